"""tidewater: batch and streaming analytics jobs on the Spark DataFrame API.

Sub-packages:

* ``functions``  native column expressions (number formatting, record parsing,
  Java-style splitting, Unicode tokenising, message building)
* ``sources``    CSV / JDBC / Kafka / text readers and the stream envelope
* ``sinks``      JSON, single-file, JDBC and Kafka writers, previews
* ``operators``  relational jobs (dimension summary, windowed counts, replay)
* ``streaming``  the event-time word-count stream and its runners
* ``plans``      the registered queries and their SQL oracles
"""

__version__ = "0.1.0"
