"""Keyed messages to Kafka (needs the ``spark-sql-kafka`` package)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def kafka_sink_options(
    bootstrap_servers: str, topic: str, auth_options: dict[str, str] | None = None
) -> dict[str, str]:
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic}
    if auth_options:
        opts["kafka.security.protocol"] = "SASL_SSL"
        opts.update(auth_options)
    return opts


def send_with_headers(options: dict[str, str]):
    """A ``send`` function for ``sinks.delivery``: what a reader needs to take every
    message once travels as record headers."""
    from tidewater.sinks.delivery import HEADERS

    def send(messages: DataFrame) -> None:
        headers = F.array(*[F.struct(F.lit(h).alias("key"), F.col(h).cast("string").cast("binary").alias("value"))
                            for h in HEADERS])
        rows = messages.select("key", "value", headers.alias("headers"))
        rows.write.format("kafka").options(**options).option("includeHeaders", "true").save()

    return send


def write_kafka(df: DataFrame, options: dict[str, str]) -> None:
    """Write ``key``/``value`` (binary or string) columns as Kafka records.

    Each task produces its own partition's records, so publishing is as
    parallel as the frame.
    """
    df.select("key", "value").write.format("kafka").options(**options).save()
