"""Messages delivered once through sinks that can only promise at least once.

A batch's messages are dealt to parts by a hash of their bytes, so a message is in
the same part however often the batch runs and however it is partitioned. Its id is
that hash and its place among the batch's rows, which tells equal messages apart;
ids are written once a run, before anything is sent. Each part is sent by an attempt of its own name and then entered
in a ledger. A batch that runs again sends only the parts the ledger lacks, so a
batch or part that was done adds nothing. What a failed attempt or a repeated task
has sent besides is told apart by what every message carries: a reader takes the
messages whose ``(batch_id, part, attempt)`` is in the ledger, each id once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Parts of a batch that are sent and entered on their own.
PARTS = 8
LEDGER_SCHEMA = "batch_id bigint, part int, attempt string, messages bigint"
#: Columns that travel with a message (Kafka: as headers).
HEADERS = ("batch_id", "part", "attempt", "message_id")

Send = Callable[[DataFrame], None]


def number_messages(batch: DataFrame, batch_id: int, parts: int = PARTS) -> DataFrame:
    """``batch`` (with ``key`` and ``value``) and ``batch_id``, ``part``, ``message_id``.

    The place is the task and the row in it: no message moves to be numbered,
    however many equal ones there are.
    """
    digest = F.sha2(F.concat_ws("/", F.md5(F.coalesce("key", F.lit(b""))), F.md5(F.coalesce("value", F.lit(b"")))), 256)
    return batch.withColumns({"__digest": digest, "__place": F.monotonically_increasing_id()}).select(
        *batch.columns, F.lit(batch_id).cast("bigint").alias("batch_id"),
        F.pmod(F.xxhash64("__digest"), F.lit(parts)).cast("int").alias("part"),
        # Half of the hash: the place makes the id unique.
        F.concat_ws("-", F.lit(batch_id), F.substring("__digest", 1, 32), "__place").alias("message_id"),
    )


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """Delivered parts; empty before the first delivery."""
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(ledger)


def deliver_batches(send: Send, ledger: str, parts: int = PARTS) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that sends each message of a batch once.

    ``send`` writes the messages it is given through any sink; it may fail, and
    may write some rows more than once. The numbered batch is kept in the shared
    folder while its parts are sent, so all parts see the same rows.
    """

    def deliver(batch: DataFrame, batch_id: int) -> None:
        from tidewater.session import scratch_path

        spark = batch.sparkSession
        entered = read_ledger(spark, ledger).where(F.col("batch_id") == batch_id).select("part").distinct()
        done = {r.part for r in entered.collect()}  # at most one row a part
        if len(done) == parts:
            return
        path = scratch_path(spark, f"delivery-{batch_id}")
        numbered = number_messages(batch, batch_id, parts)
        numbered.write.partitionBy("part").parquet(path)
        numbered = spark.read.schema(numbered.schema).parquet(path)
        for part in sorted(set(range(parts)) - done):
            attempt = uuid.uuid4().hex
            rows = numbered.where(F.col("part") == part).withColumn("attempt", F.lit(attempt))
            send(rows)
            entry = spark.createDataFrame([(batch_id, part, attempt, rows.count())], LEDGER_SCHEMA)
            entry.coalesce(1).write.mode("append").parquet(ledger)

    return deliver


def delivered_once(messages: DataFrame, ledger: DataFrame) -> DataFrame:
    """Each delivered message once: sent by the attempt that the ledger names for
    its part (the least, if two drivers should have entered the part)."""
    named = ledger.groupBy("batch_id", "part").agg(F.min("attempt").alias("attempt"))
    return messages.join(named, ["batch_id", "part", "attempt"], "left_semi").dropDuplicates(["message_id"])
