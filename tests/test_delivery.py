import pytest
from pyspark.sql import functions as F

from tidewater.sinks.delivery import deliver_batches, delivered_once, number_messages, read_ledger


class Sink:
    """Appends what it is given, and can fail before, midway or after."""

    def __init__(self, path):
        self.path, self.fail, self.sent = path, {}, []

    def __call__(self, messages):
        part = messages.select("part").first()
        part = part.part if part is not None else None
        self.sent.append(part)
        how = self.fail.pop(part, None)
        if how == "midway":
            messages.limit(3).write.mode("append").parquet(self.path)
        elif how != "before":
            messages.write.mode("append").parquet(self.path)
        if how:
            raise RuntimeError(f"failed {how}")


def _messages(spark, n=200):
    rows = [(f"k{i % 3}".encode(), f"v{i // 4}".encode()) for i in range(n)]  # each message four times or so
    rows += [(None, b"no key"), (b"no value", None), (None, None), (b"k0", b"v0")]
    return spark.createDataFrame(rows, "key binary, value binary").repartition(5), rows


def _read(spark, sink, ledger):
    once = delivered_once(spark.read.parquet(sink.path), read_ledger(spark, ledger))
    return sorted((bytes(r.key or b"") + b"/" + bytes(r.value or b"") for r in once.collect()))


def _plain(rows):
    return sorted((k or b"") + b"/" + (v or b"") for k, v in rows)


@pytest.mark.parametrize("how", ["before", "midway", "after"])
def test_a_batch_that_fails_midway_is_read_once(spark, scratch, how):
    messages, rows = _messages(spark)
    sink, ledger = Sink(scratch("sent")), scratch("ledger")
    deliver = deliver_batches(sink, ledger, parts=4)
    sink.fail = {2: how}
    with pytest.raises(RuntimeError, match=how):
        deliver(messages, 0)
    assert len(_read(spark, sink, ledger)) < len(rows)
    deliver(messages, 0)
    assert _read(spark, sink, ledger) == _plain(rows)
    # Parts that were done are not sent again, and a third run sends nothing.
    assert sink.sent == [0, 1, 2, 2, 3]
    deliver(messages, 0)
    assert sink.sent == [0, 1, 2, 2, 3]


def test_batches_do_not_replace_each_other(spark, scratch):
    messages, rows = _messages(spark, 40)
    sink, ledger = Sink(scratch("sent")), scratch("ledger")
    deliver = deliver_batches(sink, ledger, parts=3)
    deliver(messages, 0)
    deliver(messages, 1)  # the same messages again, in a batch of their own
    assert _read(spark, sink, ledger) == sorted(2 * _plain(rows))
    deliver(messages.limit(0), 2)
    assert _read(spark, sink, ledger) == sorted(2 * _plain(rows))
    entered = read_ledger(spark, ledger)
    assert entered.count() == 9 and entered.agg(F.sum("messages")).first()[0] == 2 * len(rows)


def test_a_task_that_sends_twice_is_read_once(spark, scratch):
    messages, rows = _messages(spark)
    path, ledger = scratch("sent"), scratch("ledger")

    def twice(part):
        part.union(part.limit(5)).write.mode("append").parquet(path)

    sink = Sink(path)
    deliver_batches(twice, ledger, parts=2)(messages, 7)
    assert _read(spark, sink, ledger) == _plain(rows)


def test_ids_tell_all_messages_apart(spark):
    messages, rows = _messages(spark)
    numbered = number_messages(messages, 3, parts=4)
    assert numbered.select("message_id").distinct().count() == len(rows)
    assert {r.part for r in numbered.select("part").distinct().collect()} <= set(range(4))


def test_a_stream_delivers_through_the_ledger(spark, scratch):
    source, ledger, sink = scratch("source"), scratch("ledger"), Sink(scratch("sent"))
    messages, rows = _messages(spark, 60)
    messages.write.parquet(source)
    ckpt = scratch("ck")

    def run():
        stream = spark.readStream.schema(messages.schema).parquet(source)
        query = stream.writeStream.foreachBatch(deliver_batches(sink, ledger, parts=3)).option(
            "checkpointLocation", ckpt).trigger(availableNow=True).start()
        query.awaitTermination()

    sink.fail = {1: "midway"}
    with pytest.raises(Exception, match="midway"):
        run()
    run()  # Spark repeats the batch; only the missing parts are sent
    assert _read(spark, sink, ledger) == _plain(rows)


def test_no_ledger_yet(spark, scratch):
    assert read_ledger(spark, scratch("none")).collect() == []


def test_numbering_moves_no_message(spark):
    """Values are not shuffled or sorted to get their ids, and equal messages of
    any number keep ids and parts of their own, however the batch is partitioned."""
    rows = [(b"k", b"same")] * 3000 + [(b"k", f"v{i}".encode()) for i in range(500)]
    messages = spark.createDataFrame(rows, "key binary, value binary")
    numbered = number_messages(messages.repartition(6), 5, parts=4)
    ids = {r.message_id for r in numbered.select("message_id").collect()}
    assert len(ids) == len(rows) and all(i.startswith("5-") for i in ids)

    def parts(df):
        return sorted((bytes(r.value), r.part) for r in number_messages(df, 5, parts=4).collect())

    assert parts(messages.coalesce(1)) == parts(messages.repartition(7))
    plan = number_messages(spark.range(9).selectExpr("cast(string(id) as binary) key", "cast(string(id) as binary) value"), 0)
    plan = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and "Sort" not in plan
