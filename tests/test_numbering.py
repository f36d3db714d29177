import os

from pyspark.sql import functions as F

from tidewater.operators.joins import bounded_side as numbering_side
from tidewater.operators.numbering import number_rows
from tidewater.sources.text import read_lines_in_order


def _write(folder, files):
    os.makedirs(folder)
    for name, lines in files.items():
        with open(f"{folder}/{name}", "w") as fh:
            fh.write("".join(f"{line}\n" for line in lines))


def _numbered(spark, folder):
    return {r.line_no: r.value for r in number_rows(read_lines_in_order(spark, folder)).collect()}


def test_lines_of_files_in_many_splits(spark, scratch):
    folder = scratch("lines")
    files = {f"part-{k}.txt": [f"{k}/{i} " + "x" * (i * 7 % 90) for i in range(n)] for k, n in enumerate((3000, 0, 1, 500))}
    files["part-1.txt"] = []
    _write(folder, files)
    want = dict(enumerate(line for name in sorted(files) for line in files[name]))
    for size in ("4k", "37k", "128m"):  # splits far smaller than a file, and packed into tasks out of order
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            pieces = read_lines_in_order(spark, folder).select("file", "block").distinct().count()
            assert _numbered(spark, folder) == want
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert pieces >= {"4k": 30, "37k": 4, "128m": 3}[size]


def test_repeated_and_empty_lines(spark, scratch):
    folder = scratch("lines")
    _write(folder, {"a.txt": ["same"] * 5 + ["", ""], "b.txt": ["", "same"]})
    assert _numbered(spark, folder) == dict(enumerate(["same"] * 5 + ["", "", "", "same"]))
    assert number_rows(read_lines_in_order(spark, folder).filter(F.lit(False))).collect() == []


def test_only_counts_are_shuffled(spark, scratch):
    folder = scratch("lines")
    _write(folder, {"a.txt": ["x"] * 50})
    rows = number_rows(read_lines_in_order(spark, folder))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "Exchange hashpartitioning" not in plan and "Window" not in plan


def test_more_pieces_than_may_be_sent_to_every_task(spark, scratch, monkeypatch):
    from tidewater.operators import numbering

    folder = scratch("lines")
    _write(folder, {"a.txt": ["x", "y"] * 50, "b.txt": ["z"]})
    monkeypatch.setattr(numbering, "bounded_side", lambda df: numbering_side(df, max_rows=1))
    assert _numbered(spark, folder) == dict(enumerate(["x", "y"] * 50 + ["z"]))
