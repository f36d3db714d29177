"""CSV tables with a header row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: Column that holds the raw line of a row that does not fit the schema.
RAW_LINE = "_raw_line"


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    infer: bool = False,
    header: bool = True,
    **options: str,
) -> DataFrame:
    """Read CSV with a header.

    Give ``schema`` in production: inference (``infer=True``) costs an extra
    full pass over the files before the query starts, and it narrows types
    (a bigint column whose values fit comes back as int; ``0005`` becomes 5).
    Without schema or inference, every column is a string.
    """
    reader = spark.read.option("header", str(header).lower())
    for key, value in options.items():
        reader = reader.option(key, value)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


def read_csv_sides(
    spark: SparkSession,
    path: str,
    schema: StructType,
    header: bool = True,
    **options: str,
) -> tuple[DataFrame, DataFrame]:
    """``(good, rejects)``: rows that fit the schema, and the raw lines of all others.

    A line is rejected if a value does not parse as its column's type or if it has
    more or fewer values than the schema; every line that is not blank is on exactly
    one side, whatever columns a query selects. ``rejects`` has the line
    (``_raw_line``) and its file. With ``header``, lines that hold just the names of
    the schema are left out. A quoted value may not hold a line end.
    """
    if RAW_LINE in schema.fieldNames():
        raise ValueError(f"the schema may not have a column {RAW_LINE}")
    lines = spark.read.text(path).where(F.trim("value") != "")
    if header:
        lines = lines.where(F.col("value") != options.get("sep", ",").join(schema.fieldNames()))
    whole = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*schema.fields, StructField(RAW_LINE, StringType())])
    kept = {**options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RAW_LINE}
    rows = lines.select(F.from_csv("value", whole, kept).alias("row"), F.col("_metadata.file_path").alias("file"))
    raw = F.col(f"row.{RAW_LINE}")
    good = rows.where(raw.isNull()).select(*[F.col(f"row.`{n}`") for n in schema.fieldNames()])
    return good, rows.where(raw.isNotNull()).select(raw.alias(RAW_LINE), "file")
