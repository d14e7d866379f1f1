"""Delimited text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from optiontide.schemas import EQUITY_MASTER_COLUMNS, OPTION_MASTER_COLUMNS


def read_symbol_master(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Pipe-separated symbol master with fixed column names; its header row is skipped."""
    columns = {"equities": EQUITY_MASTER_COLUMNS, "options": OPTION_MASTER_COLUMNS}[kind]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.csv(path, sep="|", header=True, schema=schema, enforceSchema=True, quote="")


def parse_delimited(spark: SparkSession, path: str, schema: T.StructType | str, first_row: int = 2,
                    last_row: int | None = None, sep: str = ",", row_sep: str = "\n") -> DataFrame:
    """Rows ``first_row`` to ``last_row`` of each file (1 = first line), typed by ``schema``, with ``bad_line``.

    ``bad_line`` holds the text of a line that does not fit and is null else.
    Blank lines give no row. Lines are numbered per file split and offset by the lines of
    earlier splits, so a large file is read in parallel. A split's lines have running ids as they are read, so none is sorted or shuffled: only the least
    id and the number of lines of each split are.
    """
    lines = spark.read.text(path, lineSep=row_sep).select(
        "value",
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__start"),
        F.monotonically_increasing_id().alias("__id"),
    )
    splits = lines.groupBy("__file", "__start").agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("__file").orderBy("__start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.withColumn("__off", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")  # a row for each split
    numbered = lines.join(F.broadcast(offsets), ["__file", "__start"])
    numbered = numbered.withColumn("__line", F.col("__id") - F.col("__first") + F.col("__off") + 1)
    wanted = numbered.filter(F.col("__line") >= first_row)
    if last_row is not None:
        wanted = wanted.filter(F.col("__line") <= last_row)
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    marked = T.StructType([*fields, T.StructField("bad_line", T.StringType())])
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad_line"}
    return wanted.filter(F.trim("value") != "").select(F.from_csv("value", _ddl(marked), options).alias("r")).select("r.*")


def read_delimited(spark: SparkSession, path: str, schema: T.StructType | str, first_row: int = 2, last_row: int | None = None,
                   sep: str = ",", row_sep: str = "\n", max_errors: int | None = None) -> DataFrame:
    """The rows of ``parse_delimited`` that fit.

    More than ``max_errors`` bad rows fail the load; the count takes a pass of
    its own (``load_delimited`` counts while it writes). None sets no limit.
    """
    parsed = parse_delimited(spark, path, schema, first_row, last_row, sep, row_sep)
    if max_errors is not None:
        _refuse(parsed.agg(F.count("bad_line")).first()[0], max_errors, path)
    return parsed.filter(F.col("bad_line").isNull()).drop("bad_line")


def load_delimited(spark: SparkSession, path: str, schema: T.StructType | str, into: str, max_errors: int | None = None, **options) -> tuple[int, int]:
    """Read and write in one pass: rows that fit to ``into/bad=false``, bad lines to ``into/bad=true``.

    Returns the numbers of both. With more than ``max_errors`` bad rows it
    fails after the write, so the bad lines are there to look at.
    """
    parsed = parse_delimited(spark, path, schema, **options).withColumn("bad", F.col("bad_line").isNotNull())
    seen = Observation()
    parsed.observe(seen, F.count(F.lit(1)).alias("rows"), F.count("bad_line").alias("bad")).write.partitionBy("bad").parquet(into)
    counts = seen.get
    _refuse(counts["bad"], max_errors, path)
    return counts["rows"] - counts["bad"], counts["bad"]


def _refuse(errors: int, limit: int | None, path: str) -> None:
    if limit is not None and errors > limit:
        raise ValueError(f"{errors} rows of {path} do not fit the schema, more than {limit}")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
