"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import functools
import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from optiontide.session import shared_dir

#: Words are runs of anything but blanks and the control characters tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


#: Bytes of an Arrow batch on its way to a Python worker.
BATCH = 4 << 20
_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_DEFAULT = "67108864b"


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH`` bytes (or one row), unless the session names a limit of its own.

    It bounds memory and changes no result. Spark has this limit by session only; its default of 64 MB would be held by the
    executor and by both of its workers, for every task.
    """
    if spark.conf.get(_BYTES) == _DEFAULT:
        spark.conf.set(_BYTES, str(BATCH))


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A function over Arrow batches that hands its task's memory back at the end: workers wait for the next task with what they hold."""
    @functools.wraps(run)
    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()

    return held


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns of these names (in any case), so that new ones can take the names."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def numbered_within(df: DataFrame, group: list[str], spread: list[Column], order: list[Column], name: str, buckets: int) -> DataFrame:
    """Gapless numbers from 0 within each ``group``, however large one group is.

    A group is cut into ``buckets`` by a hash of ``spread``; a bucket's rows are
    numbered on their own and start where the counts of the buckets before
    end. Only the counts (groups times ``buckets`` rows) meet per group. Rows
    equal in every column of ``order`` may swap numbers between runs.
    """
    df = df.withColumn("__bucket", F.pmod(F.xxhash64(*spread), F.lit(buckets)))
    before = Window.partitionBy(*group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        df.groupBy(*group, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        .select(*[F.col(g).alias(f"__{g}") for g in group], F.col("__bucket").alias("__b"), "__start")
    )
    same = F.col("__bucket") == F.col("__b")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"__{g}"))
    inner = Window.partitionBy(*group, "__bucket").orderBy(*order)
    return (
        df.withColumn("__row", F.row_number().over(inner))
        .join(starts, same)
        .withColumn(name, F.col("__start") + F.col("__row") - 1)
        .drop("__bucket", "__row", "__b", "__start", *[f"__{g}" for g in group])
    )


class Folder:
    """Tables written below one new folder of the shared one and read again; that cuts their lineage."""

    def __init__(self, df: DataFrame, name: str):
        self.spark, self.path = df.sparkSession, f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"

    def put(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.path}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")
