"""Session helpers: a tuned local builder, and the shared working folder."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "optiontide", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks; on a cluster use the session you are given."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.streaming.stopTimeout", "60s")
        .getOrCreate()
    )


@functools.cache
def _test_dir() -> str:
    return tempfile.mkdtemp(prefix="optiontide-")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder from ``spark.checkpoint.dir``.

    Only a local session that names none (tests on one machine) gets a
    temporary folder, the same one for the whole process; elsewhere executors
    would write to disks of their own, so that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.conf.get("spark.master", "local").split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (named or _test_dir()).rstrip("/")


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder path of the shared folder for one run."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def widen(df: DataFrame) -> DataFrame:
    """Spread a source that has fewer partitions than there are cores.

    For CPU-heavy work on few large splits or few topic partitions. A source
    that is wide enough is left alone, so large inputs are not shuffled. Meant
    for a plain scan or micro-batch: the partition count of a plan with joins
    is not known before it runs.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


@contextlib.contextmanager
def split_bytes(spark: SparkSession, size: int) -> Iterator[None]:
    """Files that are read inside the block come in splits of at most ``size`` bytes, for work that is costly by the byte.

    Spark has no such option of a reader; streams over files look it up in the session they were made in, batch by batch.
    """
    name = "spark.sql.files.maxPartitionBytes"
    before, given = spark.conf.get(name), spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    spark.conf.set(name, str(min(size, given)))
    try:
        yield
    finally:
        spark.conf.set(name, before)
