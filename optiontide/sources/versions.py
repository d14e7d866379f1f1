"""Tables in versions: new files, then one manifest that names them.

A table's rows stand in folders that are never written twice. A version is a manifest: for each hash bucket of the key the folder that
holds it, and the folder with the epochs merged so far. A manifest counts once its commit marker is there, and it is
written last, so readers follow the newest complete one: they see a version whole, also
while the next one is written, and a merge that broke off leaves nothing but files
that no manifest names. The bucket of a key depends on the key alone. One merge at a time writes to a table; a second one
that finishes the same version later fails.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from optiontide.operators.tables import latest_per_key

_MANIFEST = "buckets int, bucket int, folder string, taken string"
#: Columns that keep where a row came from, so that rows of equal order are told apart as on a merge of everything at once.
ORIGIN = ("merge_epoch", "merge_run")


def _files(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, hidden ones too."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return [f.getPath().toString() for f in found or []]


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@dataclass
class Version:
    """Number, how many buckets keys are dealt to, the folder of each bucket that has rows, and the folder of the epochs taken."""

    number: int
    buckets: int
    folders: dict[int, str]
    taken: str


def _number(path: str) -> int:
    return int(path.rstrip("/").rsplit("version=", 1)[1].split("/", 1)[0])


def versions(spark: SparkSession, table: str) -> list[int]:
    """Numbers of the complete versions, rising."""
    return sorted(_number(p) for p in _files(spark, f"{table}/manifests/version=*/_SUCCESS"))


def version(spark: SparkSession, table: str, number: int | None = None) -> Version | None:
    """A version, the newest complete one unless a number is given; None if there is none."""
    there = versions(spark, table)
    if number is not None and number not in there:
        raise ValueError(f"no version {number}")
    if not there:
        return None
    number = there[-1] if number is None else number
    rows = spark.read.schema(_MANIFEST).parquet(f"{table}/manifests/version={number}").collect()  # a row for each bucket
    return Version(number, rows[0]["buckets"], {r["bucket"]: r["folder"] for r in rows if r["bucket"] is not None}, rows[0]["taken"])


def read_version(spark: SparkSession, table: str, number: int | None = None, buckets: Sequence[int] | None = None, origin: bool = False) -> DataFrame | None:
    """Rows of a version (of some of its buckets); None if it holds none."""
    found = version(spark, table, number)
    names = [] if found is None else [f"{table}/{f}/bucket={b}" for b, f in sorted(found.folders.items()) if buckets is None or b in buckets]
    if not names:
        return None
    rows = spark.read.parquet(*names)
    return rows if origin else rows.drop(*ORIGIN)


def complete_epochs(spark: SparkSession, epochs: str) -> DataFrame:
    """(run, epoch) of the folders of an epoch table whose write has ended."""
    found = []
    for path in _files(spark, f"{epochs}/run=*/epoch=*/_SUCCESS"):
        run, epoch = path.split("/")[-3:-1]
        found.append((run.removeprefix("run="), int(epoch.removeprefix("epoch="))))
    return spark.createDataFrame(found, "run string, epoch long")


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def merge_folders(spark: SparkSession, read, epochs: str, table: str, keys: Sequence[str], order: Sequence[Column | str], buckets: int, most: int) -> int:
    """Merge up to ``most`` complete epochs that the newest version has not taken into the next version; returns how many.

    ``read`` gives the rows of a list of (run, epoch) with these columns. The newest row of a key is the last by ``order``, then epoch, then run.
    Only buckets that new rows touch are read and written.
    """
    now = version(spark, table)
    there = complete_epochs(spark, epochs)
    taken = spark.read.schema("run string, epoch long").parquet(f"{table}/{now.taken}") if now else None
    new = there.join(taken, ["run", "epoch"], "left_anti") if now else there
    ids = [(r["run"], r["epoch"]) for r in new.orderBy("epoch", "run").limit(most).collect()]
    if not ids:
        return 0
    buckets = now.buckets if now else buckets
    work = uuid.uuid4().hex
    rows = read(ids).withColumnRenamed("epoch", ORIGIN[0]).withColumnRenamed("run", ORIGIN[1]).withColumn("bucket", _bucket(keys, buckets))
    fresh_path = f"{table}/data/{work}/fresh"
    latest_per_key(rows, keys, [*order, *ORIGIN]).write.parquet(fresh_path)
    fresh = spark.read.schema(rows.schema).parquet(fresh_path)
    touched = sorted(r["bucket"] for r in fresh.select("bucket").distinct().collect())  # at most ``buckets``
    old = read_version(spark, table, now.number, touched, origin=True) if now else None
    merged = fresh
    if old is not None:
        old = old.withColumn("bucket", _bucket(keys, buckets))
        merged = latest_per_key(old.unionByName(fresh, allowMissingColumns=True), keys, [*order, *ORIGIN])
    folder = f"data/{work}/rows"
    # A rebalance splits large buckets over several tasks and files, and joins small ones.
    merged.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{table}/{folder}")
    _remove(spark, fresh_path)
    taken_path = f"data/{work}/taken"
    done = spark.createDataFrame(ids, "run string, epoch long")
    (taken.union(done) if now else done).coalesce(1).write.parquet(f"{table}/{taken_path}")
    folders = {**(now.folders if now else {}), **dict.fromkeys(touched, folder)}
    manifest = [(buckets, b, f, taken_path) for b, f in sorted(folders.items())] or [(buckets, None, None, taken_path)]
    # A folder without a marker is left from a merge that broke off; its number is passed over.
    last = max((_number(p) for p in _files(spark, f"{table}/manifests/version=*")), default=0)
    spark.createDataFrame(manifest, _MANIFEST).coalesce(1).write.mode("errorifexists").parquet(f"{table}/manifests/version={last + 1}")
    return len(ids)


def expire_versions(spark: SparkSession, table: str, keep: int = 2) -> list[int]:
    """Remove all but the newest ``keep`` versions, and the files that only they name; returns the numbers removed.

    Not while a merge runs: its files are not named yet. Readers of removed versions fail.
    """
    if keep < 1:
        raise ValueError("the newest version stays")
    there = versions(spark, table)
    kept = [version(spark, table, n) for n in there[-keep:]]
    if not kept:
        return []
    named = {f.split("/")[1] for v in kept for f in (*v.folders.values(), v.taken)}
    for path in _files(spark, f"{table}/manifests/version=*"):
        if _number(path) < kept[0].number:
            _remove(spark, path)
    for path in _files(spark, f"{table}/data/*"):
        if path.rstrip("/").rsplit("/", 1)[1] not in named:
            _remove(spark, path)
    return there[:-keep]
