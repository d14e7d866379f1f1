"""Writers."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from optiontide.operators.ordered import with_ordinal
from optiontide.operators.tables import latest_per_key, without_keys
from optiontide.session import shuffle_width
from optiontide.sources.versions import merge_folders, read_version

JDBC_DEFAULTS = {"batchsize": "5000", "useBulkCopyForBatchInsert": "true", "cacheBulkCopyMetadata": "true"}


def write_jdbc_append(df: DataFrame, url: str, table: str, props: Mapping[str, str] | None = None) -> None:
    """Append through JDBC, 5000 rows per batch unless ``props`` say otherwise."""
    df.write.jdbc(url, table, mode="append", properties={**JDBC_DEFAULTS, **(props or {})})


def write_epoch(df: DataFrame, path: str, epoch: int, run: str = "default", codec: str | None = None) -> None:
    """Write one epoch of one run into an epoch table; writing it again replaces it.

    Epoch numbers start anew with every checkpoint, so ``run`` has to tell
    checkpoints (days, topics) apart. It names a folder, so it is letters, digits, dots, dashes and underscores.
    ``codec`` compresses the files, the session's codec unless given.
    """
    if not re.fullmatch(r"[A-Za-z0-9._-]+", run):
        raise ValueError(f"a run can't be called {run!r}")
    df.write.mode("overwrite").parquet(f"{path}/run={run}/epoch={epoch}", compression=codec)


def read_epochs(spark: SparkSession, path: str, ids: Sequence[tuple[str, int]] | None = None) -> DataFrame:
    """All rows of an epoch table (or of the given runs and epochs) with their ``run`` and ``epoch``.

    Runs are read as text, so ``1`` and ``01`` stay apart.
    """
    folders = [path] if ids is None else [f"{path}/run={run}/epoch={epoch}" for run, epoch in ids]
    found = spark.read.option("basePath", path).parquet(*folders).schema
    kinds = {"run": T.StringType(), "epoch": T.LongType()}
    typed = T.StructType([T.StructField(f.name, kinds.get(f.name, f.dataType)) for f in found])
    return spark.read.schema(typed).option("basePath", path).parquet(*folders)


def read_merged(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Newest row per key over all runs and epochs, merged on reading; see ``merge_epochs`` for a stored merge."""
    return latest_per_key(read_epochs(spark, path), keys, [*order, "epoch", "run"]).drop("run", "epoch")


#: Epochs that one version takes.
MOST_EPOCHS = 10_000


def merge_epochs(spark: SparkSession, epochs: str, table: str, keys: Sequence[str], order: Sequence[Column | str], buckets: int = 64) -> int:
    """Merge the epochs that ``table`` has not taken yet into it; returns how many there were.

    The table is kept in versions (see ``versions``), its rows dealt to ``buckets`` by a hash of the whole key; the
    number is fixed by the first merge and should leave a few GB in a bucket. Epochs whose write has not ended wait for a later
    merge. A merge that broke off changes nothing and is done again. Read with ``read_table``.
    """
    count = 0
    while taken := merge_folders(spark, lambda ids: read_epochs(spark, epochs, ids), epochs, table, keys, order, buckets, MOST_EPOCHS):
        count += taken
    return count


def read_table(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    """Rows of a table that ``merge_epochs`` keeps, as of its newest version or an earlier one that is still there."""
    rows = read_version(spark, table, version)
    if rows is None:
        raise ValueError(f"no rows in {table}")
    return rows


def write_with_fallback(df: DataFrame, primary: Callable[[DataFrame], None], fallback_dir: str, day: str, epoch: int,
                        run: str = "default") -> bool:
    """Write with ``primary``; when that fails, keep the rows as parquet under ``errors/day/run/epoch``.

    Returns whether the primary write succeeded. The fallback folder is per run
    and epoch and replaced on a replay. A primary write that failed half-way
    may have stored some of the rows: ``pending_rows`` leaves those out.
    """
    try:
        primary(df)
        return True
    except (PySparkException, Py4JJavaError, OSError) as error:
        tagged = df.withColumn("write_error", F.lit(type(error).__name__))
        tagged.write.mode("overwrite").parquet(f"{fallback_dir}/errors/{day}/run={run}/epoch={epoch}")
        return False


def pending_rows(spark: SparkSession, fallback_dir: str, day: str, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fallback rows of a day whose key the primary table does not hold yet."""
    kept = spark.read.parquet(f"{fallback_dir}/errors/{day}")
    return without_keys(kept, stored, keys).drop("run", "epoch", "write_error")


def append_order_log(df: DataFrame, path: str) -> None:
    """Append orders as JSON lines; earlier files are not read or rewritten."""
    df.write.mode("append").json(path)


#: Rows of a JSON document unless the caller says otherwise.
DOCUMENT_ROWS = 1000


def rows_to_json_documents(df: DataFrame, keys: Sequence[str] = (), metadata: Mapping[str, Column] | None = None,
                           name: str = "json", order: Sequence[str] = (), rows_per_document: int | None = DOCUMENT_ROWS,
                           bucket: Column | None = None) -> DataFrame:
    """JSON array documents of all rows per ``keys``, with metadata columns.

    A document holds up to ``rows_per_document`` rows of a key: ``part`` counts its documents from 0 along
    ``order`` (all columns unless given). No group is gathered whole: rows are numbered range by range, at sampled places
    or where ``bucket`` grows with the order. Parts do not depend on
    how the rows are partitioned if ``order`` tells rows apart; ``document_index`` lists a key's parts. With None a key's rows become one
    document, for callers that know a bound on a key. Dates become ISO text.
    """
    body = [c for c in df.columns if c not in keys]
    row = F.struct(*body).alias("__row")
    if rows_per_document is None:
        at = F.struct(*order) if order else F.lit(0)
        placed = df.select(*keys, row, F.lit(0).cast("long").alias("part"), at.alias("__at"))
    else:
        along = list(order) or [c for c in body if not isinstance(df.schema[c].dataType, (T.MapType, T.VariantType))]
        lined = with_ordinal(df, list(keys), along, bucket, "__n")
        placed = lined.select(*keys, row, F.expr(f"(__n - 1) div {int(rows_per_document)}").alias("part"), F.col("__n").alias("__at"))
    documents = placed.groupBy(*keys, "part").agg(
        F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("__at", "__row"))), lambda x: x["__row"])).alias(name),
        F.count(F.lit(1)).alias("rows"),
    )
    return documents.withColumns(dict(metadata or {}))


def document_index(documents: DataFrame, keys: Sequence[str], first: Column, last: Column) -> DataFrame:
    """A row for each key of bounded documents: number of parts and rows, the least ``first`` and the greatest ``last`` of its parts.

    Second level of the aggregation: it reads counts and ends, so no value holds a key.
    """
    return documents.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("parts"), F.sum("rows").alias("rows"), F.min(first).alias("first"), F.max(last).alias("last"))


def save_snapshot(df: DataFrame, path: str, as_of: str) -> None:
    """Write the snapshot of one day; a second write of that day replaces it."""
    df.write.mode("overwrite").parquet(f"{path}/as_of={as_of}")


def last_updated(snapshot: DataFrame) -> DataFrame:
    """Newest snapshot date as one row."""
    return snapshot.agg(F.max(F.col("as_of").cast("date")).alias("last_updated"))


def staleness(snapshot: DataFrame, target: Column | str) -> DataFrame:
    """last_updated and whether it is missing or before the target date."""
    wanted = target if isinstance(target, Column) else F.lit(target).cast("date")
    return last_updated(snapshot).withColumn("is_stale", F.coalesce(F.col("last_updated") < wanted, F.lit(True)))


def is_stale(spark: SparkSession, path: str, target: str) -> bool:
    try:
        snapshot = spark.read.parquet(path)
    except PySparkException:
        return True
    return bool(staleness(snapshot, target).first()["is_stale"])


def spread_for_write(df: DataFrame, keys: Sequence[str] = ("symbol",), files: int | None = None) -> DataFrame:
    """Even output by hash of a high-cardinality key, not by side or expiry."""
    return df.repartition(files or shuffle_width(df.sparkSession), *keys)
