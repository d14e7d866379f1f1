"""Token counts kept as additive totals by source, language and tokenizer version.

A change holds what a document counted before and what it counts after: an
insert has only the second, a delete only the first, a revision both. A batch
of changes is folded to signed sums per key (with a map-side part, so a hot key
costs one row per task) and written to a folder of its own,
``<root>/batch=<id>``; committing the same id again replaces that folder, so
replays change nothing. Totals are the sums over all batch folders;
``compact`` folds old ones and remembers their ids.

Null sources, languages and versions are keys of their own. Null token counts
count as 0 tokens of one document. An empty batch commits an empty folder.
Changes of the same document within a batch simply add up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("source", "lang", "tokenizer")
DELTA = "source string, lang string, tokenizer string, documents long, tokens long"
FOLDED = "batch string"


def side(source: Column, lang: Column, tokenizer: Column, tokens: Column) -> Column:
    """What a document counts: one side of a change."""
    return F.struct(source.alias("source"), lang.alias("lang"), tokenizer.alias("tokenizer"), tokens.cast("long").alias("tokens"))


def nothing() -> Column:
    return F.lit(None).cast("struct<source:string,lang:string,tokenizer:string,tokens:bigint>")


def signed_sums(changes: DataFrame) -> DataFrame:
    """Signed documents and tokens per key of changes with columns ``before`` and ``after``."""
    sides = F.array(F.struct(F.lit(-1).alias("sign"), F.col("before").alias("it")), F.struct(F.lit(1).alias("sign"), F.col("after").alias("it")))
    rows = changes.select(F.explode(F.filter(sides, lambda x: x["it"].isNotNull())).alias("x"))
    sums = rows.groupBy(*[F.col(f"x.it.{k}").alias(k) for k in KEYS]).agg(
        F.sum(F.col("x.sign")).cast("long").alias("documents"),
        F.sum(F.col("x.sign") * F.coalesce("x.it.tokens", F.lit(0))).cast("long").alias("tokens"))
    return sums.where((F.col("documents") != 0) | (F.col("tokens") != 0))


def committed(spark: SparkSession, root: str) -> DataFrame:
    """Ids of the batches that a compaction has folded."""
    return _read(spark, f"{root}/folded", FOLDED)


def _exists(spark: SparkSession, path: str) -> bool:
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there)


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if _exists(spark, path) else spark.createDataFrame([], schema)


def commit_batch(changes: DataFrame, root: str, batch: str) -> bool:
    """Write a batch's signed sums; False if a compaction has folded that batch before."""
    spark = changes.sparkSession
    if not committed(spark, root).where(F.col("batch") == batch).isEmpty():
        return False
    signed_sums(changes).write.mode("overwrite").parquet(f"{root}/deltas/batch={batch}")
    return True


def totals(spark: SparkSession, root: str) -> DataFrame:
    """Documents and tokens per key over all committed batches; keys without documents and tokens are left out."""
    folded = committed(spark, root)
    deltas = _read(spark, f"{root}/deltas", f"{DELTA}, batch string").join(folded, "batch", "left_anti").drop("batch")
    rows = deltas.unionByName(_read(spark, f"{root}/base", DELTA))
    sums = rows.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
    return sums.where((F.col("documents") != 0) | (F.col("tokens") != 0))


def compact(spark: SparkSession, root: str, into: str) -> None:
    """Totals and the ids they hold, written to a new root ``into``; readers change over when it is complete."""
    totals(spark, root).write.mode("overwrite").parquet(f"{into}/base")
    ids = _read(spark, f"{root}/deltas", f"{DELTA}, batch string").select("batch").union(committed(spark, root)).distinct()
    ids.write.mode("overwrite").parquet(f"{into}/folded")
