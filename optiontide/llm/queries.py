"""Queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from optiontide.llm import bpe, lang_id, oracle_sql, quality, toxicity
from optiontide.llm.common import bound_batches, word_count
from optiontide.llm.hyperminhash import near_duplicates
from optiontide.llm.itq import near_vectors
from optiontide.llm.lexical import search
from optiontide.llm.mixing import mix
from optiontide.llm.repair import repair, transcripts
from optiontide.llm.secrets import BASE, find_secrets, listing
from optiontide.llm.sharding import rendezvous, shard_records
from optiontide.llm.token_rollup import commit_batch, nothing, side, totals
from optiontide.llm.voronoi import top_k, whole_numbers
from optiontide.session import run_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SHARDS = 16
RANK_FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table. Arrow batches are bounded by bytes, so that long texts stay within a worker's memory."""
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op4_rendezvous_shards")
def op4(spark, sf_dir):
    """Every document's shard among 16 equal ones, its slot there, and its shard among 17."""
    equal = {s: 1.0 for s in range(SHARDS)}
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32("text").alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    return shard_records(rows, "doc_id", equal, ["text_crc32", "size"]).withColumn(
        "grown_shard", rendezvous(F.col("doc_id"), {**equal, SHARDS: 1.0}))


@query("op6_secret_scan", oracle_sql.SECRETS)
def op6(spark, sf_dir):
    """Secrets of every whole text: counts of the base kinds, a digest of the base spans, and all spans."""
    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("secrets", lambda x: x["rank"] < len(BASE))

    def count(rank):
        return F.size(F.filter("secrets", lambda x: x["rank"] == rank)).cast("long")

    return found.select(
        "doc_id", *[count(r).alias(f"n_{b[0]}") for r, b in enumerate(BASE)],
        F.sha2(listing(base), 256).alias("base_sha256"), listing(F.col("secrets")).alias("spans"))


@query("op2_mix_sources")
def op2(spark, sf_dir):
    """Words that the mix takes of every document, with its source's size and target."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("words"))
    mixed = mix(rows, "source", F.col("words"), ["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "rate")


@query("op5_token_rollup", r"""
WITH d AS (
  SELECT source, lang, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words,
         len(regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[0-9]+|[^\x20\x09-\x0DA-Za-z0-9]')) AS pieces
  FROM documents)
SELECT source, lang, CASE WHEN words >= 100 THEN 'pieces-2' ELSE 'words-1' END AS tokenizer,
       count(*) AS documents, CAST(sum(CASE WHEN words >= 100 THEN pieces ELSE words END) AS BIGINT) AS tokens
FROM d WHERE words >= 3 GROUP BY ALL""")
def op5(spark, sf_dir):
    """Totals after three batches over all documents, the second of them committed twice.

    All documents come in under the first tokenizer version; those of 100 words
    or more are recounted under the second; those under 3 words are deleted.
    """
    pieces = F.regexp_count("text", F.lit(r"[A-Za-z]+|[0-9]+|[^\x20\x09-\x0DA-Za-z0-9]"))
    root = run_dir(spark, "token-rollup")
    table(spark, sf_dir, "documents").select("source", "lang", word_count(F.col("text")).alias("words"), pieces.alias("pieces")).write.parquet(f"{root}/counted")
    rows = spark.read.schema("source string, lang string, words long, pieces int").parquet(f"{root}/counted")
    first = side(F.col("source"), F.col("lang"), F.lit("words-1"), F.col("words"))
    second = side(F.col("source"), F.col("lang"), F.lit("pieces-2"), F.col("pieces"))
    inserts = rows.select(nothing().alias("before"), first.alias("after"))
    revised = rows.where("words >= 100").select(first.alias("before"), second.alias("after"))
    deleted = rows.where("words < 3").select(first.alias("before"), nothing().alias("after"))
    for batch, changes in (("1", inserts), ("2", revised), ("3", deleted), ("2", revised)):
        commit_batch(changes, f"{root}/totals", batch)
    return totals(spark, f"{root}/totals")


def language_model(docs: DataFrame) -> lang_id.LanguageModel | None:
    """The model learnt from the labelled documents that are not held out."""
    learn = docs.where(F.col("lang").isNotNull() & (F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3, F.lit(0)) != 1))
    return lang_id.fit(learn.select("doc_id", "text", "lang"), "doc_id", "text", "lang")


@query("op1_language_id")
def op1(spark, sf_dir):
    """The language of every whole text, by a model that has not seen the held-out third."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    return lang_id.predict(rows, "text", language_model(docs)).select("doc_id", "held_out", "lang_pred", "score")


def token_digest(docs: DataFrame, rank_file: str = RANK_FILE) -> DataFrame:
    """doc_id, number of tokens, digest of the ids and of the bytes they decode to."""
    coded = bpe.round_trip(docs.select("doc_id", "text"), "text", rank_file)
    ids = F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), ids.alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op10_byte_bpe")
def op10(spark, sf_dir):
    """Every whole text to ids and back."""
    return token_digest(table(spark, sf_dir, "documents"))


@query("op8_minhash_near_dedup", oracle_sql.NEAR_DEDUP)
def op8(spark, sf_dir):
    """Components of documents whose sets of 4-word shingles are 80 % alike or more."""
    return near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text", words=4)


@query("op7_embedding_near_dedup", oracle_sql.NEAR_VECTORS)
def op7(spark, sf_dir):
    """Components of embeddings with a cosine of 0.9 or more."""
    return near_vectors(table(spark, sf_dir, "embeddings"))


@query("op3_voronoi_top_k", """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5""")
def op3(spark, sf_dir):
    """The 5 highest inner products of every fiftieth embedding, against all others."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", whole_numbers(F.col("embedding"), 256).alias("q"))
    return top_k(rows, "vec_id", "q", F.col("vec_id") % 50 == 0, 5)


def severity_grade() -> Column:
    """0: fit for use, 1: of low quality, 2: toxic; null without a toxic label."""
    return F.when(F.col("toxic") == 1, 2).when(F.col("toxic") == 0, F.when(F.col("quality") == 0, 1).otherwise(0))


@query("op9_toxicity_severity")
def op9(spark, sf_dir):
    """Expected severity of every document, learnt from the labelled ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), "doc_id", "text", severity_grade(), 3)
    return toxicity.severity(docs, "text", model).select("doc_id", "severity", "grade", "toxic")


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of conversations, damaged by the CRC-32 of conversation and turn: dropped, emptied, without full stops, repeated, or given to the user."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(key) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return rows.where(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("col")


@query("op13_conversation_repair", oracle_sql.REPAIR)
def op13(spark, sf_dir):
    """The cheapest repair of every conversation after damage to some of its rows."""
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = repair(damaged(conversations))
    digests = transcripts(found.rows).withColumnRenamed("conv", "__digest")
    every = conversations.select(F.col("conv_id").alias("__every")).distinct()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    out = every.join(found.conversations, F.col("__every").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    out = out.join(digests, F.col("__every").eqNullSafe(F.col("__digest")), "left")
    return out.select(
        F.col("__every").alias("conv_id"), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


#: From this score on a text is predicted to be of quality.
GOOD = 0.3


@query("op11_quality_compression")
def op11(spark, sf_dir):
    """Quality of every whole text, by a model that has not seen the labels of the held-out fifth."""
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5, F.lit(1))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(fold != 0)
    model = quality.fit(docs, labels, "doc_id", "text", "quality")
    scored = quality.score(docs.select("doc_id", (fold == 0).alias("held_out"), "text"), "text", model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))


@query("op12_lexical_search", oracle_sql.RANKED)
def op12(spark, sf_dir):
    """The 50 highest-scoring documents of every benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
