"""A training corpus from raw documents, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all rows it is given, and returns
a DataFrame that is written as Parquet and read again as the next stage's input.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from optiontide.llm import lang_id
from optiontide.llm.common import bound_batches, word_count
from optiontide.llm.hyperminhash import one_of_each
from optiontide.llm.mixing import mix
from optiontide.llm.queries import language_model, token_digest
from optiontide.llm.secrets import redacted, secret_spans
from optiontide.session import run_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Texts without a letter, and those whose best language has a lower score, are rejected. Scores are combined from
#: windows of bounded size, the clear ones first, so neither length nor ids beside the prose lower them much.
LEAST_SCORE = 0.4


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is recognised; ``lang`` stays as it came, or is filled in where it was null."""
    bound_batches(spark)
    docs = docs.select(*COLUMNS)
    found = lang_id.predict(docs, "text", language_model(docs))
    kept = found.where((F.col("lang_pred") != lang_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose 5-word shingles are 80 % alike or more."""
    bound_batches(spark)
    return one_of_each(docs.select(*COLUMNS))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; secrets in the text give way to their kind in brackets, and ``n_chars`` follows."""
    found = docs.select(*COLUMNS).withColumn("__spans", secret_spans(F.col("text")))
    text = found.withColumn("text", redacted(F.col("text"), F.col("__spans")))
    changed = F.when(F.size("__spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return text.withColumn("n_chars", changed).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it."""
    docs = docs.select(*COLUMNS)
    mixed = mix(docs, "source", word_count(F.col("text")), ["doc_id"])
    times = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return mixed.where("copies > 0").select(*COLUMNS, times.alias("__copy")).select(*COLUMNS)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens of each copy, with digests of its ids and of the bytes they decode to."""
    bound_batches(spark)
    return token_digest(docs)


STAGES = [
    ("language ID", identify_language),
    ("MinHash near-dedup", drop_near_duplicates),
    ("secret scans", redact_secrets),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode_tokens),
]

#: SQL states neither the kernel classifier, nor the balancing iterations, nor the encoder; a test runs brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    path = run_dir(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{path}/{k}")
        docs = spark.read.parquet(f"{path}/{k}")
    return docs
