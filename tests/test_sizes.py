"""Steps whose cost per task must not grow with the table."""

import gzip
from pathlib import Path

from pyspark.sql import functions as F

from optiontide.operators import feeds as FD
from optiontide.plans import queries_records as QR
from optiontide.plans.enrich import _with_volatility
from optiontide.sources import chains as SC
from optiontide.streaming import job as J


def test_european_contracts_are_solved_in_arrays(spark):
    params = {"beta0": 0.04, "beta1": 0.0, "beta2": 0.0, "beta3": 0.0, "tau1": 1.0, "tau2": 2.0}
    rows = [("E", 12.0), ("A", 12.0), ("E", None)]
    timed = spark.createDataFrame(rows, "exerciseType string, mark double").selectExpr(
        "*", "5.0D AS intrinsicValue", "100.0D AS underlyingPrice", "95.0D AS strikePrice", "'CALL' AS putCall", "0.0D AS q", "false AS isIndex",
        "0.0D AS dividendAmount", "0.01D AS time_remaining", "0.5D AS T_eqo", "0.5D AS T_ind")
    solved = _with_volatility(timed, params, True, None, european_only=True)
    assert "_implied_vol_udf" in solved._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.exerciseType, r.mark, r.iv_mark is not None) for r in solved.filter("mark IS NOT NULL").collect()) == [("A", 12.0, False), ("E", 12.0, True)]


def test_feed_is_written_by_service_without_a_sort(spark, tmp_path):
    items = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, "LEVELONE_EQUITIES").otherwise("LEVELONE_OPTIONS").alias("service"), F.col("id").alias("timestamp"),
        F.create_map(F.lit("0"), F.col("id").cast("string")).alias("content")).coalesce(1)
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    FD.write_by_service(items, str(tmp_path / "feed"))
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    back = spark.read.parquet(str(tmp_path / "feed"))
    assert {r["service"]: r["n"] for r in back.groupBy("service").agg(F.count(F.lit(1)).alias("n")).collect()} == {"LEVELONE_EQUITIES": 334, "LEVELONE_OPTIONS": 666}


def test_a_batch_of_lines_takes_a_file_for_each_core(spark, monkeypatch, tmp_path):
    rows = spark.range(0, 900, 1, 3).selectExpr("id AS l_orderkey", "1.5D AS l_extendedprice", "1 AS l_linenumber")  # three files
    monkeypatch.setattr(QR.D, "table", lambda *_, **__: rows)
    assert spark.sparkContext.defaultParallelism >= 2
    sizes = []
    QR.J.run_stream(QR._line_stream(spark, ""), lambda batch, epoch: sizes.append(batch.count()), str(tmp_path / "cp"), trigger=None).awaitTermination()
    cores = spark.sparkContext.defaultParallelism
    assert sizes == ([900] if cores >= 3 else [600, 300])


def test_messages_are_compressed_together(spark, tmp_path):
    """Landed and stored messages keep the whole text in gzip frames, at less than half of what a deflated frame each would take."""
    chains = spark.range(0, 4000, 1, 1).select(
        F.concat(F.lit("P"), F.col("id") % 50).alias("symbol"), F.lit("SUCCESS").alias("status"), (F.col("id") / 4).alias("underlyingPrice"),
        F.create_map(F.lit("2024-01-05:3"), F.array(F.struct(F.lit("PUT").alias("putCall"), (F.col("id") % 97).alias("mark"), F.lit(0.5).alias("timeValue")))).alias("putExpDateMap"))
    landed, stored = str(tmp_path / "landed"), str(tmp_path / "stored")
    SC.publish_chains(chains, landed)
    stream = SC.read_chain_stream(spark, "parquet", landed, 10)
    J.run_stream(stream, J.epoch_sink(stored, codec=SC.MESSAGE_CODEC), str(tmp_path / "cp"), trigger=None).awaitTermination()
    texts = sorted(r.text.encode() for r in chains.select(F.to_json(F.struct("*")).alias("text")).collect())
    alone = sum(len(gzip.compress(t)) for t in texts)
    for folder in (landed, stored):
        assert sorted(gzip.decompress(r["value"]) for r in spark.read.parquet(folder).collect()) == texts
        assert sum(f.stat().st_size for f in Path(folder).rglob("*.parquet")) < alone / 2
