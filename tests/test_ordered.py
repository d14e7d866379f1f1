"""Split ordered operators against plain pandas, with one hot key, ties, nulls and tiny buckets."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from optiontide.operators import bars as B
from optiontide.operators import ordered
from optiontide.operators import universe as U
from optiontide.operators.ordered import time_bucket, trailing_count, with_ordinal, with_previous


@pytest.fixture(scope="module")
def ticks(spark):
    rng = np.random.default_rng(5)
    n = 3000
    keys = np.where(rng.random(n) < 0.4, "HOT", np.array([f"S{i}" for i in range(12)])[rng.integers(0, 12, n)])
    start = dt.datetime(2024, 1, 1)
    rows = [
        (i, None if i % 97 == 0 else str(keys[i]), start + dt.timedelta(seconds=int(rng.integers(0, 40000))),
         None if i % 53 == 0 else float(np.round(rng.uniform(1, 99), 2)))
        for i in range(n)
    ]
    df = spark.createDataFrame(rows, "id int, symbol string, ts timestamp, close double")
    local = pd.DataFrame(rows, columns=["id", "symbol", "ts", "close"]).sort_values(["symbol", "ts", "id"])
    local["symbol"] = local["symbol"].fillna("<null>")
    return df.repartition(7).cache(), local


def by_id(df, column):
    out = df.select("id", column).toPandas().set_index("id")[column].sort_index()
    return out


def same(got, want):
    got, want = got.astype(float), want.sort_index().astype(float)
    assert len(got) == len(want)
    assert np.allclose(got.to_numpy(), want.to_numpy(), equal_nan=True, atol=1e-9)


def test_ordinal(ticks):
    df, local = ticks
    got = by_id(with_ordinal(df, ["symbol"], ["ts", "id"], time_bucket("ts", 600)), "ordinal")
    local = local.assign(want=local.groupby("symbol").cumcount() + 1).set_index("id")
    same(got, local["want"])


def test_previous(ticks):
    df, local = ticks
    got = by_id(with_previous(df, ["symbol"], ["ts", "id"], "close", time_bucket("ts", 60), "prev"), "prev")
    same(got, local.assign(want=local.groupby("symbol")["close"].shift()).set_index("id")["want"])


@pytest.mark.parametrize("fn", ["mean", "sum", "min", "max", "std", "var", "median", "count"])
def test_rolling(ticks, fn):
    df, local = ticks
    out = B.rolling(df, "close", 7, fn, tie=["id"], name="x", bucket_seconds=900, block_rows=11)
    assert out.count() == len(local)
    rolled = local.groupby("symbol")["close"].rolling(7, min_periods=7)
    want = getattr(rolled, fn)().reset_index(level=0, drop=True)
    same(by_id(out, "x"), pd.Series(want.to_numpy(), index=local.loc[want.index, "id"]))


def test_window_wider_than_block(ticks):
    df, local = ticks
    out = B.rolling(df, "close", 40, "sum", tie=["id"], name="x", block_rows=5)
    want = local.groupby("symbol")["close"].rolling(40, min_periods=40).sum().reset_index(level=0, drop=True)
    same(by_id(out, "x"), pd.Series(want.to_numpy(), index=local.loc[want.index, "id"]))


def test_trailing_count(ticks):
    df, local = ticks
    got = by_id(trailing_count(df, ["symbol"], "ts", 90, "rate", bucket_seconds=120), "rate")
    want = {}
    for _, group in local.groupby("symbol"):
        times = group["ts"].to_numpy()
        for i, t in zip(group["id"], times):
            want[i] = int(((times >= t - np.timedelta64(90, "s")) & (times <= t)).sum())
    same(got, pd.Series(want))


def test_returns_after_zero_are_null(spark):
    rows = [("A", dt.datetime(2024, 1, d), v) for d, v in ((1, 2.0), (2, 0.0), (3, 5.0), (9, 10.0))]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp, close double")
    out = B.daily_returns(df).orderBy("ts").collect()
    assert [r.ret for r in out] == [None, -1.0, None, 1.0]


def test_ranking_keeps_a_bounded_number_of_rows_per_task(ticks):
    df, _ = ticks
    for frame in (B.last_rows(df, tie=["id"]), B.bar_ago(df, 3, tie=["id"])):
        assert "WindowGroupLimit" in frame._jdf.queryExecution().toString()


@pytest.fixture(params=[4096, 16])
def cuts(request, monkeypatch):
    monkeypatch.setattr(ordered, "CUTS", request.param)
    return request.param


def test_sampled_cuts_give_the_plain_windows(ticks, cuts):
    df, local = ticks
    got = by_id(with_ordinal(df, ["symbol"], ["ts", "id"]), "ordinal")
    same(got, pd.Series(local.groupby("symbol").cumcount().to_numpy() + 1, index=local["id"]))
    got = by_id(with_ordinal(df, [], ["ts", "id"]), "ordinal")
    everyone = local.sort_values(["ts", "id"])
    same(got, pd.Series(np.arange(1, len(local) + 1), index=everyone["id"]))
    out = B.rolling(df, "close", 5, "mean", tie=["id"], name="x", block_rows=11)
    want = local.groupby("symbol")["close"].rolling(5, min_periods=5).mean()
    full = local.groupby("symbol")["close"].apply(lambda v: v.rolling(5, min_periods=1).count())
    assert by_id(out, "x").notna().sum() == (full.to_numpy() >= 5).sum() and want.notna().sum() <= len(local)
    rate = by_id(trailing_count(df, ["symbol"], "ts", 90, "rate"), "rate")
    brute = {}
    for _, own in local.groupby("symbol"):
        at = own["ts"].astype("datetime64[us]").astype("int64").to_numpy()
        brute.update(zip(own["id"], [((at >= t - 90_000_000) & (at <= t)).sum() for t in at], strict=True))
    same(rate, pd.Series(brute))


def test_cuts_follow_the_rows(spark):
    """A third of the rows has one key and one second, in names with one long prefix; no range holds much more than its share."""
    n = 30_000
    df = spark.range(n).selectExpr(
        "CASE WHEN id % 3 = 0 THEN concat(repeat('x', 40), 'hot') ELSE concat(repeat('x', 40), cast(id % 5000 AS string)) END AS symbol",
        "timestamp_micros(CASE WHEN id % 3 = 0 THEN 1700000000000000 + id ELSE 1600000000000000 + id * 7919 END) AS ts", "id")
    sizes = [r["count"] for r in ordered.with_order_bucket(df, ["symbol"], ["ts", "id"], "b", 64).groupBy("b").count().collect()]
    assert sum(sizes) == n and len(sizes) > 40 and max(sizes) < n / 64 * 12
    hot = df.filter("id % 3 = 0")
    assert ordered.with_order_bucket(hot, ["symbol"], ["ts", "id"], "b", 64, df).select("b").distinct().count() > 12


def test_no_row_carries_the_cuts(ticks):
    df, _ = ticks
    for frame in (with_ordinal(df, ["symbol"], ["ts", "id"]), B.daily_returns(df, tie=["id"])):
        assert "AS __cuts" not in frame._jdf.queryExecution().optimizedPlan().toString()


def test_plans_are_built_without_jobs(spark, sf_dir):
    bars = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("user_id AS symbol", "cast(ts AS timestamp) AS ts", "value AS close", "event_id AS id", "user_id AS client")
    sc = spark.sparkContext
    sc.setJobGroup("lazy-plans", "building")
    try:
        frames = [B.daily_returns(bars, tie=["id"]), B.rolling(bars, "close", 5, "mean", tie=["id"]), trailing_count(bars, ["client"], "ts", 60, "rate"),
                  with_ordinal(bars, [], ["ts", "id"]), U.chunk_symbols(bars.selectExpr("cast(symbol AS string) AS symbol"), 7)]
        assert not sc.statusTracker().getJobIdsForGroup("lazy-plans")
        for frame in frames:
            frame.write.format("noop").mode("overwrite").save()
        assert sc.statusTracker().getJobIdsForGroup("lazy-plans")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_chunks_of_symbols_with_one_prefix(spark):
    names = [f"PREFIX{i:05d}" for i in range(5000)]
    out = U.chunk_symbols(spark.createDataFrame([(n,) for n in names * 2], "symbol string"), 9)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    rows = {r["symbol"]: (r["position"], r["chunk"]) for r in out.collect()}
    assert rows == {n: (i + 1, i // 556 + 1) for i, n in enumerate(names)}
