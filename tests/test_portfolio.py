import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from optiontide.operators import bars as B
from optiontide.operators import portfolio as PF


@pytest.fixture(scope="module")
def returns(spark):
    rng = np.random.default_rng(9)
    start = dt.datetime(2024, 1, 1)
    rows = [
        (f"S{s:02d}", start + dt.timedelta(hours=h), float(rng.normal(0.001 * s, 0.02)))
        for s in range(13) for h in range(150) if rng.random() < (0.9 if s else 0.4)
    ]
    rows += [("LONE", start + dt.timedelta(days=400), 0.5), ("NONE", start, None)]
    return spark.createDataFrame(rows, "symbol string, ts timestamp, ret double"), pd.DataFrame(rows, columns=["symbol", "ts", "ret"])


@pytest.mark.parametrize("tiles", [1, 3, 16])
def test_covariance_is_pairwise_complete(spark, returns, tiles):
    df, local = returns
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")  # times straddle batches
    try:
        rows = PF.return_covariance(df, tiles=tiles).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    wide = local.dropna().pivot(index="ts", columns="symbol", values="ret")
    want = wide.cov()
    assert len({(r.symbol_a, r.symbol_b) for r in rows}) == len(rows)
    for r in rows:
        exact = want.loc[r.symbol_a, r.symbol_b]
        assert r.n == (wide[r.symbol_a].notna() & wide[r.symbol_b].notna()).sum()
        assert (r.cov is None and np.isnan(exact)) or np.isclose(r.cov, exact, rtol=1e-9, atol=1e-15)
    # every pair that ever met is there, both ways
    met = {(a, b) for a in wide for b in wide if (wide[a].notna() & wide[b].notna()).any()}
    assert {(r.symbol_a, r.symbol_b) for r in rows} == met


def test_covariance_of_many_symbols(spark, monkeypatch):
    monkeypatch.setattr(PF, "TILE_SYMBOLS", 100)
    rng = np.random.default_rng(8)
    x = rng.standard_normal((5, 700))
    rows = [(f"S{j:04d}", i, float(x[i, j])) for i in range(5) for j in range(700)]
    cov = PF.return_covariance(spark.createDataFrame(rows, "symbol string, ts int, ret double"), slice_rows=500)
    assert cov.count() == 700 * 700
    want = np.cov(x.T)
    for r in cov.filter("symbol_a in ('S0003', 'S0500') and n = 5").collect():
        assert np.isclose(r.cov, want[int(r.symbol_a[1:]), int(r.symbol_b[1:])])


def test_covariance_blocks_are_bounded():
    frames = [pd.DataFrame({"ta": 0, "tb": 1, "part": 0, "tile": [0] * 40 + [1] * 30, "ts": t, "symbol": [f"s{i}" for i in range(70)],
                            "x": np.arange(70.0)}) for t in range(3)]
    block = PF._Block(same=False)
    for frame in frames:
        block.add(frame, 0)
    assert len(block.rows()) == 40 * 30 and max(m.shape[0] * m.shape[1] for m in block.sums) <= 64 * 64
    (whole,) = list(PF._pair_sums(iter(frames)))
    assert set(whole["n"]) == {3}


def test_variance_and_weights(spark, returns):
    df, local = returns
    cov = PF.return_covariance(df.filter("symbol in ('S01', 'S02', 'S03')"))
    w = spark.createDataFrame([("S01", 0.5), ("S02", 0.3), ("S03", 0.2)], "symbol string, weight double")
    wide = local.pivot(index="ts", columns="symbol", values="ret")[["S01", "S02", "S03"]].cov()
    v = np.array([0.5, 0.3, 0.2])
    got = PF.portfolio_variance(w, cov).first().variance
    assert np.isclose(got, v @ wide.to_numpy() @ v) and got >= 0


@pytest.fixture(scope="module")
def book(spark):
    positions = spark.createDataFrame(
        [("A", 10, 4.0, "equity", True), ("B", 5, 8.0, "equity", False), ("C", 2, 3.0, "option", True), ("D", 1, 0.0, "option", True)],
        "symbol string, quantity int, purchase_price double, asset_type string, ownership_status boolean",
    )
    quotes = spark.createDataFrame([("A", 7.0), ("B", 6.0), ("C", 3.0), ("Z", 9.0)], "symbol string, lastPrice double")
    return positions, quotes


def test_market_value(book):
    rows = {r.symbol: r for r in PF.market_value(*book).collect()}
    assert set(rows) == {"A", "B", "C"}
    assert (rows["A"].total_market_value, rows["A"].total_loss_or_gain, rows["A"].total_loss_or_gain_pct) == (70.0, 30.0, 0.75)
    assert rows["C"].is_profitable and not rows["B"].is_profitable
    t = PF.market_value_totals(*book).first()
    assert (t.total_positions, t.number_of_profitable_positions, t.number_of_non_profitable_positions, t.number_of_breakeven_positions) == (4, 1, 1, 1)
    assert abs(sum(r.weight for r in PF.weights(*book).collect()) - 1) < 1e-12


def test_no_quotes(book, spark):
    empty = book[1].filter("false")
    t = PF.market_value_totals(book[0], empty).first()
    assert (t.total_market_value, t.total_positions) == (0.0, 4)
    assert PF.weights(book[0], empty).count() == 0


def test_position_changes(book, spark):
    positions = book[0]
    new = spark.createDataFrame(
        [("A", None, None, "equity", "2024-01-31"), ("E", 3, 1.0, "equity", None)],
        "symbol string, quantity int, purchase_price double, asset_type string, purchase_date string",
    )
    rows = {r.symbol: r for r in PF.upsert_positions(positions, new).collect()}
    assert (rows["A"].quantity, rows["A"].purchase_price, rows["A"].ownership_status) == (0, 0.0, True)
    assert rows["E"].ownership_status is False and rows["B"].quantity == 5 and len(rows) == 5
    kept, outcome = PF.remove_positions(positions, spark.createDataFrame([("A",), ("Q",)], "symbol string"))
    assert kept.count() == 3 and {(r.symbol, r.removed) for r in outcome.collect()} == {("A", True), ("Q", False)}
    flags = PF.in_portfolio(positions, spark.createDataFrame([("B",), ("Q",), ("A",)], "symbol string")).collect()
    assert {(r.symbol, r.in_portfolio, r.owned) for r in flags} == {("A", True, True), ("B", True, False), ("Q", False, False)}


def test_signals(spark):
    last = spark.createDataFrame([("A", 1.0, 2.0), ("B", 5.0, 3.0), ("C", None, 1.0)], "symbol string, x double, y double")
    rules = {"x": {"buy": 2.0, "buy_operator": "lt", "sell": 4.0, "sell_operator": "gt"},
             "x_comp_y": {"buy_operator": "lt", "sell_operator": None}}

    def got(**kw):
        return sorted((r.symbol, r.side, r.rule) for r in B.check_signals(last, rules, **kw).collect())

    assert got() == [("A", "buy", "x"), ("A", "buy", "x_comp_y"), ("B", "sell", "x")]
    assert got(combine="all") == [("A", "buy", "all"), ("B", "sell", "all")]
    assert got(combine="last") == [("A", "buy", "x_comp_y"), ("B", "sell", "x")]
    with pytest.raises(KeyError):
        B.check_signals(last, {"rsi": {"buy": 1, "buy_operator": "lt"}})
    trades = spark.createDataFrame([("A", "buy", 1), ("B", "sell", 2), ("C", "buy", 3)], "symbol string, side string, trade int")
    signals = B.check_signals(last, rules)
    both = PF.signals_to_orders(signals, trades)
    assert {(r.symbol, r.ownership_after) for r in both.collect()} == {("A", True), ("B", False)}
    assert [r.symbol for r in PF.signals_to_orders(signals, trades, exclusive_buys=True).collect()] == ["A"]
    sells = PF.signals_to_orders(signals.filter("side = 'sell'"), trades, exclusive_buys=True)
    assert [r.symbol for r in sells.collect()] == ["B"]
    held = spark.createDataFrame([("A", False), ("B", True)], "symbol string, ownership_status boolean")
    after = PF.apply_order_ownership(held, both).collect()
    assert {(r.symbol, r.ownership_status) for r in after} == {("A", True), ("B", False)}


def test_candles_and_upsert(spark):
    history = spark.sql("SELECT 'MSFT' AS symbol, array(named_struct('open', 165.67, 'close', 165.7, 'high', 166.67, 'low', 163.5,"
                        " 'volume', 48318234, 'datetime', 1586390396750)) AS candles")
    bar = B.flatten_candles(history)
    row = bar.first()
    assert row.ts == dt.datetime(2020, 4, 8, 23, 59, 56, 750000) and float(row.close) == 165.7
    changed = B.upsert_bars(bar, bar.withColumn("close", F.lit(1.0)))
    assert [float(r.close) for r in changed.collect()] == [1.0]
