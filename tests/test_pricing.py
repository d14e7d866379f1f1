import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from optiontide.functions import pricing as P


def plain_tree(spot, strike, t, rate, q, sigma, call, steps=100):
    """Textbook recursion on lists, as an independent check."""
    dt = t / steps
    up = math.exp(sigma * math.sqrt(dt))
    p = (math.exp((rate - q) * dt) - 1 / up) / (up - 1 / up)
    discount, sign = math.exp(-rate * dt), 1 if call else -1

    def exercise(level, j):
        return max(0.0, sign * (spot * up ** (2 * j - level) - strike))

    values = [exercise(steps, j) for j in range(steps + 1)]
    for level in range(steps - 1, -1, -1):
        values = [
            max(discount * (p * values[j + 1] + (1 - p) * values[j]), exercise(level, j)) for j in range(level + 1)
        ]
    return values[0]


def sample(n=300, seed=3):
    rng = np.random.default_rng(seed)
    spot = rng.uniform(50, 150, n)
    return dict(
        spot=spot, strike=spot * rng.uniform(0.7, 1.3, n), t=rng.uniform(0.02, 2.5, n), rate=rng.uniform(0, 0.08, n),
        q=rng.choice([0.0, 0.01, 0.03], n), is_call=rng.random(n) < 0.5,
    ), rng.uniform(0.05, 2.0, n)


def test_cdf_matches_erfc():
    x = np.linspace(-40, 40, 4001)
    exact = np.array([0.5 * math.erfc(-v / math.sqrt(2)) for v in x])
    assert np.max(np.abs(P._cdf(x) - exact)) < 1e-15


def test_tree_matches_recursion():
    s, vol = sample(600)
    got = P.american_prices(s["spot"], s["strike"], s["t"], s["rate"], s["q"], vol, s["is_call"])
    want = [
        plain_tree(*row, vol[i], bool(s["is_call"][i]))
        for i, row in enumerate(zip(s["spot"], s["strike"], s["t"], s["rate"], s["q"]))
    ]
    assert np.allclose(got, want, atol=1e-9)


def test_tree_bounds():
    s, vol = sample()
    price = P.american_prices(s["spot"], s["strike"], s["t"], s["rate"], s["q"], vol, s["is_call"])
    sign = np.where(s["is_call"], 1, -1)
    assert np.all(price >= np.maximum(sign * (s["spot"] - s["strike"]), 0) - 1e-9)
    zero = np.zeros(len(vol))
    calls = np.ones(len(vol), dtype=bool)
    fine = P.american_prices(s["spot"], s["strike"], s["t"], s["rate"], zero, vol, calls, steps=400)
    exact, _ = P.european_prices(s["spot"], s["strike"], s["t"], s["rate"], vol, calls)
    assert np.max(np.abs(fine - exact) / s["spot"]) < 2e-3  # no dividend: an American call is a European one


def test_european_round_trip_and_parity():
    s, vol = sample()
    args = (s["spot"], s["strike"], s["t"], s["rate"])
    price, vega = P.european_prices(*args, vol, s["is_call"])
    iv = P.european_vols(price, *args, s["is_call"])
    clear = vega > 1e-3
    assert np.max(np.abs(iv - vol)[clear]) < 1e-8
    call, _ = P.european_prices(*args, vol, True)
    put, _ = P.european_prices(*args, vol, False)
    assert np.allclose(call - put, s["spot"] - s["strike"] * np.exp(-s["rate"] * s["t"]), atol=1e-9)


def test_american_round_trip():
    s, vol = sample()
    args = (s["spot"], s["strike"], s["t"], s["rate"], s["q"])
    price = P.american_prices(*args, vol, s["is_call"])
    iv = P.american_vols(price, *args, s["is_call"])
    ok = np.isfinite(iv)
    assert ok.mean() > 0.95
    assert np.allclose(P.american_prices(*(a[ok] for a in args), iv[ok], s["is_call"][ok]), price[ok], atol=1e-4)


def test_prices_grow_with_volatility():
    s, _ = sample(50)
    vols = np.linspace(0.05, 3, 30)
    for fn in (
        lambda v: P.european_prices(s["spot"], s["strike"], s["t"], s["rate"], np.full(50, v), s["is_call"])[0],
        lambda v: P.american_prices(s["spot"], s["strike"], s["t"], s["rate"], s["q"], np.full(50, v), s["is_call"]),
    ):
        assert np.all(np.diff([fn(v) for v in vols], axis=0) >= -1e-6)


@pytest.fixture(scope="module")
def frame(spark):
    s, vol = sample(200)
    rows = [
        (i, float(s["spot"][i]), float(s["strike"][i]), float(s["t"][i]), float(s["rate"][i]), float(s["q"][i]),
         float(vol[i]), "CALL" if s["is_call"][i] else "PUT")
        for i in range(200)
    ]
    return spark.createDataFrame(rows, "id int, S double, K double, t double, r double, q double, sigma double, putCall string")


def test_column_price_matches_numpy(frame):
    column = P.bs_price("S", "K", "t", "r", "sigma", "putCall")
    both = P.with_bs_price(frame.withColumn("a", column), "S", "K", "t", "r", "sigma", "putCall", "b").toPandas()
    want, _ = P.european_prices(both.S, both.K, both.t, both.r, both.sigma, both.putCall == "CALL")
    assert np.allclose(both.a, want, atol=1e-10) and np.allclose(both.b, want, atol=1e-10)


def test_dividend_yield_only_when_asked(frame):
    plain = P.bs_price("S", "K", "t", "r", "sigma", "putCall")
    with_q = P.bs_price("S", "K", "t", "r", "sigma", "putCall", "q", use_q=True)
    out = frame.select("q", plain.alias("a"), with_q.alias("b")).toPandas()
    assert np.allclose(out.a[out.q == 0], out.b[out.q == 0])
    assert np.all(np.abs(out.a - out.b)[out.q > 0] > 0)


def test_edges(spark):
    rows = [
        (1, 100.0, 90.0, 0.0, "CALL"), (2, 100.0, 90.0, -0.5, "CALL"), (3, None, 90.0, 0.5, "PUT"), (4, 100.0, 100.0, 0.0, "PUT"),
    ]
    df = spark.createDataFrame(rows, "id int, S double, K double, t double, putCall string")
    out = df.select(
        "id", P.bs_price("S", "K", "t", F.lit(0.05), F.lit(0.2), "putCall").alias("bs"),
        P.implied_vol(F.lit(12.0), "S", "K", "t", F.lit(0.05), F.lit(0.0), "putCall", F.lit("E")).alias("iv"),
    ).collect()
    assert [r.bs for r in out] == [10.0, None, None, 0.0]
    assert all(r.iv is None for r in out)


def test_implied_vol_routing(spark):
    df = spark.createDataFrame(
        [("E", 10.0), ("A", 10.0), ("", 10.0), (None, 10.0), ("E", None), ("E", 500.0)], "kind string, mark double"
    )
    iv = P.implied_vol("mark", F.lit(100.0), F.lit(100.0), F.lit(0.5), F.lit(0.05), F.lit(0.01), F.lit("CALL"), "kind")
    out = [r.iv for r in df.select(iv.alias("iv")).collect()]
    assert abs(P.european_prices(100.0, 100.0, 0.5, 0.05, np.array([out[0]]), True)[0][0] - 10) < 1e-9
    assert out[1] == out[2] == out[3] and abs(out[1] - out[0]) > 1e-4
    assert abs(plain_tree(100, 100, 0.5, 0.05, 0.01, out[1], True) - 10) < 1e-5
    assert out[4] is None and out[5] is None  # no mark; no sign change


def test_crr_column(frame):
    out = frame.withColumn("p", P.crr_price("S", "K", "t", "r", "q", "sigma", "putCall", steps=60)).toPandas()
    want = P.american_prices(out.S, out.K, out.t, out.r, out.q, out.sigma, out.putCall == "CALL", 60)
    assert np.allclose(out.p, want)


def test_european_root_in_columns(spark):
    """The fold against the array solver, over wide ranges; no Python in the plan."""
    rng = np.random.default_rng(8)
    n = 3000
    rows = [(float(a), float(b), float(t), float(r), float(v), bool(c), float(e)) for a, b, t, r, v, c, e in zip(
        rng.uniform(1, 500, n), rng.uniform(1, 500, n), np.exp(rng.uniform(-7, 1.5, n)), rng.uniform(-0.02, 0.1, n), np.exp(rng.uniform(-5, 2.5, n)),
        rng.integers(0, 2, n), rng.normal(0, 1e-3, n), strict=True)]
    df = spark.createDataFrame(rows, "S double, K double, t double, r double, vol double, call boolean, noise double").withColumn(
        "putCall", F.when(F.col("call"), "CALL").otherwise("PUT"))
    frame = df.toPandas()
    frame["mark"] = P.european_prices(frame.S.values, frame.K.values, frame.t.values, frame.r.values, frame.vol.values, frame.call.values)[0] + frame.noise
    priced = spark.createDataFrame(frame)
    found = priced.withColumn("iv", P.european_vol("mark", "S", "K", "t", "r", "putCall"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    out = found.toPandas()
    want = P.european_vols(out.mark.values, out.S.values, out.K.values, out.t.values, out.r.values, out.call.values)
    assert (np.isfinite(want) == out.iv.notna().values).all()
    both = np.isfinite(want)
    price = lambda v: P.european_prices(out.S.values, out.K.values, out.t.values, out.r.values, v, out.call.values)[0][both]
    close = np.abs(out.iv.values[both] - want[both]) < 1e-7
    same_price = np.abs(price(out.iv.values) - out.mark.values[both]) < 1e-9 * out.S.values[both] + 1e-9  # where the price is flat, any volatility fits
    assert (close | same_price).all() and close.mean() > 0.9


@pytest.mark.parametrize("steps", [1, 2, 7, 8, 100, 237])
def test_known_nodes_are_not_walked(steps, monkeypatch):
    """Options with proper probabilities leave out nodes whose value is known; the price is that of the whole walk."""
    rng = np.random.default_rng(steps)
    n = 3000
    spot = np.exp(rng.uniform(-2, 7, n))
    strike = spot * np.exp(rng.normal(0, 0.5, n))
    t, vol = np.exp(rng.uniform(-8, 2, n)), np.exp(rng.uniform(-5, 2.4, n))
    rate, q = rng.choice([0, -0.02, 0.01, 0.05, 0.12], n), rng.choice([0, 0, 0.001, 0.01, 0.05, 0.2], n)
    is_call = rng.random(n) < 0.5
    strike[:50] = spot[:50]
    strike[50:60], strike[60:70] = spot[50:60] * 1e6, spot[60:70] / 1e6
    t[70:75], vol[75:80], spot[80:85], q[85:120] = 0, 0, np.nan, -0.01  # no tree, or one where the order of exercised nodes is not certain
    whole, walked = P._tree_block, []

    def counted(*args):
        walked.append(len(args[0]))
        return whole(*args)

    monkeypatch.setattr(P, "_tree_block", counted)
    got = P.american_prices(spot, strike, t, rate, q, vol, is_call, steps)
    with np.errstate(all="ignore"):
        want = whole(spot, strike, t, rate, q, vol, is_call, steps)
        up = np.exp(vol * np.sqrt(t / steps))
        p = (np.exp((rate - q) * t / steps) - 1 / up) / (up - 1 / up)
    assert (np.isfinite(got) == np.isfinite(want)).all()
    fine = np.isfinite(want) & (p > 0) & (p < 1)
    assert np.max(np.abs(got - want)[fine] / np.maximum(want, spot)[fine]) < 1e-11
    assert sum(walked) < n / 4 and fine.sum() > n * 0.8
