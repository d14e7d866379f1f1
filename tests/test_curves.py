import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from optiontide.functions import rates as R
from optiontide.operators import curves as K


def pieces(spark, curves):
    rows = [(name, float(t), float(y)) for name, (ts, ys) in curves.items() for t, y in zip(ts, ys, strict=True)]
    found = K.spline_coefficients(spark.createDataFrame(rows, "ref_date string, t double, y double"))
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
    out = {}
    for r in found.orderBy("ref_date", "t0").collect():
        out.setdefault(r["ref_date"], []).append((r["c1"], r["c2"], r["c3"]))
    return {k: np.array(v).T for k, v in out.items()}


def test_spline_is_smooth_and_not_a_knot(spark):
    rng = np.random.default_rng(2)
    curves = {f"n{n}": (np.sort(rng.uniform(0, 30, n)), rng.uniform(0.01, 0.06, n)) for n in (4, 5, 9, 14)}
    t = np.array([0.0, 1.0, 2.5, 4.0])
    curves |= {"cubic": (t, t**3), "square": (t[:3], t[:3] ** 2), "line": (t[:2], t[:2]), "point": (t[:1], t[:1])}
    found = pieces(spark, curves)
    for name, (at, y) in curves.items():
        if not name.startswith("n"):
            continue
        c1, c2, c3 = (c[:-1] for c in found[name])
        h = np.diff(at)
        assert np.allclose(y[:-1] + h * (c1 + h * (c2 + h * c3)), y[1:])  # meets the next point
        assert np.allclose((c1 + 2 * c2 * h + 3 * c3 * h * h)[:-1], c1[1:]) and np.allclose((2 * c2 + 6 * c3 * h)[:-1], 2 * c2[1:], atol=1e-9)
        assert np.isclose(c3[0], c3[1]) and np.isclose(c3[-1], c3[-2])  # ends
    assert np.allclose(found["cubic"][0][:-1], 3 * t[:-1] ** 2) and np.allclose(found["cubic"][2][:-1], 1)
    assert np.allclose(found["square"][0][:-1], 2 * t[:2]) and np.allclose(found["square"][2], 0)
    assert np.allclose(found["line"][0], [1, 0]) and np.allclose(found["point"], 0)


@pytest.fixture(scope="module")
def points(spark):
    rows = [("a", 0.0, 0.01), ("a", 1.0, 0.02), ("a", 3.0, 0.05), ("a", 4.0, 0.03), ("a", 4.0, 0.03), ("b", 2.0, 0.07)]
    return spark.createDataFrame(rows, "ref_date string, t double, y double")


def rates(spark, points, fn):
    asked = [("a", -1.0), ("a", 0.0), ("a", 0.5), ("a", 1.0), ("a", 2.0), ("a", 4.0), ("a", 9.0), ("b", 0.0), ("b", 5.0), ("x", 1.0)]
    df = spark.createDataFrame(asked, "ref_date string, t double")
    return [r.rate for r in fn(points, df).orderBy("ref_date", "t").collect()]


def test_linear_and_flat_forward(spark, points):
    linear = rates(spark, points, K.interp_linear)
    assert np.allclose(linear[:-1], [0.01, 0.01, 0.015, 0.02, 0.035, 0.03, 0.03, 0.07, 0.07]) and linear[-1] is None
    flat = rates(spark, points, K.interp_flat_forward)
    assert np.allclose(flat[:-1], [0.01, 0.01, 0.01, 0.02, 0.02, 0.03, 0.03, 0.07, 0.07]) and flat[-1] is None


def test_cubic(spark, points):
    cubic = rates(spark, points, K.interp_cubic)
    assert np.allclose([cubic[i] for i in (0, 1, 3, 5, 6, 7, 8)], [0.01, 0.01, 0.02, 0.03, 0.03, 0.07, 0.07])
    # four points: the not-a-knot spline is the cubic through them
    p = np.polyfit([0, 1, 3, 4], [0.01, 0.02, 0.05, 0.03], 3)
    assert np.allclose([cubic[2], cubic[4]], np.polyval(p, [0.5, 2.0]))


def test_pick_curve(spark):
    days = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (1, 5, 6, 9, 12)] + [(None,)], "day date")
    curves = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (5, 9)], "ref_date date")

    def chosen(policy):
        rows = K.pick_curve(days, curves, "day", policy=policy).collect()
        return {r.day and r.day.day: r.curve_date and r.curve_date.day for r in rows}

    assert chosen("on_or_before") == {1: 5, 5: 5, 6: 5, 9: 9, 12: 9, None: None}
    assert chosen("strictly_before") == {1: 5, 5: 9, 6: 5, 9: 5, 12: 9, None: None}
    with pytest.raises(ValueError):
        K.pick_curve(days, curves, "day", policy="nearest")


def test_calibration(spark):
    truth = {"beta0": 0.045, "beta1": -0.02, "beta2": 0.03, "beta3": -0.015, "tau1": 1.3, "tau2": 6.0}
    maturities = [30, 60, 90, 180, 365, 730, 1095, 1825, 2555, 3650, 7300, 10950]
    base = spark.createDataFrame([(d, m / 365) for d in range(3) for m in maturities], "ref_date int, t double")
    sv = base.withColumn("y", R.svensson("t", truth) + F.col("ref_date") * 0.001)
    fitted = K.calibrate_curves(sv, "svensson")
    assert fitted.count() == 3 and max(r.sse for r in fitted.collect()) < 1e-10
    back = sv.join(fitted, "ref_date").select(F.abs(R.svensson("t", {k: F.col(k) for k in truth}) - F.col("y")).alias("e"))
    assert back.agg(F.max("e")).first()[0] < 1e-5
    ns_truth = {"beta0": 0.05, "beta1": -0.02, "beta2": 0.01, "tau": 2.0}
    ns = K.calibrate_curves(base.withColumn("y", R.nelson_siegel("t", ns_truth)), "nelson_siegel").first()
    assert ns.sse < 1e-12 and abs(ns.tau - 2.0) < 0.05


def test_maturity_labels(spark):
    df = spark.createDataFrame([("1 Mo",), ("6 mo",), ("30 YR",), (None,)], "label string")
    assert [r.d for r in df.select(R.maturity_days("label").alias("d")).collect()] == [30, 180, 10950, None]
    with pytest.raises(Exception, match="unrecognised maturity"):
        spark.createDataFrame([("3 Wk",)], "label string").select(R.maturity_days("label")).collect()


def test_discount_factors(spark):
    df = spark.createDataFrame([(0.05, 2.0), (0.0, 3.0), (0.05, 0.0)], "r double, t double")
    for model, want in (("svensson", [np.exp(-0.1), 1, 1]), ("flat_forward", [1 / 1.1, 1, 1])):
        assert np.allclose([x.d for x in df.select(R.discount_factor("r", "t", model).alias("d")).collect()], want)
    with pytest.raises(ValueError):
        R.discount_factor("r", "t", "other")
