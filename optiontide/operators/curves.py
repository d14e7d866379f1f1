"""Yield curves: reshaping, as-of choice, interpolation and calibration."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from optiontide.functions.pricing import let
from optiontide.functions.rates import DAYS_PER_YEAR, maturity_days


def curve_points(wide: DataFrame, date: str = "Date", labels: Sequence[str] | None = None) -> DataFrame:
    """Long curve table from one column per maturity label with yields in percent.

    Dates may be text, month first or ISO. Null yields are left out.
    """
    labels = list(labels or [c for c in wide.columns if c != date])
    cells = [F.struct(F.lit(c).alias("label"), F.col(f"`{c}`").cast("double").alias("pct")) for c in labels]
    day = F.col(date)
    if isinstance(wide.schema[date].dataType, T.StringType):
        day = F.coalesce(F.try_to_date(day, "MM/dd/yyyy"), day.try_cast("date"))
    long = wide.select(day.cast("date").alias("ref_date"), F.inline(F.array(*cells))).filter("pct is not null")
    days = maturity_days("label")
    return long.select(
        "ref_date",
        "label",
        F.date_add("ref_date", days).alias("maturity_date"),
        (days / F.lit(DAYS_PER_YEAR)).alias("t"),
        (F.col("pct") / 100).alias("y"),
    )


def sorted_curve(points: DataFrame, by: Sequence[str] = ("ref_date",), t: str = "t", y: str = "y") -> DataFrame:
    """One row per curve with its points in order of maturity.

    Points are folded to one per maturity first, so the array is no longer
    than the number of maturities.
    """
    unique = points.groupBy(*by, F.col(t).alias("t")).agg(F.min(y).alias("y"))
    return unique.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("t", "y"))).alias("points"))


def pick_curve(queries: DataFrame, curves: DataFrame, day: str, ref_date: str = "ref_date",
               policy: str = "on_or_before", name: str = "curve_date", latest_without_day: bool = False) -> DataFrame:
    """As-of curve date: the nearest earlier one, else the nearest later one.

    A query without a day has none, or with ``latest_without_day`` the latest curve.

    ``policy`` is ``on_or_before``, where the same day wins, or
    ``strictly_before``, where the same day is passed over. The choice is made
    once per distinct day, then joined back by equality: no range join.
    """
    if policy not in ("on_or_before", "strictly_before"):
        raise ValueError(f"unknown policy {policy!r}")
    asked = queries.select(F.col(day).cast("date").alias("__d"), F.lit(None).cast("date").alias("__c")).distinct()
    known = curves.select(F.col(ref_date).cast("date").alias("__d"), F.col(ref_date).cast("date").alias("__c")).distinct()
    days = asked.unionByName(known).groupBy("__d").agg(F.max("__c").alias("__c"))
    w = W.orderBy("__d")  # one row per calendar day
    shift = 0 if policy == "on_or_before" else 1
    before = F.last("__c", ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, -shift))
    after = F.first("__c", ignorenulls=True).over(w.rowsBetween(shift, W.unboundedFollowing))
    choice = days.filter("__d is not null").select("__d", F.coalesce(before, after).alias("__choice"))
    joined = queries.join(choice, queries[day].cast("date") == F.col("__d"), "left")
    chosen = F.col("__choice")
    if latest_without_day:
        chosen = F.when(F.col("__undated"), known.agg(F.max("__c")).scalar()).otherwise(chosen)
    return joined.withColumn("__undated", queries[day].isNull()).withColumn(name, chosen).drop("__d", "__choice", "__undated")


def latest_curve(curves: DataFrame, ref_date: str = "ref_date", as_of: Column | str | None = None) -> DataFrame:
    """Rows of the newest curve, or of the newest one up to ``as_of``; the date is found by one aggregate and pushed to the scan."""
    day = F.col(ref_date).cast("date")
    known = curves if as_of is None else curves.filter(day <= (as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")))
    return curves.filter(day == known.agg(F.max(day)).scalar())


def _folded(points: DataFrame, by: Sequence[str], t: str, y: str) -> DataFrame:
    """One point per maturity: what meets a window or Python is never longer than a curve."""
    known = points.filter(F.col(t).isNotNull() & F.col(y).isNotNull())
    return known.groupBy(*by, F.col(t).alias("t0")).agg(F.min(y).alias("y0"))


def _segments(points: DataFrame, by: Sequence[str], t: str, y: str) -> DataFrame:
    """Half-open pieces between neighbouring points, the outer ones unbounded."""
    unique = _folded(points, by, t, y)
    w = W.partitionBy(*by).orderBy("t0")  # the distinct maturities of one curve
    return unique.select(
        *by, "t0", "y0",
        F.lead("t0").over(w).alias("t1"),
        F.lead("y0").over(w).alias("y1"),
        F.when(F.lag("t0").over(w).isNull(), F.lit(float("-inf"))).otherwise(F.col("t0")).alias("__from"),
        F.coalesce(F.lead("t0").over(w), F.lit(float("inf"))).alias("__to"),
    )


def _on_segment(queries: DataFrame, segments: DataFrame, by: Sequence[str], t: str, value: Column, name: str) -> DataFrame:
    # equality on the curve key, the segment bounds as a residual of the same join
    renamed = segments.withColumnsRenamed({k: f"__{k}" for k in by})
    condition = (F.col(t) >= F.col("__from")) & (F.col(t) < F.col("__to"))
    for k in by:
        condition = (queries[k] == renamed[f"__{k}"]) & condition
    joined = queries.join(renamed, condition, "left").withColumn(name, value)
    return joined.select(*queries.columns, name)


def _held(t: str) -> Column:
    """Distance into the segment, zero left of the first point."""
    return F.greatest(F.col(t), F.col("t0")) - F.col("t0")


def interp_linear(points: DataFrame, queries: DataFrame, by: Sequence[str] = ("ref_date",), t: str = "t",
                  y: str = "y", name: str = "rate") -> DataFrame:
    """Linear between points, flat outside."""
    slope = F.try_divide(F.col("y1") - F.col("y0"), F.col("t1") - F.col("t0"))
    value = F.col("y0") + F.coalesce(slope, F.lit(0.0)) * _held(t)
    return _on_segment(queries, _segments(points, by, t, y), by, t, value, name)


def interp_flat_forward(points: DataFrame, queries: DataFrame, by: Sequence[str] = ("ref_date",), t: str = "t",
                        y: str = "y", name: str = "rate") -> DataFrame:
    """Value of the last point at or before t, flat outside."""
    return _on_segment(queries, _segments(points, by, t, y), by, t, F.col("y0"), name)


def _spline_rows(x: Column) -> Column:
    """Rows (a, b, c, r) of the tridiagonal system for the slopes of the not-a-knot spline through four points or more."""
    h, d, n = x["h"], x["d"], F.size(x["p"])

    def row(i: Column) -> Column:
        h0, h1, d0, d1 = F.get(h, i - 1), F.get(h, i), F.get(d, i - 1), F.get(d, i)
        u, v, e, f = F.get(h, F.lit(0)), F.get(h, F.lit(1)), F.get(d, F.lit(0)), F.get(d, F.lit(1))
        first = F.struct(F.lit(0.0).alias("a"), v.alias("b"), (u + v).alias("c"), (((3 * u + 2 * v) * v * e + u * u * f) / (u + v)).alias("r"))
        v, u, f, e = F.get(h, n - 3), F.get(h, n - 2), F.get(d, n - 3), F.get(d, n - 2)
        last = F.struct((u + v).alias("a"), v.alias("b"), F.lit(0.0).alias("c"), ((u * u * f + (3 * u + 2 * v) * v * e) / (u + v)).alias("r"))
        inner = F.struct(h1.alias("a"), (2 * (h0 + h1)).alias("b"), h0.alias("c"), (3 * (h1 * d0 + h0 * d1)).alias("r"))
        return F.when(i == 0, first).when(i == n - 1, last).otherwise(inner)

    return F.transform(F.sequence(F.lit(0), n - 1), row)


def _spline_slopes(x: Column) -> Column:
    """First derivatives at the points: two folds over the points, forward to eliminate and backward to solve.

    Up to three points give a constant, a line or a parabola.
    """
    h, d, n = x["h"], x["d"], F.size(x["p"])
    kind = "array<struct<c:double,r:double>>"

    def eliminate(done: Column, row: Column) -> Column:
        before = F.get(done, F.size(done) - 1)
        pivot = F.when(F.size(done) == 0, row["b"]).otherwise(row["b"] - row["a"] * before["c"])
        right = F.when(F.size(done) == 0, row["r"]).otherwise(row["r"] - row["a"] * before["r"])
        return F.concat(done, F.array(F.struct((row["c"] / pivot).alias("c"), (right / pivot).alias("r"))))

    def solve(done: Column, row: Column) -> Column:
        slope = F.when(F.size(done) == 0, row["r"]).otherwise(row["r"] - row["c"] * F.get(done, F.lit(0)))
        return F.concat(F.array(slope), done)

    reduced = F.aggregate(_spline_rows(x), F.array().cast(kind), eliminate)
    slopes = F.aggregate(F.reverse(reduced), F.array().cast("array<double>"), solve)
    first, second = F.get(d, F.lit(0)), F.get(d, F.lit(1))
    bend = F.try_divide(second - first, F.get(h, F.lit(0)) + F.get(h, F.lit(1)))
    parabola = F.array(first - bend * F.get(h, F.lit(0)), first + bend * F.get(h, F.lit(0)), second + bend * F.get(h, F.lit(1)))
    return F.when(n == 1, F.array(F.lit(0.0))).when(n == 2, F.array(first, first)).when(n == 3, parabola).otherwise(slopes)


def spline_coefficients(points: DataFrame, by: Sequence[str] = ("ref_date",), t: str = "t", y: str = "y") -> DataFrame:
    """Cubic pieces per curve: y = y0 + c1 h + c2 h^2 + c3 h^3 from t0 on, in Columns.

    Points are folded first, so a curve's array is never longer than the number of its maturities.
    """
    unique = _folded(points, by, t, y)
    pair = F.struct(F.col("t0").cast("double").alias("t"), F.col("y0").cast("double").alias("y"))
    curves = unique.groupBy(*by).agg(F.sort_array(F.collect_list(pair)).alias("p"))

    def steps(p: Column) -> Column:
        nxt = lambda i: F.get(p, i + 1)
        h = F.transform(F.slice(p, 1, F.size(p) - 1), lambda a, i: nxt(i)["t"] - a["t"])
        d = F.transform(F.slice(p, 1, F.size(p) - 1), lambda a, i: (nxt(i)["y"] - a["y"]) / (nxt(i)["t"] - a["t"]))
        return F.struct(p.alias("p"), h.alias("h"), d.alias("d"))

    def pieces(x: Column, s: Column) -> Column:
        def piece(a: Column, i: Column) -> Column:
            h, d, s0, s1 = F.get(x["h"], i), F.get(x["d"], i), F.get(s, i), F.get(s, i + 1)
            zero, inner = F.lit(0.0), i < F.size(x["p"]) - 1
            return F.struct(
                a["t"].alias("t0"), a["y"].alias("y0"), F.when(inner, s0).otherwise(zero).alias("c1"),
                F.when(inner, (3 * d - 2 * s0 - s1) / h).otherwise(zero).alias("c2"),
                F.when(inner, (s0 + s1 - 2 * d) / (h * h)).otherwise(zero).alias("c3"),
                F.when(i == 0, F.lit(float("-inf"))).otherwise(a["t"]).alias("__from"),
                F.when(inner, F.get(x["p"], i + 1)["t"]).otherwise(F.lit(float("inf"))).alias("__to"))

        return F.transform(x["p"], piece)

    solved = let(let(F.col("p"), steps), lambda x: let(_spline_slopes(x), lambda s: pieces(x, s)))
    return curves.select(*by, F.inline(solved))


def interp_cubic(points: DataFrame, queries: DataFrame, by: Sequence[str] = ("ref_date",), t: str = "t",
                 y: str = "y", name: str = "rate") -> DataFrame:
    """Not-a-knot cubic spline, flat outside; no Python is planned."""
    h = _held(t)
    value = F.col("y0") + h * (F.col("c1") + h * (F.col("c2") + h * F.col("c3")))
    return _on_segment(queries, spline_coefficients(points, by, t, y), by, t, value, name)


# --------------------------------------------------------------------------- calibration

_TAUS = np.geomspace(0.05, 30.0, 28)
#: Years that a decay time may take; the search does not leave them.
TAU_RANGE = (0.02, 60.0)
#: Curves that are fitted together.
CURVES_AT_ONCE = 1024


def _design(t: np.ndarray, taus: np.ndarray) -> np.ndarray:
    """Loadings of the points (..., n) for decay times (..., 1 or 2): level, slope and a hump for each decay time."""
    x = t[..., None, :] / taus[..., :, None]
    level = np.where(x > 0, -np.expm1(-x) / np.where(x > 0, x, 1.0), 1.0)
    hump = level - np.exp(-x)
    columns = [np.ones_like(level[..., 0, :]), level[..., 0, :], *[hump[..., k, :] for k in range(taus.shape[-1])]]
    return np.stack(columns, axis=-1)


def _fitted(t: np.ndarray, y: np.ndarray, taus: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared errors and linear parameters of stacked curves (m, n), each for decay times of its own (m, k)."""
    design = _design(t, taus)
    betas = (np.linalg.pinv(design, rcond=1e-9) @ y[..., None])[..., 0]
    return (((design @ betas[..., None])[..., 0] - y) ** 2).sum(axis=-1), betas


def _fit_curves(t: np.ndarray, y: np.ndarray, two_humps: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least squares of stacked curves (m, n): a grid over the decay times, then ever finer steps around each curve's best.

    Curves that share their maturities share the grid's designs: each is decomposed once and projects all of them.
    """
    taus = np.array([(a, b) for a in _TAUS[::2] for b in _TAUS[::2]] if two_humps else [(a,) for a in _TAUS])
    best, where = np.full(len(y), np.inf), np.zeros(len(y), dtype=np.int64)
    for points in {row.tobytes(): row for row in t}.values():
        own = np.flatnonzero((t == points).all(axis=1))
        for k, pair in enumerate(taus):
            design = _design(points, pair)
            error = ((design @ (np.linalg.pinv(design, rcond=1e-9) @ y[own].T) - y[own].T) ** 2).sum(axis=0)
            better = error < best[own]
            best[own[better]], where[own[better]] = error[better], k
    at, step = taus[where].copy(), np.full(len(y), 0.3)
    best, betas = _fitted(t, y, at)
    while (open_ := np.flatnonzero(step > 1e-3)).size:
        moved = np.zeros(len(y), dtype=bool)
        for i in range(at.shape[1]):
            for sign in (1, -1):
                tried = at[open_].copy()
                tried[:, i] = np.clip(tried[:, i] * np.exp(sign * step[open_]), *TAU_RANGE)
                error, found = _fitted(t[open_], y[open_], tried)
                better = error < best[open_]
                own = open_[better]
                best[own], betas[own], at[own], moved[own] = error[better], found[better], tried[better], True
        step[open_[~moved[open_]]] /= 2
    return best, betas, at


def calibrate_curves(points: DataFrame, model: str = "svensson", by: Sequence[str] = ("ref_date",), t: str = "t",
                     y: str = "y") -> DataFrame:
    """Curve parameters and squared error per curve, by least squares on its points.

    For fixed decay times the other parameters are a linear fit, so only the
    decay times are searched, within ``TAU_RANGE``. A curve is one row; the curves of an Arrow batch are fitted together as stacked arrays.
    """
    if model not in ("svensson", "nelson_siegel"):
        raise ValueError(f"unknown curve model {model!r}")
    two = model == "svensson"
    unique = _folded(points, by, t, y)
    pair = F.struct(F.col("t0").cast("double").alias("t"), F.col("y0").cast("double").alias("y"))
    curves = unique.groupBy(*by).agg(F.sort_array(F.collect_list(pair)).alias("p"))
    curves = curves.select(*by, F.col("p.t").alias("__t"), F.col("p.y").alias("__y"))
    names = ["beta0", "beta1", "beta2", "beta3", "tau1", "tau2"] if two else ["beta0", "beta1", "beta2", "tau"]
    kinds = [curves.schema[k] for k in by] + [T.StructField(n, T.DoubleType()) for n in [*names, "sse"]] + [T.StructField("points", T.IntegerType())]

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, CURVES_AT_ONCE):
                batch = whole.slice(begin, CURVES_AT_ONCE)
                times, values = (batch.column(len(by) + i).to_pylist() for i in (0, 1))
                sizes = np.array([len(x) for x in times])
                out = np.full((batch.num_rows, len(names) + 1), np.nan)
                for n in np.unique(sizes):  # curves of as many points are stacked
                    own = np.flatnonzero(sizes == n)
                    error, betas, taus = _fit_curves(np.array([times[i] for i in own]), np.array([values[i] for i in own]), two)
                    out[own] = np.column_stack([betas, taus, error])
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i) for i in range(len(by))], *[pa.array(c) for c in out.T], pa.array(sizes.astype(np.int32))], [*by, *names, "sse", "points"])

    return curves.mapInArrow(fit, T.StructType(kinds))
