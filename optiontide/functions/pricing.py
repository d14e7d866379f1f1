"""Option prices and implied volatility.

``bs_price`` is a plain Column, so a price stays inside whole-stage codegen; the European root is a fold in Columns.
The binomial tree needs loops that a Column cannot express; it and its root finder
run as numpy over whole Arrow batches, never row by row.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

# Coefficients of the published double-precision normal
# distribution function (Hart 1968, as given by West 2005), high order first.
CDF_NUMERATOR = (
    3.52624965998911e-02,
    0.700383064443688,
    6.37396220353165,
    33.912866078383,
    112.079291497871,
    221.213596169931,
    220.206867912376,
)
CDF_DENOMINATOR = (
    8.83883476483184e-02,
    1.75566716318264,
    16.064177579207,
    86.7807322029461,
    296.564248779674,
    637.333633378831,
    793.826512519948,
    440.413735824752,
)
CDF_SPLIT = 7.07106781186547
CDF_ROOT_TWO_PI = 2.506628274631

# Fixed values of the solver: volatility interval, tolerance, tree steps.
VOL_LOW = 0.01
VOL_HIGH = 10.0
VOL_TOLERANCE = 1e-6
SETTLED = 1e-12
ROOT_STEPS = 100
TREE_STEPS = 100

_TREE_ROWS = 400  # rows priced together: keeps the working set in cache
_BAND_ROWS = 512
_BAND_LEAST = 128  # fewer rows than these are walked whole, in fewer steps of numpy
_BAND_LEVELS = 4  # levels walked between two looks at the exercise boundary
_BAND_RANGE = 600.0  # largest exponent of the scaled values, below the 709 of a double


def _col(value: Column | str | float) -> Column:
    if isinstance(value, Column):
        return value
    return F.col(value) if isinstance(value, str) else F.lit(float(value))


# --------------------------------------------------------------------------- Columns


def _horner(x: Column, coefficients: tuple[float, ...]) -> Column:
    out = F.lit(coefficients[0])
    for c in coefficients[1:]:
        out = out * x + F.lit(c)
    return out


def _tail_weight(a: Column, e: Column) -> Column:
    """1 - N(a) for a >= 0, given e = exp(-a*a/2)."""
    core = e * _horner(a, CDF_NUMERATOR) / _horner(a, CDF_DENOMINATOR)
    tail = e / (a + 1 / (a + 2 / (a + 3 / (a + 4 / (a + 0.65))))) / F.lit(CDF_ROOT_TWO_PI)
    return F.when(a < CDF_SPLIT, core).when(a <= 37, tail).otherwise(F.when(a > 37, F.lit(0.0)))


def norm_cdf(x: Column) -> Column:
    """Standard normal distribution function, accurate to double precision."""
    a = F.abs(x)
    lower = _tail_weight(a, F.exp(-a * a / 2))
    return F.when(x > 0, 1 - lower).otherwise(lower)


def bs_price(
    spot: Column | str,
    strike: Column | str,
    t: Column | str,
    rate: Column | str,
    sigma: Column | str | float,
    put_call: Column | str,
    q: Column | str | float | None = None,
    use_q: bool = False,
) -> Column:
    """European price; a first letter C is a call, anything else a put.

    The dividend yield is taken but left out unless ``use_q`` is set. At
    t = 0 the price is the exercise value, for t < 0 it is null.
    """
    spot, strike, t, rate, sigma = (_col(c) for c in (spot, strike, t, rate, sigma))
    if use_q:
        if q is None:
            raise ValueError("use_q needs q")
        spot = spot * F.exp(-_col(q) * t)
    sign = _sign(_col(put_call))
    d1, d2 = _d1_d2(spot, strike, t, rate, sigma, sign)
    return _bs_value(spot, strike, t, rate, sign, norm_cdf(d1), norm_cdf(d2))


def _sign(put_call: Column) -> Column:
    return F.when(put_call.startswith("C"), F.lit(1.0)).otherwise(F.lit(-1.0))


def _d1_d2(spot: Column, strike: Column, t: Column, rate: Column, sigma: Column, sign: Column) -> tuple[Column, Column]:
    width = sigma * F.sqrt(t)
    d1 = F.try_divide(F.ln(F.try_divide(spot, strike)) + (rate + sigma * sigma / 2) * t, width)
    return sign * d1, sign * (d1 - width)


def _bs_value(spot: Column, strike: Column, t: Column, rate: Column, sign: Column, n1: Column, n2: Column) -> Column:
    price = sign * (spot * n1 - strike * F.exp(-rate * t) * n2)
    return F.when(t == 0, F.greatest(sign * (spot - strike), F.lit(0.0))).when(t > 0, price)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _fixed_terms(mark: Column, spot: Column, strike: Column, t: Column, rate: Column, sign: Column) -> Column:
    """What a European price needs beside the volatility."""
    return F.struct(
        mark.alias("mark"), spot.alias("spot"), sign.alias("sign"), (strike * F.exp(-rate * t)).alias("discounted"),
        (F.ln(spot / strike) + rate * t).alias("drift"), t.alias("t"), F.sqrt(t).alias("root_t"))


def _gap_and_vega(c: Column, vol: Column) -> Column:
    """Price less mark, and the slope of the price, at a volatility."""
    def weights(d: Column) -> Column:
        return let(F.struct(d.alias("d"), F.abs(d).alias("a"), F.exp(-d * d / 2).alias("e")), lambda w: F.struct(
            w["e"].alias("e"), let(_tail_weight(w["a"], w["e"]), lambda low: F.when(w["d"] > 0, 1 - low).otherwise(low)).alias("n")))

    d1 = c["drift"] / (vol * c["root_t"]) + vol * c["root_t"] / 2

    def valued(d: Column) -> Column:
        ahead, behind = weights(c["sign"] * d), weights(c["sign"] * (d - vol * c["root_t"]))
        return let(F.struct(ahead.alias("one"), behind["n"].alias("two")), lambda w: F.struct(
            (c["sign"] * (c["spot"] * w["one"]["n"] - c["discounted"] * w["two"]) - c["mark"]).alias("gap"),
            (c["spot"] * w["one"]["e"] * c["root_t"] / F.lit(CDF_ROOT_TWO_PI)).alias("vega")))

    return let(d1, valued)


def european_vol(
    mark: Column | str, spot: Column | str, strike: Column | str, t: Column | str, rate: Column | str | float, put_call: Column | str,
) -> Column:
    """Volatility at which the Black-Scholes price meets ``mark``; null without a sign change on the interval.

    A fold over a fixed number of steps: Newton steps kept inside a shrinking bracket, the middle of the bracket where one leaves it. Steps after a
    row has settled pass its state on, so a row costs as many prices as it needs. No Python is involved.
    """
    mark, spot, strike, t, rate = (_col(c).cast("double") for c in (mark, spot, strike, t, rate))

    def solved(c: Column) -> Column:
        guess = F.sqrt(2 * F.abs(c["drift"]) / c["t"])
        first = F.greatest(F.least(F.when(guess > VOL_LOW, guess).otherwise(F.lit(0.5)), F.lit(5.0)), F.lit(0.05))
        start = F.struct(first.alias("x"), F.lit(VOL_LOW).alias("lo"), F.lit(VOL_HIGH).alias("hi"), F.lit(False).alias("done"))

        def moved(state: Column, g: Column) -> Column:
            below = g["gap"] < 0
            bracket = F.struct(
                F.when(below, state["x"]).otherwise(state["lo"]).alias("lo"), F.when(below, state["hi"]).otherwise(state["x"]).alias("hi"),
                (state["x"] - F.try_divide(g["gap"], g["vega"])).alias("newton"))

            def next_(b: Column) -> Column:
                inside = (b["newton"] > b["lo"]) & (b["newton"] < b["hi"])
                new = F.when(g["gap"] == 0, state["x"]).when(inside, b["newton"]).otherwise((b["lo"] + b["hi"]) / 2)
                return let(new, lambda x: F.struct(
                    x.alias("x"), b["lo"].alias("lo"), b["hi"].alias("hi"),
                    ((F.abs(x - state["x"]) < SETTLED) | (b["hi"] - b["lo"] < SETTLED)).alias("done")))

            return let(bracket, next_)

        def step(state: Column, _: Column) -> Column:
            return F.when(state["done"], state).otherwise(let(_gap_and_vega(c, state["x"]), lambda g: moved(state, g)))

        root = F.aggregate(F.sequence(F.lit(1), F.lit(ROOT_STEPS)), start, step, lambda s: F.when(s["done"], s["x"]))
        changes = _gap_and_vega(c, F.lit(VOL_LOW))["gap"] * _gap_and_vega(c, F.lit(VOL_HIGH))["gap"] <= 0
        return F.when(changes, root)

    usable = mark.isNotNull() & rate.isNotNull() & (spot > 0) & (strike > 0) & (t > 0) & ~F.isnan(mark) & ~F.isnan(rate)
    return F.when(usable, let(_fixed_terms(mark, spot, strike, t, rate, _sign(_col(put_call))), solved))


def with_bs_price(
    df: DataFrame,
    spot: str = "underlyingPrice",
    strike: str = "strikePrice",
    t: str = "t",
    rate: str = "r",
    sigma: str = "sigma",
    put_call: str = "putCall",
    name: str = "price",
) -> DataFrame:
    """``bs_price`` as a column of ``df``, for wide tables.

    The arguments of the distribution function are columns of their own, so the
    expression stays small and is compiled once per stage.
    """
    spot, strike, t, rate, sigma = (F.col(c) for c in (spot, strike, t, rate, sigma))
    signed = df.withColumn("__sign", _sign(F.col(put_call)))
    d1, d2 = _d1_d2(spot, strike, t, rate, sigma, F.col("__sign"))
    staged = signed.withColumns({"__d1": d1, "__d2": d2})
    staged = staged.withColumns({"__a1": F.abs("__d1"), "__a2": F.abs("__d2")})
    staged = staged.withColumns({f"__e{i}": F.exp(-F.col(f"__a{i}") * F.col(f"__a{i}") / 2) for i in (1, 2)})
    staged = staged.withColumns({f"__l{i}": _tail_weight(F.col(f"__a{i}"), F.col(f"__e{i}")) for i in (1, 2)})
    n1, n2 = (
        F.when(F.col(f"__d{i}") > 0, 1 - F.col(f"__l{i}")).otherwise(F.col(f"__l{i}")) for i in (1, 2)
    )
    value = _bs_value(spot, strike, t, rate, F.col("__sign"), n1, n2)
    parts = [f"__{part}{i}" for part in "dael" for i in (1, 2)]
    return staged.withColumn(name, value).drop("__sign", *parts)


# --------------------------------------------------------------------------- numpy kernels


def _cdf(x: np.ndarray) -> np.ndarray:
    a = np.minimum(np.abs(x), 40.0)
    e = np.exp(-a * a / 2)
    num = np.polyval(CDF_NUMERATOR, a)
    den = np.polyval(CDF_DENOMINATOR, a)
    tail = e / (a + 1 / (a + 2 / (a + 3 / (a + 4 / (a + 0.65))))) / CDF_ROOT_TWO_PI
    lower = np.where(a < CDF_SPLIT, e * num / den, tail)
    return np.where(x > 0, 1 - lower, lower)


def european_prices(spot, strike, t, rate, sigma, is_call) -> tuple[np.ndarray, np.ndarray]:
    """Black-Scholes prices and vegas for whole arrays."""
    root_t = np.sqrt(t)
    width = sigma * root_t
    d1 = (np.log(spot / strike) + (rate + sigma * sigma / 2) * t) / width
    d2 = d1 - width
    sign = np.where(is_call, 1.0, -1.0)
    price = sign * (spot * _cdf(sign * d1) - strike * np.exp(-rate * t) * _cdf(sign * d2))
    vega = spot * root_t * np.exp(-d1 * d1 / 2) / np.sqrt(2 * np.pi)
    return price, vega


def _tree_block(spot, strike, t, rate, q, sigma, is_call, steps: int) -> np.ndarray:
    dt = t / steps
    log_up = sigma * np.sqrt(dt)
    up, down = np.exp(log_up), np.exp(-log_up)
    p = (np.exp((rate - q) * dt) - down) / (up - down)
    discount = np.exp(-rate * dt)
    w_up, w_down = discount * p, discount * (1 - p)
    sign = np.where(is_call, 1.0, -1.0)
    # exercise value at every reachable price spot * up**k, k = -steps .. steps
    k = np.arange(-steps, steps + 1, dtype=float)[:, None]
    exercise = np.maximum(sign * (spot * np.exp(k * log_up) - strike), 0.0)
    value = exercise[::2].copy()
    scratch = np.empty_like(value)
    for level in range(steps - 1, -1, -1):
        n = level + 1
        v, s = value[:n], scratch[:n]
        np.multiply(value[1 : n + 1], w_up, out=s)
        np.multiply(v, w_down, out=v)
        np.add(v, s, out=v)
        np.maximum(v, exercise[steps - level : steps + level + 1 : 2], out=v)
    return value[0]


def _tree_sum(spot, strike, t, rate, sigma, steps: int) -> np.ndarray:
    """Value of calls without dividend on the same tree.

    Early exercise of such a call never pays, so the tree value is the
    discounted expectation of the payoff over the last level.
    """
    dt = t / steps
    log_up = sigma * np.sqrt(dt)
    up, down = np.exp(log_up), np.exp(-log_up)
    p = (np.exp(rate * dt) - down) / (up - down)
    j = np.arange(steps + 1, dtype=float)[:, None]
    log_ways = np.concatenate([[0.0], np.cumsum(np.log(np.arange(steps, 0, -1)) - np.log(np.arange(1, steps + 1)))])
    weight = np.exp(log_ways[:, None] + j * np.log(p) + (steps - j) * np.log1p(-p))
    payoff = np.maximum(spot * np.exp((2 * j - steps) * log_up) - strike, 0.0)
    return np.exp(-rate * t) * np.sum(weight * payoff, axis=0)


def _rows_of(rows: int, n: int) -> np.ndarray:
    """An array whose rows begin on cache lines if n is a multiple of 8; sums of such rows take some two thirds of the time."""
    raw = np.empty(rows * n + 8)
    skipped = -raw.ctypes.data // 8 % 8
    return raw[skipped : skipped + rows * n].reshape(rows, n)


def _powers(base: np.ndarray, rows: int) -> np.ndarray:
    """base ** 0, base ** 1 and so on, a row each."""
    out = _rows_of(rows, len(base))
    out[0] = 1.0
    have = 1
    while have < rows:
        more = min(have, rows - have)
        np.multiply(out[:more], base, out=out[have : have + more])
        base = base * base
        have += more
    return out


def _tree_band(spot, strike, up, near, far, is_call, in_money, steps: int) -> np.ndarray:
    """The walk of ``_tree_block`` without the nodes whose value is known.

    Nodes of a level are numbered from the one deepest in the money. With proper probabilities and a dividend yield of at least 0, nodes are
    exercised up to a number that falls by at most one a level on the way back (Kim and Byun 1994) and never grows, and from the number of
    last nodes in the money (``in_money``) on they are worth exactly 0. Only the nodes between are walked, and only those about the boundary are
    compared with their exercise value. Where none is exercised any more, as with most calls, the rest of the walk is one sum. ``near`` and ``far`` are the discounted probabilities of the deeper and the
    other child; node i of level n is kept divided by near**(steps - n) and times (far / near)**i, so that a value is the plain sum of its children.
    """
    n = len(spot)
    width = min(int(in_money.max()), steps + 1)
    if not width:
        return np.zeros(n)
    sign = np.where(is_call, -1.0, 1.0)
    move = np.where(is_call, 1 / up, up)
    ratio = far / near
    # exercise value of node i at a level: strikes[i] * a - spots[i] * b
    strikes, spots = _powers(ratio, width), _powers(move * move * ratio, width)
    strikes *= sign * strike
    spots *= sign * spot
    a, b = np.ones(n), move ** -float(steps)
    a_step, b_step = 1 / near, move / near
    value, other = _rows_of(width + 1, n), _rows_of(width + 1, n)
    value[width] = other[width] = 0.0
    exercise, scratch = _rows_of(width, n), _rows_of(width, n)

    def exercised(rows: slice) -> np.ndarray:
        e, s = exercise[rows], scratch[rows]
        np.multiply(strikes[rows], a, out=e)
        np.multiply(spots[rows], b, out=s)
        return np.subtract(e, s, out=e)

    np.maximum(exercised(slice(0, width)), 0.0, out=value[:width])
    level, low, high = steps, 0, width
    while level:
        # the last level back may exercise anywhere, so it is walked alone
        levels = 1 if level == steps else min(_BAND_LEVELS, level)
        if low:
            value[max(low - levels, 0) : low] = exercised(slice(max(low - levels, 0), low))
        low, end = max(low - levels, 0), min(level, width)
        high = min(high, end)
        if low >= end:  # all nodes that are left are exercised
            low = max(end - 1, 0)
        zone = slice(low, high)
        for _ in range(levels):
            a *= a_step
            b *= b_step
            np.add(value[low:end], value[low + 1 : end + 1], out=other[low:end])
            if high > low:
                np.maximum(other[zone], exercised(zone), out=other[zone])
            value, other = other, value
        level -= levels
        if high > low:
            taken = value[zone] == exercise[zone]
            every, some = taken.all(axis=1), taken.any(axis=1)
            high = high - int(some[::-1].argmax()) if some.any() else low
            low += len(every) if every.all() else int(every.argmin())
        if not high:  # no exercise from here on: what is left is an expectation
            ways = np.array([math.comb(level, i) for i in range(min(level + 1, width))], dtype=float)
            return np.einsum("i,ij->j", ways, value[: len(ways)]) * near ** float(steps)
    if low:
        return sign * (strike - spot)
    return value[0] * near ** float(steps)


def american_prices(spot, strike, t, rate, q, sigma, is_call, steps: int = TREE_STEPS) -> np.ndarray:
    """Binomial-tree prices with early exercise, one array element per option.

    The backward walk keeps one value per node of the current level for a
    block of options, so memory is (steps + 1) x block, not steps squared.
    Calls without dividend need no walk; where the order of exercised nodes is certain, a walk takes options of like moneyness and the nodes that matter.
    """
    args = np.broadcast_arrays(*(np.asarray(a, dtype=float) for a in (spot, strike, t, rate, q, sigma)))
    is_call = np.broadcast_to(np.asarray(is_call, dtype=bool), args[0].shape)
    out = np.empty(args[0].shape[0])
    spot, strike, t, rate, q, sigma = args
    with np.errstate(all="ignore"):
        log_up = sigma * np.sqrt(t / steps)
        up, discount = np.exp(log_up), np.exp(-rate * t / steps)
        p = (np.exp((rate - q) * t / steps) - 1 / up) / (up - 1 / up)
        near, far = discount * np.where(is_call, p, 1 - p), discount * np.where(is_call, 1 - p, p)
        depth = np.where(is_call, -1.0, 1.0) * np.log(strike / spot) / log_up
        spread = steps * (2 * log_up + np.abs(np.log(near)) + np.abs(np.log(far / near)))
        banded = (q >= 0) & (p > 0) & (p < 1) & (log_up > 0) & (spread < _BAND_RANGE) & np.isfinite(depth)
        # nodes i with strike above spot * up ** (2 * i - steps), and one more against rounding
        in_money = np.clip(np.ceil((steps + np.where(banded, depth, 0.0)) / 2) + 1, 0, steps + 1).astype(int)
        picked = np.flatnonzero(banded)
        picked = picked[np.lexsort((in_money[picked], is_call[picked]))]
        for first in range(0, len(picked), _BAND_ROWS):
            rows = picked[first : first + _BAND_ROWS]
            if len(rows) < _BAND_LEAST:
                banded[rows] = False
                break
            out[rows] = _tree_band(spot[rows], strike[rows], up[rows], near[rows], far[rows], is_call[rows], in_money[rows], steps)
        proper = rate * np.sqrt(t / steps) < sigma
        summed = ~banded & is_call & (q == 0) & (rate >= 0) & (t > 0) & proper
        for rows in np.array_split(np.flatnonzero(summed), 1 + int(summed.sum()) // _TREE_ROWS):
            out[rows] = _tree_sum(spot[rows], strike[rows], t[rows], rate[rows], sigma[rows], steps)
        rest = np.flatnonzero(~banded & ~summed)
        for rows in np.array_split(rest, 1 + len(rest) // _TREE_ROWS):
            out[rows] = _tree_block(*(a[rows] for a in args), is_call[rows], steps)
    return out


def european_vols(mark, spot, strike, t, rate, is_call) -> np.ndarray:
    """Roots of price(vol) = mark on the interval; NaN where there is no sign change.

    Newton steps kept inside a shrinking bracket, on the still-open rows only.
    """
    n = len(mark)
    out = np.full(n, np.nan)
    with np.errstate(all="ignore"):
        def gap(index, vol):
            price, vega = european_prices(spot[index], strike[index], t[index], rate[index], vol, is_call[index])
            return price - mark[index], vega

        every = np.arange(n)
        f_lo, _ = gap(every, np.full(n, VOL_LOW))
        f_hi, _ = gap(every, np.full(n, VOL_HIGH))
        open_ = every[f_lo * f_hi <= 0]
        lo, hi = np.full(n, VOL_LOW), np.full(n, VOL_HIGH)
        guess = np.sqrt(2 * np.abs(np.log(spot / strike) + rate * t) / t)
        x = np.clip(np.where(np.isfinite(guess) & (guess > VOL_LOW), guess, 0.5), 0.05, 5.0)
        for _ in range(100):
            if not len(open_):
                break
            v = x[open_]
            f, vega = gap(open_, v)
            below = f < 0
            lo[open_[below]] = v[below]
            hi[open_[~below]] = v[~below]
            step = v - f / vega
            inside = np.isfinite(step) & (step > lo[open_]) & (step < hi[open_])
            new = np.where(inside, step, (lo[open_] + hi[open_]) / 2)
            done = (np.abs(new - v) < 1e-12) | (hi[open_] - lo[open_] < 1e-13) | (f == 0)
            new = np.where(f == 0, v, new)
            x[open_] = new
            out[open_[done]] = new[done]
            open_ = open_[~done]
    return out  # rows that did not settle stay NaN


def american_vols(mark, spot, strike, t, rate, q, is_call, steps: int = TREE_STEPS) -> np.ndarray:
    """As ``european_vols`` for the tree price.

    The tree price follows the closed-form price closely, so secant steps from
    the closed-form root settle in a few tree prices. Rows they do not settle,
    and rows whose tree has no proper probabilities at the lowest volatility
    (so that the price need not grow with it), take the bracketed search over
    the whole interval.
    """
    n = len(mark)
    out = np.full(n, np.nan)

    def gap(index, vol):
        price = american_prices(
            spot[index], strike[index], t[index], rate[index], q[index], vol, is_call[index], steps
        )
        return price - mark[index]

    with np.errstate(all="ignore"):
        every = np.arange(n)
        proper = np.abs(rate - q) * np.sqrt(t / steps) < VOL_LOW
        start = european_vols(mark, spot * np.exp(-q * t), strike, t, rate, is_call)
        rows = every[proper & np.isfinite(start)]
        settled = _secant_roots(gap, rows, start[rows], spot, strike, t, rate, is_call)
        out[rows] = settled
        rows = every[~np.isfinite(out)]
        f_lo, f_hi = gap(rows, np.full(len(rows), VOL_LOW)), gap(rows, np.full(len(rows), VOL_HIGH))
        inside = f_lo * f_hi <= 0
        rows, k = rows[inside], int(inside.sum())
        out[rows] = _bracketed_root(gap, rows, np.full(k, VOL_LOW), f_lo[inside], np.full(k, VOL_HIGH), f_hi[inside])
    return out


def _secant_roots(gap, rows, x, spot, strike, t, rate, is_call, tolerance: float = 2 * VOL_TOLERANCE) -> np.ndarray:
    """Roots by secant steps, the first one along the closed-form slope; NaN where not settled in 8 steps.

    The last step is taken when it is below ``tolerance``; what is left after it
    is far smaller, since the slope is known to a few percent by then.
    """
    out = np.full(len(rows), np.nan)
    active = np.arange(len(rows))
    slope = european_prices(spot[rows], strike[rows], t[rows], rate[rows], x, is_call[rows])[1]
    last, f_last = x.copy(), gap(rows, x)
    x = x - f_last / slope
    for _ in range(8):
        moving = (x[active] > VOL_LOW) & (x[active] < VOL_HIGH)
        active = active[moving]
        if not len(active):
            break
        f = gap(rows[active], x[active])
        change = f - f_last[active]
        # equal values leave the slope as it was
        s = np.where(change != 0, change / (x[active] - last[active]), slope[active])
        slope[active] = np.where(s > 0, s, slope[active])
        step = f / slope[active]
        last[active], f_last[active] = x[active], f
        x[active] = x[active] - step
        done = np.abs(step) < tolerance
        out[active[done]] = x[active[done]]
        active = active[~done]
    return out


def _bracketed_root(gap, rows, a, fa, b, fb, tolerance: float = VOL_TOLERANCE / 100) -> np.ndarray:
    """Chandrupatla's bracketed root finder (1997) on all rows at once."""
    n = len(rows)
    root = np.where(np.abs(fa) < np.abs(fb), a, b)
    active = np.arange(n)[(fa != 0) & (fb != 0)]
    a, b, fa, fb = a.copy(), b.copy(), fa.copy(), fb.copy()
    c, fc = a.copy(), fa.copy()
    frac = np.full(n, 0.5)
    for _ in range(100):
        if not len(active):
            break
        i = active
        x = a[i] + frac[i] * (b[i] - a[i])
        fx = gap(rows[i], x)
        same = np.sign(fx) == np.sign(fa[i])
        c[i] = np.where(same, a[i], b[i])
        fc[i] = np.where(same, fa[i], fb[i])
        b[i] = np.where(same, b[i], a[i])
        fb[i] = np.where(same, fb[i], fa[i])
        a[i], fa[i] = x, fx
        best = np.abs(fa[i]) < np.abs(fb[i])
        root[i] = np.where(best, a[i], b[i])
        f_best = np.where(best, fa[i], fb[i])
        room = tolerance / np.abs(b[i] - a[i])
        open_ = (room <= 0.5) & (f_best != 0) & np.isfinite(fx)
        root[i[~np.isfinite(fx)]] = np.nan
        xi = (a[i] - b[i]) / (c[i] - b[i])
        phi = (fa[i] - fb[i]) / (fc[i] - fb[i])
        quadratic = (phi**2 < xi) & ((1 - phi) ** 2 < 1 - xi)
        step = fa[i] / (fb[i] - fa[i]) * fc[i] / (fb[i] - fc[i]) + (c[i] - a[i]) / (b[i] - a[i]) * fa[i] / (
            fc[i] - fa[i]
        ) * fb[i] / (fc[i] - fb[i])
        step = np.where(quadratic & np.isfinite(step), step, 0.5)
        frac[i] = np.clip(step, room, 1 - room)
        active = i[open_]
    root[active] = np.nan  # not settled
    return root


# --------------------------------------------------------------------------- batch UDFs


def _calls(put_call: pd.Series) -> np.ndarray:
    return put_call.fillna("").str.startswith("C").to_numpy(dtype=bool)


@pandas_udf(DoubleType())
def _tree_price_udf(
    spot: pd.Series, strike: pd.Series, t: pd.Series, rate: pd.Series, q: pd.Series,
    sigma: pd.Series, put_call: pd.Series, steps: pd.Series,
) -> pd.Series:
    numbers = [s.to_numpy(dtype=float) for s in (spot, strike, t, rate, q, sigma)]
    out = american_prices(*numbers, _calls(put_call), int(steps.iloc[0])) if len(spot) else np.empty(0)
    return pd.Series(out)


@pandas_udf(DoubleType())
def _implied_vol_udf(
    mark: pd.Series, spot: pd.Series, strike: pd.Series, t: pd.Series, rate: pd.Series,
    q: pd.Series, put_call: pd.Series, exercise: pd.Series, steps: pd.Series,
) -> pd.Series:
    levels = int(steps.iloc[0]) if len(steps) else TREE_STEPS
    mark, spot, strike, t, rate, q = (s.to_numpy(dtype=float) for s in (mark, spot, strike, t, rate, q))
    is_call = _calls(put_call)
    european = (exercise.fillna("") == "E").to_numpy(dtype=bool)
    out = np.full(len(mark), np.nan)
    usable = np.isfinite(mark) & np.isfinite(rate) & (spot > 0) & (strike > 0) & (t > 0)
    pick = np.flatnonzero(usable & european)
    out[pick] = european_vols(mark[pick], spot[pick], strike[pick], t[pick], rate[pick], is_call[pick])
    pick = np.flatnonzero(usable & ~european & np.isfinite(q))
    out[pick] = american_vols(mark[pick], spot[pick], strike[pick], t[pick], rate[pick], q[pick], is_call[pick], levels)
    return pd.Series(out)


def crr_price(
    spot: Column | str, strike: Column | str, t: Column | str, rate: Column | str, q: Column | str | float,
    sigma: Column | str | float, put_call: Column | str, steps: int = TREE_STEPS,
) -> Column:
    """American price on a recombining tree of ``steps`` levels."""
    numbers = [_col(c).cast("double") for c in (spot, strike, t, rate, q, sigma)]
    price = _tree_price_udf(*numbers, _col(put_call), F.lit(int(steps)))
    return F.when(~F.isnan(price), price)


def implied_vol(
    mark: Column | str, spot: Column | str, strike: Column | str, t: Column | str, rate: Column | str,
    q: Column | str | float, put_call: Column | str, exercise: Column | str, steps: int = TREE_STEPS,
) -> Column:
    """Volatility at which the model price meets ``mark``; null without a sign change.

    Exercise type E uses Black-Scholes (which leaves q out), all others the
    tree of ``steps`` levels. Whole batches are solved in arrays, which is faster than the fold of ``european_vol``; that
    one plans no Python.
    """
    numbers = [_col(c).cast("double") for c in (mark, spot, strike, t, rate, q)]
    return _implied_vol_udf(*numbers, _col(put_call), _col(exercise), F.lit(int(steps)))
