"""Pieces of oracle SQL that several queries share (DuckDB text, used for checking only)."""

from __future__ import annotations

from optiontide.functions import calendar as C
from optiontide.functions import pricing as P


def ts_text(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"


def _horner(x: str, coefficients: tuple[float, ...]) -> str:
    out = f"{coefficients[0]!r}::double"
    for c in coefficients[1:]:
        out = f"({out} * {x} + {c!r}::double)"
    return out


def norm_cdf(x: str) -> str:
    """Normal distribution function of a column name or short expression."""
    a = f"abs({x})"
    e = f"exp(-{a} * {a} / 2)"
    core = f"{e} * {_horner(a, P.CDF_NUMERATOR)} / {_horner(a, P.CDF_DENOMINATOR)}"
    tail = f"{e} / ({a} + 1 / ({a} + 2 / ({a} + 3 / ({a} + 4 / ({a} + 0.65::double))))) / {P.CDF_ROOT_TWO_PI!r}::double"
    lower = f"(CASE WHEN {a} > 37 THEN 0.0::double WHEN {a} < {P.CDF_SPLIT!r}::double THEN {core} ELSE {tail} END)"
    return f"(CASE WHEN {x} > 0 THEN 1 - {lower} ELSE {lower} END)"


def with_bs_price(source: str, sigma: str, name: str) -> str:
    """Rows of ``source`` (underlyingPrice, strikePrice, t, r, putCall) with their price at ``sigma``."""
    return (
        f"SELECT * EXCLUDE (d1_, d2_), CASE WHEN t < 0 THEN NULL WHEN t = 0 THEN greatest(CASE WHEN putCall = 'CALL'"
        f" THEN underlyingPrice - strikePrice ELSE strikePrice - underlyingPrice END, 0.0) WHEN putCall = 'CALL' THEN"
        f" underlyingPrice * {norm_cdf('d1_')} - strikePrice * exp(-r * t) * {norm_cdf('d2_')}"
        f" ELSE strikePrice * exp(-r * t) * {norm_cdf('(-d2_)')} - underlyingPrice * {norm_cdf('(-d1_)')} END AS {name}"
        f" FROM (SELECT *, d1_ - {sigma} * sqrt(greatest(t, 0)) AS d2_ FROM (SELECT *, (ln(underlyingPrice / strikePrice)"
        f" + (r + {sigma} * {sigma} / 2) * t) / nullif({sigma} * sqrt(greatest(t, 0)), 0) AS d1_ FROM ({source}) s0) s1) s2"
    )


def implied_vols(source: str, columns: str, steps: int = 52) -> str:
    """Body of a WITH RECURSIVE: table ``vols`` of ``columns`` and iv by bisection, null without a sign change."""
    low = with_bs_price(f"SELECT *, {P.VOL_LOW}::double AS lo, {P.VOL_HIGH}::double AS hi FROM ({source}) q0", "lo", "p_lo")
    both = with_bs_price(low, "hi", "p_hi")
    step = with_bs_price("SELECT *, (lo + hi) / 2 AS mid FROM bis WHERE n < %d" % steps, "mid", "p_mid")
    keep = f"{columns}, underlyingPrice, strikePrice, t, r, putCall, mark"
    return (
        f"ends AS MATERIALIZED (SELECT *, coalesce((p_lo - mark) * (p_hi - mark) <= 0, false) AS bracketed FROM ({both}) b0),"
        f" bis AS (SELECT {keep}, lo, hi, 0 AS n FROM ends WHERE bracketed"
        f" UNION ALL SELECT {keep}, CASE WHEN p_mid < mark THEN mid ELSE lo END AS lo,"
        f" CASE WHEN p_mid < mark THEN hi ELSE mid END AS hi, n + 1 AS n FROM ({step}) b1),"
        f" vols AS (SELECT {columns}, (lo + hi) / 2 AS iv FROM bis WHERE n = {steps}"
        f" UNION ALL SELECT {columns}, NULL FROM ends WHERE NOT bracketed)"
    )


def tree_price(source: str, columns: str, steps: int = P.TREE_STEPS) -> str:
    """``columns`` and the American tree price of the rows of ``source`` (underlyingPrice, strikePrice, t, r, q, sigma, putCall).

    The levels of the tree are folded as lists: the walk starts from the payoffs and each
    level number, wrapped in a list of its own, turns the values of one level into those of the level before.
    """
    # prices at every node are listed once: position 2j - level counts up-moves minus down-moves
    worth = "sg * (px[(2 * j - {level})::int + " + str(steps + 1) + "] - strikePrice)"
    first = f"list_transform(range(0, {steps + 1}), lambda j: greatest({worth.format(level=steps)}, 0.0::double))"
    back = (
        "list_transform(range(0, e[1]::int + 1), lambda j: greatest(w_up * acc[j + 2] + w_down * acc[j + 1], "
        + worth.format(level="e[1]") + ", 0.0::double))"
    )
    levels = f"list_transform(range({steps - 1}, -1, -1), lambda l: [l::double])"
    return (
        f"SELECT {columns}, list_reduce({levels}, lambda acc, e: {back}, {first})[1] AS price FROM (SELECT *, dc * pr AS w_up,"
        f" dc * (1 - pr) AS w_down FROM (SELECT *, (exp((r - q) * t / {steps}) - exp(-lu)) / (exp(lu) - exp(-lu)) AS pr,"
        f" exp(-r * t / {steps}) AS dc, CASE WHEN putCall = 'CALL' THEN 1 ELSE -1 END AS sg,"
        f" list_transform(range({-steps}, {steps + 1}), lambda k: underlyingPrice * exp(k * lu)) AS px FROM (SELECT *, sigma * sqrt(t /"
        f" {steps}) AS lu FROM ({source}) t0) t1) t2) t3"
    )


def tree_vols(source: str, columns: str, tree_steps: int, steps: int = 40) -> str:
    """As ``implied_vols`` for the American tree price."""
    keep = f"{columns}, underlyingPrice, strikePrice, t, r, q, putCall, mark"
    low = tree_price(f"SELECT *, {P.VOL_LOW}::double AS sigma FROM ({source}) q0", keep, tree_steps)
    both = tree_price(
        f"SELECT * EXCLUDE (price), price AS p_lo, {P.VOL_HIGH}::double AS sigma FROM ({low}) q1", f"{keep}, p_lo", tree_steps
    )
    step = tree_price(
        f"SELECT *, (lo + hi) / 2 AS sigma FROM bis WHERE n < {steps}", f"{keep}, lo, hi, n, sigma", tree_steps
    )
    return (
        f"ends AS MATERIALIZED (SELECT *, coalesce((p_lo - mark) * (price - mark) <= 0, false) AS bracketed FROM ({both}) b0),"
        f" bis AS (SELECT {keep}, {P.VOL_LOW}::double AS lo, {P.VOL_HIGH}::double AS hi, 0 AS n FROM ends WHERE bracketed"
        f" UNION ALL SELECT {keep}, CASE WHEN price < mark THEN sigma ELSE lo END AS lo,"
        f" CASE WHEN price < mark THEN hi ELSE sigma END AS hi, n + 1 AS n FROM ({step}) b1),"
        f" vols AS (SELECT {columns}, (lo + hi) / 2 AS iv FROM bis WHERE n = {steps}"
        f" UNION ALL SELECT {columns}, NULL FROM ends WHERE NOT bracketed)"
    )


def is_holiday(d: str) -> str:
    rules = []
    for month, number in C.DATED_HOLIDAYS:
        def on(x: str) -> str:
            return f"(month({x}) = {month} AND day({x}) = {number})"

        rule = (
            f"(isodow({d}) <= 5 AND {on(d)}) OR (isodow({d}) = 5 AND {on(f'({d} + 1)')})"
            f" OR (isodow({d}) = 1 AND {on(f'({d} - 1)')})"
        )
        since = f" AND {d} >= date '{C.JUNETEENTH_FROM}'" if month == 6 else ""
        rules.append(f"(({rule}){since})")
    for month, target, nth in C.FLOATING_HOLIDAYS:
        since = f" AND {d} >= date '{C.KING_DAY_FROM}'" if month == 1 else ""
        rules.append(f"(month({d}) = {month} AND isodow({d}) = {target} AND (day({d}) - 1) // 7 = {nth - 1}{since})")
    rules.append(f"(month({d}) = 5 AND isodow({d}) = 1 AND day({d}) > 24)")
    return "(" + " OR ".join(rules) + ")"


def is_bizday(d: str) -> str:
    return f"(isodow({d}) <= 5 AND NOT {is_holiday(d)})"


def svensson(t: str, p: dict[str, float]) -> str:
    def loading(tau: float) -> str:
        return f"(CASE WHEN {t} = 0 THEN 1.0::double ELSE (1 - exp(-{t} / {tau}::double)) / ({t} / {tau}::double) END)"

    l1, l2 = loading(p["tau1"]), loading(p["tau2"])
    return (
        f"(CASE WHEN {t} >= 0 THEN {p['beta0']}::double + {p['beta1']}::double * {l1}"
        f" + {p['beta2']}::double * ({l1} - exp(-{t} / {p['tau1']}::double))"
        f" + {p['beta3']}::double * ({l2} - exp(-{t} / {p['tau2']}::double)) END)"
    )


def nelson_siegel(t: str, p: dict[str, float]) -> str:
    full = {"beta0": p["beta0"], "beta1": p["beta1"], "beta2": p["beta2"], "beta3": 0.0, "tau1": p["tau"], "tau2": 1.0}
    return svensson(t, full)
