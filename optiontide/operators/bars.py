"""Price bars: reshaping, returns, rolling indicators, signals."""

from __future__ import annotations

import operator
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from optiontide.operators.ordered import rolling_rows, time_bucket, with_previous
from optiontide.operators.tables import latest_per_key, nth_from_end, upsert

BAR_VALUES = ("open", "close", "high", "low", "volume")

# Candle frequencies.
FREQUENCIES = ("minute1", "minute5", "minute10", "minute15", "minute30", "daily", "weekly", "monthly")

# Number of periods allowed and default, and default frequency, by period type.
PERIODS = {
    "day": ((1, 2, 3, 4, 5, 10), 10, "minute1"),
    "month": ((1, 2, 3, 6), 1, "weekly"),
    "year": ((1, 2, 3, 5, 10, 15, 20), 1, "monthly"),
    "ytd": ((1,), 1, "weekly"),
}

_OPERATORS: dict[str, Callable] = {
    "gt": operator.gt,
    "ge": operator.ge,
    "lt": operator.lt,
    "le": operator.le,
    "eq": operator.eq,
    "ne": operator.ne,
}


def flatten_candles(history: DataFrame, symbol: str = "symbol", candles: str = "candles") -> DataFrame:
    """Bar rows from one array of candles per symbol; epoch milliseconds become timestamps."""
    rows = history.select(F.col(symbol).alias("symbol"), F.inline(candles))
    return rows.select("symbol", F.timestamp_millis("datetime").alias("ts"), *BAR_VALUES)


def period_start(ts: Column | str, freq: str) -> Column:
    """Start of the candle that holds ``ts``."""
    if freq not in FREQUENCIES:
        raise ValueError(f"unknown frequency {freq!r}; one of {', '.join(FREQUENCIES)}")
    t = (ts if isinstance(ts, Column) else F.col(ts)).cast("timestamp")
    if freq.startswith("minute"):
        seconds = int(freq.removeprefix("minute")) * 60
        return F.timestamp_seconds(F.floor(t.cast("double") / seconds) * seconds)
    return F.date_trunc({"daily": "day", "weekly": "week", "monthly": "month"}[freq], t)


def ohlcv(ticks: DataFrame, freq: str, price: str = "close", volume: str = "volume", ts: str = "ts",
          by: Sequence[str] = ("symbol",), tie: Sequence[str] = ()) -> DataFrame:
    """Candles of ``freq``: first, highest, lowest, last price and summed volume.

    All five are aggregates with a map-side part, so a hot symbol reaches the
    shuffle as one row per candle and task. ``tie`` orders equal times.
    """
    order = F.struct(ts, *tie) if tie else F.col(ts)
    return ticks.groupBy(*by, period_start(ts, freq).alias("period")).agg(
        F.min_by(price, order).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, order).alias("close"),
        F.sum(volume).alias("volume"),
    )


def history_window(sessions: DataFrame, period_type: str = "day", period: int | None = None, start: str | None = None,
                   end: str | None = None, as_of: str | None = None) -> DataFrame:
    """The times (start, end) of a price history, as one row.

    Without ``end`` it is the close of the last session before ``as_of``. Without
    ``start`` the window holds the last ``period`` sessions, months or years up to the end, or the year so far.
    A period beside both a start and an end is refused.
    """
    allowed, default, _ = PERIODS[period_type]
    if start and end and period:
        raise ValueError("no period beside a start and an end")
    if period is not None and period not in allowed:
        raise ValueError(f"period {period} is not one of {allowed} for {period_type}")
    if not end and not as_of:
        raise ValueError("an end, or a day to look back from")
    n = period or default
    last = F.lit(end).cast("timestamp") if end else F.max(F.when(F.col("iso_date") < F.lit(as_of).cast("date"), F.col("market_close")))
    bounds = sessions.agg(last.alias("end"), F.array_sort(F.collect_set("iso_date")).alias("__days"))  # one row per session
    day = F.col("end").cast("date")
    if start:
        first = F.lit(start).cast("timestamp")
    elif period_type == "day":
        past = F.filter("__days", lambda d: d <= day)
        first = F.get(past, F.greatest(F.size(past) - n, F.lit(0))).cast("timestamp")
    elif period_type == "ytd":
        first = F.date_trunc("year", day)
    else:
        first = F.add_months(day, -n * (12 if period_type == "year" else 1)).cast("timestamp")
    return bounds.select(first.alias("start"), "end")


def price_history(ticks: DataFrame, sessions: DataFrame, period_type: str = "day", period: int | None = None,
                  freq: str | None = None, start: str | None = None, end: str | None = None, as_of: str | None = None,
                  extended: bool = True, previous_close: bool = True, price: str = "close", volume: str = "volume",
                  ts: str = "ts", by: Sequence[str] = ("symbol",), tie: Sequence[str] = ()) -> DataFrame:
    """Candles of a window, see ``history_window``; with ``extended=False`` of session hours only.

    ``previous_close`` adds the last price before the window per symbol, null where there is none.
    """
    window = history_window(sessions, period_type, period, start, end, as_of).first()
    low, high = F.lit(window["start"]), F.lit(window["end"])
    inside = ticks.filter((F.col(ts) >= low) & (F.col(ts) <= high))
    if not extended:
        hours = sessions.select(F.col("iso_date").cast("date").alias("__day"), "market_open", "market_close")
        regular = (F.col(ts).cast("date") == F.col("__day")) & (F.col(ts) >= F.col("market_open")) & (F.col(ts) < F.col("market_close"))
        inside = inside.join(hours, regular, "left_semi")
    out = ohlcv(inside, freq or PERIODS[period_type][2], price, volume, ts, by, tie)
    if not previous_close:
        return out
    order = F.struct(ts, *tie) if tie else F.col(ts)
    before = ticks.filter(F.col(ts) < low).groupBy(*by).agg(F.max_by(price, order).alias("previous_close"))
    return out.join(before, list(by), "left")


def upsert_bars(bars: DataFrame, new: DataFrame, order: Sequence[str] = ("ts",)) -> DataFrame:
    """New values at (symbol, ts), added where missing."""
    return upsert(new, bars, ["symbol", "ts"], order)


def _cut(ts: str, seconds: float | None) -> Column | None:
    """Ranges of a fixed width along time, or none: then places are sampled when the query runs."""
    return time_bucket(ts, seconds) if seconds else None


def daily_returns(bars: DataFrame, price: str = "close", by: Sequence[str] = ("symbol",), ts: str = "ts",
                  tie: Sequence[str] = (), name: str = "ret", bucket_seconds: float | None = None) -> DataFrame:
    """Change of ``price`` against the row before, per symbol; null on the first row and after a zero.

    Each symbol is cut along time, at sampled places unless a width is given; no job runs before the first action.
    """
    prior = with_previous(bars, by, [ts, *tie], price, _cut(ts, bucket_seconds), "__prev")
    return prior.withColumn(name, F.try_divide(F.col(price), F.col("__prev")) - 1).drop("__prev")


def group_stat(df: DataFrame, column: str, fns: Mapping[str, str], by: Sequence[str] = ("symbol",)) -> DataFrame:
    """Statistics per group on every row; ``fns`` is name -> mean, std, var, min, max, sum or count.

    Aggregated first and joined back, so no group is gathered in one task.
    """
    known = {"mean": F.avg, "std": F.stddev_samp, "var": F.var_samp, "min": F.min, "max": F.max,
             "sum": F.sum, "count": F.count}
    keyed = df.withColumn("__key", F.struct(*by))
    stats = keyed.groupBy("__key").agg(*[known[fn](column).alias(n) for n, fn in fns.items()])
    return keyed.join(stats, "__key").drop("__key")


def rolling(bars: DataFrame, column: str, n: int, fn: str, by: Sequence[str] = ("symbol",), ts: str = "ts",
            tie: Sequence[str] = (), name: str | None = None, bucket_seconds: float | None = None,
            block_rows: int = 65536) -> DataFrame:
    """Statistic of the last ``n`` rows per symbol, null until n values are there."""
    return rolling_many(bars, {name or f"{column}_{fn}_{n}": (column, n, fn)}, by, ts, tie, bucket_seconds, block_rows)


def rolling_many(bars: DataFrame, outputs: dict[str, tuple[str, int, str]], by: Sequence[str] = ("symbol",),
                 ts: str = "ts", tie: Sequence[str] = (), bucket_seconds: float | None = None,
                 block_rows: int = 65536) -> DataFrame:
    """Several rolling columns over one partitioning: name -> (column, n, function).

    Each symbol is cut along time, at sampled places unless a width is given; no job runs before the first action.
    """
    return rolling_rows(bars, by, [ts, *tie], _cut(ts, bucket_seconds), outputs, block_rows)


def last_rows(bars: DataFrame, by: Sequence[str] = ("symbol",), ts: str = "ts", tie: Sequence[str] = ()) -> DataFrame:
    return latest_per_key(bars, by, [ts, *tie])


def last_rolled(bars: DataFrame, outputs: dict[str, tuple[str, int, str]], by: Sequence[str] = ("symbol",), ts: str = "ts",
                tie: Sequence[str] = ()) -> DataFrame:
    """The last row of each symbol with the rolling columns ``outputs``, from its last rows alone.

    A row-number filter keeps as many rows per symbol and task as the widest
    window asks for, so the history is not rolled for one row.
    """
    widest = max(n for _, n, _ in outputs.values())
    order = W.partitionBy(*by).orderBy(*[F.col(c).desc() for c in (ts, *tie)])
    recent = bars.withColumn("__rn", F.row_number().over(order)).filter(F.col("__rn") <= widest).drop("__rn")
    return last_rows(rolling_rows(recent, by, [ts, *tie], F.lit(0), outputs), by, ts, tie)


def current_bar(bars: DataFrame, symbol: str, ts: str = "ts", tie: Sequence[str] = ()) -> DataFrame:
    """Last bar of one symbol, matched by equality."""
    return bars.filter(F.col("symbol") == symbol).orderBy(*[F.col(c).desc() for c in (ts, *tie)]).limit(1)


def bar_ago(bars: DataFrame, n: int, by: Sequence[str] = ("symbol",), ts: str = "ts", tie: Sequence[str] = ()) -> DataFrame:
    """The n-th bar from the end of each symbol."""
    return nth_from_end(bars, by, [ts, *tie], n)


def _predicate(op, left: Column, right: Column) -> Column:
    compare = _OPERATORS[op] if isinstance(op, str) else op
    return F.coalesce(compare(left, right), F.lit(False))


def check_signals(last: DataFrame, rules: Mapping[str, Mapping], by: str = "symbol", combine: str = "any") -> DataFrame:
    """Buy and sell signals of the last rows: (symbol, side, rule).

    A rule named ``a_comp_b`` compares two columns, any other compares its
    column with the constants ``buy`` and ``sell``; a missing operator leaves
    that side out. ``combine`` is ``any`` (each rule that holds), ``all``
    (all rules of the side hold) or ``last`` (the last rule of the side decides).
    """
    if combine not in ("any", "all", "last"):
        raise ValueError(f"unknown combination {combine!r}")
    hits: dict[str, list[tuple[str, Column]]] = {"buy": [], "sell": []}
    for name, rule in rules.items():
        left, _, right = name.partition("_comp_")
        missing = {left, *([right] if right else [])} - set(last.columns)
        if missing:
            raise KeyError(f"indicator columns are missing: {', '.join(sorted(missing))}")
        for side in hits:
            op = rule.get(f"{side}_operator")
            if op is None:
                continue
            other = F.col(right) if right else F.lit(rule[side])
            hits[side].append((name, _predicate(op, F.col(left), other)))
    cases = []
    for side, tests in hits.items():
        if combine == "all" and tests:
            every = tests[0][1]
            for _, test in tests[1:]:
                every = every & test
            tests = [("all", every)]
        elif combine == "last":
            tests = tests[-1:]
        cases += [
            F.struct(F.lit(side).alias("side"), F.lit(name).alias("rule"), test.alias("hit")) for name, test in tests
        ]
    return last.select(by, F.inline(F.array(*cases))).filter("hit").drop("hit")
