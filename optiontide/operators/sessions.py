"""Exchange sessions: an input table, or rules with local clocks, and trading time between any two dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from optiontide.functions import calendar as C

# Exchange holidays. Dated ones move from a Saturday to the Friday before (New Year does not) and from a
# Sunday to the Monday after; the others fall on the n-th given weekday of a month (1 = Monday). Good Friday and the last Monday of May are
# closed too. The last number is the first year of a rule; rules without one hold in all years that are asked for, which should be
# 1971 or later. Single closures (mourning, storms, attacks) are no rules: give them as a table.
DATED_CLOSURES = ((1, 1, None), (6, 19, 2022), (7, 4, None), (12, 25, None))
FLOATING_CLOSURES = ((1, 1, 3, 1998), (2, 1, 3, None), (9, 1, 1, None), (11, 4, 4, None))
EARLY_CLOSES_FROM = 1993
# Local clocks.
ZONE = "America/New_York"
OPEN, CLOSE, INDEX_CLOSE, EARLY_CLOSE, EARLY_INDEX_CLOSE = "09:30:00", "16:00:00", "16:15:00", "13:00:00", "13:15:00"


def _div(value: Column, n: int) -> Column:
    return F.floor(value / n)


def easter(year: Column) -> Column:
    """Easter Sunday of a year of the Gregorian calendar."""
    century, golden = _div(year, 100), year % 19
    moon = (19 * golden + century - _div(century, 4) - _div(century - _div(century + 8, 25) + 1, 3) + 15) % 30
    rest = year % 100
    back = (32 + 2 * (century % 4) + 2 * _div(rest, 4) - moon - rest % 4) % 7
    shift = moon + back - 7 * _div(golden + 11 * moon + 22 * back, 451) + 114
    return F.make_date(year, _div(shift, 31).cast("int"), (shift % 31 + 1).cast("int"))


def _on(day: Column, month: int, number: int) -> Column:
    return (F.month(day) == month) & (F.day(day) == number)


def is_exchange_holiday(day: Column | str) -> Column:
    d = (day if isinstance(day, Column) else F.col(day)).cast("date")
    weekday = F.weekday(d) + 1
    closed = (d == F.date_sub(easter(F.year(d)), 2)) | ((F.month(d) == 5) & (weekday == 1) & (F.day(d) > 24))

    def since(rule: Column, first: int | None) -> Column:
        return rule if first is None else rule & (F.year(d) >= first)

    for month, number, first in DATED_CLOSURES:
        rule = _on(d, month, number) | ((weekday == 1) & _on(F.date_sub(d, 1), month, number))
        if (month, number) != (1, 1):
            rule = rule | ((weekday == 5) & _on(F.date_add(d, 1), month, number))
        closed = closed | since(rule, first)
    for month, which, n, first in FLOATING_CLOSURES:
        closed = closed | since((F.month(d) == month) & (weekday == which) & (F.ceil(F.day(d) / 7) == n), first)
    return closed


def closes_early(day: Column | str) -> Column:
    """The day after Thanksgiving, and the weekdays before Independence Day and Christmas where these are weekdays but no Monday."""
    d = (day if isinstance(day, Column) else F.col(day)).cast("date")
    weekday = F.weekday(d) + 1
    thanks = (F.month(d) == 11) & (weekday == 5) & (F.ceil((F.day(d) - 1) / 7) == 4) & (F.day(d) > 1)
    eve = ((F.month(d) == 7) & (F.day(d) == 3)) | ((F.month(d) == 12) & (F.day(d) == 24))
    return (thanks | (eve & (weekday <= 4))) & (F.year(d) >= EARLY_CLOSES_FROM)


def session_table(days: DataFrame, closures: DataFrame | None = None, early: DataFrame | None = None, zone: str = ZONE,
                  also_closed: DataFrame | None = None) -> DataFrame:
    """Sessions (iso_date, market_open, market_close, index_close) of the weekdays of ``days`` that are no closures.

    ``closures`` and ``early`` are tables with a ``day``; without them the
    exchange's rules hold. ``also_closed`` adds single days to either. Clocks are local, so the times follow daylight saving.
    """
    rows = days.select(F.col("day").cast("date").alias("day")).distinct()
    if closures is None:
        rows = rows.withColumn("__closed", is_exchange_holiday("day"))
    else:
        off = closures.select(F.col("day").cast("date").alias("day"), F.lit(True).alias("__closed")).distinct()
        rows = rows.join(off, "day", "left")
    if also_closed is not None:
        single = also_closed.select(F.col("day").cast("date").alias("day"), F.lit(True).alias("__single")).distinct()
        rows = rows.join(single, "day", "left").withColumn("__closed", F.coalesce("__closed", F.lit(False)) | F.coalesce("__single", F.lit(False)))
    if early is None:
        rows = rows.withColumn("__early", closes_early("day"))
    else:
        soon = early.select(F.col("day").cast("date").alias("day"), F.lit(True).alias("__early")).distinct()
        rows = rows.join(soon, "day", "left")
    open_ = ~F.coalesce("__closed", F.lit(False)) & (F.weekday("day") < 5)
    soon = F.coalesce("__early", F.lit(False))

    def at(clock: Column | str) -> Column:
        local = F.concat(F.col("day").cast("string"), F.lit(" "), clock if isinstance(clock, Column) else F.lit(clock))
        return F.to_utc_timestamp(local.cast("timestamp"), zone)

    # generated rather than filtered, see trading_schedule
    kept = rows.select(F.explode(F.when(open_, F.array(F.struct("day", soon.alias("soon"))))).alias("s")).select("s.*")
    return kept.select(
        F.col("day").alias("iso_date"), at(OPEN).alias("market_open"),
        at(F.when(F.col("soon"), EARLY_CLOSE).otherwise(CLOSE)).alias("market_close"),
        at(F.when(F.col("soon"), EARLY_INDEX_CLOSE).otherwise(INDEX_CLOSE)).alias("index_close"),
    )


def elapsed_hours(sessions: DataFrame) -> DataFrame:
    """Session hours up to and including every calendar day of the sessions' span: one row per day, whatever is joined to it."""
    def hours(close: str) -> Column:
        return (F.col(close).cast("double") - F.col("market_open").cast("double")) / 3600

    timed = sessions.select(F.col("iso_date").cast("date").alias("day"), hours("market_close").alias("e"), hours("index_close").alias("i"))
    span = timed.agg(F.min("day").alias("lo"), F.max("day").alias("hi")).filter("lo is not null")
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("day"))
    w = W.orderBy("day")  # bounded by the calendar
    rows = days.join(timed, "day", "left")
    return rows.select("day", F.col("e").isNotNull().alias("is_session"), F.sum(F.coalesce("e", F.lit(0.0))).over(w).alias("hours_eqo"),
                       F.sum(F.coalesce("i", F.lit(0.0))).over(w).alias("hours_ind"))


def attach_trading_time(contracts: DataFrame, sessions: DataFrame, fetched: str, expiry: str) -> DataFrame:
    """``T_eqo`` and ``T_ind``: years of trading time after the fetch date up to the expiry's session.

    Hours are cumulated once; both dates look them up, and the difference is the time, so rows of any number of
    fetch dates go through one plan. Null without a session on the expiry date or when it is not after the fetch date.
    """
    hours = elapsed_hours(sessions)
    start = hours.select(F.col("day").alias("__from"), F.col("hours_eqo").alias("__e0"), F.col("hours_ind").alias("__i0"))
    end = hours.filter("is_session").select(F.col("day").alias("__to"), F.col("hours_eqo").alias("__e1"), F.col("hours_ind").alias("__i1"))
    first, last = F.col(fetched).cast("date"), C.prefix_date(F.col(expiry).cast("string"))
    out = contracts.join(start, first == F.col("__from"), "left").join(end, last == F.col("__to"), "left")

    def years(a: str, b: str, per_year: float) -> Column:
        return F.when(last > first, (F.col(b) - F.col(a)) / per_year)

    return out.withColumns({
        "T_eqo": years("__e0", "__e1", C.EQUITY_HOURS_PER_YEAR), "T_ind": years("__i0", "__i1", C.INDEX_HOURS_PER_YEAR),
    }).drop("__from", "__e0", "__i0", "__to", "__e1", "__i1")


def fetch_day(fetched: Column | str, zone: str = ZONE) -> Column:
    """The exchange's date at an instant."""
    at = fetched if isinstance(fetched, Column) else F.col(fetched)
    return F.from_utc_timestamp(at.cast("timestamp"), zone).cast("date")


def attach_session_left(chains: DataFrame, sessions: DataFrame, fetched: str = "fetchTime", is_index: str = "isIndex", name: str = "time_remaining",
                        zone: str = ZONE, reference_least: bool = False) -> DataFrame:
    """``fetch_day`` and what is left of that day's session in years of trading time (0 on a day without one), whatever the day."""
    closes = sessions.select(F.col("iso_date").cast("date").alias("__day"), F.col("market_close").alias("__close"), F.col("index_close").alias("__index"))
    out = chains.withColumn("fetch_day", fetch_day(fetched, zone)).join(closes, F.col("fetch_day") == F.col("__day"), "left")
    left = C.session_time_left(fetched, "__close", "__index", is_index, reference_least)
    known = F.col(fetched).isNotNull()
    return out.withColumn(name, F.when(F.col("__day").isNotNull(), left).when(known, F.lit(0.0))).drop("__day", "__close", "__index")
