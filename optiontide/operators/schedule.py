"""Trading schedules and business-day dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from optiontide.functions import calendar as C


def calendar_days(dates: DataFrame, day: str, pad_before: int = 0, pad_after: int = 0,
                  start: str | None = None) -> DataFrame:
    """Every calendar day from the first to the last date of ``dates``, plus padding.

    ``start`` is a date the span must reach back to. The size is the number of
    days in that span, whatever the size of ``dates``.
    """
    first = F.least(F.min(F.col(day).cast("date")), F.lit(start).cast("date"))  # nulls are passed over
    span = dates.agg(
        F.date_sub(first, pad_before).alias("__lo"),
        F.date_add(F.max(F.col(day).cast("date")), pad_after).alias("__hi"),
    ).filter("__hi is not null")
    return span.select(F.explode(F.sequence("__lo", "__hi")).alias("day"))


def business_calendar(days: DataFrame) -> DataFrame:
    """Per day: business flag, and the ordinals of the business days at or around it.

    ``ord_back`` counts business days up to the day; ``ord_ahead`` is the
    ordinal of the first business day from the day on.
    """
    w = W.orderBy("day")  # one row per calendar day: bounded by the calendar itself
    flagged = days.withColumn("is_bizday", C.is_bizday("day"))
    counted = flagged.withColumn("ord_back", F.sum(F.col("is_bizday").cast("int")).over(w))
    return counted.withColumn("ord_ahead", F.col("ord_back") + F.when(F.col("is_bizday"), 0).otherwise(1))


def bizday_offset(df: DataFrame, day: str, n: int, name: str) -> DataFrame:
    """The business day ``n`` away from each ``day``.

    From a weekend or holiday a move back or of zero days starts at the next
    business day, a move ahead at the previous one.
    """
    reach = 3 * abs(n) + 14
    cal = business_calendar(calendar_days(df, day, reach, reach))
    ordinal = (F.col("ord_ahead") if n <= 0 else F.col("ord_back")) + n
    # a business day has ord_back = ord_ahead = its own ordinal
    targets = cal.filter("is_bizday").select(F.col("ord_back").alias("__ord"), F.col("day").alias(name))
    moves = cal.select(F.col("day").alias("__day"), ordinal.alias("__ord")).join(targets, "__ord")
    return df.join(moves, df[day].cast("date") == F.col("__day"), "left").drop("__day", "__ord")


def prior_bizday(df: DataFrame, day: str, name: str = "prior_bizday", n: int = 1) -> DataFrame:
    return bizday_offset(df, day, -n, name)


def snapshot_target(df: DataFrame, day: str, name: str = "target_date") -> DataFrame:
    """The date a snapshot must reach on ``day``: the day itself, or the business day before a closed one."""
    prior = prior_bizday(df, day, "__prior")
    target = F.when(C.is_bizday(day), F.col(day).cast("date")).otherwise(F.col("__prior"))
    return prior.withColumn(name, target).drop("__prior")


def trading_schedule(days: DataFrame, open_time: str = "14:30:00", close_time: str = "21:00:00",
                     index_close_time: str = "21:15:00") -> DataFrame:
    """Sessions on the business days of ``days`` with opening and closing times in UTC."""
    def at(clock: str) -> Column:
        return F.concat(F.col("day").cast("string"), F.lit(" " + clock)).cast("timestamp")

    # Not a filter on the day: the optimiser would copy the holiday rules to the
    # other side of every later join on the date and test them on each contract.
    open_days = days.select(F.explode(F.when(C.is_bizday("day"), F.array("day"))).alias("day"))
    return open_days.select(
        F.col("day").alias("iso_date"),
        at(open_time).alias("market_open"),
        at(close_time).alias("market_close"),
        at(index_close_time).alias("index_close"),
    )


def cumulative_trading_time(
    schedule: DataFrame,
    as_of: Column | str,
    hours: str = "hours",
    hours_per_year: float = C.EQUITY_HOURS_PER_YEAR,
    name: str = "T",
    by: Sequence[str] = (),
) -> DataFrame:
    """Years of trading time from the session after ``as_of`` to each session's end; null up to ``as_of``.

    One row per session and calendar, so the window is bounded by the calendar.
    """
    later = F.col("iso_date") > (as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date"))
    w = W.partitionBy(*by).orderBy("iso_date").rowsBetween(W.unboundedPreceding, 0)
    total = F.sum(F.when(later, F.col(hours))).over(w)
    return schedule.withColumn(name, F.when(later, total / hours_per_year))


def expiry_schedule(sessions: DataFrame, as_of: Column | str) -> DataFrame:
    """iso_date, T_eqo, T_ind: trading time to each session for equity and index options."""
    def hours(close: str) -> Column:
        return (F.col(close).cast("double") - F.col("market_open").cast("double")) / 3600

    timed = sessions.withColumns({"__eqo": hours("market_close"), "__ind": hours("index_close")})
    timed = cumulative_trading_time(timed, as_of, "__eqo", C.EQUITY_HOURS_PER_YEAR, "T_eqo")
    timed = cumulative_trading_time(timed, as_of, "__ind", C.INDEX_HOURS_PER_YEAR, "T_ind")
    return timed.select("iso_date", "T_eqo", "T_ind")


def attach_schedule(contracts: DataFrame, schedule: DataFrame, expiry: str = "expirationDate") -> DataFrame:
    """Schedule columns of the session on the expiry date, null where there is none.

    No broadcast hint: the schedule has one row per session, so Spark's own size
    check broadcasts it, and falls back to a shuffle join beyond the threshold.
    """
    keyed = schedule.withColumn("__iso", F.col("iso_date").cast("date")).drop("iso_date")
    return contracts.join(keyed, C.prefix_date(expiry) == F.col("__iso"), "left").drop("__iso")


def expirations_only(schedule: DataFrame, expirations: DataFrame, expiry: str = "expirationDate") -> DataFrame:
    wanted = expirations.select(C.prefix_date(expiry).alias("__iso")).distinct()
    return schedule.join(wanted, F.col("iso_date").cast("date") == F.col("__iso"), "left_semi")


def open_sessions(events: DataFrame, hours: DataFrame, ts: str, market: str) -> DataFrame:
    """Market phase of each event from a table of sessions, "closed" outside all.

    The join is on the calendar date, the range of the session is a residual filter.
    """
    sessions = hours.filter((F.col("market") == market) & F.col("start").isNotNull()).select(
        F.col("date").cast("date").alias("__date"), "phase", "start", "end"
    )
    t = F.col(ts).cast("timestamp")
    inside = (t.cast("date") == F.col("__date")) & (t >= F.col("start")) & (t < F.col("end"))
    return events.join(sessions, inside, "left").withColumn("phase", F.coalesce("phase", F.lit("closed"))).drop(
        "__date", "start", "end"
    )
