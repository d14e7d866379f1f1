"""Dates, sessions and market-hours documents as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Sessions per year and hours per session.
SESSIONS_PER_YEAR = 252
EQUITY_SESSION_HOURS = 6.5
INDEX_SESSION_HOURS = 6.75
EQUITY_HOURS_PER_YEAR = SESSIONS_PER_YEAR * EQUITY_SESSION_HOURS
INDEX_HOURS_PER_YEAR = SESSIONS_PER_YEAR * INDEX_SESSION_HOURS
EQUITY_SECONDS_PER_YEAR = EQUITY_HOURS_PER_YEAR * 3600
INDEX_SECONDS_PER_YEAR = INDEX_HOURS_PER_YEAR * 3600

# Session phases as (name, first minute of day, last minute of day).
UTC_PHASES = (("pre", 480, 810), ("regular", 810, 1200), ("post", 1200, 1440))
LOCAL_PHASES = (("pre", 420, 570), ("regular", 570, 960), ("post", 960, 1200))
LOCAL_INDEX_PHASES = (("regular", 570, 975),)

# US federal holidays. Dated ones are observed on the nearest
# weekday; the others fall on the n-th given weekday of a month (1 = Monday).
DATED_HOLIDAYS = ((1, 1), (6, 19), (7, 4), (11, 11), (12, 25))
FLOATING_HOLIDAYS = ((1, 1, 3), (2, 1, 3), (9, 1, 1), (10, 1, 2), (11, 4, 4))
JUNETEENTH_FROM = "2021-06-18"
KING_DAY_FROM = "1986-01-01"


def _col(value: Column | str) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def prefix_date(text: Column | str) -> Column:
    """Date in the first ten characters; null when they hold none."""
    return F.substring(_col(text), 1, 10).try_cast("date")


def from_epoch_ms(ms: Column | str) -> Column:
    return F.timestamp_millis(_col(ms))


def to_epoch_ms(ts: Column | str) -> Column:
    return F.unix_millis(_col(ts).cast("timestamp"))


# --------------------------------------------------------------------------- business days


def is_holiday(day: Column | str) -> Column:
    """Whether ``day`` is an observed US federal holiday."""
    d = _col(day).cast("date")
    weekday = F.weekday(d) + 1

    def dated(month: int, number: int) -> Column:
        def on(x: Column) -> Column:
            return (F.month(x) == month) & (F.day(x) == number)

        return (
            ((weekday <= 5) & on(d))
            | ((weekday == 5) & on(F.date_add(d, 1)))
            | ((weekday == 1) & on(F.date_sub(d, 1)))
        )

    def floating(month: int, target: int, nth: int) -> Column:
        return (F.month(d) == month) & (weekday == target) & (F.floor((F.day(d) - 1) / 7) == nth - 1)

    out = F.lit(False)
    for month, number in DATED_HOLIDAYS:
        rule = dated(month, number)
        out = out | (rule & (d >= F.lit(JUNETEENTH_FROM).cast("date")) if month == 6 else rule)
    for month, target, nth in FLOATING_HOLIDAYS:
        rule = floating(month, target, nth)
        out = out | (rule & (d >= F.lit(KING_DAY_FROM).cast("date")) if month == 1 else rule)
    last_monday_of_may = (F.month(d) == 5) & (weekday == 1) & (F.day(d) > 24)
    return out | last_monday_of_may


def is_bizday(day: Column | str) -> Column:
    return (F.weekday(_col(day).cast("date")) < 5) & ~is_holiday(day)


# --------------------------------------------------------------------------- sessions


def session_time_left(
    fetch_ts: Column | str,
    close_equity: Column | str,
    close_index: Column | str,
    is_index: Column | str,
    reference_least: bool = False,
) -> Column:
    """Rest of the current session in years of trading time, never below 0.

    ``reference_least`` keeps the smaller of that span and 0 instead, which
    is 0 during the session and negative after its close.
    """
    fetched = _col(fetch_ts).cast("timestamp").cast("long")
    index_left = (_col(close_index).cast("timestamp").cast("long") - fetched) / F.lit(INDEX_SECONDS_PER_YEAR)
    equity_left = (_col(close_equity).cast("timestamp").cast("long") - fetched) / F.lit(EQUITY_SECONDS_PER_YEAR)
    left = F.when(_col(is_index), index_left).otherwise(equity_left)
    return F.least(left, F.lit(0.0)) if reference_least else F.greatest(left, F.lit(0.0))


def time_to_expiry(
    time_left: Column | str, t_equity: Column | str, t_index: Column | str, is_index: Column | str
) -> Column:
    """Session time left today plus whole sessions up to the expiry."""
    return _col(time_left) + F.when(_col(is_index), _col(t_index)).otherwise(_col(t_equity))


def session_hours(open_ts: Column | str, close_ts: Column | str, as_of: Column | str) -> Column:
    """Trading hours still ahead at ``as_of``: whole for later days, the rest for that day, 0 before."""
    opened, closed, now = (_col(c).cast("timestamp") for c in (open_ts, close_ts, as_of))

    def hours(a: Column, b: Column) -> Column:
        return (b.cast("double") - a.cast("double")) / 3600

    day, today = opened.cast("date"), now.cast("date")
    return (
        F.when(day > today, hours(opened, closed))
        .when(day == today, F.greatest(hours(F.greatest(now, opened), closed), F.lit(0.0)))
        .otherwise(F.lit(0.0))
    )


def session_phase(ts: Column | str, table: tuple = UTC_PHASES) -> Column:
    """Phase name at ``ts`` by minute of day, "closed" outside all phases.

    A phase starts at its first minute and ends just before its last; weekends
    and holidays are not looked at, as in a plain clock check.
    """
    t = _col(ts).cast("timestamp")
    minute = F.hour(t) * 60 + F.minute(t)
    out = F.when(t.isNull(), F.lit(None).cast("string"))
    for name, first, last in table:
        out = out.when((minute >= first) & (minute < last), F.lit(name))
    return out.otherwise("closed")


# --------------------------------------------------------------------------- hours documents


def get_hour(doc: Column | str, path: str) -> Column:
    """Timestamp at a JSON path such as ``$.option.EQO.sessionHours.regularMarket[0].end``."""
    return F.get_json_object(_col(doc), path).try_cast("timestamp")


def get_document_date(doc: Column | str) -> Column:
    """The top-level date, else the date of the first product of the first market."""
    top = F.get_json_object(_col(doc), "$.date")
    markets = F.from_json(_col(doc), T.MapType(T.StringType(), T.StringType()))
    return F.coalesce(top, _first_product_field(F.try_element_at(F.map_values(markets), F.lit(1)), "date")).try_cast("date")


def get_markets(doc: Column | str) -> Column:
    """Top-level names in upper case."""
    return F.transform(F.json_object_keys(_col(doc)), lambda k: F.upper(k))


def _first_product_field(market_doc: Column, field: str) -> Column:
    products = F.from_json(market_doc, T.MapType(T.StringType(), T.StringType()))
    return F.get_json_object(F.try_element_at(F.map_values(products), F.lit(1)), f"$.{field}")


def is_open(doc: Column | str, market: str | None = None) -> Column:
    """Open flag: of the whole document, else of the market's first product.

    With no market and no top-level flag the first market other than forex decides.
    """
    doc = _col(doc)
    if market is not None:
        return _first_product_field(F.get_json_object(doc, f"$.{market.lower()}"), "isOpen").try_cast("boolean")
    top = F.get_json_object(doc, "$.isOpen")
    names = F.filter(F.json_object_keys(doc), lambda k: k != "forex")
    markets = F.from_json(doc, T.MapType(T.StringType(), T.StringType()))
    first = F.try_element_at(markets, F.try_element_at(names, F.lit(1)))
    return F.coalesce(top, _first_product_field(first, "isOpen")).try_cast("boolean")


# --------------------------------------------------------------------------- offsets


def utc_offset_seconds(ts: Column | str, zone: Column | str) -> Column:
    """Seconds to add to UTC time ``ts`` to get the local time of ``zone``."""
    t = _col(ts).cast("timestamp")
    return F.from_utc_timestamp(t, zone).cast("long") - t.cast("long")


def utc_offset_text(ts: Column | str, zone: Column | str) -> Column:
    """The offset as ``+hh:mm`` or ``-hh:mm``."""
    seconds = utc_offset_seconds(ts, zone)
    minutes = F.floor(F.abs(seconds) / 60)
    return F.format_string(
        "%s%02d:%02d", F.when(seconds < 0, "-").otherwise("+"), F.floor(minutes / 60), minutes % 60
    )


def to_local(ts: Column | str, zone: Column | str) -> Column:
    return F.from_utc_timestamp(_col(ts).cast("timestamp"), zone)


def to_utc(ts: Column | str, zone: Column | str) -> Column:
    return F.to_utc_timestamp(_col(ts).cast("timestamp"), zone)
