"""Exchange sessions by rule, by table, and trading time between dates."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from optiontide.operators import bars as B
from optiontide.operators import sessions as SS


@pytest.fixture(scope="module")
def year(spark):
    return spark.sql("SELECT explode(sequence(date'2024-01-01', date'2024-12-31')) AS day")


def test_exchange_year(year):
    rows = {r.iso_date: r for r in SS.session_table(year).collect()}
    assert len(rows) == 252
    closed = ("2024-01-01", "2024-01-15", "2024-02-19", "2024-03-29", "2024-05-27", "2024-06-19", "2024-07-04", "2024-09-02", "2024-11-28", "2024-12-25")
    assert all(dt.date.fromisoformat(d) not in rows for d in closed)
    assert all(dt.date.fromisoformat(d) in rows for d in ("2024-10-14", "2024-11-11"))  # federal holidays with a session
    early = sorted(str(d) for d, r in rows.items() if (r.market_close - r.market_open).seconds < 6 * 3600)
    assert early == ["2024-07-03", "2024-11-29", "2024-12-24"]
    winter, summer = rows[dt.date(2024, 1, 2)], rows[dt.date(2024, 7, 2)]
    assert str(winter.market_open)[11:] == "14:30:00" and str(summer.market_open)[11:] == "13:30:00" and str(summer.index_close)[11:] == "20:15:00"


def test_observed_days(spark):
    days = spark.createDataFrame([(d,) for d in ("2021-12-31", "2022-06-20", "2021-07-05", "2020-07-03", "2022-12-26", "2023-04-07")], "day string")
    got = {r.day: r.h for r in days.select("day", SS.is_exchange_holiday(F.col("day").cast("date")).alias("h")).collect()}
    assert got == {"2021-12-31": False, "2022-06-20": True, "2021-07-05": True, "2020-07-03": True, "2022-12-26": True, "2023-04-07": True}


def test_trading_time_over_fetch_dates(spark, year):
    sessions = SS.session_table(year)
    rows = [("2024-01-02", "2024-01-05"), ("2024-01-06", "2024-01-08"), ("2024-01-05", "2024-01-05"), ("2024-01-02", "2024-01-06"), (None, "2024-01-05"),
            ("2024-07-02", "2024-07-03T20:00:00Z")]
    out = SS.attach_trading_time(spark.createDataFrame(rows, "f string, x string"), sessions, "f", "x").collect()
    got = {(r.f, r.x): r.T_eqo for r in out}
    assert got[rows[0]] == pytest.approx(3 / 252) and got[rows[1]] == pytest.approx(1 / 252) and got[rows[5]] == pytest.approx(3.5 / 6.5 / 252)
    assert got[rows[2]] is None and got[rows[3]] is None and got[rows[4]] is None


def test_history_windows(spark, year):
    sessions = SS.session_table(year)
    row = B.history_window(sessions, "day", 2, as_of="2024-01-16").first()
    assert str(row.start) == "2024-01-11 00:00:00" and str(row.end) == "2024-01-12 21:00:00"
    assert str(B.history_window(sessions, "year", 1, end="2024-05-01").first().start) == "2023-05-01 00:00:00"
    assert str(B.history_window(sessions, "ytd", end="2024-05-01").first().start) == "2024-01-01 00:00:00"
    for bad in (dict(period=7, as_of="2024-01-16"), dict(period=1, start="2024-01-01", end="2024-01-02"), dict()):
        with pytest.raises(ValueError):
            B.history_window(sessions, "day", **bad)


def test_rules_begin_with_a_year_and_single_days_are_added(spark):
    days = spark.createDataFrame(
        [(d,) for d in ("2020-06-19", "2021-06-18", "2022-06-20", "1997-01-20", "1998-01-19", "2012-10-29", "1990-11-23", "2024-11-29")], "day string")
    got = {r.day: r.h for r in days.select("day", SS.is_exchange_holiday(F.col("day").cast("date")).alias("h")).collect()}
    assert got == {"2020-06-19": False, "2021-06-18": False, "2022-06-20": True, "1997-01-20": False, "1998-01-19": True, "2012-10-29": False,
                   "1990-11-23": False, "2024-11-29": False}
    early = {r.day: r.e for r in days.select("day", SS.closes_early(F.col("day").cast("date")).alias("e")).collect()}
    assert not early["1990-11-23"] and early["2024-11-29"]
    storm = spark.createDataFrame([("2012-10-29",), ("2012-10-29",)], "day string")
    open_days = {str(r.iso_date) for r in SS.session_table(days, also_closed=storm).collect()}
    assert open_days == {"2020-06-19", "2021-06-18", "1997-01-20", "1990-11-23", "2024-11-29"}
    none = spark.createDataFrame([], "day string")
    assert SS.session_table(days, closures=none, also_closed=storm).count() == 7


def test_session_left_by_fetch_day(spark, year):
    rows = [("2024-01-02 19:30:00", False, 1.5 / 1638), ("2024-01-02 19:30:00", True, 1.75 / 1701), ("2024-01-03 02:00:00", False, 0.0),
            ("2024-01-06 15:00:00", False, 0.0), ("2024-07-03 16:00:00", False, 1 / 1638), (None, False, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, f string, isIndex boolean, want double").withColumn("fetchTime", F.col("f").cast("timestamp"))
    out = {r.id: r for r in SS.attach_session_left(df, SS.session_table(year)).collect()}
    for i, (_, _, want) in enumerate(rows):
        assert out[i].time_remaining == (None if want is None else pytest.approx(want))
    assert str(out[2].fetch_day) == "2024-01-02"  # nine in the evening at the exchange
