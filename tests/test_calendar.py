import datetime as dt

import numpy as np
import pandas as pd
from pandas.tseries.holiday import USFederalHolidayCalendar
from pandas.tseries.offsets import CustomBusinessDay
from pyspark.sql import functions as F

from optiontide.functions import calendar as C
from optiontide.functions import rates as R
from optiontide.operators import schedule as S


def days(spark, first, last):
    return spark.sql(f"SELECT explode(sequence(date '{first}', date '{last}')) AS day")


def test_holidays_match_the_federal_calendar(spark):
    got = {r.day for r in days(spark, "1975-01-01", "2035-12-31").filter(C.is_holiday("day")).collect()}
    want = {d.date() for d in USFederalHolidayCalendar().holidays("1975-01-01", "2035-12-31")}
    assert got == want


def test_offsets_match_custom_business_days(spark):
    step = CustomBusinessDay(calendar=USFederalHolidayCalendar())
    df = days(spark, "2021-12-15", "2022-02-10")
    for n in (-5, -1, 0, 1, 4):
        got = {r.day: r.out for r in S.bizday_offset(df, "day", n, "out").collect()}
        assert len(got) == 58
        for day, out in got.items():
            assert out == (pd.Timestamp(day) + n * step).date(), (n, day)


def test_snapshot_target(spark):
    rows = {r.day: r.target_date for r in S.snapshot_target(days(spark, "2024-01-12", "2024-01-16"), "day").collect()}
    friday, tuesday = dt.date(2024, 1, 12), dt.date(2024, 1, 16)
    assert rows[friday] == friday and rows[tuesday] == tuesday
    assert all(rows[dt.date(2024, 1, d)] == friday for d in (13, 14, 15))  # weekend and holiday


def test_trading_time(spark):
    sessions = S.trading_schedule(days(spark, "2024-01-01", "2024-12-31"))
    rows = {r.iso_date: r for r in S.expiry_schedule(sessions, "2024-01-10").collect()}
    assert rows[dt.date(2024, 1, 10)].T_eqo is None
    assert np.isclose(rows[dt.date(2024, 1, 11)].T_eqo, 1 / 252)
    assert np.isclose(rows[dt.date(2024, 1, 12)].T_ind, 2 / 252)
    assert dt.date(2024, 7, 4) not in rows


def test_time_left_sign_options(spark):
    df = spark.sql("SELECT timestamp '2024-01-02 20:00:00' AS early, timestamp '2024-01-02 22:00:00' AS late")
    close = F.lit("2024-01-02 21:00:00")
    out = df.select(
        C.session_time_left("early", close, close, F.lit(False)).alias("a"),
        C.session_time_left("late", close, close, F.lit(False)).alias("b"),
        C.session_time_left("early", close, close, F.lit(False), reference_least=True).alias("c"),
        C.session_time_left("late", close, close, F.lit(False), reference_least=True).alias("d"),
    ).first()
    assert np.isclose(out.a, 3600 / (252 * 6.5 * 3600)) and out.b == 0 and out.c == 0 and out.d < 0


def test_rates_edges(spark):
    p = {"beta0": 0.04, "beta1": -0.01, "beta2": 0.02, "beta3": 0.01, "tau1": 1.0, "tau2": 3.0}
    df = spark.createDataFrame([(0.0,), (-1.0,), (None,), (1e-9,)], "t double")
    out = [r.r for r in df.select(R.svensson("t", p).alias("r")).collect()]
    assert np.isclose(out[0], 0.03) and out[1] is None and out[2] is None and np.isclose(out[3], 0.03)
    q = spark.createDataFrame([(1.0, 0.0), (1.0, None), (-1.0, 10.0), (1.0, 10.0)], "d double, p double")
    guarded = [r.q for r in q.select(R.dividend_yield("d", "p").alias("q")).collect()]
    raw = [r.q for r in q.select(R.dividend_yield("d", "p", guarded=False).alias("q")).collect()]
    assert guarded[:3] == [0.0, None, 0.0] and np.isclose(guarded[3], np.log(1.1))
    assert raw[0] is None and raw[1] is None and np.isclose(raw[2], np.log(0.9))


def test_utc_offset(spark):
    df = spark.sql("SELECT timestamp '2024-01-15 12:00:00' AS w, timestamp '2024-07-15 12:00:00' AS s")
    out = df.select(
        C.utc_offset_text("w", "America/New_York").alias("a"), C.utc_offset_text("s", "America/New_York").alias("b"),
        C.utc_offset_text("w", "America/St_Johns").alias("c"), C.to_utc(C.to_local("w", "America/New_York"), "America/New_York").alias("d"),
        "w",
    ).first()
    assert (out.a, out.b, out.c) == ("-05:00", "-04:00", "-03:30") and out.d == out.w
