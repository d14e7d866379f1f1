"""Curve, calendar and symbol queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from optiontide.functions import calendar as C
from optiontide.functions import rates as R
from optiontide.functions import symbols as Y
from optiontide.operators import curves as K
from optiontide.operators import schedule as S
from optiontide.operators import tables as TB
from optiontide.operators import universe as U
from optiontide.plans import derived as D
from optiontide.plans import oracle_sql as O
from optiontide.plans.registry import query, rounded

POINTS = D.oracle_text(D.CURVE_POINTS)
ASKED = D.oracle_text(D.CURVE_QUERIES)
MASTER = D.oracle_text(D.OPTION_MASTER)
EQUITIES = D.oracle_text(D.EQUITY_MASTER)

# --------------------------------------------------------------------------- curves

# the fitted curve must run within a tenth of a percent (root mean square) of its points
def _fit_query(model: str, curve, names: tuple[str, ...]) -> None:
    @query(
        f"fn11_calibration_fit_{model}",
        f"SELECT cast(ref_date AS varchar) AS ref_date, CAST(count(*) AS int) AS points, true AS close_fit FROM ({POINTS}) p GROUP BY 1",
    )
    def _(spark, sf):
        points = D.curve_points_table(spark, sf)
        fitted = K.calibrate_curves(points, model)
        fit = curve("t", {n: F.col(n) for n in names})
        errors = points.join(fitted, "ref_date").groupBy("ref_date", "points", "sse").agg(
            F.sum((fit - F.col("y")) * (fit - F.col("y"))).alias("sum")
        )
        close = (F.sqrt(F.col("sum") / F.col("points")) < 1e-3) & (F.abs(F.col("sum") - F.col("sse")) < 1e-12)
        return errors.select("ref_date", "points", close.alias("close_fit"))


_fit_query("svensson", R.svensson, ("beta0", "beta1", "beta2", "beta3", "tau1", "tau2"))
_fit_query("nelson_siegel", R.nelson_siegel, ("beta0", "beta1", "beta2", "tau"))

# One wide yield row per event: percents by maturity label, some missing.
_WIDE = (
    "SELECT event_id, cast(ts AS date) AS Date, CASE WHEN event_id % 5 = 0 THEN NULL ELSE floor(value * 100) / 100 END AS"
    " `1 Mo`, floor(value * 50) / 100 AS `6 mo`, floor(value * 25) / 100 AS `2 Yr`, CASE WHEN event_id % 3 = 0 THEN"
    " floor(value * 10) / 100 END AS `30 YR` FROM {events}"
)
_WIDE_DUCK = D.oracle_text(_WIDE.replace("`", '"'))


@query(
    "fn10_curve_points",
    "SELECT ref_date, label, maturity_date, count(*) AS n, round(sum(y), 6) AS y, max(t) AS t FROM (SELECT cast(Date AS"
    " varchar) AS ref_date, label, cast(Date + CASE lower(split_part(label, ' ', 2)) WHEN 'mo' THEN 30 ELSE 365 END *"
    " cast(split_part(label, ' ', 1) AS int) AS varchar) AS maturity_date, pct / 100 AS y, round(CASE lower(split_part("
    "label, ' ', 2)) WHEN 'mo' THEN 30 ELSE 365 END * cast(split_part(label, ' ', 1) AS int) / 365.0::double, 8) AS t FROM"
    f" (UNPIVOT (SELECT * EXCLUDE (event_id) FROM ({_WIDE_DUCK}) w) ON COLUMNS(* EXCLUDE (Date)) INTO NAME label VALUE pct) u)"
    " GROUP BY ALL",
)
def _(spark, sf):
    wide = D.derived(spark, sf, _WIDE).drop("event_id")
    out = K.curve_points(wide).groupBy("ref_date", "label", "maturity_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("y"), F.max("t").alias("t")
    )
    return rounded(rounded(out, 6, "y"), 8, "t")


@query("fn11_calibrate_svensson")
def _(spark, sf):
    return K.calibrate_curves(D.curve_points_table(spark, sf), "svensson")


@query("fn11_calibrate_nelson_siegel")
def _(spark, sf):
    return K.calibrate_curves(D.curve_points_table(spark, sf), "nelson_siegel")




GAPPED = D.oracle_text(D.GAPPED_DATES)


def _pick_sql(op: str, later: str, dates: str = POINTS) -> str:
    days = f"SELECT DISTINCT day FROM ({ASKED}) a"
    return (
        f"WITH c AS (SELECT DISTINCT ref_date FROM ({dates}) p), d AS (SELECT a.day, coalesce(max(CASE WHEN c.ref_date {op}"
        f" a.day THEN c.ref_date END), min(CASE WHEN c.ref_date {later} a.day THEN c.ref_date END)) AS curve_date FROM"
        f" ({days}) a, c GROUP BY a.day) SELECT q.event_id, cast(q.day AS varchar) AS day, cast(d.curve_date AS varchar) AS"
        f" curve_date FROM ({ASKED}) q JOIN d ON q.day = d.day"
    )


def picked(spark, sf, policy="on_or_before", dates=D.CURVE_DATES):
    return K.pick_curve(D.derived(spark, sf, D.CURVE_QUERIES), D.derived(spark, sf, dates), "day", policy=policy)


@query("join5_pick_curve", _pick_sql("<=", ">", GAPPED))
def _(spark, sf):
    return picked(spark, sf, dates=D.GAPPED_DATES).select("event_id", "day", "curve_date")


@query("join5_pick_curve_strict", _pick_sql("<", ">", GAPPED))
def _(spark, sf):
    return picked(spark, sf, "strictly_before", D.GAPPED_DATES).select("event_id", "day", "curve_date")


_ON_CURVE = (
    f"WITH p AS (SELECT ref_date, t, y, lead(t) OVER w AS t1, lead(y) OVER w AS y1, lag(t) OVER w AS t_before FROM ({POINTS}) x"
    " WINDOW w AS (PARTITION BY ref_date ORDER BY t)), q AS (SELECT q.event_id, q.t, c.curve_date FROM"
    f" ({ASKED}) q JOIN ({{pick}}) c ON q.event_id = c.event_id) SELECT q.event_id, round({{value}}, 9) AS rate FROM q JOIN p ON"
    " cast(p.ref_date AS varchar) = q.curve_date AND (q.t >= p.t OR p.t_before IS NULL) AND (q.t < p.t1 OR p.t1 IS NULL)"
).replace("{pick}", _pick_sql("<=", ">"))


def asked_on_curves(spark, sf):
    return picked(spark, sf).withColumnRenamed("curve_date", "ref_date")


@query(
    "join6_interp_linear",
    _ON_CURVE.replace(
        "{value}", "CASE WHEN q.t <= p.t OR p.t1 IS NULL THEN p.y ELSE p.y + (p.y1 - p.y) * (q.t - p.t) / (p.t1 - p.t) END"
    ),
)
def _(spark, sf):
    out = K.interp_linear(D.curve_points_table(spark, sf), asked_on_curves(spark, sf))
    return rounded(out.select("event_id", "rate"), 9, "rate")


@query("join7_interp_flat_forward", _ON_CURVE.replace("{value}", "p.y"))
def _(spark, sf):
    out = K.interp_flat_forward(D.curve_points_table(spark, sf), asked_on_curves(spark, sf))
    return rounded(out.select("event_id", "rate"), 9, "rate")


# Elimination and back substitution of the spline's tridiagonal system, point by point.
_SPLINE = (
    f"x AS (SELECT ref_date, t, y, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY ref_date) AS n, lead(t) OVER w - t AS h, (lead(y) OVER w - y) /"
    f" (lead(t) OVER w - t) AS d FROM ({POINTS}) x0 WINDOW w AS (PARTITION BY ref_date ORDER BY t)),"
    " g AS (SELECT *, lag(h) OVER w AS h0, lag(d) OVER w AS d0, lead(h) OVER w AS h1, lead(d) OVER w AS d1, lag(h, 2) OVER w AS g0, lag(d, 2) OVER w AS e0"
    " FROM x WINDOW w AS (PARTITION BY ref_date ORDER BY i)),"
    " m AS (SELECT *, CASE WHEN i = 0 THEN 0 WHEN i = n - 1 THEN h0 + g0 ELSE h END AS a, CASE WHEN i = 0 THEN h1 WHEN i = n - 1 THEN g0 ELSE 2 * (h0 + h) END AS b,"
    " CASE WHEN i = 0 THEN h + h1 WHEN i = n - 1 THEN 0 ELSE h0 END AS c, CASE WHEN i = 0 THEN ((3 * h + 2 * h1) * h1 * d + h * h * d1) / (h + h1) WHEN i = n - 1"
    " THEN (h0 * h0 * e0 + (3 * h0 + 2 * g0) * g0 * d0) / (h0 + g0) ELSE 3 * (h * d0 + h0 * d) END AS r FROM g),"
    " fw AS (SELECT ref_date, i, n, c / b AS cp, r / b AS rp FROM m WHERE i = 0 UNION ALL SELECT m.ref_date, m.i, m.n, m.c / (m.b - m.a * f.cp), (m.r - m.a * f.rp)"
    " / (m.b - m.a * f.cp) FROM fw f JOIN m ON m.ref_date = f.ref_date AND m.i = f.i + 1),"
    " bw AS (SELECT ref_date, i, rp AS s FROM fw WHERE i = n - 1 UNION ALL SELECT f.ref_date, f.i, f.rp - f.cp * w.s FROM bw w JOIN fw f ON f.ref_date ="
    " w.ref_date AND f.i = w.i - 1),"
    " p AS (SELECT g.ref_date, g.t, g.y, CASE WHEN g.h IS NOT NULL THEN g.t + g.h END AS t1, CASE WHEN g.i > 0 THEN 0 END AS t_before, u.s AS c1, (3 * g.d - 2 * u.s - v.s)"
    " / g.h AS c2, (u.s + v.s - 2 * g.d) / (g.h * g.h) AS c3 FROM g JOIN bw u ON u.ref_date = g.ref_date AND u.i = g.i LEFT JOIN bw v ON v.ref_date = g.ref_date"
    " AND v.i = g.i + 1)"
)


@query(
    "join8_interp_cubic",
    f"WITH RECURSIVE {_SPLINE}, q AS (SELECT q.event_id, q.t, c.curve_date FROM ({ASKED}) q JOIN ({_pick_sql('<=', '>')}) c ON q.event_id = c.event_id)"
    " SELECT q.event_id, round(q.t, 9) AS t, round(CASE WHEN q.t <= p.t OR p.t1 IS NULL THEN p.y ELSE p.y + (q.t - p.t) * (c1 + (q.t - p.t) * (c2 + (q.t - p.t)"
    " * c3)) END, 9) AS rate FROM q JOIN p ON cast(p.ref_date AS varchar) = q.curve_date AND (q.t >= p.t OR p.t_before IS NULL) AND (q.t < p.t1 OR p.t1 IS NULL)",
)
def _(spark, sf):
    return rounded(K.interp_cubic(D.curve_points_table(spark, sf), asked_on_curves(spark, sf)).select("event_id", "t", "rate"), 9, "t", "rate")


_ASKED_SOME = f"SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN day END AS day FROM ({ASKED}) a0"


@query(
    "join5_latest_curve",
    f"WITH c AS (SELECT DISTINCT ref_date FROM ({GAPPED}) p), d AS (SELECT a.day, coalesce(max(CASE WHEN c.ref_date <= a.day THEN c.ref_date END), min(CASE WHEN"
    f" c.ref_date > a.day THEN c.ref_date END)) AS curve_date FROM (SELECT DISTINCT day FROM ({_ASKED_SOME}) a1 WHERE day IS NOT NULL) a, c GROUP BY a.day)"
    f" SELECT q.event_id, cast(CASE WHEN q.day IS NULL THEN (SELECT max(ref_date) FROM c) ELSE d.curve_date END AS varchar) AS curve_date FROM ({_ASKED_SOME}) q"
    " LEFT JOIN d ON q.day = d.day",
)
def _(spark, sf):
    asked = D.derived(spark, sf, D.CURVE_QUERIES).withColumn("day", F.when(F.col("event_id") % 4 != 0, F.col("day")))
    return K.pick_curve(asked, D.derived(spark, sf, D.GAPPED_DATES), "day", latest_without_day=True).select("event_id", "curve_date")


@query(
    "join5_points_of_the_latest_curve",
    f"SELECT cast(ref_date AS varchar) AS ref_date, t, round(y, 9) AS y FROM ({POINTS}) p WHERE ref_date = (SELECT max(ref_date) FROM ({POINTS}) m)",
)
def _(spark, sf):
    return rounded(K.latest_curve(D.curve_points_table(spark, sf)).select("ref_date", "t", "y"), 9, "y")


# at the maturities themselves, and outside them, the spline must give the given yields
@query(
    "join8_interp_cubic_nodes",
    f"SELECT cast(ref_date AS varchar) AS ref_date, t, round(y, 9) AS rate FROM ({POINTS}) p UNION ALL SELECT cast(ref_date AS"
    f" varchar), t + 20, round(y, 9) FROM ({POINTS}) p WHERE label = '30 Yr'",
)
def _(spark, sf):
    points = D.curve_points_table(spark, sf)
    asked = points.select("ref_date", "t").union(
        points.filter("label = '30 Yr'").select("ref_date", (F.col("t") + 20).alias("t"))
    )
    return rounded(K.interp_cubic(points, asked), 9, "rate")


@query(
    "top2_sorted_curve",
    f"SELECT cast(ref_date AS varchar) AS ref_date, count(*) AS n, string_agg(cast(days AS varchar), ' ' ORDER BY t) AS days"
    f" FROM ({POINTS}) p GROUP BY 1",
)
def _(spark, sf):
    curve = K.sorted_curve(D.curve_points_table(spark, sf))
    days = F.transform("points", lambda p: F.round(p["t"] * 365).cast("int").cast("string"))
    return curve.select("ref_date", F.size("points").cast("bigint").alias("n"), F.array_join(days, " ").alias("days"))


# --------------------------------------------------------------------------- tables


@query(
    "prj10_drop_null_columns",
    "SELECT o_orderkey, o_orderpriority AS mixed FROM orders",
)
def _(spark, sf):
    o = D.table(spark, sf, "orders")
    wide = o.select(
        "o_orderkey", F.lit(None).cast("string").alias("empty"), F.lit("N/A").alias("absent"), F.col("o_orderpriority").alias("mixed")
    )
    return TB.drop_null_columns(wide)


_TEXT = "CASE WHEN o_orderkey % 4 = 0 THEN 'N/A' WHEN o_orderkey % 4 = 1 THEN '' ELSE cast(o_totalprice AS string) END"


@query("prj11_to_numeric", f"SELECT o_orderkey, TRY_CAST({_TEXT} AS double) AS price FROM orders")
def _(spark, sf):
    o = D.table(spark, sf, "orders").select("o_orderkey", F.expr(_TEXT).alias("price"))
    return TB.to_numeric(o, ["price"])


# --------------------------------------------------------------------------- calendar


@query("fn17_epoch_ms", f"SELECT event_id, epoch_us(ts) // 1000 AS ms, {O.ts_text('make_timestamp(epoch_us(ts) // 1000 * 1000)')} AS back FROM events")
def _(spark, sf):
    e = D.table(spark, sf, "events").withColumn("ms", C.to_epoch_ms("ts"))
    return e.select("event_id", "ms", C.from_epoch_ms("ms").alias("back"))


# One hours document per event; markets are closed on every fourth event.
_HOURS = (
    "SELECT event_id, CASE WHEN event_id % 4 = 0 THEN concat('{{\"equity\":{{\"equity\":{{\"date\":\"', cast(cast(ts AS date) AS"
    " string), '\",\"marketType\":\"EQUITY\",\"product\":\"equity\",\"isOpen\":false,\"sessionHours\":null}}}},\"date\":\"',"
    " cast(cast(ts AS date) AS string), '\"}}') ELSE concat('{{\"option\":{{\"EQO\":{{\"date\":\"', cast(cast(ts AS date) AS"
    " string), '\",\"product\":\"EQO\",\"isOpen\":true,\"sessionHours\":{{\"regularMarket\":[{{\"start\":\"', cast(cast(ts AS date)"
    " AS string), 'T09:30:00-05:00\",\"end\":\"', cast(cast(ts AS date) AS string), 'T16:00:00-05:00\"}}]}}}},\"IND\":{{\"date\":\"',"
    " cast(cast(ts AS date) AS string), '\",\"product\":\"IND\",\"isOpen\":true,\"sessionHours\":{{\"regularMarket\":[{{\"start\":\"',"
    " cast(cast(ts AS date) AS string), 'T09:30:00-05:00\",\"end\":\"', cast(cast(ts AS date) AS string),"
    " 'T16:15:00-05:00\"}}]}}}}}},\"isOpen\":true}}') END AS value FROM {events}"
)


def hours_documents(spark, sf):
    return D.derived(spark, sf, _HOURS)


@query(
    "fn18_get_hour",
    "SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN strftime(CAST(CAST(ts AS date) AS timestamp) + INTERVAL 1260 MINUTE,"
    " '%Y-%m-%d %H:%M:%S.%f') END AS eqo_end, CASE WHEN event_id % 4 <> 0 THEN strftime(CAST(CAST(ts AS date) AS timestamp) +"
    " INTERVAL 1275 MINUTE, '%Y-%m-%d %H:%M:%S.%f') END AS ind_end, cast(CAST(ts AS date) AS varchar) AS day FROM events",
)
def _(spark, sf):
    return hours_documents(spark, sf).select(
        "event_id",
        C.get_hour("value", "$.option.EQO.sessionHours.regularMarket[0].end").alias("eqo_end"),
        C.get_hour("value", "$.option.IND.sessionHours.regularMarket[0].end").alias("ind_end"),
        C.get_document_date("value").alias("day"),
    )


@query(
    "fn19_is_open",
    "SELECT event_id, event_id % 4 <> 0 AS any_open, CASE WHEN event_id % 4 <> 0 THEN true END AS option_open, CASE WHEN"
    " event_id % 4 = 0 THEN false END AS equity_open FROM events",
)
def _(spark, sf):
    return hours_documents(spark, sf).select(
        "event_id", C.is_open("value").alias("any_open"), C.is_open("value", "OPTION").alias("option_open"),
        C.is_open("value", "equity").alias("equity_open"),
    )


_MINUTE = "hour(ts) * 60 + minute(ts)"


@query(
    "fn20_session_phase",
    f"SELECT event_id, CASE WHEN {_MINUTE} >= 480 AND {_MINUTE} < 810 THEN 'pre' WHEN {_MINUTE} >= 810 AND {_MINUTE} < 1200"
    f" THEN 'regular' WHEN {_MINUTE} >= 1200 THEN 'post' ELSE 'closed' END AS utc_phase, CASE WHEN {_MINUTE} >= 570 AND"
    f" {_MINUTE} < 975 THEN 'regular' ELSE 'closed' END AS index_phase FROM events",
)
def _(spark, sf):
    e = D.table(spark, sf, "events")
    return e.select(
        "event_id", C.session_phase("ts").alias("utc_phase"), C.session_phase("ts", C.LOCAL_INDEX_PHASES).alias("index_phase")
    )


@query(
    "fn20_open_sessions",
    "SELECT event_id, CASE WHEN event_day % 7 <> 6 AND minute_of_day >= 870 AND minute_of_day < 1260 THEN 'regularMarket' ELSE"
    f" 'closed' END AS phase FROM (SELECT event_id, day(ts) AS event_day, {_MINUTE} AS minute_of_day FROM events) e",
)
def _(spark, sf):
    # hours of each date; the dates with day number 6 modulo 7 are closed
    dates = D.table(spark, sf, "events").select(F.to_date("ts").alias("date")).distinct()
    at = lambda minutes: F.col("date").cast("timestamp") + F.make_interval(mins=F.lit(minutes))
    hours = dates.select(
        "date", F.lit("equity").alias("market"), F.lit("regularMarket").alias("phase"),
        F.when(F.day("date") % 7 != 6, at(870)).alias("start"), F.when(F.day("date") % 7 != 6, at(1260)).alias("end"),
    )
    return S.open_sessions(D.table(spark, sf, "events"), hours, "ts", "equity").select("event_id", "phase")


@query("fn21_is_bizday", f"SELECT o_orderkey, {O.is_bizday('d')} AS is_bizday FROM (SELECT o_orderkey, CAST(o_orderdate AS date) AS d FROM orders) o")
def _(spark, sf):
    return D.table(spark, sf, "orders").select("o_orderkey", C.is_bizday("o_orderdate").alias("is_bizday"))


_CALENDAR = (
    f"SELECT d, {O.is_bizday('d')} AS biz FROM (SELECT CAST(unnest(generate_series((SELECT min(o_orderdate) FROM orders) -"
    " INTERVAL 60 DAY, (SELECT max(o_orderdate) FROM orders) + INTERVAL 60 DAY, INTERVAL 1 DAY)) AS date) AS d) g"
)


@query(
    "fn21_bizday_offset",
    f"WITH cal AS ({_CALENDAR}), o AS (SELECT d, biz, sum(biz::int) OVER (ORDER BY d) AS back, sum(biz::int) OVER (ORDER BY d) +"
    " CASE WHEN biz THEN 0 ELSE 1 END AS ahead FROM cal), b AS (SELECT d, back AS n FROM o WHERE biz) SELECT k.o_orderkey,"
    " cast(p.d AS varchar) AS prior_bizday, cast(a.d AS varchar) AS next3 FROM orders k JOIN o ON CAST(k.o_orderdate AS date) ="
    " o.d JOIN b p ON p.n = o.ahead - 1 JOIN b a ON a.n = o.back + 3",
)
def _(spark, sf):
    o = D.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    out = S.bizday_offset(S.prior_bizday(o, "o_orderdate"), "o_orderdate", 3, "next3")
    return out.select("o_orderkey", "prior_bizday", "next3")


_DAYS = "SELECT DISTINCT CAST(ts AS date) AS d FROM events"


@query(
    "fn22_session_hours",
    "SELECT event_id, round(CASE WHEN CAST(ts AS date) > date '2024-01-10' THEN 6.5 WHEN CAST(ts AS date) = date '2024-01-10'"
    " THEN greatest(least(6.5, (epoch(CAST(CAST(ts AS date) AS timestamp) + INTERVAL 21 HOUR) - epoch(greatest(TIMESTAMP"
    " '2024-01-10 16:20:00', CAST(CAST(ts AS date) AS timestamp) + INTERVAL 870 MINUTE))) / 3600), 0) ELSE 0 END, 8) AS hours"
    " FROM events",
)
def _(spark, sf):
    day = F.to_date("ts").cast("timestamp")
    opened, closed = day + F.make_interval(mins=F.lit(870)), day + F.make_interval(hours=F.lit(21))
    e = D.table(spark, sf, "events")
    return rounded(e.select("event_id", C.session_hours(opened, closed, F.lit("2024-01-10 16:20:00")).alias("hours")), 8, "hours")


@query(
    "win8_cumulative_trading_time",
    f"SELECT cast(d AS varchar) AS iso_date, CASE WHEN d > date '2024-01-10' THEN round(sum(CASE WHEN d > date '2024-01-10' THEN"
    f" 6.5 ELSE 0 END) OVER (ORDER BY d) / 1638, 9) END AS T FROM ({_DAYS}) x WHERE {O.is_bizday('d')}",
)
def _(spark, sf):
    days = D.table(spark, sf, "events").select(F.to_date("ts").alias("day"))
    sessions = S.trading_schedule(S.calendar_days(days, "day")).withColumn("hours", F.lit(6.5))
    return rounded(S.cumulative_trading_time(sessions, "2024-01-10").select("iso_date", "T"), 9, "T")


@query(
    "fn28_utc_offset",
    f"SELECT event_id, '+05:30' AS offset_text, {O.ts_text('ts + INTERVAL 330 MINUTE')} AS local_time, {O.ts_text('ts')} AS"
    " back FROM events",
)
def _(spark, sf):
    e = D.table(spark, sf, "events")
    local = e.withColumn("local_time", C.to_local("ts", "Asia/Kolkata"))
    return local.select(
        "event_id", C.utc_offset_text("ts", "Asia/Kolkata").alias("offset_text"), "local_time",
        C.to_utc("local_time", "Asia/Kolkata").alias("back"),
    )


# --------------------------------------------------------------------------- symbols


@query(
    "fn23_parse_occ_symbol",
    f"SELECT optionID, underlying AS root, '2024-01-19' AS expiry, substr(optionID, 13, 1) AS put_call, cast(substr(optionID, 14)"
    f" AS double) / 1000 AS strike, optionID AS rebuilt FROM ({MASTER}) m",
)
def _(spark, sf):
    m = D.derived(spark, sf, D.OPTION_MASTER).select("optionID", Y.parse_occ_symbol("optionID").alias("p")).select("optionID", "p.*")
    return m.withColumn("rebuilt", Y.build_occ_symbol("root", "expiry", "put_call", "strike"))


_STRIKE = "cast(substr(optionID, 14) AS int)"


@query(
    "fn24_normalise_option_master",
    "SELECT optionID, concat(underlying, '_011924', substr(optionID, 13, 1), cast(x // 1000 AS varchar), CASE WHEN x % 1000 = 0"
    f" THEN '' ELSE '.5' END) AS symbol FROM (SELECT *, {_STRIKE} AS x FROM ({MASTER}) m) n",
)
def _(spark, sf):
    return U.normalise_option_master(D.derived(spark, sf, D.OPTION_MASTER)).select("optionID", "symbol")


@query(
    "fn25_adapt_symbol",
    f"SELECT Issue_Name, CASE WHEN Primary_Listing_Mkt = 'U' THEN concat('$', replace(Symbol, ' ', '.')) ELSE replace(Symbol, ' ',"
    f" '.') END AS symbol FROM ({EQUITIES}) e",
)
def _(spark, sf):
    e = D.derived(spark, sf, D.EQUITY_MASTER)
    return e.select("Issue_Name", Y.adapt_symbol("Symbol", F.col("Primary_Listing_Mkt") == "U").alias("symbol"))


_OPTS = f"SELECT DISTINCT underlying AS symbol FROM ({MASTER}) m WHERE test_issue_flag = 'N'"
_EQS = f"SELECT DISTINCT Symbol AS symbol FROM ({EQUITIES}) e WHERE test_issue_flag = 'N'"


def options(spark, sf):
    return U.option_underlyings(D.derived(spark, sf, D.OPTION_MASTER))


def equities(spark, sf, **kw):
    return U.equity_universe(D.derived(spark, sf, D.EQUITY_MASTER), adapt=False, **kw)


@query("set3_index_options", f"SELECT concat('$', replace(symbol, ' ', '.')) AS symbol FROM ({_OPTS} EXCEPT {_EQS}) x")
def _(spark, sf):
    return U.index_options(options(spark, sf), equities(spark, sf))


@query("set4_equity_options", f"SELECT replace(symbol, ' ', '.') AS symbol FROM ({_OPTS} INTERSECT {_EQS}) x")
def _(spark, sf):
    return U.equity_options(options(spark, sf), equities(spark, sf))


@query(
    "set5_option_universe",
    f"SELECT * FROM (SELECT CASE WHEN e.symbol IS NULL THEN concat('$', o.symbol) ELSE o.symbol END AS symbol FROM ({_OPTS}) o LEFT"
    f" JOIN ({_EQS}) e ON o.symbol = e.symbol) x WHERE symbol NOT IN ('P7', '$P161')",
)
def _(spark, sf):
    return U.option_universe(options(spark, sf), equities(spark, sf), blocked=("P7", "$P161"))


@query(
    "set6_equity_universe",
    f"SELECT DISTINCT replace(Symbol, ' ', '.') AS symbol FROM ({EQUITIES}) e WHERE test_issue_flag = 'N' AND"
    " Primary_Listing_Mkt <> 'U'",
)
def _(spark, sf):
    return U.equity_universe(D.derived(spark, sf, D.EQUITY_MASTER), drop_otc=True)


@query("set8_add_symbols", f"SELECT DISTINCT symbol FROM (SELECT * FROM ({_OPTS}) o UNION ALL SELECT * FROM ({_EQS}) e) x")
def _(spark, sf):
    return U.add_symbols(options(spark, sf), equities(spark, sf))


@query(
    "set8_remove_symbols",
    f"SELECT symbol, symbol IN (SELECT symbol FROM ({_EQS}) e) AS removed FROM ({_OPTS}) o",
)
def _(spark, sf):
    kept, gone = U.remove_symbols(options(spark, sf), equities(spark, sf))
    return kept.withColumn("removed", F.lit(False)).union(gone.withColumn("removed", F.lit(True)))


@query("join11_missing_symbols", f"SELECT symbol FROM ({_OPTS} EXCEPT {_EQS}) x")
def _(spark, sf):
    return U.missing_symbols(options(spark, sf), equities(spark, sf))


_IDS = "SELECT concat(lpad(cast(c_custkey % 977 AS string), 3, '0'), c_mktsegment) AS symbol FROM {customer}"


@query(
    "win9_chunk_symbols",
    "SELECT symbol, rn AS position, CAST(ceil(rn / ceil(n / 7.0)) AS bigint) AS chunk FROM (SELECT symbol, row_number() OVER (ORDER BY"
    f" symbol) AS rn, count(*) OVER () AS n FROM (SELECT DISTINCT symbol FROM ({D.oracle_text(_IDS)}) s) d) x",
)
def _(spark, sf):
    return U.chunk_symbols(D.derived(spark, sf, _IDS), 7).select("symbol", "position", "chunk")


@query("top3_head_symbols", f"SELECT symbol FROM ({_EQS}) e ORDER BY symbol LIMIT 60")
def _(spark, sf):
    return U.head_symbols(equities(spark, sf), accounts=3, per_account=20)
