"""Bar, portfolio and request-rate queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from optiontide.functions import orders as FO
from optiontide.operators import bars as B
from optiontide.operators import capacity as Q
from optiontide.operators import portfolio as PF
from optiontide.operators import ranking as RK
from optiontide.operators import schedule as S
from optiontide.operators import tables as TB
from optiontide.plans import derived as D
from optiontide.plans import oracle_sql as O
from optiontide.plans.registry import query, rounded
from optiontide.session import run_dir
from optiontide.sources import sinks as SK
from optiontide.streaming import job as J
from optiontide.streaming.rates import trailing_rate_stream

BARS = D.oracle_text(D.BARS)
QUOTES = D.oracle_text(D.QUOTES)
POSITIONS = D.oracle_text(D.POSITIONS)
REQUESTS = D.oracle_text(D.REQUESTS)


def bars(spark, sf):
    return D.derived(spark, sf, D.BARS)


def positions(spark, sf):
    return D.derived(spark, sf, D.POSITIONS)


def quotes(spark, sf):
    rows = B.last_rows(bars(spark, sf), tie=["event_id"])
    return rows.select("symbol", F.col("close").alias("lastPrice"), "ts")


# --------------------------------------------------------------------------- bars


@query(
    "prj9_flatten_candles",
    f"SELECT concat('P', cast(l_partkey AS varchar)) AS symbol, {O.ts_text('l_shipdate + INTERVAL 1 DAY * k')} AS ts,"
    " l_extendedprice + k AS open, l_extendedprice + 2 * k AS close, l_extendedprice + 3 * k AS high, l_extendedprice - k AS"
    " low, CAST(l_quantity AS bigint) AS volume FROM lineitem, (VALUES (0), (1)) v(k)",
)
def _(spark, sf):
    li = D.table(spark, sf, "lineitem")

    def candle(k):
        return F.struct(
            (F.col("l_extendedprice") + k).alias("open"), (F.col("l_extendedprice") + 2 * k).alias("close"),
            (F.col("l_extendedprice") + 3 * k).alias("high"), (F.col("l_extendedprice") - k).alias("low"),
            F.col("l_quantity").cast("bigint").alias("volume"),
            (F.unix_millis(F.col("l_shipdate")) + 86400000 * k).alias("datetime"),
        )

    history = li.select(
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("symbol"), F.array(candle(0), candle(1)).alias("candles")
    )
    return B.flatten_candles(history)


@query(
    "win1_daily_returns",
    "SELECT event_id, symbol, round(close / lag(close) OVER (PARTITION BY symbol ORDER BY ts, event_id) - 1, 8) + 0.0 AS ret FROM"
    f" ({BARS}) b",
)
def _(spark, sf):
    out = B.daily_returns(bars(spark, sf), tie=["event_id"])
    return rounded(out.select("event_id", "symbol", "ret"), 8, "ret")


@query(
    "win2_group_stat",
    "SELECT event_id, round(avg(close) OVER w, 6) AS mean, round(stddev_samp(close) OVER w, 6) AS sd FROM"
    f" ({BARS}) b WINDOW w AS (PARTITION BY symbol)",
)
def _(spark, sf):
    out = B.group_stat(bars(spark, sf), "close", {"mean": "mean", "sd": "std"})
    return rounded(out.select("event_id", "mean", "sd"), 6, "mean", "sd")


def _frame(n: int, fn: str, digits: int = 6) -> str:
    w = f"(PARTITION BY symbol ORDER BY ts, event_id ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count(close) OVER {w} >= {n} THEN round({fn}(close) OVER {w}, {digits}) + 0.0 END"


@query(
    "win3_rolling",
    f"SELECT event_id, symbol, {_frame(20, 'avg')} AS mean20, {_frame(5, 'sum')} AS sum5, {_frame(50, 'min')} AS min50,"
    f" {_frame(50, 'max')} AS max50, {_frame(20, 'stddev_samp')} AS std20, {_frame(20, '0.000000123::double + var_samp', 5)} AS var20,"
    f" {_frame(9, 'median')} AS median9 FROM ({BARS}) b",
)
def _(spark, sf):
    wanted = {
        "mean20": ("close", 20, "mean"), "sum5": ("close", 5, "sum"), "min50": ("close", 50, "min"),
        "max50": ("close", 50, "max"), "std20": ("close", 20, "std"), "var20": ("close", 20, "var"),
        "median9": ("close", 9, "median"),
    }
    out = B.rolling_many(bars(spark, sf), wanted, tie=["event_id"]).select("event_id", "symbol", *wanted)
    # variances of prices in cents can end in a 5: moved off the tie before rounding
    out = out.withColumn("var20", F.col("var20") + 0.000000123)
    return rounded(rounded(out, 6, *[n for n in wanted if n != "var20"]), 5, "var20")


@query("win4_last_rows", f"SELECT symbol, lastPrice AS close, {O.ts_text('ts')} AS ts FROM ({QUOTES}) q")
def _(spark, sf):
    return B.last_rows(bars(spark, sf), tie=["event_id"]).select("symbol", "close", "ts")


@query(
    "win5_bar_ago",
    "SELECT symbol, event_id, close FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC, event_id DESC) AS rn"
    f" FROM ({BARS}) b) x WHERE rn = 7",
)
def _(spark, sf):
    return B.bar_ago(bars(spark, sf), 7, tie=["event_id"]).select("symbol", "event_id", "close")


@query("win5_current_bar", f"SELECT symbol, event_id, close FROM ({BARS}) b WHERE symbol = 'U1' ORDER BY ts DESC, event_id DESC LIMIT 1")
def _(spark, sf):
    return B.current_bar(bars(spark, sf), "U1", tie=["event_id"]).select("symbol", "event_id", "close")


RULES = {
    "close": {"buy": 60.0, "buy_operator": "lt", "sell": 150.0, "sell_operator": "gt"},
    "close_comp_mean5": {"buy_operator": "gt", "sell_operator": "lt"},
}
_LAST = (
    f"SELECT * FROM (SELECT symbol, close, {_frame(5, 'avg', 12)} AS mean5, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC,"
    f" event_id DESC) AS rn FROM ({BARS}) b) x WHERE rn = 1"
)
_SIGNALS = (
    f"WITH last AS ({_LAST}) SELECT symbol, 'buy' AS side, 'close' AS rule FROM last WHERE close < 60 UNION ALL SELECT symbol,"
    " 'sell', 'close' FROM last WHERE close > 150 UNION ALL SELECT symbol, 'buy', 'close_comp_mean5' FROM last WHERE close > mean5"
    " UNION ALL SELECT symbol, 'sell', 'close_comp_mean5' FROM last WHERE close < mean5"
)


def last_with_mean(spark, sf):
    return B.last_rolled(bars(spark, sf), {"mean5": ("close", 5, "mean")}, tie=["event_id"])


@query("win6_check_signals", _SIGNALS)
def _(spark, sf):
    return B.check_signals(last_with_mean(spark, sf), RULES)


@query(
    "win6_check_signals_all",
    f"WITH last AS ({_LAST}) SELECT symbol, 'buy' AS side, 'all' AS rule FROM last WHERE close < 60 AND close > mean5 UNION ALL"
    " SELECT symbol, 'sell', 'all' FROM last WHERE close > 150 AND close < mean5",
)
def _(spark, sf):
    return B.check_signals(last_with_mean(spark, sf), RULES, combine="all")


_CANDLES = (
    "SELECT symbol, period, arg_min(close, (ts, event_id)) AS open, max(close) AS high, min(close) AS low, arg_max(close, (ts,"
    " event_id)) AS close, CAST(sum(volume) AS bigint) AS volume FROM (SELECT *, {period} AS period FROM ("
    + BARS + ") b) x GROUP BY symbol, period"
)


def _candles_sql(period: str) -> str:
    return f"SELECT * REPLACE ({O.ts_text('period')} AS period) FROM ({_CANDLES.format(period=period)}) c"


@query("win7_ohlcv_minute30", _candles_sql("time_bucket(INTERVAL 30 MINUTE, ts)"))
def _(spark, sf):
    return B.ohlcv(bars(spark, sf), "minute30", tie=["event_id"])


@query("win7_ohlcv_daily", _candles_sql("date_trunc('day', ts)::timestamp"))
def _(spark, sf):
    return B.ohlcv(bars(spark, sf), "daily", tie=["event_id"])


@query("win7_ohlcv_weekly", _candles_sql("date_trunc('week', ts)::timestamp"))
def _(spark, sf):
    return B.ohlcv(bars(spark, sf), "weekly", tie=["event_id"])


@query("win7_ohlcv_monthly", _candles_sql("date_trunc('month', ts)::timestamp"))
def _(spark, sf):
    return B.ohlcv(bars(spark, sf), "monthly", tie=["event_id"])


def _history_sql(where: str, candle: str, low: str, extra: str = "") -> str:
    ticks = f"SELECT symbol, ts, event_id, close, volume FROM ({BARS}) b"
    return (
        f"WITH t AS ({ticks}), p AS (SELECT symbol, max_by(close, struct_pack(a := ts, b := event_id)) AS previous_close FROM t WHERE ts < {low} GROUP BY 1),"
        f" c AS (SELECT symbol, {candle} AS period, min_by(close, struct_pack(a := t.ts, b := event_id)) AS open, min(close) AS low, max(close) AS high,"
        f" max_by(close, struct_pack(a := t.ts, b := event_id)) AS close, sum(volume)::bigint AS volume FROM t WHERE {where} GROUP BY 1, 2)"
        f" SELECT c.symbol, {O.ts_text('c.period')} AS period, open, low, high, close, volume, previous_close FROM c LEFT JOIN p USING (symbol)"
    )


def _weekdays(spark, sf):
    """Sessions of every weekday of the events from 14:30 to 21:00."""
    days = S.calendar_days(D.table(spark, sf, "events"), "ts").filter("weekday(day) < 5")
    return days.select(F.col("day").alias("iso_date"), *[
        F.to_timestamp(F.concat(F.col("day").cast("string"), F.lit(c))).alias(n)
        for n, c in (("market_open", " 14:30:00"), ("market_close", " 21:00:00"), ("index_close", " 21:15:00"))])


@query("win7_history_month", _history_sql("ts >= timestamp '2023-12-19' AND ts <= timestamp '2024-01-19 21:00:00'",
                                          "date_trunc('day', ts)::timestamp", "timestamp '2023-12-19'"))
def _(spark, sf):
    return B.price_history(bars(spark, sf), _weekdays(spark, sf), "month", 1, "daily", as_of="2024-01-22", tie=["event_id"])


@query("win7_history_two_sessions", _history_sql(
    "ts >= timestamp '2024-01-18' AND ts <= timestamp '2024-01-19 21:00:00' AND ts::time >= time '14:30:00' AND ts::time < time '21:00:00'",
    "time_bucket(INTERVAL 30 MINUTE, ts)", "timestamp '2024-01-18'"))
def _(spark, sf):
    return B.price_history(bars(spark, sf), _weekdays(spark, sf), "day", 2, "minute30", as_of="2024-01-22", extended=False, tie=["event_id"])


@query("win7_history_between", _history_sql("ts >= timestamp '2024-01-05 06:00:00' AND ts <= timestamp '2024-01-25'",
                                            "date_trunc('week', ts)::timestamp", "timestamp '2024-01-05 06:00:00'"))
def _(spark, sf):
    return B.price_history(bars(spark, sf), _weekdays(spark, sf), "month", start="2024-01-05 06:00:00", end="2024-01-25", tie=["event_id"])


@query("win7_history_ytd", _history_sql("ts >= timestamp '2024-01-01' AND ts <= timestamp '2024-01-19 21:00:00'",
                                        "date_trunc('week', ts)::timestamp", "timestamp '2024-01-01'"))
def _(spark, sf):
    return B.price_history(bars(spark, sf), _weekdays(spark, sf), "ytd", as_of="2024-01-22", tie=["event_id"])


@query(
    "win12_latest_per_key",
    "SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate"
    " DESC, o_orderkey DESC) AS rn FROM orders) x WHERE rn = 1",
)
def _(spark, sf):
    o = D.table(spark, sf, "orders")
    return TB.latest_per_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


# hourly bars, of which the second half of the month is sent again at twice the price
_HOURLY = _CANDLES.format(period="date_trunc('hour', ts)")


@query(
    "set7_upsert_bars",
    f"SELECT symbol, {O.ts_text('period')} AS ts, CASE WHEN day(period) >= 16 THEN 2 * close ELSE close END AS close,"
    f" volume FROM ({_HOURLY}) c",
)
def _(spark, sf):
    hourly = (
        bars(spark, sf).groupBy("symbol", F.date_trunc("hour", "ts").alias("hour"))
        .agg(F.max_by("close", F.struct("ts", "event_id")).alias("close"), F.sum("volume").alias("volume"))
        .withColumnRenamed("hour", "ts")
    )
    again = hourly.filter(F.day("ts") >= 16).withColumn("close", 2 * F.col("close"))
    stale = hourly.filter(F.day("ts") < 20)
    return B.upsert_bars(stale, again)


@query(
    "snk3_upsert",
    "SELECT o_orderkey AS order_id, coalesce(l.price, o_totalprice) AS price FROM orders LEFT JOIN (SELECT l_orderkey,"
    " l_extendedprice AS price FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC,"
    " l_extendedprice DESC) AS rn FROM lineitem WHERE l_returnflag = 'R') x WHERE rn = 1) l ON l.l_orderkey = o_orderkey",
)
def _(spark, sf):
    target = D.table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("price"), F.lit(0).alias("line"))
    staging = D.table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_extendedprice").alias("price"), F.col("l_linenumber").alias("line")
    )
    return TB.upsert(staging, target, ["order_id"], ["line", "price"]).select("order_id", "price")


# --------------------------------------------------------------------------- portfolio

_VALUE = (
    "SELECT p.symbol, p.asset_type, CAST(p.quantity AS bigint) AS quantity, p.purchase_price, q.lastPrice AS current_price,"
    " p.purchase_price <= q.lastPrice AS is_profitable, round(q.lastPrice * p.quantity, 6) AS total_market_value,"
    " round(p.quantity * p.purchase_price, 6) AS total_invested_capital, round((q.lastPrice - p.purchase_price) * p.quantity, 6)"
    " AS total_loss_or_gain, round((q.lastPrice - p.purchase_price) / p.purchase_price, 4) AS total_loss_or_gain_pct FROM"
    f" ({POSITIONS}) p JOIN ({QUOTES}) q ON p.symbol = q.symbol"
)


@query("join9_mark_positions", f"SELECT p.symbol, p.purchase_price, q.lastPrice AS current_price FROM ({POSITIONS}) p JOIN ({QUOTES}) q ON p.symbol = q.symbol")
def _(spark, sf):
    return PF.mark_positions(positions(spark, sf), quotes(spark, sf)).select("symbol", "purchase_price", "current_price")


@query("agg3_market_value", _VALUE)
def _(spark, sf):
    out = PF.market_value(positions(spark, sf), quotes(spark, sf))
    return rounded(out, 6, "total_market_value", "total_invested_capital", "total_loss_or_gain")


@query(
    "agg3_market_value_totals",
    "SELECT round(sum(total_market_value), 4) AS total_market_value, round(sum(total_invested_capital), 4) AS"
    " total_invested_capital, round(sum(total_loss_or_gain), 4) AS total_profit_or_loss, count(CASE WHEN total_loss_or_gain > 0"
    " THEN 1 END) AS number_of_profitable_positions, count(CASE WHEN total_loss_or_gain < 0 THEN 1 END) AS"
    " number_of_non_profitable_positions, count(CASE WHEN total_loss_or_gain = 0 THEN 1 END) AS number_of_breakeven_positions,"
    f" (SELECT count(*) FROM ({POSITIONS}) p) AS total_positions FROM ({_VALUE}) v",
)
def _(spark, sf):
    out = PF.market_value_totals(positions(spark, sf), quotes(spark, sf))
    return rounded(out, 4, "total_market_value", "total_invested_capital", "total_profit_or_loss")


@query("fn27_is_profitable", f"SELECT symbol, is_profitable FROM ({_VALUE}) v")
def _(spark, sf):
    marked = PF.mark_positions(positions(spark, sf), quotes(spark, sf))
    return marked.select("symbol", FO.is_profitable("current_price", "purchase_price").alias("is_profitable"))


@query(
    "agg4_allocation",
    "SELECT asset_type, count(*) AS positions, CAST(sum(quantity) AS bigint) AS quantity, round(sum(quantity * purchase_price), 4)"
    f" AS invested_capital FROM ({POSITIONS}) p GROUP BY 1",
)
def _(spark, sf):
    return rounded(PF.allocation(positions(spark, sf)), 4, "invested_capital")


_WEIGHTS = f"SELECT symbol, total_market_value / sum(total_market_value) OVER () AS weight FROM ({_VALUE}) v"


@query("agg5_weights", f"SELECT symbol, round(weight, 9) AS weight FROM ({_WEIGHTS}) w")
def _(spark, sf):
    return rounded(PF.weights(positions(spark, sf), quotes(spark, sf)), 9, "weight")


# closes of hourly bars on a common clock, raised by 100 so that returns stay small
_RETURNS = (
    "SELECT symbol, period AS ts, price / lag(price) OVER (PARTITION BY symbol ORDER BY period) - 1 AS ret FROM (SELECT symbol,"
    f" period, close + 100 AS price FROM ({_HOURLY}) h) r"
)


def returns(spark, sf):
    hourly = (
        bars(spark, sf).groupBy("symbol", F.date_trunc("hour", "ts").alias("hour"))
        .agg((F.max_by("close", F.struct("ts", "event_id")) + 100).alias("close"))
        .withColumnRenamed("hour", "ts")
    )
    return B.daily_returns(hourly)


@query(
    "agg6_return_stats",
    "SELECT symbol, round(avg(ret), 8) AS average_returns, round(stddev_samp(ret), 8) AS standard_deviation_of_returns,"
    f" round(var_samp(ret), 8) AS variance_of_returns, count(ret) AS observations FROM ({_RETURNS}) r GROUP BY 1",
)
def _(spark, sf):
    out = PF.return_stats(returns(spark, sf))
    return rounded(out, 8, "average_returns", "standard_deviation_of_returns", "variance_of_returns")


_COV = (
    "SELECT a.symbol AS symbol_a, b.symbol AS symbol_b, count(*) AS n, covar_samp(a.ret, b.ret) AS cov FROM r a JOIN r b ON a.ts ="
    " b.ts WHERE a.ret IS NOT NULL AND b.ret IS NOT NULL GROUP BY 1, 2"
)


@query("agg7_return_covariance", f"WITH r AS ({_RETURNS}) SELECT symbol_a, symbol_b, n, round(cov, 8) + 0.0 AS cov FROM ({_COV}) c")
def _(spark, sf):
    return rounded(PF.return_covariance(returns(spark, sf)), 8, "cov")


_VARIANCE = (
    f"SELECT sum(wa.weight * wb.weight * cov) AS variance FROM ({_COV}) c JOIN w wa ON wa.symbol = symbol_a JOIN w wb ON wb.symbol ="
    " symbol_b"
)


@query("agg8_portfolio_variance", f"WITH r AS ({_RETURNS}), w AS ({_WEIGHTS}) SELECT round(variance, 8) AS variance FROM ({_VARIANCE}) v")
def _(spark, sf):
    w = PF.weights(positions(spark, sf), quotes(spark, sf))
    return rounded(PF.portfolio_variance(w, PF.return_covariance(returns(spark, sf))), 8, "variance")


@query(
    "agg9_portfolio_metrics",
    f"WITH r AS ({_RETURNS}), w AS ({_WEIGHTS}) SELECT w.symbol, round(avg(ret), 8) AS average_returns, round(stddev_samp(ret), 8)"
    " AS standard_deviation_of_returns, round(var_samp(ret), 8) AS variance_of_returns, round(max(weight), 8) AS weight,"
    " round(avg(ret) * max(weight), 8) + 0.0 AS weighted_returns, (SELECT round(variance, 8) FROM (" + _VARIANCE + ") v) AS"
    " portfolio_variance FROM r JOIN w ON r.symbol = w.symbol GROUP BY 1",
)
def _(spark, sf):
    out = PF.portfolio_metrics(positions(spark, sf), quotes(spark, sf), returns(spark, sf))
    return rounded(out, 8, *[c for c in out.columns if c != "symbol"])


@query(
    "agg9_portfolio_summary",
    f"SELECT v.symbol, v.total_market_value, round(w.weight, 9) AS weight FROM ({_VALUE}) v JOIN ({_WEIGHTS}) w ON v.symbol = w.symbol",
)
def _(spark, sf):
    out = PF.portfolio_summary(positions(spark, sf), quotes(spark, sf)).select("symbol", "total_market_value", "weight")
    return rounded(rounded(out, 6, "total_market_value"), 9, "weight")


_TRADES = (
    "SELECT concat('U', cast(s_suppkey % 15 AS string)) AS symbol, CASE WHEN s_suppkey % 2 = 0 THEN 'buy' ELSE 'sell' END AS side,"
    " max(s_suppkey) AS trade_id FROM {supplier} GROUP BY 1, 2"
)


@query(
    "join10_signals_to_orders",
    f"SELECT DISTINCT s.symbol, s.side, t.trade_id, s.side = 'buy' AS ownership_after FROM ({_SIGNALS}) s JOIN"
    f" ({D.oracle_text(_TRADES)}) t ON s.symbol = t.symbol AND s.side = t.side",
)
def _(spark, sf):
    signals = B.check_signals(last_with_mean(spark, sf), RULES)
    return PF.signals_to_orders(signals, D.derived(spark, sf, _TRADES))


@query(
    "join10_signals_exclusive_buys",
    f"WITH s AS (SELECT DISTINCT symbol, side FROM ({_SIGNALS}) x) SELECT s.symbol, s.side, t.trade_id, s.side = 'buy' AS"
    f" ownership_after FROM s JOIN ({D.oracle_text(_TRADES)}) t ON s.symbol = t.symbol AND s.side = t.side WHERE s.side = 'buy' OR"
    " NOT EXISTS (SELECT 1 FROM s WHERE side = 'buy')",
)
def _(spark, sf):
    signals = B.check_signals(last_with_mean(spark, sf), RULES)
    return PF.signals_to_orders(signals, D.derived(spark, sf, _TRADES), exclusive_buys=True)


_HELD = f"SELECT symbol, quantity, purchase_price, asset_type, symbol <> 'U4' AS ownership_status FROM ({POSITIONS}) p"
_NEW = (
    "SELECT concat(CASE WHEN c_custkey % 25 > 9 THEN 'U' ELSE 'W' END, cast(c_custkey % 25 AS string)) AS symbol, cast(c_nationkey AS bigint) AS quantity, cast(NULL AS double) AS"
    " purchase_price, 'equity' AS asset_type, CASE WHEN c_nationkey % 2 = 0 THEN '2024-01-31' END AS purchase_date, c_custkey FROM"
    " {customer}"
)


def held(spark, sf):
    return positions(spark, sf).withColumn("ownership_status", F.col("symbol") != "U4")


@query(
    "set9_upsert_positions",
    f"WITH n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY c_custkey DESC) AS rn FROM"
    f" ({D.oracle_text(_NEW)}) n0) n1 WHERE rn = 1) SELECT symbol, quantity, 0.0::double AS purchase_price, purchase_date IS NOT NULL"
    f" AS ownership_status FROM n UNION ALL SELECT symbol, CAST(quantity AS bigint), purchase_price, ownership_status FROM ({_HELD})"
    " h WHERE symbol NOT IN (SELECT symbol FROM n)",
)
def _(spark, sf):
    out = PF.upsert_positions(held(spark, sf), D.derived(spark, sf, _NEW), order=["c_custkey"])
    return out.select("symbol", "quantity", "purchase_price", "ownership_status")


_ASKED = "SELECT DISTINCT concat(CASE WHEN c_custkey % 30 > 12 THEN 'U' ELSE 'V' END, cast(c_custkey % 30 AS string)) AS symbol FROM {customer}"


@query(
    "set9_remove_positions",
    f"SELECT symbol, symbol IN (SELECT symbol FROM ({POSITIONS}) p) AS removed, (SELECT count(*) FROM ({POSITIONS}) p WHERE symbol"
    f" NOT IN (SELECT symbol FROM ({D.oracle_text(_ASKED)}) a)) AS left_over FROM ({D.oracle_text(_ASKED)}) x",
)
def _(spark, sf):
    kept, outcome = PF.remove_positions(held(spark, sf), D.derived(spark, sf, _ASKED))
    return outcome.withColumn("left_over", kept.agg(F.count(F.lit(1))).scalar())


@query(
    "set9_set_ownership",
    f"SELECT symbol, CASE WHEN symbol IN (SELECT symbol FROM ({D.oracle_text(_ASKED)}) a) THEN false ELSE ownership_status END AS"
    f" ownership_status FROM ({_HELD}) h",
)
def _(spark, sf):
    changes = D.derived(spark, sf, _ASKED).withColumn("owned", F.lit(False))
    return PF.set_ownership(held(spark, sf), changes).select("symbol", "ownership_status")


@query(
    "flt10_in_portfolio",
    f"SELECT a.symbol, h.symbol IS NOT NULL AS in_portfolio, coalesce(h.ownership_status, false) AS owned FROM"
    f" ({D.oracle_text(_ASKED)}) a LEFT JOIN ({_HELD}) h ON a.symbol = h.symbol",
)
def _(spark, sf):
    return PF.in_portfolio(held(spark, sf), D.derived(spark, sf, _ASKED))


def _tick(expr: str) -> str:
    return f"CAST(CASE WHEN {expr} < 1 THEN round({expr}, 4) ELSE round({expr}, 2) END AS double)"




@query(
    "fn26_bracket_prices",
    f"SELECT l_orderkey, l_linenumber, {_tick('p * 1.1000')} AS take_profit_price, {_tick('(p - 0.3500)')} AS stop_price,"
    f" {_tick('p * 0.9750')} AS limit_price FROM (SELECT l_orderkey, l_linenumber, round(CAST(l_extendedprice AS decimal(18,4)) /"
    " 1, 2)::decimal(14,2) AS p FROM lineitem) x",
)
def _(spark, sf):
    li = D.table(spark, sf, "lineitem")
    prices = FO.bracket_prices("l_extendedprice", 0.1, 0.35, 0.025, profit_percent=True, limit_percent=True)
    return li.select("l_orderkey", "l_linenumber", *[c.alias(n) for n, c in prices.items()])


_DAYQUOTES = (
    "SELECT concat('C', cast(c_custkey AS string)) AS symbol, c_mktsegment AS universe, cast(c_custkey * 7919 % 100003 AS bigint) AS"
    " volume, cast(c_custkey * 31 % 977 AS bigint) AS trades, c_acctbal / 10000 AS"
    " pct_change, c_acctbal / 10000 - cast(c_custkey % 7 AS double) / 4 AS pct_change_30m FROM {customer}"
)


def _movers_sql(order: str) -> str:
    return (
        f"SELECT * FROM (SELECT symbol, universe, row_number() OVER (PARTITION BY universe ORDER BY {order}, symbol) AS rank FROM"
        f" ({D.oracle_text(_DAYQUOTES)}) q) x WHERE rank <= 10"
    )


@query("top1_movers_volume", _movers_sql("volume DESC"))
def _(spark, sf):
    return RK.movers(D.derived(spark, sf, _DAYQUOTES), "VOLUME").select("symbol", "universe", "rank")


@query("top1_movers_percent_down", _movers_sql("pct_change_30m"))
def _(spark, sf):
    return RK.movers(D.derived(spark, sf, _DAYQUOTES), "PERCENT_CHANGE_DOWN", frequency=30).select("symbol", "universe", "rank")


# --------------------------------------------------------------------------- request rates

# five requests an event, so that the busiest minute of a client fills its limit
_BURST = (
    "SELECT client, event_id * 5 + k AS request_id, ts + k * INTERVAL '7' SECOND AS ts FROM (SELECT client, event_id, ts FROM ("
    + REQUESTS + ") r0) r, (VALUES (0), (1), (2), (3), (4)) v(k)"
)
_LIMITS = "SELECT DISTINCT user_id % 8 AS client, cast(2 + user_id % 8 AS int) AS \"limit\", cast(user_id % 8 % 3 AS int) AS queued FROM events"


def requests(spark, sf):
    r = D.derived(spark, sf, D.REQUESTS)
    return r.select("client", F.posexplode(F.transform(
        F.array(*[F.lit(k * 7) for k in range(5)]), lambda s: F.col("ts") + F.make_interval(secs=s)
    )).alias("k", "ts"), "event_id")


def limits(spark, sf):
    c = (F.col("user_id") % 8)
    return D.table(spark, sf, "events").select(
        c.alias("client"), (c + 2).cast("int").alias("limit"), (c % 3).cast("int").alias("queued")
    ).distinct()


def as_of(r):
    return r.agg(F.max("ts") - F.make_interval(secs=F.lit(14))).scalar()


_NOW = "now AS (SELECT max(ts) - INTERVAL '14' SECOND AS at_ FROM b)"
_RECENT = "recent AS (SELECT b.* FROM b, now WHERE ts >= at_ - INTERVAL '60' SECOND)"


@query("agg10_requests_last_60s", f"WITH b AS ({_BURST}), {_NOW}, {_RECENT} SELECT client, count(*) AS used FROM recent GROUP BY 1")
def _(spark, sf):
    r = requests(spark, sf)
    return Q.requests_last_60s(r, as_of(r))


_STATE = (
    f"WITH b AS ({_BURST}), {_NOW}, {_RECENT}, l AS ({_LIMITS}), u AS (SELECT l.*, (SELECT count(*) FROM recent r WHERE r.client ="
    " l.client) AS used, (SELECT min(ts) FROM recent r WHERE r.client = l.client) AS oldest FROM l), state AS (SELECT client,"
    " \"limit\", queued, used, greatest(\"limit\" - used, 0) AS capacity, CASE WHEN \"limit\" - used > 0 THEN at_ ELSE oldest + INTERVAL"
    " '60' SECOND END AS next_ts, at_ FROM u, now)"
)


@query(
    "agg10_capacity",
    f"{_STATE} SELECT client, \"limit\", queued, used, greatest(\"limit\" - used - queued, 0) AS capacity FROM state",
)
def _(spark, sf):
    r = requests(spark, sf)
    return Q.capacity(Q.requests_last_60s(r, as_of(r)), limits(spark, sf), include_queued=True)


@query(
    "agg11_capacity_summary",
    f"{_STATE} SELECT client, CAST(sum(used) AS bigint) AS used, CAST(sum(queued) AS bigint) AS queued, CAST(sum(capacity) AS"
    " bigint) AS capacity, bool_or(capacity > 0) AS has_capacity, bool_and(capacity <= 0) AS no_capacity,"
    f" {O.ts_text('min(next_ts)')} AS next_ts, round(min(greatest(epoch(next_ts) - epoch(at_), 0)), 4) AS min_wait FROM state GROUP"
    " BY ROLLUP (client)",
)
def _(spark, sf):
    r = requests(spark, sf)
    return rounded(Q.capacity_summary(r, limits(spark, sf), as_of(r)), 4, "min_wait")


@query(
    "win10_project_schedule",
    f"{_STATE} SELECT client, {O.ts_text('next_ts')} AS next_ts, \"limit\" - (SELECT count(*) FROM recent r WHERE r.client ="
    " state.client AND r.ts >= state.next_ts - INTERVAL '60' SECOND) AS projected_capacity, row_number() OVER (ORDER BY next_ts,"
    " client) AS position FROM state",
)
def _(spark, sf):
    r = requests(spark, sf)
    return Q.project_schedule(r, limits(spark, sf), as_of(r))


@query(
    "win11_trailing_request_rate",
    f"SELECT client, {O.ts_text('ts')} AS ts, count(*) OVER (PARTITION BY client ORDER BY ts RANGE BETWEEN INTERVAL '60' SECOND"
    f" PRECEDING AND CURRENT ROW) AS rate FROM ({_BURST}) b",
)
def _(spark, sf):
    return Q.trailing_request_rate(requests(spark, sf)).select("client", "ts", "rate")


@query(
    "win11_trailing_rate_stream",
    f"SELECT client, {O.ts_text('ts')} AS ts, count(*) OVER (PARTITION BY client ORDER BY ts RANGE BETWEEN INTERVAL '60' SECOND"
    f" PRECEDING AND CURRENT ROW) AS rate FROM ({_BURST}) b",
)
def _(spark, sf):
    # Six slices of time arrive one after the other; a tenth of the rows comes a slice late. After three slices the query stops and goes on from
    # its checkpoint; a last request of a client of its own moves the watermark past the rest.
    # The rows are dealt to slices in one pass, and a slice lands as a file for each core, which one batch takes.
    dealt, landed, checkpoint, out = (run_dir(spark, n) for n in ("slices", "requests", "checkpoint", "rates"))
    rows = requests(spark, sf).select("client", F.col("ts").cast("timestamp").alias("ts"))
    lo, hi = rows.agg(F.unix_micros(F.min("ts")), F.unix_micros(F.max("ts"))).first()
    width = (hi - lo) // 6 + 1
    slice_ = F.floor((F.unix_micros("ts") - lo) / width) + F.when(F.xxhash64("client", "ts") % 10 == 0, 1).otherwise(0)
    rows.withColumn("slice", slice_).write.partitionBy("slice").parquet(dealt)
    files = spark.sparkContext.defaultParallelism
    end = spark.range(1).select(F.lit(None).cast(rows.schema["client"].dataType).alias("client"), F.timestamp_micros(F.lit(hi + 3 * width + 10**8)).alias("ts"))
    for k in range(8):
        part = end if k == 7 else spark.read.parquet(dealt).filter(F.col("slice") == k).drop("slice").repartition(files)
        part.write.mode("append").parquet(landed)
        if k in (2, 7):
            stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(landed)
            rates = trailing_rate_stream(stream, Q.WINDOW_SECONDS, f"{2 * width // 10**6 + 1} seconds")
            J.run_stream(rates, J.epoch_sink(out), checkpoint, trigger=None).awaitTermination()
    return SK.read_epochs(spark, out).select("client", "ts", "rate")


@query(
    "agg12_expected_requests",
    "SELECT CAST(l_shipdate AS date)::varchar AS day, CAST(floor(390.0 * sum(l_linenumber)) AS bigint) AS expected, CAST(count(*) //"
    " sum(l_linenumber) AS bigint) AS round_trip FROM lineitem GROUP BY 1",
)
def _(spark, sf):
    per_day = D.table(spark, sf, "lineitem").groupBy(F.to_date("l_shipdate").alias("day")).agg(
        F.sum("l_linenumber").alias("limit"), F.count(F.lit(1)).alias("symbols")
    )
    start = F.col("day").cast("timestamp") + F.make_interval(mins=F.lit(570))
    end = F.col("day").cast("timestamp") + F.make_interval(hours=F.lit(16))
    return per_day.select(
        "day", Q.expected_requests(start, end, F.col("limit")).alias("expected"),
        Q.round_trip_minutes(F.col("symbols"), F.col("limit")).alias("round_trip"),
    )
