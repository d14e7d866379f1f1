"""Chain, contract and pricing queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from optiontide.functions import calendar as C
from optiontide.functions import pricing as P
from optiontide.functions import rates as R
from optiontide.operators import chain as CH
from optiontide.operators import schedule as S
from optiontide.operators import sessions as SS
from optiontide.operators import tables as TB
from optiontide.plans import derived as D
from optiontide.plans import oracle_sql as O
from optiontide.plans.enrich import PARAMS, enrich_contracts, enrich_fetch_day, volatility_by_month
from optiontide.plans.registry import query, rounded
from optiontide.schemas import output_schema

CONTRACTS = D.oracle_text(D.CONTRACTS)
PAIRS = D.oracle_text(D.CONTRACT_PAIRS)
CURVE = {"beta0": 0.04, "beta1": -0.01, "beta2": 0.015, "beta3": 0.005, "tau1": 1.5, "tau2": 4.0}
NS_CURVE = {"beta0": 0.04, "beta1": -0.01, "beta2": 0.015, "tau": 1.5}


def contracts(spark, sf):
    return D.derived(spark, sf, D.CONTRACTS, wide=("lineitem",))


_FLAT = "symbol, putCall, strikePrice, expirationDate, exerciseType, mark, underlyingPrice, dividendAmount, isIndex"


@query("prj1_flatten_chain", f"SELECT {_FLAT} FROM ({PAIRS}) c")
def _(spark, sf):
    return CH.flatten_chain(D.chains(spark, sf)).select(*_FLAT.split(", "))


@query(
    "prj1_flatten_chain_keys",
    "SELECT substr(expirationDate, 1, 10) AS expiry_day, putCall, count(*) AS contracts, count(DISTINCT strikePrice)"
    f" AS strikes FROM ({PAIRS}) c GROUP BY ALL",
)
def _(spark, sf):
    rows = CH.flatten_chain(D.chains(spark, sf), keep_keys=True)
    return rows.groupBy(F.substring("expiryKey", 1, 10).alias("expiry_day"), "putCall").agg(
        F.count(F.lit(1)).alias("contracts"), F.countDistinct("strikeKey").alias("strikes")
    )


@query(
    "prj2_explode_deliverables",
    "SELECT symbol, CAST(0 AS integer) AS deliverablePos, ticker AS deliverableSymbol, 'EQUITY' AS deliverableAssetType,"
    f" 100.0::double AS deliverableUnits FROM ({CONTRACTS}) c WHERE NOT nonStandard UNION ALL"
    f" SELECT symbol, NULL, NULL, NULL, NULL FROM ({CONTRACTS}) c WHERE nonStandard",
)
def _(spark, sf):
    item = F.struct(F.col("ticker").alias("symbol"), F.lit("EQUITY").alias("assetType"), F.lit(100.0).alias("deliverableUnits"))
    listed = contracts(spark, sf).withColumn("optionDeliverablesList", F.when(~F.col("nonStandard"), F.array(item)))
    return CH.explode_deliverables(listed)


@query(
    "prj3_pack_extra",
    "SELECT symbol, CASE WHEN dividendAmount > 0 THEN '{\"daysToExpiration\":' || daysToExpiration ||"
    " ',\"isIndex\":' || isIndex || ',\"kind\":\"' || exerciseType || '\"}' ELSE '{\"daysToExpiration\":' ||"
    f" daysToExpiration || ',\"isIndex\":' || isIndex || '}}' END AS extra FROM ({CONTRACTS}) c",
)
def _(spark, sf):
    # a null column leaves no key behind
    c = contracts(spark, sf).withColumn("kind", F.when(F.col("dividendAmount") > 0, F.col("exerciseType")))
    return CH.pack_extra(c, ["daysToExpiration", "isIndex", "kind"]).select("symbol", "extra")


@query(
    "prj4_conform",
    "SELECT symbol, ticker, CAST(round(strikePrice, 2) AS double) AS strikePrice, CAST(round(underlyingPrice, 2) AS double)"
    f" AS underlyingPrice, daysToExpiration, {O.ts_text('fetchTime')} AS fetchTime FROM ({CONTRACTS}) c",
)
def _(spark, sf):
    c = contracts(spark, sf).withColumnRenamed("underlyingPrice", "spot")
    out = TB.conform(c, output_schema(), renames={"spot": "underlyingPrice"})
    return out.select("symbol", "ticker", "strikePrice", "underlyingPrice", "daysToExpiration", "fetchTime")


@query(
    "prj4_rename_retype",
    f"SELECT symbol AS contract, CAST(daysToExpiration AS bigint) AS days, strikePrice * 100 AS notional FROM ({CONTRACTS}) c",
)
def _(spark, sf):
    c = contracts(spark, sf).select("symbol", "daysToExpiration", "strikePrice")
    out = TB.rename_retype(
        c, {"symbol": "contract", "daysToExpiration": "days"}, {"days": "bigint"}, {"notional": F.col("strikePrice") * 100}
    )
    return out.drop("strikePrice")


# one chain in eleven failed, one in seven has no puts, one in thirteen null puts
_STATUS = "CASE WHEN l_orderkey % 11 = 0 THEN 'FAILED' WHEN l_orderkey % 17 = 0 THEN NULL ELSE 'SUCCESS' END"


@query(
    "flt1_valid_chains",
    f"SELECT CASE WHEN coalesce({_STATUS} = 'SUCCESS', false) AND l_orderkey % 7 <> 0 AND l_orderkey % 13 <> 0"
    f" THEN 'good' ELSE 'bad' END AS verdict, ticker AS symbol, count(*) AS chains FROM ({D.oracle_text(D.CHAIN_BASE)}) b"
    " GROUP BY ALL",
)
def _(spark, sf):
    puts = F.when(F.col("l_orderkey") % 13 == 0, None).when(
        F.col("l_orderkey") % 7 == 0, F.map_filter("putExpDateMap", lambda k, v: F.lit(False))
    ).otherwise(F.col("putExpDateMap"))
    c = D.chains(spark, sf).withColumn("status", F.expr(_STATUS)).withColumn("putExpDateMap", puts)
    good, bad = CH.valid_chains(c)
    both = good.withColumn("verdict", F.lit("good")).unionByName(bad.withColumn("verdict", F.lit("bad")))
    return both.groupBy("verdict", "symbol").agg(F.count(F.lit(1)).alias("chains"))


@query(
    "flt2_quarantine_symbols",
    f"SELECT DISTINCT ticker AS symbol FROM ({CONTRACTS}) c WHERE ticker NOT IN (SELECT concat('P', cast(l_partkey % 200"
    " AS string)) FROM lineitem WHERE l_quantity >= 50 AND l_linenumber <= 1)",
)
def _(spark, sf):
    universe = contracts(spark, sf).select(F.col("ticker").alias("symbol")).distinct()
    failures = D.table(spark, sf, "lineitem").filter("l_quantity >= 50").select(
        F.expr("concat('P', cast(l_partkey % 200 AS string))").alias("symbol"), F.col("l_linenumber").alias("round")
    )
    return CH.quarantine_symbols(universe, failures)


@query(
    "flt3_split_iv_eligible",
    "SELECT coalesce(mark > intrinsicValue, false) AS eligible, putCall, count(*) AS contracts FROM (SELECT * REPLACE"
    f" (CASE WHEN l_orderkey % 10 = 0 THEN NULL ELSE mark END AS mark) FROM ({CONTRACTS}) c) d GROUP BY ALL",
)
def _(spark, sf):
    c = contracts(spark, sf).withColumn("mark", F.when(F.col("l_orderkey") % 10 != 0, F.col("mark")))
    good, rest = CH.split_iv_eligible(c)
    both = CH.union_processed(good.withColumn("eligible", F.lit(True)), rest.withColumn("eligible", F.lit(False)))
    return both.groupBy("eligible", "putCall").agg(F.count(F.lit(1)).alias("contracts"))


@query(
    "flt4_filter_chain",
    "SELECT symbol, strikePrice, expirationDate, putCall FROM (" + CONTRACTS + ") c WHERE putCall = 'CALL' AND inTheMoney"
    " AND month(CAST(substr(expirationDate, 1, 10) AS date)) = 11 AND NOT nonStandard"
    " AND CAST(substr(expirationDate, 1, 10) AS date) BETWEEN date '2024-02-01' AND date '2025-10-31'",
)
def _(spark, sf):
    out = CH.filter_chain(
        contracts(spark, sf), "call", opt_range="itm", exp_month="nov", option_type="s",
        from_date="2024-02-01", to_date="2025-10-31",
    )
    return out.select("symbol", "strikePrice", "expirationDate", "putCall")


@query(
    "flt4_filter_chain_strike_count",
    f"WITH c AS ({CONTRACTS}), s AS (SELECT DISTINCT ticker, fetchTime, expirationDate, strikePrice, strikePrice >="
    " underlyingPrice AS above, abs(strikePrice - underlyingPrice) AS d FROM c), k AS (SELECT *, row_number() OVER"
    " (PARTITION BY ticker, fetchTime, expirationDate, above ORDER BY d, strikePrice) AS rn FROM s) SELECT symbol,"
    " strikePrice, expirationDate, putCall FROM c WHERE EXISTS (SELECT 1 FROM k WHERE k.ticker = c.ticker AND k.fetchTime"
    " = c.fetchTime AND k.expirationDate = c.expirationDate AND k.strikePrice = c.strikePrice AND rn <= 2)",
)
def _(spark, sf):
    out = CH.filter_chain(contracts(spark, sf), strike_count=2)
    return out.select("symbol", "strikePrice", "expirationDate", "putCall")


@query(
    "flt4_filter_chain_near",
    f"SELECT symbol, strikePrice, putCall FROM ({CONTRACTS}) c WHERE abs(strikePrice - underlyingPrice) <="
    " underlyingPrice * 0.06::double AND putCall = 'PUT' AND nonStandard",
)
def _(spark, sf):
    out = CH.filter_chain(contracts(spark, sf), "PUT", opt_range="NTM", option_type="NS", near_pct=0.06)
    return out.select("symbol", "strikePrice", "putCall")


@query(
    "agg1_distinct_expirations",
    "SELECT expirationDate, min(daysToExpiration) AS daysToExpiration, min(expirationType) AS expirationType,"
    f" bool_and(NOT nonStandard) AS standard, count(*) AS contracts FROM ({CONTRACTS}) c GROUP BY 1",
)
def _(spark, sf):
    return CH.distinct_expirations(contracts(spark, sf))


@query("agg2_distinct_keys", f"SELECT DISTINCT dividendAmount, underlyingPrice FROM ({CONTRACTS}) c")
def _(spark, sf):
    return TB.distinct_keys(contracts(spark, sf), ["dividendAmount", "underlyingPrice"])


@query("set1_union_sides", f"SELECT putCall, count(*) AS n, sum(strikePrice) AS strikes FROM ({CONTRACTS}) c GROUP BY 1")
def _(spark, sf):
    c = contracts(spark, sf)
    both = CH.union_sides(c.filter("putCall = 'CALL'"), c.filter("putCall = 'PUT'"))
    return rounded(both.groupBy("putCall").agg(F.count(F.lit(1)).alias("n"), F.sum("strikePrice").alias("strikes")), 2, "strikes")


@query(
    "set2_union_processed",
    "SELECT mark > intrinsicValue AS eligible, count(*) AS contracts, count(CASE WHEN mark > intrinsicValue THEN"
    f" daysToExpiration / 365.0 END) AS with_t FROM ({CONTRACTS}) c GROUP BY 1",
)
def _(spark, sf):
    good, rest = CH.split_iv_eligible(contracts(spark, sf))
    both = CH.union_processed(good.withColumn("t", F.col("daysToExpiration") / 365.0), rest)
    return both.groupBy(CH.is_iv_eligible().alias("eligible")).agg(
        F.count(F.lit(1)).alias("contracts"), F.count("t").alias("with_t")
    )


# --------------------------------------------------------------------------- rates


@query(
    "fn1_cc_rate",
    "SELECT l_orderkey, l_linenumber, round(ln(1 + l_discount), 10) AS r, round(ln(1 + l_tax) * 10 + 0.00001, 3) AS r3"
    " FROM lineitem",
)
def _(spark, sf):
    li = D.table(spark, sf, "lineitem")
    out = li.select(
        "l_orderkey", "l_linenumber", R.cc_rate("l_discount").alias("r"), (R.cc_rate("l_tax") * 10 + 0.00001).alias("r3")
    )
    return rounded(rounded(out, 10, "r"), 3, "r3")


@query(
    "fn2_dividend_yield",
    "SELECT symbol, round(CASE WHEN dividendAmount > 0 AND underlyingPrice > 0 THEN ln(1 + dividendAmount /"
    " underlyingPrice) ELSE 0 END, 10) AS q, round(ln(1 + dividendAmount / nullif(timeValue, 0)), 10) AS q_raw FROM (SELECT *"
    f" REPLACE (greatest(timeValue, 0) AS timeValue) FROM ({CONTRACTS}) c) d",
)
def _(spark, sf):
    c = contracts(spark, sf).withColumn("timeValue", F.greatest("timeValue", F.lit(0.0)))
    out = c.select(
        "symbol",
        R.dividend_yield("dividendAmount", "underlyingPrice").alias("q"),
        R.dividend_yield("dividendAmount", "timeValue", guarded=False).alias("q_raw"),
    )
    return rounded(out, 10, "q", "q_raw")


@query(
    "fn3_session_time_left",
    "SELECT event_id, round(greatest(CASE WHEN value > 200 THEN (epoch(date_trunc('day', ts)) + 76500 -"
    " floor(epoch(ts))) / 6123600 ELSE (epoch(date_trunc('day', ts)) + 75600 - floor(epoch(ts))) / 5896800 END, 0), 10)"
    " AS left_default, round(least(CASE WHEN value > 200 THEN (epoch(date_trunc('day', ts)) + 76500 - floor(epoch(ts)))"
    " / 6123600 ELSE (epoch(date_trunc('day', ts)) + 75600 - floor(epoch(ts))) / 5896800 END, 0), 10) AS left_least"
    " FROM events",
)
def _(spark, sf):
    e = D.table(spark, sf, "events")
    day = F.date_trunc("day", "ts")
    close_e, close_i = day + F.make_interval(hours=F.lit(21)), day + F.make_interval(hours=F.lit(21), mins=F.lit(15))
    out = e.select(
        "event_id",
        C.session_time_left("ts", close_e, close_i, F.col("value") > 200).alias("left_default"),
        C.session_time_left("ts", close_e, close_i, F.col("value") > 200, reference_least=True).alias("left_least"),
    )
    return rounded(out, 10, "left_default", "left_least")


_T = "SELECT symbol, putCall, daysToExpiration / 365.0::double AS t FROM (" + CONTRACTS + ") c"


@query("fn5_svensson", f"SELECT symbol, round({O.svensson('t', CURVE)}, 10) AS rate, round(ln(1 + {O.svensson('t', CURVE)}), 10) AS r FROM ({_T}) x")
def _(spark, sf):

    c = contracts(spark, sf).withColumn("t", F.col("daysToExpiration") / F.lit(365.0)).withColumn("rate", R.svensson("t", CURVE))
    return rounded(c.select("symbol", "rate", R.cc_rate("rate").alias("r")), 10, "rate", "r")


@query("fn6_nelson_siegel", f"SELECT symbol, round({O.nelson_siegel('t', NS_CURVE)}, 10) AS rate FROM ({_T}) x")
def _(spark, sf):
    c = contracts(spark, sf).withColumn("t", F.col("daysToExpiration") / F.lit(365.0))
    return rounded(c.select("symbol", R.nelson_siegel("t", NS_CURVE).alias("rate")), 10, "rate")


@query("fn7_flat_rate", f"SELECT symbol, 0.045::double AS rate FROM ({CONTRACTS}) c")
def _(spark, sf):
    return contracts(spark, sf).select("symbol", R.flat_rate(0.045).alias("rate"))


@query(
    "fn8_discount_factor",
    "SELECT symbol, round(exp(-0.045::double * t), 10) AS df_svensson, round(exp(-0.045::double * t), 10) AS"
    " df_nelson_siegel, round(1 / (1 + 0.045::double * t), 10) AS df_flat, round(1 / (1 + 0.045::double * t), 10) AS"
    f" df_cubic FROM ({_T}) x",
)
def _(spark, sf):
    c = contracts(spark, sf).withColumn("t", F.col("daysToExpiration") / F.lit(365.0))
    names = ("svensson", "nelson_siegel", "flat", "cubic")
    out = c.select("symbol", *[R.discount_factor(F.lit(0.045), "t", m).alias(f"df_{m}") for m in names])
    return rounded(out, 10, *[f"df_{m}" for m in names])


@query("fn9_year_fraction", "SELECT o_orderkey, round(date_diff('day', date '1995-01-01', o_orderdate::date) / 365.0::double, 10) AS t FROM orders")
def _(spark, sf):
    o = D.table(spark, sf, "orders")
    t = R.year_fraction_act365(F.col("o_orderdate"), F.lit("1995-01-01").cast("date"))
    return rounded(o.select("o_orderkey", t.alias("t")), 10, "t")


@query("fn16_prefix_date", f"SELECT symbol, cast(CAST(substr(expirationDate, 1, 10) AS date) AS varchar) AS expiry FROM ({CONTRACTS}) c")
def _(spark, sf):
    return contracts(spark, sf).select("symbol", C.prefix_date("expirationDate").alias("expiry"))


# --------------------------------------------------------------------------- joins to schedule and keys

_SESSIONS = (
    "SELECT d AS iso_date FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '2024-01-02', (SELECT CAST(max(substr("
    f"expirationDate, 1, 10)) AS timestamp) FROM ({CONTRACTS}) c), INTERVAL 1 DAY)) AS date) AS d) g WHERE {O.is_bizday('d')}"
)
_SCHEDULE = (
    f"SELECT iso_date, CASE WHEN iso_date > date '{D.AS_OF}' THEN (row_number() OVER (ORDER BY iso_date) - 1) * 6.5::double"
    f" / 1638 END AS T_eqo, CASE WHEN iso_date > date '{D.AS_OF}' THEN (row_number() OVER (ORDER BY iso_date) - 1) *"
    f" 6.75::double / 1701 END AS T_ind FROM ({_SESSIONS}) s"
)


def schedule(spark, sf):
    """Sessions from the fetch day to the last expiry of the contracts."""
    expiries = D.table(spark, sf, "lineitem").select(F.expr(D.EXPIRY_DAY).alias("day"))
    sessions = S.trading_schedule(S.calendar_days(expiries, "day", start=D.AS_OF))
    return S.expiry_schedule(sessions, D.AS_OF)


@query(
    "join1_attach_schedule",
    f"SELECT c.symbol, c.isIndex, round(s.T_eqo, 8) AS T_eqo, round(s.T_ind, 8) AS T_ind FROM ({CONTRACTS}) c LEFT JOIN"
    f" ({_SCHEDULE}) s ON CAST(substr(c.expirationDate, 1, 10) AS date) = s.iso_date",
)
def _(spark, sf):
    out = S.attach_schedule(contracts(spark, sf), schedule(spark, sf))
    return rounded(out.select("symbol", "isIndex", "T_eqo", "T_ind"), 8, "T_eqo", "T_ind")


# Fetch dates are all ship dates, expiries some weeks later; sessions are closed on the 25th and short on the 24th.
_TRADING_TIME = """
WITH li AS (SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS date) AS f, CAST(l_shipdate AS date) + CAST(l_linenumber * 20 + l_quantity AS int) AS x FROM lineitem),
days AS (SELECT CAST(unnest(generate_series(min(f), max(x), INTERVAL 1 DAY)) AS date) AS day FROM li),
h AS (SELECT day, isodow(day) < 6 AND day(day) <> 25 AS is_session, CASE WHEN NOT is_session THEN 0 WHEN day(day) = 24 THEN 3.5::double ELSE 6.5 END AS e,
             CASE WHEN NOT is_session THEN 0 WHEN day(day) = 24 THEN 3.75::double ELSE 6.75 END AS i FROM days),
c AS (SELECT day, is_session, sum(e) OVER (ORDER BY day) AS e, sum(i) OVER (ORDER BY day) AS i FROM h)
SELECT l_orderkey, l_linenumber, round(CASE WHEN b.is_session AND x > f THEN (b.e - a.e) / (252 * 6.5) END, 10) + 0.0 AS T_eqo,
       round(CASE WHEN b.is_session AND x > f THEN (b.i - a.i) / (252 * 6.75) END, 10) + 0.0 AS T_ind
FROM li LEFT JOIN c a ON a.day = f LEFT JOIN c b ON b.day = x"""


@query("fn15_trading_time_by_fetch_date", _TRADING_TIME)
def _(spark, sf):
    fetched = F.col("l_shipdate").cast("date")
    expiry = F.date_add(fetched, (F.col("l_linenumber") * 20 + F.col("l_quantity")).cast("int"))
    li = D.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", fetched.alias("f"), expiry.alias("x"))
    days = li.agg(F.min("f").alias("lo"), F.max("x").alias("hi")).select(F.explode(F.sequence("lo", "hi")).alias("day"))
    sessions = SS.session_table(days, days.filter("day(day) = 25"), days.filter("day(day) = 24"))
    out = SS.attach_trading_time(li, sessions, "f", "x")
    return rounded(out.select("l_orderkey", "l_linenumber", "T_eqo", "T_ind"), 10, "T_eqo", "T_ind")


@query(
    "join2_attach_time_and_rate",
    f"WITH x AS ({_T}) SELECT symbol, round(t, 10) AS t, round(ln(1 + {O.svensson('t', CURVE)}), 10) AS r FROM x",
)
def _(spark, sf):
    t = F.col("daysToExpiration") / F.lit(365.0)
    out = CH.attach_time_and_rate(contracts(spark, sf), t, R.cc_rate(R.svensson(t, CURVE)))
    return rounded(out.select("symbol", "t", "r"), 10, "t", "r")


@query(
    "join3_attach_dividend_yield",
    "SELECT symbol, round(CASE WHEN dividendAmount IS NULL THEN NULL WHEN dividendAmount > 0 THEN ln(1 + dividendAmount /"
    " underlyingPrice) ELSE 0 END, 10) AS q FROM (SELECT * REPLACE (nullif(dividendAmount, 0.5) AS dividendAmount) FROM"
    f" ({CONTRACTS}) c) d",
)
def _(spark, sf):
    c = contracts(spark, sf).withColumn("dividendAmount", F.nullif("dividendAmount", F.lit(0.5)))
    return rounded(CH.attach_dividend_yield(c).select("symbol", "q"), 10, "q")


# part numbers of 150 and above have no chain
_FUND = "SELECT concat(CASE WHEN p_partkey % 200 < 150 THEN 'P' ELSE 'Z' END, cast(p_partkey % 200 AS string)) AS symbol, max(cast(p_size % 7 AS double)) / 4 AS divAmount FROM part GROUP BY p_partkey % 200"


@query(
    "join4_attach_dividends",
    f"SELECT b.ticker AS symbol, count(*) AS chains, coalesce(max(f.divAmount), 0.0) AS dividendAmount FROM"
    f" ({D.oracle_text(D.CHAIN_BASE)}) b LEFT JOIN ({_FUND}) f ON b.ticker = f.symbol GROUP BY 1",
)
def _(spark, sf):
    funds = spark.sql(_FUND.replace("FROM part", "FROM {part}"), part=D.table(spark, sf, "part"))
    out = CH.attach_dividends(D.chains(spark, sf), funds)
    return out.groupBy("symbol").agg(F.count(F.lit(1)).alias("chains"), F.max("dividendAmount").alias("dividendAmount"))


@query(
    "join12_expirations_only",
    f"SELECT cast(iso_date AS varchar) AS iso_date, round(T_eqo, 8) AS T_eqo FROM ({_SCHEDULE}) s WHERE iso_date IN"
    f" (SELECT CAST(substr(expirationDate, 1, 10) AS date) FROM ({CONTRACTS}) c)",
)
def _(spark, sf):
    out = S.expirations_only(schedule(spark, sf), contracts(spark, sf))
    return rounded(out.select("iso_date", "T_eqo"), 8, "T_eqo")


_TIMED = (
    "SELECT c.*, greatest(CASE WHEN isIndex THEN (epoch(timestamp '2024-01-02 21:15:00') - epoch(fetchTime)) / 6123600"
    " ELSE (epoch(timestamp '2024-01-02 21:00:00') - epoch(fetchTime)) / 5896800 END, 0) + CASE WHEN isIndex THEN s.T_ind"
    " ELSE s.T_eqo END AS t FROM ({source}) c LEFT JOIN (" + _SCHEDULE + ") s ON CAST(substr(c.expirationDate, 1, 10) AS"
    " date) = s.iso_date"
)


@query("fn4_time_to_expiry", f"SELECT symbol, isIndex, round(t, 8) AS t FROM ({_TIMED.format(source=CONTRACTS)}) x")
def _(spark, sf):
    c = S.attach_schedule(contracts(spark, sf), schedule(spark, sf))
    left = C.session_time_left("fetchTime", F.lit(D.CLOSE_EQUITY), F.lit(D.CLOSE_INDEX), "isIndex")
    t = C.time_to_expiry(left, "T_eqo", "T_ind", "isIndex")
    return rounded(c.select("symbol", "isIndex", t.alias("t")), 8, "t")


# --------------------------------------------------------------------------- prices

_PRICED = f"SELECT symbol, putCall, underlyingPrice, strikePrice, daysToExpiration / 365.0::double AS t, 0.045::double AS r, 0.15::double + (daysToExpiration % 5) / 10.0::double AS sigma FROM ({CONTRACTS}) c"


@query("fn12_bs_price", f"SELECT symbol, round(price, 6) + 0.0 AS price FROM ({O.with_bs_price(_PRICED, 'sigma', 'price')}) p")
def _(spark, sf):
    c = contracts(spark, sf).withColumn("t", F.col("daysToExpiration") / F.lit(365.0))
    sigma = F.lit(0.15) + (F.col("daysToExpiration") % 5) / F.lit(10.0)
    c = P.with_bs_price(c.withColumns({"r": F.lit(0.045), "sigma": sigma}))
    return rounded(c.select("symbol", "price"), 6, "price")


_TREE = (
    "SELECT symbol, putCall, strikePrice, underlyingPrice, daysToExpiration / 365.0::double AS t, 0.045::double AS r, 0.35::double"
    " AS sigma, CASE WHEN dividendAmount > 0 THEN ln(1 + dividendAmount / underlyingPrice) ELSE 0 END AS q FROM (" + CONTRACTS + ") c"
)


@query(
    "fn13_crr_price",
    f"SELECT symbol, putCall, round(price, 5) + 0.0 AS price FROM ({O.tree_price(_TREE, 'symbol, putCall', 50)}) p",
)
def _(spark, sf):
    c = contracts(spark, sf).withColumn("t", F.col("daysToExpiration") / F.lit(365.0))
    q = R.dividend_yield("dividendAmount", "underlyingPrice")
    price = P.crr_price("underlyingPrice", "strikePrice", "t", F.lit(0.045), q, F.lit(0.35), "putCall", steps=50)
    return rounded(c.select("symbol", "putCall", price.alias("price")), 5, "price")


_EUROPEAN = (
    "SELECT *, ln(1 + " + O.svensson("t", CURVE) + ") AS r FROM (" + _TIMED.format(source="{source}") + ") e"
)


@query(
    "fn14_implied_vol_european",
    "WITH RECURSIVE q AS (SELECT symbol, putCall, underlyingPrice, strikePrice, mark, daysToExpiration / 365.0::double AS t,"
    f" 0.045::double AS r FROM ({CONTRACTS}) c WHERE mark > intrinsicValue), {O.implied_vols('SELECT * FROM q', 'symbol')}"
    " SELECT symbol, round(iv, 5) AS iv FROM vols",
)
def _(spark, sf):
    c = contracts(spark, sf).filter(CH.is_iv_eligible()).select(
        "symbol", "putCall", "underlyingPrice", "strikePrice", "mark", (F.col("daysToExpiration") / F.lit(365.0)).alias("t")
    )
    iv = P.implied_vol("mark", "underlyingPrice", "strikePrice", "t", F.lit(0.045), F.lit(0.0), "putCall", F.lit("E"))
    return rounded(c.select("symbol", iv.alias("iv")), 5, "iv")


@query(
    "fn14_european_vol_in_columns",
    "WITH RECURSIVE q AS (SELECT symbol, putCall, underlyingPrice, strikePrice, mark, daysToExpiration / 365.0::double AS t,"
    f" 0.045::double AS r FROM ({CONTRACTS}) c WHERE mark > intrinsicValue), {O.implied_vols('SELECT * FROM q', 'symbol')}"
    " SELECT symbol, round(iv, 5) AS iv FROM vols",
)
def _(spark, sf):
    c = contracts(spark, sf).filter(CH.is_iv_eligible()).withColumn("t", F.col("daysToExpiration") / F.lit(365.0))
    return rounded(c.select("symbol", P.european_vol("mark", "underlyingPrice", "strikePrice", "t", F.lit(0.045), "putCall").alias("iv")), 5, "iv")


@query("fn14_implied_vol_american")
def _(spark, sf):
    c = contracts(spark, sf).filter(CH.is_iv_eligible()).withColumn("t", F.col("daysToExpiration") / F.lit(365.0))
    q = R.dividend_yield("dividendAmount", "underlyingPrice")
    iv = P.implied_vol("mark", "underlyingPrice", "strikePrice", "t", F.lit(0.045), q, "putCall", F.lit("A"))
    return c.select("symbol", "putCall", "mark", iv.alias("iv"))


_AMERICAN = (
    "SELECT symbol, putCall, underlyingPrice, strikePrice, mark, daysToExpiration / 365.0::double AS t, 0.02::double AS r, CASE"
    " WHEN dividendAmount > 0 THEN ln(1 + dividendAmount / underlyingPrice) ELSE 0 END AS q FROM (" + CONTRACTS + ") c WHERE mark >"
    " intrinsicValue"
)


# The same solver on a coarse tree, which SQL can still walk for every contract. At this rate the coarse tree has
# proper probabilities on the whole interval, so that there is one root to find.
@query(
    "fn14_implied_vol_american_coarse",
    f"WITH RECURSIVE a AS ({_AMERICAN}), {O.tree_vols('SELECT * FROM a', 'symbol', 8)} SELECT symbol, round(iv, 3) AS iv FROM vols",
)
def _(spark, sf):
    c = contracts(spark, sf).filter(CH.is_iv_eligible()).withColumn("t", F.col("daysToExpiration") / F.lit(365.0))
    q = R.dividend_yield("dividendAmount", "underlyingPrice")
    iv = P.implied_vol("mark", "underlyingPrice", "strikePrice", "t", F.lit(0.02), q, "putCall", F.lit("A"), steps=8)
    return rounded(c.select("symbol", iv.alias("iv")), 3, "iv")


def enriched(spark, sf, **options):
    return enrich_fetch_day(
        D.chains(spark, sf), schedule(spark, sf), CURVE, F.lit(D.CLOSE_EQUITY), F.lit(D.CLOSE_INDEX), **options
    )


_ENRICHED = _EUROPEAN.format(source=PAIRS)


@query(
    "fn15_enrich_contracts",
    f"WITH RECURSIVE c AS MATERIALIZED ({_ENRICHED}), q AS (SELECT symbol, putCall, underlyingPrice, strikePrice, mark, t, r,"
    " dividendAmount, isIndex FROM c WHERE mark > intrinsicValue AND exerciseType = 'E' AND t IS NOT NULL), "
    + O.implied_vols("SELECT * FROM q", "symbol, dividendAmount, isIndex")
    + ", every AS (SELECT symbol, dividendAmount, isIndex, count(*) AS contracts, count(CASE WHEN mark > intrinsicValue THEN t"
    " END) AS with_t, round(max(CASE WHEN mark > intrinsicValue THEN t END), 7) AS t, round(max(CASE WHEN mark >"
    " intrinsicValue THEN r END), 8) AS r, round(max(ln(1 + dividendAmount / underlyingPrice)), 8) + 0.0 AS q FROM c GROUP BY ALL), solved"
    " AS (SELECT symbol, dividendAmount, isIndex, count(iv) AS solved, round(max(iv), 5) AS max_iv, round(min(iv), 5) AS"
    " min_iv FROM vols GROUP BY ALL) SELECT e.symbol, e.dividendAmount, e.isIndex, e.contracts, e.with_t, e.t, e.r, e.q,"
    " coalesce(s.solved, 0) AS european_solved, s.max_iv, s.min_iv FROM every e LEFT JOIN solved s ON e.symbol = s.symbol AND"
    " e.dividendAmount = s.dividendAmount AND e.isIndex = s.isIndex",
)
def _(spark, sf):
    rows = enriched(spark, sf)
    iv = F.when(F.col("exerciseType") == "E", F.col("iv_mark"))
    out = rows.groupBy("symbol", "dividendAmount", "isIndex").agg(
        F.count(F.lit(1)).alias("contracts"), F.count("t").alias("with_t"), F.max("t").alias("t"), F.max("r").alias("r"),
        F.max("q").alias("q"), F.count(iv).alias("european_solved"), F.max(iv).alias("max_iv"), F.min(iv).alias("min_iv"),
    )
    return rounded(rounded(rounded(out, 7, "t"), 8, "r", "q"), 5, "max_iv", "min_iv")


# Curves of three days; a fetch day takes the newest one up to it.
CURVES = (("2024-01-01", 0.04), ("2024-01-15", 0.045), ("2024-02-01", 0.035))
_FETCH_DAYS = (
    "p AS MATERIALIZED (SELECT *, CAST(fetchTime - INTERVAL 5 HOUR AS date) AS f, CAST(substr(expirationDate, 1, 10) AS date) AS x FROM ("
    + D.oracle_text(D.FETCH_DAYS_PAIRS) + ") p0), days AS (SELECT CAST(unnest(generate_series(min(f), max(x), INTERVAL 1 DAY)) AS date) AS day FROM p),"
    " h AS (SELECT day, isodow(day) < 6 AND day(day) <> 25 AS is_session, CASE WHEN NOT is_session THEN 0 WHEN day(day) = 24 THEN 3.5::double ELSE 6.5"
    " END AS e, CASE WHEN NOT is_session THEN 0 WHEN day(day) = 24 THEN 3.75::double ELSE 6.75 END AS i FROM days),"
    " s AS (SELECT day, is_session, epoch(day + INTERVAL '14 hours 30 minutes') AS opened, e, i, sum(e) OVER (ORDER BY day) AS ce, sum(i) OVER (ORDER BY day) AS ci FROM h),"
    " k AS (SELECT CAST(day AS date) AS since, b0, coalesce(lead(CAST(day AS date)) OVER (ORDER BY day), date '9999-01-01') AS until FROM (VALUES "
    + ", ".join(f"('{d}', {b}::double)" for d, b in CURVES) + ") v(day, b0)),"
    " tt AS (SELECT p.*, k.b0, CASE WHEN b.is_session AND x > f THEN CASE WHEN NOT a.is_session THEN 0 WHEN isIndex THEN greatest(a.opened + 3600 * a.i -"
    " epoch(fetchTime), 0) / 6123600 ELSE greatest(a.opened + 3600 * a.e - epoch(fetchTime), 0) / 5896800 END + CASE WHEN isIndex THEN (b.ci - a.ci)"
    " / 1701 ELSE (b.ce - a.ce) / 1638 END END AS t FROM p LEFT JOIN s a ON a.day = f LEFT JOIN s b ON b.day = x LEFT JOIN k ON f >= since AND f < until),"
    " c AS MATERIALIZED (SELECT *, ln(1 + " + O.svensson("t", CURVE) + " + b0 - 0.04::double) AS r FROM tt)"
)


@query(
    "fn15_enrich_fetch_days",
    f"WITH RECURSIVE {_FETCH_DAYS}, q AS (SELECT symbol, putCall, underlyingPrice, strikePrice, mark, t, r, fetchTime, dividendAmount, isIndex FROM c WHERE"
    " mark > intrinsicValue AND exerciseType = 'E' AND t IS NOT NULL), " + O.implied_vols("SELECT * FROM q", "symbol, fetchTime, dividendAmount, isIndex")
    + ", every AS (SELECT symbol, fetchTime, dividendAmount, isIndex, count(*) AS contracts, count(CASE WHEN mark > intrinsicValue THEN t END) AS"
    " with_t, round(max(CASE WHEN mark > intrinsicValue THEN t END), 9) AS t, round(max(CASE WHEN mark > intrinsicValue THEN r END), 9) AS r FROM c GROUP BY ALL),"
    " solved AS (SELECT symbol, fetchTime, dividendAmount, isIndex, count(iv) AS solved, round(max(iv), 5) AS max_iv, round(min(iv), 5) AS min_iv FROM vols"
    " GROUP BY ALL) SELECT e.symbol, strftime(e.fetchTime, '%Y-%m-%d %H:%M:%S.%f') AS fetched, e.dividendAmount, e.isIndex, e.contracts, e.with_t, e.t, e.r,"
    " coalesce(s.solved, 0) AS european_solved, s.max_iv, s.min_iv FROM every e LEFT JOIN solved s ON e.symbol = s.symbol AND e.fetchTime = s.fetchTime AND"
    " e.dividendAmount = s.dividendAmount AND e.isIndex = s.isIndex",
)
def _(spark, sf):
    chains = D.chains(spark, sf, D.FETCH_DAYS_BASE)
    span = D.table(spark, sf, "lineitem").agg(F.max(F.expr(D.EXPIRY_DAY)).alias("hi"))
    days = span.select(F.explode(F.sequence(F.lit(D.AS_OF).cast("date"), "hi")).alias("day"))
    sessions = SS.session_table(days, days.filter("day(day) = 25"), days.filter("day(day) = 24"))
    curves = spark.createDataFrame([(d, *{**CURVE, "beta0": b}.values()) for d, b in CURVES], f"day string, {', '.join(f'{p} double' for p in PARAMS)}")
    rows = enrich_contracts(chains, sessions, curves, european_only=True)
    out = rows.groupBy("symbol", F.col("fetchTime").alias("fetched"), "dividendAmount", "isIndex").agg(
        F.count(F.lit(1)).alias("contracts"), F.count("t").alias("with_t"), F.max("t").alias("t"), F.max("r").alias("r"),
        F.count("iv_mark").alias("european_solved"), F.max("iv_mark").alias("max_iv"), F.min("iv_mark").alias("min_iv"))
    return rounded(rounded(out, 9, "t", "r"), 5, "max_iv", "min_iv")


@query("fn15_volatility_by_month")
def _(spark, sf):
    return volatility_by_month(enriched(spark, sf))


@query(
    "fn15_european_volatility_by_month",
    f"WITH RECURSIVE c AS MATERIALIZED ({_ENRICHED}), q AS (SELECT substr(expirationDate, 1, 7) AS expiry_month, putCall AS side, putCall, underlyingPrice,"
    " strikePrice, mark, t, r FROM c WHERE mark > intrinsicValue AND exerciseType = 'E' AND t IS NOT NULL), "
    + O.implied_vols("SELECT * FROM q", "expiry_month, side")
    + ", every AS (SELECT putCall, substr(expirationDate, 1, 7) AS expiry_month, count(*) AS contracts FROM c GROUP BY ALL), solved AS (SELECT side, expiry_month,"
    " count(iv) AS solved, round(avg(iv), 6) AS avg_iv FROM vols GROUP BY ALL) SELECT e.putCall, e.expiry_month, e.contracts, coalesce(s.solved, 0) AS solved,"
    " s.avg_iv FROM every e LEFT JOIN solved s ON s.side = e.putCall AND s.expiry_month = e.expiry_month",
)
def _(spark, sf):
    return rounded(volatility_by_month(enriched(spark, sf, european_only=True)), 6, "avg_iv")
