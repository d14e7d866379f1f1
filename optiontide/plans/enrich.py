"""The flagship job: nested chains in, priced contract rows out."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from optiontide.functions.calendar import session_time_left, time_to_expiry
from optiontide.functions.pricing import implied_vol
from optiontide.functions.rates import cc_rate, dividend_yield, svensson
from optiontide.operators.chain import CHAIN_COLUMNS, flatten_chain, is_iv_eligible
from optiontide.operators.schedule import attach_schedule
from optiontide.operators.sessions import ZONE, attach_session_left, attach_trading_time


def _with_volatility(timed: DataFrame, params: Mapping[str, Column | float], solve: bool, partitions: int | None, *helpers: str,
                     european_only: bool = False) -> DataFrame:
    """t, r, ``iv_mark`` and ``extra`` of contracts that have q and the parts of their time to expiry."""
    eligible = is_iv_eligible()
    t = time_to_expiry("time_remaining", "T_eqo", "T_ind", "isIndex")
    timed = timed.withColumn("t", F.when(eligible, t)).withColumn("r", cc_rate(svensson("t", params)))
    timed = timed.drop("time_remaining", "T_eqo", "T_ind", *helpers)
    if solve:
        spread = timed.repartition(partitions) if partitions else timed
        # null inputs come back as null without a solve
        mark = F.when(is_iv_eligible(), F.col("mark"))
        if european_only:
            mark = F.when(F.col("exerciseType") == "E", mark)
        iv = implied_vol(mark, "underlyingPrice", "strikePrice", "t", "r", "q", "putCall", "exerciseType")
        timed = spread.withColumn("iv_mark", iv)
    with_time = F.to_json(F.struct("q", "r", "t", "dividendAmount", "isIndex"))
    without = F.to_json(F.struct("dividendAmount", "isIndex", "q"))
    return timed.withColumn("extra", F.when(is_iv_eligible(), with_time).otherwise(without))


def enrich_fetch_day(
    chains: DataFrame,
    schedule: DataFrame,
    params: Mapping[str, Column | float],
    close_equity: Column | str,
    close_index: Column | str,
    guarded_q: bool = True,
    reference_least: bool = False,
    solve: bool = True,
    partitions: int | None = None,
    carry: tuple[str, ...] = (),
    european_only: bool = False,
) -> DataFrame:
    """Contract rows with q, t, r, implied volatility ``iv_mark`` and JSON ``extra``, of chains of one fetch day.

    ``schedule`` is (iso_date, T_eqo, T_ind). Contracts without time value keep
    their row with null t, r and iv_mark, and cost the solver nothing. Both
    kinds stay in one pass: a split and a union would decode every chain twice.
    The job has no shuffle of its own; a narrow source is best widened where it
    is read (``session.widen``), and ``partitions`` spreads the exploded rows
    before the solver when single chains are very large. ``european_only`` solves contracts of exercise type E alone.
    """
    priced = chains.withColumns({
        "q": dividend_yield("dividendAmount", "underlyingPrice", guarded_q),
        "time_remaining": session_time_left("fetchTime", close_equity, close_index, "isIndex", reference_least),
    })
    rows = flatten_chain(priced, carry=(*CHAIN_COLUMNS, "q", "time_remaining", *carry))
    return _with_volatility(attach_schedule(rows, schedule), params, solve, partitions, european_only=european_only)


PARAMS = ("beta0", "beta1", "beta2", "beta3", "tau1", "tau2")


def enrich_contracts(
    chains: DataFrame,
    sessions: DataFrame,
    params: Mapping[str, Column | float] | DataFrame,
    guarded_q: bool = True,
    reference_least: bool = False,
    solve: bool = True,
    partitions: int | None = None,
    carry: tuple[str, ...] = (),
    zone: str = ZONE,
    european_only: bool = False,
) -> DataFrame:
    """As ``enrich_fetch_day`` for chains of any number of fetch days in one plan.

    ``sessions`` is (iso_date, market_open, market_close, index_close), see ``session_table``. A chain takes what is left of its own
    fetch day's session; hours are cumulated over the calendar once, and a contract takes the difference between its expiry and its
    fetch day. ``params`` are curve parameters for all rows, or a table with ``day`` and the parameters: each fetch day
    takes the newest curve up to that day. Tables by day are bounded by the calendar and are joined without a hint. Contracts that do not expire on a session after the
    fetch day have null t, r and iv_mark, chains fetched before the first curve null r and iv_mark. ``european_only`` solves contracts of exercise type E alone; without it the tree runs for all others.
    """
    with_q = chains.withColumn("q", dividend_yield("dividendAmount", "underlyingPrice", guarded_q))
    dated = attach_session_left(with_q, sessions, zone=zone, reference_least=reference_least)
    kept = (*CHAIN_COLUMNS, "q", "time_remaining", "fetch_day", *carry)
    helpers = ("fetch_day",)
    if isinstance(params, DataFrame):
        dated = dated.join(curves_by_day(params, sessions), F.col("fetch_day") == F.col("__curve_day"), "left").drop("__curve_day")
        names = tuple(f"__{p}" for p in PARAMS)
        kept, helpers = (*kept, *names), (*helpers, *names)
        params = {p: F.col(n) for p, n in zip(PARAMS, names, strict=True)}
    rows = flatten_chain(dated, carry=kept)
    timed = attach_trading_time(rows, sessions, "fetch_day", "expirationDate")
    return _with_volatility(timed, params, solve, partitions, *helpers, european_only=european_only)


def curves_by_day(curves: DataFrame, sessions: DataFrame) -> DataFrame:
    """Every calendar day of the sessions' span with the parameters of the newest curve up to it: ``__curve_day``, ``__beta0`` and so on."""
    given = curves.select(F.col("day").cast("date").alias("day"), F.struct(*PARAMS).alias("curve")).groupBy("day").agg(F.max("curve").alias("curve"))
    span = sessions.agg(F.min(F.col("iso_date").cast("date")).alias("lo"), F.max(F.col("iso_date").cast("date")).alias("hi")).filter("lo IS NOT NULL")
    days = span.select(F.explode(F.sequence(F.date_sub("lo", 7), F.date_add("hi", 7))).alias("day"), F.lit(None).cast(given.schema["curve"].dataType).alias("curve"))
    every = given.union(days).groupBy("day").agg(F.max("curve").alias("curve"))
    newest = F.last("curve", ignorenulls=True).over(Window.orderBy("day"))  # a row for each calendar day
    filled = every.select(F.col("day").alias("__curve_day"), newest.alias("curve"))
    return filled.select("__curve_day", *[F.col(f"curve.{p}").alias(f"__{p}") for p in PARAMS])


def volatility_by_month(enriched: DataFrame) -> DataFrame:
    """Contracts, solved contracts and mean volatility per side and expiry month."""
    month = F.substring("expirationDate", 1, 7)
    return enriched.groupBy("putCall", month.alias("expiry_month")).agg(
        F.count(F.lit(1)).alias("contracts"),
        F.count("iv_mark").alias("solved"),
        F.avg("iv_mark").alias("avg_iv"),
    )
