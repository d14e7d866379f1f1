"""Option chains: flattening, filters, and the columns around them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from optiontide.functions.calendar import prefix_date
from optiontide.functions.rates import dividend_yield
from optiontide.operators.tables import compute_on_distinct

# Allowed arguments of a chain request.
CONTRACT_TYPES = ("CALL", "PUT", "ALL")
STRATEGIES = (
    "SINGLE", "ANALYTICAL", "COVERED", "VERTICAL", "CALENDAR", "STRANGLE", "STRADDLE", "BUTTERFLY",
    "CONDOR", "DIAGONAL", "COLLAR", "ROLL",
)
RANGES = ("ITM", "NTM", "OTM", "SAK", "SBK", "SNK", "ALL")
MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")
OPTION_TYPES = ("S", "NS", "ALL")

CHAIN_COLUMNS = ("underlyingPrice", "fetchTime", "dividendAmount", "isIndex")


def flatten_chain(
    chains: DataFrame,
    keep_keys: bool = False,
    carry: Sequence[str] = CHAIN_COLUMNS,
    drop: Sequence[str] = ("optionDeliverablesList",),
) -> DataFrame:
    """One row per contract of both sides, with the ``carry`` columns of its chain.

    Both sides go through one chain of generators, so the chain is decoded
    once; a null or empty side gives no rows. ``keep_keys`` adds the map keys
    as expiryKey and strikeKey.
    """
    kept = list(carry)
    keys = ["expiryKey", "strikeKey"] if keep_keys else []
    sides = chains.select(*kept, F.explode(F.array("callExpDateMap", "putExpDateMap")).alias("__side"))
    by_expiry = sides.select(*kept, F.explode("__side").alias("expiryKey", "__strikes"))
    by_strike = by_expiry.select(*kept, "expiryKey", F.explode("__strikes").alias("strikeKey", "__contracts"))
    rows = by_strike.select(*kept, *keys, F.inline("__contracts"))
    return rows.drop(*drop)


def union_sides(calls: DataFrame, puts: DataFrame) -> DataFrame:
    return calls.unionByName(puts)


def explode_deliverables(contracts: DataFrame, key: Sequence[str] = ("symbol",), outer: bool = True) -> DataFrame:
    """Side table of deliverables: ``key``, position, symbol, asset type and units."""
    generate = F.posexplode_outer if outer else F.posexplode
    items = contracts.select(
        *[F.col(k) for k in key], generate("optionDeliverablesList").alias("deliverablePos", "__d")
    )
    return items.select(
        *key,
        "deliverablePos",
        F.col("__d.symbol").alias("deliverableSymbol"),
        F.col("__d.assetType").alias("deliverableAssetType"),
        F.col("__d.deliverableUnits").alias("deliverableUnits"),
    )


def is_valid_chain() -> Column:
    """Status SUCCESS and both maps non-empty; never null."""
    return F.coalesce(
        (F.col("status") == "SUCCESS") & (F.size("callExpDateMap") > 0) & (F.size("putExpDateMap") > 0), F.lit(False)
    )


def valid_chains(chains: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable chains and their complement."""
    return chains.filter(is_valid_chain()), chains.filter(~is_valid_chain())


def pack_extra(df: DataFrame, cols: Sequence[str], name: str = "extra") -> DataFrame:
    """JSON text of ``cols`` without their nulls."""
    return df.withColumn(name, F.to_json(F.struct(*cols)))


def is_iv_eligible(mark: str = "mark", intrinsic: str = "intrinsicValue") -> Column:
    return F.col(mark) > F.col(intrinsic)


def split_iv_eligible(contracts: DataFrame, drop_nulls: bool = False) -> tuple[DataFrame, DataFrame]:
    """Contracts with time value, and the rest.

    A null mark or intrinsic value counts as the rest, or with ``drop_nulls``
    belongs to neither.
    """
    eligible = is_iv_eligible()
    rest = ~eligible if drop_nulls else ~F.coalesce(eligible, F.lit(False))
    return contracts.filter(eligible), contracts.filter(rest)


def union_processed(eligible: DataFrame, ineligible: DataFrame) -> DataFrame:
    """Union by name; columns only one side has are typed nulls on the other."""
    return eligible.unionByName(ineligible, allowMissingColumns=True)


def _checked(name: str, value: str | None, allowed: Sequence[str]) -> str:
    value = (value or "ALL").upper()
    if value not in allowed:
        raise ValueError(f"{name} {value!r} is not one of {', '.join(allowed)}")
    return value


def chain_request(strategy: str | None = None, **theoretical: float) -> dict:
    """Checked strategy arguments; SINGLE drops the theoretical-value ones."""
    strategy = _checked("strategy", strategy or "SINGLE", STRATEGIES)
    values = {} if strategy == "SINGLE" else {k: v for k, v in theoretical.items() if v}
    return {"strategy": strategy, **values}


def filter_chain(
    contracts: DataFrame,
    contract_type: str = "ALL",
    strike_count: int | None = None,
    strike: float | None = None,
    opt_range: str = "ALL",
    from_date: str | None = None,
    to_date: str | None = None,
    exp_month: str = "ALL",
    option_type: str = "ALL",
    near_pct: float = 0.05,
    chain_keys: Sequence[str] = ("ticker", "fetchTime"),
) -> DataFrame:
    """The chain-request arguments as filters on a contract table.

    NTM and SNK keep strikes within ``near_pct`` of the underlying price.
    ``strike_count`` keeps, per chain and expiry, that many distinct strikes at
    or above the price and as many below it.
    """
    contract_type = _checked("contract_type", contract_type, CONTRACT_TYPES)
    opt_range = _checked("opt_range", opt_range, RANGES)
    exp_month = _checked("exp_month", exp_month, ("ALL", *MONTHS))
    option_type = _checked("option_type", option_type, OPTION_TYPES)
    price, level = F.col("underlyingPrice"), F.col("strikePrice")
    expiry = prefix_date("expirationDate")

    out = contracts
    if contract_type != "ALL":
        out = out.filter(F.col("putCall") == contract_type)
    if strike:
        out = out.filter(F.round(level, 2) == F.round(F.lit(strike), 2))
    if opt_range == "ITM":
        out = out.filter(F.col("inTheMoney"))
    elif opt_range == "OTM":
        out = out.filter(~F.col("inTheMoney"))
    elif opt_range == "SAK":
        out = out.filter(level > price)
    elif opt_range == "SBK":
        out = out.filter(level < price)
    elif opt_range in ("NTM", "SNK"):
        out = out.filter(F.abs(level - price) <= price * near_pct)
    if from_date:
        out = out.filter(expiry >= F.lit(from_date).cast("date"))
    if to_date:
        out = out.filter(expiry <= F.lit(to_date).cast("date"))
    if exp_month != "ALL":
        out = out.filter(F.month(expiry) == MONTHS.index(exp_month) + 1)
    if option_type != "ALL":
        out = out.filter(F.col("nonStandard") == (option_type == "NS"))
    if strike_count:
        out = _nearest_strikes(out, strike_count, list(chain_keys))
    return out


def _nearest_strikes(contracts: DataFrame, count: int, chain_keys: list[str]) -> DataFrame:
    # Distinct strikes first: copies of a contract are folded before the shuffle,
    # and the row-number filter keeps at most ``count`` strikes per group and task.
    keys = [*chain_keys, "expirationDate", "strikePrice"]
    side = F.col("strikePrice") >= F.col("underlyingPrice")
    strikes = contracts.select(*keys, side.alias("__above"), F.abs(F.col("strikePrice") - F.col("underlyingPrice")).alias("__d"))
    w = W.partitionBy(*chain_keys, "expirationDate", "__above").orderBy("__d", "strikePrice")
    near = strikes.distinct().withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= count)
    return contracts.join(near.select(*keys), keys, "left_semi")


def distinct_expirations(contracts: DataFrame) -> DataFrame:
    """Expiry list: days left, type, standard flag and number of contracts."""
    return contracts.groupBy("expirationDate").agg(
        F.min("daysToExpiration").alias("daysToExpiration"),
        F.min("expirationType").alias("expirationType"),
        F.bool_and(~F.col("nonStandard")).alias("standard"),
        F.count(F.lit(1)).alias("contracts"),
    )


def attach_dividends(chains: DataFrame, fundamentals: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Dividend amount per symbol, 0 where unknown. Works on a stream of chains too.

    Repeated fundamentals of a symbol are folded first, so no chain is doubled.
    """
    known = fundamentals.groupBy(F.col("symbol").alias("__symbol")).agg(F.max("divAmount").alias("__div"))
    joined = chains.drop("dividendAmount").join(known, F.col(symbol) == F.col("__symbol"), "left")
    return joined.withColumn("dividendAmount", F.coalesce("__div", F.lit(0.0))).drop("__symbol", "__div")


def attach_dividend_yield(contracts: DataFrame, name: str = "q") -> DataFrame:
    """Yield per distinct (dividendAmount, underlyingPrice); a null in either leaves it null."""
    keys = ["dividendAmount", "underlyingPrice"]
    return compute_on_distinct(contracts, keys, {name: dividend_yield(*keys)}, match_nulls=False)


def attach_time_and_rate(contracts: DataFrame, time_expr: Column, rate_expr: Column) -> DataFrame:
    """t and r as plain columns: JVM expressions are cheaper than a join on distinct keys."""
    return contracts.withColumn("t", time_expr).withColumn("r", rate_expr)


def quarantine_symbols(universe: DataFrame, failures: DataFrame, last_round: int = 1) -> DataFrame:
    """Universe without the symbols that failed in a round up to ``last_round``."""
    failed = failures.filter(F.col("round") <= last_round).select("symbol").distinct()
    return universe.join(failed, "symbol", "left_anti")
