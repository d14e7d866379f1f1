"""Market-shaped tables derived from the given tables.

The SQL texts run unchanged on Spark and on DuckDB: Spark fills the braces
with DataFrames, the oracle with table names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from optiontide.session import widen

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str, wide: bool = False) -> DataFrame:
    """A given table; zoneless times become instants in the session zone (UTC).

    ``wide`` spreads a table of few splits over all cores, for costly rows.
    """
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    df = widen(df) if wide else df
    zoneless = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in zoneless}) if zoneless else df


def oracle_text(sql: str) -> str:
    return sql.format(**{t: t for t in TABLES})


def derived(spark: SparkSession, sf_dir: str, sql: str, wide: tuple[str, ...] = ()) -> DataFrame:
    used = {t: table(spark, sf_dir, t, t in wide) for t in TABLES if "{" + t + "}" in sql}
    return spark.sql(sql, **used)


EXPIRY_DAY = "date '2024-01-05' + cast(7 * (l_suppkey % 100) AS int)"

# One row per lineitem: the shared columns of a small option chain.
CHAIN_BASE = f"""
SELECT concat('P', cast(l_partkey % 200 AS string)) AS ticker,
       cast(floor(p_retailprice) AS double) AS underlyingPrice,
       cast(floor(p_retailprice) AS double) * (80 + 5 * ((l_partkey + l_linenumber) % 9)) / 100 AS strikePrice,
       CASE l_returnflag WHEN 'R' THEN '' WHEN 'A' THEN 'A' ELSE 'E' END AS exerciseType,
       l_linestatus = 'F' AS isIndex,
       cast(p_size % 7 AS double) / 4 AS dividendAmount,
       cast(l_quantity - 5 AS double) AS timeValue,
       cast({EXPIRY_DAY} AS string) AS expDay,
       cast(3 + 7 * (l_suppkey % 100) AS int) AS daysToExpiration,
       p_size % 5 = 0 AS nonStandard,
       CASE WHEN l_suppkey % 4 = 2 THEN 'S' ELSE 'W' END AS expirationType,
       timestamp '2024-01-02 19:30:00' AS fetchTime,
       l_orderkey, l_linenumber
FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey
"""

# The same chains, fetched over 40 days from the morning to the evening; late ones are of the next day in UTC.
_FETCHED = "timestamp '2024-01-02 13:00:00' + INTERVAL '1' MINUTE * cast(1440 * (l_orderkey % 40) + 97 * l_linenumber AS int)"
FETCH_DAYS_BASE = CHAIN_BASE.replace("timestamp '2024-01-02 19:30:00'", _FETCHED)

AS_OF = "2024-01-02"
CLOSE_EQUITY = "2024-01-02 21:00:00"
CLOSE_INDEX = "2024-01-02 21:15:00"

_INTRINSIC = (
    "CASE WHEN {side} = 'CALL' THEN greatest(underlyingPrice - strikePrice, 0e0)"
    " ELSE greatest(strikePrice - underlyingPrice, 0e0) END"
)


def contract_fields(side: str) -> dict[str, str]:
    """Contract columns as SQL over CHAIN_BASE, for the side given as SQL text."""
    intrinsic = _INTRINSIC.format(side=side)
    return {
        "symbol": "concat(rpad(ticker, 6, ' '), replace(substr(expDay, 3, 8), '-', ''),"
        f" substr({side}, 1, 1), lpad(cast(cast(round(strikePrice * 1000) AS bigint) AS string), 8, '0'))",
        "putCall": side,
        "strikePrice": "strikePrice",
        "expirationDate": "concat(expDay, 'T20:00:00.000+00:00')",
        "exerciseType": "exerciseType",
        "intrinsicValue": intrinsic,
        "mark": f"{intrinsic} + timeValue",
        "timeValue": "timeValue",
        "daysToExpiration": "daysToExpiration",
        "inTheMoney": f"{intrinsic} > 0",
        "nonStandard": "nonStandard",
        "expirationType": "expirationType",
    }


def _select(side: str) -> str:
    return ", ".join(f"{text} AS {name}" for name, text in contract_fields(side).items())


_CHAIN_COLUMNS = "ticker, underlyingPrice, fetchTime, dividendAmount, isIndex, l_orderkey, l_linenumber"

# One contract per lineitem, calls on even line numbers.
CONTRACTS = (
    f"SELECT {_CHAIN_COLUMNS}, "
    + _select("CASE WHEN l_linenumber % 2 = 0 THEN 'CALL' ELSE 'PUT' END")
    + f" FROM ({CHAIN_BASE}) base"
)

# A call and a put per lineitem: what the chains below hold.
CONTRACT_PAIRS = (
    f"SELECT {_CHAIN_COLUMNS}, {_select(chr(39) + 'CALL' + chr(39))} FROM ({CHAIN_BASE}) base"
    f" UNION ALL SELECT {_CHAIN_COLUMNS}, {_select(chr(39) + 'PUT' + chr(39))} FROM ({CHAIN_BASE}) base"
)


FETCH_DAYS_PAIRS = CONTRACT_PAIRS.replace(CHAIN_BASE, FETCH_DAYS_BASE)


def chains(spark: SparkSession, sf_dir: str, base_sql: str = CHAIN_BASE) -> DataFrame:
    """A chain document per lineitem with one call and one put, nested by expiry and strike."""
    base = derived(spark, sf_dir, base_sql, wide=("lineitem",))

    def side(name: str):
        fields = contract_fields(f"'{name}'")
        contract = F.struct(*[F.expr(text).alias(n) for n, text in fields.items()])
        expiry = F.concat("expDay", F.lit(":"), F.col("daysToExpiration").cast("string"))
        strike = F.col("strikePrice").cast("string")
        return F.create_map(expiry, F.create_map(strike, F.array(contract)))

    return base.select(
        F.col("ticker").alias("symbol"), F.lit("SUCCESS").alias("status"), "underlyingPrice", "fetchTime",
        "dividendAmount", "isIndex", side("CALL").alias("callExpDateMap"), side("PUT").alias("putExpDateMap"),
        "l_orderkey", "l_linenumber",
    )


BARS = (
    "SELECT concat('U', cast(user_id % 20 AS string)) AS symbol, ts, event_id, value AS close, 1 AS volume"
    " FROM {events}"
)

QUOTES = (
    "SELECT symbol, close AS lastPrice, ts FROM (SELECT *, row_number() OVER (PARTITION BY symbol"
    f" ORDER BY ts DESC, event_id DESC) AS rn FROM ({BARS}) b) q WHERE rn = 1"
)

# Holdings of all suppliers; two of twenty symbols have no quotes.
POSITIONS = (
    "SELECT concat(CASE WHEN s_suppkey % 20 < 18 THEN 'U' ELSE 'X' END, cast(s_suppkey % 20 AS string)) AS symbol, sum(1 + s_nationkey) AS quantity,"
    " cast(floor(min(abs(s_acctbal))) AS double) / 20 + 1 AS purchase_price,"
    " CASE WHEN s_suppkey % 20 % 2 = 0 THEN 'equity' ELSE 'option' END AS asset_type"
    " FROM {supplier} GROUP BY s_suppkey % 20"
)

# Maturities of the curves as (label, days, spread).
MATURITIES = (
    ("1 Mo", 30, 0), ("3 Mo", 90, 1), ("6 Mo", 180, 3), ("1 Yr", 365, 2), ("2 Yr", 730, 4), ("5 Yr", 1825, 6),
    ("10 Yr", 3650, 7), ("30 Yr", 10950, 9),
)

CURVE_DATES = "SELECT DISTINCT cast(ts AS date) AS ref_date FROM {events}"
# The same days with gaps: each moves back to the one before that is a multiple of three.
GAPPED_DATES = "SELECT DISTINCT cast(ts AS date) - cast(day(ts) % 3 AS int) AS ref_date FROM {events}"

CURVE_POINTS = (
    "SELECT d.ref_date, m.label, m.days, cast(m.days AS double) / 365 AS t,"
    f" 4e-2 + 4e-4 * m.k + 1e-4 * day(d.ref_date) AS y FROM ({CURVE_DATES}) d"
    f" CROSS JOIN (VALUES {', '.join(map(str, MATURITIES))}) AS m(label, days, k)"
)


def curve_points_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of CURVE_POINTS, with the maturities exploded instead of joined."""
    items = [F.struct(F.lit(n).alias("label"), F.lit(d).alias("days"), F.lit(k).alias("k")) for n, d, k in MATURITIES]
    dates = derived(spark, sf_dir, CURVE_DATES)
    return dates.select("ref_date", F.inline(F.array(*items))).select(
        "ref_date", "label", "days", (F.col("days").cast("double") / 365).alias("t"),
        F.expr("4e-2 + 4e-4 * k + 1e-4 * day(ref_date)").alias("y"),
    )


# Maturities asked of the curves: one per event.
CURVE_QUERIES = (
    "SELECT event_id, cast(ts AS date) AS day, cast(event_id % 12000 AS double) / 365 AS t FROM {events}"
)

REQUESTS = "SELECT user_id % 8 AS client, ts, event_id, event_type = 'error' AS failed FROM {events}"

ORDERS = (
    "SELECT o_orderkey AS order_id, o_custkey AS account, CASE o_orderstatus WHEN 'F' THEN 'FILLED'"
    " WHEN 'O' THEN 'WORKING' ELSE 'QUEUED' END AS status, o_orderdate AS entered_time, o_totalprice AS price"
    " FROM {orders}"
)

OPTION_MASTER = (
    "SELECT DISTINCT 'STANDARD' AS optionKind, concat(rpad(concat('P', cast(l_partkey % 200 AS string)), 6, ' '),"
    " '240119', CASE WHEN l_linenumber % 2 = 0 THEN 'C' ELSE 'P' END,"
    " lpad(cast((l_partkey % 900 + 1) * 500 AS string), 8, '0')) AS optionID,"
    " concat('P', cast(l_partkey % 200 AS string)) AS underlying, 'A' AS exerciseStyle, 'P' AS settlementType,"
    " CASE WHEN l_partkey % 50 = 0 THEN 'Y' ELSE 'N' END AS test_issue_flag FROM {lineitem}"
)

# Listed equities: a part number below 160, some with a class suffix after a blank.
EQUITY_MASTER = (
    "SELECT CASE WHEN p_size % 10 = 3 THEN concat('P', cast(p_partkey % 160 AS string), ' A')"
    " ELSE concat('P', cast(p_partkey % 160 AS string)) END AS Symbol, p_name AS Issue_Name,"
    " CASE WHEN p_size % 4 = 0 THEN 'U' ELSE 'N' END AS Primary_Listing_Mkt,"
    " CASE WHEN p_partkey % 50 = 0 THEN 'Y' ELSE 'N' END AS test_issue_flag FROM {part}"
)

INSTRUMENTS = (
    "SELECT concat('P', cast(p_partkey AS string)) AS symbol, concat(p_name, ' ', p_type) AS description,"
    " cast(p_partkey * 7 + 100000 AS string) AS cusip FROM {part}"
)
