"""Explicit schemas of the nested and flat market-data records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

# Contract fields by type, in alphabetical order within a type.
_PRICES = """ask bid closePrice extrinsicValue high52Week highPrice intrinsicValue last low52Week
    lowPrice mark markChange markPercentChange multiplier netChange openPrice percentChange strikePrice
    theoreticalOptionValue timeValue""".split()
_GREEKS = "delta gamma rho theoreticalVolatility theta vega volatility".split()
_INTS = "askSize bidSize daysToExpiration lastSize".split()
_LONGS = "lastTradingDay openInterest quoteTimeInLong totalVolume tradeTimeInLong".split()
_BOOLS = "inTheMoney mini nonStandard pennyPilot".split()
_TEXTS = """bidAskSize deliverableNote description exchangeName exerciseType expirationDate
    expirationType optionRoot putCall settlementType symbol""".split()

PRICE = T.DecimalType(10, 2)

_KINDS = {
    "string": T.StringType(), "double": T.DoubleType(), "int": T.IntegerType(), "bigint": T.LongType(),
    "boolean": T.BooleanType(), "binary": T.BinaryType(),
}


def flat(text: str) -> T.StructType:
    """Schema of plain fields from ``name kind, name kind, ...``."""
    pairs = (item.split() for item in text.split(","))
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in pairs])

DELIVERABLES = T.ArrayType(
    T.StructType(
        [
            T.StructField("symbol", T.StringType()),
            T.StructField("assetType", T.StringType()),
            T.StructField("deliverableUnits", T.DoubleType()),
        ]
    )
)


def contract_schema(greeks: str = "double", deliverables: bool = True, fields: Sequence[str] | None = None) -> T.StructType:
    """One option contract, or some ``fields`` of it. ``greeks`` is ``double`` or ``decimal(10,2)``.

    The two-place decimal rounds a delta of 0.12567 to 0.13, so double is the default.
    """
    if greeks not in ("double", "decimal(10,2)"):
        raise ValueError("greeks must be 'double' or 'decimal(10,2)'")
    kinds: dict[str, T.DataType] = {}
    kinds.update(dict.fromkeys(_PRICES, PRICE))
    kinds.update(dict.fromkeys(_GREEKS, T.DoubleType() if greeks == "double" else PRICE))
    kinds.update(dict.fromkeys(_INTS, T.IntegerType()))
    kinds.update(dict.fromkeys(_LONGS, T.LongType()))
    kinds.update(dict.fromkeys(_BOOLS, T.BooleanType()))
    kinds.update(dict.fromkeys(_TEXTS, T.StringType()))
    if deliverables:
        kinds["optionDeliverablesList"] = DELIVERABLES
    names = kinds if fields is None else kinds.keys() & set(fields)
    return T.StructType([T.StructField(n, kinds[n], n != "symbol") for n in sorted(names, key=str.lower)])


UNDERLYING = flat(
    "symbol string, description string, change double, percentChange double, close double, quoteTime bigint,"
    " tradeTime bigint, bid double, ask double, last double, mark double, markChange double,"
    " markPercentChange double, bidSize int, askSize int, highPrice double, lowPrice double, openPrice double,"
    " totalVolume bigint, exchangeName string, fiftyTwoWeekHigh double, fiftyTwoWeekLow double, delayed boolean"
)


def chain_schema(greeks: str = "double", fields: Sequence[str] | None = None, columns: Sequence[str] | None = None) -> T.StructType:
    """One option chain, or some ``columns`` of it: expiry -> strike -> contracts (or some ``fields`` of them), once for calls and once for puts."""
    side = T.MapType(T.StringType(), T.MapType(T.StringType(), T.ArrayType(contract_schema(greeks, fields=fields))))
    out = flat("symbol string, status string").add("underlying", UNDERLYING)
    for field in flat(
        "strategy string, interval double, isDelayed boolean, isIndex boolean, interestRate double,"
        " underlyingPrice double, volatility double, daysToExpiration double, numberOfContracts int,"
        " assetMainType string, assetSubType string, isChainTruncated boolean"
    ):
        out = out.add(field)
    out = out.add("callExpDateMap", side).add("putExpDateMap", side)
    out = out.add("fetchTime", T.TimestampType()).add("dividendAmount", T.DoubleType())
    return out if columns is None else T.StructType([f for f in out if f.name in columns])


def output_schema(greeks: str = "double") -> T.StructType:
    """A processed contract: no deliverables; price, fetch time, volatility, extras and ticker added."""
    out = T.StructType(list(contract_schema(greeks, deliverables=False)))
    return (
        out.add("underlyingPrice", PRICE)
        .add("fetchTime", T.TimestampType(), False)
        .add("iv_mark", T.FloatType())
        .add("extra", T.StringType())
        .add("ticker", T.StringType(), False)
    )


MESSAGE = flat("key binary, value binary")

FUNDAMENTAL = flat(
    "avg10DaysVolume double, avg1YearVolume double, declarationDate string, divAmount double, divExDate string,"
    " divFreq int, divPayAmount double, divPayDate string, divYield double, eps double, fundLeverageFactor double,"
    " lastEarningsDate string, nextDivExDate string, nextDivPayDate string, peRatio double"
)

FUNDAMENTALS_DOCUMENT = T.MapType(
    T.StringType(),
    flat("assetMainType string, assetSubType string, ssid bigint, symbol string").add("fundamental", FUNDAMENTAL),
)

# Nested schemas as type text, parsed by Spark where they are used.
MARKET_HOURS_DOCUMENT = (
    "map<string, struct<date: string, marketType: string, exchange: string, category: string, product: string,"
    " productName: string, isOpen: boolean, sessionHours: map<string, array<struct<start: string, end: string>>>>>"
)

EQUITY_MASTER_COLUMNS = ["Symbol", "Issue_Name", "Primary_Listing_Mkt", "test_issue_flag"]
OPTION_MASTER_COLUMNS = ["optionKind", "optionID", "underlying", "exerciseStyle", "settlementType", "test_issue_flag"]

ACCOUNTS_DOCUMENT = (
    "array<map<string, struct<accountId: string, type: string,"
    " currentBalances: struct<cashBalance: double, longMarketValue: double, cashAvailableForTrading: double,"
    " cashAvailableForWithDrawal: double, availableFunds: double, buyingPower: double,"
    " dayTradingBuyingPower: double, maintenanceCall: double, maintenanceRequirement: double,"
    " shortBalance: double, shortMarketValue: double, shortMarginValue: double>,"
    " positions: array<struct<averagePrice: double, marketValue: double, currentDayProfitLossPercentage: double,"
    " currentDayProfitLoss: double, longQuantity: double, shortQuantity: double, settledLongQuantity: double,"
    " settledShortQuantity: double, instrument: struct<symbol: string, cusip: string, assetType: string,"
    " subAssetType: string, description: string, type: string>>>>>>"
)

BOOK_LEVELS = "array<struct<`0`: double, `1`: bigint, `2`: int, `3`: array<struct<`0`: string, `1`: bigint, `2`: bigint>>>>"
BOOK_CONTENT = f"struct<`0`: string, `1`: bigint, `2`: {BOOK_LEVELS}, `3`: {BOOK_LEVELS}, `key`: string>"
