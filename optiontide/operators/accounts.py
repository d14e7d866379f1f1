"""Accounts, orders, transactions and instruments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from optiontide.functions.orders import ORDER_STATES, order_status_is
from optiontide.schemas import ACCOUNTS_DOCUMENT

# Transaction types.
TRANSACTION_TYPES = (
    "TRADE", "RECEIVE_AND_DELIVER", "DIVIDEND_OR_INTEREST", "ACH_RECEIPT", "ACH_DISBURSEMENT", "CASH_RECEIPT",
    "CASH_DISBURSEMENT", "ELECTRONIC_FUND", "WIRE_OUT", "WIRE_IN", "JOURNAL", "MEMORANDUM", "MARGIN_CALL",
    "MONEY_MARKET", "SMA_ADJUSTMENT",
)
DEFAULT_DAYS = 60

# Output column -> balance field, where a missing field counts as 0.
_OPTIONAL_BALANCES = {
    "cash_available_for_trading": "cashAvailableForTrading",
    "cash_available_for_withdrawl": "cashAvailableForWithDrawal",
    "available_funds": "availableFunds",
    "buying_power": "buyingPower",
    "day_trading_buying_power": "dayTradingBuyingPower",
    "maintenance_call": "maintenanceCall",
    "maintenance_requirement": "maintenanceRequirement",
    "short_balance": "shortBalance",
    "short_market_value": "shortMarketValue",
    "short_margin_value": "shortMarginValue",
}
# Output column -> position field.
_POSITION_NUMBERS = {
    "average_price": "averagePrice",
    "market_value": "marketValue",
    "current_day_profit_loss_percentage": "currentDayProfitLossPercentage",
    "current_day_profit_loss": "currentDayProfitLoss",
    "long_quantity": "longQuantity",
    "short_quantity": "shortQuantity",
    "settled_long_quantity": "settledLongQuantity",
    "settled_short_quantity": "settledShortQuantity",
}
_POSITION_TEXTS = {"sub_asset_type": "subAssetType", "description": "description", "type": "type"}


def parse_accounts(documents: DataFrame, value: str = "value") -> DataFrame:
    """One row per account of documents that are an object or a list of objects."""
    text = F.trim(F.col(value))
    listed = F.when(text.startswith("["), text).otherwise(F.concat(F.lit("["), text, F.lit("]")))
    accounts = F.from_json(listed, ACCOUNTS_DOCUMENT)
    return documents.select(F.explode(accounts).alias("m")).select(F.explode("m").alias("account_key", "a"))


def flatten_account_balances(documents: DataFrame, value: str = "value") -> DataFrame:
    """Fourteen balance columns per account; an account type is a row of its own."""
    b = "a.currentBalances"
    return parse_accounts(documents, value).select(
        F.col("a.accountId").alias("account_number"),
        F.col("a.type").alias("account_type"),
        F.col(f"{b}.cashBalance").alias("cash_balance"),
        F.col(f"{b}.longMarketValue").alias("long_market_value"),
        *[F.coalesce(F.col(f"{b}.{field}"), F.lit(0.0)).alias(n) for n, field in _OPTIONAL_BALANCES.items()],
    )


def flatten_account_positions(documents: DataFrame, value: str = "value") -> DataFrame:
    """Fifteen columns per position; missing text is empty."""
    rows = parse_accounts(documents, value).select(F.col("a.accountId").alias("account_number"), F.explode("a.positions").alias("p"))
    return rows.select(
        "account_number",
        *[F.col(f"p.{field}").alias(n) for n, field in _POSITION_NUMBERS.items()],
        F.col("p.instrument.symbol").alias("symbol"),
        F.col("p.instrument.cusip").alias("cusip"),
        F.col("p.instrument.assetType").alias("asset_type"),
        *[F.coalesce(F.col(f"p.instrument.{field}"), F.lit("")).alias(n) for n, field in _POSITION_TEXTS.items()],
    )


def _between(column: str, start: Column | str | None, end: Column | str | None, now: Column | None) -> Column:
    """Times in [start, end]; without a start the last 60 days before the end or now."""
    def instant(x: Column | str) -> Column:
        return (x if isinstance(x, Column) else F.lit(x)).cast("timestamp")

    last = instant(end) if end is not None else (now if now is not None else F.current_timestamp())
    first = instant(start) if start is not None else last - F.make_interval(days=F.lit(DEFAULT_DAYS))
    t = F.col(column).cast("timestamp")
    return (t >= first) & (t <= last)


def orders_by(orders: DataFrame, account: str | int | None = None, status: str | None = None,
              from_ts: Column | str | None = None, to_ts: Column | str | None = None,
              max_results: int | None = None, now: Column | None = None) -> DataFrame:
    """Orders of an account and status in a time window, newest first when capped."""
    out = orders.filter(_between("entered_time", from_ts, to_ts, now))
    if account is not None:
        out = out.filter(F.col("account") == account)
    if status is not None:
        out = out.filter(F.col("status") == status)
    if max_results is not None:
        out = out.orderBy(F.col("entered_time").desc(), "order_id").limit(max_results)
    return out


def order_flags(orders: DataFrame, status: str = "status") -> DataFrame:
    """One boolean column per order state."""
    return orders.withColumns({f"is_{state}": order_status_is(status, state) for state in ORDER_STATES})


def transactions_by(transactions: DataFrame, types: Sequence[str] = TRANSACTION_TYPES, symbol: str | None = None,
                    start: Column | str | None = None, end: Column | str | None = None,
                    transaction_id: str | int | None = None, now: Column | None = None) -> DataFrame:
    """Transactions of given types, symbol and window; an id overrides all of them."""
    if transaction_id is not None:
        return transactions.filter(F.col("transaction_id") == transaction_id)
    unknown = [t for t in types if t not in TRANSACTION_TYPES]
    if unknown:
        raise ValueError(f"unknown transaction types: {', '.join(unknown)}")
    out = transactions.filter(F.col("type").isin(list(types)) & _between("ts", start, end, now))
    return out if symbol is None else out.filter(F.col("symbol") == symbol)


def search_instruments(instruments: DataFrame, pattern: str, projection: str = "symbol-search") -> DataFrame:
    """Instruments by exact symbol or cusip, symbol pattern, description word or description pattern."""
    symbol, text = F.col("symbol"), F.col("description")
    if projection in ("symbol-search", "search", "fundamental"):
        return instruments.filter((symbol == pattern) | (F.col("cusip") == pattern) if "cusip" in instruments.columns
                                  else symbol == pattern)
    if projection == "symbol-regex":
        return instruments.filter(symbol.rlike(f"^(?:{pattern})$"))
    if projection == "desc-search":
        return instruments.filter(F.array_contains(F.split(F.lower(text), r"\W+"), pattern.lower()))
    if projection == "desc-regex":
        return instruments.filter(text.rlike(rf"\b(?:{pattern})"))
    raise ValueError(f"unknown projection {projection!r}")
