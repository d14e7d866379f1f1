"""Field names of the market-data feed.

Fixed values of the feed: for each service the names of fields 0, 1, 2, ...
"""

SERVICE_FIELDS: dict[str, tuple[str, ...]] = {
    "ACCT_ACTIVITY": (
        "SUBSCRIPTION_KEY", "ACCOUNT", "MESSAGE_TYPE", "MESSAGE_DATA",
    ),
    "CHART_EQUITY": (
        "SYMBOL", "SEQUENCE", "OPEN_PRICE", "HIGH_PRICE", "LOW_PRICE", "CLOSE_PRICE", "VOLUME", "CHART_TIME_MILLIS",
        "CHART_DAY",
    ),
    "CHART_FUTURES": (
        "SYMBOL", "CHART_TIME_MILLIS", "OPEN_PRICE", "HIGH_PRICE", "LOW_PRICE", "CLOSE_PRICE", "VOLUME",
    ),
    "LEVELONE_EQUITIES": (
        "SYMBOL", "BID_PRICE", "ASK_PRICE", "LAST_PRICE", "BID_SIZE", "ASK_SIZE", "ASK_ID", "BID_ID", "TOTAL_VOLUME",
        "LAST_SIZE", "HIGH_PRICE", "LOW_PRICE", "CLOSE_PRICE", "EXCHANGE_ID", "MARGINABLE", "DESCRIPTION", "LAST_ID",
        "OPEN_PRICE", "NET_CHANGE", "HIGH_PRICE_52_WEEK", "LOW_PRICE_52_WEEK", "PE_RATIO", "DIVIDEND_AMOUNT",
        "DIVIDEND_YIELD", "NAV", "EXCHANGE_NAME", "DIVIDEND_DATE", "REGULAR_MARKET_QUOTE", "REGULAR_MARKET_TRADE",
        "REGULAR_MARKET_LAST_PRICE", "REGULAR_MARKET_LAST_SIZE", "REGULAR_MARKET_NET_CHANGE", "SECURITY_STATUS",
        "MARK", "QUOTE_TIME_MILLIS", "TRADE_TIME_MILLIS", "REGULAR_MARKET_TRADE_MILLIS", "BID_TIME_MILLIS",
        "ASK_TIME_MILLIS", "ASK_MIC_ID", "BID_MIC_ID", "LAST_MIC_ID", "NET_CHANGE_PERCENT",
        "REGULAR_MARKET_CHANGE_PERCENT", "MARK_CHANGE", "MARK_CHANGE_PERCENT", "HTB_QUANTITY", "HTB_RATE",
        "HARD_TO_BORROW", "IS_SHORTABLE", "POST_MARKET_NET_CHANGE", "POST_MARKET_NET_CHANGE_PERCENT",
    ),
    "LEVELONE_OPTIONS": (
        "SYMBOL", "DESCRIPTION", "BID_PRICE", "ASK_PRICE", "LAST_PRICE", "HIGH_PRICE", "LOW_PRICE", "CLOSE_PRICE",
        "TOTAL_VOLUME", "OPEN_INTEREST", "VOLATILITY", "MONEY_INTRINSIC_VALUE", "EXPIRATION_YEAR", "MULTIPLIER",
        "DIGITS", "OPEN_PRICE", "BID_SIZE", "ASK_SIZE", "LAST_SIZE", "NET_CHANGE", "STRIKE_TYPE", "CONTRACT_TYPE",
        "UNDERLYING", "EXPIRATION_MONTH", "DELIVERABLES", "TIME_VALUE", "EXPIRATION_DAY", "DAYS_TO_EXPIRATION",
        "DELTA", "GAMMA", "THETA", "VEGA", "RHO", "SECURITY_STATUS", "THEORETICAL_OPTION_VALUE", "UNDERLYING_PRICE",
        "UV_EXPIRATION_TYPE", "MARK", "QUOTE_TIME_MILLIS", "TRADE_TIME_MILLIS", "EXCHANGE_ID", "EXCHANGE_NAME",
        "LAST_TRADING_DAY", "SETTLEMENT_TYPE", "NET_PERCENT_CHANGE", "MARK_CHANGE", "MARK_CHANGE_PERCENT",
        "IMPLIED_YIELD", "IS_PENNY", "OPTION_ROOT", "HIGH_PRICE_52_WEEK", "LOW_PRICE_52_WEEK",
        "INDICATIVE_ASKING_PRICE", "INDICATIVE_BID_PRICE", "INDICATIVE_QUOTE_TIME", "EXERCISE_TYPE",
    ),
    "LEVELONE_FUTURES": (
        "SYMBOL", "BID_PRICE", "ASK_PRICE", "LAST_PRICE", "BID_SIZE", "ASK_SIZE", "BID_ID", "ASK_ID", "TOTAL_VOLUME",
        "LAST_SIZE", "QUOTE_TIME_MILLIS", "TRADE_TIME_MILLIS", "HIGH_PRICE", "LOW_PRICE", "CLOSE_PRICE",
        "EXCHANGE_ID", "DESCRIPTION", "LAST_ID", "OPEN_PRICE", "NET_CHANGE", "FUTURE_CHANGE_PERCENT",
        "EXCHANGE_NAME", "SECURITY_STATUS", "OPEN_INTEREST", "MARK", "TICK", "TICK_AMOUNT", "PRODUCT",
        "FUTURE_PRICE_FORMAT", "FUTURE_TRADING_HOURS", "FUTURE_IS_TRADABLE", "FUTURE_MULTIPLIER", "FUTURE_IS_ACTIVE",
        "FUTURE_SETTLEMENT_PRICE", "FUTURE_ACTIVE_SYMBOL", "FUTURE_EXPIRATION_DATE", "EXPIRATION_STYLE",
        "ASK_TIME_MILLIS", "BID_TIME_MILLIS", "QUOTED_IN_SESSION", "SETTLEMENT_DATE",
    ),
    "LEVELONE_FOREX": (
        "SYMBOL", "BID_PRICE", "ASK_PRICE", "LAST_PRICE", "BID_SIZE", "ASK_SIZE", "TOTAL_VOLUME", "LAST_SIZE",
        "QUOTE_TIME_MILLIS", "TRADE_TIME_MILLIS", "HIGH_PRICE", "LOW_PRICE", "CLOSE_PRICE", "EXCHANGE_ID",
        "DESCRIPTION", "OPEN_PRICE", "NET_CHANGE", "CHANGE_PERCENT", "EXCHANGE_NAME", "DIGITS", "SECURITY_STATUS",
        "TICK", "TICK_AMOUNT", "PRODUCT", "TRADING_HOURS", "IS_TRADABLE", "MARKET_MAKER", "HIGH_PRICE_52_WEEK",
        "LOW_PRICE_52_WEEK", "MARK",
    ),
    "LEVELONE_FUTURES_OPTIONS": (
        "SYMBOL", "BID_PRICE", "ASK_PRICE", "LAST_PRICE", "BID_SIZE", "ASK_SIZE", "BID_ID", "ASK_ID", "TOTAL_VOLUME",
        "LAST_SIZE", "QUOTE_TIME_MILLIS", "TRADE_TIME_MILLIS", "HIGH_PRICE", "LOW_PRICE", "CLOSE_PRICE", "LAST_ID",
        "DESCRIPTION", "OPEN_PRICE", "OPEN_INTEREST", "MARK", "TICK", "TICK_AMOUNT", "FUTURE_MULTIPLIER",
        "FUTURE_SETTLEMENT_PRICE", "UNDERLYING_SYMBOL", "STRIKE_PRICE", "FUTURE_EXPIRATION_DATE", "EXPIRATION_STYLE",
        "CONTRACT_TYPE", "SECURITY_STATUS", "EXCHANGE_ID", "EXCHANGE_NAME",
    ),
    "SCREENER_EQUITY": (
        "SYMBOL", "TIMESTAMP", "SORT_FIELD", "FREQUENCY", "ITEMS",
    ),
    "SCREENER_OPTION": (
        "SYMBOL", "TIMESTAMP", "SORT_FIELD", "FREQUENCY", "ITEMS",
    ),
}

# Services whose messages are order books.
BOOK_SERVICES = ("NYSE_BOOK", "NASDAQ_BOOK", "OPTIONS_BOOK")

# Words at the end of a field name that fix its type; other fields stay text.
LONG_ENDINGS = ("MILLIS", "VOLUME", "SIZE", "SEQUENCE", "INTEREST", "QUANTITY", "CHART_DAY", "LAST_TRADING_DAY")
DOUBLE_ENDINGS = (
    "PRICE", "CHANGE", "PERCENT", "52_WEEK", "MARK", "RATIO", "YIELD", "NAV", "RATE", "DELTA", "GAMMA",
    "THETA", "VEGA", "RHO", "VOLATILITY", "VALUE", "MULTIPLIER", "TICK", "TICK_AMOUNT", "DIVIDEND_AMOUNT",
)


def field_type(name: str) -> str:
    if name.endswith(LONG_ENDINGS):
        return "bigint"
    if name.endswith(DOUBLE_ENDINGS):
        return "double"
    return "string"
