"""Top movers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Sort orders as (column, descending), movers per list, periods.
MOVER_SORTS = {
    "VOLUME": ("volume", True),
    "TRADES": ("trades", True),
    "PERCENT_CHANGE_UP": ("pct_change", True),
    "PERCENT_CHANGE_DOWN": ("pct_change", False),
}
MOVERS = 10
FREQUENCIES = (0, 1, 5, 10, 30, 60)


def movers(quotes: DataFrame, sort: str = "VOLUME", universe: str = "universe", frequency: int = 0) -> DataFrame:
    """The top ten per universe; equal values rank by symbol.

    Percent sorts with a ``frequency`` look at the change over that many
    minutes, column ``pct_change_<n>m``; 0 is the change over the day, ``pct_change``.
    """
    if sort not in MOVER_SORTS:
        raise ValueError(f"unknown sort {sort!r}; one of {', '.join(MOVER_SORTS)}")
    if frequency not in FREQUENCIES:
        raise ValueError(f"unknown frequency {frequency!r}")
    column, descending = MOVER_SORTS[sort]
    if frequency and column == "pct_change":
        column = f"pct_change_{frequency}m"
    order = F.col(column).desc() if descending else F.col(column).asc()
    w = W.partitionBy(universe).orderBy(order, "symbol")
    return quotes.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= MOVERS)
