"""Symbol universes as set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from optiontide.functions.symbols import adapt_symbol, normalised_option_symbol
from optiontide.operators.ordered import with_ordinal

# Fixed value: symbols one account may stream.
STREAM_SYMBOLS_PER_ACCOUNT = 200


def listed_options(master: DataFrame, drop_test: bool = True) -> DataFrame:
    """Option master without test issues."""
    return master.filter(F.col("test_issue_flag") == "N") if drop_test else master


def option_underlyings(master: DataFrame, drop_test: bool = True) -> DataFrame:
    """Distinct underlyings, without nulls and the text "nan"."""
    names = listed_options(master, drop_test).select(F.col("underlying").alias("symbol"))
    return names.filter("symbol is not null and symbol <> 'nan'").distinct()


def equity_universe(master: DataFrame, drop_test: bool = True, drop_otc: bool = False, adapt: bool = True) -> DataFrame:
    rows = master.filter(F.col("test_issue_flag") == "N") if drop_test else master
    if drop_otc:
        rows = rows.filter(F.col("Primary_Listing_Mkt") != "U")
    name = adapt_symbol("Symbol") if adapt else F.col("Symbol")
    return rows.filter("Symbol is not null").select(name.alias("symbol")).distinct()


def index_options(options: DataFrame, equities: DataFrame, adapt: bool = True) -> DataFrame:
    """Option underlyings that are no listed equity."""
    out = options.select("symbol").subtract(equities.select("symbol"))
    return out.select(adapt_symbol("symbol", True).alias("symbol")) if adapt else out


def equity_options(options: DataFrame, equities: DataFrame, adapt: bool = True) -> DataFrame:
    out = options.select("symbol").intersect(equities.select("symbol"))
    return out.select(adapt_symbol("symbol").alias("symbol")) if adapt else out


def option_universe(options: DataFrame, equities: DataFrame, blocked: Sequence[str] = (),
                    adapt: bool = True) -> DataFrame:
    """All option underlyings in request form, index ones with ``$``, minus those the caller blocks."""
    known = equities.select(F.col("symbol").alias("__e")).distinct()
    flagged = options.select("symbol").distinct().join(known, F.col("symbol") == F.col("__e"), "left")
    name = adapt_symbol("symbol", F.col("__e").isNull()) if adapt else F.col("symbol")
    return flagged.select(name.alias("symbol")).filter(~F.col("symbol").isin(list(blocked)))


def normalise_option_master(master: DataFrame) -> DataFrame:
    """Option master with the symbol in UNDER_MMDDYYC123.5 form."""
    return master.withColumn("symbol", normalised_option_symbol("optionID", "underlying"))


def missing_symbols(universe: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Symbols not in the snapshot yet."""
    return universe.select("symbol").distinct().join(snapshot.select("symbol").distinct(), "symbol", "left_anti")


def add_symbols(universe: DataFrame, delta: DataFrame) -> DataFrame:
    return universe.select("symbol").union(delta.select("symbol")).distinct()


def remove_symbols(universe: DataFrame, delta: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Universe left, and the symbols that were removed from it."""
    gone = delta.select("symbol").distinct()
    kept = universe.select("symbol").distinct()
    return kept.join(gone, "symbol", "left_anti"), kept.join(gone, "symbol", "left_semi")


def chunk_symbols(universe: DataFrame, chunks: int) -> DataFrame:
    """Consecutive chunks 1..n of the sorted distinct symbols, each ceil(size / n) long.

    Positions come from counts of ranges between sampled symbols, so the universe is not gathered to be numbered, whatever
    prefixes its symbols share.
    """
    symbols = universe.select("symbol").distinct()
    placed = with_ordinal(symbols, [], ["symbol"], name="position")
    size = F.ceil(symbols.agg(F.count(F.lit(1))).scalar() / chunks)
    return placed.withColumn("chunk", F.ceil(F.col("position") / size))


def head_symbols(universe: DataFrame, accounts: int, per_account: int = STREAM_SYMBOLS_PER_ACCOUNT) -> DataFrame:
    """The first symbols that all accounts together may stream."""
    return universe.select("symbol").orderBy("symbol").limit(accounts * per_account)
