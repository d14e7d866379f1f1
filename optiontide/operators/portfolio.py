"""Positions, market value, weights and risk."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from optiontide.functions.orders import is_profitable
from optiontide.operators.tables import upsert
from optiontide.session import run_dir


# --------------------------------------------------------------------------- positions


def with_ownership(positions: DataFrame) -> DataFrame:
    """A position is owned when it has a non-empty purchase date."""
    return positions.withColumn("ownership_status", F.coalesce(F.col("purchase_date").cast("string") != "", F.lit(False)))


def upsert_positions(positions: DataFrame, new: DataFrame, order: Sequence[str] = ("purchase_date",)) -> DataFrame:
    """Add or replace positions by symbol; missing quantity and price are 0."""
    filled = new.withColumns({
        "quantity": F.coalesce("quantity", F.lit(0)), "purchase_price": F.coalesce("purchase_price", F.lit(0.0)),
    })
    return upsert(with_ownership(filled), positions, ["symbol"], order)


def remove_positions(positions: DataFrame, symbols: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Positions left, and each asked symbol with whether it was removed."""
    asked = symbols.select("symbol").distinct()
    held = positions.select(F.col("symbol").alias("__held")).distinct()
    outcome = asked.join(held, F.col("symbol") == F.col("__held"), "left")
    return (
        positions.join(asked, "symbol", "left_anti"),
        outcome.select("symbol", F.col("__held").isNotNull().alias("removed")),
    )


def set_ownership(positions: DataFrame, changes: DataFrame) -> DataFrame:
    """Flag from ``changes(symbol, owned)`` where there is one."""
    latest = changes.groupBy("symbol").agg(F.bool_or("owned").alias("__owned"))
    return (
        positions.join(latest, "symbol", "left")
        .withColumn("ownership_status", F.coalesce("__owned", "ownership_status"))
        .drop("__owned")
    )


def in_portfolio(positions: DataFrame, symbols: DataFrame) -> DataFrame:
    """Each asked symbol with membership and ownership flag."""
    held = positions.groupBy(F.col("symbol").alias("__s")).agg(F.bool_or("ownership_status").alias("__owned"))
    asked = symbols.select("symbol").distinct()
    return asked.join(held, F.col("symbol") == F.col("__s"), "left").select(
        "symbol", F.col("__s").isNotNull().alias("in_portfolio"), F.coalesce("__owned", F.lit(False)).alias("owned")
    )


# --------------------------------------------------------------------------- value


def mark_positions(positions: DataFrame, quotes: DataFrame, price: str = "lastPrice") -> DataFrame:
    """Held symbols with their quote."""
    return positions.join(quotes.select("symbol", F.col(price).alias("current_price")), "symbol")


def market_value(positions: DataFrame, quotes: DataFrame, price: str = "lastPrice") -> DataFrame:
    """Value, invested capital and profit or loss of each quoted position."""
    now, paid, quantity = F.col("current_price"), F.col("purchase_price"), F.col("quantity")
    return mark_positions(positions, quotes, price).select(
        "symbol",
        "asset_type",
        "quantity",
        "purchase_price",
        "current_price",
        is_profitable(now, paid).alias("is_profitable"),
        (now * quantity).alias("total_market_value"),
        (quantity * paid).alias("total_invested_capital"),
        ((now - paid) * quantity).alias("total_loss_or_gain"),
        F.round(F.try_divide(now - paid, paid), 4).alias("total_loss_or_gain_pct"),
    )


def market_value_totals(positions: DataFrame, quotes: DataFrame, price: str = "lastPrice") -> DataFrame:
    """One row of totals; the position count includes positions without a quote."""
    gain = F.col("total_loss_or_gain")
    held = positions.agg(F.countDistinct("symbol")).scalar()
    return market_value(positions, quotes, price).agg(
        F.coalesce(F.sum("total_market_value"), F.lit(0.0)).alias("total_market_value"),
        F.coalesce(F.sum("total_invested_capital"), F.lit(0.0)).alias("total_invested_capital"),
        F.coalesce(F.sum("total_loss_or_gain"), F.lit(0.0)).alias("total_profit_or_loss"),
        F.count_if(gain > 0).alias("number_of_profitable_positions"),
        F.count_if(gain < 0).alias("number_of_non_profitable_positions"),
        F.count_if(gain == 0).alias("number_of_breakeven_positions"),
    ).withColumn("total_positions", held)


def allocation(positions: DataFrame) -> DataFrame:
    """Positions, quantity and invested capital per asset class.

    Aggregates only: the positions of a class stay rows of the position table.
    """
    return positions.groupBy("asset_type").agg(
        F.count(F.lit(1)).alias("positions"),
        F.sum("quantity").alias("quantity"),
        F.sum(F.col("quantity") * F.col("purchase_price")).alias("invested_capital"),
    )


def weights(positions: DataFrame, quotes: DataFrame, price: str = "lastPrice") -> DataFrame:
    """Share of each position in the total market value."""
    values = market_value(positions, quotes, price)
    total = values.agg(F.sum("total_market_value")).scalar()
    return values.select("symbol", F.try_divide(F.col("total_market_value"), total).alias("weight"))


# --------------------------------------------------------------------------- risk


def return_stats(returns: DataFrame, ret: str = "ret", by: Sequence[str] = ("symbol",)) -> DataFrame:
    """Mean, sample deviation and variance of returns."""
    return returns.groupBy(*by).agg(
        F.avg(ret).alias("average_returns"),
        F.stddev_samp(ret).alias("standard_deviation_of_returns"),
        F.var_samp(ret).alias("variance_of_returns"),
        F.count(ret).alias("observations"),
    )


_PAIR_SUMS = "symbol_a string, symbol_b string, n bigint, sa double, sb double, sab double"


# Symbols of a tile, and rows of a tile pair that one task sums.
TILE_SYMBOLS = 512
SLICE_ROWS = 2_000_000


def return_covariance(returns: DataFrame, ret: str = "ret", symbol: str = "symbol", ts: str = "ts", tiles: int | None = None,
                      slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Sample covariance of every ordered symbol pair over their common times: symbols squared, by definition.

    No row pairs are formed. Symbols fall into hash tiles of about
    ``TILE_SYMBOLS`` (counted first, unless ``tiles`` is given); each row is sent
    to the tile pairs it belongs to. A task takes one tile pair in one slice of
    the times and sums matrix products, keeping only a tile-by-tile block; block
    sums are then added per symbol pair. Repeated rows of a symbol and time are averaged first. Values are
    centred on the symbol mean before any product is taken.
    """
    clean = returns.select(F.col(symbol).alias("symbol"), F.col(ts).alias("ts"), F.col(ret).cast("double").alias("x"))
    clean = clean.dropna().groupBy("symbol", "ts").agg(F.avg("x").alias("x"))
    means = clean.groupBy("symbol").agg(F.avg("x").alias("__m"), F.count(F.lit(1)).alias("__n"))
    symbols, rows = means.agg(F.count(F.lit(1)), F.coalesce(F.sum("__n"), F.lit(0))).first()
    tiles = tiles or max(1, -(-symbols // TILE_SYMBOLS))
    # every row goes to `tiles` tile pairs, of which there are tiles * (tiles + 1) / 2
    slices = max(1, -(-2 * rows // ((tiles + 1) * slice_rows)))
    centred = clean.join(means, "symbol").select("symbol", "ts", (F.col("x") - F.col("__m")).alias("x"))
    tile = F.pmod(F.xxhash64("symbol"), F.lit(tiles)).cast("int")
    partners = F.sequence(F.lit(0), F.lit(tiles - 1))
    spread = centred.withColumn("tile", tile).select("*", F.explode(partners).alias("other"))
    keyed = spread.select(
        F.least("tile", "other").alias("ta"), F.greatest("tile", "other").alias("tb"), "tile",
        F.pmod(F.xxhash64("ts"), F.lit(slices)).cast("int").alias("part"), "ts", "symbol", "x",
    )
    placed = keyed.repartition("ta", "tb", "part").sortWithinPartitions("ta", "tb", "part", "ts")
    sums = placed.mapInPandas(_pair_sums, _PAIR_SUMS)
    pairs = sums.groupBy("symbol_a", "symbol_b").agg(
        F.sum("n").alias("n"), F.sum("sa").alias("sa"), F.sum("sb").alias("sb"), F.sum("sab").alias("sab")
    )
    half = pairs.select(
        "symbol_a", "symbol_b", "n",
        F.when(F.col("n") > 1, (F.col("sab") - F.col("sa") * F.col("sb") / F.col("n")) / (F.col("n") - 1)).alias("cov"),
    )
    both = F.when(F.col("symbol_a") == F.col("symbol_b"), F.array(F.struct("symbol_a", "symbol_b"))).otherwise(
        F.array(F.struct("symbol_a", "symbol_b"),
                F.struct(F.col("symbol_b").alias("symbol_a"), F.col("symbol_a").alias("symbol_b")))
    )
    return half.select(F.inline(both), "n", "cov").select("symbol_a", "symbol_b", "n", "cov")


class _Side:
    """The symbols of one side of a block and their places."""

    def __init__(self) -> None:
        self.index: dict[str, int] = {}

    def places(self, names: pd.Series) -> np.ndarray:
        for name in names.unique():
            self.index.setdefault(name, len(self.index))
        return names.map(self.index).to_numpy(dtype=np.int64)


def _grown(block: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """The block with room for ``shape``; sides double, so a block is copied a few times only."""
    if block.shape[0] >= shape[0] and block.shape[1] >= shape[1]:
        return block
    room = tuple(have if have >= need else max(64, 2 * have, need) for have, need in zip(block.shape, shape))
    out = np.zeros(room)
    out[: block.shape[0], : block.shape[1]] = block
    return out


class _Block:
    """Running sums of one tile pair: counts, sums and products of (symbol of the lower tile, symbol of the higher one)."""

    def __init__(self, same: bool) -> None:
        self.left = _Side()
        self.right = self.left if same else _Side()
        self.same = same
        self.sums: list[np.ndarray] = [np.zeros((0, 0))] * 4

    def add(self, rows: pd.DataFrame, low: int) -> None:
        times, line = np.unique(rows["ts"].to_numpy(), return_inverse=True)
        on_left = (rows["tile"] == low).to_numpy()
        parts = []
        for side, own in ((self.left, on_left),) if self.same else ((self.left, on_left), (self.right, ~on_left)):
            place = side.places(rows["symbol"][own])
            x, seen = np.zeros((len(times), len(side.index))), np.zeros((len(times), len(side.index)))
            x[line[own], place], seen[line[own], place] = rows["x"].to_numpy()[own], 1.0
            parts.append((seen, x))
        (seen_a, a), (seen_b, b) = parts[0], parts[-1]
        shape = len(self.left.index), len(self.right.index)
        self.sums = [_grown(m, shape) for m in self.sums]
        for m, (p, q) in zip(self.sums, ((seen_a, seen_b), (a, seen_b), (seen_a, b), (a, b))):
            m[: shape[0], : shape[1]] += p.T @ q

    def rows(self) -> pd.DataFrame:
        lefts, rights = (np.array(list(side.index), dtype=object) for side in (self.left, self.right))
        i, j = np.nonzero(self.sums[0] > 0)
        if self.same:  # every unordered pair once
            keep = lefts[i] <= rights[j] if len(i) else np.zeros(0, dtype=bool)
            i, j = i[keep], j[keep]
        a, b = lefts[i], rights[j]
        swap = (a > b) if len(i) else np.zeros(0, dtype=bool)
        n, sa, sb, sab = (m[i, j] for m in self.sums)
        return pd.DataFrame({
            "symbol_a": np.where(swap, b, a), "symbol_b": np.where(swap, a, b), "n": n.astype("int64"),
            "sa": np.where(swap, sb, sa), "sb": np.where(swap, sa, sb), "sab": sab,
        })


def _pair_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums of each (tile pair, slice) of a partition sorted by them and by time."""
    group, block, held = None, None, None
    for batch in batches:
        batch = batch if held is None else pd.concat([held, batch], ignore_index=True)
        held = None
        for key, rows in batch.groupby(["ta", "tb", "part"], sort=True):
            if key != group:
                if block is not None:
                    yield block.rows()
                group, block = key, _Block(key[0] == key[1])
            if rows.index[-1] == batch.index[-1]:  # the last time may go on in the next batch
                last = rows["ts"].iloc[-1]
                held = rows[rows["ts"] == last]
                rows = rows[rows["ts"] != last]
            if len(rows):
                block.add(rows, key[0])
    if held is not None and len(held):
        block.add(held, group[0])
    if block is not None:
        yield block.rows()


def portfolio_variance(weight_table: DataFrame, covariance: DataFrame) -> DataFrame:
    """w' S w as one row."""
    a = weight_table.select(F.col("symbol").alias("symbol_a"), F.col("weight").alias("wa"))
    b = weight_table.select(F.col("symbol").alias("symbol_b"), F.col("weight").alias("wb"))
    joined = covariance.join(a, "symbol_a").join(b, "symbol_b")
    return joined.agg(F.sum(F.col("wa") * F.col("wb") * F.col("cov")).alias("variance"))


def portfolio_metrics(positions: DataFrame, quotes: DataFrame, returns: DataFrame) -> DataFrame:
    """Weight, mean, weighted mean, deviation and variance per symbol, with the portfolio variance on each row."""
    spark, path = returns.sparkSession, run_dir(returns.sparkSession, "portfolio")
    weights(positions, quotes).write.parquet(f"{path}/weights")  # each input is computed once
    w = spark.read.parquet(f"{path}/weights")
    returns.join(w.select("symbol"), "symbol", "left_semi").write.parquet(f"{path}/returns")
    held = spark.read.parquet(f"{path}/returns")
    variance = portfolio_variance(w, return_covariance(held)).scalar()
    return (
        return_stats(held).drop("observations").join(w, "symbol")
        .withColumn("weighted_returns", F.col("average_returns") * F.col("weight"))
        .withColumn("portfolio_variance", variance)
    )


def portfolio_summary(positions: DataFrame, quotes: DataFrame) -> DataFrame:
    """Market value and weight per position."""
    return market_value(positions, quotes).join(weights(positions, quotes), "symbol")


# --------------------------------------------------------------------------- signals to orders


def signals_to_orders(signals: DataFrame, trades: DataFrame, exclusive_buys: bool = False) -> DataFrame:
    """Signalled symbols that have a trade template for that side, with the ownership they lead to.

    ``exclusive_buys`` looks at sells only when there is no buy at all.
    """
    unique = signals.select("symbol", "side").distinct()
    if exclusive_buys:
        any_buy = F.coalesce(unique.agg(F.bool_or(F.col("side") == "buy")).scalar(), F.lit(False))
        unique = unique.filter((F.col("side") == "buy") | ~any_buy)
    return unique.join(trades, ["symbol", "side"]).withColumn("ownership_after", F.col("side") == "buy")


def apply_order_ownership(positions: DataFrame, orders: DataFrame) -> DataFrame:
    return set_ownership(positions, orders.select("symbol", F.col("ownership_after").alias("owned")))
