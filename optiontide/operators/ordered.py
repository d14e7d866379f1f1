"""Ordered computations that stay balanced when one key holds most rows.

A plain window sorts a whole key in one task. These operators cut each key
along its order instead: into buckets that bound what one task sees, joined
by small per-bucket summaries. Results equal those of the plain window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_KEY, _BUCKET = "__key", "__bucket"


def _col(value: Column | str) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def time_bucket(ts: Column | str, seconds: float) -> Column:
    """Number of the ``seconds``-wide bucket that holds ``ts``."""
    micros = F.unix_micros(_col(ts).cast("timestamp"))
    return F.floor(micros / F.lit(round(seconds * 1_000_000)))


#: Cut points of a table: with n rows a range between two of them holds about n / CUTS of the distinct places.
CUTS = 4096


def _place(columns: Sequence[Column | str]) -> Column:
    return F.struct(*[_col(c).alias(f"c{i}") for i, c in enumerate(columns)])


def cut_points(df: DataFrame, columns: Sequence[Column | str], parts: int | None = None) -> DataFrame:
    """One row with ``cuts``: up to ``parts`` places (structs of ``columns``) in order, spread evenly over the distinct places of ``df``.

    Places are dealt to ``parts`` by hash, and each part keeps its least hash, which adds up on the map side; the places of these hashes
    are the sample. Any sortable types will do, long common prefixes or wide gaps make no difference, and nothing is read before an action.
    """
    parts = parts or CUTS
    mark = F.xxhash64(*[_col(c) for c in columns])
    least = df.select(mark.alias("h")).groupBy(F.pmod("h", F.lit(parts)).alias("part")).agg(F.min("h").alias("__least"))
    chosen = df.select(_place(columns).alias("place"), mark.alias("h")).join(F.broadcast(least.select("__least")), F.col("h") == F.col("__least"))
    return chosen.select("place").distinct().agg(F.sort_array(F.collect_list("place")).alias("cuts"))  # up to ``parts`` places


def _passed(cuts: str, place: Column, parts: int) -> Column:
    """How many of the sorted cut points in the column ``cuts`` are not behind ``place``: a binary search.

    The column is named once, so that over a table of plain columns the optimiser puts the subquery it stands for in its place and no row carries the cuts.
    """
    steps = F.array(*[F.lit(1 << k) for k in range(parts.bit_length(), -1, -1)])

    def search(x: Column) -> Column:
        return F.aggregate(steps, F.lit(0), lambda n, far: F.when(F.get(x["cuts"], n + far - 1) <= x["place"], n + far).otherwise(n))

    return F.get(F.transform(F.array(F.struct(F.col(cuts).alias("cuts"), place.alias("place"))), search), F.lit(0))


def with_order_bucket(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], name: str, parts: int | None = None, source: DataFrame | None = None
) -> DataFrame:
    """``df`` with a number that does not decrease along ``keys``, then ``order``, and cuts the table (or ``source``) into even ranges.

    A key that holds a third of the rows is cut a third of the times, a small key hardly ever. The cut points are a scalar subquery:
    they are found when the query runs.
    """
    columns, parts = [*keys, *order], parts or CUTS
    cuts = cut_points(df if source is None else source, columns, parts).scalar()
    return df.withColumn("__cuts", cuts).withColumn(name, _passed("__cuts", _place(columns), parts)).drop("__cuts")


def _bucketed(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], bucket: Column | None) -> DataFrame:
    # A struct key is never null itself, so null keys form a group and still
    # join by plain equality, which keeps the partitioning of the window.
    keyed = df.withColumn(_KEY, F.struct(*[F.col(k) for k in keys]) if keys else F.lit(0))
    return with_order_bucket(keyed, keys, order, _BUCKET) if bucket is None else keyed.withColumn(_BUCKET, bucket)


def with_ordinal(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], bucket: Column | None = None, name: str = "ordinal"
) -> DataFrame:
    """1-based position of each row within its key.

    ``bucket`` must not decrease along ``order``; without one the table is cut at sampled places. Rows are numbered inside
    (key, bucket), and the sizes of earlier buckets are added.
    """
    cut = _bucketed(df, keys, order, bucket)
    local = W.partitionBy(_KEY, _BUCKET).orderBy(*[_col(c) for c in order])
    before = W.partitionBy(_KEY).orderBy(_BUCKET).rowsBetween(W.unboundedPreceding, -1)
    sizes = cut.groupBy(_KEY, _BUCKET).agg(F.count(F.lit(1)).alias("__n"))
    offsets = sizes.select(_KEY, _BUCKET, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    numbered = cut.withColumn("__rn", F.row_number().over(local))
    return (
        numbered.join(offsets, [_KEY, _BUCKET])
        .withColumn(name, F.col("__rn") + F.col("__off"))
        .drop(_KEY, _BUCKET, "__rn", "__off")
    )


def with_previous(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], value: str, bucket: Column | None, name: str
) -> DataFrame:
    """``value`` of the row before, per key.

    Inside a bucket it is a lag; the first row of a bucket takes the last value
    of the nearest earlier bucket that has rows.
    """
    cut = _bucketed(df, keys, order, bucket)
    ordering = [_col(c) for c in order]
    local = W.partitionBy(_KEY, _BUCKET).orderBy(*ordering)
    # the value travels in a struct, so a null value is a last value like any other
    tails = cut.groupBy(_KEY, _BUCKET).agg(
        F.max_by(F.struct(F.col(value).alias("v")), F.struct(*ordering)).alias("__tail")
    )
    carried = tails.select(
        _KEY, _BUCKET, F.lag("__tail").over(W.partitionBy(_KEY).orderBy(_BUCKET))["v"].alias("__carry")
    )
    marked = cut.withColumns({"__lag": F.lag(value).over(local), "__rn": F.row_number().over(local)})
    return (
        marked.join(carried, [_KEY, _BUCKET])
        .withColumn(name, F.when(F.col("__rn") == 1, F.col("__carry")).otherwise(F.col("__lag")))
        .drop(_KEY, _BUCKET, "__lag", "__rn", "__carry")
    )


_FRAME_FUNCTIONS = {
    "mean": F.avg,
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "std": F.stddev_samp,
    "var": F.var_samp,
    "count": F.count,
}


def _frame_median(value: Column, w) -> Column:
    ordered = F.sort_array(F.collect_list(value).over(w))
    size = F.size(ordered)
    low = F.element_at(ordered, F.floor((size + 1) / 2).cast("int"))
    high = F.element_at(ordered, F.floor((size + 2) / 2).cast("int"))
    return (low + high) / 2


def rolling_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    bucket: Column | None,
    outputs: dict[str, tuple[str, int, str]],
    block_rows: int = 65536,
) -> DataFrame:
    """Windows of the last n rows per key; ``outputs`` is name -> (column, n, function).

    Rows are numbered, cut into blocks of ``block_rows``, and the last rows of
    each block are repeated in front of the next one, so every window is whole
    inside its block. A result is null until n values are there.
    """
    widest = max(n for _, n, _ in outputs.values())
    size = max(block_rows, widest)
    numbered = with_ordinal(df, keys, order, bucket, "__ord")
    position = (F.col("__ord") - 1) % size
    home = F.floor((F.col("__ord") - 1) / size)
    blocks = F.when(position >= size - (widest - 1), F.array(home, home + 1)).otherwise(F.array(home))
    spread = numbered.select("*", home.alias("__home"), F.explode(blocks).alias("__block"))
    base = W.partitionBy(*keys, "__block").orderBy("__ord")
    columns = {}
    for name, (column, n, fn) in outputs.items():
        w = base.rowsBetween(-(n - 1), 0)
        value = F.col(column)
        if fn == "median":
            result = _frame_median(value, w)
        elif fn in _FRAME_FUNCTIONS:
            result = _FRAME_FUNCTIONS[fn](value).over(w)
        else:
            raise ValueError(f"unknown rolling function {fn!r}")
        present = F.lit(1) if fn == "count" else value  # a count waits for n rows, the others for n values
        columns[name] = F.when(F.count(present).over(w) >= n, result)
    return (
        spread.withColumns(columns).filter(F.col("__home") == F.col("__block")).drop("__ord", "__home", "__block")
    )


def trailing_count(
    df: DataFrame, keys: Sequence[str], ts: str, seconds: int, name: str, bucket_seconds: float = 3600
) -> DataFrame:
    """Rows of the same key in the ``seconds`` up to and including each row's time.

    Each key is cut along time every ``bucket_seconds`` (never below the window), so a hot key is spread over as many groups as it has hours. Buckets
    overlap by the window: a row near the end of one is repeated
    in the next one, where it only counts towards other rows. Nothing is read while the plan is built.
    """
    width = max(bucket_seconds, seconds)
    instant = F.col(ts).cast("timestamp")
    bucket = time_bucket(ts, width)
    reach = time_bucket(instant + F.make_interval(secs=F.lit(seconds)), width)
    homes = F.when(reach > bucket, F.array(bucket, bucket + 1)).otherwise(F.array(bucket))
    micros = F.unix_micros(instant)
    spread = df.select("*", micros.alias("__us"), bucket.alias("__home"), F.explode(homes).alias(_BUCKET))
    w = W.partitionBy(*keys, _BUCKET).orderBy("__us").rangeBetween(-seconds * 1_000_000, 0)
    counted = spread.withColumn(name, F.count(F.lit(1)).over(w))
    return counted.filter(F.col("__home").eqNullSafe(F.col(_BUCKET))).drop("__us", "__home", _BUCKET)
