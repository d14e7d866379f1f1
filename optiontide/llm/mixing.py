"""Mixing sources to target weights by entropy balancing.

Every document starts with a rate of one copy. The rates nearest to that in
relative entropy, at most ``most`` copies each, that give every source its
target of words are ``min(most, exp(tilt[source] * size / scale[source]))``. The tilts solve a convex
dual, one constraint per source, by Newton steps; a step is one aggregation
over the (source, size) classes, whose sums are decimals and so the same in any
order. Rates become whole copies by carrying the fraction on along the sizes of
a source, then single copies are added or taken back where that brings a source
nearer to its target.

On the driver stand only values per source. A source's class table has at most
one row per distinct size; no source, class or document is ordered in one task.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from optiontide.llm.common import without
from optiontide.session import shared_dir

#: Weights of the sources by code point, null last, repeating (fixed values).
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
STEPS = 60
REPAIRS = 12
#: Parts of a copy that are carried as whole numbers.
PART = 1 << 20
#: Hash parts of a class, each numbered on its own.
PARTS = 256


def source_order(name: str | None):
    """Sort key: code points, null last."""
    return (name is None, [ord(c) for c in name or ""])


def targets(sizes: dict[str | None, int], weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> dict[str | None, float]:
    """Words of each source: ``share`` of all by weight, none above ``most`` times its size, the excess reshared."""
    names = sorted(sizes, key=source_order)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total >= most * sizes[s]}
        if not full:
            out.update({s: left * weight[s] / total for s in open_})
            break
        out.update({s: float(most * sizes[s]) for s in full})
        left -= sum(most * sizes[s] for s in full)
        open_ -= full
    return out


def _by_source(spark: SparkSession, values: dict[str | None, tuple], names: str) -> DataFrame:
    return spark.createDataFrame([(s, *v) for s, v in values.items()], f"__s string, {names}")


def _with_source(df: DataFrame, small: DataFrame) -> DataFrame:
    return df.join(small, F.col("source").eqNullSafe(F.col("__s"))).drop("__s")


def _rate(tilt: Column, size: Column, scale: Column, most: int) -> Column:
    return F.least(F.lit(float(most)), F.exp(F.least(tilt * size / scale, F.lit(50.0))))


def solve_tilts(spark: SparkSession, classes: DataFrame, sizes: dict, counts: dict, goal: dict, most: int = MOST, steps: int = STEPS) -> dict:
    """Tilt and scale of each source whose target lies strictly between 0 and ``most`` times its size.

    ``classes`` has source, size, n. Newton steps that leave the known bracket
    of a root are replaced by its middle, so every step narrows the bracket.
    """
    open_ = {s for s in sizes if 0 < goal[s] < most * sizes[s]}
    scale = {s: max(1.0, sizes[s] / counts[s]) for s in sizes}
    tilt, low, high = {s: 0.0 for s in open_}, {s: -math.inf for s in open_}, {s: math.inf for s in open_}
    for _ in range(steps):
        if not open_:
            break
        rows = _with_source(classes, _by_source(spark, {s: (tilt[s], scale[s]) for s in open_}, "tilt double, scale double"))
        rate = _rate(F.col("tilt"), F.col("size"), F.col("scale"), most)
        words = F.col("n") * F.col("size") * rate
        slope = F.when(rate < most, words * F.col("size") / F.col("scale")).otherwise(0.0)
        exact = "decimal(38,9)"
        sums = rows.groupBy("source").agg(F.sum(words.cast(exact)).alias("words"), F.sum(slope.cast(exact)).alias("slope")).collect()
        for r in sums:
            s, gap, step = r["source"], float(r["words"]) - goal[r["source"]], float(r["slope"])
            if abs(gap) <= 1e-9 * goal[s]:
                open_.discard(s)
                continue
            if gap > 0:
                high[s] = min(high[s], tilt[s])
            else:
                low[s] = max(low[s], tilt[s])
            new = tilt[s] - gap / step if step > 0 else math.nan
            if not low[s] < new < high[s]:
                if math.isinf(high[s]):
                    new = max(1.0, 2 * low[s])
                elif math.isinf(low[s]):
                    new = min(-1.0, 2 * high[s])
                else:
                    new = (low[s] + high[s]) / 2
            if new == tilt[s]:
                open_.discard(s)
            tilt[s] = new
    return {s: (t, scale[s]) for s, t in tilt.items()}


def _class_copies(classes: DataFrame, most: int) -> DataFrame:
    """``copies`` of each class: fractions of a copy carried along the sizes of a source, in blocks of sizes."""
    whole = F.round(F.col("n") * F.col("rate") * PART).cast("long")
    rows = classes.withColumn("__w", whole).withColumn("__block", F.floor(F.log2(F.col("size") + 1) * 4))
    before = Window.partitionBy("source").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("source", "__block").agg(F.sum("__w").alias("__sum")).select(
        F.col("source").alias("__s"), F.col("__block").alias("__b"), F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__from"))
    inner = Window.partitionBy("source", "__block").orderBy("size").rowsBetween(Window.unboundedPreceding, 0)
    end = F.col("__from") + F.sum("__w").over(inner)
    rows = rows.join(blocks, F.col("source").eqNullSafe(F.col("__s")) & (F.col("__block") == F.col("__b"))).withColumn("__end", end)
    half = F.lit(PART // 2)
    nearest = F.floor((F.col("__end") + half) / PART) - F.floor((F.col("__end") - F.col("__w") + half) / PART)
    return rows.withColumn("copies", F.least(nearest.cast("long"), F.col("n") * most)).drop("__w", "__block", "__s", "__b", "__from", "__end")


def _repaired(spark: SparkSession, classes: DataFrame, goal: dict, most: int, rounds: int) -> DataFrame:
    """Copies moved by one, class by class, as long as that brings a source nearer to its target."""
    totals = {r["source"]: r["taken"] for r in classes.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("taken")).collect()}
    moves: dict[tuple, int] = {}
    done: set = set()
    for _ in range(rounds):
        gaps = {s: (goal[s] - t,) for s, t in totals.items() if s not in done and abs(goal[s] - t) > 0.5}
        if not gaps:
            break
        rows = _with_source(_moved(spark, classes, moves), _by_source(spark, gaps, "gap double")).where("size > 0")
        step = F.signum("gap").cast("long")
        fits = F.when(step > 0, F.col("copies") < F.col("n") * most).otherwise(F.col("copies") > 0)
        left = F.abs(F.col("gap") - step * F.col("size"))
        best = rows.where(fits & (left < F.abs("gap"))).groupBy("source").agg(
            F.min(F.struct(left.alias("left"), F.col("size"), step.alias("step"))).alias("best")).collect()
        found = {r["source"]: r["best"] for r in best}
        for s in gaps:
            if s not in found:
                done.add(s)
                continue
            size, step = found[s]["size"], found[s]["step"]
            moves[s, size] = moves.get((s, size), 0) + step
            totals[s] += step * size
    return _moved(spark, classes, moves)


def _moved(spark: SparkSession, classes: DataFrame, moves: dict[tuple, int]) -> DataFrame:
    if not moves:
        return classes
    small = spark.createDataFrame([(s, n, m) for (s, n), m in moves.items()], "__s string, __size long, __move long")
    same = F.col("source").eqNullSafe(F.col("__s")) & (F.col("size") == F.col("__size"))
    return classes.join(small, same, "left").withColumn("copies", F.col("copies") + F.coalesce("__move", F.lit(0))).drop("__s", "__size", "__move")


def mix(df: DataFrame, source: str, size: Column, order: list[str], weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``df`` with ``size``, ``source_size``, ``target``, ``rate`` and ``copies`` (0 to ``most``) of each row.

    ``order`` names the columns (a key first) that tell rows apart; rows alike
    in all of them may swap copies, so the result as a whole does not change.
    Rows without words keep a rate of 1 and one copy. Null sources are one
    source, the last. Columns of the new names are replaced. Work tables go to
    the shared folder.
    """
    spark = df.sparkSession
    kept = without(df, "size", "source_size", "target", "rate", "copies").columns
    names = [f"__order{i}" for i in range(len(order))]
    rows = df.select(*[F.col(f"`{c}`") for c in kept], size.cast("long").alias("size"), F.col(source).alias("__src"),
                     F.pmod(F.xxhash64(*order), F.lit(PARTS)).alias("__part"), *[F.col(o).alias(n) for o, n in zip(order, names, strict=True)])
    parts_path = f"{shared_dir(spark)}/mix-{uuid.uuid4().hex}"
    rows.groupBy(F.col("__src").alias("source"), "size", F.col("__part").alias("part")).agg(F.count(F.lit(1)).alias("m")).write.parquet(f"{parts_path}/parts")
    parts = spark.read.schema("source string, size long, part long, m long").parquet(f"{parts_path}/parts")
    parts.groupBy("source", "size").agg(F.sum("m").alias("n")).write.parquet(f"{parts_path}/classes")
    classes = spark.read.schema("source string, size long, n long").parquet(f"{parts_path}/classes")
    sums = classes.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("words"), F.sum("n").alias("n")).collect()
    sizes, counts = {r["source"]: r["words"] for r in sums}, {r["source"]: r["n"] for r in sums}
    goal = targets(sizes, weights, share, most)
    tilts = solve_tilts(spark, classes, sizes, counts, goal, most)
    plan = {s: (sizes[s], goal[s], *(tilts.get(s) or (0.0, 1.0)), s not in tilts and goal[s] > 0) for s in sizes}
    small = _by_source(spark, plan, "source_size long, target double, tilt double, scale double, full boolean")
    rate = F.when(F.col("size") == 0, 1.0).when(F.col("full"), float(most)).otherwise(_rate(F.col("tilt"), F.col("size"), F.col("scale"), most))
    rated = _with_source(classes, small).withColumn("rate", F.round(rate, 9)).drop("tilt", "scale", "full")
    _class_copies(rated, most).write.parquet(f"{parts_path}/copies")
    kinds = f"source string, size long, n long, source_size long, target double, rate double, copies long"
    settled = _repaired(spark, spark.read.schema(kinds).parquet(f"{parts_path}/copies"), goal, most, REPAIRS)

    before = Window.partitionBy("source", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    known = settled.select(F.col("source").alias("__s"), F.col("size").alias("__size"), "n", "copies", "source_size", "target", "rate")
    end = F.sum("m").over(before)
    dealt = (
        parts.withColumn("end", end)
        .join(known, F.col("source").eqNullSafe(F.col("__s")) & (F.col("size") == F.col("__size")))
        .select(
            F.col("source").alias("__s"), F.col("size").alias("__size"), F.col("part").alias("__p"), "source_size", "target", "rate", F.col("m").alias("__m"),
            (F.expr("(end * copies) div n") - F.expr("((end - m) * copies) div n")).alias("__share"))
    )
    place = F.row_number().over(Window.partitionBy("__src", "size", "__part").orderBy(*names)).cast("long")
    same = F.col("__src").eqNullSafe(F.col("__s")) & (F.col("size") == F.col("__size")) & (F.col("__part") == F.col("__p"))
    return (
        rows.withColumn("__k", place).join(dealt, same)
        .withColumn("copies", (F.expr("(__k * __share) div __m") - F.expr("((__k - 1) * __share) div __m")).cast("int"))
        .drop("__src", "__part", "__k", "__s", "__size", "__p", "__m", "__share", *names)
    )
