"""General table operators the others are built from."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

Order = Sequence[Column | str]


def _col(value: Column | str) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], right_keys: Sequence[str] | None = None) -> Column:
    """Join condition in which null equals null."""
    pairs = zip(keys, right_keys or keys)
    condition = None
    for a, b in pairs:
        test = left[a].eqNullSafe(right[b])
        condition = test if condition is None else condition & test
    return condition


def distinct_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def compute_on_distinct(
    df: DataFrame, keys: Sequence[str], exprs: Mapping[str, Column], match_nulls: bool = True
) -> DataFrame:
    """Evaluate ``exprs`` once per distinct key tuple and join the results back.

    Worth it only for costly expressions. The distinct side is left to Spark's
    own size check: small it is broadcast, large it is shuffled, and a hot key
    is split by the adaptive skew join. With ``match_nulls=False`` rows with a
    null key get null results.
    """
    names = [f"__k{i}" for i in range(len(keys))]
    values = distinct_keys(df, keys).select(
        *[F.col(k).alias(n) for k, n in zip(keys, names)], *[e.alias(n) for n, e in exprs.items()]
    )
    if match_nulls:
        return df.join(values, null_safe(df, values, keys, names), "left").drop(*names)
    condition = None
    for k, n in zip(keys, names):
        condition = (df[k] == values[n]) if condition is None else condition & (df[k] == values[n])
    return df.join(values, condition, "left").drop(*names)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    """The row with the greatest ``order`` per key.

    A row-number filter of one lets Spark keep only one candidate per key in
    each map task, so a hot key never reaches a single task whole.
    """
    w = W.partitionBy(*keys).orderBy(*[_col(c).desc() for c in order])
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def nth_from_end(df: DataFrame, keys: Sequence[str], order: Order, n: int) -> DataFrame:
    """The n-th row from the end per key; keys with fewer rows give none."""
    w = W.partitionBy(*keys).orderBy(*[_col(c).desc() for c in order])
    ranked = df.withColumn("__rn", F.row_number().over(w))
    return ranked.filter(F.col("__rn") <= n).filter(F.col("__rn") == n).drop("__rn")


def without_keys(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``other``; null keys are equal."""
    gone = other.select(*[_col(k).alias(f"__{k}") for k in keys])
    same = functools.reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return df.join(gone, same, "left_anti")


def upsert(staging: DataFrame, target: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    """Target with the newest staged row of each key in place of its old row; a null is a key like others.

    Only the staged keys travel to the target: the anti join broadcasts them
    when they are small, so a small batch does not shuffle a large table.
    """
    fresh = latest_per_key(staging, keys, order)
    return without_keys(target, fresh, keys).unionByName(fresh, allowMissingColumns=True)


def conform(df: DataFrame, schema: T.StructType, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Select, rename and cast to ``schema``; missing nullable columns become null.

    A null in a column declared NOT NULL fails the job at that row. Doubles that
    go to decimals are rounded half-up.
    """
    source = {new: old for old, new in (renames or {}).items()}
    columns = []
    for field in schema:
        name = source.get(field.name, field.name)
        if name not in df.columns:
            if not field.nullable:
                raise ValueError(f"column {field.name} is required")
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        value = F.col(f"`{name}`")
        if isinstance(field.dataType, T.DecimalType) and isinstance(df.schema[name].dataType, T.DoubleType):
            value = F.round(value, field.dataType.scale)
        value = value.cast(field.dataType)
        if not field.nullable:
            fail = F.raise_error(F.lit(f"null in required column {field.name}")).cast(field.dataType)
            value = F.coalesce(value, fail)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def rename_retype(
    df: DataFrame,
    renames: Mapping[str, str] | None = None,
    types: Mapping[str, str] | None = None,
    added: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Rename, retype (by new name) and add columns of a table."""
    out = df.withColumnsRenamed(dict(renames or {}))
    out = out.withColumns({n: F.col(n).cast(t) for n, t in (types or {}).items()})
    return out.withColumns(dict(added or {}))


def null_columns(df: DataFrame, na: str = "N/A") -> list[str]:
    """Columns after the first that hold nothing but nulls, or nothing but ``na``.

    One pass that returns a single row of counts.
    """
    names = df.columns[1:]
    if not names:
        return []
    counts = [F.count(F.lit(1)).alias("__all")]
    for i, c in enumerate(names):
        text = F.col(f"`{c}`").cast("string")
        counts.append(F.count(text).alias(f"v{i}"))
        counts.append(F.count_if(text == na).alias(f"n{i}"))
    row = df.agg(*counts).first()
    total = row["__all"]
    return [c for i, c in enumerate(names) if row[f"v{i}"] == 0 or row[f"n{i}"] == total]


def drop_null_columns(df: DataFrame, na: str = "N/A") -> DataFrame:
    return df.drop(*null_columns(df, na))


def to_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Text columns as doubles; text that is no number becomes null."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in cols})


def sections(df: DataFrame, fields: Sequence[str], keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Root nodes of a quote document: quote, fundamental, extended, reference, regular."""
    allowed = ("quote", "fundamental", "extended", "reference", "regular")
    unknown = [f for f in fields if f not in allowed]
    if unknown:
        raise ValueError(f"unknown sections {unknown}; allowed: {', '.join(allowed)}")
    return df.select(*keys, *fields)
