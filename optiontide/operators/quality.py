"""Share of malformed records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MALFORMED_LIMIT = 0.5


def malformed_ratio(df: DataFrame, error_col: str, limit: float = MALFORMED_LIMIT) -> DataFrame:
    """Row and error counts, their ratio, and whether it is above ``limit``."""
    counted = df.agg(F.count(F.lit(1)).alias("cnt"), F.count(error_col).alias("malformed"))
    ratio = F.try_divide(F.col("malformed"), F.col("cnt"))
    return counted.select("cnt", "malformed", ratio.alias("ratio"), F.coalesce(ratio > limit, F.lit(False)).alias("alert"))


def observe_quality(df: DataFrame, error_col: str, name: str = "metric") -> DataFrame:
    """The same counts as an observed metric of a batch or streaming query."""
    return df.observe(name, F.count(F.lit(1)).alias("cnt"), F.count(error_col).alias("malformed"))
