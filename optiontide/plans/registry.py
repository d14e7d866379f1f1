"""Registry of catalogue queries and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def present(df: DataFrame) -> DataFrame:
    """Result columns both engines print alike: dates and times as text, decimals as doubles."""
    columns = []
    for field in df.schema:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            value = value.cast("string")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, T.DecimalType):
            value = value.cast("double")
        elif isinstance(field.dataType, T.FloatType):
            value = value.cast("double")
        columns.append(value.alias(field.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name``, with its oracle when SQL can express it."""
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return present(fn(spark, sf_dir))

        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    """Doubles rounded for comparison; -0.0 becomes 0.0."""
    return df.withColumns({n: F.round(F.col(n), digits) + F.lit(0.0) for n in names})
