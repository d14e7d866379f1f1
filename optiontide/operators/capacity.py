"""Request-rate accounting over a table of request times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from optiontide.operators.ordered import trailing_count, with_ordinal

WINDOW_SECONDS = 60


def _instant(as_of: Column | str) -> Column:
    return (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("timestamp")


def _window_start(as_of: Column | str) -> Column:
    return _instant(as_of) - F.make_interval(secs=F.lit(WINDOW_SECONDS))


def requests_last_60s(requests: DataFrame, as_of: Column | str) -> DataFrame:
    """Requests per client in the minute up to ``as_of``; the instant a minute ago counts."""
    recent = requests.filter(F.col("ts").cast("timestamp") >= _window_start(as_of))
    return recent.groupBy("client").agg(F.count(F.lit(1)).alias("used"))


def capacity(used: DataFrame, limits: DataFrame, include_queued: bool = False) -> DataFrame:
    """Requests each client may still make. ``limits`` is (client, limit, queued)."""
    queued = F.col("queued") if include_queued else F.lit(0)
    joined = limits.join(used, "client", "left").withColumn("used", F.coalesce("used", F.lit(0)))
    return joined.withColumn("capacity", F.greatest(F.col("limit") - F.col("used") - queued, F.lit(0)))


def next_available(requests: DataFrame, limits: DataFrame, as_of: Column | str, include_queued: bool = False) -> DataFrame:
    """Per client: used, capacity and the time of the next free slot.

    Without capacity the slot opens a minute after the oldest request in the
    window; with queued requests, a minute after the one that the last of them
    waits for. Only the requests of the last minute are ranked.
    """
    recent = requests.filter(F.col("ts").cast("timestamp") >= _window_start(as_of))
    state = capacity(recent.groupBy("client").agg(F.count(F.lit(1)).alias("used")), limits, include_queued)
    wanted = F.greatest(F.col("queued"), F.lit(1)) if include_queued else F.lit(1)
    ranked = recent.select("client", "ts", F.row_number().over(W.partitionBy("client").orderBy("ts")).alias("rank"))
    if not include_queued:
        ranked = ranked.filter("rank = 1")  # kept to one candidate per client and task
    picked = state.withColumn("rank", wanted.cast("int")).join(ranked, ["client", "rank"], "left")
    opens = F.col("ts").cast("timestamp") + F.make_interval(secs=F.lit(WINDOW_SECONDS))
    return picked.select(
        "client", "limit", "queued", "used", "capacity",
        F.when(F.col("capacity") > 0, _instant(as_of)).otherwise(opens).alias("next_ts"),
    )


def capacity_summary(requests: DataFrame, limits: DataFrame, as_of: Column | str, include_queued: bool = False) -> DataFrame:
    """One row per client, and one of the whole group with a null client."""
    states = next_available(requests, limits, as_of, include_queued).withColumn(
        "wait", F.greatest(F.col("next_ts").cast("double") - _instant(as_of).cast("double"), F.lit(0.0))
    )
    return states.rollup("client").agg(
        F.sum("used").alias("used"),
        F.sum("queued").alias("queued"),
        F.sum("capacity").alias("capacity"),
        F.bool_or(F.col("capacity") > 0).alias("has_capacity"),
        F.bool_and(F.col("capacity") <= 0).alias("no_capacity"),
        F.min("next_ts").alias("next_ts"),
        F.min("wait").alias("min_wait"),
    )


def project_schedule(requests: DataFrame, limits: DataFrame, as_of: Column | str, include_queued: bool = False) -> DataFrame:
    """Clients in order of their next slot, with the capacity they will have then.

    Clients are numbered range by range between sampled places of the order; requests are only counted.
    """
    states = next_available(requests, limits, as_of, include_queued)
    recent = requests.filter(F.col("ts").cast("timestamp") >= _window_start(as_of)).select(
        "client", F.col("ts").cast("timestamp").alias("ts")
    )
    starts = states.select("client", "next_ts")
    cutoff = F.col("next_ts") - F.make_interval(secs=F.lit(WINDOW_SECONDS))
    counts = recent.join(starts, "client").groupBy("client").agg(
        F.count_if(F.col("ts") >= cutoff).alias("__used"), F.count_if(F.col("ts") < cutoff).alias("__purged")
    )
    free = F.col("limit") - F.coalesce("__used", F.lit(0))
    if include_queued:
        # queued requests are served by slots that have opened by then
        free = free - F.least("queued", F.coalesce("__purged", F.lit(0)))
    placed = states.join(counts, "client", "left").withColumn("projected_capacity", free)
    # null slots come first in both forms of the order; clients of one slot are cut by client
    return with_ordinal(placed.select("client", "next_ts", "projected_capacity"), [], ["next_ts", "client"], name="position").withColumn(
        "position", F.col("position").cast("int"))


def trailing_request_rate(requests: DataFrame, seconds: int = WINDOW_SECONDS, name: str = "rate") -> DataFrame:
    """Requests of the same client in the ``seconds`` up to each request."""
    return trailing_count(requests, ["client"], "ts", seconds, name)


def expected_requests(start: Column, end: Column, total_limit: Column) -> Column:
    """Requests that fit between two times at ``total_limit`` per minute."""
    seconds = end.cast("timestamp").cast("double") - start.cast("timestamp").cast("double")
    return F.floor(seconds / 60 * total_limit).cast("bigint")


def round_trip_minutes(symbols: Column, total_limit: Column) -> Column:
    """Whole minutes to ask for every symbol once."""
    return F.floor(F.try_divide(symbols, total_limit)).cast("bigint")
