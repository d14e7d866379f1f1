"""Request accounting on a stream: keyed state under a watermark."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from optiontide.operators.ordered import time_bucket

_STATE = "at array<long>, n array<long>"
_MICRO = 1_000_000


def settled(at: np.ndarray, n: np.ndarray, until: int, seconds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Instants up to ``until`` that have not been answered, with their numbers of requests and rates, and what has to be kept.

    ``at`` are rising instants in microseconds with ``n`` requests each; a negative n marks one that was answered, or is answered elsewhere.
    """
    count = np.abs(n)
    total = np.concatenate([[0], np.cumsum(count)])
    ready = (at <= until) & (n > 0)
    rate = total[1:] - total[np.searchsorted(at, at - seconds * _MICRO, side="left")]
    kept = at >= until - seconds * _MICRO
    return at[ready], count[ready], rate[ready], at[kept], np.where(ready, -n, n)[kept]


def _step(seconds: int, names: list[str]) -> Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        at, n = (np.array(x, dtype=np.int64) for x in (state.get if state.exists else ([], [])))
        if not state.hasTimedOut:
            for frame in frames:
                new, first, count = np.unique(frame["__us"].to_numpy(dtype=np.int64), return_index=True, return_counts=True)
                count = np.where(frame["__home"].to_numpy(dtype=bool)[first], count, -count)
                both, place = np.unique(np.concatenate([at, new]), return_inverse=True)
                sums = np.zeros(len(both), dtype=np.int64)
                np.add.at(sums, place, np.concatenate([n, count]))
                at, n = both, sums
        until = state.getCurrentWatermarkMs() * 1000
        ready, times, rates, at, n = settled(at, n, until, seconds)
        if len(at):
            state.update((at.tolist(), n.tolist()))
            # called again when the watermark has passed the first open instant, or when the window has left the last answered one
            last = at[n > 0][0] if (n > 0).any() else at[-1] + seconds * _MICRO
            state.setTimeoutTimestamp(max(int(last) // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()
        if len(ready):
            out = pd.DataFrame({"ts": pd.to_datetime(np.repeat(ready, times), unit="us", utc=True), "rate": np.repeat(rates, times)})
            for place, (name, k) in enumerate(zip(names, key, strict=False)):  # the bucket ends the key
                out.insert(place, name, k)
            yield out

    return step


def trailing_rate_stream(requests: DataFrame, seconds: int, delay: str, by: tuple[str, ...] = ("client",), ts: str = "ts",
                         bucket_seconds: float = 21600) -> DataFrame:
    """Every request of a stream with the requests of its client in the ``seconds`` up to it: ``by``, ts, rate.

    A request is answered once the watermark (``delay`` behind the newest time) has passed it, so rows that come out of
    order by less than that count as in the batch form; later ones are dropped. A client is cut along time every ``bucket_seconds`` (never
    below the window), as in ``trailing_count``: a request near the end of a bucket is repeated in the next one, where it only counts towards
    others. A state is one bucket of one client, the instants that are open and the window before them. It is removed when the window has passed, so a hot
    client is spread over its buckets and a batch reads and writes only the buckets it touches. Requests of null time are left out. Restarts go
    on from the checkpoint.
    """
    width = max(bucket_seconds, seconds)
    times = requests.where(f"{ts} IS NOT NULL").select(*by, requests[ts].cast("timestamp").alias("ts"))
    bucket, reach = time_bucket("ts", width), time_bucket(F.col("ts") + F.make_interval(secs=F.lit(seconds)), width)
    placed = times.withWatermark("ts", delay).select(*by, "ts", F.unix_micros("ts").alias("__us"), bucket.alias("__own"), F.explode(F.sequence(bucket, reach)).alias("__bucket"))
    marked = placed.select(*by, "ts", "__us", (F.col("__own") == F.col("__bucket")).alias("__home"), "__bucket")
    fields = [marked.schema[c] for c in by]
    out = T.StructType([*fields, T.StructField("ts", T.TimestampType()), T.StructField("rate", T.LongType())])
    return marked.groupBy(*by, "__bucket").applyInPandasWithState(
        _step(seconds, list(by)), out, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
