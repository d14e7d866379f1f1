"""Micro-batch jobs over chain messages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from optiontide.sources.chains import TRIGGER_SECONDS
from optiontide.sources.sinks import write_epoch, write_with_fallback

BatchSink = Callable[[DataFrame, int], None]


def run_stream(source: DataFrame, sink: BatchSink, checkpoint: str, name: str | None = None,
               trigger: str | None = f"{TRIGGER_SECONDS} seconds") -> StreamingQuery:
    """Start an append-mode query that hands every micro-batch to ``sink``.

    ``trigger`` None takes all available input and stops. The batch function
    returns only after its write ended, so the checkpoint never runs ahead.
    """
    writer = source.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(sink)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return writer.start()


def query_id(batch: DataFrame) -> str:
    """Id of the streaming query a micro-batch belongs to; it is kept in the checkpoint, so replays have the same one."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "default"


def epoch_sink(path: str, transform: Callable[[DataFrame], DataFrame] = lambda df: df, run: str | None = None,
               codec: str | None = None) -> BatchSink:
    """Sink into an epoch table: a replayed epoch replaces its own rows, and only those.

    Folders are named by ``run`` (the id of the query unless given) and epoch,
    so queries with checkpoints of their own can share a table.
    """
    def write(batch: DataFrame, epoch: int) -> None:
        write_epoch(transform(batch), path, epoch, run or query_id(batch), codec)

    return write


def fallback_sink(primary: Callable[[DataFrame], None], fallback_dir: str, day: str,
                  transform: Callable[[DataFrame], DataFrame] = lambda df: df, keep: bool = True) -> BatchSink:
    """Sink with a parquet fallback per query and epoch.

    The batch is persisted for the write, so a failed primary write does not
    evaluate the whole plan a second time.
    """
    def write(batch: DataFrame, epoch: int) -> None:
        run = query_id(batch)
        rows = transform(batch)
        if keep:
            rows = rows.persist()
        try:
            write_with_fallback(rows, primary, fallback_dir, day, epoch, run)
        finally:
            if keep:
                rows.unpersist()

    return write


# Key under which contract rows are merged on reading.
MERGE_KEYS = ("symbol", "fetchTime")
