"""Progress and data-quality listeners."""

from __future__ import annotations

import json
import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from optiontide.operators.quality import MALFORMED_LIMIT

log = logging.getLogger("optiontide.streaming")


def progress_record(progress) -> dict:
    """Flat record of one progress event; durations a batch lacks are left out."""
    return {
        "id": str(progress.id),
        "runId": str(progress.runId),
        "name": progress.name,
        "timestamp": progress.timestamp,
        "batchId": progress.batchId,
        "batchDuration": progress.batchDuration,
        "numInputRows": progress.numInputRows,
        "inputRowsPerSecond": progress.inputRowsPerSecond,
        "processedRowsPerSecond": progress.processedRowsPerSecond,
        "durationMs": {k: int(v) for k, v in dict(progress.durationMs).items()},
        "stateOperators": len(progress.stateOperators),
        "sources": [s.description for s in progress.sources],
        "sink": progress.sink.description,
        "observed": {name: row.asDict() for name, row in progress.observedMetrics.items()},
    }


RECORD = (
    "id string, runId string, name string, timestamp string, batchId long, batchDuration long, numInputRows long, inputRowsPerSecond double,"
    " processedRowsPerSecond double, durationMs map<string,long>, stateOperators int, sources array<string>, sink string,"
    " observed map<string,struct<cnt:long,malformed:long>>"
)


class ProgressTable:
    """Keeps progress records as a table: one JSON document per query id and batch, which a replayed batch replaces.

    Use it as the ``emit`` of a ``ProgressListener``. A document is written through the cluster's file system and runs no job, so it does not wait for
    the query it reports on. A query that was restarted keeps its id and goes on with its batches.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def __call__(self, record: dict) -> None:
        jvm = self.spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(f"{self.path}/query={record['id']}/batch-{record['batchId']:012d}.json")
        with_default = json.dumps(record, default=str).encode()
        out = target.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(target, True)
        try:
            out.write(with_default)
        finally:
            out.close()

    def flush(self, query) -> None:
        """Keep the query's recent records now: the listener gets them a little after their batch. Keeping one twice changes nothing."""
        for progress in query.recentProgress:
            self(progress_record(progress))

    def read(self, limit: float = MALFORMED_LIMIT) -> DataFrame:
        """Records with the share of malformed messages (null without an observed metric ``messages``) and whether it is above ``limit``."""
        rows = self.spark.read.schema(RECORD).json(self.path)
        seen = F.col("observed")["messages"]
        ratio = F.try_divide(seen["malformed"], seen["cnt"])
        return rows.withColumns({"malformed_ratio": ratio, "alert": F.coalesce(ratio > limit, F.lit(False))})


class ProgressListener(StreamingQueryListener):
    """Hands every progress record to ``emit`` (default: the log)."""

    def __init__(self, emit: Callable[[dict], None] | None = None) -> None:
        self.emit = emit or (lambda record: log.info(json.dumps(record)))

    def onQueryStarted(self, event) -> None:
        log.info("query started: id=%s runId=%s name=%s", event.id, event.runId, event.name)

    def onQueryProgress(self, event) -> None:
        self.emit(progress_record(event.progress))

    def onQueryIdle(self, event) -> None:
        log.info("query idle: id=%s runId=%s", event.id, event.runId)

    def onQueryTerminated(self, event) -> None:
        log.info("query terminated: id=%s exception=%s", event.id, event.exception)


class QualityListener(StreamingQueryListener):
    """Calls ``alert`` when the share of malformed rows of a batch is above ``limit``."""

    def __init__(self, alert: Callable[[dict], None], metric: str = "metric", limit: float = MALFORMED_LIMIT) -> None:
        self.alert, self.metric, self.limit = alert, metric, limit

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.metric)
        if row is not None and row.cnt and row.malformed / row.cnt > self.limit:
            self.alert({"batchId": event.progress.batchId, "cnt": row.cnt, "malformed": row.malformed})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
