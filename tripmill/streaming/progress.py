"""Progress of streams as a table: rows, lag, watermark, rows dropped as late and state, one row per micro-batch."""

from __future__ import annotations

import threading
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS = (
    "query string, run_id string, batch bigint, at timestamp, input_rows bigint, rows_per_second double, "
    "watermark timestamp, dropped_late bigint, state_rows bigint, state_bytes bigint, batch_ms bigint"
)


def _instant(text: str | None) -> datetime | None:
    return datetime.fromisoformat(text.replace("Z", "+00:00")) if text else None


class ProgressTable(StreamingQueryListener):
    """A listener that appends each progress report to a table on files.

    A row is written as the report comes, so what a run has reported outlives it. A batch that is repeated after a
    restart is reported again under the new run; `read_progress` keeps its last report.
    """

    def __init__(self, spark: SparkSession, path: str, named: set[str] | None = None) -> None:
        super().__init__()
        self.spark, self.path, self.named = spark, path, named
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()
        spark.createDataFrame([], PROGRESS).write.mode("ignore").parquet(f"{path}/none")

    def _end_of(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end_of(str(event.runId))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if self.named is not None and p.name not in self.named:
            return
        states = p.stateOperators or []
        row = (
            p.name, str(p.runId), p.batchId, _instant(p.timestamp), p.numInputRows, p.processedRowsPerSecond,
            _instant((p.eventTime or {}).get("watermark")), sum(s.numRowsDroppedByWatermark for s in states),
            sum(s.numRowsTotal for s in states), sum(s.memoryUsedBytes for s in states), (p.durationMs or {}).get("triggerExecution"),
        )
        self.spark.createDataFrame([row], PROGRESS).write.mode("append").parquet(f"{self.path}/reports")

    def onQueryTerminated(self, event) -> None:
        self._end_of(str(event.runId)).set()

    def wait_for(self, query: StreamingQuery, seconds: float = 60.0) -> bool:
        """Whether all reports of a query that has ended are in the table; reports come after the batches they tell of."""
        return self._end_of(str(query.runId)).wait(seconds)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """One row per query and batch, the last report of it."""
    rows = spark.read.schema(PROGRESS).option("recursiveFileLookup", "true").parquet(path)
    rest = [c for c in rows.columns if c not in ("query", "batch")]
    # A trigger without new data reports under the number of the batch to come, with no rows.
    last = F.max_by(F.struct(*rest), F.struct("input_rows", "at")).alias("_last")
    return rows.groupBy("query", "batch").agg(last).select("query", "batch", "_last.*")


def lag(progress: DataFrame) -> DataFrame:
    """How far the watermark of each report is behind its time, in seconds."""
    behind = F.unix_micros("at") - F.unix_micros("watermark")
    return progress.withColumn("lag_seconds", F.when(F.col("watermark") > F.timestamp_seconds(F.lit(0)), behind / F.lit(1e6)))


def freshness(progress: DataFrame) -> DataFrame:
    """Per query: batches with data, rows, rows dropped as late, the latest watermark."""
    return progress.groupBy("query").agg(
        F.count_if(F.col("input_rows") > 0).alias("batches"),
        F.sum("input_rows").alias("input_rows"),
        F.sum("dropped_late").alias("dropped_late"),
        F.max("watermark").alias("watermark"),
    )
