"""Job health feed (ST14): micro-batch progress as a DataFrame.

Progress reports are small driver-side metadata (one record per
micro-batch), so turning them into rows is cheap.  :class:`HealthListener` writes
them to a table while the jobs run; :func:`progress_frame` reads them from query
objects that are still at hand.
"""

from __future__ import annotations

import json
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from basketry.streaming.versions import Table

PROGRESS_SCHEMA = ("query string, batch_id long, ts string, num_input_rows long, "
                   "input_rows_per_second double, processed_rows_per_second double, "
                   "trigger_ms long, rows_dropped_by_watermark long, state_rows long")


def _record(p) -> tuple:
    d = p if isinstance(p, dict) else json.loads(p.json)
    ops = d.get("stateOperators") or []
    return (
        d.get("name") or str(d.get("id")),
        int(d.get("batchId", -1)),
        d.get("timestamp"),
        int(d.get("numInputRows", 0) or 0),
        float(d.get("inputRowsPerSecond", 0.0) or 0.0),
        float(d.get("processedRowsPerSecond", 0.0) or 0.0),
        int((d.get("durationMs") or {}).get("triggerExecution", 0) or 0),
        int(sum(int(o.get("numRowsDroppedByWatermark", 0) or 0) for o in ops)),
        int(sum(int(o.get("numRowsTotal", 0) or 0) for o in ops)),
    )


def progress_records(query: StreamingQuery) -> list[tuple]:
    return [_record(p) for p in query.recentProgress]


def progress_frame(spark: SparkSession, queries: list[StreamingQuery]) -> DataFrame:
    rows = [r for q in queries for r in progress_records(q)]
    return spark.createDataFrame(rows, PROGRESS_SCHEMA)


class HealthListener(StreamingQueryListener):
    """Writes a row per micro-batch of the jobs it watches, and one per job that
    ends, to the table at ``path``: every ``every`` rows, and when a job ends.

    Rows are small and bounded by ``every``; the listener's thread is not the jobs'."""

    def __init__(self, spark: SparkSession, path: str, every: int = 20, watch: set[str] | None = None):
        super().__init__()
        self.spark, self.table, self.every, self.watch = spark, Table(path, "append"), every, watch
        self.run, self.batch = f"health-{uuid.uuid4().hex[:8]}", 0
        self.rows: list[tuple] = []
        self.names: dict[str, str] = {}
        self.lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        if event.name and (self.watch is None or event.name in self.watch):
            self.names[str(event.runId)] = event.name

    def onQueryProgress(self, event) -> None:
        if str(event.progress.runId) in self.names:
            self._add((*_record(event.progress), "progress", None))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        name = self.names.pop(str(event.runId), None)
        if name is not None:
            self._add((name, -1, None, 0, 0.0, 0.0, 0, 0, 0, "failed" if event.exception else "ended", event.exception))
            self.flush()

    def _add(self, row: tuple) -> None:
        with self.lock:
            self.rows.append(row)
            full = len(self.rows) >= self.every
        if full:
            self.flush()

    def flush(self) -> None:
        with self.lock:
            rows, self.rows = self.rows, []
            if rows:
                self.batch += 1
                self.table.add(self.spark.createDataFrame(rows, HEALTH_SCHEMA).coalesce(1), self.batch, self.run)

    def settled(self) -> bool:
        """Whether every job that has started under this listener has ended in it."""
        return not self.names and not self.rows


HEALTH_SCHEMA = PROGRESS_SCHEMA + ", event string, error string"


def read_health(spark: SparkSession, path: str) -> DataFrame:
    return Table(path, "append").read(spark, schema=spark.createDataFrame([], HEALTH_SCHEMA).schema)


def job_health(health: DataFrame) -> DataFrame:
    """Per job: batches, input rows, rows dropped by the watermark, largest state,
    slowest trigger, and whether it has failed."""
    batch = F.col("event") == "progress"
    return health.groupBy(F.col("query").alias("job")).agg(
        F.count_if(batch).alias("batches"),
        F.sum("num_input_rows").alias("input_rows"),
        F.sum("rows_dropped_by_watermark").alias("dropped_rows"),
        F.max("state_rows").alias("state_rows"),
        F.max("trigger_ms").alias("slowest_trigger_ms"),
        F.count_if(F.col("event") == "failed").alias("failures"))
