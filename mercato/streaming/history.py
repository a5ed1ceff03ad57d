"""Refresh history (T5): what a refresh says of its batches, and what the stream itself
reports, failures and empty batches included."""

from __future__ import annotations

import datetime as _dt
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

HISTORY_SCHEMA = ("batch_id long, refresh_start_time timestamp, refresh_end_time timestamp, "
                  "input_rows long, units_refreshed long, state string, message string")
STREAM_SCHEMA = ("query string, batch_id long, reported_at timestamp, state string, input_rows long, "
                 "dropped_rows long, duration_ms long, message string")


def record(spark: SparkSession, location: str | None, batch_id: int, started: _dt.datetime,
           input_rows: int | None, units: int | None, state: str, message: str | None = None) -> None:
    """Add one row to the history below ``location`` (None: keep none)."""
    if location is None:
        return
    row = (batch_id, started, _dt.datetime.now(_dt.timezone.utc), input_rows, units, state, message)
    (spark.createDataFrame([row], HISTORY_SCHEMA).coalesce(1)
     .write.parquet(f"{location}/attempt={batch_id}-{uuid.uuid4().hex[:8]}"))


def refresh_history(spark: SparkSession, location: str, n: int = 10) -> DataFrame:
    """The last ``n`` attempts, newest first."""
    return (spark.read.schema(HISTORY_SCHEMA).parquet(location)
            .select(*[c.split()[0] for c in HISTORY_SCHEMA.split(", ")])
            .orderBy(F.col("refresh_start_time").desc(), F.col("batch_id").desc()).limit(n))


class StreamHistory(StreamingQueryListener):
    """Rows about every micro-batch of the streams that it listens to: SUCCEEDED, EMPTY
    (nothing came) or, when a query ends with an error, FAILED.

    Add it with ``spark.streams.addListener``; ``finished`` waits for the end of a
    query to be reported; ``save`` appends what has come in to a table's folder.
    Unlike ``recentProgress`` it forgets no batch.
    """

    def __init__(self):
        self.rows: list[tuple] = []
        self._names: dict[str, str] = {}
        self._ended: dict[str, threading.Event] = {}

    def onQueryStarted(self, event):
        self._names[str(event.runId)] = event.name or str(event.id)
        self._end(str(event.runId))

    def onQueryProgress(self, event):
        p = event.progress
        dropped = sum(max(0, op.numRowsDroppedByWatermark) for op in p.stateOperators)
        self.rows.append((p.name or str(p.id), p.batchId, _utc(), "SUCCEEDED" if p.numInputRows else "EMPTY",
                          p.numInputRows, dropped, p.batchDuration, None))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        run = str(event.runId)
        if event.exception:
            self.rows.append((self._names.get(run, str(event.id)), None, _utc(), "FAILED", None, None, None,
                              event.exception))
        self._end(run).set()

    def _end(self, run: str) -> threading.Event:
        return self._ended.setdefault(run, threading.Event())

    def finished(self, query, seconds: float = 60) -> bool:
        """Wait until the end of ``query`` has been reported."""
        return self._end(str(query.runId)).wait(seconds)

    def dropped(self) -> int:
        return sum(r[5] or 0 for r in self.rows)

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.rows), STREAM_SCHEMA)

    def save(self, spark: SparkSession, location: str) -> None:
        rows, self.rows = self.rows, []
        spark.createDataFrame(rows, STREAM_SCHEMA).coalesce(1).write.mode("append").parquet(location)


def _utc() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc)
