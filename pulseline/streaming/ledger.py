"""Ledger of micro-batches: what each consumed, stored and rejected (AGG-10, AGG-19).

The counts come from the metrics that the running query observes
(``processor.observe_ingest``), so they cost no job. A listener writes one
small file per (query, batch) when the batch has succeeded; a batch that is
retried keeps its number and so its one entry.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from pulseline.session import list_names, write_text

SCHEMA = "query_id string, batch_id bigint, ended string, consumed bigint, ok bigint, dead_lettered bigint"
COUNTS = ("consumed", "ok", "dead_lettered")


class BatchLedger(StreamingQueryListener):
    """Writes the observed counts of every batch below ``path``."""

    def __init__(self, spark: SparkSession, path: str, metric: str = "ingest"):
        self.spark, self.path, self.metric = spark, path, metric
        self._ended: dict[str, threading.Event] = {}

    def onQueryStarted(self, event) -> None:
        self._ended.setdefault(str(event.runId), threading.Event())

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        row = (progress.observedMetrics or {}).get(self.metric)
        if row is None or not row.consumed:
            return
        folder, name = f"{self.path}/{progress.id}", f"{progress.batchId}.json"
        if name not in list_names(self.spark, folder):
            write_text(self.spark, f"{folder}/{name}", json.dumps(
                {"query_id": str(progress.id), "batch_id": progress.batchId, "ended": progress.timestamp,
                 **{c: row[c] for c in COUNTS}}))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended.setdefault(str(event.runId), threading.Event()).set()

    def settle(self, query, seconds: float = 60) -> None:
        """Wait until the entries of a finished query are written (events arrive after it)."""
        if not self._ended.setdefault(str(query.runId), threading.Event()).wait(seconds):
            raise TimeoutError("the end of the query was not reported")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """One row a batch."""
    return spark.read.schema(SCHEMA).json([f"{path}/{q}" for q in list_names(spark, path)])
