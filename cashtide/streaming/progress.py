"""What streams report of themselves, kept as numbers."""

from __future__ import annotations

import threading
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

COUNTERS = ("batches", "input_rows", "late_rows", "state_rows")


class ProgressCounter(StreamingQueryListener):
    """Sums the progress of each stream of a session, however many triggers it has.

    ``late_rows`` are the rows that stateful operators dropped because they were behind the watermark. An operator sees
    rows after partial aggregation, so for windows it is the number of sums (one for each task, window and key) that came too late.
    ``state_rows`` is what the operators held after the last trigger.
    """

    def __init__(self):
        self.totals: dict[str, dict[str, int]] = defaultdict(lambda: dict.fromkeys(COUNTERS, 0))
        self.ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        totals = self.totals[str(progress.runId)]
        totals["batches"] += 1
        totals["input_rows"] += progress.numInputRows
        totals["late_rows"] += sum(o.numRowsDroppedByWatermark for o in progress.stateOperators)
        totals["state_rows"] = sum(o.numRowsTotal for o in progress.stateOperators)

    def onQueryTerminated(self, event) -> None:
        self.ended[str(event.runId)].set()

    def of(self, query: StreamingQuery, wait_seconds: float = 60.0) -> dict[str, int]:
        """The counters of a stream; of one that has ended, after all its reports have come in."""
        run = str(query.runId)
        if not query.isActive:
            self.ended[run].wait(wait_seconds)
        return dict(self.totals[run])


def counted_progress(spark: SparkSession) -> ProgressCounter:
    """A counter that listens to all streams of the session from now on."""
    counter = ProgressCounter()
    spark.streams.addListener(counter)
    return counter


def store_progress(spark: SparkSession, totals: dict[str, int], path: str) -> DataFrame:
    """The counters as a table of one row."""
    row = spark.createDataFrame([tuple(totals[c] for c in COUNTERS)], ", ".join(f"{c} long" for c in COUNTERS))
    row.coalesce(1).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
