"""Stopping streams: on a marker, when idle, or after enough rows."""

from __future__ import annotations

import threading
import time

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from tagtide.sinks.markers import marker_exists, remove_marker, write_marker
from tagtide.streaming.landing import ROWS


class Watch(StreamingQueryListener):
    """Adds up a query's observed rows from the engine's events, each micro-batch once.

    Progress of batches that ended before the watch began is taken from the query, which
    keeps the last hundred; begin it where the query starts. Used as a context, it ends
    with the block.
    """

    def __init__(self, query: StreamingQuery):
        self.query, self.run = query, str(query.runId)
        self.total, self.idle, self.error = 0, 0, None
        self._seen: set[int] = set()
        self._changed, self.terminated = threading.Condition(), threading.Event()
        self._spark = SparkSession.active()
        self._spark.streams.addListener(self)
        for progress in query.recentProgress:
            self._count(progress)
        if not query.isActive:
            self.terminated.set()

    def _count(self, progress) -> None:
        observed = progress.observedMetrics.get(ROWS)
        with self._changed:
            if observed is None or progress.batchId in self._seen:
                return
            self._seen.add(progress.batchId)
            self.total += observed[ROWS]
            self.idle = 0
            self._changed.notify_all()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if str(event.progress.runId) == self.run:
            self._count(event.progress)

    def onQueryIdle(self, event) -> None:
        if str(event.runId) == self.run:
            with self._changed:
                self.idle += 1
                self._changed.notify_all()

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) == self.run:
            self.error = event.exception
            with self._changed:
                self.terminated.set()
                self._changed.notify_all()

    def wait(self, seconds: float, rows: int | None = None, idle: int | None = None) -> None:
        """Until the query ends, the rows reach ``rows``, idle events exceed ``idle``, or the time is over."""

        def reached() -> bool:
            enough = rows is not None and self.total >= rows
            return enough or self.terminated.is_set() or (idle is not None and self.idle > idle)

        with self._changed:
            self._changed.wait_for(reached, seconds)

    def finish(self, seconds: float = 600) -> int:
        """All rows of a query that has ended: its last event comes after those of its batches."""
        self.terminated.wait(seconds)
        return self.total

    def __enter__(self) -> Watch:
        return self

    def __exit__(self, *_) -> None:
        self._spark.streams.removeListener(self)


def stop_gracefully(query: StreamingQuery, patience: float = 600) -> None:
    """Stop between micro-batches, or after ``patience`` seconds in the middle of one."""
    deadline = time.monotonic() + patience
    while query.isActive and query.status["isTriggerActive"] and time.monotonic() < deadline:
        time.sleep(0.05)
    query.stop()


def run_until_stopped(
    spark: SparkSession,
    query: StreamingQuery,
    marker: str,
    stop_text: str = "shutdown",
    poll_seconds: float = 5,
    idle_batches: int = 5,
) -> int:
    """Wait until the stop marker is there, then stop; gives the rows written.

    More than ``idle_batches`` idle events in a row write the marker; the engine sends one
    every ``spark.sql.streaming.noDataProgressEventInterval``. A marker left by an earlier
    run is removed first.
    """
    remove_marker(spark, marker)
    with Watch(query) as watch:
        while query.isActive:
            watch.wait(poll_seconds, idle=idle_batches)
            if watch.idle > idle_batches and query.isActive:
                write_marker(spark, marker, stop_text)
            if marker_exists(spark, marker):
                stop_gracefully(query)
        query.awaitTermination()
        return watch.finish()


def run_until_collected(query: StreamingQuery, wanted: int, poll_seconds: float = 5) -> int:
    """Stop after the micro-batch in which the accepted rows reach ``wanted``."""
    with Watch(query) as watch:
        while query.isActive:
            watch.wait(poll_seconds, rows=wanted)
            if watch.total >= wanted:
                stop_gracefully(query)
        query.awaitTermination()
        return watch.finish()
