"""Several topics in one session: a query, a checkpoint and a counter for each."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tagtide.streaming.supervise import Watch, stop_gracefully


@dataclass(frozen=True)
class Outcome:
    rows: int
    error: str | None


class Topics:
    """Streams that run side by side; one that fails leaves the others running.

    ``start`` gets a topic, its records and a checkpoint of its own.
    """

    def __init__(
        self,
        records: Mapping[str, DataFrame],
        checkpoint: str,
        start: Callable[[str, DataFrame, str], StreamingQuery],
    ):
        self.queries: dict[str, StreamingQuery] = {}
        self.watches: dict[str, Watch] = {}
        for topic, stream in records.items():
            self.queries[topic] = start(topic, stream, f"{checkpoint.rstrip('/')}/{topic}")
            self.watches[topic] = Watch(self.queries[topic])

    def running(self) -> list[str]:
        return [topic for topic, query in self.queries.items() if query.isActive]

    def rows(self) -> dict[str, int]:
        return {topic: watch.total for topic, watch in self.watches.items()}

    def stop(self) -> None:
        for query in self.queries.values():
            stop_gracefully(query)

    def wait(self) -> dict[str, Outcome]:
        """Rows and error of every topic, when all queries have ended."""
        found = {}
        for topic, query in self.queries.items():
            with self.watches[topic] as watch:
                while query.isActive:
                    watch.wait(5)
                found[topic] = Outcome(watch.finish(), watch.error)
        return found
