"""Micro-batches written once each, with compaction while readers read.

A table here is a folder of folders. The log says which of them are live: every entry is
a numbered file that appears at once or not at all, and also says which batch of which
stream it ends with. A batch that comes again finds its id there and writes nothing; a
folder that no entry lists was never there for readers. Small folders are merged in
tiers, so a row is written again once per tier; merged folders stay until so many further
entries that no reader should still be at them.
"""

from __future__ import annotations

import json
import math
import uuid
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from tagtide.functions import dates, posts
from tagtide.schemas import LANDING, PARTITIONS
from tagtide.sinks.commits import Folder
from tagtide.sinks.tables import TEXT_OPTIONS
from tagtide.sources.feeds import to_landing
from tagtide.streaming.landing import ROWS, _triggered
from tagtide.workspace import drop_shuffles

#: Folders of a tier that are merged into one of the next.
FAN = 8
#: Log entries that a merged folder outlives.
READERS = 20
#: Partitions that are merged at a time.
MERGES = 8
FILE_BYTES = 128 << 20
KINDS = ("post", "notice", "malformed")
LETTERS = StructType([*LANDING.fields, StructField("kind", StringType())])
EMPTY: dict[str, Any] = {"number": 0, "batches": {}, "folders": [], "gone": [], "rows": {}}


class BatchTable:
    """A table of live folders at ``path``, partitioned by ``by``."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, by: list[str]):
        self.spark, self.path, self.schema, self.by = spark, path.rstrip("/"), schema, by
        self.log, self.data = Folder(spark, f"{self.path}/_log"), Folder(spark, self.path)

    def newest(self) -> dict[str, Any]:
        names = [n for n in self.log.names() if not n.startswith(("_", "."))]
        return json.loads(self.log.read(names[-1])) if names else EMPTY

    def _add(self, last: dict[str, Any], **changed: Any) -> None:
        number = last["number"] + 1
        entry = {**last, **changed, "number": number}
        over = [name for name, since in entry["gone"] if since + READERS <= number]
        entry["gone"] = [[name, since] for name, since in entry["gone"] if name not in over]
        self.log.create(f"{number:012d}", json.dumps(entry))
        for name in over:
            self.data.delete(f"folder={name}")
        for name in self.log.names()[: -2 * READERS]:
            self.log.delete(name)

    def _write(self, rows: DataFrame, folder: str) -> None:
        """Rows stay in their tasks: no document is shuffled to be written."""
        writer = rows.write.partitionBy(*self.by) if self.by else rows.write
        writer.options(**TEXT_OPTIONS).orc(f"{self.path}/folder={folder}")

    def _parts(self, folder: str) -> list[str]:
        """The partitions in a folder, as paths below it."""
        found = [""]
        for _ in self.by:
            found = [f"{p}/{n}" for p in found for n in self.data.names(f"folder={folder}{p}") if "=" in n]
        return found

    def _merge(self, folders: list[str], folder: str) -> None:
        """One folder of the rows of several, partition by partition.

        The files of a partition are read together and written to its place, so rows are
        neither shuffled nor sorted; a large partition has a file for each ``FILE_BYTES``.
        """
        parts: dict[str, list[str]] = {}
        for name in folders:
            for part in self._parts(name):
                parts.setdefault(part, []).append(f"folder={name}{part}")
        columns = StructType([field for field in self.schema.fields if field.name not in self.by])

        def merge(part: str) -> None:
            files = math.ceil(sum(map(self.data.size, parts[part])) / FILE_BYTES)
            rows = self.spark.read.schema(columns).orc([f"{self.path}/{name}" for name in parts[part]])
            rows.coalesce(max(1, files)).write.options(**TEXT_OPTIONS).orc(f"{self.path}/folder={folder}{part}")

        with ThreadPoolExecutor(MERGES) as pool:
            list(pool.map(merge, sorted(parts)))

    def append(
        self,
        rows: DataFrame,
        stream: str,
        batch: int,
        measures: dict[str, Column] | None = None,
        wanted: int | None = None,
    ) -> None:
        """Add a micro-batch, unless it is there, or ``wanted`` rows are there without it."""
        last = self.newest()
        if batch <= last["batches"].get(stream, -1):
            return
        if wanted is not None and last["rows"].get("rows", 0) >= wanted:
            return
        if rows.isEmpty():  # a plan known to be empty measures nothing
            self._add(last, batches={**last["batches"], stream: batch})
            return
        folder, counts = f"T0-{uuid.uuid4().hex}", Observation("batch")
        all_rows = {"rows": F.count(F.lit(1)), **(measures or {})}
        self._write(rows.observe(counts, *[m.alias(name) for name, m in all_rows.items()]), folder)
        total = {name: last["rows"].get(name, 0) + (counts.get[name] or 0) for name in all_rows}
        self._add(last, batches={**last["batches"], stream: batch}, folders=[*last["folders"], folder], rows=total)

    def compact(self, fan: int = FAN) -> int:
        """Merge every tier that has enough folders; gives the number of folders merged."""
        merged, tier = 0, 0
        while True:
            last = self.newest()
            tiers = [int(name[1 : name.index("-")]) for name in last["folders"]]
            if tier > max(tiers, default=0):
                return merged
            here = [name for name, t in zip(last["folders"], tiers, strict=True) if t == tier]
            tier += 1
            if len(here) < fan:
                continue
            folder = f"T{tier}-{uuid.uuid4().hex}"
            self._merge(here, folder)
            kept = [name for name in last["folders"] if name not in here]
            gone = [*last["gone"], *[[name, last["number"]] for name in here]]
            self._add(last, folders=[*kept, folder], gone=gone)
            merged += len(here)

    def sweep(self) -> int:
        """Remove folders that a lost write left; to be called when no stream runs."""
        last = self.newest()
        known = {*last["folders"], *[name for name, _ in last["gone"]]}
        lost = [n for n in self.data.names() if n.startswith("folder=") and n.removeprefix("folder=") not in known]
        for name in lost:
            self.data.delete(name)
        return len(lost)

    def _rows(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        paths = [f"{self.path}/folder={name}" for name in folders]
        schema = StructType([*self.schema.fields, StructField("folder", StringType())])
        rows = self.spark.read.schema(schema).option("basePath", self.path).orc(paths)
        return rows.select(*self.schema.names)

    def read(self) -> DataFrame:
        """The rows that are live now; the same ones however long it takes to read them."""
        return self._rows(self.newest()["folders"])

    def rows(self) -> dict[str, int]:
        """Rows and measures added up over all batches."""
        return self.newest()["rows"]


def letters(spark: SparkSession, path: str) -> BatchTable:
    """Landed documents by kind: posts, and the dead letters beside them."""
    return BatchTable(spark, path, LETTERS, ["kind", *PARTITIONS])


def landed_posts(spark: SparkSession, path: str) -> DataFrame:
    return letters(spark, path).read().where("kind = 'post'").select(*LANDING.names)


def dead_letters(spark: SparkSession, path: str) -> DataFrame:
    """Documents that are no posts, as they came, and what they are."""
    return letters(spark, path).read().where("kind != 'post'")


def start_landing_batches(
    records: DataFrame,
    path: str,
    checkpoint: str,
    zone: str = "UTC",
    landed_at: Column | None = None,
    batch_seconds: int | None = None,
    fan: int = FAN,
) -> StreamingQuery:
    """Kafka-shaped records to the landing folder; malformed ones and notices are kept apart.

    Everything of a batch is written in one pass and becomes readable at once.
    """
    stamp = dates.to_zone(F.current_timestamp(), zone) if landed_at is None else landed_at
    rows = to_landing(records, stamp).observe(ROWS, F.count(F.lit(1)).alias(ROWS))
    rows = posts.with_kind(rows, "full_tweet")

    def write(batch: DataFrame, batch_id: int) -> None:
        table = letters(batch.sparkSession, path)
        measures = {kind: F.count_if(F.col("kind") == kind) for kind in KINDS}
        drop_shuffles(batch.sparkSession)
        table.append(batch, checkpoint, batch_id, measures)
        table.compact(fan)

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _triggered(writer, batch_seconds).start()


def start_collecting(
    accepted: DataFrame, path: str, checkpoint: str, wanted: int, batch_seconds: int | None = None
) -> StreamingQuery:
    """Documents to a folder until a batch has brought their number to ``wanted``.

    Batches that begin after that write nothing, so what is collected doesn't depend on
    when the query is stopped.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        collected(batch.sparkSession, path).append(batch, checkpoint, batch_id, wanted=wanted)

    writer = accepted.select("value").writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _triggered(writer, batch_seconds).start()


def collected(spark: SparkSession, path: str) -> BatchTable:
    """Documents that a stream has collected."""
    return BatchTable(spark, path, StructType([StructField("value", StringType())]), [])
