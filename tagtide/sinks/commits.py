"""Several tables replaced by one commit, and runs that are done once.

Every table of a group has its versions in folders of its own. A commit is a numbered file
that names the new folder of each table; it appears by a rename that fails if the number
is taken, so either all tables have new rows or none has. The catalog follows: it is
pointed to the folders afterwards, and whoever comes next does what a lost run left
undone. A commit also names its run, so a run done again after its commit adds nothing.
One run writes at a time; a second one fails at its commit.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from typing import Any

from pyspark.sql import DataFrame, SparkSession

#: Commits whose folders stay: the newest, and the one before for readers still at it.
KEPT = 2


class Folder:
    """A folder of the table file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm.org.apache.hadoop.fs
        self.conf = spark._jsc.hadoopConfiguration()
        self.gateway = spark.sparkContext._gateway
        self.path = path.rstrip("/")

    def _at(self, name: str):
        return self.jvm.Path(f"{self.path}/{name}" if name else self.path)

    def _files(self):
        return self._at("").getFileSystem(self.conf)

    def names(self, below: str = "") -> list[str]:
        files = self._files()
        if not files.exists(self._at(below)):
            return []
        return sorted(f.getPath().getName() for f in files.listStatus(self._at(below)))

    def size(self, name: str) -> int:
        """Bytes of a folder or file."""
        return self._files().getContentSummary(self._at(name)).getLength()

    def read(self, name: str) -> str:
        stream = self._files().open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """A whole file under a name that must be free."""
        hidden = f"_{uuid.uuid4().hex}"
        stream = self._files().create(self._at(hidden), False)
        stream.write(bytearray(text.encode()))
        stream.close()
        kind = getattr(self.jvm, "Options$Rename")
        context = self.jvm.FileContext.getFileContext(self._at("").toUri(), self.conf)
        try:
            context.rename(self._at(hidden), self._at(name), self.gateway.new_array(kind, 0))
        except Exception:
            self._files().delete(self._at(hidden), False)
            raise

    def delete(self, name: str) -> None:
        self._files().delete(self._at(name), True)


def location(spark: SparkSession, table: str) -> str:
    """The folder that a table points to."""
    facts = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Location'").first()
    return facts["data_type"]


def _name(folder: str) -> str:
    return folder.rstrip("/").rpartition("/")[2]


def point(spark: SparkSession, table: str, folder: str) -> None:
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(table)


def drop_versions(spark: SparkSession, path: str, keep: Iterable[str]) -> None:
    """Remove the version folders below ``path`` that ``keep`` doesn't name."""
    folder, kept = Folder(spark, path), {_name(k) for k in keep}
    for name in folder.names():
        if name.startswith("v-") and name not in kept:
            folder.delete(name)


class TableGroup:
    """Tables whose new versions become current together.

    ``step`` is called with a name before every write, for logs and for tests.
    """

    def __init__(self, spark: SparkSession, path: str, step: Callable[[str], None] = lambda name: None):
        self.spark, self.folder, self.step = spark, Folder(spark, path), step
        self.pending: dict[str, tuple[str, str]] = {}

    def _last(self, count: int) -> list[dict[str, Any]]:
        names = [n for n in self.folder.names() if not n.startswith(("_", "."))]
        return [json.loads(self.folder.read(name)) for name in names[-count:]][::-1]

    def newest(self) -> dict[str, Any] | None:
        """The last commit, if its tables still have the rows that it gave them."""
        found = self._last(1)
        if not found:
            return None
        current = {table: _name(location(self.spark, table)) for table in found[0]["tables"]}
        return found[0] if all(_name(v) == current[t] for t, v in found[0]["tables"].items()) else None

    def recover(self) -> dict[str, Any] | None:
        """Point the tables to the last commit where a lost run didn't; gives that commit.

        A table that someone has replaced since is left alone.
        """
        for record in self._last(1):
            for table, version in record["tables"].items():
                if _name(location(self.spark, table)) == _name(record["before"][table]):
                    self.step(f"point {table}")
                    point(self.spark, table, version)
        return self.newest()

    def add(self, table: str, path: str, version: str) -> None:
        self.pending[table] = (path, version)

    def written(self, table: str) -> DataFrame:
        """The added version of a table, not yet current."""
        return self.spark.read.schema(self.spark.table(table).schema).orc(self.pending[table][1])

    def commit(self, run: str, **facts: Any) -> None:
        """Make all added versions current, then remove those that no reader needs."""
        last = self._last(1)
        number = last[0]["number"] + 1 if last else 1
        before = {table: location(self.spark, table) for table in self.pending}
        tables = {table: version for table, (_, version) in self.pending.items()}
        record = {"number": number, "run": run, "tables": tables, "before": before, **facts}
        self.step("commit")
        self.folder.create(f"{number:012d}", json.dumps(record))
        self.recover()
        recent = self._last(KEPT)
        for table, (path, _) in self.pending.items():
            drop_versions(self.spark, path, [before[table], *(r["tables"].get(table, "") for r in recent)])
        self.pending = {}

    def recent(self, fact: str) -> set[str]:
        """What the commits that stay readable list under ``fact``."""
        return {entry for record in self._last(KEPT) for entry in record.get(fact, [])}
