"""Table writes. Row counts come from the write itself, not from a second pass."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tagtide.schemas import PARTITIONS
from tagtide.sinks.commits import Folder, TableGroup, drop_versions, location, point

#: Of files that hold texts: blocks of 1 MB in place of 256 KB, packed closer.
TEXT_OPTIONS = {"orc.compress.size": str(1 << 20), "orc.buffer.size.enforce": "true", "orc.compression.zstd.level": "5"}
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` with its row count measured while it is written."""
    rows = Observation(name)
    return df.observe(rows, F.count(F.lit(1)).alias("rows")), rows


def append_path(df: DataFrame, path: str) -> int:
    """Append to a partitioned ORC folder; gives the number of rows written."""
    measured, rows = counted(df, "append")
    measured.write.options(**TEXT_OPTIONS).partitionBy(*PARTITIONS).mode("append").orc(path)
    return rows.get["rows"]


def append_table(df: DataFrame, table: str, path: str) -> int:
    """Append to a partitioned table at ``path``, created on first use."""
    measured, rows = counted(df, "append")
    (
        measured.write.format("orc")
        .partitionBy(*PARTITIONS)
        .mode("append")
        .option("path", path)
        .saveAsTable(table)
    )
    return rows.get["rows"]


def append_bucketed(df: DataFrame, table: str, buckets: int, key: str) -> None:
    """Append to a bucketed table of the catalog, one file per bucket."""
    columns = df.sparkSession.table(table).columns
    df.select(*columns).repartition(buckets, key).write.insertInto(table)


def overwrite_partitions(df: DataFrame, path: str) -> int:
    """Replace just the partitions that occur in ``df``, for runs done again."""
    measured, rows = counted(df, "overwrite")
    (
        measured.write.options(**TEXT_OPTIONS)
        .partitionBy(*PARTITIONS)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .orc(path)
    )
    return rows.get["rows"]


def overwrite_table_partitions(df: DataFrame, table: str) -> int:
    """The same for a table of the catalog, whose columns ``df`` has in order.

    ``insertInto`` takes no options, and a session is static unless it is told otherwise:
    all other partitions would go.
    """
    measured, rows = counted(df, "overwrite")
    with conf_set(df.sparkSession, {OVERWRITE_MODE: "dynamic"}):
        measured.write.insertInto(table, overwrite=True)
    return rows.get["rows"]


@contextmanager
def conf_set(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for a while."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def of_day(year: int, month: int, day: int) -> Column:
    """A partition, named by literals."""
    return (F.col("year") == year) & (F.col("month") == month) & (F.col("day") == day)


def day_groups(scan: DataFrame, most: int) -> list[Column]:
    """The days of a scan of files in groups of up to ``most`` bytes of them, one day at least.

    Days come to the driver, as many as the scan has. Rows without a day are in no group;
    rows that come from no file are one group.
    """
    try:
        scan.select("_metadata.file_size")
    except AnalysisException:
        return [F.lit(True)]
    files = scan.select(*PARTITIONS, "_metadata.file_path", "_metadata.file_size").distinct()
    days = files.groupBy(*PARTITIONS).agg(F.sum("file_size").alias("bytes")).na.drop().orderBy(*PARTITIONS).collect()
    groups: list[list[Column]] = []
    left = 0
    for *day, size in days:
        if size > left:
            groups.append([])
            left = most
        groups[-1].append(of_day(*day))
        left -= size
    return [reduce(lambda a, b: a | b, group) for group in groups]


def drop_days_before(spark: SparkSession, path: str, day: dt.date) -> None:
    """Remove the partitions of a folder from before ``day``, once no run will read them again."""
    folder = Folder(spark, path)
    for year in folder.names():
        for month in folder.names(year) if year.startswith("year=") else []:
            for name in folder.names(f"{year}/{month}"):
                parts = [part.partition("=")[2] for part in (year, month, name)]
                if all(part.isdigit() for part in parts) and dt.date(*map(int, parts)) < day:
                    folder.delete(f"{year}/{month}/{name}")


def replace_table(df: DataFrame, table: str, path: str, group: TableGroup | None = None) -> int:
    """Replace all rows of an unpartitioned table that ``df`` may itself read.

    The rows go to a new folder below ``path`` and the table is pointed to it
    once they are complete, so readers see the old rows or the new ones and a
    failed write changes nothing. The version that the table pointed to stays
    for readers that are still at it; others are removed. With a ``group`` the
    table is pointed to it by the group's commit.
    """
    spark = df.sparkSession
    version = f"{path.rstrip('/')}/v-{uuid.uuid4().hex}"
    measured, rows = counted(df, "replace")
    if group is not None:
        group.step(f"write {table}")
    measured.write.orc(version)
    if group is not None:
        group.add(table, path, version)
        return rows.get["rows"]
    before = location(spark, table)
    point(spark, table, version)
    drop_versions(spark, path, [before, version])
    return rows.get["rows"]


def truncate_table(spark: SparkSession, table: str, path: str) -> None:
    """Empty a table the same way: point it to a new, empty version."""
    replace_table(spark.table(table).limit(0), table, path)


def preview(df: DataFrame, rows: int = 20) -> None:
    df.printSchema()
    df.show(rows, truncate=False)
