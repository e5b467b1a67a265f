"""Ranks within a day that never bring a whole day into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagtide.functions import dates
from tagtide.schemas import ANALYTIC, conform
from tagtide.workspace import checkpointed, stored

DAY = "date_recorded"


def _placed(df: DataFrame, group: str, out: str, ties: bool) -> DataFrame:
    """Rows with their number (or rank) per ``group`` by falling count, then hashtag.

    Runs a job when called: rows are range-partitioned over all tasks and
    checkpointed, which fixes the range of every row. Each task numbers its own
    range; one header row per range and group says how many rows come before.
    For ranks a header also says how many of these have the range's first count,
    so a count that fills many ranges is never brought together.
    """
    ranged = checkpointed(
        df.repartitionByRange(group, F.desc("rt_count"), F.asc("hashtag")).withColumn("_range", F.spark_partition_id())
    )
    by_range = Window.partitionBy(group).orderBy("_range")
    earlier = by_range.rowsBetween(Window.unboundedPreceding, -1)
    same_low = Window.partitionBy(group, "_low").orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)
    counts = ranged.groupBy(group, "_range", "rt_count").agg(F.count(F.lit(1)).alias("_n"))
    headers = counts.groupBy(group, "_range").agg(
        F.sum("_n").alias("_rows"),
        F.max("rt_count").alias("_top"),
        F.min("rt_count").alias("_low"),
        F.min_by("_n", "rt_count").alias("_low_rows"),
    )
    # a range's run of its lowest count, with the runs of that count in ranges before
    headers = headers.withColumn("_run", F.sum("_low_rows").over(same_low)).withColumn(
        "_tail",
        F.when(F.lag("_low").over(by_range) == F.col("_top"), F.lag("_run").over(by_range)).otherwise(F.lit(0)),
    )
    headers = headers.select(
        F.col(group).alias("_group"),
        F.col("_range").alias("_of"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
        "_tail",
    )
    within = Window.partitionBy(group, "_range").orderBy(F.desc("rt_count"), *([] if ties else [F.asc("hashtag")]))
    local = ranged.withColumn("_local", (F.rank() if ties else F.row_number()).over(within))
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_range") == F.col("_of"))
    place = F.col("_local") + F.col("_before")
    if ties:
        place = place - F.when(F.col("_local") == 1, F.col("_tail")).otherwise(F.lit(0))
    rows = local.join(stored(headers, "headers"), same)
    return rows.select(*[F.col(f"`{name}`") for name in df.columns], place.cast("int").alias(out))


def number_rows(df: DataFrame, group: str = DAY, out: str = "rank") -> DataFrame:
    """Row number per day by count, ties by hashtag. Runs a job when called."""
    return _placed(df, group, out, ties=False)


def rank_rows(df: DataFrame, group: str = DAY, out: str = "rank") -> DataFrame:
    """Rank per day by count: equal counts share it, gaps follow. Runs a job when called."""
    return _placed(df, group, out, ties=True)


def _with_ranks(df: DataFrame, ranks: DataFrame, group: str, out: str) -> DataFrame:
    same = F.col(group).eqNullSafe(F.col("_group")) & F.col("rt_count").eqNullSafe(F.col("_count"))
    return df.join(ranks, same).select(*[F.col(f"`{name}`") for name in df.columns], out)


def top_n_per_day(df: DataFrame, n: int = 10, group: str = DAY, out: str = "rank") -> DataFrame:
    """Rows of rank ``n`` or better per day; ties at the cut all stay.

    A first pass keeps ``n`` rows per day, limited map-side. They hold every
    count that makes the cut, with its rank. The second pass looks the ranks up
    by (day, count), so ties never gather in one task.
    """
    by_count = Window.partitionBy(group).orderBy(F.desc("rt_count"))
    ranks = (
        df.select(group, "rt_count")
        .withColumn("_row", F.row_number().over(by_count))
        .where(F.col("_row") <= n)
        .groupBy(F.col(group).alias("_group"), F.col("rt_count").alias("_count"))
        .agg(F.min("_row").alias(out))
    )
    return _with_ranks(df, ranks, group, out)


def publish(staging: DataFrame) -> DataFrame:
    """Staging rows as published: ``hashtag_id`` is the date and the row number.

    Runs a job when called. Rows are measures only, without names.
    """
    numbered = number_rows(staging.drop("last_update"))
    return conform(
        numbered.withColumn("hashtag_id", F.concat_ws("-", dates.compact_date(), "rank")), ANALYTIC
    )


def sorted_by_count(df: DataFrame) -> DataFrame:
    """Global order, for reading results out only."""
    return df.orderBy(F.desc("rt_count"), "hashtag")
