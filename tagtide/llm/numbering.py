"""Numbers of rows within groups, without bringing a group into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagtide.workspace import Scratch


def numbered(rows: DataFrame, group: str, order: list[str], out: str, scratch: Scratch) -> DataFrame:
    """``rows`` with their number in the group, from 1, by ``order`` with nulls first.

    Rows are dealt by ranges of group and order and stored with their range; each range
    numbers its own rows, after the count of those in earlier ranges of the group.
    """
    placed = rows.repartitionByRange(group, *order).withColumn("_range", F.spark_partition_id())
    placed = scratch.stored(placed, "placed")
    earlier = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(group, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select(group, "_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy(group, "_range").orderBy(*order)
    local = placed.withColumn("_local", F.row_number().over(within))
    found = local.join(scratch.stored(before, "before"), [group, "_range"])
    return found.select(*rows.columns, (F.col("_local") + F.col("_before")).alias(out))
