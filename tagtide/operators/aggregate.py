"""Per-hashtag aggregation and the running staging merge.

Names are kept in long form, one row per hashtag and name, beside the measures: the
same for a hashtag with one name and one with a hundred million.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagtide.functions import dates
from tagtide.schemas import AGGREGATED, NAMES, PARTITIONS, PUBLISHED_NAMES, STAGING, conform


def _measured() -> list[Column]:
    """Measures of exploded rows."""
    return [
        F.sum("rt_count").alias("rt_count"),
        F.count("tweet_id").alias("tweet_count"),
        F.sum("sentiment_%").alias("sentiment_sum"),
        F.count("sentiment_%").alias("sentiment_count"),
        F.min("date_posted").alias("date_posted"),
        F.max("date_recorded").alias("date_recorded"),
    ]


def _combined() -> list[Column]:
    """The same measures of rows that already hold them."""
    return [
        *[
            F.sum(name).alias(name)
            for name in ("rt_count", "tweet_count", "sentiment_sum", "sentiment_count")
        ],
        F.min("date_posted").alias("date_posted"),
        F.max("date_recorded").alias("date_recorded"),
    ]


def _finished(measured: DataFrame) -> DataFrame:
    day = F.col("date_recorded")
    mean = F.try_divide(F.col("sentiment_sum"), F.col("sentiment_count"))
    rows = measured.withColumn("avg_sentiment", F.round(mean, 2)).withColumns(dates.partition_parts(day))
    return conform(rows, AGGREGATED)


def aggregate_hashtags(exploded: DataFrame) -> DataFrame:
    """Totals, mean sentiment and dates per hashtag: one shuffle, a row per hashtag and task."""
    return _finished(exploded.groupBy("hashtag").agg(*_measured()))


def name_measures(exploded: DataFrame) -> DataFrame:
    """Measures per hashtag and name: stored once, both results below come from it."""
    return exploded.groupBy("hashtag", "user_name").agg(*_measured())


def aggregate_names(pairs: DataFrame) -> DataFrame:
    """``aggregate_hashtags`` from stored pairs."""
    return _finished(pairs.groupBy("hashtag").agg(*_combined()))


def names_of(pairs: DataFrame) -> DataFrame:
    """The names of stored pairs, which are distinct."""
    return pairs.where(F.col("user_name").isNotNull()).select(*NAMES.names)


def hashtag_names(exploded: DataFrame) -> DataFrame:
    """The distinct names per hashtag."""
    return exploded.where(F.col("user_name").isNotNull()).select(*NAMES.names).distinct()


_SIDES = ["rt_count", "tweet_count", "avg_sentiment", "date_posted", "date_recorded"]
#: Of two rows with equal counts the greater by these stays, then the new one.
_RECORDED = ["date_recorded", "tweet_count", "avg_sentiment", "date_posted"]


def paired(new: DataFrame, old: DataFrame) -> DataFrame:
    """Old and new measures of every hashtag side by side, in one shuffle.

    Each input holds one row per hashtag, as aggregates and staging tables do.
    """
    columns = ["hashtag", *_SIDES]
    rows = old.select(*columns, F.lit(False).alias("_new")).unionByName(
        new.select(*columns, F.lit(True).alias("_new"))
    )
    return rows.groupBy("hashtag").agg(
        F.max(F.when(~F.col("_new"), 1)).alias("in_old"),
        F.max(F.when(F.col("_new"), 1)).alias("in_new"),
        *[F.max(F.when(~F.col("_new"), F.col(name))).alias(f"old_{name}") for name in _SIDES],
        *[F.max(F.when(F.col("_new"), F.col(name))).alias(f"new_{name}") for name in _SIDES],
    )


def side(mode: str = "reference", dedup_counts: bool = True) -> Column:
    """Which sides of a pair count: ``old``, ``new`` or ``both``."""
    only = F.when(F.col("in_old").isNull(), "new").when(F.col("in_new").isNull(), "old")
    if mode == "replace":
        return only.otherwise("new")
    if mode != "reference":
        raise ValueError(f"unknown mode: {mode}")
    if not dedup_counts:
        return only.otherwise("both")
    later = F.struct(*[F.col(f"old_{n}") for n in _RECORDED]) > F.struct(*[F.col(f"new_{n}") for n in _RECORDED])
    same = F.col("old_rt_count").eqNullSafe(F.col("new_rt_count"))
    return only.when(same & later, "old").when(same, "new").otherwise("both")


def merge_pairs(pairs: DataFrame, mode: str = "reference", dedup_counts: bool = True) -> DataFrame:
    """One row per hashtag: the side that counts, or both added up."""
    chosen = side(mode, dedup_counts)

    def one(name: str, both: Column) -> Column:
        old, new = F.col(f"old_{name}"), F.col(f"new_{name}")
        return F.when(F.col("_side") == "old", old).when(F.col("_side") == "new", new).otherwise(both)

    def total(name: str) -> Column:
        old, new = F.col(f"old_{name}"), F.col(f"new_{name}")
        return F.coalesce(old + new, old, new)

    # Whole hundredths have one exact mean, whatever the order of the rows.
    old, new = (F.round(F.col(f"{s}_avg_sentiment") * 100).cast("long") for s in ("old", "new"))
    mean = F.coalesce(F.round((old + new) / 2) / 100, F.col("old_avg_sentiment"), F.col("new_avg_sentiment"))
    return (
        pairs.withColumn("_side", chosen)
        .select(
            "hashtag",
            one("rt_count", total("rt_count")).alias("rt_count"),
            one("tweet_count", total("tweet_count")).alias("tweet_count"),
            one("avg_sentiment", mean).alias("avg_sentiment"),
            one("date_posted", F.least("old_date_posted", "new_date_posted")).alias("date_posted"),
            one("date_recorded", F.greatest("old_date_recorded", "new_date_recorded")).alias("date_recorded"),
        )
        .withColumns(dates.partition_parts(F.col("date_recorded")))
    )


def merge_staging(
    new: DataFrame,
    old: DataFrame,
    zone: str = "UTC",
    now: dt.datetime | None = None,
    mode: str = "reference",
    dedup_counts: bool = True,
    stamp: str = "timestamp",
) -> DataFrame:
    """Merge fresh aggregates into the staging rows.

    ``mode="reference"`` keeps one row per (hashtag, count) and adds up the
    rest, so a run over the same posts counts them again. ``mode="replace"``
    takes the newest row per hashtag and is safe to repeat.
    ``dedup_counts=False`` sums every row. ``stamp="day_hour"`` writes day and
    hour of the merge in place of its time.
    """
    return stamped(merge_pairs(paired(new, old), mode, dedup_counts), zone, now, stamp)


def merge_names(
    new: DataFrame, old: DataFrame, pairs: DataFrame, mode: str = "reference", dedup_counts: bool = True
) -> DataFrame:
    """The names of the merged rows: those of a side that doesn't count go with it.

    ``pairs`` should be stored: only hashtags on both sides of which one counts
    are looked up. They are read with a known size, which decides the join, and
    a hashtag with very many names can be split in it.
    """
    dropped = pairs.where("in_old IS NOT NULL AND in_new IS NOT NULL").select(
        "hashtag", side(mode, dedup_counts).alias("_side")
    )
    kept_old = old.join(dropped.where("_side = 'new'").select("hashtag"), "hashtag", "left_anti")
    kept_new = new.join(dropped.where("_side = 'old'").select("hashtag"), "hashtag", "left_anti")
    return kept_old.select(*NAMES.names).unionByName(kept_new.select(*NAMES.names)).distinct()


def published_names(names: DataFrame, staging: DataFrame) -> DataFrame:
    """Names with the partition of the row that they belong to."""
    return conform(names.join(staging.select("hashtag", *PARTITIONS), "hashtag"), PUBLISHED_NAMES)


def stamped(
    df: DataFrame, zone: str, now: dt.datetime | None = None, stamp: str = "timestamp"
) -> DataFrame:
    """Put the time of update before the partition columns."""
    update = dates.now_in(zone, now)
    if stamp == "timestamp":
        return conform(df.withColumn("last_update", update), STAGING)
    day, hour = dates.day_and_hour(update)
    columns = [name for name in AGGREGATED.names if name not in ("year", "month", "day")]
    return conform(df, AGGREGATED).select(
        *columns, day.alias("last_update1"), hour.alias("last_update2"), "year", "month", "day"
    )


def fresh_staging(new: DataFrame, zone: str = "UTC", now: dt.datetime | None = None) -> DataFrame:
    """First staging rows of a day. Aggregates hold one row per hashtag, so none can repeat."""
    return stamped(new, zone, now)


def last_update(staging: DataFrame) -> DataFrame:
    return staging.agg(F.max("last_update").alias("last_update"))
