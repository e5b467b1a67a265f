"""Deterministic one-row-per-key picks, combined map-side so hot keys stay small."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagtide.functions import dates


def greatest_row(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """Per key the row that is greatest by ``order``, then by its other columns.

    ``max`` of a struct keeps one row per key and map task, so a key that holds
    a third of the input sends one row per task through the shuffle.
    """
    leading = [
        F.col(f"`{entry}`") if isinstance(entry, str) else entry.alias(f"_order{i}")
        for i, entry in enumerate(order)
    ]
    taken = {*keys, *(entry for entry in order if isinstance(entry, str))}
    rest = [F.col(f"`{name}`") for name in df.columns if name not in taken]
    best = df.groupBy(*keys).agg(F.max(F.struct(*leading, *rest)).alias("_best"))
    return best.select(
        *[F.col(name) if name in keys else F.col(f"_best.`{name}`").alias(name) for name in df.columns]
    )


def latest_posts(base: DataFrame) -> DataFrame:
    """One row per ``tweet_id``: greatest count, then latest, then greatest user."""
    return greatest_row(base, ["tweet_id"], ["rt_count", dates.posted_at(), "user_id"])


def distinct_counts(staged: DataFrame) -> DataFrame:
    """One row per (hashtag, rt_count): the one recorded last."""
    return greatest_row(staged, ["hashtag", "rt_count"], ["date_recorded"])


def union_all(first: DataFrame, second: DataFrame) -> DataFrame:
    """Union by name that keeps duplicates."""
    return first.unionByName(second)
