"""Base rows to one row per post and hashtag, with sentiment and dates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagtide.functions import dates, sentiment
from tagtide.operators import dedup
from tagtide.schemas import EXPLODED


def explode_tags(posts: DataFrame) -> DataFrame:
    """One row per hashtag; posts whose list is empty or NULL give none."""
    return posts.withColumn("hashtag", F.explode("hashtags")).drop("hashtags")


def scored_rows(base: DataFrame, score: Callable[[Column], Column] = sentiment.lexicon_score) -> DataFrame:
    """Scored rows without their text; its hash stays, as a last tie-break between rows."""
    marked = base.withColumn("_text", F.xxhash64("tweet_txt"))
    return marked.withColumn("sentiment", score(F.col("tweet_txt"))).drop("tweet_txt")


def scored_winners(base: DataFrame, score: Callable[[Column], Column] = sentiment.lexicon_score) -> DataFrame:
    """``latest_posts(scored_rows(base))``, but only the rows that stay are scored.

    The text goes along as the last to compare by, behind its hash, so the same rows stay.
    """
    marked = base.select(*[name for name in base.columns if name != "tweet_txt"], F.xxhash64("tweet_txt").alias("_text"), "tweet_txt")
    latest = dedup.latest_posts(marked)
    return latest.withColumn("sentiment", score(F.col("tweet_txt"))).drop("tweet_txt")


def score_posts(
    base: DataFrame,
    score: Callable[[Column], Column] = sentiment.lexicon_score,
    before_dedup: bool = True,
) -> DataFrame:
    """One scored row per post, without its text.

    A cheap scorer runs before the deduplication: the text is then read by the
    scan stage only and never sorted or shuffled. A costly model should run
    after it (``before_dedup=False``), once per distinct post. The text's hash
    is a last tie-break, so both orders pick the same rows.
    """
    if before_dedup:
        return dedup.latest_posts(scored_rows(base, score)).drop("_text")
    latest = dedup.latest_posts(base.withColumn("_text", F.xxhash64("tweet_txt")))
    return latest.withColumn("sentiment", score(F.col("tweet_txt"))).drop("tweet_txt", "_text")


def explode_posts(
    base: DataFrame,
    score: Callable[[Column], Column] = sentiment.lexicon_score,
    before_dedup: bool = True,
) -> DataFrame:
    """Deduplicate, score, date and explode base rows."""
    return explode_scored(score_posts(base, score, before_dedup))


def explode_scored(posts: DataFrame, *more: str) -> DataFrame:
    """Date and explode rows that are scored, one per post; ``more`` columns come along."""
    return explode_tags(
        posts.select(
            "hashtags",
            "rt_count",
            "tweet_id",
            sentiment.percent(F.col("sentiment")).alias("sentiment_%"),
            "user_name",
            dates.date_posted().alias("date_posted"),
            dates.date_recorded().alias("date_recorded"),
            "year",
            "month",
            "day",
            *more,
        )
    ).select(*EXPLODED.names, *more)
