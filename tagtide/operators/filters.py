"""Row filters on feeds and tables; the feed filters also work on streams."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagtide.config import FeedSettings
from tagtide.functions import dates, posts


def ingest_filter(feed: DataFrame, settings: FeedSettings, value: str = "value") -> DataFrame:
    """Raw documents that are reposts in the language, often reposted, with hashtags."""
    columns = feed.columns
    parsed = posts.parse_posts(feed, value)
    return parsed.where(posts.accepted(settings.language, settings.min_reposts)).select(*columns)


def first_n(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The first ``n`` rows to arrive; a distributed top-n when ``order`` is given."""
    return df.orderBy(*order).limit(n) if order else df.limit(n)


def drop_any_null(df: DataFrame, *columns: str) -> DataFrame:
    return df.na.drop("any", subset=list(columns) or None)


def scan_since(table: DataFrame, day: dt.date, mode: str = "calendar") -> DataFrame:
    """Partitions since ``day``; see ``dates.since`` for the modes."""
    return table.where(dates.since(day, mode))
