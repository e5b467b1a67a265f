"""Dates, time zones and partition predicates."""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: "Wed Nov 27 09:24:39 +0000 2019" without the day name, which
# Spark refuses to parse.
CREATED_PATTERN = "MMM dd HH:mm:ss Z yyyy"


def posted_at(created: str = "created") -> Column:
    """Instant at which the post was created; NULL for unreadable text."""
    return F.try_to_timestamp(F.substr(F.col(created), F.lit(5)), F.lit(CREATED_PATTERN))


def date_posted(created: str = "created") -> Column:
    """Calendar date of the post in the session time zone."""
    return F.to_date(posted_at(created))


def date_recorded(year: str = "year", month: str = "month", day: str = "day") -> Column:
    return F.make_date(F.col(year), F.col(month), F.col(day))


def to_zone(stamp: Column, zone: str, local: str | None = None) -> Column:
    """Shift a local wall-clock time to ``zone``; the session zone is the default."""
    source = F.lit(local) if local else F.current_timezone()
    return F.from_utc_timestamp(F.to_utc_timestamp(stamp, source), F.lit(zone))


def now_in(zone: str, now: dt.datetime | Column | None = None) -> Column:
    """Current time in ``zone``. A given ``now`` is taken as already local to it."""
    if now is None:
        return to_zone(F.current_timestamp(), zone)
    return now if isinstance(now, Column) else F.lit(now.replace(tzinfo=None).isoformat(" ")).cast("timestamp")


def partition_parts(stamp: Column) -> dict[str, Column]:
    """Year, month and day columns in the types of the tables."""
    return {
        "year": F.year(stamp).cast("short"),
        "month": F.month(stamp).cast("byte"),
        "day": F.dayofmonth(stamp).cast("byte"),
    }


def day_and_hour(stamp: Column) -> tuple[Column, Column]:
    return F.dayofmonth(stamp), F.hour(stamp)


def since_date(zone: str, days_back: int, as_of: dt.datetime | dt.date | None = None) -> dt.date:
    """The date ``days_back`` days before ``as_of`` (default: now) in ``zone``."""
    if as_of is None:
        as_of = dt.datetime.now(ZoneInfo(zone))
    day = as_of.date() if isinstance(as_of, dt.datetime) else as_of
    return day - dt.timedelta(days=days_back)


def since(day: dt.date, mode: str = "calendar") -> Column:
    """Partition predicate on bare year, month and day, so it prunes.

    ``calendar`` means on or after ``day``. ``componentwise`` compares each
    part on its own and so loses days after a month or year end.
    """
    year, month, date = F.col("year"), F.col("month"), F.col("day")
    if mode == "componentwise":
        return (year >= day.year) & (month >= day.month) & (date >= day.day)
    if mode != "calendar":
        raise ValueError(f"unknown mode: {mode}")
    return (year > day.year) | (
        (year == day.year) & ((month > day.month) | ((month == day.month) & (date >= day.day)))
    )


def compact_date(date: str = "date_recorded") -> Column:
    return F.date_format(date, "yyyyMMdd")
