"""Registered queries that run whole jobs on catalog tables of their own.

Each makes a database with tables in a folder of the run, lands the feed in it, runs
jobs, stores what they leave, and drops the database.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagtide import catalog
from tagtide.config import Settings, TableSettings
from tagtide.operators import aggregate, ledger, ranking
from tagtide.operators.explode import explode_posts
from tagtide.plans import driver_feed as source
from tagtide.plans import jobs
from tagtide.schemas import BASE
from tagtide.sinks import tables as sink
from tagtide.sources.feeds import to_landing
from tagtide.workspace import moved, new_path, stored

NOW = dt.datetime(2024, 1, 15, 12, 30)
#: Reaches behind every row of the feed.
ALL_DAYS = 10_000
TURN = dt.date(2024, 1, 1)


@contextmanager
def run_tables(spark: SparkSession) -> Iterator[Settings]:
    folder, database = new_path(spark, "jobs"), f"run_{uuid.uuid4().hex}"
    values = {}
    for name, value in vars(TableSettings()).items():
        if name.endswith(("_path", "_checkpoint")):
            values[name] = f"{folder}/{name}"
        elif name.endswith(("_table", "_view")):
            values[name] = f"{database}.{name}"
        else:
            values[name] = value
    settings = Settings(tables=TableSettings(**{**values, "time_zone": "UTC", "days_back": ALL_DAYS, "winner_buckets": 8}))
    try:
        catalog.create_all(spark, settings.tables)
        yield settings
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def _landed(spark: SparkSession, sf: str) -> DataFrame:
    return to_landing(source.records_of(source.feed(spark, sf)), F.col("timestamp"))


def _days_back(settings: Settings, days: int) -> Settings:
    return replace(settings, tables=replace(settings.tables, days_back=days))


def _expire(spark: SparkSession, settings: Settings, day: dt.date = dt.date.max) -> None:
    """Landing days from before ``day`` go: they are in base, and no later load reads them."""
    sink.drop_days_before(spark, settings.tables.landing_path, day)


def _two_runs(spark: SparkSession, sf: str, settings: Settings, first: dt.datetime) -> None:
    """What landed before the turn of the year is staged at ``first``, the rest at ``NOW``."""
    landed = _landed(spark, sf)
    for year, now, days in ((2023, first, ALL_DAYS), (2024, NOW, (NOW.date() - TURN).days)):
        recent = _days_back(settings, days)
        sink.append_path(landed.where(F.col("year") == year), settings.tables.landing_path)
        jobs.land_to_base(spark, recent, now, load="replace")
        _expire(spark, settings)
        jobs.base_to_analytic(spark, recent, now)


def _both_parts(spark: SparkSession, sf: str, settings: Settings) -> Iterator[None]:
    """All rows, landed up to the turn of the year and then the rest; landing keeps a part until the next."""
    landed = _landed(spark, sf)
    late = F.coalesce(F.make_date("year", "month", "day") >= F.lit(TURN), F.lit(False))
    for part in (~late, late):
        sink.append_path(landed.where(part), settings.tables.landing_path)
        yield
        _expire(spark, settings)


def job_land_to_base(spark: SparkSession, sf: str) -> DataFrame:
    with run_tables(spark) as settings:
        for _ in _both_parts(spark, sf, settings):
            jobs.land_to_base(spark, settings, NOW)
        return moved(spark, settings.tables.base_path, BASE, "base")


def load_twice(spark: SparkSession, sf: str) -> DataFrame:
    """A repeated load leaves the same rows, and those of other days."""
    with run_tables(spark) as settings:
        for _ in _both_parts(spark, sf, settings):
            for _ in range(2):
                jobs.land_to_base(spark, settings, NOW, load="replace")
        return moved(spark, settings.tables.base_path, BASE, "base")


def job_same_day(spark: SparkSession, sf: str) -> DataFrame:
    """Staging after two runs on one day."""
    with run_tables(spark) as settings:
        _two_runs(spark, sf, settings, NOW - dt.timedelta(hours=6))
        return stored(spark.table(settings.tables.staging_table), "staging")


def job_same_day_names(spark: SparkSession, sf: str) -> DataFrame:
    with run_tables(spark) as settings:
        _two_runs(spark, sf, settings, NOW - dt.timedelta(hours=6))
        return stored(spark.table(settings.tables.staging_names_table), "names")


def job_new_day(spark: SparkSession, sf: str) -> DataFrame:
    """What the first run of a new day publishes."""
    with run_tables(spark) as settings:
        _two_runs(spark, sf, settings, NOW - dt.timedelta(days=1))
        return stored(spark.table(settings.tables.analytic_table), "analytic")


def job_new_day_staging(spark: SparkSession, sf: str) -> DataFrame:
    """What it leaves in staging."""
    with run_tables(spark) as settings:
        _two_runs(spark, sf, settings, NOW - dt.timedelta(days=1))
        return stored(spark.table(settings.tables.staging_table), "staging")


class Lost(RuntimeError):
    """A run that ends before one of its writes."""


def _rerun(spark: SparkSession, sf: str, settings: Settings) -> None:
    """The new day's run lost before each of its writes in turn, and done again each time."""
    landed = _landed(spark, sf)
    first = NOW - dt.timedelta(days=1)
    sink.append_path(landed.where("year = 2023"), settings.tables.landing_path)
    jobs.land_to_base(spark, settings, first, load="replace")
    _expire(spark, settings)
    jobs.base_to_analytic(spark, settings, first)
    recent = _days_back(settings, (NOW.date() - TURN).days)
    sink.append_path(landed.where("year = 2024"), settings.tables.landing_path)
    jobs.land_to_base(spark, recent, NOW, load="replace")
    _expire(spark, settings)
    writes = 0
    while True:
        left = writes

        def lost(name: str) -> None:
            nonlocal left
            left -= 1
            if left < 0:
                raise Lost(name)

        try:
            jobs.base_to_analytic(spark, recent, NOW, step=lost)
        except Lost:
            writes += 1
        else:
            return


def job_rerun_after_failure(spark: SparkSession, sf: str) -> DataFrame:
    """The names that are published, however often the run was lost."""
    with run_tables(spark) as settings:
        _rerun(spark, sf, settings)
        return stored(spark.table(settings.tables.analytic_names_table), "names")


def job_rerun_staging(spark: SparkSession, sf: str) -> DataFrame:
    """Staging after the same, with the number of each hashtag's names."""
    with run_tables(spark) as settings:
        _rerun(spark, sf, settings)
        names = spark.table(settings.tables.staging_names_table).groupBy("hashtag").agg(F.count("user_name").alias("names"))
        return stored(spark.table(settings.tables.staging_table).join(names, "hashtag", "left"), "staging")


def _overlapping(spark: SparkSession, sf: str, settings: Settings) -> None:
    """Three runs on one day whose posts overlap, each counted once."""
    landed = _landed(spark, sf)
    since = None
    runs = ((None, "2023-12-27"), ("2023-12-20", "2024-01-05"), ("2023-12-30", "2024-12-31"))
    for hour, (start, day) in enumerate(runs):
        until = F.make_date("year", "month", "day") <= F.lit(day).cast("date")
        part = landed.where(until if since is None else until & (F.make_date("year", "month", "day") > F.lit(since).cast("date")))
        sink.append_path(part, settings.tables.landing_path)
        back = ALL_DAYS if start is None else (NOW.date() - dt.date.fromisoformat(start)).days
        now = NOW - dt.timedelta(hours=2 - hour)
        jobs.land_to_base(spark, _days_back(settings, back), now, load="replace")
        following = [dt.date.fromisoformat(later) for later, _ in runs[hour + 1 :]]
        _expire(spark, settings, min(following, default=dt.date.max))
        jobs.base_to_analytic(spark, _days_back(settings, back), now, merge_mode="delta")
        since = day


def staging_merge_delta(spark: SparkSession, sf: str) -> DataFrame:
    with run_tables(spark) as settings:
        _overlapping(spark, sf, settings)
        return stored(spark.table(settings.tables.staging_table), "staging")


def staging_names_delta(spark: SparkSession, sf: str) -> DataFrame:
    with run_tables(spark) as settings:
        _overlapping(spark, sf, settings)
        return stored(spark.table(settings.tables.staging_names_table), "names")


def dedup_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The row of each post that counts, after loads that overlap."""
    with run_tables(spark) as settings:
        _overlapping(spark, sf, settings)
        found = ledger.winners(spark.table(settings.tables.winners_table))
        return stored(found.drop("_text", "sentiment"), "winners")


def _stage(spark: SparkSession, sf: str, settings: Settings) -> DataFrame:
    base = jobs.to_base(_landed(spark, sf))
    fresh = aggregate.aggregate_hashtags(explode_posts(base, before_dedup=False))
    rows = aggregate.fresh_staging(fresh, "UTC", NOW)
    sink.replace_table(rows, settings.tables.staging_table, settings.tables.staging_path)
    return spark.table(settings.tables.staging_table)


def replace_table(spark: SparkSession, sf: str) -> DataFrame:
    """A table replaced by rows that read it."""
    with run_tables(spark) as settings:
        doubled = _stage(spark, sf, settings).withColumn("rt_count", F.col("rt_count") * 2)
        sink.replace_table(doubled, settings.tables.staging_table, settings.tables.staging_path)
        return stored(spark.table(settings.tables.staging_table), "staging")


def truncate(spark: SparkSession, sf: str) -> DataFrame:
    """Rows before and after."""
    with run_tables(spark) as settings:
        tables = settings.tables
        before = _stage(spark, sf, settings).count()
        sink.truncate_table(spark, tables.staging_table, tables.staging_path)
        left = spark.table(tables.staging_table).agg(F.count(F.lit(1)).alias("left"))
        return stored(left.select(F.lit(before).cast("long").alias("before"), "left"), "truncated")


def sql_view(spark: SparkSession, sf: str) -> DataFrame:
    """The top ten through the stored view."""
    with run_tables(spark) as settings:
        tables = settings.tables
        rows = ranking.publish(_stage(spark, sf, settings))
        sink.append_table(rows, tables.analytic_table, tables.analytic_path)
        catalog.create_top_view(spark, tables.analytic_table, tables.analytic_view)
        return stored(spark.table(tables.analytic_view), "top")


QUERIES = [
    job_land_to_base,
    load_twice,
    job_same_day,
    job_same_day_names,
    job_new_day,
    job_new_day_staging,
    job_rerun_after_failure,
    job_rerun_staging,
    staging_merge_delta,
    staging_names_delta,
    dedup_incremental,
    replace_table,
    truncate,
    sql_view,
]
