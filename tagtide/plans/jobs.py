"""The jobs: ingest, land, landing to base, base to analytic."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tagtide.config import Settings, TableSettings
from tagtide.functions import dates, sentiment
from tagtide.operators import aggregate, explode, ledger, ranking
from tagtide.operators.base import to_base
from tagtide.operators.explode import explode_posts
from tagtide.operators.filters import ingest_filter, scan_since
from tagtide.schemas import LANDING, PARTITIONS
from tagtide.sinks import tables as sink
from tagtide.sinks.commits import Folder, TableGroup
from tagtide.sinks.kafka import start_kafka, write_kafka
from tagtide.sources import tables as source
from tagtide.streaming.batches import landed_posts, start_landing_batches
from tagtide.streaming.landing import accepted_stream, start_landing, start_text
from tagtide.streaming.supervise import run_until_collected, run_until_stopped
from tagtide.workspace import drop_shuffles, stored


def ingest(feed: DataFrame, settings: Settings, checkpoint: str | None = None) -> StreamingQuery | None:
    """Accepted documents of a batch or streaming feed to the raw topic."""
    if feed.isStreaming:
        accepted = accepted_stream(feed, settings.feed)
        return start_kafka(accepted, settings.kafka, checkpoint, settings.spark.batch_seconds)
    write_kafka(ingest_filter(feed, settings.feed), settings.kafka)
    return None


def land(records: DataFrame, settings: Settings) -> StreamingQuery:
    """Kafka-shaped records to the landing folder, every few seconds."""
    if settings.tables.landing_sink == "batches":
        return start_landing_batches(
            records,
            settings.tables.landing_path,
            settings.tables.landing_checkpoint,
            settings.tables.time_zone,
            batch_seconds=settings.spark.batch_seconds,
        )
    return start_landing(
        records,
        settings.tables.landing_path,
        settings.tables.landing_checkpoint,
        settings.tables.time_zone,
        batch_seconds=settings.spark.batch_seconds,
        retention=settings.tables.landing_retention,
    )


def ingest_until_collected(
    feed: DataFrame, path: str | None, checkpoint: str, settings: Settings
) -> int:
    """Accepted documents of a stream to a folder, or the topic, until enough are collected."""
    if path is None:
        query = ingest(feed, settings, checkpoint)
    else:
        query = start_text(
            accepted_stream(feed, settings.feed), path, checkpoint, settings.spark.batch_seconds
        )
    return run_until_collected(query, settings.feed.posts_to_collect, settings.spark.poll_seconds)


def land_until_stopped(records: DataFrame, settings: Settings) -> int:
    """Land records until the stop marker is there or the stream stays idle."""
    return run_until_stopped(
        records.sparkSession,
        land(records, settings),
        settings.kafka.stop_marker,
        settings.kafka.stop_text,
        settings.spark.poll_seconds,
        settings.spark.idle_batches,
    )


#: Bytes of landing files whose days a repeated load replaces at a time.
LOAD_BYTES = 256 << 20


def land_to_base(
    spark: SparkSession,
    settings: Settings,
    as_of: dt.datetime | None = None,
    mode: str = "calendar",
    load: str = "append",
) -> int:
    """Base rows of recent landing partitions; gives their number.

    ``load="append"`` adds them, so a second run adds them again.
    ``load="replace"`` replaces the partitions it reads and may be repeated: some days at
    a time, as old and new rows of a day are both there until the new ones are complete.
    """
    chosen = settings.tables
    drop_shuffles(spark)
    day = dates.since_date(chosen.time_zone, chosen.days_back, as_of)
    if chosen.landing_sink == "batches":
        landing = scan_since(landed_posts(spark, chosen.landing_path), day, mode)
    else:
        landing = source.orc_path_since(spark, chosen.landing_path, LANDING, day, mode)
    if load == "replace":
        groups = sink.day_groups(landing, LOAD_BYTES)
        return sum(sink.overwrite_table_partitions(to_base(landing.where(days)), chosen.base_table) for days in groups)
    if load != "append":
        raise ValueError(f"unknown load: {load}")
    return sink.append_table(to_base(landing), chosen.base_table, chosen.base_path)


def updated_on(staging: DataFrame, day: dt.date) -> DataFrame:
    """One row: whether staging was last updated on ``day``; true when empty.

    Compared in Spark: a time that crosses to the driver turns into its machine's zone.
    """
    same = F.to_date("last_update") == F.lit(day)
    return aggregate.last_update(staging).select(F.coalesce(same, F.lit(True)).alias("updated"))


def updated_today(staging: DataFrame, zone: str, now: dt.datetime | None = None) -> bool:
    """Whether staging was last updated on the date of ``now``; true when empty."""
    return updated_on(staging, (now or dt.datetime.now(ZoneInfo(zone))).date()).first()["updated"]


#: Runs whose winners are kept apart before they become one again.
MOST_RUNS = 24


def base_to_analytic(
    spark: SparkSession,
    settings: Settings,
    now: dt.datetime | None = None,
    score: Callable[[Column], Column] = sentiment.lexicon_score,
    score_before_dedup: bool = False,
    merge_mode: str = "reference",
    scan_mode: str = "calendar",
    step: Callable[[str], None] = lambda name: None,
) -> dict[str, int]:
    """Aggregate recent base partitions into staging; publish on the first run of a day.

    A run may fail anywhere and be done again. Measures and names of staging become
    current by one commit, so what is published comes from one state of both; publishing
    appends only rows that aren't there yet. A run with the ``now`` of the last commit
    has been done: it only gives that commit's numbers.

    ``merge_mode``: ``reference`` and ``replace`` as in ``merge_staging``. ``delta``
    counts each post once, however often runs overlap on a day: see ``operators.ledger``.
    ``step`` is called with a name before every write. Posts are scored after their
    deduplication; ``score_before_dedup`` suits bases that hold few rows of a post.
    """
    chosen = settings.tables
    zone = chosen.time_zone
    drop_shuffles(spark)
    group = TableGroup(spark, chosen.staging_commits_path, step)
    last = group.recover()
    run = (now or dt.datetime.now(ZoneInfo(zone))).isoformat()
    if last is not None and last["run"] == run:
        return last["counts"]
    day = dates.since_date(zone, chosen.days_back, now)
    base = source.table_since(spark, chosen.base_table, day, scan_mode)
    same_day = updated_today(spark.table(chosen.staging_table), zone, now)
    before = spark.table(chosen.staging_table).count() if same_day else 0
    published = 0 if same_day else _publish(spark, chosen, step)
    if merge_mode == "delta":
        if before and (last is None or "ledger" not in last):
            raise ValueError("staging holds posts that no ledger knows; delta starts with an empty staging or a new day")
        runs = last["ledger"] if before else []
        rows = ledger.winners(explode.scored_rows(base, score)) if score_before_dedup else explode.scored_winners(base, score)
        after, facts = _stage_delta(spark, chosen, rows, runs, now, group)
    else:
        facts = {}
        after = _stage(spark, chosen, explode_posts(base, score, score_before_dedup), same_day, merge_mode, now, group)
    counts = {"staged": after, "new": after - before, "published": published}
    group.commit(run, counts=counts, **facts)
    if merge_mode == "delta":
        _drop_runs(spark, chosen, group.recent("ledger"))
    return counts


def _stage(
    spark: SparkSession,
    chosen: TableSettings,
    exploded: DataFrame,
    same_day: bool,
    merge_mode: str,
    now: dt.datetime | None,
    group: TableGroup,
) -> int:
    """New versions of staging and its names: merged, or fresh on a new day."""
    # Scored and deduplicated once; the aggregate and the names both come from it.
    measures = stored(aggregate.name_measures(exploded), "names")
    fresh, names = aggregate.aggregate_names(measures), aggregate.names_of(measures)
    if same_day:
        pairs = stored(aggregate.paired(fresh, spark.table(chosen.staging_table)), "pairs")
        names = aggregate.merge_names(names, spark.table(chosen.staging_names_table), pairs, merge_mode)
        rows = aggregate.stamped(aggregate.merge_pairs(pairs, merge_mode), chosen.time_zone, now)
    else:
        rows = aggregate.fresh_staging(fresh, chosen.time_zone, now)
    sink.replace_table(names, chosen.staging_names_table, chosen.staging_names_path, group)
    return sink.replace_table(rows, chosen.staging_table, chosen.staging_path, group)


def _stage_delta(
    spark: SparkSession,
    chosen: TableSettings,
    rows: DataFrame,
    runs: list[str],
    now: dt.datetime | None,
    group: TableGroup,
) -> tuple[int, dict[str, list[str]]]:
    """The same from the ledger, after the posts that changed went out and in again.

    ``rows``: the scored row that counts for each post.
    """
    known = bool(runs)
    history = spark.table(chosen.winners_table).where(F.col("run").isin(runs))
    current = ledger.winners(history)
    changed = stored(ledger.changes(rows, current, chosen.winner_buckets), "changed")
    fresh = changed.select("new.*")
    if len(runs) >= MOST_RUNS:
        fresh, runs = ledger.winners(history.select(*fresh.columns).unionByName(fresh)), []
    run = uuid.uuid4().hex
    group.step(f"write {chosen.winners_table}")
    sink.append_bucketed(fresh.withColumn("run", F.lit(run)), chosen.winners_table, chosen.winner_buckets, "tweet_id")
    delta = ledger.contributions(changed)
    posts = ledger.merged(spark.table(chosen.ledger_table), delta) if known else delta
    sink.replace_table(posts, chosen.ledger_table, chosen.ledger_path, group)
    posts = group.written(chosen.ledger_table)
    names = aggregate.names_of(posts).distinct()
    sink.replace_table(names, chosen.staging_names_table, chosen.staging_names_path, group)
    measures = aggregate.stamped(aggregate.aggregate_names(posts), chosen.time_zone, now)
    after = sink.replace_table(measures, chosen.staging_table, chosen.staging_path, group)
    return after, {"ledger": [*runs, run]}


def _drop_runs(spark: SparkSession, chosen: TableSettings, keep: set[str]) -> None:
    """Remove winners of runs that no readable commit lists: lost runs, and old days."""
    found = [r[0].removeprefix("run=") for r in spark.sql(f"SHOW PARTITIONS {chosen.winners_table}").collect()]
    folder = Folder(spark, chosen.winners_path)
    for run in set(found) - keep:
        spark.sql(f"ALTER TABLE {chosen.winners_table} DROP IF EXISTS PARTITION (run = '{run}')")
        folder.delete(f"run={run}")


def _publish(spark: SparkSession, chosen: TableSettings, step: Callable[[str], None]) -> int:
    """Staging and its names to the analytic tables, as far as they aren't there."""
    staging = spark.table(chosen.staging_table)
    names = aggregate.published_names(spark.table(chosen.staging_names_table), staging)
    step(f"append {chosen.analytic_table}")
    published = _append_missing(ranking.publish(staging), chosen.analytic_table, chosen.analytic_path)
    step(f"append {chosen.analytic_names_table}")
    _append_missing(names, chosen.analytic_names_table, chosen.analytic_names_path)
    return published


def of_days(table: DataFrame, rows: DataFrame) -> DataFrame:
    """The partitions of ``table`` that ``rows`` fall into, named by literals.

    The days come to the driver: as many as the rows were recorded on.
    """
    found = rows.select(*PARTITIONS).distinct().collect()
    days = [sink.of_day(*day) for day in found]
    return table.where(reduce(lambda a, b: a | b, days, F.lit(False)))


def _append_missing(rows: DataFrame, table: str, path: str) -> int:
    """Append the rows that the table doesn't hold; only their partitions are read."""
    rows = stored(rows, "rows")
    there = of_days(rows.sparkSession.table(table), rows).select(*rows.columns)
    return sink.append_table(stored(rows.subtract(there), "missing"), table, path)


def staging_status(staging: DataFrame, zone: str, now: dt.datetime | None = None) -> DataFrame:
    """One row: time and day of the last update, current hour and day, zone."""
    current = dates.now_in(zone, now)
    return aggregate.last_update(staging).select(
        "last_update",
        F.dayofmonth("last_update").alias("last_day"),
        F.hour(current).alias("hour_now"),
        F.dayofmonth(current).alias("day_now"),
        F.current_timezone().alias("local_zone"),
    )
