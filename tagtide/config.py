"""Settings and the session builder."""

from __future__ import annotations

import tomllib
from collections.abc import Mapping
from dataclasses import dataclass, field, fields, replace
from typing import Any

from pyspark.sql import SparkSession

CONF_PREFIX = "tagtide."
OPTIONAL_NUMBERS = ("shuffle_partitions", "records_per_batch")


@dataclass(frozen=True)
class KafkaSettings:
    brokers: str = "localhost:9092"
    raw_topic: str = "reposts"
    acks: str = "1"
    group_id: str = "G1"
    offset_reset: str = "latest"
    # Records that one micro-batch takes at most; None takes what is there.
    records_per_batch: int | None = None
    stop_marker: str = "out/stop_marker"
    stop_text: str = "shutdown"


@dataclass(frozen=True)
class FeedSettings:
    language: str = "en"
    min_reposts: int = 100
    posts_to_collect: int = 100


@dataclass(frozen=True)
class SparkSettings:
    app_name: str = "tagtide"
    master: str | None = None
    warehouse_dir: str | None = None
    # None keeps the cluster's own value; AQE coalesces small partitions.
    shuffle_partitions: int | None = None
    batch_seconds: int = 5
    poll_seconds: int = 5
    idle_batches: int = 5
    session_zone: str = "UTC"


@dataclass(frozen=True)
class TableSettings:
    landing_table: str = "posts_landing.posts"
    landing_path: str = "warehouse/landing/posts"
    landing_checkpoint: str = "warehouse/_stream/landing"
    base_table: str = "posts_base.posts"
    base_path: str = "warehouse/base/posts"
    analytic_table: str = "posts_analytic.hashtags"
    analytic_path: str = "warehouse/analytic/hashtags"
    analytic_names_table: str = "posts_analytic.hashtag_names"
    analytic_names_path: str = "warehouse/analytic/hashtag_names"
    analytic_view: str = "posts_analytic.top10"
    staging_table: str = "posts_analytic.hashtags_staging"
    staging_path: str = "warehouse/analytic/hashtags_staging"
    staging_names_table: str = "posts_analytic.hashtag_names_staging"
    staging_names_path: str = "warehouse/analytic/hashtag_names_staging"
    # What names the current versions of the staging tables.
    staging_commits_path: str = "warehouse/analytic/_staging_commits"
    # What ``merge_mode="delta"`` knows of the posts that are counted in staging.
    ledger_table: str = "posts_analytic.staging_ledger"
    ledger_path: str = "warehouse/analytic/staging_ledger"
    winners_table: str = "posts_analytic.staging_winners"
    winners_path: str = "warehouse/analytic/staging_winners"
    winner_buckets: int = 64
    days_back: int = 1
    time_zone: str = "Europe/Amsterdam"
    # "files" is Spark's file sink; "batches" keeps dead letters and merges small files.
    landing_sink: str = "files"
    # How long the landing sink remembers its files; None remembers all of them.
    landing_retention: str | None = None


@dataclass(frozen=True)
class Settings:
    kafka: KafkaSettings = field(default_factory=KafkaSettings)
    feed: FeedSettings = field(default_factory=FeedSettings)
    spark: SparkSettings = field(default_factory=SparkSettings)
    tables: TableSettings = field(default_factory=TableSettings)

    def override(self, values: Mapping[str, Mapping[str, Any]]) -> Settings:
        """A copy with ``{section: {key: value}}`` applied; unknown keys raise."""
        sections = {}
        for name, entries in values.items():
            section = getattr(self, name)
            kinds = {f.name: type(getattr(section, f.name)) for f in fields(section)}
            typed = {
                key: int(value) if kinds.get(key) is int or key in OPTIONAL_NUMBERS else value
                for key, value in entries.items()
            }
            sections[name] = replace(section, **typed)
        return replace(self, **sections)

    @classmethod
    def from_toml(cls, path: str) -> Settings:
        with open(path, "rb") as handle:
            return cls().override(tomllib.load(handle))

    @classmethod
    def from_session(cls, spark: SparkSession) -> Settings:
        """Defaults overridden by ``tagtide.<section>.<key>`` session settings."""
        values: dict[str, dict[str, str]] = {}
        for section in fields(cls):
            for entry in fields(getattr(cls(), section.name)):
                found = spark.conf.get(f"{CONF_PREFIX}{section.name}.{entry.name}", None)
                if found is not None:
                    values.setdefault(section.name, {})[entry.name] = found
        return cls().override(values)


def session(settings: Settings | None = None, hive: bool = False) -> SparkSession:
    """Build (or take over) a session; dynamic partition overwrite and AQE are on.

    The session zone decides which date a post gets. It is pinned to
    ``spark.session_zone``, whatever the machines are set to.
    """
    chosen = (settings or Settings()).spark
    builder = (
        SparkSession.builder.appName(chosen.app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.session.timeZone", chosen.session_zone)
        .config("spark.sql.streaming.noDataProgressEventInterval", str(chosen.batch_seconds * 1000))
    )
    if chosen.master:
        builder = builder.master(chosen.master)
    if chosen.warehouse_dir:
        builder = builder.config("spark.sql.warehouse.dir", chosen.warehouse_dir)
    if chosen.shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(chosen.shuffle_partitions))
    if hive:
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()
