"""Command line: ``python -m tagtide JOB [--settings FILE] [...]``."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from tagtide import catalog
from tagtide.config import Settings, session
from tagtide.plans import jobs
from tagtide.sinks.tables import preview
from tagtide.sources import feeds


PRINTED = 1000


def _feed(spark: SparkSession, settings: Settings, folder: str | None):
    """Kafka records, or a folder of documents in their shape."""
    if folder is None:
        return feeds.kafka_stream(spark, settings.kafka)
    return feeds.as_records(feeds.document_stream(spark, folder), settings.kafka.raw_topic)


def run(spark: SparkSession, settings: Settings, options: argparse.Namespace) -> None:
    tables, now = settings.tables, options.now
    if options.job == "create-tables":
        catalog.create_all(spark, tables)
        catalog.create_top_view(spark, tables.analytic_table, tables.analytic_view)
    elif options.job == "ingest":
        folder = feeds.document_stream(spark, options.feed)
        rows = jobs.ingest_until_collected(folder, options.out, options.checkpoint, settings)
        print(f"{rows} posts collected")
    elif options.job == "land":
        rows = jobs.land_until_stopped(_feed(spark, settings, options.feed), settings)
        print(f"{rows} posts landed")
    elif options.job == "land-to-base":
        print(f"{jobs.land_to_base(spark, settings, now, load=options.load)} posts added to the base table")
    elif options.job == "base-to-analytic":
        print(jobs.base_to_analytic(spark, settings, now, merge_mode=options.merge))
    elif options.job == "status":
        preview(jobs.staging_status(spark.table(tables.staging_table), tables.time_zone, now))
    elif options.job == "top":
        top = catalog.top_view(spark.table(tables.analytic_table))
        print(f"{top.count()} rows, of which up to {PRINTED} follow")
        preview(top, PRINTED)


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tagtide")
    parser.add_argument(
        "job",
        choices=["create-tables", "ingest", "land", "land-to-base", "base-to-analytic", "status", "top"],
    )
    parser.add_argument("--settings", help="TOML file with [kafka] [feed] [spark] [tables]")
    parser.add_argument("--feed", help="folder of documents, one per line")
    parser.add_argument("--out", help="folder for accepted documents in place of the topic")
    parser.add_argument("--checkpoint", help="checkpoint folder of the ingest stream")
    parser.add_argument("--now", type=dt.datetime.fromisoformat, help="time of the run, local to the zone")
    parser.add_argument("--load", choices=["append", "replace"], default="append")
    parser.add_argument("--merge", choices=["reference", "replace"], default="reference")
    options = parser.parse_args(argv)
    if options.job == "ingest" and not (options.feed and options.checkpoint):
        parser.error("ingest needs --feed and --checkpoint")
    return options


def main(argv: list[str] | None = None) -> None:
    options = arguments(argv)
    settings = Settings.from_toml(options.settings) if options.settings else Settings()
    run(session(settings, hive=True), settings, options)


if __name__ == "__main__":
    main()
