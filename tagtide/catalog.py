"""Databases, tables and the top-10 view, generated from the schemas."""

from __future__ import annotations

from os.path import dirname

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tagtide.config import TableSettings
from tagtide.operators.ranking import top_n_per_day
from tagtide.schemas import (
    ANALYTIC,
    BASE,
    LANDING,
    LEDGER,
    NAMES,
    PARTITIONS,
    PUBLISHED_NAMES,
    STAGING,
    TOP_VIEW,
    WINNERS,
    columns_ddl,
)
from tagtide.sinks.tables import TEXT_OPTIONS


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{at}")


def create_table(
    spark: SparkSession, name: str, schema: StructType, path: str, partitioned: bool = True
) -> None:
    """An external ORC table at ``path``."""
    by = f" PARTITIONED BY ({', '.join(PARTITIONS)})" if partitioned else ""
    options = ", ".join(f"'{key}' '{value}'" for key, value in TEXT_OPTIONS.items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns_ddl(schema)}) USING orc OPTIONS ({options}){by} LOCATION '{path}'"
    )


def create_all(spark: SparkSession, tables: TableSettings) -> None:
    """The databases, next to their tables, and the tables of all layers."""
    for table, path in (
        (tables.landing_table, tables.landing_path),
        (tables.base_table, tables.base_path),
        (tables.analytic_table, tables.analytic_path),
        (tables.staging_table, tables.staging_path),
    ):
        if "." in table:
            create_database(spark, table.split(".")[0], dirname(path.rstrip("/")))
    create_table(spark, tables.landing_table, LANDING, tables.landing_path)
    create_table(spark, tables.base_table, BASE, tables.base_path)
    create_table(spark, tables.analytic_table, ANALYTIC, tables.analytic_path)
    create_table(spark, tables.analytic_names_table, PUBLISHED_NAMES, tables.analytic_names_path)
    create_table(spark, tables.staging_table, STAGING, f"{tables.staging_path}/v-0", False)
    create_table(spark, tables.staging_names_table, NAMES, f"{tables.staging_names_path}/v-0", False)
    create_table(spark, tables.ledger_table, LEDGER, f"{tables.ledger_path}/v-0", False)
    create_winners(spark, tables.winners_table, tables.winners_path, tables.winner_buckets)


def create_winners(spark: SparkSession, name: str, path: str, buckets: int) -> None:
    """The winners of every run, in buckets of posts, so that merges don't shuffle them."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns_ddl(WINNERS)}, run string) USING orc PARTITIONED BY (run) "
        f"CLUSTERED BY (tweet_id) INTO {buckets} BUCKETS LOCATION '{path}'"
    )


def add_partitions(spark: SparkSession, table: str) -> None:
    """Make partitions that a stream has written known to a catalog table.

    The jobs read landing by path, where the streaming sink's own list of
    complete files counts; the table is for SQL users.
    """
    spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")


def top_view(analytic: DataFrame, n: int = 10) -> DataFrame:
    return top_n_per_day(analytic, n).select(*TOP_VIEW)


def create_top_view(spark: SparkSession, analytic_table: str, view: str, n: int = 10) -> None:
    """The top-n view for SQL users, kept in the catalog.

    As in ``top_n_per_day``: n rows a day, limited map-side, give the ranks of the
    counts that make the cut; rows are looked up by them, so ties never meet.
    """
    spark.sql(
        f"CREATE VIEW IF NOT EXISTS {view} AS SELECT {', '.join(TOP_VIEW)} FROM {analytic_table} JOIN ("
        "SELECT date_recorded AS of_day, rt_count AS of_count, min(place) AS rank FROM ("
        "SELECT date_recorded, rt_count, "
        "row_number() OVER (PARTITION BY date_recorded ORDER BY rt_count DESC) AS place "
        f"FROM {analytic_table}) AS placed WHERE place <= {n} GROUP BY date_recorded, rt_count) AS ranks "
        "ON date_recorded <=> of_day AND rt_count <=> of_count"
    )


def register_top_view(spark: SparkSession, analytic_table: str, view: str, n: int = 10) -> None:
    """The same as a session view, in the form that splits ties over all tasks."""
    top_view(spark.table(analytic_table), n).createOrReplaceTempView(view)
