"""Stored tables: by path with a declared schema, or by name from the catalog."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tagtide.operators.filters import scan_since


def orc_path(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A partitioned ORC folder; the schema keeps the partition types narrow."""
    return spark.read.schema(schema).orc(path)


def orc_path_since(
    spark: SparkSession, path: str, schema: StructType, day: dt.date, mode: str = "calendar"
) -> DataFrame:
    return scan_since(orc_path(spark, path, schema), day, mode)


def table_since(spark: SparkSession, name: str, day: dt.date, mode: str = "calendar") -> DataFrame:
    return scan_since(spark.table(name), day, mode)
