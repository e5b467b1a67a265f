"""One-file text markers on the table file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_marker(spark: SparkSession, path: str, content: str) -> None:
    marker = spark.createDataFrame([(content,)], "value string")
    marker.coalesce(1).write.mode("overwrite").text(path)


def marker_exists(spark: SparkSession, path: str) -> bool:
    target, files = _path(spark, path)
    return files.exists(target)


def remove_marker(spark: SparkSession, path: str) -> None:
    target, files = _path(spark, path)
    files.delete(target, True)
