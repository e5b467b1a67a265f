"""The shared folder that holds checkpoints and intermediate tables."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; where none is set, one in the warehouse.

    On a cluster that has to be shared as well: a folder of one machine is refused.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named is None:
        named = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
        if not context.master.startswith("local") and named.startswith(("file:", "/")):
            raise ValueError("spark.checkpoint.dir is unset and the warehouse is a folder of one machine")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/tagtide/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so later stages survive lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, its size known."""
    return _written(df, new_path(df.sparkSession, name))


def drop_shuffles(spark: SparkSession) -> None:
    """Shuffle files of finished results that nobody holds any more go from the disks.

    The engine removes them when the driver's garbage is collected, which by itself may be
    half an hour later.
    """
    gc.collect()
    spark._jvm.System.gc()


def moved(spark: SparkSession, path: str, schema: StructType, name: str) -> DataFrame:
    """The ORC folder ``path`` renamed to a place of its own: its rows outlive their table without a copy."""
    to = new_path(spark, name)
    old, new = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, to))
    files = old.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(old)
    files.mkdirs(new.getParent())
    if not files.rename(old, new):
        raise OSError(f"{path} could not be renamed to {to}")
    return spark.read.schema(schema).orc(to)


class Scratch:
    """Stored tables that go when the ``with`` block ends: nothing may still read them then."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path, self.tables = spark, new_path(spark, name), 0

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        self.tables += 1
        return _written(df, f"{self.path}/{self.tables}-{name}")

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
