"""Tables written between steps, in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir; where that is unset, below the warehouse, unless that is a folder of the
    driver's machine which executors elsewhere don't see."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        if (root.startswith("file:") or "://" not in root) and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root.rstrip('/')}/tomewright-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "t", *, keyed: bool = False, folder: str | None = None) -> DataFrame:
    """Writes df as Parquet into the shared folder and reads it back: cuts the lineage and outlives executors.

    keyed: joins meet it by key. Its size in files says little about that of its rows, so a table that looks small enough to be
    broadcast may be too large for the driver. folder: one that is there already."""
    spark = df.sparkSession
    path = f"{folder or shared_folder(spark)}/{name}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    if keyed:
        out = out.hint("merge")
    out.__dict__["written_to"] = path
    return out


def read_part(spark: SparkSession, schema: StructType, path: str) -> DataFrame:
    """A folder of a partitioned table, which is missing where the partition has no rows."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt by key over some tasks for each core, ahead of work that costs much for each row: a file with few bytes a row
    has one or two splits, whose tasks would do all of it."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism), key)


def discard(*written: DataFrame) -> None:
    """Deletes what ``materialize`` wrote, once nothing reads it any more."""
    for df in written:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.__dict__["written_to"])
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path.getParent(), True)
