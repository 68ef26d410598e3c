"""A shared folder for data that a job writes and reads back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder the cluster names.

    Only a local session may go without ``spark.checkpoint.dir``: executors of a cluster
    could not read a folder of one machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="stationlake-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(rows: DataFrame, name: str) -> DataFrame:
    """Rows written once to the shared folder, so that later steps do not compute them again."""
    folder = scratch_folder(rows.sparkSession, name)
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of the session's file systems; one that is not there is fine."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
