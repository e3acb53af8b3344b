"""Cutting lineage with a written table in the cluster's shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir`` (or set on the context).

    A local-mode session without one gets a new temporary folder; on a cluster the
    setting is required, because executors cannot read each other's local disks.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder:
        return folder
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tallyspark-"))
    return sc.getCheckpointDir()


def park(df: DataFrame) -> DataFrame:
    """Write ``df`` once and read it back.

    The plan up to here runs exactly once, survives lost executors, and later
    readers still get column pruning and filter pushdown. Tables live under
    ``<shared folder>/<application id>``; drop that folder when the job has ended.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
