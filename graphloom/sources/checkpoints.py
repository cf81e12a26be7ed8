"""Where iterations cut their lineage: the folder that the cluster names; one of our own only where Spark is local."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors see. Without spark.checkpoint.dir, a cluster has none, and that is an error."""
    sc = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if not at and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(at or tempfile.mkdtemp(prefix="spark-graphloom-"))
    return (at or sc._jsc.sc().getCheckpointDir().get()).rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """df computed once and kept in reliable storage; it outlives the executors that computed it."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
