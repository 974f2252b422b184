"""Tables written between jobs, in the folder all executors share."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session, or a folder of the warehouse, which executors share as well, where that is unset."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return configured.rstrip("/") if configured else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid4().hex}"


def stored(frame: DataFrame, label: str) -> DataFrame:
    """Write a frame once and read it back: lineage is cut, lost executors cost nothing, sizes are known to Spark."""
    path = scratch_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
