"""Period folders on storage: their latest modification times, and the state kept from the last run."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deltaextract.sources.tables import read_or_empty

log = logging.getLogger(__name__)

FOLDER_STATE = T.StructType(
    [
        T.StructField("data_source", T.StringType()),
        T.StructField("folder", T.StringType()),
        T.StructField("last_modified", T.TimestampType()),
    ]
)


def folder_listing(spark: SparkSession, base_paths: Mapping[str, str]) -> DataFrame:
    """(data_source, folder, last_modified) of every folder that directly holds parquet files.

    Only file metadata is read: the content column is pruned from the scan.
    """
    listings = []
    for data_source, base in base_paths.items():
        try:
            files = spark.read.format("binaryFile").load(f"{base.rstrip('/')}/*/*.parquet")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            log.warning("%s: no parquet files below %s", data_source, base)
            continue
        folder = F.concat(F.element_at(F.split("path", "/"), -2), F.lit("/"))
        listings.append(
            files.groupBy(folder.alias("folder"))
            .agg(F.max("modificationTime").alias("last_modified"))
            .select(F.lit(data_source).alias("data_source"), "folder", "last_modified")
        )
    if not listings:
        return spark.createDataFrame([], FOLDER_STATE)
    return reduce(DataFrame.unionByName, listings)


def write_folder_state(listing: DataFrame, path: str) -> None:
    """Save a listing as one JSON file; it has one row per source and period."""
    listing.select(*FOLDER_STATE.names).coalesce(1).write.mode("overwrite").json(path)


def read_folder_state(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, FOLDER_STATE, "json")
