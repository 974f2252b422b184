"""State kept between runs: which runs completed, and the fingerprint snapshot they add up to.

Each run writes its fingerprints to ``<entity>/run=<id>/<period>=.../``, by the period of the folder that rows were read from, and, as its very last step, writes one record to
the list of completed runs. That record makes its fingerprints and folder state visible all at once, so a run that
dies half way leaves the previous state untouched and can simply be repeated. Periods a run did not read are not
copied: a run's rows stay visible until a later run has read their period again. A period read without any row (its folder is gone) hides the earlier rows and puts nothing in their place.

Records lie in a folder named by the run's number. Two runs that overlap have the same number, and the first to complete is the run of that number; the other fails.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deltaextract.sources.buckets import read_buckets, write_buckets
from deltaextract.sources.tables import read_or_empty, write_by_period

RUN_SCHEMA = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("fys", T.ArrayType(T.StringType())),
        T.StructField("full", T.BooleanType()),
        # What stored hashes depend on.
        T.StructField("time_zone", T.StringType()),
        T.StructField("hash_encoding", T.StringType()),
        T.StructField("digest", T.StringType()),
        # Of fingerprints stored in buckets by key; 0 or null: by period.
        T.StructField("buckets", T.IntegerType()),
    ]
)


class Overtaken(RuntimeError):
    """Another run of the same feed completed while this one was running; nothing of this one counts."""


def _records(spark: SparkSession, path: str) -> DataFrame:
    """Of each run number the record that was there first."""
    try:
        records = spark.read.schema(RUN_SCHEMA).json(f"{path}/*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], RUN_SCHEMA)
    written = F.struct(F.col("_metadata.file_modification_time"), F.col("run_id"))
    return records.groupBy("seq").agg(F.min_by(F.struct(*RUN_SCHEMA.names), written).alias("run")).select("run.*")


def completed_runs(spark: SparkSession, path: str) -> list[Row]:
    """Completed runs from the last one that holds a full snapshot, in order. One small record per run."""
    runs = _records(spark, path)
    last_full = runs.where("full").agg(F.coalesce(F.max("seq"), F.lit(0)).alias("seq")).first().seq
    return runs.where(F.col("seq") >= last_full).orderBy("seq").collect()


def record_run(spark: SparkSession, path: str, run: Row) -> None:
    """Make a run count. :class:`Overtaken` if there is a run of its number or a later one already."""

    def later() -> list[Row]:
        return _records(spark, path).where(F.col("seq") >= run.seq).orderBy("seq").limit(1).collect()

    found = later()
    if not found:
        spark.createDataFrame([run], RUN_SCHEMA).coalesce(1).write.mode("append").json(f"{path}/{run.seq:09d}")
        found = later()
    if found[0].run_id != run.run_id:
        raise Overtaken(f"run {found[0].run_id} completed meanwhile; repeat run {run.run_id} under another id")


def write_fingerprints(frame: DataFrame, path: str, keys: Sequence[str], period: str, buckets: int, mode: str = "overwrite") -> None:
    """Fingerprints of one run and entity: partitioned by period, or in ``buckets`` by key if there are any."""
    if buckets:
        write_buckets(frame, path, keys, period, buckets, mode)
    else:
        write_by_period(frame, path, period, mode)


def read_fingerprints(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int | None) -> DataFrame:
    if buckets:
        return read_buckets(spark, path, schema, keys, buckets).select(*schema.names)
    return read_or_empty(spark, path, schema).select(*schema.names)


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], period: str, runs: Sequence[Row]) -> DataFrame:
    """Fingerprints visible after ``runs``: each run's rows except for periods that a later run has read.

    Each run's folder is named, so that those of hidden and unfinished runs are not even listed; an entity that a run did not have yet has
    no rows of it. Conditions are on the partition column. There are at most as many runs as lie between two full snapshots.
    """
    if not runs:
        return spark.createDataFrame([], schema)
    visible, later = [], set()
    for run in reversed(runs):
        rows = read_fingerprints(spark, f"{path}/run={run.run_id}", schema, keys, run.buckets)
        visible.append(rows.where(~F.col(period).isin(sorted(later))) if later else rows)
        later |= set(run.fys)
    return reduce(DataFrame.unionByName, visible)
