"""Parquet tables dealt into buckets by key: two of them, or one and a frame dealt out alike, meet by key without a shuffle of the table.

Only files last; the catalog holds such a table while a frame over it is made, under a name of its own. Within a bucket rows are sorted by period, so that conditions on the
period skip row groups.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@contextmanager
def _table(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int) -> Iterator[str]:
    name = f"deltaextract_{uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) INTO {buckets} BUCKETS LOCATION {_quoted(path)}")
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE {name}")  # its files stay


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def dealt_out(frame: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """``frame`` with its rows where a table of so many buckets has them."""
    return frame.repartition(buckets, *keys)


def write_buckets(frame: DataFrame, path: str, keys: Sequence[str], period: str, buckets: int, mode: str = "overwrite") -> None:
    """One file per bucket. ``append`` adds files to a table of the same columns and buckets."""
    spark, placed = frame.sparkSession, dealt_out(frame, keys, buckets).sortWithinPartitions(period, *keys)
    if mode == "append":
        with _table(spark, path, frame.schema, keys, buckets) as name:
            placed.write.insertInto(name)
        return
    name = f"deltaextract_{uuid4().hex}"
    placed.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).option("path", path).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")


def read_buckets(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int) -> DataFrame:
    """A table of :func:`write_buckets`; one that does not exist is empty."""
    try:
        spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    with _table(spark, path, schema, keys, buckets) as name:
        return spark.table(name)
