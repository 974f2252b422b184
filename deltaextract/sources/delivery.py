"""Delivered files: size-controlled delimited parts, and the control file that lists them."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the delivery contract.
ENCODING = "windows-1252"
PART_FORMAT = {
    "header": True,
    "sep": "|",
    "lineSep": "\n",
    "dateFormat": "yyyy-MM-dd",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
    "emptyValue": "",
    "compression": "gzip",
}
CONTROL_FORMAT = {**PART_FORMAT, "sep": "|~|", "lineSep": "\r\n", "compression": "none"}

_SPARK_CHARSETS = {"US-ASCII", "ISO-8859-1", "UTF-8", "UTF-16BE", "UTF-16LE", "UTF-16", "UTF-32"}
_CHARSETS_CONF = "spark.sql.legacy.javaCharsets"


@contextmanager
def charset_allowed(spark: SparkSession, encoding: str) -> Iterator[None]:
    """Let CSV jobs use a charset outside Spark's short list, for the duration of the block."""
    if encoding.upper() in _SPARK_CHARSETS:
        yield
        return
    before = spark.conf.get(_CHARSETS_CONF, None)
    spark.conf.set(_CHARSETS_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CHARSETS_CONF)
        else:
            spark.conf.set(_CHARSETS_CONF, before)


def parts_for(records: int, target_rows: int) -> int:
    """Parts for so many records; an exact multiple of the target gives one part more."""
    return max(1, records // target_rows + 1)


def write_delivery(
    frame: DataFrame, path: str, target_rows: int, records: int | None = None, encoding: str = ENCODING, finish: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> int:
    """Write gzip-compressed delimited parts of about ``target_rows`` rows and return the number of records.

    Null and empty text both write as nothing. Pass a stored frame: it is counted (unless ``records`` is given) and
    then written. ``finish`` is applied to rows that lie in their parts already, so what it makes is not shuffled; it must keep each row.
    """
    if records is None:
        records = frame.count()
    with charset_allowed(frame.sparkSession, encoding):
        parts = finish(frame.repartition(parts_for(records, target_rows)))
        # Each task moves its own part into place; otherwise the driver would move all of them, one after another.
        options = {**PART_FORMAT, "encoding": encoding, "mapreduce.fileoutputcommitter.algorithm.version": 2}
        parts.write.mode("overwrite").options(**options).csv(path)
    return records


def write_control(rows: DataFrame, path: str, encoding: str = ENCODING) -> None:
    """Write control rows (one per delivered part) as a single uncompressed file, in order of the parts' names."""
    with charset_allowed(rows.sparkSession, encoding):
        rows.repartition(1).sortWithinPartitions(rows.columns[0]).write.mode("overwrite").options(encoding=encoding, **CONTROL_FORMAT).csv(path)


def delivered_files(spark: SparkSession, path: str) -> DataFrame:
    """(file) names of the delivered parts below ``path``, as ``<last folder>/<file>``."""
    files = spark.read.format("binaryFile").load(f"{path.rstrip('/')}/*.csv.gz")
    return files.select(F.array_join(F.slice(F.split("path", "/"), -2, 2), "/").alias("file"))
