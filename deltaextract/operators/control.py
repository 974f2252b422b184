"""Control totals and the control file's rows."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deltaextract.config import PERIOD_END, PERIOD_START


def record_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """(entity, records), one row per frame. Counts need no columns, so parquet sources answer from their footers."""
    counts = [f.agg(F.count(F.lit(1)).alias("records")).select(F.lit(n).alias("entity"), "records") for n, f in frames.items()]
    return reduce(DataFrame.unionByName, counts)


def part_count(records: Column, target_rows: int | Column) -> Column:
    """Parts an output of so many rows is split into; an exact multiple of the target gives one part more."""
    return F.greatest(F.lit(1).cast("long"), F.floor(records / F.lit(target_rows)).cast("long") + 1)


def _moment(value: datetime) -> Column:
    # Without a zone: the same text whatever the session's or the driver's time zone.
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def control_rows(
    entries: DataFrame,
    datum: str,
    period_start: datetime = PERIOD_START,
    period_end: datetime = PERIOD_END,
) -> DataFrame:
    """One row per delivered file from entries (files array<string>, records long); totals repeat on every part."""
    # The column names of the control file.
    return entries.select(
        F.explode("files").alias("cExtractFileName"),
        F.col("records").cast("long").alias("nRecordCount"),
        F.lit(datum).alias("cDatum"),
        _moment(period_start).alias("dPeriodStart"),
        _moment(period_end).alias("dPeriodEnd"),
    )
