"""Rolling a fingerprint snapshot forward."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deltaextract.operators.changes import outside_periods


def snapshot_schema(key_fields: Sequence[T.StructField], fy: str, scope: Sequence[str] = ()) -> T.StructType:
    """Keys as typed in the source, then FY, what else fingerprints are grouped by, hash and row count."""
    return T.StructType(
        [
            *key_fields,
            *[T.StructField(name, T.StringType()) for name in (fy, *scope)],
            T.StructField("hash", T.StringType()),
            T.StructField("hash_count", T.LongType()),
        ]
    )


def carry_over(previous: DataFrame, periods: DataFrame, fy: str) -> DataFrame:
    """Previous fingerprints of FYs that were not read this time."""
    return previous.join(periods.select(F.col("fy").alias(fy)), fy, "left_anti")


def merge_snapshot(current: DataFrame, previous: DataFrame, periods: DataFrame | Sequence[str], fy: str) -> DataFrame:
    """Current fingerprints plus the carried-over ones; ``periods`` is a frame with ``fy`` or a list of FYs."""
    kept = carry_over(previous, periods, fy) if isinstance(periods, DataFrame) else outside_periods(previous, periods, fy)
    return current.unionByName(kept)
