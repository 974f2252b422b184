"""Size checks behind every broadcast hint."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 32 * 1024 * 1024
_ROW_OVERHEAD = 32


def measured(frame: DataFrame) -> DataFrame:
    """One row, ``bytes``: the frame's values as text plus a per-row overhead."""
    widths = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in frame.columns]
    row = reduce(lambda a, b: a + b, widths, F.lit(_ROW_OVERHEAD)).cast("long")
    return frame.agg(F.coalesce(F.sum(row), F.lit(0)).alias("bytes"))


def are_small(frames: Sequence[DataFrame], max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether all frames together stay below a size, measured in one job."""
    return reduce(DataFrame.unionByName, map(measured, frames)).agg(F.sum("bytes")).first()[0] <= max_bytes
