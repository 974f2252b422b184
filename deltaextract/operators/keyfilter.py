"""A filter of keys of bounded size, to drop most rows outside a cohort before they are hashed and shuffled.

A cohort too large to broadcast is joined by a shuffle, after the source has been reduced to one row per group. Without a filter every source row would be hashed and every group
sent, though a region's cohort is a small part of a national table. The filter is one bit for each hash value of a key: rows whose bit is not set are
outside for sure, and a few outside rows pass (about one in ``BITS_PER_KEY``); the exact join comes later. It is made of built-in bitmap functions, and is a broadcast of at most ``MAX_BITS`` bits, whatever the cohort.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS_PER_KEY = 16
MIN_BITS, MAX_BITS = 1 << 15, 1 << 30
_WHOLE = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())


@dataclass(frozen=True)
class KeyFilter:
    """``bitmaps``: rows of a number and 32,768 bits. Hashes are of ``types``, so that an ``int`` and a ``bigint`` key with equal values have the same bit."""

    bitmaps: DataFrame
    bits: int
    types: tuple[T.DataType, ...]

    @classmethod
    def of(cls, cohort: DataFrame, keys: Sequence[str], n_keys: int | None = None) -> KeyFilter:
        """Of the keys of a cohort. ``n_keys``: about how many there are; counted if not given."""
        wanted = BITS_PER_KEY * (cohort.count() if n_keys is None else n_keys)
        bits = min(MAX_BITS, max(MIN_BITS, 1 << max(wanted - 1, 1).bit_length()))
        types = tuple(_hashed_type(cohort.schema[k].dataType) for k in keys)
        value = _value(keys, types, bits)
        positions = cohort.dropna(subset=list(keys)).select(F.bitmap_bucket_number(value).alias("__bitmap"), F.bitmap_bit_position(value).alias("__at"))
        return cls(positions.groupBy("__bitmap").agg(F.bitmap_construct_agg("__at").alias("__bits")), bits, types)

    def fits(self, source: DataFrame, keys: Sequence[str]) -> bool:
        """Whether the source's keys hash like the cohort's. Otherwise (say text against numbers) an equal key could have another bit."""
        return all(_hashed_type(source.schema[k].dataType) == kind for k, kind in zip(keys, self.types, strict=True))

    def keep(self, source: DataFrame, keys: Sequence[str]) -> DataFrame:
        """Source rows whose key may be in the cohort; all of them if :meth:`fits` says no. Null keys are not."""
        if not self.fits(source, keys):
            return source
        value = _value(keys, self.types, self.bits)
        at = F.bitmap_bit_position(value)
        octet = F.conv(F.hex(F.substring("__bits", F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        is_set = F.getbit(octet, at.bitwiseAND(7).cast("int")) == 1
        named = F.bitmap_bucket_number(value) == F.col("__bitmap")
        return source.dropna(subset=list(keys)).join(F.broadcast(self.bitmaps), named & is_set, "left_semi")


def _hashed_type(kind: T.DataType) -> T.DataType:
    return T.LongType() if kind in _WHOLE else kind


def _value(keys: Sequence[str], types: Sequence[T.DataType], bits: int) -> Column:
    columns = [F.col(f"`{k}`").cast(kind) for k, kind in zip(keys, types, strict=True)]
    return F.pmod(F.xxhash64(*columns), F.lit(bits)) + 1
