"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters of text that a Python task works on at a time, whatever the size of the Arrow batch.
SLICE_CHARS = 1_000_000

_trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None


def fold_of(doc_id: Column, folds: int) -> Column:
    """Fold of a document: crc32 of its id as text, modulo ``folds``. A null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(folds))


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` cut from its lineage, in the folder that ``spark.checkpoint.dir`` names; below the warehouse where that is unset."""
    spark = df.sparkSession
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints")
    return df.checkpoint()


def slices(texts: pd.Series, chars: int = SLICE_CHARS) -> Iterator[list[str | None]]:
    """The texts in order, in lists of about ``chars`` characters (a longer text is a list of its own)."""
    out: list[str | None] = []
    held = 0
    for text in texts:
        if out and held + len(text or "") > chars:
            yield out
            out, held = [], 0
        out.append(text)
        held += len(text or "")
    if out:
        yield out


def give_back() -> None:
    """Returns to the system what the allocators of this process keep of freed batches."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def each(batches: Iterator, work: Callable[..., Iterator]) -> Iterator:
    """What ``work`` makes of each batch, in order.

    A batch is let go before the next one is read, and its memory goes back to the system: workers outlive their tasks, and all of an executor's share what its JVM leaves.
    """
    for batch in batches:
        yield from work(batch)
        del batch
        give_back()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")



# Everything but 0-9, a-z and what is not ASCII separates words, after lower-casing A-Z.
_SEPARATORS = bytes(b for b in range(128) if not (0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A))
_TABLE = bytes.maketrans(_SEPARATORS, b" " * len(_SEPARATORS))


def plain(text: str | None) -> bytes:
    """UTF-8 of ``text`` with A-Z lower-cased and a blank for each separator; a null text is empty.

    Bytes of characters beyond ASCII stay as they are, and none of them is white space to ``bytes.split``.
    """
    return (text or "").encode("utf-8", "replace").lower().translate(_TABLE)
