"""Blocks of documents with a dictionary of their own.

A block is one row: some documents as lists of term numbers, and the distinct terms these number. What is done per term is then done once for each term of a block, and
documents are put together again by array look-ups, without a shuffle of their terms.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa


def slices_of(batch: pa.RecordBatch, column: str, chars: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of an Arrow batch with about ``chars`` characters of text each, and their texts (null: empty); a longer text is a part of its own."""
    texts = [x or "" for x in batch.column(column).to_pylist()]
    start = held = 0
    for at, text in enumerate(texts):
        if at > start and held + len(text) > chars:
            yield batch.slice(start, at - start), texts[start:at]
            start, held = at, 0
        held += len(text)
    if texts:
        yield batch.slice(start), texts[start:]


def one_list(values: pa.Array) -> pa.Array:
    """A column of one row that is the list of ``values``."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def ragged(rows: list[np.ndarray], kind: type) -> pa.Array:
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*rows, np.zeros(0, kind)]).astype(kind)))


def cached(build: Callable) -> Callable:
    """Built once while a worker lives."""
    return lru_cache(maxsize=2)(build)
