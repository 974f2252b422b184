"""Importance resampling towards a target distribution, with features counted once for each distinct line.

Features are runs of words, hashed into buckets. Newlines separate words, so texts are cut into lines: each distinct line of the corpus has its features counted once, and its counts are
multiplied by the number of times it occurs. Runs of several words that cross lines are found document by document and added separately. A bucket's gain is the logarithm of how much likelier it is in the
target; a document's weight is the sum of its features' gains, again a sum over its lines. Gumbel noise from a hash of the id turns the weights into a draw without replacement: the highest
scores are drawn.

What travels: the distinct lines of each task once (to be counted), then per line of a document a hash, its line's sums and nothing else. Lines that make up a thousandth of all lines or more are at most a
thousand; they reach the documents as a broadcast, so that no line that is left holds more than that share of the rows that are shuffled.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import partial
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deltaextract.llm.blocks import ragged, slices_of
from deltaextract.llm.common import plain
from deltaextract.sources.shared import stored

SEED, BUCKETS, MIN_WORDS, PERCENT = 2024, 10_000, 20, 10
HOT_LINES = 1_000
_SLICE_CHARS = 4_000_000

_LONG, _BINARY = T.LongType(), T.BinaryType()


def _fields(*named: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in named])


def _of_line(line: str, min_n: int, max_n: int, buckets: int) -> tuple[int, list[int]]:
    """Number of words, and the bucket of each run of words."""
    words = plain(line).split()
    if min_n == max_n == 1:
        return len(words), [crc32(w) % buckets for w in words]
    return len(words), [crc32(b" ".join(words[i : i + n])) % buckets for n in range(min_n, max_n + 1) for i in range(len(words) - n + 1)]


def _crossing(text: str, min_n: int, max_n: int, buckets: int) -> list[int]:
    """The buckets of those runs of words that lie in more than one line."""
    words, line_of = [], []
    for number, line in enumerate(text.split("\n")):
        found = plain(line).split()
        words += found
        line_of += [number] * len(found)
    return [
        crc32(b" ".join(words[i : i + n])) % buckets
        for n in range(max(min_n, 2), max_n + 1)
        for i in range(len(words) - n + 1)
        if line_of[i] != line_of[i + n - 1]
    ]


def _lines_of_documents(sizes: tuple[int, int, int], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in slices_of(batch, "text", _SLICE_CHARS):
            keys, times, across = [], [], []
            for text in texts:
                lines = Counter(text.split("\n"))
                lines.pop("", None)
                keys.append([hashlib.md5(x.encode(), usedforsecurity=False).digest() for x in lines])
                times.append(np.fromiter(lines.values(), np.int64, len(lines)))
                across.append(np.array(_crossing(text, *sizes) if sizes[1] > 1 else [], "<u4").tobytes())
            columns = [part.column("row"), pa.array(keys, pa.list_(pa.binary())), ragged(times, np.int64), pa.array(across, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["row", "keys", "times", "crossing"])


def _features_of_lines(sizes: tuple[int, int, int], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, lines in slices_of(batch, "text", _SLICE_CHARS):
            found = [_of_line(x, *sizes) for x in lines]
            counted = [pa.array([n for n, _ in found], pa.int64()), pa.array([np.array(b, "<u4").tobytes() for _, b in found], pa.binary())]
            yield pa.RecordBatch.from_arrays([part.column("key"), part.column("times"), *counted], ["key", "times", "n_words", "buckets"])


def _counted(buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features in each bucket, times the occurrences of their lines."""
    total = np.zeros(buckets, np.int64)
    for batch in batches:
        held = batch["buckets"].to_pylist()
        at = np.frombuffer(b"".join(held), "<u4")
        times = np.repeat(batch["times"].to_numpy(), [len(x) // 4 for x in held])
        # In two halves, since sums in doubles are exact up to 2^53 only.
        for shift, part in ((0, times & 0xFFFFFFFF), (32, times >> 32)):
            if part.any():
                total += np.bincount(at, part, buckets).astype(np.int64) << shift
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found])], ["bucket", "n"])


def _weighed(gains: np.ndarray, kept: Sequence[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The columns ``kept``, and the sum of the gains of ``buckets`` and their number."""
    for batch in batches:
        found = [np.frombuffer(x, "<u4") for x in batch["buckets"].to_pylist()]
        sums = [pa.array([int(gains[x].sum()) for x in found], pa.int64()), pa.array([len(x) for x in found], pa.int64())]
        yield pa.RecordBatch.from_arrays([*[batch[c] for c in kept], *sums], [*kept, "weight", "n_features"])


def _lines(texts: DataFrame, text: str) -> DataFrame:
    """Distinct lines with a hash of 128 bits and their number of occurrences; empty ones, and those of null texts, are none."""
    # explode_outer: for explode() Spark would cut each text twice, once to see whether there is a line.
    lines = texts.select(F.explode_outer(F.split(f"`{text}`", "\n")).alias("text")).where("text != ''")
    return lines.groupBy("text").agg(F.count(F.lit(1)).alias("times")).withColumn("key", F.unhex(F.md5("text")))


def line_features(texts: DataFrame, *, text: str = "text", min_n: int = 1, max_n: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """``key``, ``times``, ``n_words`` and ``buckets`` (of each feature, as unsigned 32-bit integers) of every distinct line; stored, so that it is done once."""
    schema = _fields(("key", _BINARY), ("times", _LONG), ("n_words", _LONG), ("buckets", _BINARY))
    return stored(_lines(texts, text).mapInArrow(partial(_features_of_lines, (min_n, max_n, buckets)), schema), "line_features")


def document_lines(docs: DataFrame, *, text: str = "text", min_n: int = 1, max_n: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """``row`` (the columns but the text), ``keys`` and ``times`` of its distinct lines, ``crossing`` (buckets of runs across lines), and a number ``at``, of every document; stored."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("row")
    rows = docs.select(row, F.col(f"`{text}`").alias("text"))
    schema = T.StructType([rows.schema["row"], *_fields(("keys", T.ArrayType(_BINARY)), ("times", T.ArrayType(_LONG)), ("crossing", _BINARY))])
    return stored(rows.mapInArrow(partial(_lines_of_documents, (min_n, max_n, buckets)), schema).withColumn("at", F.monotonically_increasing_id()), "document_lines")


def bucket_counts(features: DataFrame, documents: DataFrame | None, buckets: int) -> np.ndarray:
    """Features in each bucket: those of lines times their occurrences, and those across lines."""
    held = features.select("times", "buckets")
    if documents is not None:
        held = held.unionByName(documents.select(F.lit(1).cast("long").alias("times"), F.col("crossing").alias("buckets")))
    parts = held.mapInArrow(partial(_counted, buckets), _fields(("bucket", _LONG), ("n", _LONG)))
    out = np.zeros(buckets, np.int64)
    for bucket, n in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most one row per bucket
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of how much likelier each bucket is in the target, with one feature added to each."""
    size = float(len(source))
    all_source, all_target = float(source.sum()) + size, float(target.sum()) + size
    return np.array([math.floor(1000 * math.log((t + 1.0) * all_source / ((s + 1.0) * all_target))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def _gumbel(doc_id: Column, seed: int) -> Column:
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0))).cast("long")


def weights(documents: DataFrame, features: DataFrame, gain: np.ndarray) -> DataFrame:
    """``at``, ``row``, ``weight``, ``n_features`` and ``n_words`` of every document of :func:`document_lines`."""
    longs = [("weight", _LONG), ("n_features", _LONG)]
    schema = _fields(("key", _BINARY), ("times", _LONG), ("n_words", _LONG), *longs)
    lines = stored(features.mapInArrow(partial(_weighed, gain, ("key", "times", "n_words")), schema), "line_weights")
    total = lines.agg(F.coalesce(F.sum("times"), F.lit(0)).alias("n")).first().n
    is_hot = F.col("times") * HOT_LINES >= total
    hot = F.broadcast(lines.where(is_hot).drop("times"))  # at most HOT_LINES rows
    held = documents.select("at", F.explode_outer(F.arrays_zip("keys", "times")).alias("l")).where(F.col("l.keys").isNotNull()).select("at", F.col("l.keys").alias("key"), F.col("l.times").alias("k"))
    pairs = [held.join(hot, "key"), held.join(hot.select("key"), "key", "left_anti").join(lines.where(~is_hot).drop("times"), "key")]
    sums = ("weight", "n_features", "n_words")
    parts = [p.select("at", *[(F.col(c) * F.col("k")).alias(c) for c in sums]) for p in pairs]
    across = documents.select("at", F.col("crossing").alias("buckets")).where(F.octet_length("buckets") > 0)
    parts.append(across.mapInArrow(partial(_weighed, gain, ("at",)), _fields(("at", _LONG), *longs)).withColumn("n_words", F.lit(0).cast("long")))
    added = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("at").agg(*[F.sum(c).alias(c) for c in sums])
    return documents.select("at", "row").join(added, "at", "left").select("at", "row", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in sums])


def importance(
    docs: DataFrame, target: DataFrame, *, doc_id: str = "doc_id", text: str = "text", min_n: int = 1, max_n: int = 1,
    buckets: int = BUCKETS, min_words: int = MIN_WORDS, percent: int = PERCENT, seed: int = SEED,
) -> DataFrame:
    """The columns of ``docs`` but the text, and ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank`` (from 1; null: not drawn); columns of these names are replaced.

    Of the N documents with at least ``min_words`` words, the floor(``percent`` * N / 100) highest scores are drawn; ties go to the smaller id (null last). Null and empty texts have no
    features and weight 0. Every row is a document: repeated rows have equal scores, and may be drawn each. Empty tables: without documents the result is empty, and without a target all its counts are 0.
    """
    sizes = {"min_n": min_n, "max_n": max_n, "buckets": buckets}
    added = ("n_words", "n_features", "weight", "score", "rank")
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in added or c in (doc_id, text)])
    documents, features = document_lines(docs, text=text, **sizes), line_features(docs, text=text, **sizes)
    wanted = line_features(target, text=text, **sizes)
    of_target = document_lines(target.select(F.lit(0).alias("none"), F.col(f"`{text}`").alias("text")), **sizes) if max_n > 1 else None
    gain = gains(bucket_counts(features, documents if max_n > 1 else None, buckets), bucket_counts(wanted, of_target, buckets))
    found = weights(documents, features, gain)
    # Ordered by position in the whole table: stored first, since an order is sampled before it is made.
    scored = stored(found.withColumn("score", F.col("weight") + _gumbel(F.col(f"row.`{doc_id}`"), seed)).withColumn("may", F.col("n_words") >= min_words), "scored")
    order = [F.desc("may"), F.desc("score"), F.asc_nulls_last(f"row.`{doc_id}`"), F.asc("at")]
    placed = stored(scored.orderBy(*order).withColumn("place", F.monotonically_increasing_id()), "placed")
    # A place is the number of a partition and that of a row in it; partitions are few, and in order.
    part = F.shiftright("place", 33)
    sizes_of = sorted(placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.count_if("may").alias("may")).collect())
    drawn = percent * sum(p.may for p in sizes_of) // 100
    before = np.cumsum([0] + [p.n for p in sizes_of]).tolist()
    offsets = docs.sparkSession.createDataFrame([(p.part, b) for p, b in zip(sizes_of, before, strict=False)], _fields(("part", _LONG), ("before", _LONG)))
    number = F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1) + 1
    ranked = placed.withColumn("part", part).join(F.broadcast(offsets), "part").withColumn("rank", F.when(number <= drawn, number))
    return ranked.select("row.*", *added)
