"""Filter interaction audit over a sparse document-term matrix.

Words are numbered for the whole corpus, and blocks of documents become shards of a sparse matrix (compressed rows: how many entries each row has, their columns in any order, their counts). A row's sum
is its document's number of words and its number of entries that of different words, which decide the filters on length and repetition. The other flags come with the rows; documents are then counted by
what they fail, and every order of the filters is read from these few counts.

How words get their numbers: each block has a dictionary of its own, whose words are dealt out by hash into buckets; a word's rank within its bucket, times the number of buckets, plus the bucket is its
number. That is the same whichever task computes it, and takes one shuffle of the blocks' dictionaries; a very common word is one row for each block there. The matrix itself moves once, compressed.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from functools import partial, reduce
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deltaextract.llm.blocks import one_list, slices_of
from deltaextract.sources.shared import stored

BLOCK_CHARS = 12_000_000
#: So many that a bucket's words are few in any corpus; sorting by bucket first is cheap.
WORD_BUCKETS = 1 << 20
# The filters of the audit.
FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_CAPITALS_PERCENT = 200, 50, 2
_CAPITALS, _SIGNS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|"

_BINARY = T.BinaryType()
_FLAGS = T.StructType([T.StructField("c", T.BooleanType()), T.StructField("d", T.BooleanType())])


def _packed(values: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(values).tobytes(), 1)


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), kind)


def _shard(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Entries of each row, columns (each row's are in order) and counts, and the words that columns stand for."""
    numbers: dict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    number = numbers.__getitem__
    entries, columns, counts = [], [], []
    for text in texts:
        found = Counter(text.split())  # bytes: white space is exactly blank and \x09 to \x0d
        at = np.array(list(map(number, found)), np.int64)
        order = np.argsort(at)
        entries.append(len(found))
        columns.append(at[order])
        counts.append(np.fromiter(found.values(), np.int64, len(found))[order])
    none = np.zeros(0, np.int64)
    return np.array(entries, np.int64), np.concatenate([*columns, none]), np.concatenate([*counts, none]), list(numbers)


def _steps(entries: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Columns as differences within each row: small numbers, which compress well."""
    out = np.diff(columns, prepend=0)
    starts = (np.cumsum(entries) - entries)[entries > 0]
    out[starts] = columns[starts]
    return out


def _columns(entries: np.ndarray, steps: np.ndarray) -> np.ndarray:
    total = np.cumsum(steps)
    before = np.concatenate([[0], total])[np.cumsum(entries) - entries]
    return total - np.repeat(before, entries)


def _flags(texts: list[str], octets: list[bytes]) -> pa.Array:
    capitals = [100 * (len(x) - len(x.translate(None, _CAPITALS))) > MAX_CAPITALS_PERCENT * len(t) for t, x in zip(texts, octets, strict=True)]
    signs = [len(x.translate(None, _SIGNS)) < len(x) for x in octets]
    return pa.StructArray.from_arrays([pa.array(capitals, pa.bool_()), pa.array(signs, pa.bool_())], ["c", "d"])


def _to_shards(chars: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in slices_of(batch, "text", chars):
            octets = [x.encode() for x in texts]
            entries, columns, counts, words = _shard(octets)
            rows = pa.StructArray.from_arrays([part.column("row"), _flags(texts, octets)], ["row", "flags"])
            parts = [_packed(entries.astype(np.int32)), _packed(_steps(entries, columns).astype(np.int32)), _packed(counts.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([one_list(rows), *[pa.array([x], pa.binary()) for x in parts], one_list(pa.array(words, pa.binary()))], ["docs", "entries", "steps", "counts", "words"])


def _with_numbers(shards: pa.Table, numbered: pa.Table) -> pa.Table:
    """One shard with the numbers of its words, given by their places in its own dictionary. A shard of empty texts has no words."""
    if not shards.num_rows:
        raise ValueError("numbers without a shard")
    entries = _unpacked(shards["entries"][0].as_py(), np.int32).astype(np.int64)
    numbers = np.zeros(numbered.num_rows, np.int64)
    numbers[numbered["pos"].to_numpy()] = numbered["number"].to_numpy()
    columns = numbers[_columns(entries, _unpacked(shards["steps"][0].as_py(), np.int32).astype(np.int64))]
    counts = _unpacked(shards["counts"][0].as_py(), np.int32).astype(np.int64)
    parts = [pa.array([_packed(x)], pa.binary()) for x in (entries, columns, counts)]
    return pa.table([shards["docs"], *parts], names=["docs", "entries", "columns", "counts"])


def document_term_matrix(docs: DataFrame, *, text: str = "text", chars: int = BLOCK_CHARS) -> DataFrame:
    """Shards of the matrix: ``docs`` (array of ``row``, the columns of ``docs`` but the text, and ``flags``), ``entries`` (of each row), ``columns`` and ``counts`` (row after row; compressed 64-bit integers).

    Columns are numbers of words that mean the same in every shard. A null text is an empty row. A very long text is a shard of its own.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("row")
    rows = docs.select(row, F.col(f"`{text}`").alias("text"))
    each = T.StructType([rows.schema["row"], T.StructField("flags", _FLAGS)])
    binaries = [T.StructField(n, _BINARY) for n in ("entries", "steps", "counts")]
    schema = T.StructType([T.StructField("docs", T.ArrayType(each)), *binaries, T.StructField("words", T.ArrayType(_BINARY))])
    # Stored: what is numbered must be what the rows refer to.
    shards = stored(rows.mapInArrow(partial(_to_shards, chars), schema).withColumn("shard", F.monotonically_increasing_id()), "shards")

    words = shards.select("shard", F.posexplode_outer("words").alias("pos", "word")).where("word IS NOT NULL").withColumn("bucket", F.pmod(F.xxhash64("word"), F.lit(WORD_BUCKETS)))
    rank = F.dense_rank().over(Window.partitionBy("bucket").orderBy("word"))
    numbered = words.select("shard", "pos", (rank.cast("long") * WORD_BUCKETS + F.col("bucket")).alias("number"))
    out = T.StructType([shards.schema["docs"], *[T.StructField(n, _BINARY) for n in ("entries", "columns", "counts")]])
    # A group is one shard and the words of its dictionary, so it is as large as a block.
    return shards.drop("words").groupBy("shard").cogroup(numbered.groupBy("shard")).applyInArrow(_with_numbers, out)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for docs, data, counts in zip(batch["docs"], batch["entries"], batch["counts"], strict=True):
            entries = _unpacked(data.as_py(), np.int64)
            totals = np.concatenate([[0], np.cumsum(_unpacked(counts.as_py(), np.int64))])
            ends = np.cumsum(entries)
            rows = docs.values
            yield pa.RecordBatch.from_arrays([rows.field("row"), rows.field("flags"), pa.array(totals[ends] - totals[ends - entries]), pa.array(entries)], ["row", "flags", "n_words", "n_distinct"])


def row_sums(matrix: DataFrame) -> DataFrame:
    """``row``, ``flags``, ``n_words`` (sum of the row) and ``n_distinct`` (its entries) of every document of :func:`document_term_matrix`."""
    each = matrix.schema["docs"].dataType.elementType
    longs = [T.StructField(n, T.LongType()) for n in ("n_words", "n_distinct")]
    return matrix.select("docs", "entries", "counts").mapInArrow(_sums, T.StructType([*each.fields, *longs]))


def _mask(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, [F.when(c, 1 << k).otherwise(0) for k, c in enumerate(conditions)])


def failures(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", chars: int = BLOCK_CHARS) -> DataFrame:
    """Documents counted (``n``) by ``part``, ``mask`` (bit k: fails filter k), ``good`` and ``toxic``.

    Copies are told by SHA-256 of the text (null: empty). A null id is no smaller than another and has none smaller. Rows with equal id and text are each a document, and none of them
    makes the other a copy. If labels hold an id several times, one label of 1 is enough. Hot texts: rows are counted by id first, then by text, part and label, so that of a group of copies
    a few rows are left before they meet.
    """
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")), 256)).alias("digest"),
        F.col(f"`{text}`").alias("text"),
    )
    found = row_sums(document_term_matrix(rows, chars=chars))
    short, repetitive = F.col("n_words") < MIN_WORDS, 100 * F.col("n_distinct") < MIN_DISTINCT_PERCENT * F.col("n_words")
    flagged = found.select("row.*", _mask([short, repetitive, F.col("flags.c"), F.col("flags.d")]).alias("mask"))
    # Rows without an id are dealt out by text.
    salt = F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(0)
    by_id = flagged.groupBy("doc_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("k")).withColumn("salt", salt)
    labelled = labels.groupBy("doc_id").agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")).withColumn("salt", F.lit(0).cast("long"))
    joined = by_id.join(labelled, ["doc_id", "salt"], "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    # Of each text, part and label: the rows, those without an id, and the smallest id with the number of its rows.
    no_id = F.col("doc_id").isNull()
    groups = joined.groupBy("digest", "part", "mask", "good", "toxic").agg(F.sum("k").alias("n"), F.sum(F.when(no_id, F.col("k")).otherwise(0)).alias("without"), F.min(F.when(~no_id, F.struct("doc_id", "k"))).alias("least"))
    smallest = F.min("least.doc_id").over(Window.partitionBy("digest"))
    first = F.col("without") + F.when(F.col("least.doc_id") == smallest, F.col("least.k")).otherwise(0)
    split = groups.select("part", "mask", "good", "toxic", F.col("n"), first.alias("first"))
    copy = 1 << FILTERS.index("E")
    both = F.explode(F.array(F.struct(F.col("mask"), F.col("first").alias("n")), F.struct((F.col("mask") + copy).alias("mask"), (F.col("n") - F.col("first")).alias("n"))))
    out = split.select("part", "good", "toxic", both.alias("x")).groupBy("part", F.col("x.mask").alias("mask"), "good", "toxic").agg(F.sum("x.n").alias("n"))
    return out.where("n > 0")


def orders(counts: DataFrame) -> DataFrame:
    """The audit of :func:`failures`: one row per part, order of the filters and step, with the columns of :func:`audit`."""
    masks = range(1 << len(FILTERS))

    def total(label: Column | None) -> Column:
        n = F.col("n") if label is None else F.when(label, F.col("n")).otherwise(0)
        return F.array(*[F.coalesce(F.sum(F.when(F.col("mask") == m, n)), F.lit(0)).cast("long") for m in masks])

    parts = counts.groupBy("part").agg(total(None).alias("all"), total(F.col("good")).alias("good"), total(F.col("toxic")).alias("toxic"))
    steps = []
    for order in permutations(FILTERS):
        for step, name in enumerate(order, start=1):
            bit, before = 1 << FILTERS.index(name), sum(1 << FILTERS.index(x) for x in order[: step - 1])
            steps.append(f"{''.join(order)} {step} {bit} {before}")
    # One constant text instead of some thousand constants.
    fields = F.split("s", " ")
    each = parts.select("*", F.explode(F.split(F.lit(",".join(steps)), ",")).alias("s"))
    each = each.select("part", "all", "good", "toxic", fields[0].alias("filter_order"), fields[1].cast("int").alias("step"), fields[2].cast("int").alias("bit"), fields[3].cast("int").alias("before"))
    bit, before = F.col("bit"), F.col("before")
    fails, passed = lambda m: m.bitwiseAND(bit) != 0, lambda m: m.bitwiseAND(before) == 0

    def count(values: str, condition) -> Column:
        return F.aggregate(F.transform(values, lambda n, m: F.when(condition(m), n).otherwise(F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda a, x: a + x)

    # A filter removes a document in those orders that have it before all others that the document fails: one in as many as it fails.
    share = F.array(*[F.lit(factorial(len(FILTERS)) // max(1, m.bit_count())).cast("long") for m in masks])
    shapley = F.aggregate(F.transform("all", lambda n, m: F.when(fails(m), n * F.get(share, m)).otherwise(F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda a, x: a + x)
    removed = lambda m: fails(m) & passed(m)
    return each.select(
        "part",
        "filter_order",
        "step",
        count("all", lambda m: m.bitwiseAND(bit.bitwiseOR(before)) == 0).alias("kept"),
        count("all", removed).alias("removed"),
        count("all", lambda m: fails(m) & ~passed(m)).alias("redundant"),
        count("all", lambda m: m == bit).alias("unique_fails"),
        count("good", removed).alias("good_lost"),
        count("toxic", removed).alias("toxic_lost"),
        shapley.alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, **settings: int | str) -> DataFrame:
    """One row per part, order of the five filters and step (from 1), in long counts of documents within the part.

    ``kept`` after this step, ``removed`` here, ``redundant`` (fails its filter but was removed earlier), ``unique_fails`` (fails its filter only), ``good_lost`` and ``toxic_lost`` (removed here,
    with that label) and ``shapley`` (removed by its filter, summed over all orders). Zeros stay. Parts are the values of ``source``; a null and an empty one are the same part. An empty table has no
    parts, so the result is empty. Long, repeated and null texts, null ids and several labels: see :func:`failures`. Other columns of ``docs`` are not read.
    """
    return orders(failures(docs, labels, **settings))
