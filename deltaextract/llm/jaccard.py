"""Similarity join of texts on word shingles, by chosen paths.

Each distinct text is a set of hashed shingles and a sketch of ``TOKENS`` minhash values: each value is a shingle of the set, sampled in a way that all
sets share. A run splits the sets on one sampled token into buckets; a bucket with more than ``SMALL`` sets is split again, on ``BRANCHES`` tokens chosen by a hash
of its path, and so on. Two sets of similarity s meet after one split with chance s. Runs, each with another first token, are repeated until pairs
at the threshold meet with the ``recall`` asked for. Buckets left too large after ``DEPTH`` splits (many near copies) are compared in
blocks, so nothing is dropped. Buckets with the same members are compared once.

Small buckets are brute-forced on sketches, which only links sets that may well be similar. The components of these links are then checked exactly:
their whole shingle sets are intersected, in blocks of bounded size, and what leaves a block is one row per text: its number of links
and a tree of them, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deltaextract.llm.common import checkpointed, each, give_back, plain, slices
from deltaextract.llm.components import components

SHINGLE, THRESHOLD, RECALL = 5, 0.8, 0.9999
TOKENS, SMALL, BRANCHES, DEPTH = 64, 3_000, 3, 3
#: Sketches that agree in this share of places are checked: 4 standard deviations below the threshold.
LOOSE = THRESHOLD - 4 * math.sqrt(THRESHOLD * (1 - THRESHOLD) / TOKENS)
#: Shingles in one block of an exact check, and in one task's group of blocks.
BLOCK_SHINGLES, BLOCK_TEXTS, TASK_SHINGLES = 1_500_000, 1_000, 3_000_000
TASK_SKETCHES = 20_000

_ODD = np.random.default_rng(20_240_501).integers(2**29, 2**31, TOKENS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_STEPS = np.random.default_rng(7).integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class _Shingler:
    """Hashed shingles of texts; hashes of words are kept from text to text."""

    def __init__(self, size: int):
        self._size = size
        self._known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = plain(text).split()
        if not words:
            return np.empty(0, np.uint64)
        known = self._known
        if len(known) > 150_000:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        codes = np.array([known[w] for w in words], np.uint64)
        size = min(self._size, len(codes))
        total = np.zeros(len(codes) - size + 1, np.uint64)
        for k in range(size):
            total += codes[k : len(codes) - size + 1 + k] * _STEPS[k]
        return np.unique(_mixed(total + np.uint64(size)))


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """One row of ``TOKENS`` values (unsigned 32-bit) per set, none of which is empty."""
    out = np.empty((len(sets), TOKENS), np.uint32)
    first = 0
    while first < len(sets):  # some sets at a time, so that they stay in the processor's cache
        last, held = first, 0
        while last < len(sets) and (last == first or held + len(sets[last]) <= 30_000):
            held += len(sets[last])
            last += 1
        values = (np.concatenate(sets[first:last]) >> np.uint64(32)).astype(np.uint32)
        starts = np.cumsum([0, *map(len, sets[first : last - 1])])
        mixed = np.empty_like(values)
        for t in range(TOKENS):
            np.multiply(values, _ODD[t], out=mixed)
            out[first:last, t] = np.minimum.reduceat(mixed, starts)
        first = last
    return out


def _sketched(texts: DataFrame, size: int) -> DataFrame:
    """Key, number of shingles and sketch of each row with words."""

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = _Shingler(size)

        def rows(b: pd.DataFrame) -> Iterator[pd.DataFrame]:
            done = 0
            for part in slices(b["text"]):
                sets = [shingles(x) for x in part]
                keys = b["key"].iloc[done : done + len(part)]
                done += len(part)
                full = [len(s) > 0 for s in sets]
                sets = [s for s in sets if len(s)]
                if sets:
                    yield pd.DataFrame({"key": keys[full].to_numpy(), "shingles": list(map(len, sets)), "sketch": [r.tobytes() for r in sketches(sets)]})

        return each(batches, rows)

    return texts.mapInPandas(sketch, "key binary, shingles int, sketch binary")


def _split(buckets: DataFrame, branches: int) -> DataFrame:
    """Rows (path, key, sketch) on sampled tokens: one bucket for each chosen token and its value."""
    chosen = buckets.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(branches - 1))))
    place = F.pmod(F.xxhash64("path", "k"), F.lit(TOKENS)).cast("int")
    return chosen.select(F.xxhash64("path", "k", F.expr("sketch").substr(place * 4 + 1, F.lit(4))).alias("path"), "key")


def _shared(rows: DataFrame) -> DataFrame:
    """Rows whose bucket has others, with its size ``n``."""
    sizes = rows.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return checkpointed(rows.join(sizes, "path"))


def _runs(threshold: float, recall: float) -> int:
    met = threshold * (1 - (1 - threshold) ** BRANCHES) ** (DEPTH - 1)
    return min(TOKENS, math.ceil(math.log(1 - recall) / math.log(1 - met)))


def _leaves(sketched: DataFrame, runs: int) -> DataFrame:
    """Buckets to compare: path, blocks ``i`` and ``j`` of it, key, own block."""
    first = sketched.withColumn("run", F.explode(F.sequence(F.lit(0), F.lit(runs - 1))))
    rows = _shared(first.select(F.xxhash64("run", F.expr("sketch").substr(F.col("run") * 4 + 1, F.lit(4))).alias("path"), "key"))
    found = [rows.where(F.col("n") <= SMALL)]
    large = rows.where(F.col("n") > SMALL)
    for _ in range(DEPTH - 1):
        if large.isEmpty():
            break
        rows = _shared(_split(large.join(sketched.select("key", "sketch"), "key"), BRANCHES))
        found.append(rows.where(F.col("n") <= SMALL))
        large = rows.where(F.col("n") > SMALL)
    leaves = found[0]
    for more in [*found[1:], large]:
        leaves = leaves.union(more)
    # The same members come together in several runs: one bucket of each is enough.
    member = F.xxhash64("key", F.lit(1)), F.xxhash64("key", F.lit(2))
    made = leaves.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(member[0]).alias("x"), F.bit_xor(member[1]).alias("y"))
    kept = made.groupBy("n", "x", "y").agg(F.min("path").alias("path")).select("path")
    return _in_blocks(leaves.join(kept, "path", "left_semi"), "path", F.ceil(F.col("n") / SMALL))


def _in_blocks(rows: DataFrame, group: str, blocks) -> DataFrame:
    """Each row once for every pair (i, j) of blocks, i <= j, that its own block is part of."""
    own = rows.withColumn("blocks", blocks.cast("int")).withColumn("own", F.pmod(F.xxhash64("key", F.lit(3)), F.col("blocks")).cast("int"))
    other = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return other.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).drop("other", "blocks")


class _Forest:
    def __init__(self, n: int):
        self._up = list(range(n))

    def root(self, i: int) -> int:
        while self._up[i] != i:
            self._up[i] = self._up[self._up[i]]
            i = self._up[i]
        return i

    def join_rows(self, linked: np.ndarray) -> None:
        """``linked``: a symmetric matrix of truth values."""
        seen = np.zeros(len(linked), bool)
        for start in range(len(linked)):
            if seen[start]:
                continue
            seen[start], edge = True, [start]
            while edge:
                new = linked[edge].any(axis=0) & ~seen
                seen |= new
                edge = np.flatnonzero(new).tolist()
                for v in edge:
                    self._up[v] = start


def _agree(sketch: np.ndarray, loose: float) -> np.ndarray:
    same = np.zeros((len(sketch), len(sketch)), np.uint8)
    for values in sketch.T:
        same += values[:, None] == values[None]
    return same >= loose * TOKENS


def _loose_links(leaves: DataFrame, sketched: DataFrame, loose: float) -> DataFrame:
    tasks = max(1, math.ceil(leaves.count() / TASK_SKETCHES))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        group = group.sort_values(["path", "i", "j"], kind="stable")
        names = group[["path", "i", "j"]].to_numpy()
        cuts = [0, *(np.flatnonzero((names[1:] != names[:-1]).any(axis=1)) + 1).tolist(), len(group)] if len(group) else [0]
        keys = group["key"].tolist()
        values = np.frombuffer(b"".join(group["sketch"]), np.uint32).reshape(-1, TOKENS)
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b - a == 2:
                if (values[a] == values[a + 1]).sum() >= loose * TOKENS:
                    out.append((keys[a + 1], keys[a]))
                continue
            forest = _Forest(b - a)
            forest.join_rows(_agree(values[a:b], loose))
            out += [(keys[a + v], keys[a + r]) for v in range(b - a) if (r := forest.root(v)) != v]
        give_back()
        return pd.DataFrame(out, columns=["a", "b"])

    packed = leaves.join(sketched.select("key", "sketch"), "key").select(F.pmod(F.xxhash64("path", "i", "j"), F.lit(tasks)).alias("task"), "path", "i", "j", "key", "sketch")
    return packed.groupBy("task").applyInPandas(compare, "a binary, b binary").distinct()


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the pairwise intersections of sorted sets."""
    n = len(sets)
    out = np.zeros((n, n), np.float32)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    held = np.diff(np.append(first, len(values)))
    number = np.repeat(np.cumsum(held > 1) - 1, held)
    several = np.repeat(held > 1, held)  # a shingle of one text alone is in no intersection
    owner, number = owner[several], number[several]
    width = max(1, min(8192, 16_000_000 // n))
    for a in range(0, int(number[-1]) + 1 if len(number) else 0, width):
        lo, hi = np.searchsorted(number, [a, a + width])
        present = np.zeros((n, min(width, int(number[-1]) + 1 - a)), np.float32)
        present[owner[lo:hi], number[lo:hi] - a] = 1
        out += present @ present.T
        del present  # before the next one is made
    return out


def _exact_links(members: DataFrame, size: int, threshold: float) -> DataFrame:
    """``members``: root, i, j, own, key, text, shingles. Rows key, root of its tree, links: for each block pair a text has links in."""
    weight = members.agg(F.sum("shingles")).first()[0] or 0
    tasks = max(1, math.ceil(weight / TASK_SHINGLES))

    def shingle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = _Shingler(size)
        return each(batches, lambda b: iter([b.drop(columns="text").assign(set=[shingles(x).tobytes() for x in b["text"]])]))

    def block(rows: pd.DataFrame, between: bool) -> list[tuple[bytes, bytes, int]]:
        keys, own = rows["key"].tolist(), rows["own"].to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in rows["set"]]
        both = _intersections(sets)
        sizes = np.array([len(s) for s in sets], np.float32)
        linked = both >= threshold * (sizes[:, None] + sizes[None] - both) - 1e-6
        np.fill_diagonal(linked, False)
        if between:
            linked &= own[:, None] != own[None]
        forest = _Forest(len(keys))
        forest.join_rows(linked)
        degree = linked.sum(axis=1)
        return [(keys[v], keys[forest.root(v)], int(degree[v])) for v in np.flatnonzero(degree)]

    def check(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, i, j), rows in group.groupby(["root", "i", "j"], sort=False):
            out += block(rows, i != j)
        give_back()
        return pd.DataFrame(out, columns=["key", "tree", "links"])

    packed = members.withColumn("task", F.pmod(F.xxhash64("root", "i", "j"), F.lit(tasks))).drop("shingles", "n")
    kinds = "task long, root binary, i int, j int, own int, key binary, set binary"
    return packed.select("task", "root", "i", "j", "own", "key", "text").mapInPandas(shingle, kinds).groupBy("task").applyInPandas(check, "key binary, tree binary, links long")


def similar_texts(docs: DataFrame, *, text: str = "text", size: int = SHINGLE, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """Distinct non-null texts that have links: ``key`` (MD5 of the text), ``root`` (key of its class), ``links`` (number of *different* similar texts)."""
    value = F.col(f"`{text}`")
    keyed = docs.where(value.isNotNull()).select(F.unhex(F.md5(value)).alias("key"), value.alias("text"))
    sketched = checkpointed(_sketched(keyed, size).dropDuplicates(["key"]))
    loose = threshold - 4 * math.sqrt(threshold * (1 - threshold) / TOKENS)
    found = checkpointed(_loose_links(_leaves(sketched, _runs(threshold, recall)), sketched, loose))
    parts = components(found).join(sketched.select(F.col("key").alias("node"), "shingles"), "node").select(F.col("node").alias("key"), "root", "shingles")
    totals = parts.groupBy("root").agg(F.sum("shingles").alias("s"), F.count(F.lit(1)).alias("c"))
    blocks = F.ceil(F.greatest(F.col("s") / BLOCK_SHINGLES, F.col("c") / BLOCK_TEXTS))
    dealt = checkpointed(_in_blocks(parts.join(totals, "root"), "root", blocks).select("root", "i", "j", "own", "key", "shingles"))
    texts = keyed.join(dealt.select("key").distinct(), "key", "left_semi").dropDuplicates(["key"])
    links = checkpointed(_exact_links(dealt.join(texts, "key"), size, threshold))
    roots = components(links.select(F.col("key").alias("a"), F.col("tree").alias("b")))
    counts = links.groupBy("key").agg(F.sum("links").alias("links"))
    return counts.join(roots.select(F.col("node").alias("key"), "root"), "key").select("key", "root", "links")


def _text_classes(docs: DataFrame, doc_id: str, text: str, settings: dict) -> DataFrame:
    """One row per distinct non-null text: ``key``, ``least`` id, ``n_copies``, ``root`` (key that names its class), ``links``."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.unhex(F.md5(F.col(f"`{text}`"))).alias("key"))
    texts = rows.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("least"), (F.count(F.lit(1)) - 1).alias("n_copies"))
    similar = checkpointed(similar_texts(docs, text=text, **settings))
    return texts.join(similar, "key", "left").withColumn("root", F.coalesce("root", "key"))


def classes(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **settings: float) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``class_id``, ``n_links``, ``n_copies``.

    ``class_id`` is the least id of the class: texts linked by similarities of at least ``threshold``, directly or through others, and all copies of these
    texts. ``n_links`` counts the different texts that are similar to the row's own, ``n_copies`` the other rows with the same text. A text of fewer
    words than a shingle is one shingle; a text without words is similar to nothing but its copies. A null text is in a
    class of its own. Ids may repeat or be null; a class without any id has a null ``class_id``.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.unhex(F.md5(F.col(f"`{text}`"))).alias("key"))
    named = _text_classes(docs, doc_id, text, settings)
    least = named.groupBy("root").agg(F.min("least").alias("class_id"))
    by_text = named.join(least, "root").select("key", "class_id", F.coalesce("links", F.lit(0)).alias("n_links"), "n_copies")
    return rows.join(by_text, "key", "left").select(
        "doc_id",
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("n_copies", F.lit(0)).alias("n_copies"),
    )


def keep_one(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **settings: float) -> DataFrame:
    """One row of each class of ``docs``, with the columns of ``docs``; rows without a text all stay.

    The row with the least id stays (a null id comes last); among different texts of one id, that with the smaller hash; of rows alike in
    id and text, any one. Ids may repeat or be null: classes are told apart by their texts.
    """
    first = F.min(F.struct(F.col("least").isNull(), "least", "key"))
    chosen = _text_classes(docs, doc_id, text, settings).groupBy("root").agg(first.alias("first")).select(F.col("first.key").alias("_key"), F.col("first.least").alias("_least"))
    keyed = docs.where(F.col(f"`{text}`").isNotNull()).select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{doc_id}`").alias("_id"), F.unhex(F.md5(F.col(f"`{text}`"))).alias("_own"))
    # Joined on text and id together: the copies of one text, however many, are spread by their ids.
    one = keyed.join(chosen, (F.col("_own") == F.col("_key")) & F.col("_id").eqNullSafe(F.col("_least"))).dropDuplicates(["_key"]).select("_row.*")
    return one.union(docs.where(F.col(f"`{text}`").isNull()))
