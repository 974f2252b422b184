"""Language-model scores from a bigram trie in shards.

Texts are dealt to batches. A batch finds its distinct words and pairs of neighbouring words, and sends them, with their counts in
training texts, to the shards their hashes name; a context's successors are spread over ``SPREAD`` shards, so that a word that makes up a third of all
text is no shard's burden. A shard adds up the counts, builds an Elias-Fano trie (contexts, pointers, successors relative to their
context, quantised counts), looks up what each batch has asked, and answers in the order of the question. The batch then has all it
needs to score its texts. Nothing is collected, and no executor holds the whole model.

The model: Dirichlet smoothing towards the base distribution, p(w | v) = (c(v w) + M base(w)) / (c(v) + M), with M = ``PRIOR``, so a context never
seen leaves base(w). Counts c(v w) are quantised (exact up to 32,767, then within 0.03 %). c(v) and base(w) belong to words of other shards, so the
shards keep the counts quantised and the batch, which has all three, completes the probabilities.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deltaextract.llm.common import fold_of
from deltaextract.llm.eliasfano import SUCCESSOR_BITS, NgramTrie, dequantised

#: Bytes of text in one batch and behind one shard: what a Python worker holds at a time.
BATCH_BYTES, SHARD_BYTES = 12_000_000, 24_000_000
SPREAD = 16
#: Occurrences that the base distribution is worth in every context.
PRIOR = 16.0
SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

# Words never hold white space, and are never empty: these two stand for the end of a text and for what is before its first word.
_END, _START = b"", b" "
_LOW = np.uint64((1 << SUCCESSOR_BITS) - 1)


def _packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.astype("<u4").tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "<u4").astype(np.int64)


class _Batch:
    """Words and pairs of some texts, numbered by their hashes, so that the order of the texts does not matter."""

    def __init__(self, texts: list[str | None], train: np.ndarray, shards: int):
        number = {_END: 0, _START: 1}
        flat: list[np.ndarray] = []
        for text in texts:
            words = (text or "").encode("utf-8", "replace").lower().split()
            for w in words:
                if w not in number:
                    number[w] = len(number)
            flat.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, number), np.uint64, len(number))
        order = np.argsort(hashes)
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        self.hashes = hashes[order]
        self.end, self.start = int(rank[0]), int(rank[1])
        lengths = np.array([len(x) + 1 for x in flat], np.int64)
        self.bounds = np.concatenate([[0], np.cumsum(lengths)])
        self.tokens = np.full(int(self.bounds[-1]), self.end)
        before = np.full(int(self.bounds[-1]), self.start)
        for a, words in zip(self.bounds.tolist(), flat, strict=False):
            self.tokens[a : a + len(words)] = rank[words]
            before[a + 1 : a + len(words) + 1] = self.tokens[a : a + len(words)]
        trained = np.repeat(train, lengths)
        n = len(self.hashes)
        self.counts = np.bincount(self.tokens[trained], minlength=n)
        pairs, self.pair_of = np.unique(before * n + self.tokens, return_inverse=True)
        self.pair_counts = np.bincount(self.pair_of[trained], minlength=len(pairs))
        self.first, self.second = pairs // n, pairs % n
        modulus = np.uint64(shards)
        own = self.hashes % modulus
        spread = (self.hashes >> np.uint64(60)) * np.uint64(-(-shards // SPREAD)) if shards > 1 else np.zeros(n, np.uint64)
        shard = ((own[self.first] + spread[self.second]) % modulus).astype(np.uint32)
        self.pair_order = np.argsort(shard, kind="stable")
        self.pair_cuts = np.searchsorted(shard[self.pair_order], np.arange(shards + 1))
        own = own.astype(np.uint32)
        self.word_order = np.argsort(own, kind="stable")
        self.word_cuts = np.searchsorted(own[self.word_order], np.arange(shards + 1))

    def asked(self, shard: int) -> dict[str, bytes] | None:
        words = self.word_order[self.word_cuts[shard] : self.word_cuts[shard + 1]]
        pairs = self.pair_order[self.pair_cuts[shard] : self.pair_cuts[shard + 1]]
        first = self.first[pairs]
        cuts = np.flatnonzero(np.append(True, first[1:] != first[:-1])) if len(first) else np.empty(0, np.int64)
        successors = (self.hashes[self.second[pairs]] & _LOW).astype("<u8").view(np.uint8).reshape(-1, 8)[:, : SUCCESSOR_BITS // 8]
        return {
            "words": self.hashes[words].tobytes(),
            "counts": _packed(self.counts[words]),
            "contexts": self.hashes[first[cuts]].tobytes(),
            "degrees": _packed(np.diff(np.append(cuts, len(first)))),
            "successors": successors.tobytes(),
            "pair_counts": _packed(self.pair_counts[pairs]),
        }


_ASKED = "shard int, batch long, words binary, counts binary, contexts binary, degrees binary, successors binary, pair_counts binary"
_ANSWER = "batch long, shard int, counts binary, codes binary, n long, v long"


def _successors(data: bytes) -> np.ndarray:
    width = SUCCESSOR_BITS // 8
    wide = np.zeros((len(data) // width, 8), np.uint8)
    wide[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return wide.view("<u8").ravel()


def _merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and their sums."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _trie_of(rows: pd.DataFrame) -> NgramTrie:
    contexts, keys, counts = [], [], []
    for r in rows.itertuples():
        degrees, c = _unpacked(r.degrees), _unpacked(r.pair_counts)
        seen = c > 0
        contexts.append(np.repeat(np.frombuffer(r.contexts, np.uint64), degrees)[seen])
        keys.append(_successors(r.successors)[seen])
        counts.append(c[seen])
    joined = np.concatenate(contexts)
    known = np.unique(joined)
    if len(known) >= 1 << (64 - SUCCESSOR_BITS):
        raise ValueError("too many contexts in a shard: lower SHARD_BYTES")
    merged, sums = _merged(np.searchsorted(known, joined).astype(np.uint64) << np.uint64(SUCCESSOR_BITS) | np.concatenate(keys), np.concatenate(counts))
    return NgramTrie.from_buffer(NgramTrie.build(known, merged, sums).to_bytes())


def _answer(rows: pd.DataFrame) -> pd.DataFrame:
    words = [np.frombuffer(x, np.uint64) for x in rows["words"]]
    known, sums = _merged(np.concatenate(words), np.concatenate([_unpacked(x) for x in rows["counts"]]))
    trie = _trie_of(rows)
    out = []
    for asked, r in zip(words, rows.itertuples(), strict=True):
        _, codes = trie.lookup(np.frombuffer(r.contexts, np.uint64), _unpacked(r.degrees), _successors(r.successors))
        totals = int(sums.sum()), int((sums > 0).sum())
        out.append((r.batch, r.shard, _packed(sums[np.searchsorted(known, asked)]), zstandard.ZstdCompressor(level=1).compress(codes.tobytes()), *totals))
    return pd.DataFrame(out, columns=["batch", "shard", "counts", "codes", "n", "v"])


def _score(docs: pd.DataFrame, answers: pd.DataFrame, shards: int) -> pd.DataFrame:
    if not len(docs):
        return pd.DataFrame(columns=[c.split()[0] for c in SCORED.split(", ")])
    train = docs["train"].to_numpy(bool)
    batch = _Batch(docs["text"].tolist(), train, shards)
    counts = np.zeros(len(batch.hashes))
    codes = np.zeros(len(batch.first), np.uint16)
    for r in answers.itertuples():
        counts[batch.word_order[batch.word_cuts[r.shard] : batch.word_cuts[r.shard + 1]]] = _unpacked(r.counts)
        codes[batch.pair_order[batch.pair_cuts[r.shard] : batch.pair_cuts[r.shard + 1]]] = np.frombuffer(zstandard.ZstdDecompressor().decompress(r.codes), np.uint16)
    n, v = int(answers["n"].sum()), int(answers["v"].sum())
    base = (counts + 0.1) / (n + 0.1 * (v + 1))
    # Before a first word stands one start for each training text, as many as there are ends.
    own = counts.copy()
    own[batch.start] = counts[batch.end]
    p = (dequantised(codes) + PRIOR * base[batch.second]) / (own[batch.first] + PRIOR)
    p = np.minimum(p, 1.0)
    starts = batch.bounds[:-1]
    return pd.DataFrame(
        {
            "doc_id": docs["doc_id"],
            "held_out": ~train,
            "n_tokens": np.diff(batch.bounds),
            "n_known": np.add.reduceat((counts > 0).astype(np.int64)[batch.tokens], starts),
            "train_tokens": n,
            "base_score": np.add.reduceat(np.log10(base)[batch.tokens], starts),
            "score": np.add.reduceat(np.log10(p)[batch.pair_of], starts),
        }
    )


def _dealt(docs: DataFrame, doc_id: str, text: str, folds: int) -> tuple[DataFrame, int]:
    total = docs.agg(F.sum(F.octet_length(f"`{text}`")).alias("b"), F.count(F.lit(1)).alias("n")).first()
    size = (total["b"] or 0) + 64 * total["n"]
    batches, shards = max(1, math.ceil(size / BATCH_BYTES)), max(1, math.ceil(size / SHARD_BYTES))
    i, t = F.col(f"`{doc_id}`"), F.col(f"`{text}`")
    rows = docs.select(F.pmod(F.xxhash64(i, t), F.lit(batches)).alias("batch"), i.cast("long").alias("doc_id"), t.alias("text"), (fold_of(i, folds) != 0).alias("train"))
    return rows, shards


def _questions(rows: DataFrame, shards: int) -> DataFrame:
    def ask(docs: pd.DataFrame) -> pd.DataFrame:
        batch = _Batch(docs["text"].tolist(), docs["train"].to_numpy(bool), shards)
        asked = [{"shard": s, "batch": docs["batch"].iloc[0]} | batch.asked(s) for s in range(shards)]
        return pd.DataFrame(asked, columns=[c.split()[0] for c in _ASKED.split(", ")])

    return rows.groupBy("batch").applyInPandas(ask, _ASKED)


def score_documents(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", folds: int = 10) -> DataFrame:
    """One row per row of ``docs`` with its log10 probabilities under the base distribution and the model, learned from all folds but the first.

    A null text is the empty one: its one token is the end. Repeated rows count, and are scored, as often as they stand there. An empty table gives no rows;
    without training rows every token has the base probability of an unknown one.
    """
    rows, shards = _dealt(docs, doc_id, text, folds)
    answers = _questions(rows, shards).groupBy("shard").applyInPandas(_answer, _ANSWER)

    def complete(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        return _score(docs, answers, shards)

    return rows.groupBy("batch").cogroup(answers.groupBy("batch")).applyInPandas(complete, SCORED)


def model(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", folds: int = 10) -> DataFrame:
    """The shards of the trie (``shard``, ``trie``: bytes for :meth:`NgramTrie.from_buffer`, or a file to be mapped)."""
    rows, shards = _dealt(docs, doc_id, text, folds)

    def built(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        return pd.DataFrame({"shard": [rows["shard"].iloc[0]], "trie": [_trie_of(rows).to_bytes()]})

    return _questions(rows, shards).groupBy("shard").applyInPandas(built, "shard int, trie binary")
