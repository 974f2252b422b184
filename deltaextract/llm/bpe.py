"""BPE encoding and decoding with a pair occurrence index.

The distinct words of a task are laid out one after another as symbols. An index maps each pair that has a rank to all
positions where it stands; a heap holds the ranks that are active. The lowest rank is applied to all its positions, from left to
right, and the positions of the pairs that this makes are added to their lists. Entries of pairs that a merge has broken up stay and are
passed over when they come up. Where a merge makes a pair of *lower* rank, the rest of that word waits until the lower
rank is done, so the order within a word is the usual one: lowest rank first, then leftmost.

Words and their ids are kept while a worker lives, up to ``CACHE_WORDS``; beyond that the cache starts anew.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer
from tokenizers.pre_tokenizers import Split

from deltaextract.llm.common import each, slices

CACHE_WORDS = 120_000
# The word pattern and the word end of the tokenizer files this reads.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"

# Below U+0180 every text is in NFC already, lower-cases character by character, and has the same letters in every version of
# Unicode. All other texts go through the library's normaliser and splitter, whose version decides there.
_SIMPLE = range(0x180)
_BEYOND = re.compile(r"[^\x00-\u017f]")


def _simple_words() -> re.Pattern:
    def listed(kind: str) -> str:
        return "".join(re.escape(chr(c)) for c in _SIMPLE if unicodedata.category(chr(c))[0] == kind)

    return re.compile(WORD_PATTERN.replace(r"[\p{L}]", f"[{listed('L')}]").replace(r"[\p{N}]", f"[{listed('N')}]").replace(r"\p{L}\p{N}", listed("L") + listed("N")).replace(r"\s", r"\t-\r \x85\xa0"))



def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else the next one from U+0100."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(spare)) for b in range(256)]


class PairIndexBpe:
    """Encoder and decoder made from the text of a tokenizer file."""

    def __init__(self, spec: str):
        parsed = json.loads(spec)
        if parsed["model"]["type"] != "BPE" or parsed["model"]["end_of_word_suffix"] != WORD_END or parsed["decoder"] is not None:
            raise ValueError("only BPE files with word ends and without a decoder are supported")
        if parsed["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] != WORD_PATTERN:
            raise ValueError("unknown word pattern")
        vocab = parsed["model"]["vocab"]
        self._normalizer = Tokenizer.from_str(spec).normalizer
        self._splitter = Split(Regex(WORD_PATTERN), "removed", invert=True)
        self._simple = _simple_words().findall
        letters = byte_letters()
        self._plain = np.array([vocab.get(x, -1) for x in letters])
        self._ending = np.array([vocab.get(x + WORD_END, -1) for x in letters])
        merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in parsed["model"]["merges"]]
        self._merges = merges
        self._rank = {a << 32 | b: r for r, (a, b, _) in enumerate(merges)}
        keys = np.array(list(self._rank), dtype=np.int64)
        order = np.argsort(keys)
        self._keys, self._key_ranks = keys[order], np.array(list(self._rank.values()))[order]
        added = {x["content"]: x["id"] for x in parsed["added_tokens"]}
        self._added = {k: np.array([v], "<u4").tobytes() for k, v in added.items()}
        self._split = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self._tokens = {i: t for t, i in (vocab | added).items()}
        self._cache: dict[str, bytes] = {}

    def words(self, text: str | None) -> list[str]:
        """Words in order; special tokens stand for themselves."""
        out = []
        for piece in self._split.split(text) if self._split and "<|" in (text or "") else [text or ""]:
            if piece in self._added:
                out.append(piece)
            elif piece:
                if _BEYOND.search(piece):
                    out += [w for w, _ in self._splitter.pre_tokenize_str(self._normalizer.normalize_str(piece))]
                else:
                    out += self._simple(piece.lower())
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        split = [self.words(x) for x in texts]
        cache = self._cache
        new = set().union(*split).difference(cache)
        if len(cache) + len(new) > CACHE_WORDS:
            cache.clear()
            new = set().union(*split)
        for word in [x for x in self._added if x in new]:
            cache[word] = self._added[word]
            new.discard(word)
        cache.update(self._merged(list(new)))
        return [b"".join([cache[w] for w in words]) for words in split]

    def decode(self, ids: bytes) -> str:
        tokens = self._tokens
        return " ".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])

    def _merged(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        if not words:
            return
        raw = [w.encode() for w in words]
        ends = np.cumsum([len(x) for x in raw])
        octets = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self._plain[octets]
        symbols[ends - 1] = self._ending[octets[ends - 1]]
        number = np.repeat(np.arange(len(words)), np.diff(ends, prepend=0))
        if (symbols < 0).any():  # bytes outside the vocabulary are left out
            kept = symbols >= 0
            symbols, number = symbols[kept], number[kept]
        n = len(symbols)
        if not n:
            yield from ((w, b"") for w in words)
            return
        same = number[1:] == number[:-1]
        pair = symbols[:-1] << 32 | symbols[1:]
        at = np.minimum(np.searchsorted(self._keys, pair), len(self._keys) - 1)
        found = np.flatnonzero(same & (self._keys[at] == pair))
        ranks = self._key_ranks[at[found]]
        order = np.argsort(ranks, kind="stable")
        active, starts = np.unique(ranks[order], return_index=True)
        places = found[order].tolist()
        bounds = [*starts.tolist(), len(places)]
        index = {r: places[a:b] for r, a, b in zip(active.tolist(), bounds, bounds[1:], strict=False)}

        sym, word_of = symbols.tolist(), number.tolist()
        nxt = (np.arange(1, n + 1) * np.append(same, False) - np.append(~same, True)).tolist()  # -1 at a word's end
        prv = (np.arange(-1, n - 1) * np.insert(same, 0, False) - np.insert(~same, 0, True)).tolist()
        rank_of, merges = self._rank.get, self._merges
        heap = list(index)
        heapify(heap)
        while heap:
            rank = heappop(heap)
            positions = index.pop(rank, None)
            if positions is None:
                continue
            a, b, c = merges[rank]
            positions.sort()
            waiting: set[int] = set()
            for p in positions:
                if sym[p] != a:
                    continue
                q = nxt[p]
                if q < 0 or sym[q] != b:
                    continue
                if waiting and word_of[p] in waiting:
                    if rank in index:
                        index[rank].append(p)
                    else:
                        index[rank] = [p]
                        heappush(heap, rank)
                    continue
                sym[p], sym[q] = c, -1
                after = nxt[p] = nxt[q]
                if after >= 0:
                    prv[after] = p
                    r = rank_of(c << 32 | sym[after])
                    if r is not None:
                        if r in index:
                            index[r].append(p)
                        else:
                            index[r] = [p]
                            heappush(heap, r)
                        if r < rank:
                            waiting.add(word_of[p])
                before = prv[p]
                if before >= 0:
                    r = rank_of(sym[before] << 32 | c)
                    if r is not None:
                        if r in index:
                            index[r].append(before)
                        else:
                            index[r] = [before]
                            heappush(heap, r)
                        if r < rank:
                            waiting.add(word_of[p])
        left = np.array(sym)
        kept = left >= 0
        ids = left[kept].astype("<u4").tobytes()
        stops = (np.cumsum(np.bincount(number[kept], minlength=len(words))) * 4).tolist()
        start = 0
        for word, stop in zip(words, stops, strict=True):
            yield word, ids[start:stop]
            start = stop


@lru_cache(maxsize=2)
def _loaded(spec: str) -> PairIndexBpe:
    return PairIndexBpe(spec)


CODED = "ids binary, decoded string"


def bpe_columns(spark: SparkSession, tokenizer_path: str) -> tuple:
    """Functions of a tokenizer file: ``encode(text)`` (binary: little-endian unsigned 32-bit ids), ``decode(ids)`` (string), and ``both(text)`` (struct of the two).

    A null text is encoded like the empty one (no ids). The file is read by the driver; it is a few MB whatever the data. Results leave
    a worker in slices, so that it never holds those of a whole Arrow batch.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        spec = spark.sparkContext.broadcast(file.read())

    @F.pandas_udf("binary")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = _loaded(spec.value)
        return each(batches, lambda texts: (pd.Series(bpe.encode(part), dtype=object) for part in slices(texts)))

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = _loaded(spec.value)
        return each(batches, lambda ids: iter([pd.Series([None if x is None else bpe.decode(x) for x in ids], dtype=object)]))

    @F.pandas_udf(CODED)
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = _loaded(spec.value)

        def coded(texts: pd.Series) -> Iterator[pd.DataFrame]:
            for part in slices(texts):
                ids = bpe.encode(part)
                yield pd.DataFrame({"ids": ids, "decoded": [bpe.decode(x) for x in ids]})

        return each(batches, coded)

    return encode, decode, both


def encode_documents(docs: DataFrame, tokenizer_path: str, *, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``docs`` with a column of token ids and, if named, one with the text they decode to; no shuffle.

    Null and empty texts have no ids and decode to the empty text. Rows are never dropped or merged, so repeated rows give repeated
    results. A column of ``docs`` that has the name of a result is replaced by it; all other columns stay.
    """
    encode, _, both = bpe_columns(docs.sparkSession, tokenizer_path)
    value = F.col(f"`{text}`")
    if decoded is None:
        return docs.withColumn(ids, encode(value))
    # Both at once: one worker per task holds the tables.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in (ids, decoded)]).alias("row")
    coded = docs.select(row, both.asNondeterministic()(value).alias("coded"))
    return coded.select("row.*", F.col("coded.ids").alias(ids), F.col("coded.decoded").alias(decoded))


def n_tokens(ids: Column) -> Column:
    return F.octet_length(ids).cast("long") / F.lit(4)
