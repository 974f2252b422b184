"""Byte-level BPE: ranked merges of the bytes of words, for every document in the task that reads it.

Texts are cut by the pattern into words. A word starts as its bytes; the two neighbours whose bytes together have the lowest rank are merged, leftmost first, until none have
one. A heap holds the neighbours that have a rank, so that a word of any length takes time in proportion to its length and the logarithm of it. The codes of words of up to
``CACHE_CHARS`` characters are kept while a worker lives, ``CACHE_WORDS`` of them; beyond that they start anew, so a worker's memory does not grow with the corpus. Nothing is shuffled.

Letters, digits and white space are what the installed tokenizer library takes for them, asked once by the driver: the workers' regular expressions
come with tables of another Unicode version.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deltaextract.llm.blocks import cached
from deltaextract.llm.common import SLICE_CHARS, slices

CACHE_WORDS, CACHE_CHARS = 250_000, 64


def read_ranks(path: str) -> dict[bytes, int]:
    """Bytes and ranks of a file of ranks: base64 and number per line."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    lacking = [b for b in range(256) if bytes([b]) not in ranks]
    if lacking:
        raise ValueError(f"no rank for bytes {lacking}")
    return ranks


def _ranges(chars: str) -> str:
    """A character class, without brackets, of the given characters."""
    points = np.unique(np.frombuffer(chars.encode("utf-32-le"), "<u4"))
    cuts = np.flatnonzero(np.diff(points) > 1)
    starts, ends = points[np.append(0, cuts + 1)], points[np.append(cuts, len(points) - 1)]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(starts.tolist(), ends.tolist(), strict=True))


@cached
def patterns(pattern: str) -> tuple[str, str, str]:
    r"""``pattern``; the same with ``\p{L} \p{N} \s \S`` written out as the tokenizer library knows them; and a class of the characters on which the workers' regular expressions differ from it."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    letters = {bytes([b]): b for b in range(256)}
    differ: set[str] = set()

    def known(kind: str) -> str:
        library = tiktoken.Encoding("class", pat_str=kind, mergeable_ranks=letters, special_tokens={})
        chars = library.decode(library.encode_ordinary(every))
        differ.update(set(chars) ^ set(regex.findall(kind, every)))
        return _ranges(chars)

    letter, digit, space = known(r"\p{L}"), known(r"\p{N}"), known(r"\s")

    def inside(group: re.Match) -> str:
        return group[0].replace(r"\p{L}", letter).replace(r"\p{N}", digit).replace(r"\s", space)

    out = re.sub(r"\[[^\]]*\]", inside, pattern)
    for kind, chars in ((r"\p{L}", f"[{letter}]"), (r"\p{N}", f"[{digit}]"), (r"\s", f"[{space}]"), (r"\S", f"[^{space}]")):
        out = out.replace(kind, chars)
    return pattern, out, f"[{_ranges(''.join(differ))}]" if differ else "(?!)"


@cached
def splitter(pattern: str, plain: str, differ: str) -> Callable[[str], list[str]]:
    """Words of a text, as the tokenizer library cuts them. From :func:`patterns`."""
    usual, exact, odd = regex.compile(pattern).findall, re.compile(plain).findall, re.compile(differ).search
    far = re.compile(differ[:11] + r"-\U0010ffff]").search  # from the first character of the class on; quick
    return lambda text: exact(text) if far(text) and odd(text) else usual(text)


def merged(ranks: dict[bytes, int], word: bytes) -> list[int]:
    """The ids of a word after all merges."""
    if word in ranks:
        return [ranks[word]]
    parts: list[bytes] = [word[i : i + 1] for i in range(len(word))]  # b"" where a part has gone into the one before it
    after, before = list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
    found = [(ranks.get(word[i : i + 2]), i) for i in range(len(word) - 1)]
    heap = [x for x in found if x[0] is not None]
    heapify(heap)
    while heap:
        rank, at = heappop(heap)
        beside = after[at]
        if not parts[at] or beside == len(parts):
            continue
        both = parts[at] + parts[beside]
        if ranks.get(both) != rank:  # one of the two has been merged meanwhile
            continue
        parts[at], parts[beside] = both, b""
        beside = after[at] = after[beside]
        if beside < len(parts):
            before[beside] = at
            rank = ranks.get(both + parts[beside])
            if rank is not None:
                heappush(heap, (rank, at))
        if at:
            left = before[at]
            rank = ranks.get(parts[left] + both)
            if rank is not None:
                heappush(heap, (rank, left))
    return [ranks[x] for x in parts if x]


class Encoder:
    """Ids of texts, with the codes of words that came before. Sent to workers by a broadcast, so that the codes live as long as a worker has it."""

    def __init__(self, ranks: dict[bytes, int], found: tuple[str, str, str]):
        self.ranks, self.found = ranks, found
        self.codes: dict[str, bytes] = {}

    def __call__(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit integers."""
        codes, out = self.codes, []
        for word in splitter(*self.found)(text or ""):
            code = codes.get(word)
            if code is None:
                code = np.array(merged(self.ranks, word.encode()), "<u4").tobytes()
                if len(word) <= CACHE_CHARS:
                    if len(codes) >= CACHE_WORDS:
                        codes.clear()
                    codes[word] = code
            out.append(code)
        return b"".join(out)


def encode_documents(docs: DataFrame, ranks: dict[bytes, int], pattern: str, *, text: str = "text", ids: str = "ids", chars: int = SLICE_CHARS) -> DataFrame:
    """The columns of ``docs`` but the text, and ``ids``: binary, little-endian unsigned 32-bit integers.

    Each match of ``pattern`` is encoded by itself; what no match covers has no ids. Null and empty texts have no ids. Rows are never
    dropped or merged, so repeated rows give repeated results, and an empty table an empty one. A column of ``docs`` that has the name of the result is replaced by it.
    Results leave a worker after about ``chars`` characters of text.
    """
    encoder = docs.sparkSession.sparkContext.broadcast(Encoder(ranks, patterns(pattern)))

    @F.pandas_udf("binary")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            for part in slices(texts, chars):
                yield pd.Series(list(map(encoder.value, part)), dtype=object)

    # Not deterministic to Spark, so that it is not computed again for each use of its result.
    coded = encode.asNondeterministic()(F.col(f"`{text}`")).alias(ids)
    return docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in (text, ids)], coded)


def decoder(spark: SparkSession, ranks: dict[bytes, int]) -> Callable[[Column], Column]:
    """A function of ids (binary, as :func:`encode_documents` gives them) to the bytes they stand for: their pieces one after another. Null gives null."""
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    pieces = spark.sparkContext.broadcast(table)

    @F.pandas_udf("binary")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        piece = pieces.value.__getitem__
        for ids in batches:
            yield pd.Series([None if x is None else b"".join(map(piece, np.frombuffer(x, "<u4").tolist())) for x in ids], dtype=object)

    return decode


def n_tokens(ids: Column) -> Column:
    return F.shiftright(F.octet_length(ids), 2).cast("long")
