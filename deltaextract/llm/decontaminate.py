"""Benchmark decontamination with one Aho-Corasick automaton.

Benchmark questions and answers are lower-cased (A-Z) and cut into words, and every run of ``window`` words (or the whole item, if shorter) is a pattern.
Each distinct benchmark word gets a letter of its own, so that a pattern is a string of ``window`` letters, and a document becomes a
string with one letter for each word (a blank for words that no item has). The automaton reads that string once. The place of a
letter is the number of its word, which maps back to bytes of the original text.

The automaton is a broadcast: benchmarks of up to ``BLOCK_WORDS`` words are one automaton. A larger benchmark is cut into
blocks of that size, and all documents are read against one block after another.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from deltaextract.llm.common import each, plain

WINDOW = 13
#: Words of benchmark text in one automaton: about 100 bytes each in every Python worker.
BLOCK_WORDS = 1_000_000
#: Contaminated: at least one word in this many is hit.
SHARE = 20
HITS = "n_words long, spans array<struct<first:int,last:int>>, items array<string>"

_PLACES = re.compile(rb"[^ ]+")


def words_of(text: str | None) -> list[bytes]:
    return plain(text).split()


def word_places(text: str) -> list[tuple[int, int]]:
    """First and last byte (exclusive) of each word in the UTF-8 of ``text``."""
    return [m.span() for m in _PLACES.finditer(plain(text))]


class Automaton:
    """Windows of the given (item, text) rows."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        self._letters: dict[bytes, str] = {}
        found: dict[str, set[str]] = {}
        for item, text in items:
            coded = "".join([self._letter(w) for w in words_of(text)])
            for i in range(max(len(coded) - window, 0) + 1 if coded else 0):
                found.setdefault(coded[i : i + window], set()).add(item)
        self._automaton = ahocorasick.Automaton()
        for pattern, owners in found.items():
            self._automaton.add_word(pattern, (len(pattern), tuple(sorted(owners))))
        self._any = bool(found)
        if self._any:
            self._automaton.make_automaton()

    def _letter(self, word: bytes) -> str:
        # One code point for each word, from U+0100 on and around the surrogates; BLOCK_WORDS of them fit.
        known = self._letters.get(word)
        if known is None:
            code = 0x100 + len(self._letters)
            known = self._letters[word] = chr(code if code < 0xD800 else code + 0x800)
        return known

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, spans of hit words (first and last, inclusive, merged), items with a window in the text."""
        words = words_of(text)
        if not self._any or not words:
            return len(words), [], set()
        letter = self._letters.get
        coded = "".join([letter(w, " ") for w in words])
        ranges, items = [], set()
        for end, (length, owners) in self._automaton.iter(coded):
            ranges.append((end - length + 1, end))
            items.update(owners)
        return len(words), merged(ranges), items


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(ranges):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def _blocks(rows: Iterator[Row], block_words: int) -> Iterator[list[tuple[str, str | None]]]:
    block, held = [], 0
    for row in rows:
        n = len(words_of(row["text"]))
        if block and held + n > block_words:
            yield block
            block, held = [], 0
        block.append((row["item"], row["text"]))
        held += n
    if block:
        yield block


def scan_column(items: list[tuple[str, str | None]], text: Column, window: int) -> Column:
    """Struct of ``n_words``, hit ``spans`` and ``items`` for one block of benchmark items."""

    @F.pandas_udf(HITS)
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = Automaton(items, window)

        def scanned(texts: pd.Series) -> Iterator[pd.DataFrame]:
            rows = [automaton.scan(x) for x in texts]
            yield pd.DataFrame({"n_words": [r[0] for r in rows], "spans": [[{"first": a, "last": b} for a, b in r[1]] for r in rows], "items": [sorted(r[2]) for r in rows]})

        return each(batches, scanned)

    return apply.asNondeterministic()(text)


def find_contamination(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item: str = "item_id", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per row of ``docs``: struct ``row`` with its columns, and struct ``found`` (n_words, n_hit, spans, items).

    ``spans`` are word numbers, first and last, merged; :func:`word_places` maps them to bytes. ``items`` are ids as text, sorted;
    a null id is left out, though its words count as hit. Null and empty texts have no words and no hits. Repeated items
    and repeated rows change nothing. The benchmark is read block by block through the driver, never as a whole.
    """
    bench = benchmark.select(F.col(f"`{item}`").cast("string").alias("item"), F.col("`text`").alias("text")).where("text is not null")
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    parts = []
    for k, block in enumerate(_blocks(bench.toLocalIterator(), block_words)):
        out = out.withColumn(f"part{k}", scan_column([(i if i is not None else "", t) for i, t in block], F.col(f"row.`{text}`"), window))
        parts.append(f"part{k}")
    if not parts:
        out, parts = out.withColumn("part0", scan_column([], F.col(f"row.`{text}`"), window)), ["part0"]
    spans = F.flatten(F.array(*[F.col(f"{p}.spans") for p in parts])) if len(parts) > 1 else F.col("part0.spans")
    items = F.array_sort(F.array_remove(F.array_distinct(F.flatten(F.array(*[F.col(f"{p}.items") for p in parts]))), ""))
    if len(parts) > 1:
        # Spans of several blocks may overlap: joined in order of their first word.
        spans = F.aggregate(
            F.array_sort(spans),
            F.expr("cast(array() as array<struct<first:int,last:int>>)"),
            lambda acc, s: F.when(
                (F.size(acc) > 0) & (s["first"] <= F.element_at(acc, -1)["last"] + 1),
                F.concat(
                    F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))),
                    F.array(F.struct(F.element_at(acc, -1)["first"].alias("first"), F.greatest(F.element_at(acc, -1)["last"], s["last"]).alias("last"))),
                ),
            ).otherwise(F.concat(acc, F.array(s))),
        )
    out = out.select("row", F.col("part0.n_words").alias("n_words"), spans.alias("spans"), items.alias("items"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["last"] - s["first"] + 1)
    return out.select("row", F.struct("n_words", n_hit.alias("n_hit"), "spans", "items").alias("found"))


def is_contaminated(found: str = "found", share: int = SHARE) -> Column:
    return (F.col(f"{found}.n_hit") > 0) & (share * F.col(f"{found}.n_hit") >= F.col(f"{found}.n_words"))


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item: str = "item_id", window: int = WINDOW, share: int = SHARE) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with the columns of ``docs``."""
    return find_contamination(docs, benchmark, text=text, item=item, window=window).where(~is_contaminated(share=share)).select("row.*")
