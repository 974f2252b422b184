"""Toxicity scores from a weighted lexicon, matched by Aho-Corasick.

Texts are folded first: compatibility forms, case, accents kept, look-alike letters of other scripts to Latin ones, and digits and signs that
stand for letters inside a word to these letters. The lexicon is learned: its entries are words, and beginnings of words, that labelled
toxic documents have far more often than others do; its weights are log odds. Where an entry mostly stands in
harmless documents together with one certain neighbour, the two words become an exception phrase, and the entry does not count inside it.

The weights that a text gathers are divided by a slowly growing function of its length, and a logistic curve turns that
into a score. Everything is fitted on about ``FIT_ROWS`` labelled rows at most, chosen by a hash of their id; scoring covers all rows.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deltaextract.llm.common import checkpointed

#: Letters of a beginning of a word; entries of the lexicon; documents that an entry needs; least log odds of an entry.
STEMS = range(4, 9)
ENTRIES, LEAST_DOCS, LEAST_WEIGHT = 5_000, 5, 3.0
#: Share of the toxic documents that an entry needs too: copies of one document do not make its words toxic.
LEAST_SHARE = 0.01
#: Labelled rows that the fit reads (the bound of its sample), and beginnings and words of toxic ones that are looked up in the others.
FIT_ROWS, CANDIDATES = 20_000, 50_000
#: An exception: so many harmless documents have the phrase, and toxic ones are no more than this share.
EXCEPTION_DOCS, EXCEPTION_SHARE = 5, 0.2
SCORES = "score double, predicted int, matches int"

# Letters of other scripts that look like Latin ones, and digits and signs written for letters.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p",
    "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "х": "x", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}

_FOLD = str.maketrans(LOOK_ALIKES)
_DIGITS = str.maketrans(DIGITS)
# A word: letters and digits; signs only between two letters or digits.
_WORD = re.compile(r"[^\W_]+(?:[@$!]+[^\W_]+)*")
_MIXED = re.compile(r"[0134578@$!]")
_LETTER = re.compile(r"[^\W\d_]")


def fold(text: str | None) -> list[str]:
    """The folded words of a text."""
    lowered = text or ""
    if not lowered.isascii():
        lowered = unicodedata.normalize("NFKC", lowered)
    words = _WORD.findall(lowered.lower().translate(_FOLD))
    return [w.translate(_DIGITS) if _MIXED.search(w) and _LETTER.search(w) else w for w in words]


@dataclass(frozen=True)
class Lexicon:
    """Entries are `` word `` or, for a beginning, `` stem`` (a blank before, none behind). ``curve``: slope and offset of the score."""

    weights: dict[str, float]
    exceptions: frozenset[str]
    curve: tuple[float, float]


class Matcher:
    def __init__(self, weights: dict[str, float], exceptions: frozenset[str]):
        self._exceptions = exceptions
        self._automaton = ahocorasick.Automaton()
        for entry, weight in weights.items():
            self._automaton.add_word(entry, (len(entry), weight))
        if weights:
            self._automaton.make_automaton()
        self._any = bool(weights)

    def matches(self, words: list[str]) -> list[tuple[int, str, float]]:
        """Of each word with an entry: its number, itself, and the greatest weight of its entries; without words in an exception phrase."""
        if not self._any or not words:
            return []
        line = f" {' '.join(words)} "
        best: dict[int, float] = {}
        for end, (length, weight) in self._automaton.iter(line):
            start = end - length + 1
            best[start] = max(best.get(start, weight), weight)
        found, at, seen = [], 0, 0
        for start in sorted(best):
            at += line.count(" ", seen, start)
            seen = start
            if not (self._exceptions and ((at and f"{words[at - 1]} {words[at]}" in self._exceptions) or (at + 1 < len(words) and f"{words[at]} {words[at + 1]}" in self._exceptions))):
                found.append((at, words[at], best[start]))
        return found

    def density(self, words: list[str]) -> tuple[float, int]:
        """Weight of the matches by length, and their number."""
        found = self.matches(words)
        return sum(w for _, _, w in found) / (1 + math.log1p(len(words))), len(found)


def _entries(text: str | None) -> set[str]:
    words = {*fold(text)}
    found = {f" {w} " for w in words}
    for n in STEMS:
        found.update([f" {w[:n]}" for w in words if len(w) >= n])
    return found


def _document_counts(rows: DataFrame, among: frozenset[str] | None = None) -> DataFrame:
    """Number of rows (docs) with each entry; each Arrow batch sends an entry once."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            counts: Counter = Counter()
            for text in b["text"]:
                counts.update(_entries(text) if among is None else _entries(text) & among)
            # With types, since there may be none.
            yield pd.DataFrame({"entry": pd.Series(list(counts), dtype=object), "docs": pd.Series(list(counts.values()), dtype="int64")})

    return rows.select("text").mapInPandas(count, "entry string, docs long").groupBy("entry").agg(F.sum("docs").alias("docs"))


def _labelled(docs: DataFrame, labels: DataFrame, text: str, doc_id: str) -> DataFrame:
    known = labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).join(known, "doc_id").select("doc_id", "text", "toxic")


def fit(docs: DataFrame, labels: DataFrame, *, text: str = "text", doc_id: str = "doc_id", entries: int = ENTRIES, fit_rows: int = FIT_ROWS) -> Lexicon:
    """A lexicon from rows of ``docs`` that ``labels`` (doc_id, toxic) marks 0 or 1. Repeated labels of a document count once, as toxic if any is.

    Without labels of both kinds, the lexicon is empty and every text gets the score that fits the one kind (0.5 without any).
    """
    rows = _labelled(docs, labels, text, doc_id)
    totals = rows.agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n")).first()
    n_toxic, n_all = totals["t"] or 0, totals["n"]
    if not n_toxic or n_toxic == n_all:
        return Lexicon({}, frozenset(), (0.0, 0.0 if not n_all else 30.0 if n_toxic else -30.0))
    share = min(1.0, fit_rows / n_all)
    rows = checkpointed(rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share * 1_000_000))
    toxic, others = rows.where("toxic = 1"), rows.where("toxic = 0")
    counted = _document_counts(toxic).where(F.col("docs") >= max(LEAST_DOCS, LEAST_SHARE * toxic.count())).orderBy(F.desc("docs"), "entry").limit(CANDIDATES).collect()
    in_toxic = {r["entry"]: r["docs"] for r in counted}
    in_others = {r["entry"]: r["docs"] for r in _document_counts(others, frozenset(in_toxic)).collect()}
    by_kind = dict(rows.groupBy("toxic").count().collect())

    def weight(entry: str) -> float:
        return math.log((in_toxic[entry] + 0.5) / (by_kind.get(1, 0) + 1)) - math.log((in_others.get(entry, 0) + 0.5) / (by_kind.get(0, 0) + 1))

    weights = {e: weight(e) for e in in_toxic}
    best = sorted([e for e in weights if weights[e] >= LEAST_WEIGHT], key=lambda e: (-weights[e] * in_toxic[e], e))[:entries]
    weights = _without_longer({e: weights[e] for e in best})
    exceptions = _exceptions(rows, weights)

    def densities(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(weights, exceptions)
        for b in batches:
            yield pd.DataFrame({"x": [matcher.density(fold(t))[0] for t in b["text"]], "toxic": b["toxic"]})

    points = rows.select("text", "toxic").mapInPandas(densities, "x double, toxic int").collect()
    return Lexicon(weights, exceptions, _curve(np.array([p["x"] for p in points]), np.array([p["toxic"] for p in points], float)))


def _without_longer(weights: dict[str, float]) -> dict[str, float]:
    """Entries that no shorter one covers just as well."""
    kept: dict[str, float] = {}
    for entry in sorted(weights, key=lambda e: (len(e.rstrip()), e)):
        stem = entry.rstrip()
        if not any(kept.get(stem[:n], -1.0) >= weights[entry] - 1.0 for n in range(2, len(stem) + (entry != stem))):
            kept[entry] = weights[entry]
    return kept


def _exceptions(rows: DataFrame, weights: dict[str, float]) -> frozenset[str]:
    def phrases(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(weights, frozenset())
        for b in batches:
            counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for text, label in zip(b["text"], b["toxic"], strict=True):
                words = fold(text)
                around = {f"{words[i]} {words[i + 1]}" for at, _, _ in matcher.matches(words) for i in (at - 1, at) if 0 <= i < len(words) - 1}
                counts[label].update(around)
            names = list(counts[0] | counts[1])
            both = {"t": counts[1], "o": counts[0]}
            yield pd.DataFrame({"phrase": pd.Series(names, dtype=object), **{k: pd.Series([c[x] for x in names], dtype="int64") for k, c in both.items()}})

    found = (
        rows.select("text", "toxic").mapInPandas(phrases, "phrase string, t long, o long")
        .groupBy("phrase")
        .agg(F.sum("t").alias("t"), F.sum("o").alias("o"))
        .where((F.col("o") >= EXCEPTION_DOCS) & (F.col("t") <= EXCEPTION_SHARE * (F.col("o") + F.col("t"))))
        .orderBy(F.desc("o"), "phrase")
        .limit(ENTRIES)
    )
    return frozenset(r["phrase"] for r in found.collect())


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton's method with a weak pull towards 0."""
    if not len(x):
        return 1.0, -1.0
    beta, design = np.zeros(2), np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        step = np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + 0.01 * np.eye(2), design.T @ (y - p) - 0.01 * beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return float(max(beta[0], 0.0)), float(beta[1])


def score(lexicon: Lexicon, text: Column) -> Column:
    """Struct of ``score`` (0 to 1), ``predicted`` (1 from 0.5 on) and ``matches``. Null and empty texts have no match, and the score of that."""

    @F.pandas_udf(SCORES)
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(lexicon.weights, lexicon.exceptions)
        slope, offset = lexicon.curve
        for texts in batches:
            rows = []
            for text in texts:
                x, n = matcher.density(fold(text))
                p = 1 / (1 + math.exp(-max(-30.0, min(30.0, slope * x + offset))))
                rows.append((p, int(p >= 0.5), n))
            yield pd.DataFrame(rows, columns=["score", "predicted", "matches"])

    return apply.asNondeterministic()(text)
