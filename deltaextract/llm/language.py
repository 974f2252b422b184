"""Language identification by compression.

Each language has a zstandard dictionary of raw content: pieces of its labelled texts. A text, of which only lower-cased letters and
single blanks are looked at, is compressed with each dictionary, block by block so that every part of a long text is as close to the dictionary as the first; the language with the fewest bytes wins. A
text without letters, or whose two best languages differ by less than ``margin`` of the bytes, is rejected.

Fitting takes ``pieces`` texts per language, the one with the smallest hash out of each of as many buckets of hashes, and the first
``piece_chars`` characters of each. That bounds the model (pieces x piece_chars x languages, at most ``MAX_LANGUAGES``) whatever
the size of the table. Predicting reads whole texts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deltaextract.llm.common import each

PIECES, PIECE_CHARS, MAX_LANGUAGES = 64, 400, 500
BLOCK_BYTES = 4096
#: Rejected: the best two languages differ by less than this share of the compressed bytes.
MARGIN = 0.002
#: Score: how sure a margin is. A margin of 1 / STEEPNESS of the bytes has odds of e to 1.
STEEPNESS = 60.0
UNKNOWN = "und"
PREDICTED = "lang string, score double, margin double, rejected boolean"

_LETTER = regex.compile(r"\p{L}")
_OTHERS = re.compile(r"[\W\d_]+")


def _settings() -> zstandard.ZstdCompressionParameters:
    # A search that looks at several earlier places finds the words of the dictionary; the fast levels miss too many of them.
    return zstandard.ZstdCompressionParameters(
        window_log=17, chain_log=17, hash_log=17, search_log=4, min_match=3, target_length=32,
        strategy=zstandard.STRATEGY_BTLAZY2, write_content_size=False, write_dict_id=False,
    )


def letters_only(text: str) -> str:
    return _OTHERS.sub(" ", text.lower())


@dataclass(frozen=True)
class CompressionModel:
    languages: tuple[str, ...]
    dictionaries: tuple[bytes, ...]


def fit(docs: DataFrame, *, text: str = "text", lang: str = "lang", pieces: int = PIECES, piece_chars: int = PIECE_CHARS) -> CompressionModel:
    """Dictionaries from the labelled texts of ``docs``: rows with a language and a text that has more than 20 characters.

    Repeated texts count once. The driver gets ``pieces`` bounded pieces for each language and no more.
    """
    usable = docs.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text")).where("lang is not null and length(text) > 20")
    hashed = usable.select("lang", "text", F.xxhash64("text").alias("h")).withColumn("bucket", F.pmod("h", F.lit(pieces)))
    chosen = hashed.groupBy("lang", "bucket").agg(F.min("h").alias("h"))
    # At most MAX_LANGUAGES x pieces narrow rows; the texts themselves are not shuffled for the choice.
    named = chosen.limit(MAX_LANGUAGES * pieces + 1).collect()
    if len({r["lang"] for r in named}) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not named:
        return CompressionModel((), ())
    # As an Arrow table: rows of Python would be read by Python workers of their own, which stay in each executor.
    picked = docs.sparkSession.createDataFrame(pa.table({"lang": pa.array([r["lang"] for r in named], pa.string()), "h": pa.array([r["h"] for r in named], pa.int64())}))
    found = (
        hashed.select("lang", "h", F.substring("text", 1, piece_chars).alias("piece"))
        .join(F.broadcast(picked), ["lang", "h"], "left_semi")
        .groupBy("lang", "h")
        .agg(F.min("piece").alias("piece"))
        .collect()
    )
    by_lang: dict[str, list[tuple[int, str]]] = {}
    for r in found:
        by_lang.setdefault(r["lang"], []).append((r["h"], r["piece"]))
    languages = sorted(by_lang)
    content = ["\n".join(letters_only(p) for _, p in sorted(by_lang[x])).encode() for x in languages]
    # Equal length, so that none wins by having more to refer to; a language with little text is repeated.
    length = max(map(len, content))
    return CompressionModel(tuple(languages), tuple((c * -(-length // len(c)))[:length] for c in content))


class _Predictor:
    def __init__(self, model: CompressionModel):
        self._languages = model.languages
        self._compressors = []
        for content in model.dictionaries:
            made = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            made.precompute_compress(compression_params=_settings())
            self._compressors.append(zstandard.ZstdCompressor(compression_params=_settings(), dict_data=made))

    def __call__(self, text: str | None, margin: float) -> tuple[str, float, float, bool]:
        if not text or not self._languages or not _LETTER.search(text):
            return UNKNOWN, 0.0, 0.0, True
        raw = letters_only(text).encode("utf-8", "replace")
        blocks = [raw[i : i + BLOCK_BYTES] for i in range(0, len(raw), BLOCK_BYTES)]
        sizes = [sum([len(c.compress(b)) for b in blocks]) for c in self._compressors]
        best = min(range(len(sizes)), key=lambda k: (sizes[k], k))
        least = sizes[best]
        others = [s for k, s in enumerate(sizes) if k != best]
        gap = (min(others) - least) / least if others else 1.0
        odds = sum(math.exp(-min(STEEPNESS * (s - least) / least, 700)) for s in sizes)
        return self._languages[best], 1 / odds, gap, gap < margin


def predict(model: CompressionModel, text: Column, margin: float = MARGIN) -> Column:
    """Struct of ``lang``, ``score`` (0 to 1), ``margin`` (share of bytes between the best two) and ``rejected``.

    Null texts and texts without a letter are ``und``, score 0, rejected. Equal sizes go to the first language by name, and are rejected.
    """

    @F.pandas_udf(PREDICTED)
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        predictor = _Predictor(model)

        def found(texts: pd.Series) -> Iterator[pd.DataFrame]:
            yield pd.DataFrame([predictor(x, margin) for x in texts], columns=["lang", "score", "margin", "rejected"]).astype({"score": float, "margin": float, "rejected": bool})

        return each(batches, found)

    return apply.asNondeterministic()(text)


def keep_known(docs: DataFrame, model: CompressionModel, *, text: str = "text", margin: float = MARGIN) -> DataFrame:
    """The rows of ``docs`` whose language is not rejected, with the columns of ``docs``."""
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), predict(model, F.col(f"`{text}`"), margin).alias("found"))
    return marked.where("not found.rejected").select("row.*")
