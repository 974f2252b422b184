"""Byte-level BPE, importance resampling and filter audit against brute force, also as registered queries over a small data folder."""

import hashlib
import math
import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from __spark_entry__ import queries
from deltaextract.llm import byte_bpe, filteraudit, resample

RANKS = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def folder(spark, tmp_path, docs, benchmark=(), labels=()):
    """A data folder with these documents, (item_id, text) and (doc_id, quality, toxic)."""
    spark.createDataFrame(list(docs), SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(benchmark), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def sha(data):
    return hashlib.sha256(data).hexdigest()


# -- byte-level BPE -------------------------------------------------------------------------------------------------

TEXTS = [
    "",
    None,
    "  The quick brown fox, didn't it?  ",
    "a" * 700,
    "ababab" * 40 + "xyz" * 50,
    "x\u0085y z \x1c\x1d end\n\n  \n\tnext",
    "中文字 ñandú ＡＢ ２３ ² Ⅷ",
    "\U00010400\U0001f600 \U000e0100\U0001e950 ͸Ᲊ",
    "'s 't 'S can'tve'll'd 123abc456 <|endoftext|>",
    "one two one two " * 3000,
    "#$%&*| \x00\x01 ﻿�",
]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def test_bytes_like_the_library(spark, library):
    rows = [(i, t, f"{i}") for i, t in enumerate(TEXTS * 2)] + [(3, TEXTS[3], "again")]
    docs = spark.createDataFrame(rows, "row long, text string, items string").withColumn("ids", F.lit("replaced")).withColumn("words", F.lit(1)).repartition(3)
    # Blocks of a few texts, and texts longer than a block.
    out = byte_bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN, chars=1000)
    assert out.columns == ["row", "items", "words", "ids"]
    decode = byte_bpe.decoder(spark, RANKS)
    found = out.select("row", "items", "ids", decode(F.col("ids")).alias("bytes")).collect()
    assert sorted((r.row, r["items"]) for r in found) == sorted((i, n) for i, _, n in rows)
    for r in found:
        text = TEXTS[r.row % len(TEXTS)] or ""
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode_ordinary(text), repr(text)[:60]
        assert bytes(r.bytes) == text.encode()
    assert byte_bpe.encode_documents(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_other_ranks(spark):
    """Ranks of another vocabulary, and a small one where a merge makes a pair of lower rank than its own."""
    multi = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    odd = {bytes([b]): b + 10 for b in range(256)} | {b"ab": 400, b"abx": 1, b"ba": 300, b"aa": 401, b"aaa": 2, b"aba": 3, b"bab": 402}
    for ranks in (multi, odd):
        other = tiktoken.Encoding("other", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        texts = [t for t in TEXTS if t] + ["abxab abab aaaaa baab xabab" + "aab" * 7]
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
        for r in byte_bpe.encode_documents(docs, ranks, public_tokenizers.PATTERN).collect():
            assert np.frombuffer(r.ids, "<u4").tolist() == other.encode_ordinary(texts[r.doc_id])


def test_a_worker_keeps_a_bounded_number_of_words(monkeypatch, library):
    monkeypatch.setattr(byte_bpe, "CACHE_WORDS", 50)
    encoder = byte_bpe.Encoder(RANKS, byte_bpe.patterns(public_tokenizers.PATTERN))
    text = " ".join(f"{'qx'[i % 2]}{'jkvw' * (i % 9)}zq{i}" for i in range(500)) + " " + "jq" * 100
    assert np.frombuffer(encoder(text), "<u4").tolist() == library.encode_ordinary(text)
    assert 0 < len(encoder.codes) <= 50
    assert max(map(len, encoder.codes)) <= byte_bpe.CACHE_CHARS


def test_a_very_long_word_is_not_quadratic(library):
    for word in ("ab" * 150_000, "xyzzy" * 50_000, "a" * 300_000):
        assert byte_bpe.merged(RANKS, word.encode()) == library.encode_ordinary(word)


def test_a_byte_without_a_rank_is_an_error(tmp_path):
    (tmp_path / "few").write_text("YQ== 0\n")
    with pytest.raises(ValueError, match="no rank"):
        byte_bpe.read_ranks(f"{tmp_path}/few")


def test_query_11(spark, tmp_path, library):
    docs = [(i, t, "en", "s", 0) for i, t in enumerate(TEXTS)]
    out = queries()["op11_byte_bpe"](spark, folder(spark, tmp_path, docs))
    assert out.dtypes == [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    expected = []
    for i, text, *_ in docs:
        ids = library.encode_ordinary(text or "")
        expected.append((i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha((text or "").encode())))
    assert sorted(map(tuple, out.collect())) == expected


# -- importance resampling ------------------------------------------------------------------------------------------


def words_of(text):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]


def features_of(text, min_n, max_n, buckets):
    words = words_of(text)
    return [zlib.crc32(" ".join(words[i : i + n]).encode()) % buckets for n in range(min_n, max_n + 1) for i in range(len(words) - n + 1)]


def resampled(docs, target, *, min_n=1, max_n=1, buckets=10_000, min_words=20, percent=10, seed=2024):
    """(id, n_words, n_features, weight, score, rank) of each document."""
    found = [(i, len(words_of(t)), features_of(t, min_n, max_n, buckets)) for i, t in docs]
    s, t = Counter(b for _, _, f in found for b in f), Counter(b for x in target for b in features_of(x, min_n, max_n, buckets))
    n_s, n_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * n_s / ((s[b] + 1) * n_t))) for b in s}
    out = []
    for i, n, f in found:
        h = int(sha(f"{seed}:{'' if i is None else i}".encode())[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append((i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    order = sorted((x for x in out if x[1] >= min_words), key=lambda x: (-x[4], x[0] is None, x[0] or 0))
    ranks = Counter()
    drawn = order[: percent * len(order) // 100]
    places = [(*x, k) for k, x in enumerate(drawn, start=1)]
    for x in drawn:
        ranks[x] += 1
    rest = []
    for x in out:
        if ranks[x]:
            ranks[x] -= 1
        else:
            rest.append((*x, None))
    return sorted(places + rest, key=repr)


LINES = ["Alpha beta gamma; delta", "the SAME line, again and again", "É à 中文 x1", "", "   ", "--- ***", "one", "two three\tfour\x0bfive six seven eight nine ten eleven twelve"]
DOCS = (
    [(i, "\n".join(LINES[(i * k) % len(LINES)] for k in range(1, 2 + i % 9))) for i in range(60)]
    + [(100, None), (101, ""), (None, "\n".join(LINES * 3)), (7, "\n".join(LINES)), (7, "\n".join(LINES)), (7, "\n".join(LINES))]
    + [(200, "the same line again and again\n" * 4000), (201, "word " * 20)]
)
TARGET = ["alpha beta\ngamma delta delta", None, "", "one two\nthree"]


@pytest.mark.parametrize("sizes", [{}, {"max_n": 2, "buckets": 500}, {"min_n": 2, "max_n": 3, "buckets": 70, "percent": 50, "min_words": 3, "seed": 1}])
def test_importance_like_brute_force(spark, sizes, monkeypatch):
    monkeypatch.setattr(resample, "HOT_LINES", 5)  # some lines reach the documents by broadcast, some by a shuffle
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("row", "key", "at", "weight", "times")}).repartition(4)
    found = resample.importance(docs, spark.createDataFrame([(t,) for t in TARGET], "text string"), **sizes)
    assert found.columns == ["doc_id", "row", "key", "at", "times", "n_words", "n_features", "weight", "score", "rank"]
    rows = [tuple(r) for r in found.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()]
    assert sorted(rows, key=repr) == resampled(DOCS, TARGET, **sizes)
    assert any(r[-1] for r in rows)


def test_importance_of_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert resample.importance(none, none).count() == 0
    docs = spark.createDataFrame(DOCS[:20], "doc_id long, text string")
    rows = [tuple(r) for r in resample.importance(docs, none).select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()]
    assert sorted(rows, key=repr) == resampled(DOCS[:20], [])


def test_query_12(spark, tmp_path):
    docs = [(i, t, None, "s", 0) for i, t in DOCS]
    out = queries()["op12_resampling"](spark, folder(spark, tmp_path, docs, list(enumerate(TARGET))))
    assert out.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([(i, f, w, s, r) for i, _, f, w, s, r in resampled(DOCS, TARGET)], key=repr)


# -- filter audit ---------------------------------------------------------------------------------------------------


def audited(docs, labels):
    """docs: (id, source, text)."""
    good, toxic = {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, t in labels if t == 1 and i is not None}
    least = {}
    for i, _, text in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    rows = []
    for i, source, text in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": i is not None and i > least[text],
        }
        rows.append((source or "", {k for k, v in fails.items() if v}, i in good, i in toxic))
    out = []
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        removed_by, lines = Counter(), []
        for order in permutations("ABCDE"):
            for step, f in enumerate(order, start=1):
                before = set(order[: step - 1])
                gone = [r for r in own if f in r[1] and not r[1] & before]
                removed_by[f] += len(gone)
                kept = sum(1 for r in own if not r[1] & (before | {f}))
                redundant = sum(1 for r in own if f in r[1] and r[1] & before)
                lines.append((part, "".join(order), step, kept, len(gone), redundant, sum(1 for r in own if r[1] == {f}), sum(r[2] for r in gone), sum(r[3] for r in gone)))
        out += [(*x, removed_by[x[1][x[2] - 1]]) for x in lines]
    return sorted(out)


LONG = " ".join(f"w{k}" for k in range(200))
AUDIT = [
    (1, "a", LONG),
    (2, "a", LONG),
    (2, "a", LONG),
    (3, "b", LONG),
    (None, "a", LONG),
    (None, None, LONG),
    (0, None, LONG + " #"),
    (5, "", "word " * 300),
    (6, "b", "word " * 300 + "A" * 40),
    (7, "b", "Short & Loud"),
    (8, "a", None),
    (9, "a", ""),
    (9, "b", ""),
    (10, "a", "\x1c  \x85é É\t\n\x0b"),
    (11, "c", " ".join(f"v{k % 100}" for k in range(200))),
    (12, "c", " ".join(f"v{k % 99}" for k in range(200))),
    (13, "c", ("x" * 48 + "A" + " ") * 300),
    (14, "c", "x" * 300_000),
]
AUDIT += [(20 + k, "hot", LONG + " end") for k in range(300)] + [(15, "hot", "same row")] * 200
LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (3, None, 1), (7, 0, 1), (9, 1, None), (None, 1, 1), (25, 1, 1), (15, 1, 0), (999, 1, 1)]


@pytest.mark.parametrize("chars", [1, 5_000, 12_000_000])
def test_audit_like_brute_force(spark, chars):
    docs = spark.createDataFrame(AUDIT, "doc_id long, source string, text string").withColumns({c: F.lit("x") for c in ("shard", "docs", "n", "row", "part")}).repartition(3)
    found = filteraudit.audit(docs, spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int"), chars=chars)
    assert sorted(map(tuple, found.collect())) == audited(AUDIT, LABELS)


def test_words_have_one_number_in_all_shards(spark):
    docs = spark.createDataFrame([(i, t) for i, _, t in AUDIT], "doc_id long, text string").repartition(5)
    matrix = filteraudit.document_term_matrix(docs, chars=4_000)
    assert matrix.count() > 5
    word_of, seen = {}, 0
    texts = Counter((i, t) for i, _, t in AUDIT)
    for shard in matrix.collect():
        entries, columns, counts = (filteraudit._unpacked(shard[c], np.int64) for c in ("entries", "columns", "counts"))
        at = np.concatenate([[0], np.cumsum(entries)])
        for k, doc in enumerate(shard.docs):
            row = dict(zip(columns[at[k] : at[k + 1]].tolist(), counts[at[k] : at[k + 1]].tolist(), strict=True))
            text = next(t for (i, t), n in texts.items() if i == doc.row.doc_id and len((t or "").encode().split()) == sum(row.values()) and n > 0)
            assert sorted(row.values()) == sorted(Counter((text or "").encode().split()).values())
            for word, n in Counter((text or "").encode().split()).items():
                if list(Counter((text or "").encode().split()).values()).count(n) == 1:
                    number = next(c for c, m in row.items() if m == n)
                    assert word_of.setdefault(word, number) == number
            seen += 1
    assert seen == len(AUDIT) and len(set(word_of.values())) == len(word_of)
    sums = filteraudit.row_sums(matrix).select("n_words", "n_distinct").collect()
    assert Counter(map(tuple, sums)) == Counter((len(w), len(set(w))) for w in ((t or "").encode().split() for _, _, t in AUDIT))


def test_audit_of_empty_tables(spark):
    none, labels = spark.createDataFrame([], "doc_id long, source string, text string"), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filteraudit.audit(none, labels).count() == 0
    docs = spark.createDataFrame(AUDIT[:3], "doc_id long, source string, text string")
    assert sorted(map(tuple, filteraudit.audit(docs, labels).collect())) == audited(AUDIT[:3], [])


def test_query_13(spark, tmp_path):
    docs = [(i, t, None, s, 0) for i, s, t in AUDIT]
    out = queries()["op13_filter_audit"](spark, folder(spark, tmp_path, docs, labels=LABELS))
    assert dict(out.dtypes) == {"part": "string", "filter_order": "string", "step": "int"} | {c: "bigint" for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")}
    assert sorted(map(tuple, out.collect())) == audited(AUDIT, LABELS)
