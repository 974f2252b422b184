"""The registered queries and the pipeline over a small data folder: columns, types and folds of their contracts, against plain computations."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import queries

DATA = "/root/testdata/sf0.001"
ODD = [(9001, None, None, None, None), (9002, "", "en", "s", 0), (9003, "12 345 !!", None, "s", 9), (9004, "many words " * 4000, "en", "s", 44000), (9005, "many words " * 4000, "en", "s", 44000)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Eighty documents and odd ones, with all of the other tables."""
    base = str(tmp_path_factory.mktemp("data"))
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = docs.where("doc_id < 80").select("doc_id", "text", "lang", "source", "n_chars")
    rows.union(spark.createDataFrame(ODD, rows.schema)).repartition(3).write.parquet(f"{base}/documents.parquet")
    for name in ("benchmark", "labels", "embeddings"):
        spark.read.parquet(f"{DATA}/{name}.parquet").write.parquet(f"{base}/{name}.parquet")
    return base


@pytest.fixture(scope="module")
def docs(folder):
    return {r["doc_id"]: r for r in pq.read_table(f"{folder}/documents.parquet").to_pylist()}


def run(spark, folder, name):
    frame = queries()[name](spark, folder)
    return dict(frame.dtypes), frame.collect()


def fold(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


def sha(data):
    return hashlib.sha256(data).hexdigest()


def words_of(text):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]


def test_query_1(spark, folder, docs):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    types, rows = run(spark, folder, "op1_bpe")
    assert types == {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}
    assert len(rows) == len(docs)
    for r in rows:
        ids = library.encode(docs[r.doc_id]["text"] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(decoded.encode()))


def test_query_3(spark, folder, docs):
    types, rows = run(spark, folder, "op3_language")
    assert {k: types[k] for k in ("doc_id", "held_out", "lang_pred", "score")} == {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"}
    learned = {d["lang"] for i, d in docs.items() if d["lang"] and fold(i, 4) != 2}
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        assert r.held_out == (fold(r.doc_id, 4) == 2) and 0 <= r.score <= 1
        has_letter = any(c.isalpha() for c in docs[r.doc_id]["text"] or "")
        assert (r.lang_pred in learned) if has_letter else (r.lang_pred == "und")


def test_query_4(spark, folder, docs):
    types, rows = run(spark, folder, "op4_toxicity")
    assert {k: types[k] for k in ("doc_id", "held_out", "score", "predicted")} == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        assert r.held_out == (fold(r.doc_id, 5) == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)


def test_query_5(spark, folder, docs):
    items = {r["item_id"]: words_of(r["text"]) for r in pq.read_table(f"{folder}/benchmark.parquet").to_pylist()}
    windows = defaultdict(set)
    for item, words in items.items():
        for k in range(max(1, len(words) - 12)) if words else ():
            windows[tuple(words[k : k + 13])].add(str(item))
    types, rows = run(spark, folder, "op5_decontamination")
    assert types == {"doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint", "items_sha256": "string", "contaminated": "boolean"}
    hits = 0
    for r in rows:
        words, hit, found = words_of(docs[r.doc_id]["text"]), set(), set()
        for size in {len(w) for w in windows}:
            for k in range(len(words) - size + 1):
                if (w := tuple(words[k : k + size])) in windows:
                    hit |= set(range(k, k + size))
                    found |= windows[w]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == (len(words), len(hit), len(found), sha(",".join(sorted(found)).encode()))
        assert r.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(words))
        hits += r.n_hit
    assert hits and len(rows) == len(docs)


def test_query_6(spark, folder, docs):
    types, rows = run(spark, folder, "op6_sharding")
    assert {k: types[k] for k in ("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")} == {
        "doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"
    }
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    slots = defaultdict(list)
    for r in rows:
        data = (docs[r.doc_id]["text"] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 16, zlib.crc32(data), "bytes", None) and 0 <= r.shard < 40
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_query_7(spark, folder):
    table = pq.read_table(f"{folder}/embeddings.parquet").to_pylist()
    column = next(k for k, v in table[0].items() if isinstance(v, list))
    vectors = {r["vec_id"]: np.array(r[column], np.float64) for r in table if r[column] and all(x is not None and math.isfinite(x) for x in r[column]) and any(r[column])}
    ids = sorted(vectors)
    matrix = np.array([vectors[i] for i in ids])
    types, rows = run(spark, folder, "op7_ann")
    assert {k: types[k] for k in ("query_id", "rank", "vec_id", "score")} == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"}
    found = defaultdict(list)
    for r in sorted(rows, key=lambda r: r["rank"]):
        found[r.query_id].append((r.vec_id, r.score))
    assert sorted(found) == [i for i in ids if i % 50 == 0]
    right = total = 0
    for query, near in found.items():
        scores = matrix @ vectors[query] / (np.linalg.norm(matrix, axis=1) * np.linalg.norm(vectors[query]))
        best = sorted((-s, i) for s, i in zip(scores.tolist(), ids, strict=True) if i != query)[:5]
        right, total = right + len({i for _, i in best} & {i for i, _ in near}), total + len(best)
        of = dict(zip(ids, scores.tolist(), strict=True))
        assert len(near) == len(best) and all(abs(of[i] - s) < 1e-9 for i, s in near)
    assert right >= 0.9 * total


def test_query_9(spark, folder, docs):
    shingles = {}
    for i, d in docs.items():
        words = words_of(d["text"])
        shingles[i] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)}
    types, rows = run(spark, folder, "op9_jaccard_join")
    assert types["doc_id"] == "bigint" and sorted(r.doc_id for r in rows) == sorted(docs)
    column = next(c for c in types if "class" in c)
    class_of = {r.doc_id: r[column] for r in rows}
    for i in docs:
        for j in docs:
            if i < j and shingles[i] and shingles[j] and len(shingles[i] & shingles[j]) >= 0.8 * len(shingles[i] | shingles[j]):
                assert class_of[i] == class_of[j]


def test_query_10(spark, folder, docs):
    tokens = {i: [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), d["text"] or "")), None] for i, d in docs.items()}
    counts = Counter(t for i, found in tokens.items() if fold(i, 10) != 0 for t in found)
    n, v = sum(counts.values()), len(counts)
    types, rows = run(spark, folder, "op10_lm_scoring")
    assert types == {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"}
    for r in rows:
        found = tokens[r.doc_id]
        base = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in found)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (fold(r.doc_id, 10) == 0, len(found), sum(t in counts for t in found), n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and math.isfinite(r.score) and r.score < 0
    assert len(rows) == len(docs)


def test_queries_2_and_8_have_a_row_for_each_document(spark, folder, docs):
    for name in ("op2_licenses", "op8_line_dedup"):
        _, rows = run(spark, folder, name)
        assert sorted(r.doc_id for r in rows) == sorted(docs)


def test_pipeline(spark, folder, docs):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "line dedup", "jaccard join", "decontamination", "bpe"]
    frame = queries()["pipeline"](spark, folder)
    rows = frame.collect()
    kept = [r.doc_id for r in rows]
    assert len(set(kept)) == len(kept) and set(kept) < set(docs)
    # Without a letter, without text, and one of two copies.
    assert not {9001, 9002, 9003} & set(kept) and len({9004, 9005} & set(kept)) <= 1
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    same = 0
    for r in rows:
        ids = library.encode(docs[r.doc_id]["text"] or "", add_special_tokens=False).ids
        same += np.frombuffer(bytes(r.ids), "<u4").tolist() == ids
        assert r.n_tokens == len(bytes(r.ids)) // 4
    # Texts of which no line went are encoded whole.
    assert same > len(rows) / 2
