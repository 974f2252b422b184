"""Training-data operators against brute force, on small tables with nulls, empty and long texts, copies and clashing columns."""

import hashlib
import math
import re
import weakref
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from deltaextract.llm import ann, bpe, decontaminate, jaccard, language, license, linededup, lm, reshard, toxicity
from deltaextract.llm.common import plain
from deltaextract.llm.eliasfano import EliasFano, NgramTrie

PATH = public_tokenizers.path("word_bpe_49k.json")
EMPTY = "doc_id long, text string"


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    """A hundred documents, copies, and odd rows."""
    some = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 150").select("doc_id", "text", "lang")
    odd = spark.createDataFrame(
        [(9001, None, "en"), (9002, "", None), (9003, "12 345 !!", "en"), (None, "no id here at all", None), (9004, "x " * 12_000, "en"), (9004, "x " * 12_000, "en")],
        some.schema,
    )
    return some.union(odd).union(some.where("doc_id < 5").withColumn("doc_id", F.col("doc_id") + 8000)).cache()


def texts_of(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def test_bpe_is_that_of_the_library(spark, docs):
    library = Tokenizer.from_file(PATH)
    odd = ["<|endoftext|>x<|startoftext|>", "ΑΣ σς İI", "don't 'S've", "漢字 ½ ⅷ", "áé\x1c\x85b", "aaaaaaaaaaaa" * 50, *[chr(c) + "a" + chr(c) + "B" for c in range(1, 0x250)]]
    coder = bpe.PairIndexBpe(open(PATH, encoding="utf-8").read())
    assert [np.frombuffer(x, "<u4").tolist() for x in coder.encode(odd)] == [library.encode(x, add_special_tokens=False).ids for x in odd]
    found = bpe.encode_documents(docs.withColumn("ids", F.lit("clash")), PATH, decoded="decoded").collect()
    assert len(found) == docs.count()
    for r in found:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == ids
        assert r.decoded == library.decode(ids, skip_special_tokens=False)
    assert bpe.encode_documents(spark.createDataFrame([], EMPTY), PATH, decoded="d").count() == 0


def test_language_is_right_on_held_out_rows_and_rejects_what_has_no_letter(spark, sf_dir, docs):
    all_docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language.fit(all_docs.where("doc_id % 4 != 2"))
    marked = {r.doc_id: r.p for r in docs.select("doc_id", language.predict(model, F.col("text")).alias("p")).collect()}
    assert [(marked[k].lang, marked[k].score, marked[k].rejected) for k in (9001, 9002, 9003)] == [("und", 0.0, True)] * 3
    kept = language.keep_known(docs, model)
    assert kept.columns == docs.columns and not {9001, 9002, 9003} & {r.doc_id for r in kept.collect()}
    assert language.fit(spark.createDataFrame([], "text string, lang string")).languages == ()


def test_language_accuracy(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language.fit(rows.where("doc_id % 4 != 2"))
    found = rows.where("doc_id % 4 = 2").select("lang", language.predict(model, F.col("text"))["lang"].alias("p"))
    assert found.agg(F.avg((F.col("p") == F.col("lang")).cast("int"))).first()[0] > 0.95


def test_toxicity_finds_planted_words_and_their_disguises(spark):
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        rows.append((i, f"w{i % 17} plain words {'grumblefuzz ' * 2 if bad else 'and the kind grumble fuzz '}end number{i % 23}"))
        labels.append((i, int(bad)))
    docs, marks = spark.createDataFrame(rows, EMPTY), spark.createDataFrame(labels, "doc_id long, toxic int")
    lexicon = toxicity.fit(docs, marks)
    asked = spark.createDataFrame([(1, "GRUMBL3FUZZ here grumblefuzz"), (2, "grуmblefuzz gruмblefuzz grumblefuzz"), (3, "kind words"), (4, None), (5, "")], EMPTY)
    found = {r.doc_id: r.s for r in asked.select("doc_id", toxicity.score(lexicon, F.col("text")).alias("s")).collect()}
    assert [found[k].predicted for k in (1, 2, 3, 4, 5)] == [1, 1, 0, 0, 0] and found[4].score == found[5].score
    assert toxicity.Matcher({" bad ": 2.0}, frozenset({"bad luck"})).matches(["bad", "luck", "bad"]) == [(2, "bad", 2.0)]
    assert toxicity.fit(spark.createDataFrame([], EMPTY), marks).weights == {}


def brute_contamination(text, bench, window=13):
    words = lambda x: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (x or "").encode().lower())
    own, hit, items = words(text), set(), set()
    for item, t in bench:
        w = words(t)
        size = min(window, len(w))
        for a in range(len(w) - size + 1 if w else 0):
            for b in range(len(own) - size + 1):
                if own[b : b + size] == w[a : a + size]:
                    hit.update(range(b, b + size))
                    items.add(str(item))
    return len(own), len(hit), sorted(items)


def test_decontamination_matches_brute_force(spark):
    bench = [(1, " ".join(f"q{i}" for i in range(20))), (2, "Short One"), (10, "q3 q4 Q5 " * 6), (11, None), (12, "--"), (None, "nobody owns this")]
    texts = ["a q0 q1 q2 q3, q4 q5 q6 q7 q8 q9 q10 q11 q12; q13 b", "short-one! short one", "q3 q4 q5 " * 9, "nobody owns this", None, "", "é" * 5000]
    docs = spark.createDataFrame(list(enumerate(texts)), EMPTY).withColumn("found", F.lit(1))
    table = spark.createDataFrame(bench, "item_id long, text string")
    for block in (decontaminate.BLOCK_WORDS, 20):
        found = {r.row.doc_id: r.found for r in decontaminate.find_contamination(docs, table, block_words=block).collect()}
        for i, t in enumerate(texts):
            n, hit, items = brute_contamination(t, bench)
            assert (found[i].n_words, found[i].n_hit, found[i]["items"]) == (n, hit, [x for x in items if x != "None"])
    assert decontaminate.find_contamination(docs, table.limit(0)).count() == len(texts)
    assert decontaminate.drop_contaminated(docs, table).columns == docs.columns
    assert decontaminate.word_places("Ab, é1") == [(0, 2), (4, 7)]


def test_resharding_is_even_whole_and_moves_little(spark, docs, tmp_path):
    rows, plan = reshard.reshard_documents(docs.where("doc_id < 150"), 4, 5)
    found = rows.collect()
    sizes = Counter()
    for r in found:
        sizes[r.shard] += r.size
    assert max(sizes.values()) < 1.1 * min(sizes.values())
    for s in sizes:
        assert sorted(r.slot for r in found if r.shard == s) == list(range(sum(r.shard == s for r in found)))
    assert sum(r.size for r in found if r.shard != r.old_shard) <= 1.2 * sum(n for (i, j), n in plan.flow.items() if i != j) + max(sizes.values()) // 20
    assert reshard.min_cost_flow({0: 5, 1: 1}, {0: 2, 1: 2, 2: 2}) in ({(0, 0): 2, (0, 1): 1, (0, 2): 2, (1, 1): 1}, {(0, 0): 2, (0, 2): 2, (0, 1): 1, (1, 1): 1})
    written = reshard.rewrite(rows, plan, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == sum(r.shard in written for r in found)
    assert reshard.reshard_documents(docs, 3, 4)[0].count() == docs.count()
    assert reshard.reshard_documents(spark.createDataFrame([], EMPTY), 3, 4)[0].count() == 0


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(700, 16)).astype(float)
    x[300:400] = x[7]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (901, [0.0] * 16), (902, [math.nan] + [1.0] * 15), (None, [1.0] * 16), (903, [1.0, 2.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = ann.search(ann.index(vectors, shard_rows=200), vectors.where("vec_id % 50 = 0 or vec_id = 7")).collect()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    right = total = 0
    for q in {r.query_id for r in found}:
        scores = unit @ unit[q]
        scores[q] = -9
        best = np.lexsort((np.arange(700), -scores.round(12)))[:5].tolist()
        own = [r.vec_id for r in sorted((r for r in found if r.query_id == q), key=lambda r: r.rank)]
        right, total = right + len(set(best) & set(own)), total + 5
        assert len(own) == 5 and q not in own
    assert right >= 0.9 * total
    assert [r.vec_id for r in sorted((r for r in found if r.query_id == 7), key=lambda r: r.rank)] == [300, 301, 302, 303, 304]
    assert ann.search(ann.index(vectors.limit(0)), vectors.limit(0)).count() == 0


def test_repeated_lines_go_once_and_every_line_stays_somewhere(spark, docs):
    passage = "\n".join(f"line {k} of a passage that several documents share, with words enough to count here" for k in range(8))
    long_line = "a single long line " * 15
    rows = [(k, f"own {k} start\nmore {k}\n{passage}\nown {k} end") for k in range(6)] + [(10, f"first\n{long_line}"), (11, f"second\n{long_line}\nthird"), (12, None), (13, ""), (13, ""), (14, "clean\ntext")]
    found = linededup.dedup_lines(spark.createDataFrame(rows, EMPTY).withColumn("removed_lines", F.lit(-1)))
    by_id = {r.doc_id: r for r in found.collect()}
    assert found.count() == len(rows) and by_id[0].text == rows[0][1] and by_id[12].text is None and by_id[14].text == "clean\ntext"
    assert by_id[11].text == "second\nthird" and by_id[10].removed_lines == 0
    assert all(by_id[k].removed_lines >= 5 and by_id[k].text.startswith(f"own {k} start") for k in range(1, 6))
    cleaned = {l for r in linededup.dedup_lines(docs).collect() for l in (r.text or "").split("\n")}
    assert {l for _, t in texts_of(docs) for l in (t or "").split("\n")} <= cleaned | {""}
    assert linededup.dedup_lines(docs.limit(0)).count() == 0


def brute_line_dedup(rows, min_lines=2, min_words=25, long_words=50):
    """Text of each document without the lines of passages that occur before and end there before they start here; what lines are left."""
    first, out = {}, {}
    for d, (i, text) in enumerate(sorted({r for r in rows if r[1] is not None})):
        lines, gone = text.split("\n"), set()
        for a in range(len(lines)):
            for b in range(a, len(lines)):
                n = sum(len(x.split()) for x in lines[a : b + 1])
                if (b - a + 1 >= min_lines and n >= min_words) or (a == b and n >= long_words):
                    there = first.setdefault(tuple(lines[a : b + 1]), (d, b))
                    if there < (d, a):
                        gone.update(range(a, b + 1))
        out[i, text] = "\n".join(x for k, x in enumerate(lines) if k not in gone), len(gone)
    return out


def test_repeated_passages_go_though_their_lines_are_frequent_elsewhere(spark):
    said = " ".join(f"p{k}" for k in range(30))
    passage = f"{said} one\n\na common sentence\n{said} two\n\n{said} three"
    rows = [(0, "a common sentence\n\nand something else"), (1, f"a\n{passage}\nb"), (2, f"c\n\n{passage}\nd"), (3, passage), (4, f"\n{passage}\n\n{passage}\n")]
    found = {r.doc_id: r.text for r in linededup.dedup_lines(spark.createDataFrame(rows, EMPTY)).collect()}
    assert found == {0: rows[0][1], 1: rows[1][1], 2: "c\n\nd", 3: "", 4: ""}
    assert all(found[r[0]] == brute_line_dedup(rows)[r][0] for r in rows)


@pytest.mark.parametrize(("n", "words"), [(2, 30), (3, 20), (5, 12), (2, 13)])
def test_edges_of_repeated_passages_and_short_ones_go(spark, n, words):
    passage = "\n".join(" ".join(f"w{k}x{j}" for j in range(words)) for k in range(n))
    rows = [(d, f"before {d}\nand {d * 7}\n{passage}\nafter {d}\nend {d * 3}") for d in range(60)]
    found = {r.doc_id: r.text for r in linededup.dedup_lines(spark.createDataFrame(rows, EMPTY)).collect()}
    assert found == {d: t if d == 0 else f"before {d}\nand {d * 7}\nafter {d}\nend {d * 3}" for d, t in rows}


def test_line_dedup_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    lines = ["", "ok", "a common sentence", "\tx y\u2003z  "] + [" ".join(rng.choice(["aa", "bb\u00a0cc", "dd", "ee\tff"], rng.integers(1, 60))) for _ in range(12)]
    rows = [(i, "\n".join(lines[k] for k in rng.integers(0, len(lines), rng.integers(1, 30)))) for i in range(120)]
    rows += [(500, "\n".join(["five words in this line"] * 45)), (501, None), (502, ""), (502, ""), rows[3], rows[3], (None, rows[5][1] + "\nmore")]
    right = brute_line_dedup([(-1 if i is None else i, t) for i, t in rows])
    for r in linededup.dedup_lines(spark.createDataFrame(rows, EMPTY).withColumn("old", F.col("text"))).collect():
        assert r.old is None and r.text is None or (r.text, r.removed_lines) == right[-1 if r.doc_id is None else r.doc_id, r.old]


def brute_links(texts):
    sets = []
    for t in texts:
        w = plain(t).split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return [(a, b) for a in range(len(sets)) for b in range(a) if sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]


def test_similar_documents(spark, docs, monkeypatch):
    base = " ".join(f"word{i % 97}{i % 13}" for i in range(200))
    near = [base.replace(f"word{k}{k} ", f"other{k} ", 1) if k else base for k in range(12)]
    rows = texts_of(docs.where("doc_id is not null")) + [(10_000 + k, t) for k, t in enumerate(near)] + [(10_100, base), (10_101, "two words"), (10_102, "Two, words")]
    frame = spark.createDataFrame(rows, EMPTY)
    texts = list(dict.fromkeys(t for _, t in rows if t is not None))
    links = brute_links(texts)
    degree = Counter(x for pair in links for x in pair)
    up = list(range(len(texts)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        up[root(a)] = root(b)
    least = {}
    for i, t in rows:
        if t is not None:
            least[root(texts.index(t))] = min(least.get(root(texts.index(t)), i), i)
    expected = {(i, i if t is None else least[root(texts.index(t))], 0 if t is None else degree[texts.index(t)]) for i, t in rows}
    for small in (jaccard.SMALL, 4):
        monkeypatch.setattr(jaccard, "SMALL", small)
        found = jaccard.classes(frame)
        assert {(r.doc_id, r.class_id, r.n_links) for r in found.collect()} == expected and found.count() == len(rows)
    kept = jaccard.keep_one(frame.withColumn("key", F.lit("clash")))
    assert kept.columns == ["doc_id", "text", "key"] and kept.count() == len(set(least.values())) + sum(t is None for _, t in rows)
    assert jaccard.classes(frame.limit(0)).count() == 0


def test_one_document_of_each_class_stays_whatever_the_ids(spark):
    words = [" ".join(f"{kind}{i}" for i in range(40)) for kind in ("apple", "pear", "plum", "fig", "kiwi")]
    rows = [(None, words[0]), (None, words[1]), (None, words[1]), (5, words[2]), (3, words[2]), (5, words[3]), (None, words[3]), (7, words[3] + " more"), (3, words[4]), (9, words[4]), (None, None), (5, None)]
    rows += [(4, "one two"), (4, "one two"), (None, ""), (1, "")]
    frame = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, _key int")
    kept = jaccard.keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted([(r.doc_id, r.text) for r in kept.collect()], key=str) == sorted(
        [(None, words[0]), (None, words[1]), (3, words[2]), (5, words[3]), (3, words[4]), (None, None), (5, None), (4, "one two"), (1, "")], key=str
    )
    assert jaccard.keep_one(frame.limit(0)).count() == 0


def test_elias_fano_and_trie(tmp_path):
    rng = np.random.default_rng(3)
    for values in (rng.integers(0, 2**63, 500, dtype=np.uint64) * np.uint64(2), np.arange(50, dtype=np.uint64), np.array([2**64 - 1], np.uint64), np.array([], np.uint64)):
        values = np.unique(values)
        sequence = EliasFano.build(values)
        if len(values):
            assert (sequence[np.arange(len(values))] == values).all() and (sequence.find(values) == np.arange(len(values))).all()
        others = np.setdiff1d(rng.integers(0, 2**63, 200, dtype=np.uint64), values)
        assert (sequence.find(others) == -1).all()
    trie = NgramTrie.build(np.array([5, 2**60], np.uint64), np.array([3, 9, (1 << 40) | 3], np.uint64), np.array([1, 90_000, 7]))
    (tmp_path / "trie").write_bytes(trie.to_bytes())
    types, codes = NgramTrie.mapped(str(tmp_path / "trie")).lookup(np.array([5, 6, 2**60], np.uint64), np.array([2, 1, 2]), np.array([3, 9, 3, 3, 9], np.uint64))
    assert types.tolist() == [2, 0, 1] and codes.tolist()[0] == 1 and codes.tolist()[2:] == [0, 7, 0] and codes[1] > 32_767


def test_language_model_matches_plain_counts(spark, docs, monkeypatch):
    monkeypatch.setattr(lm, "BATCH_BYTES", 60_000)
    monkeypatch.setattr(lm, "SHARD_BYTES", 60_000)
    found = lm.score_documents(docs).collect()
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = lambda t: re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low)) + ["\n"]
    train = lambda i: zlib.crc32(str(i if i is not None else "").encode()) % 10 != 0
    words, pairs = Counter(), Counter()
    for i, t in texts_of(docs):
        if train(i):
            words.update(tokens(t))
            pairs.update(zip(["\r", *tokens(t)], tokens(t), strict=False))
    n, v = sum(words.values()), len(words)
    own = Counter()
    for (a, _), c in pairs.items():
        own[a] += c
    by_key = {(r.doc_id, r.n_tokens): r for r in found}
    assert len(found) == docs.count()
    for i, t in texts_of(docs):
        w = tokens(t)
        r = by_key[i, len(w)]
        base = [(words[x] + 0.1) / (n + 0.1 * (v + 1)) for x in w]
        p = [(pairs[a, x] + lm.PRIOR * b) / (own[a] + lm.PRIOR) for a, x, b in zip(["\r", *w], w, base, strict=False)]
        assert (r.held_out, r.n_known, r.train_tokens) == (not train(i), sum(words[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(map(math.log10, base)), rel=1e-9)
        assert r.score == pytest.approx(sum(map(math.log10, p)), rel=1e-6)
    assert lm.score_documents(docs.limit(0)).count() == 0 and lm.model(docs).count() > 0


def test_licences(spark, docs):
    rows = [(1, "Hello\nReleased under the MIT License.\nBye"), (2, "licensed under the apache license, version 2.0"), (3, "The license of the driver was under review."), (4, None), (5, ""), (6, "All rights reserved.\nLicensed under CC BY-NC 4.0.")]
    frame = spark.createDataFrame(rows, EMPTY).withColumn("families", F.lit("clash"))
    model = license.fit(docs)
    found = {r.doc_id: r for r in license.scan(frame, model).collect()}
    assert [found[k].families for k in range(1, 7)] == [["mit"], ["apache-2.0"], [], [], [], ["cc-by-nc-4.0", "proprietary"]]
    assert [found[k].n_paragraphs for k in range(1, 7)] == [3, 1, 1, 0, 0, 2] and found[1].licenses[0].paragraph == 1
    for texts in license.TEMPLATES.values():
        for t in texts:  # the words of the driver's side and of the column are the same
            assert spark.range(1).select(F.array_distinct(license.words_of(F.lit(t)))).first()[0] == license._split_words(t)
    assert license.scan(frame.limit(0), model).count() == 0


def test_licences_wrapped_over_lines(spark, docs):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files, to deal in the Software\nwithout restriction."
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:"
    gpl = "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3."
    rows = [(1, f"Title\n\n{mit}\n\nmore"), (2, f"Some words go before it\n{bsd}\nand after"), (3, gpl), (4, mit.replace("\n", "\n\n")), (5, f"{mit}\n\n{gpl}\n\n{mit}")]
    found = {r.doc_id: r for r in license.scan(spark.createDataFrame(rows, EMPTY), license.fit(docs)).collect()}
    assert [found[k].families for k in range(1, 6)] == [["mit"], ["bsd-3-clause"], ["gpl-3.0"], [], ["gpl-3.0", "mit"]]
    assert [[x.paragraph for x in found[k].licenses if x.confirmed] for k in (1, 2, 3, 5)] == [[2], [1], [0], [0, 4, 8]]


def test_digest_of_items():
    assert decontaminate.items_digest(["10", "9"]) == hashlib.sha256(b"10,9").hexdigest()


@pytest.fixture
def tasks_made(spark, monkeypatch):
    """The functions given to pandas_udf and mapInPandas, as Python workers call them."""
    frame = type(spark.range(1))
    made, udf, over = [], F.pandas_udf, frame.mapInPandas
    monkeypatch.setattr(F, "pandas_udf", lambda *a, **b: udf(*a, **b) if b else lambda f: made.append(f) or udf(*a)(f))
    monkeypatch.setattr(frame, "mapInPandas", lambda df, f, kind, **more: made.append(f) or over(df, f, kind, **more))
    return made


def test_workers_let_a_batch_go_before_the_next_is_read(spark, tasks_made):
    some = [f"word{k} and some more words of text number {k}" for k in range(6)]
    bpe.bpe_columns(spark, PATH)
    encode, decode, both = tasks_made
    ids = [b"\x01\0\0\0"] * 3
    language.predict(language.CompressionModel(("de", "en"), (b"der die das und nicht", b"the and some more words")), F.col("text"))
    decontaminate.scan_column([("a", some[0])], F.col("text"), 3)
    jaccard._sketched(spark.createDataFrame([(b"a", "a")], "key binary, text string"), 5)
    jaccard._exact_links(spark.createDataFrame([], "root binary, i int, j int, own int, key binary, text string, shingles int"), 5, 0.8)
    assert len(tasks_made) == 7
    for task in tasks_made:
        frames = task in tasks_made[5:]
        made, alive = 0, []

        def batches(task=task, frames=frames, alive=alive):
            for k in range(3):
                assert not any(old() is not None for old in alive), task
                texts = pd.Series(ids if task is decode else some[2 * k : 2 * k + 2] + [None])
                batch = pd.DataFrame({"key": [b"a", b"b", b"c"], "text": texts}) if frames else texts
                alive.append(weakref.ref(batch))
                yield batch
                del batch, texts

        for out in task(batches()):
            made += len(out)
            del out
        assert made == (6 if task is tasks_made[5] else 9) and len(alive) == 3


def test_language_fit_starts_no_python_workers(spark, docs, monkeypatch):
    """Rows of Python given to createDataFrame would be read by workers of their own in every executor."""
    before = language.fit(docs.select("text", "lang"))
    assert before.languages
    monkeypatch.setattr(type(spark.sparkContext), "parallelize", lambda *a, **b: pytest.fail("rows went through Python workers"))
    assert language.fit(docs.select("text", "lang")) == before
