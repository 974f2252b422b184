"""Line dedup with content-defined spans of lines, in built-in functions only.

Lines are hashed. From each line on, the shortest span of at least ``min_lines`` lines and ``min_words`` words is a key, and so is the shortest one that ends with it; a line of
``long_words`` words or more is a key by itself. Where a span begins and ends depends on its own lines alone: an inserted line shifts nothing after it. Spans with
equal hashes are repeated text; the first occurrence (by id, then text, then place) stays.

Each passage of at least ``min_lines`` lines and ``min_words`` words is the union of such spans: they start at each line from which it is still long enough, end at each one up to which it
is, and one of them has any other line. So a line goes exactly if it lies in a passage of this length, or is a long line, that occurs before without overlap, whatever
else its lines occur in. Spans of a document that continue each other both here and at the first occurrence are one run, which is compared byte by byte with the text it repeats, and removed.

What travels: one narrow row per span (written once, read twice), the text of runs to be removed, and the documents twice (to fetch the first occurrences, to remove the runs).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deltaextract.llm.common import checkpointed

MIN_LINES, MIN_WORDS, LONG_WORDS = 2, 25, 50
# Lines whose words are added up at a time, as a power of two.
_BLOCK_BITS = 5
_KEY = ("_k1", "_k2")
# What str.split() takes for white space; single characters below 256 are one look-up in a table, and one range keeps most others from being compared with each.
_SPACE = r"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]]+"


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``docs`` with two independent 64-bit hashes of id and text: rows alike in both are one document here."""
    i, t = F.col(f"`{doc_id}`"), F.col(f"`{text}`")
    return docs.withColumns({"_k1": F.xxhash64(i, t), "_k2": F.xxhash64(t, F.lit("second"), i)})


def _words(text: Column) -> Column:
    """Number of words, by any white space."""
    return F.size(F.array_remove(F.split(text, _SPACE), ""))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    # A one-element array names what is used often, so that it is computed once.
    return F.transform(F.array(value), body)[0]


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def _before(counts: Column) -> Column:
    """Sum of the counts before each place: those of whole blocks, then those within its block."""
    size = 1 << _BLOCK_BITS
    blocks = F.transform(F.sequence(F.lit(0), F.shiftright(F.size(counts) - 1, _BLOCK_BITS)), lambda b: _sum(F.slice(counts, b * size + 1, F.lit(size))))

    def within(base: Column) -> Column:
        return F.transform(counts, lambda _, i: F.get(base, F.shiftright(i, _BLOCK_BITS)) + _sum(F.slice(counts, i - i % size + 1, i % size)))

    return _let(blocks, lambda sums: _let(F.transform(sums, lambda _, b: _sum(F.slice(sums, F.lit(1), b))), within))


def spans(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", min_lines: int = MIN_LINES, min_words: int = MIN_WORDS, long_words: int = LONG_WORDS
) -> DataFrame:
    """One row per span: keys and id of its document, first line ``start``, ``n`` lines, hash ``h``."""
    lines = _keyed(docs, doc_id, text).where(F.col(f"`{text}`").isNotNull()).select(*_KEY, F.col(f"`{doc_id}`").alias("_id"), F.split(f"`{text}`", "\n").alias("_lines"))
    hashed = lines.select(*_KEY, "_id", F.transform("_lines", lambda x: F.xxhash64(x)).alias("_h"), F.transform("_lines", _words).alias("_w"))

    def found(w: Column) -> Column:
        # The line of each word, and the words before each line.
        line_of = F.flatten(F.transform(w, lambda n, i: F.array_repeat(i, n)))
        return _let(line_of, lambda at: _let(_before(w), lambda c: _let(ends(w, at, c), lambda e: every(w, at, c, e))))

    def ends(w: Column, at: Column, c: Column) -> Column:
        return F.transform(w, lambda _, i: _let(F.get(at, F.get(c, i) + min_words - 1), lambda last: F.when(last.isNotNull(), F.greatest(last, i + min_lines - 1))))

    def every(w: Column, at: Column, c: Column, e: Column) -> Column:
        ahead = F.transform(e, lambda end, i: F.struct(i.alias("start"), (end - i + 1).alias("n")))
        first = F.transform(w, lambda n, i: _let(F.get(at, F.get(c, i) + n - min_words), lambda line: F.when(line.isNotNull(), F.least(line, i - min_lines + 1))))
        # Those that are also the shortest from their first line on are there already.
        back = F.transform(first, lambda b, i: F.struct(b.alias("start"), F.when(F.get(e, b) != i, i - b + 1).alias("n")))
        alone = F.transform(w, lambda n, i: F.struct(i.alias("start"), F.when(n >= long_words, 1).alias("n")))
        return F.filter(F.concat(ahead, back, alone), lambda s: s["n"].isNotNull() & (s["start"] >= 0) & (s["start"] + s["n"] <= F.size(w)))

    cut = hashed.select(*_KEY, "_id", _let(F.struct("_h", "_w"), lambda d: F.transform(found(d["_w"]), lambda s: F.struct(s["start"].alias("start"), s["n"].alias("n"), F.xxhash64(F.slice(d["_h"], s["start"] + 1, s["n"])).alias("h")))).alias("_s"))
    # Spark filters what explode() reads by its size, for which it would compute the spans again.
    return cut.select(*_KEY, "_id", F.explode_outer("_s").alias("s")).where(F.col("s").isNotNull()).select(*_KEY, "_id", "s.*")


def repeated_runs(docs: DataFrame, **settings: int | str) -> DataFrame:
    """Runs that repeat earlier text by their hashes, without overlap: document keys, ``start``, ``n``, and the same place in the first occurrence (``_f1 _f2 _fs``)."""
    found = checkpointed(spans(docs, **settings))
    first = found.groupBy("h", "n").agg(F.min(F.struct("_id", *_KEY, "start")).alias("f"), F.count(F.lit(1)).alias("_times")).where("_times > 1").select("h", "n", "f")
    # Rows alike in id and text are the same place. A span that overlaps its first occurrence repeats only itself.
    elsewhere = (F.col("_k1") != F.col("f._k1")) | (F.col("_k2") != F.col("f._k2")) | (F.col("start") >= F.col("f.start") + F.col("n"))
    again = found.join(first, ["h", "n"]).where(elsewhere)
    flat = again.select(*_KEY, "start", "n", F.col("f._k1").alias("_f1"), F.col("f._k2").alias("_f2"), F.col("f.start").alias("_fs"))
    # Of each span, what those before it have not covered; nothing is left of copies.
    in_order = Window.partitionBy(*_KEY).orderBy("start", F.desc("n"))
    covered = F.max(F.col("start") + F.col("n")).over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    skipped = F.greatest(F.coalesce(covered, F.lit(0)) - F.col("start"), F.lit(0))
    pieces = flat.withColumn("_skip", skipped).where("_skip < n").select(*_KEY, "_f1", "_f2", (F.col("start") + F.col("_skip")).alias("start"), (F.col("n") - F.col("_skip")).alias("n"), (F.col("_fs") + F.col("_skip")).alias("_fs"))
    # A run: pieces that follow each other both here and at the first occurrence.
    by_doc = Window.partitionBy(*_KEY).orderBy("start")
    same = (F.lag("_f1").over(by_doc) == F.col("_f1")) & (F.lag("_f2").over(by_doc) == F.col("_f2"))
    follows = same & (F.lag(F.col("start") + F.col("n")).over(by_doc) == F.col("start")) & (F.lag(F.col("_fs") + F.col("n")).over(by_doc) == F.col("_fs"))
    numbered = pieces.withColumn("_new", F.when(F.coalesce(follows, F.lit(False)), 0).otherwise(1)).withColumn("_run", F.sum("_new").over(by_doc))
    return numbered.groupBy(*_KEY, "_run", "_f1", "_f2").agg(F.min("start").alias("start"), F.sum("n").cast("int").alias("n"), F.min("_fs").alias("_fs")).drop("_run")


def _text_of(lines: Column, start: Column, n: Column) -> Column:
    return F.array_join(F.slice(lines, start + 1, n), "\n")


def dedup_lines(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **settings: int) -> DataFrame:
    """``docs`` without repeated runs of lines; its columns, and ``removed_lines`` and ``removed_chars`` (which replace columns of these names).

    Rows stay, also those that lose all their text (it becomes empty). Null texts stay null. Rows alike in id and text are one
    document: none repeats the other, and both lose the same lines. Ties between documents go to the smaller id (null first), then to a
    hash of the text. Within a document, later repeats of a run go too. An empty table gives an empty one.
    """
    runs = repeated_runs(docs, doc_id=doc_id, text=text, **settings)
    sources = runs.select("_f1", "_f2", "_fs", "n").distinct()
    wanted = sources.groupBy(F.col("_f1").alias("_k1"), F.col("_f2").alias("_k2")).agg(F.collect_list(F.struct("_fs", "n")).alias("_wanted"))
    # The id is kept until rows alike are one: where docs have no other columns, Spark deals these rows out once for both joins.
    texts = _keyed(docs.select(*[c for c in docs.columns if c in (doc_id, text)]), doc_id, text)
    first_text = (
        texts.join(wanted, list(_KEY))
        .dropDuplicates([*_KEY, doc_id])
        .withColumn("_lines", F.split(f"`{text}`", "\n"))
        .select(F.col("_k1").alias("_f1"), F.col("_k2").alias("_f2"), F.explode(F.transform("_wanted", lambda w: F.struct(w["_fs"].alias("_fs"), w["n"].alias("n"), _text_of(F.col("_lines"), w["_fs"], w["n"]).alias("_first")))).alias("w"))
        .select("_f1", "_f2", "w.*")
    )
    removals = runs.join(first_text, ["_f1", "_f2", "_fs", "n"]).groupBy(*_KEY).agg(F.array_sort(F.collect_list(F.struct("start", "n", F.col("_first").alias("first")))).alias("_runs"))
    rows = _keyed(docs.drop("removed_lines", "removed_chars"), doc_id, text).join(removals, list(_KEY), "left").withColumn("_lines", F.when(F.col("_runs").isNotNull(), F.split(f"`{text}`", "\n")))
    # Byte comparison: only runs whose text is that of the first occurrence go.
    equal = F.filter("_runs", lambda r: _text_of(F.col("_lines"), r["start"], r["n"]) == r["first"])
    rows = rows.withColumn("_runs", F.transform(equal, lambda r: F.struct(r["start"].alias("start"), r["n"].alias("n"))))
    gone = F.aggregate("_runs", F.lit(0), lambda a, r: a + r["n"])
    # The lines between the runs, joined: from the end of each run (and line 0) to the start of the next (and the last line).
    ends = F.concat(F.array(F.lit(0)), F.transform("_runs", lambda r: r["start"] + r["n"]))
    stops = F.concat(F.transform("_runs", lambda r: r["start"]), F.array(F.size("_lines")))
    kept = F.flatten(F.zip_with(ends, stops, lambda a, b: F.slice("_lines", a + 1, F.greatest(b - a, F.lit(0)))))
    cleaned = F.when(F.size("_runs") > 0, F.array_join(kept, "\n")).otherwise(F.col(f"`{text}`"))
    out = rows.withColumns({"removed_lines": F.when(F.size("_runs") > 0, gone).otherwise(0), "_cleaned": cleaned})
    out = out.withColumn("removed_chars", F.coalesce(F.length(f"`{text}`") - F.length("_cleaned"), F.lit(0)))
    columns = [F.col("_cleaned").alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns if c not in ("removed_lines", "removed_chars")]
    return out.select(*columns, "removed_lines", "removed_chars")
