"""Fingerprints: order, duplicates, nulls, skewed keys, and every physical path giving the same answer."""

import hashlib
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from deltaextract.config import EntitySpec
from deltaextract.operators import CohortLists, KeyFilter, cohort_fingerprint, cohort_keys, family_changes, fingerprint
from deltaextract.sources import read_buckets, write_buckets

SPEC = EntitySpec.from_mapping("e", {"columns": ["id", "a", "b", "c"], "keys": ["id"], "encrypt": ["a"]})
SCHEMA = "id long, fy string, a string, b string, c string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    groups = {}
    for key, fy, *values in rows:
        if key is not None:
            groups.setdefault((key, fy), []).append(sha("~".join(v for v in values if v is not None)))

    def digest(hashes):
        return sha("~".join([*[str(sum(int(h[15 * k : 15 * k + 15], 16) for h in hashes)) for k in range(4)], str(len(hashes))]))

    return {g: (digest(d), len(d)) for g, d in groups.items()}


def run(spark, rows, keys=None, spec=SPEC, **options):
    source = spark.createDataFrame(rows, SCHEMA)
    cohort = source.select("id", "fy").distinct() if keys is None else spark.createDataFrame(keys, "id long, fy string")
    found = fingerprint(source, cohort, spec, "fy", **options).collect()
    assert len({(r.id, r.fy) for r in found}) == len(found)
    return {(r.id, r.fy): (r.hash, r.hash_count) for r in found}


ROWS = [
    (1, "2012/13", "x", "y", "z"),
    (1, "2012/13", "x", "y", "z"),
    (1, "2012/13", "x", None, "z"),
    (1, "2013/14", "x", "y", "z"),
    (2, None, None, None, None),
    (None, "2012/13", "lost", "lost", "lost"),
]


def test_values_match_a_plain_computation(spark):
    assert run(spark, ROWS) == expected(ROWS)


def test_row_order_does_not_matter(spark):
    rows = ROWS * 3
    random.Random(7).shuffle(rows)
    assert run(spark, rows) == expected(ROWS * 3)


def test_duplicate_rows_and_edits_matter(spark):
    base = run(spark, ROWS)[(1, "2012/13")]
    assert run(spark, [*ROWS, ROWS[0]])[(1, "2012/13")] != base
    assert run(spark, [(1, "2012/13", "x", "y", "Z"), *ROWS[1:]])[(1, "2012/13")] != base


def test_joined_encoding_skips_nulls_and_framed_does_not(spark):
    left, right = [(1, "f", "a", None, "b")], [(1, "f", "a", "b", None)]
    assert run(spark, left) == run(spark, right)
    assert run(spark, left, encoding="framed") != run(spark, right, encoding="framed")
    blank = [(1, "f", None, None, None)], [(1, "f", "", None, None)]
    assert run(spark, blank[0], encoding="framed") != run(spark, blank[1], encoding="framed")
    with pytest.raises(ValueError):
        run(spark, left, encoding="other")


def test_keys_in_two_periods_match_once_unless_fanned_out(spark):
    keys = [(1, "2012/13"), (1, "2013/14")]
    assert {g: n for g, (_, n) in run(spark, ROWS, keys).items()} == {(1, "2012/13"): 3, (1, "2013/14"): 1}
    fanned = run(spark, ROWS, keys, fan_out=True)
    assert {g: n for g, (_, n) in fanned.items()} == {(1, "2012/13"): 6, (1, "2013/14"): 2}


def test_only_cohort_keys(spark):
    assert set(run(spark, ROWS, [(2, "other")])) == {(2, None)}


def skewed_rows():
    """A third of all rows in one group, a third of those copies of one row, and a hot group without FY."""
    rows = [(1, "2012/13", str(i), "y", None) for i in range(200)] + [(1, "2012/13", "copy", "y", None)] * 100
    rows += [(2, None, str(i), None, "z") for i in range(60)]
    rows += [(10 + i, "2012/13", str(j), "y", "z") for i in range(200) for j in range(3)]
    return rows


def test_hot_keys_hash_alike_however_they_are_partitioned(spark):
    rows = skewed_rows()
    assert run(spark, rows) == expected(rows)
    source = spark.createDataFrame(rows, SCHEMA)
    for spread in (source.coalesce(1), source.repartition(7), source.repartition(5, "a")):
        found = fingerprint(spread, source.select("id", "fy").distinct(), SPEC, "fy").collect()
        assert {(r.id, r.fy): (r.hash, r.hash_count) for r in found} == expected(rows)


def test_hash_sees_edits_copies_swaps_and_not_order(spark):
    rows = skewed_rows()
    base = run(spark, rows)
    shuffled = rows[:]
    random.Random(3).shuffle(shuffled)
    assert run(spark, shuffled) == base
    one_copy_edited = [*rows[:299], (1, "2012/13", "copy!", "y", None), *rows[300:]]
    changed = run(spark, one_copy_edited)
    assert {g for g in base if base[g] != changed[g]} == {(1, "2012/13")}
    one_copy_for_another = [*rows[:199], rows[299], *rows[200:]]
    assert run(spark, one_copy_for_another)[(1, "2012/13")] != base[(1, "2012/13")]


def test_hot_keys_respect_cohort_and_fan_out(spark):
    assert set(run(spark, skewed_rows(), [(1, "x"), (11, "x")])) == {(1, "2012/13"), (11, "2012/13")}
    assert run(spark, skewed_rows(), [(1, "x"), (1, "y")], fan_out=True)[(1, "2012/13")][1] == 600


def test_filter_limits_what_is_hashed(spark):
    spec = EntitySpec.from_mapping("e", {"columns": ["id", "a"], "keys": ["id"], "filter": "c = 'z'"})
    rows = [(1, "f", "a", "b", "z"), (1, "f", "a", "b", "q")]
    assert run(spark, rows, spec=spec)[(1, "f")][1] == 1


text = st.one_of(st.none(), st.text(alphabet="ab~", max_size=2))
row = st.tuples(st.integers(1, 3), st.sampled_from(["f1", "f2"]), text, text, text)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=12))
def test_any_rows_match_a_plain_computation(spark, rows):
    assert run(spark, rows) == expected(rows)


def test_sums_combine_before_the_shuffle(spark):
    source = spark.createDataFrame(ROWS, SCHEMA)
    plan = fingerprint(source, source.select("id", "fy").distinct(), SPEC, "fy")._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "collect_list" not in plan and "SortAggregate" not in plan


def test_a_key_filter_keeps_the_cohort_and_drops_most_others(spark):
    cohort = spark.range(0, 40_000, 4).select(F.col("id").cast("int").alias("id"))
    made = KeyFilter.of(cohort, ["id"])
    assert made.bits == 1 << 18 and made.bitmaps.count() <= made.bits >> 15
    source = spark.range(40_000).union(spark.sql("SELECT cast(NULL AS bigint)"))
    passed = {r.id for r in made.keep(source, ["id"]).collect()}
    assert set(range(0, 40_000, 4)) <= passed and None not in passed
    assert len(passed) - 10_000 < 0.1 * 30_000
    # Text equal to a number may have another bit, so such keys are left to the join.
    text = source.select(F.col("id").cast("string").alias("id"))
    assert not made.fits(text, ["id"]) and made.keep(text, ["id"]) is text
    assert KeyFilter.of(cohort.limit(0), ["id"]).keep(source, ["id"]).count() == 0


def test_a_key_filter_on_several_keys_changes_no_fingerprint(spark):
    spec = EntitySpec.from_mapping("e", {"columns": ["id", "a", "b", "c"], "keys": ["id", "a"], "filter": "c <> 'q'"})
    source = spark.createDataFrame(skewed_rows() + ROWS, SCHEMA)
    cohort = source.where("id % 3 = 1").select("id", "a", "fy").distinct()
    plain = fingerprint(source, cohort, spec, "fy")
    filtered = fingerprint(source, cohort, spec, "fy", key_filter=KeyFilter.of(cohort, ["id", "a"]))
    assert sorted(map(str, filtered.collect())) == sorted(map(str, plain.collect())) != []


def test_the_key_filter_lies_below_hashing(spark):
    source = spark.createDataFrame(skewed_rows(), SCHEMA)
    cohort = source.where("id = 11").select("id", "fy").distinct()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = fingerprint(source, cohort, SPEC, "fy", key_filter=KeyFilter.of(cohort, ["id"]))
        plan = frame._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # Deeper in the plan means further down in its text.
    assert plan.index("SortMergeJoin") < plan.index("partial_sum") < plan.index("sha2") < plan.index("BroadcastHashJoin") < plan.index("bitmap_construct_agg")


@pytest.mark.parametrize("small", [True, False])
def test_one_pass_finds_the_cohort_and_its_fingerprints(spark, tmp_path, small):
    rows = [
        (1, "f1", "A", "x", "1"),
        (1, "f1", "n", "n", "2"),
        (1, "f2", "n", "n", "3"),  # taken along by its key
        (2, "f1", "n", "y", "4"),
        (2, None, "A", "y", "5"),
        (3, "f1", "n", "n", "6"),
        (None, "f1", "A", "x", "7"),
        *[(4, "f1", "n", "n", str(i)) for i in range(50)],
    ]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/rows")
    source = spark.read.parquet(f"{tmp_path}/rows")
    orgs = [spark.createDataFrame([(v,), (None,)], "org_code string").distinct() for v in ("A", "y")]
    lists = CohortLists.measure(list(zip(orgs, ("a", "b"), strict=True)), **{} if small else {"broadcast_bytes": 0})
    found = cohort_fingerprint(source, lists, SPEC, "fy")
    cohort = cohort_keys(source, lists, SPEC, "fy").dropna(subset=["id"])
    assert sorted(map(str, found.drop("matched").collect())) == sorted(map(str, fingerprint(source, cohort, SPEC, "fy").collect()))
    assert {(r.id, r.fy) for r in found.where("matched").collect()} == {(r.id, r.fy) for r in cohort.collect()} == {(1, "f1"), (2, "f1"), (2, None)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "partial_bool_or" in plan.replace("partial_max(__matched", "partial_bool_or")


def test_fingerprints_in_buckets_are_compared_without_a_shuffle(spark, tmp_path):
    def stored(name, rows, mode="overwrite"):
        frame = spark.createDataFrame(rows, "id long, fy string, hash string, source_period string")
        write_buckets(frame, f"{tmp_path}/{name}", ["id"], "source_period", 3, mode)
        return read_buckets(spark, f"{tmp_path}/{name}", frame.schema, ["id"], 3)

    first = stored("r1", [(i, "f", f"h{i}", "p1" if i % 2 else "p2") for i in range(40)])
    stored("r2", [(i, "f", f"h{i}", "p2") for i in range(0, 40, 4)])
    second = stored("r2", [(100, "f", "h", "p2")], "append")
    assert second.count() == 11 and not [t for t in spark.catalog.listTables() if t.name.startswith("deltaextract_")]
    previous = first.where("source_period IN ('p1')").unionByName(second.where("source_period IN ('p2')"))
    current = stored("r3", [(i, "f", f"h{i}" if i % 10 else "edited", "p1" if i % 2 else "p2") for i in range(41)])
    changes = family_changes([(current, previous), (current.where("id <> 5"), previous)], ["id"], in_place=True)
    plan = changes._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SelectedBucketsCount" in plan
    found = {r.id: (r.changed, r.known, r.lost) for r in changes.collect()}
    new = {i for i in range(0, 40) if i % 2 == 0 and i % 4} | {40}
    assert {i for i, f in found.items() if f[0]} == new | {0, 10, 20, 30}
    assert {i for i, f in found.items() if not f[1]} == new
    assert {i for i, f in found.items() if f[2]} == {5, 100}
    assert sorted(found) == sorted(r.id for r in family_changes([(current, previous)], ["id"]).collect())
    missing = read_buckets(spark, f"{tmp_path}/none", first.schema, ["id"], 3)
    assert missing.count() == 0 and missing.schema == first.schema
