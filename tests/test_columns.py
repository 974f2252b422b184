"""Mapping grammar, transforms, pseudonyms and projections."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from deltaextract.config import ColumnSpec, EntitySpec, FeedSpec
from deltaextract.functions import register_transform, registered_transforms
from deltaextract.operators import extract_delta, live_keys, project, source_rows
from deltaextract.plans import PRESETS, feed_from_preset


def spec(columns, **mapping):
    return EntitySpec.from_mapping("e", {"columns": columns, "keys": ["id"], **mapping})


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(
        [(1, "abcdef", "2024-02-30", None), (2, "xyz", "2024-02-29", "q")], "id long, a string, d string, n string"
    )


def first(frame):
    return frame.orderBy(frame.columns[0]).first().asDict()


def test_column_grammar():
    assert ColumnSpec.parse("a") == ColumnSpec("a", ("a",))
    assert ColumnSpec.parse(["a", "b"]) == ColumnSpec("a", ("b",))
    assert ColumnSpec.parse(["a", ["b", "c"]]) == ColumnSpec("a", ("b", "c"))
    assert ColumnSpec.parse(["", "a"]) == ColumnSpec("a", ("a",))


def test_aliases_and_missing_columns(rows):
    out = project(rows, spec(["id", ["a", ["x", "y"]], ["gone", "renamed"]], encrypt=["gone"], transform={"gone": [["left", [1]]]}))
    assert out.columns == ["id", "x", "y", "gone"]
    assert first(out) == {"id": 1, "x": "abcdef", "y": "abcdef", "gone": ""}


def test_transform_chain_runs_left_to_right(rows):
    steps = [["substring", [2, 4]], ["concat", ["d"]], ["left", [6]], ["instr", ["e"]]]
    assert first(project(rows, spec(["id", "a"], transform={"a": steps})))["a"] == 4


def test_expr_discards_earlier_steps_and_sees_the_row(rows):
    steps = [["left", [1]], ["expr", ["upper(e.a) || id"]]]
    assert first(project(rows, spec(["id", "a"], transform={"a": steps})))["a"] == "ABCDEF1"


def test_to_date_gives_null_for_what_is_no_date(rows):
    out = project(rows, spec(["id", "d"], transform={"d": [["to_date", ["any format"]]]})).orderBy("id").collect()
    assert [r.d for r in out] == [None, dt.date(2024, 2, 29)]


def test_substring_start_zero_behaves_as_one(rows):
    assert first(project(rows, spec(["id", "a"], transform={"a": [["substring", [0, 2]]]})))["a"] == "ab"


def test_unknown_transform_is_an_error_and_own_ones_can_be_added(rows):
    with pytest.raises(ValueError, match="nonesuch"):
        project(rows, spec(["id", "a"], transform={"a": [["nonesuch", []]]}))
    register_transform("shout", lambda column, mark: F.concat(F.upper(column), F.lit(mark)))
    assert "shout" in registered_transforms()
    assert first(project(rows, spec(["id", "a"], transform={"a": [["shout", ["!"]]]})))["a"] == "ABCDEF!"


def test_pseudonym_applies_after_transforms_and_keeps_null(rows):
    mapping = {"encrypt": ["a", "n"], "transform": {"a": [["left", [2]]]}}
    out = first(project(rows, spec(["id", "a", "n"], **mapping), "salt"))
    assert out["a"] == hashlib.sha256(b"saltab").hexdigest().upper()
    assert out["n"] is None
    with pytest.raises(ValueError, match="salt"):
        project(rows, spec(["a"], encrypt=["a"]))


def test_filter_sees_source_values_and_unprojected_columns(rows):
    wanted = spec(["id", ["a", "d"]], filter="d = '2024-02-29' AND e.n = 'q'", encrypt=["id"])
    assert project(source_rows(rows, wanted), wanted, "s").count() == 1


def test_delta_keeps_rows_of_changed_keys_once(spark, rows):
    changed = spark.createDataFrame([(2,), (2,), (None,)], "id long")
    twice = rows.unionByName(rows).unionByName(spark.createDataFrame([(None, "a", None, None)], rows.schema))
    assert [r.id for r in extract_delta(twice, changed, spec(["id"])).collect()] == [2, 2]


def test_live_keys_look_like_delivered_keys(spark):
    snapshot = spark.createDataFrame([(1, "f1", "h", 1), (1, "f2", "h", 1), (2, "f1", "h", 1)], "id long, fy string, hash string, hash_count long")
    wanted = spec([["id", ["one", "two"]], "a"], encrypt=["id"])
    out = live_keys(snapshot, wanted, "s")
    assert out.columns == ["one", "two"] and out.count() == 2
    assert {r.one for r in out.collect()} == {hashlib.sha256(f"s{k}".encode()).hexdigest().upper() for k in (1, 2)}


def test_feed_settings():
    mapping = '{"entities": {"p": {"columns": ["id"], "keys": ["id"], "encrypt": [], "transform": {}, "filter": null}, "c": {"columns": ["id"], "keys": ["id"]}}}'
    tree = {"p": {"basePath": "/in/p", "children": {"c": {"basePath": "/in/c/"}}}}
    for preset in PRESETS:
        feed = feed_from_preset(preset, tree, mapping, output_path="/out", providers_path="/dim/o", gp_path="/dim/g")
        assert [e.name for e in feed.entities] == ["p", "c"] and feed.entities[1].base_path == "/in/c"
        assert feed.target_rows == (20_000_000 if preset == "outpatient" else 10_000_000)
    with pytest.raises(ValueError, match="keys"):
        FeedSpec.build(
            "f",
            tree,
            {"entities": {"p": {"columns": ["id"], "keys": ["id"]}, "c": {"columns": ["x"], "keys": ["x"]}}},
            output_path="/out",
            fy_column="fy",
            datum="d",
            dimensions=(),
        )
