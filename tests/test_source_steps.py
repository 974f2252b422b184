"""Queries over a small data folder of their own join its tables once, whatever number of folders, runs and outputs they write."""

import datetime as dt

import pytest

from deltaextract.plans import queries as module


@pytest.fixture
def tables(spark, tmp_path):
    day = dt.datetime(1996, 5, 1)
    orders = [(i, i % 4, "OF"[i % 2], 10.0 * i, day.replace(year=1995 + i % 6), "1-URGENT") for i in range(1, 61)]
    lines = [(o[0], 1, 1, n, 1.0, 2.0, 0.0, 0.0, "RNA"[n % 3], "O", day) for o in orders for n in (1, 2)]
    written = {
        "customer": ([(i, f"c{i}", i % 2, 1.0, ("BUILDING", "OTHER")[i % 2]) for i in range(4)], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": (
            lines,
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
        ),
        "nation": ([(0, "A", 0), (1, "B", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(0, "ASIA"), (1, "EUROPE")], "r_regionkey int, r_name string"),
        "conversations": ([(1, 1, "user", "hi")], "conv_id long, turn long, role string, text string"),
    }
    for name, (rows, schema) in written.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.mark.parametrize(("name", "step", "frames"), [("control_file", "write_delivery", 3), ("run_feed", "_write_folders", 4), ("run_feed_without_fy", "_write_folders", 6), ("run_feed_retired_folder", "_write_folders", 4)])
def test_sources_are_joined_once(spark, tables, monkeypatch, capsys, name, step, frames):
    plans, original = [], getattr(module, step)

    def watched(frame, *args, **options):
        plans.append(frame._jdf.queryExecution().optimizedPlan().toString())
        return original(frame, *args, **options)

    monkeypatch.setattr(module, step, watched)
    assert module.queries()[name](spark, tables).count() > 0
    assert len(plans) == frames
    assert not [p for p in plans if "Join" in p]


def test_control_file_lists_each_part_once(spark, tables, monkeypatch):
    monkeypatch.setattr(module, "CONTROL_TARGET", 25)
    lines = [r.line for r in module.queries()["control_file"](spark, tables).collect()][1:]
    names = [x.split("|~|")[0] for x in lines]
    assert sorted(names) == [f"child/part-0000{i}" for i in range(5)] + ["conversations/part-00000"] + [f"parent/part-0000{i}" for i in range(3)]
    assert {x.split("|~|")[1] for x in lines if x.startswith("child")} == {"120"}
