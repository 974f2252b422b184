"""Whole feed runs: bootstrap, delta, nothing to do, crashes, odd data, and a receiver that stays in step."""

import glob
import gzip
import hashlib
import shutil

import pytest
from pyspark.sql import functions as F

import deltaextract.plans.feed as feed_module
from deltaextract.config import Dimension, FeedSpec
from deltaextract.plans import run_feed
from deltaextract.plans.feed import live_key_label
from deltaextract.sources.runs import Overtaken, completed_runs

SALT = "s"
PARENT = "id long, fy string, org string, gp string, a string"
CHILD = "id long, fy string, n int, v string"
MAPPING = {
    "entities": {
        "spell": {"columns": [["id", "key"], "a"], "keys": ["id"], "encrypt": ["id"], "transform": {"a": [["left", [3]]]}},
        "diag": {"columns": [["id", "key"], "n", "v", "later"], "keys": ["id"], "encrypt": ["id"]},
        "open_now": {"columns": ["id", "a"], "keys": ["id"]},
    }
}


def code(key):
    return hashlib.sha256(f"{SALT}{key}".encode()).hexdigest().upper()


class World:
    """Source folders, organisation lists and a feed over them."""

    def __init__(self, spark, base):
        self.spark, self.base = spark, str(base)
        spark.createDataFrame([("O1", "Y"), ("O9", "N")], "code string, region string").write.parquet(f"{base}/orgs")
        spark.createDataFrame([("G1", "Y"), ("G1", "Y")], "code string, region string").write.parquet(f"{base}/gps")
        self.feed = FeedSpec.build(
            "spells",
            {
                "spell": {"basePath": f"{base}/spell", "children": {"diag": {"basePath": f"{base}/diag/"}}},
                "open_now": {"basePath": f"{base}/open"},
            },
            MAPPING,
            output_path=f"{base}/out",
            fy_column="fy",
            datum="Discharge_Date",
            dimensions=(
                Dimension("code", "region", "Y", "org", f"{base}/orgs"),
                Dimension("code", "region", "Y", "gp", f"{base}/gps"),
            ),
        )

    def put(self, entity, folder, rows, schema):
        self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{self.base}/{entity}/{folder}")

    def run(self, **options):
        return run_feed(self.spark, self.feed, SALT, **options)

    def lines(self, run, label):
        found = []
        for path in glob.glob(f"{run.delivery_path}/{label}/*.csv.gz"):
            found += gzip.open(path, "rt").read().splitlines()[1:]
        return sorted(found)


@pytest.fixture
def world(spark, tmp_path):
    w = World(spark, tmp_path)
    w.put("spell", "FY2012-13", [(1, "2012/13", "O1", "G9", "abcd"), (2, "2012/13", "O9", "G1", "b"), (3, "2012/13", "O9", "G9", "no")], PARENT)
    w.put("spell", "FY2013-14", [(4, "2013/14", "O1", None, "d"), (5, "2013/14", "O1", None, "e")], PARENT)
    w.put("diag", "FY2012-13", [(1, "2012/13", 1, "x"), (1, "2012/13", 2, None), (3, "2012/13", 1, "no")], CHILD)
    w.put("diag", "FY2013-14", [(4, "2013/14", 1, "z"), (5, "2013/14", 1, "z")], CHILD)
    return w


def test_three_runs(world):
    first = world.run(run_id="r1")
    assert first.periods == ("2012/13", "2013/14")
    assert first.records == {"spell": 4, "diag": 4, "open_now": 0, "spellDeletes": 4, "open_nowDeletes": 0}
    assert world.lines(first, "spell") == sorted(f"{code(k)}|{a}" for k, a in ((1, "abc"), (2, "b"), (4, "d"), (5, "e")))
    assert world.lines(first, "diag") == sorted(f"{code(k)}|{n}|{v}|" for k, n, v in ((1, 1, "x"), (1, 2, ""), (4, 1, "z"), (5, 1, "z")))
    assert world.lines(first, "spellDeletes") == sorted(code(k) for k in (1, 2, 4, 5))

    # Beyond the first three characters nothing is delivered, so nothing has changed; one child row makes a family change.
    world.put("spell", "FY2013-14", [(4, "2013/14", "O1", None, "d"), (6, "2013/14", "O1", None, "f")], PARENT)
    world.put("spell", "FY2012-13", [(1, "2012/13", "O1", "G9", "abcX"), (2, "2012/13", "O9", "G1", "b")], PARENT)
    world.put("diag", "FY2013-14", [(4, "2013/14", 1, "z"), (4, "2013/14", 2, "new")], CHILD)
    second = world.run(run_id="r2")
    assert world.lines(second, "spell") == sorted([f"{code(4)}|d", f"{code(6)}|f"])
    assert world.lines(second, "diag") == sorted([f"{code(4)}|1|z|", f"{code(4)}|2|new|"])
    assert world.lines(second, "spellDeletes") == sorted(code(k) for k in (1, 2, 4, 6))

    third = world.run(run_id="r3")
    assert not third.changed and third.delivery_path is None


def test_control_file_lists_every_part(world):
    run = world.run()
    (path,) = glob.glob(f"{run.delivery_path}/spells_control/*.csv")
    lines = open(path, encoding="windows-1252", newline="").read().split("\r\n")[1:-1]
    listed = {line.split("|~|")[0]: line.split("|~|")[1:] for line in lines}
    on_disk = {"/".join(p.split("/")[-2:]) for p in glob.glob(f"{run.delivery_path}/*/*.csv.gz")}
    assert set(listed) == on_disk
    totals = {name.split("/")[0]: int(values[0]) for name, values in listed.items()}
    assert totals == {"spell": 4, "diag": 4, "open_now": 0, "spellDeletes": 4, "openDeletes_now": 0}
    assert {tuple(v[1:]) for v in listed.values()} == {("Discharge_Date", "1970-04-01 00:00:00", "2999-01-01 00:00:00")}
    assert live_key_label("Open_Daily_X") == "OpenDeletes_Daily_X" and live_key_label("Open") == "OpenDeletes"


def test_periods_not_read_are_carried_over(world):
    world.run(run_id="r1")
    world.put("diag", "FY2013-14", [(4, "2013/14", 1, "edited"), (5, "2013/14", 1, "z")], CHILD)
    second = world.run(run_id="r2")
    assert second.periods == ("2013/14",)
    assert world.lines(second, "spell") == [f"{code(4)}|d"]
    assert world.lines(second, "spellDeletes") == sorted(code(k) for k in (1, 2, 4, 5))


@pytest.mark.parametrize("every", [1, 30])
def test_snapshots_add_up_however_often_they_are_completed(world, every):
    world.run(run_id="r1")
    for i, value in enumerate(("p", "z"), start=2):
        world.put("diag", "FY2013-14", [(4, "2013/14", 1, value), (5, "2013/14", 1, "z")], CHILD)
        run = world.run(run_id=f"r{i}", full_snapshot_every=every)
        assert world.lines(run, "diag") == [f"{code(4)}|1|{value}|"]
        assert world.lines(run, "spellDeletes") == sorted(code(k) for k in (1, 2, 4, 5))
    world.put("spell", "FY2012-13", [(1, "2012/13", "O1", "G9", "abcd"), (2, "2012/13", "O9", "G1", "b2")], PARENT)
    last = world.run(run_id="r9", full_snapshot_every=every)
    assert world.lines(last, "spell") == [f"{code(2)}|b2"]


def test_a_run_that_dies_changes_nothing(world, monkeypatch):
    world.run(run_id="r1")
    world.put("diag", "FY2013-14", [(4, "2013/14", 1, "edited"), (5, "2013/14", 1, "z")], CHILD)
    with monkeypatch.context() as patch:
        patch.setattr(feed_module, "write_control", lambda *_: (_ for _ in ()).throw(OSError("disk full")))
        with pytest.raises(OSError):
            world.run(run_id="r2")
    for again in ("r2", "r3"):
        run = world.run(run_id=again)
        assert run.changed == (again == "r2")
    assert run.periods == ()


def test_a_repeated_run_replaces_its_own_leftovers(world, monkeypatch):
    with monkeypatch.context() as patch:
        patch.setattr(feed_module, "record_run", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            world.run(run_id="r1")
    assert world.run(run_id="r1").records["spellDeletes"] == 4
    with pytest.raises(ValueError, match="r1"):
        world.run(run_id="r1")


def test_new_columns_and_rows_filed_under_another_period(world):
    world.run(run_id="r1")
    world.put("diag", "FY2013-14", [(4, "2013/14", 1, "z", "new"), (5, "2013/14", 1, "z", None)], CHILD + ", later string")
    second = world.run(run_id="r2")
    # The column exists now: 4 has a value, and 5 changes from "" to null, which the fingerprint tells apart.
    assert world.lines(second, "diag") == sorted([f"{code(4)}|1|z|new", f"{code(5)}|1|z|"])

    world.put("spell", "FY2013-14", [(4, "2013/14", "O1", None, "d"), (1, "2012/13", "O1", None, "moved")], PARENT)
    third = world.run(run_id="r3")
    assert third.periods == ("2013/14",)
    assert world.lines(third, "spell") == [f"{code(1)}|mov"]
    assert world.lines(third, "spellDeletes") == sorted(code(k) for k in (1, 2, 4))


def test_vanished_child_rows_are_sent_on_request(world):
    world.run(run_id="r1")
    world.put("diag", "FY2013-14", [(4, "2013/14", 1, "z")], CHILD)
    assert world.lines(world.run(run_id="r2", detect_vanished=True), "spell") == [f"{code(5)}|e"]


def test_childless_parent_and_entity_without_folders(world):
    world.put("open", "FY2013-14", [(7, "2013/14", "O1", None, "open")], PARENT)
    run = world.run()
    assert world.lines(run, "open_now") == ["7|open"]
    assert world.lines(run, "openDeletes_now") == ["7"]


def test_period_floor_and_hash_setting_guards(spark, world):
    object.__setattr__(world.feed, "fy_floor", 2013)
    assert world.run().periods == ("2013/14",)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with pytest.raises(ValueError, match="time_zone"):
            world.run()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    with pytest.raises(ValueError, match="hash_encoding"):
        world.run(hash_encoding="framed")
    again = world.run(hash_encoding="framed", rehash=True)
    assert again.periods == ("2013/14",)
    assert not world.run(hash_encoding="framed").changed


@pytest.mark.parametrize("detect_vanished", [False, True])
def test_records_that_leave_the_cohort_are_not_sent(world, detect_vanished):
    world.run(run_id="r1")
    # 4 moves to an organisation outside the region; its child rows stay.
    world.put("spell", "FY2013-14", [(4, "2013/14", "O9", None, "d"), (5, "2013/14", "O1", None, "e")], PARENT)
    second = world.run(run_id="r2", detect_vanished=detect_vanished)
    assert not [line for label in ("spell", "diag") for line in world.lines(second, label) if line.startswith(code(4))]
    assert code(4) not in world.lines(second, "spellDeletes")


def test_receiver_stays_in_step(world):
    """Replacing delivered families and dropping keys that are not alive turns the old copy into the new one."""
    states = [
        ([(4, "d", 1), (5, "e", 1)], "r1"),
        ([(4, "d", 2), (6, "f", 1)], "r2"),
        ([(6, "F", 1), (7, "g", 3)], "r3"),
    ]
    copy = {"spell": [], "diag": []}
    for families, run_id in states:
        world.put("spell", "FY2013-14", [(k, "2013/14", "O1", None, a) for k, a, _ in families], PARENT)
        world.put("diag", "FY2013-14", [(k, "2013/14", i, "v") for k, _, n in families for i in range(n)], CHILD)
        run = world.run(run_id=run_id)
        alive = set(world.lines(run, "spellDeletes"))
        sent = {line.split("|")[0] for line in world.lines(run, "spell")}
        for label in copy:
            kept = [line for line in copy[label] if line.split("|")[0] not in sent and line.split("|")[0] in alive]
            copy[label] = sorted(kept + world.lines(run, label))
        older = [f"{code(1)}|abc", f"{code(2)}|b"]
        assert copy["spell"] == sorted(older + [f"{code(k)}|{a}" for k, a, _ in families])
        assert copy["diag"] == sorted(
            [f"{code(1)}|1|x|", f"{code(1)}|2||"] + [f"{code(k)}|{i}|v|" for k, _, n in families for i in range(n)]
        )


def test_rows_without_an_fy_are_sent_once_and_retire(world):
    """Three runs: without changes nothing is sent again, and a removed key leaves the list of live keys."""
    unfiled = [(4, None, "O1", None, "d"), (5, None, "O1", None, "e"), (6, "2013/14", "O1", None, "f")]
    child = [(4, None, 1, "z"), (5, "2013/14", 1, "z"), (6, None, 1, "z")]
    world.put("spell", "FY2013-14", unfiled, PARENT)
    world.put("diag", "FY2013-14", child, CHILD)
    first = world.run(run_id="r1")
    assert world.lines(first, "spellDeletes") == sorted(code(k) for k in (1, 2, 4, 5, 6))

    world.put("spell", "FY2013-14", unfiled, PARENT)
    second = world.run(run_id="r2")
    assert second.changed and world.lines(second, "spell") == [] and world.lines(second, "diag") == []
    assert world.lines(second, "spellDeletes") == sorted(code(k) for k in (1, 2, 4, 5, 6))

    world.put("spell", "FY2013-14", unfiled[1:], PARENT)
    world.put("diag", "FY2013-14", [(4, None, 1, "z"), (5, "2013/14", 1, "z"), (6, None, 1, "new")], CHILD)
    third = world.run(run_id="r3")
    assert world.lines(third, "spell") == [f"{code(6)}|f"]
    assert world.lines(third, "spellDeletes") == sorted(code(k) for k in (1, 2, 5, 6))
    # Also where older rows come from a completed snapshot.
    world.put("spell", "FY2013-14", unfiled[2:], PARENT)
    fourth = world.run(run_id="r4", full_snapshot_every=1)
    assert world.lines(fourth, "spell") == [] and world.lines(fourth, "spellDeletes") == sorted(code(k) for k in (1, 2, 6))


def test_a_row_that_moves_to_another_folder_is_neither_doubled_nor_lost(world):
    world.run(run_id="r1")
    world.put("spell", "FY2012-13", [(1, "2012/13", "O1", "G9", "abcd")], PARENT)
    world.put("spell", "FY2013-14", [(4, "2013/14", "O1", None, "d"), (5, "2013/14", "O1", None, "e"), (2, "2012/13", "O9", "G1", "b")], PARENT)
    moved = world.run(run_id="r2")
    assert world.lines(moved, "spell") == []  # its content is the same
    assert world.lines(moved, "spellDeletes") == sorted(code(k) for k in (1, 2, 4, 5))
    # The old folder changes again: the row is not of it any more.
    world.put("spell", "FY2012-13", [(1, "2012/13", "O1", "G9", "xbcd")], PARENT)
    later = world.run(run_id="r3")
    assert world.lines(later, "spell") == [f"{code(1)}|xbc"]
    assert world.lines(later, "spellDeletes") == sorted(code(k) for k in (1, 2, 4, 5))
    # And it is gone when it is gone from the new one.
    world.put("spell", "FY2013-14", [(4, "2013/14", "O1", None, "d"), (5, "2013/14", "O1", None, "e")], PARENT)
    last = world.run(run_id="r4")
    assert world.lines(last, "spell") == [] and world.lines(last, "spellDeletes") == sorted(code(k) for k in (1, 4, 5))


@pytest.mark.parametrize("retire", [False, True])
def test_a_folder_that_disappears(world, retire):
    world.run(run_id="r1")
    shutil.rmtree(f"{world.base}/spell/FY2013-14")
    second = world.run(run_id="r2", retire_folders=retire)
    assert second.periods == (("2013/14",) if retire else ())
    if retire:
        assert second.records["spell"] == second.records["diag"] == 0
        assert world.lines(second, "spellDeletes") == sorted(code(k) for k in (1, 2))
        assert not world.run(run_id="r3", retire_folders=True).changed
    # The folder comes back, with one of its records.
    world.put("spell", "FY2013-14", [(4, "2013/14", "O1", None, "d")], PARENT)
    back = world.run(run_id="r4", retire_folders=retire)
    assert world.lines(back, "spell") == ([f"{code(4)}|d"] if retire else [])
    assert world.lines(back, "spellDeletes") == sorted(code(k) for k in (1, 2, 4))


def test_of_two_runs_that_overlap_the_first_to_complete_counts(spark, world, monkeypatch):
    world.run(run_id="r1")
    world.put("spell", "FY2013-14", [(4, "2013/14", "O1", None, "d"), (6, "2013/14", "O1", None, "f")], PARENT)
    complete, inner = feed_module._Run.complete, []

    def overtaken(run):
        if run.run_id == "slow":
            inner.append(world.run(run_id="quick"))
        complete(run)

    monkeypatch.setattr(feed_module._Run, "complete", overtaken)
    with pytest.raises(Overtaken, match="quick"):
        world.run(run_id="slow")
    assert world.lines(inner[0], "spell") == [f"{code(6)}|f"]
    assert [r.run_id for r in completed_runs(spark, f"{world.base}/out/state/runs")] == ["r1", "quick"]
    assert not world.run(run_id="r4").changed


def test_of_two_records_of_one_number_the_earlier_one_counts(spark, tmp_path):
    from pyspark.sql import Row

    from deltaextract.sources.runs import RUN_SCHEMA, record_run

    def run(name, seq):
        return Row(seq=seq, run_id=name, fys=[], full=seq == 1, time_zone="UTC", hash_encoding="joined", digest="d", buckets=0)

    path = f"{tmp_path}/runs"
    record_run(spark, path, run("first", 1))
    record_run(spark, path, run("b", 2))
    # As if both had looked before either wrote.
    spark.createDataFrame([run("a", 2)], RUN_SCHEMA).write.mode("append").json(f"{path}/{2:09d}")
    assert [r.run_id for r in completed_runs(spark, path)] == ["first", "b"]
    for late in (run("a", 2), run("c", 1)):
        with pytest.raises(Overtaken):
            record_run(spark, path, late)


def test_a_folder_with_files_of_different_types(spark, world):
    world.run(run_id="r1")
    rows = [(4, "2013/14", 1, "z")]
    world.put("diag", "FY2013-14", rows, CHILD)
    spark.createDataFrame([(5, "2013/14", 2**40, "z")], "id int, fy string, n long, v string").write.mode("append").parquet(f"{world.base}/diag/FY2013-14")
    second = world.run(run_id="r2")
    assert world.lines(second, "diag") == [f"{code(5)}|{2**40}|z|"]


@pytest.mark.parametrize("options", [{"one_pass": True}, {"key_filter_bytes": 0}, {"snapshot_buckets": 3}, {"one_pass": True, "key_filter_bytes": 0, "snapshot_buckets": 2, "full_snapshot_every": 1}])
def test_other_ways_to_the_cohort_deliver_the_same(world, options):
    first = world.run(run_id="r1", **options)
    assert first.records == {"spell": 4, "diag": 4, "open_now": 0, "spellDeletes": 4, "open_nowDeletes": 0}
    world.put("diag", "FY2013-14", [(4, "2013/14", 1, "edited"), (5, "2013/14", 1, "z"), (9, "2013/14", 1, "outside")], CHILD)
    second = world.run(run_id="r2", **options)
    assert world.lines(second, "spell") == [f"{code(4)}|d"] and world.lines(second, "diag") == [f"{code(4)}|1|edited|"]
    assert world.lines(second, "spellDeletes") == sorted(code(k) for k in (1, 2, 4, 5))
    # Both forms write the same hashes.
    assert not world.run(run_id="r3").changed
    world.put("spell", "FY2013-14", [(4, "2013/14", "O1", None, "d"), (5, "2013/14", "O1", None, "e")], PARENT)
    assert world.lines(world.run(run_id="r4"), "spell") == []


def test_pseudonyms_are_made_when_rows_lie_in_their_parts(spark, world):
    """What is stored and dealt out holds plain values, which are a fraction of the size of pseudonyms."""
    run = world.run()
    work = f"{world.base}/out/work/{run.run_id}"
    assert sorted(str(r.key) for r in spark.read.parquet(f"{work}/spell_out").collect()) == ["1", "2", "4", "5"]
    assert sorted(str(r.key) for r in spark.read.parquet(f"{work}/spellDeletes_out").collect()) == ["1", "2", "4", "5"]
    assert [x.split("|")[0] for x in world.lines(run, "spell")] == sorted(map(code, [1, 2, 4, 5]))
    assert world.lines(run, live_key_label("spell")) == sorted(map(code, [1, 2, 4, 5]))
