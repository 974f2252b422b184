"""Files: delivery bytes, control file, folder listings, drifting schemas, empty and missing tables."""

import datetime as dt
import glob
import gzip

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from deltaextract.operators import changed_folder_list, changed_periods, control_rows, entity_folders, part_count
from deltaextract.sources import (
    delivered_files,
    folder_listing,
    period_schema,
    read_folder_state,
    read_or_empty,
    read_periods,
    schema_groups,
    write_by_period,
    write_control,
    write_delivery,
    write_folder_state,
)
from deltaextract.sources.delivery import parts_for
from deltaextract.sources.folders import FOLDER_STATE


def parts(path):
    return [gzip.open(f).read() for f in sorted(glob.glob(f"{path}/*.csv.gz"))]


def test_delivery_bytes(spark, tmp_path):
    rows = spark.createDataFrame(
        [
            ("1", "a|b", dt.date(2024, 3, 1), dt.datetime(2024, 3, 1, 1, 2, 3, 456000)),
            ("2", 'say "x"', None, None),
            ("3", "two\nlines", None, None),
            ("4", None, None, None),
            ("5", "", None, None),
            ("6", "é—中", None, None),
        ],
        "id string, t string, d date, ts timestamp_ntz",
    ).coalesce(1)
    before = spark.conf.get("spark.sql.legacy.javaCharsets", None)
    assert write_delivery(rows, f"{tmp_path}/out", 10) == 6
    assert spark.conf.get("spark.sql.legacy.javaCharsets", None) == before
    (text,) = parts(f"{tmp_path}/out")
    lines = text.split(b"\n", 1)
    assert lines[0] == b"id|t|d|ts"
    found = lines[1]
    for expected in (
        b'1|"a|b"|2024-03-01|2024-03-01 01:02:03\n',
        b'2|"say \\"x\\""||\n',
        b'3|"two\nlines"||\n',
        b"4|||\n",
        b"5|||\n",
        b"6|\xe9\x97?||\n",
    ):
        assert expected in found


def test_part_counts(spark):
    assert [parts_for(n, 10) for n in (0, 1, 9, 10, 11, 20)] == [1, 1, 1, 2, 2, 3]
    sizes = spark.createDataFrame([(n,) for n in (0, 1, 9, 10, 11, 20)], "n long")
    assert [r[0] for r in sizes.orderBy("n").select(part_count(F.col("n"), 10)).collect()] == [1, 1, 1, 2, 2, 3]


def test_delivery_is_split_and_empty_output_keeps_its_header(spark, tmp_path):
    rows = spark.range(100).withColumn("v", F.lit("x"))
    write_delivery(rows, f"{tmp_path}/many", 30)
    assert len(parts(f"{tmp_path}/many")) == 4
    assert sorted(sum((p.splitlines()[1:] for p in parts(f"{tmp_path}/many")), [])) == sorted(b"%d|x" % i for i in range(100))
    assert write_delivery(rows.limit(0), f"{tmp_path}/none", 30) == 0
    assert parts(f"{tmp_path}/none") == [b"id|v\n"]
    assert [f.file.split("/")[0] for f in delivered_files(spark, f"{tmp_path}/none").collect()] == ["none"]


def test_control_bytes(spark, tmp_path):
    entries = spark.createDataFrame(
        [(["b1", "b2"], 3_000_000_000), (["a1"], 0), ([], 5)], "files array<string>, records long"
    )
    write_control(control_rows(entries, "Some_Date"), f"{tmp_path}/ctl")
    (path,) = glob.glob(f"{tmp_path}/ctl/*.csv")
    head, *rest = open(path, "rb").read().decode("windows-1252").split("\r\n")
    assert head == "cExtractFileName|~|nRecordCount|~|cDatum|~|dPeriodStart|~|dPeriodEnd"
    tail = "|~|Some_Date|~|1970-04-01 00:00:00|~|2999-01-01 00:00:00"
    assert sorted(rest) == sorted(["", f"b1|~|3000000000{tail}", f"b2|~|3000000000{tail}", f"a1|~|0{tail}"])


def test_folder_listing(spark, tmp_path):
    one = spark.range(1)
    for folder in ("FY2012-13", "FY2013-14", "FY2013-14/deeper", "notes"):
        one.write.mode("append").parquet(f"{tmp_path}/src/{folder}")
    one.write.json(f"{tmp_path}/src/FY2014-15")
    listing = folder_listing(spark, {"src": f"{tmp_path}/src/", "absent": f"{tmp_path}/absent"})
    assert sorted((r.data_source, r.folder) for r in listing.collect()) == [
        ("src", "FY2012-13/"),
        ("src", "FY2013-14/"),
        ("src", "notes/"),
    ]
    before = listing.where("folder = 'FY2013-14/'").first().last_modified
    write_folder_state(listing, f"{tmp_path}/state")
    state = read_folder_state(spark, f"{tmp_path}/state")
    assert changed_periods(listing, state).count() == 0
    assert state.where("folder = 'FY2013-14/'").first().last_modified == before
    one.write.mode("append").parquet(f"{tmp_path}/src/FY2013-14")
    changed = changed_periods(folder_listing(spark, {"src": f"{tmp_path}/src"}), state)
    assert [tuple(r) for r in changed.collect()] == [("FY2013-14/", "2013/14", 2013)]
    assert folder_listing(spark, {"absent": f"{tmp_path}/absent"}).count() == 0


def test_periods_floor_unmatched_names_and_other_sources(spark):
    at = dt.datetime(2024, 1, 1)
    rows = [("p", "FY2014-15/", at), ("p", "FY2015-16/", at), ("c", "FY2016-17/", at), ("c", "archive/", at)]
    listing = spark.createDataFrame(rows, FOLDER_STATE)
    previous = spark.createDataFrame([("p", "FY2014-15/", at)], FOLDER_STATE)
    changed = changed_periods(listing, previous, floor=2015)
    assert [r.fy for r in changed.collect()] == ["2015/16", "2016/17"]
    assert changed_folder_list(changed).first().folders == ["FY2015-16/", "FY2016-17/"]
    assert sorted(map(tuple, entity_folders(listing, changed).collect())) == [("c", "FY2016-17/"), ("p", "FY2015-16/")]
    assert changed_periods(listing, spark.createDataFrame([], FOLDER_STATE)).count() == 3


def test_drifting_schema(spark, tmp_path):
    spark.createDataFrame([(1,)], "id long").write.parquet(f"{tmp_path}/a")
    spark.createDataFrame([(2, "x")], "id long, x string").write.parquet(f"{tmp_path}/b")
    both = read_periods(spark, [f"{tmp_path}/a", f"{tmp_path}/b"])
    assert sorted(map(tuple, both.collect())) == [(1, None), (2, "x")]
    spark.createDataFrame([("3",)], "id string").write.parquet(f"{tmp_path}/c")
    with pytest.raises(ValueError, match="id is string"):
        period_schema(spark, [f"{tmp_path}/a", f"{tmp_path}/c"])


def test_missing_tables_are_empty_but_broken_ones_are_errors(spark, tmp_path):
    schema = spark.range(1).schema
    assert read_or_empty(spark, f"{tmp_path}/none", schema).count() == 0
    assert read_periods(spark, [], schema).count() == 0
    with pytest.raises(ValueError):
        read_periods(spark, [])
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part.parquet").write_text("not parquet")
    with pytest.raises(Exception) as error:
        read_or_empty(spark, f"{tmp_path}/bad", schema).collect()
    assert not isinstance(error.value, AnalysisException)


def test_period_partitions_keep_slashes_and_nulls(spark, tmp_path):
    rows = spark.createDataFrame([(1, "2012/13"), (2, None)], "id long, fy string")
    write_by_period(rows, f"{tmp_path}/t", "fy")
    assert sorted(map(tuple, spark.read.schema(rows.schema).parquet(f"{tmp_path}/t").collect())) == [(1, "2012/13"), (2, None)]


def test_files_of_different_types_in_one_folder(spark, tmp_path):
    folder = f"{tmp_path}/FY2012-13"
    for rows, schema in (
        ([(1, 1.5)], "id int, x float"),
        ([(2, 2.5, "new")], "id int, x float, late string"),
        ([(2**40, 3.5)], "id long, x double"),
        ([(4, 4.5)], "id short, x double"),
        ([(2**41, 5.5, "l")], "id long, x double, late string"),
    ):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    spark.createDataFrame([(6, 6.5)], "id long, x double").coalesce(1).write.parquet(f"{tmp_path}/FY2013-14")
    paths = [folder, f"{tmp_path}/FY2013-14"]
    assert period_schema(spark, paths).simpleString() == "struct<id:bigint,x:double,late:string>"
    expected = [(1, 1.5, None), (2, 2.5, "new"), (4, 4.5, None), (6, 6.5, None), (2**40, 3.5, None), (2**41, 5.5, "l")]
    assert sorted(map(tuple, read_periods(spark, paths).collect()), key=lambda r: r[0]) == expected
    placed = read_periods(spark, paths, with_period=True)
    assert {r.id: r.source_period for r in placed.collect()} == {**dict.fromkeys((1, 2, 4, 2**40, 2**41), "2012/13"), 6: "2013/14"}
    # int with float, long with double, short with double
    assert len(schema_groups(spark, paths)) == 3
    plan = placed.where("id = 2").select("x")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(id), EqualTo(id,2)]" in plan and "late" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_nested_types_widen_and_real_conflicts_are_named(spark, tmp_path):
    spark.createDataFrame([(1, [1], (1, "a"))], "id int, l array<int>, s struct<n:int,t:string>").write.parquet(f"{tmp_path}/a")
    spark.createDataFrame([(1, [2**40], (2**40, "b"))], "id long, l array<long>, s struct<n:long,t:string>").write.mode("append").parquet(f"{tmp_path}/a")
    rows = read_periods(spark, [f"{tmp_path}/a"])
    assert sorted((r.l[0], r.s.n, r.s.t) for r in rows.collect()) == [(1, 1, "a"), (2**40, 2**40, "b")]
    spark.createDataFrame([("x",)], "id string").write.mode("append").parquet(f"{tmp_path}/a")
    with pytest.raises(ValueError, match="column id is"):
        read_periods(spark, [f"{tmp_path}/a"])
