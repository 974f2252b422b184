"""One query per operator, each over whole tables: ``(spark, data folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial, reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deltaextract.config import Dimension, EntitySpec, FeedSpec
from deltaextract.functions import folder_to_fy, folder_year, row_hash
from deltaextract.operators import (
    CohortLists,
    KeyFilter,
    carry_over,
    changed_entity_keys,
    changed_folder_list,
    changed_keys,
    changed_periods,
    cohort_fingerprint,
    cohort_keys,
    control_rows,
    entity_folders,
    extract_delta,
    family_changes,
    fingerprint,
    in_periods,
    live_keys,
    merge_snapshot,
    org_filter,
    part_count,
    previous_in_scope,
    project,
    record_counts,
    snapshot_schema,
    source_rows,
    vanished_periods,
)
from deltaextract.operators.project import ROW_ALIAS, hash_columns
from deltaextract.plans.feed import FeedRun, run_feed
from deltaextract.plans.concurrent import side_by_side
from deltaextract.plans.fixtures import (
    CHILD,
    CHILD_MAPPING,
    GP_REGION,
    PARENT,
    PARENT_MAPPING,
    PROVIDER_REGION,
    SALT,
    Fixtures,
)
from deltaextract.sources import (
    READ_PERIOD,
    delivered_files,
    folder_listing,
    read_buckets,
    read_folder_state,
    read_or_empty,
    read_periods,
    write_buckets,
    write_by_period,
    write_control,
    write_delivery,
    write_folder_state,
)
from deltaextract.sources.delivery import ENCODING, charset_allowed
from deltaextract.sources.shared import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}

SNAPSHOT = snapshot_schema([T.StructField("rec_id", T.LongType())], "fy")
PART_TARGETS = (1_000, 15_000, 10_000_000)
CONTROL_TARGET = 4_000


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _query(name: str) -> Callable[[Callable[[Fixtures], DataFrame]], Callable[[Fixtures], DataFrame]]:
    def register(build: Callable[[Fixtures], DataFrame]) -> Callable[[Fixtures], DataFrame]:
        _QUERIES[name] = lambda spark, sf_dir: build(Fixtures(spark, sf_dir))
        return build

    return register


def _spec(columns: list[Any], **mapping: Any) -> EntitySpec:
    return EntitySpec.from_mapping("entity", {"columns": columns, "keys": ["rec_id"], **mapping})


def _project(source: DataFrame, spec: EntitySpec) -> DataFrame:
    return project(source_rows(source, spec), spec, SALT)


# -- projections and functions --------------------------------------------------------------------------------------


@_query("config_select")
def config_select(fx: Fixtures) -> DataFrame:
    spec = _spec(
        [
            ["rec_id", "record_id"],
            ["gp_code", ["gp_pseudonym", "practice_pseudonym"]],
            ["", "status"],
            ["priority", "priority_class"],
            "not_supplied",
            ["order_date", "ordered_on"],
        ],
        encrypt=["gp_code"],
        transform={"priority": [["left", [1]]]},
        filter="total_price > 1000",
    )
    return _project(fx.parent, spec)


@_query("missing_column_default")
def missing_column_default(fx: Fixtures) -> DataFrame:
    spec = _spec(["rec_id", ["not_supplied", "renamed"]], encrypt=["not_supplied"], transform={"not_supplied": [["left", [1]]]})
    return _project(fx.parent, spec)


@_query("multi_alias")
def multi_alias(fx: Fixtures) -> DataFrame:
    return _project(fx.parent, _spec(["rec_id", ["provider_code", ["treating_provider", "billing_provider"]]]))


@_query("transform_chain")
def transform_chain(fx: Fixtures) -> DataFrame:
    steps = [["substring", [3, 20]], ["concat", ["status", "provider_code"]], ["left", [4]]]
    return _project(fx.parent, _spec(["rec_id", "priority"], transform={"priority": steps}))


@_query("pseudonymise")
def pseudonymise(fx: Fixtures) -> DataFrame:
    return _project(fx.child, _spec(["rec_id", "line_no", "part_id", "return_flag"], encrypt=["part_id", "return_flag"]))


@_query("config_filter")
def config_filter(fx: Fixtures) -> DataFrame:
    spec = _spec(["rec_id", "line_no"], encrypt=["rec_id"], filter="quantity > 30 AND e.rec_id > 10")
    return _project(fx.child, spec)


@_query("fn_to_date")
def fn_to_date(fx: Fixtures) -> DataFrame:
    text = F.when(F.col("rec_id") % 10 == 0, F.lit("n/a")).otherwise(F.col("order_date").cast("string"))
    spec = _spec(["rec_id", "ordered"], transform={"ordered": [["to_date", ["yyyy-MM-dd"]]]})
    return _project(fx.parent.withColumn("ordered", text), spec)


@_query("fn_expr")
def fn_expr(fx: Fixtures) -> DataFrame:
    steps = [["left", [1]], ["expr", ["concat(priority, '/', e.status)"]]]
    return _project(fx.parent, _spec(["rec_id", "priority"], transform={"priority": steps}))


@_query("fn_concat")
def fn_concat(fx: Fixtures) -> DataFrame:
    spec = _spec(["rec_id", "line_no", "quantity"], transform={"quantity": [["concat", ["price", "return_flag"]]]})
    return _project(fx.child, spec)


@_query("fn_instr")
def fn_instr(fx: Fixtures) -> DataFrame:
    return _project(fx.parent, _spec(["rec_id", "priority"], transform={"priority": [["instr", ["E"]]]}))


@_query("fn_left")
def fn_left(fx: Fixtures) -> DataFrame:
    return _project(fx.parent, _spec(["rec_id", "priority"], transform={"priority": [["left", [3]]]}))


@_query("fn_substring")
def fn_substring(fx: Fixtures) -> DataFrame:
    transform = {"priority": [["substring", [3, 4]]], "provider_code": [["substring", [0, 2]]]}
    return _project(fx.parent, _spec(["rec_id", "priority", "provider_code"], transform=transform))


@_query("fn_folder_to_fy")
def fn_folder_to_fy(fx: Fixtures) -> DataFrame:
    folders = fx.folders.select("folder")
    other = folders.select(F.concat(F.lit("old-"), "folder").alias("folder"))
    folder = F.col("folder")
    return (
        folders.unionByName(other)
        .distinct()
        .select("folder", folder_to_fy(folder).alias("fy"), folder_year(folder).alias("first_year"))
    )


@_query("row_hash")
def row_digests(fx: Fixtures) -> DataFrame:
    rows = fx.child
    columns = hash_columns(CHILD, rows.columns)
    return rows.alias(ROW_ALIAS).select(
        "rec_id", "line_no", row_hash(columns).alias("hash"), row_hash(columns, "framed").alias("framed_hash")
    )


# -- cohort ---------------------------------------------------------------------------------------------------------


@_query("org_filter")
def org_lists(fx: Fixtures) -> DataFrame:
    providers, practices = fx.providers, fx.gp_practices
    found = [
        org_filter(providers.unionByName(providers), "org_code", "region_code", PROVIDER_REGION),
        org_filter(practices.unionByName(practices), "org_code", "region_code", GP_REGION),
    ]
    return found[0].unionByName(found[1])


@_query("cohort_keys")
def cohort(fx: Fixtures) -> DataFrame:
    return fx.cohort()


@_query("cohort_keys_large_lists")
def cohort_large_lists(fx: Fixtures) -> DataFrame:
    return cohort_keys(fx.parent, CohortLists.measure(fx.org_pairs(), broadcast_bytes=0), PARENT, "fy")


# -- periods and folder state ---------------------------------------------------------------------------------------


@_query("changed_periods")
def periods(fx: Fixtures) -> DataFrame:
    return fx.periods()


@_query("changed_periods_floor")
def changed_periods_floor(fx: Fixtures) -> DataFrame:
    return changed_periods(fx.folders, fx.folders_previous(), floor=2000)


@_query("changed_folder_list")
def folder_list(fx: Fixtures) -> DataFrame:
    return changed_folder_list(fx.periods()).select(F.array_join("folders", ",").alias("folders"))


@_query("entity_paths")
def entity_paths(fx: Fixtures) -> DataFrame:
    missing = (F.col("data_source") == "child") & (F.col("folder") == "FY1999-00/")
    return entity_folders(fx.folders.where(~missing), fx.periods())


@_query("folder_state_roundtrip")
def folder_state_roundtrip(fx: Fixtures) -> DataFrame:
    path = scratch_path(fx.spark, "folder_state")
    write_folder_state(fx.folders, path)
    state = read_folder_state(fx.spark, path)
    return state.withColumn("last_modified", F.date_format("last_modified", "yyyy-MM-dd HH:mm:ss"))


def _write_folders(frame: DataFrame, base: str, fys: list[str], mode: str = "overwrite", by: str = "fy") -> None:
    """One folder per FY, each filled from the partition of its FY: the frame is one of sources that are stored."""

    def write(fy: str) -> None:
        frame.where(F.col(by) == fy).drop(READ_PERIOD).write.mode(mode).parquet(f"{base}/FY{fy[:4]}-{fy[5:]}")

    side_by_side([partial(write, fy) for fy in fys])


@_query("folder_mod_times")
def folder_mod_times(fx: Fixtures) -> DataFrame:
    fx.store_sources()
    base = scratch_path(fx.spark, "sources")
    fys = [r.fy for r in fx.parent.select("fy").distinct().collect()]
    for mode in ("overwrite", "append"):  # two files at least, the second some time after the first
        _write_folders(fx.parent, f"{base}/parent", fys, mode)
        _write_folders(fx.child, f"{base}/child", fys, mode)
    listing = folder_listing(fx.spark, {"parent": f"{base}/parent", "child": f"{base}/child", "none": f"{base}/none"})
    # The times of the files once more, as the parquet reader sees them.
    folder = F.concat(F.element_at(F.split("_metadata.file_path", "/"), -2), F.lit("/"))
    times = reduce(
        DataFrame.unionByName,
        [
            fx.spark.read.parquet(f"{base}/{name}/*").select(F.lit(name).alias("data_source"), folder.alias("folder"), F.col("_metadata.file_modification_time").alias("t"))
            for name in ("parent", "child")
        ],
    )
    spans = times.groupBy("data_source", "folder").agg(F.min("t").alias("first"), F.max("t").alias("last"))
    return listing.join(spans, ["data_source", "folder"], "left").select(
        "data_source", "folder", (F.col("last_modified") == F.col("last")).alias("is_last"), (F.col("last_modified") > F.col("first")).alias("after_first")
    )


@_query("vanished_periods")
def periods_gone(fx: Fixtures) -> DataFrame:
    """One data source has lost every second folder, the other those of two years."""
    year = folder_year(F.col("folder"))
    lost = F.when(F.col("data_source") == "parent", year % 2 == 0).otherwise(year.isin(1996, 1997))
    return vanished_periods(fx.folders.where(~lost), fx.folders, floor=1995)


@_query("mixed_file_types")
def mixed_file_types(fx: Fixtures) -> DataFrame:
    """Folders whose files differ in the types of columns, and in the columns they have, read as one table."""
    fx.store_sources()
    base = scratch_path(fx.spark, "mixed")
    rows = fx.child.select("rec_id", "fy", "line_no", "part_id", "quantity", "ship_date")
    narrow = rows.where("line_no <= 3").withColumns({"line_no": F.col("line_no").cast("smallint"), "part_id": F.col("part_id").cast("int"), "quantity": F.col("quantity").cast("float")})
    wide = rows.where("line_no > 3").withColumns({"line_no": F.col("line_no").cast("bigint"), "quantity": F.col("quantity").cast("double")}).drop("ship_date")
    fys = [r.fy for r in fx.parent.select("fy").distinct().collect()]
    for part in (narrow, wide):
        _write_folders(part, base, fys, "append")
    return read_periods(fx.spark, [f"{base}/FY{fy[:4]}-{fy[5:]}" for fy in sorted(fys)], with_period=True)


# -- fingerprints ---------------------------------------------------------------------------------------------------


@_query("fingerprint_parent")
def fingerprint_parent(fx: Fixtures) -> DataFrame:
    return _fingerprints(fx, partial(fx.current_fingerprints, PARENT))[0]


@_query("fingerprint_child")
def fingerprint_child(fx: Fixtures) -> DataFrame:
    return _fingerprints(fx, partial(fx.current_fingerprints, CHILD))[0]


@_query("fingerprint_one_pass")
def fingerprint_one_pass(fx: Fixtures) -> DataFrame:
    """Cohort and fingerprints of the parent from one scan."""
    return cohort_fingerprint(in_periods(fx.parent, fx.changed_fys, "fy"), fx.org_lists, PARENT, "fy")


@_query("fingerprint_one_pass_fan")
def fingerprint_one_pass_fan(fx: Fixtures) -> DataFrame:
    """The same for keys that lie in several FYs and match in some of them only; lists that are not broadcast."""
    rows = fx.parent.unionByName(fx.parent.where(F.col("rec_id") % 3 == 0).withColumns({"fy": F.lit("2000/01"), "provider_code": F.lit("none"), "gp_code": F.lit("none")}))
    return cohort_fingerprint(rows, CohortLists.measure(fx.org_pairs(), broadcast_bytes=0), PARENT, "fy")


@_query("fingerprint_filtered")
def fingerprint_filtered(fx: Fixtures) -> DataFrame:
    """Child rows whose key is not in the cohort are dropped by a filter of bounded size before they are hashed."""
    fx.prepare(previous=False)
    return fx.current_fingerprints(CHILD, key_filter=KeyFilter.of(fx.cohort_in_changed, CHILD.keys))


@_query("fingerprint_split")
def fingerprint_split(fx: Fixtures) -> DataFrame:
    """Three keys hold all rows, each about a third."""
    rows = fx.child.withColumn("rec_id", F.col("rec_id") % 3)
    return fingerprint(rows, rows.select("rec_id").distinct(), CHILD, "fy")


MULTI = _spec(["rec_id", "status", "total_price"])


def _multi_cohort(fx: Fixtures) -> DataFrame:
    """Keys and FYs of the cohort's records, some in several FYs; many records are not in it."""
    return fx.parent_multi.select("rec_id", "fy").distinct().join(fx.cohort_current.select("rec_id"), "rec_id", "left_semi")


@_query("key_join_semi")
def key_join_semi(fx: Fixtures) -> DataFrame:
    return fingerprint(fx.parent_multi, _multi_cohort(fx), MULTI, "fy")


@_query("key_join_inner")
def key_join_inner(fx: Fixtures) -> DataFrame:
    return fingerprint(fx.parent_multi, _multi_cohort(fx), MULTI, "fy", fan_out=True)


# -- changed keys ---------------------------------------------------------------------------------------------------


def _fingerprints(fx: Fixtures, *builds: Callable[[], DataFrame]) -> list[DataFrame]:
    """Fingerprints whose group-size checks are independent jobs and run side by side."""
    fx.prepare(previous=len(builds) > 1)
    return side_by_side(builds)


def _pairs(fx: Fixtures, *specs: EntitySpec) -> list[tuple[DataFrame, DataFrame]]:
    """(current, previous in scope) per entity."""
    builds = [b for s in specs for b in (partial(fx.current_fingerprints, s), partial(fx.previous_in_changed, s))]
    frames = _fingerprints(fx, *builds)
    return list(zip(frames[::2], frames[1::2], strict=True))


def _changed(fx: Fixtures) -> DataFrame:
    return changed_keys(_pairs(fx, PARENT, CHILD), PARENT.keys)


@_query("changed_parent")
def changed_parent(fx: Fixtures) -> DataFrame:
    return changed_entity_keys(*_pairs(fx, PARENT)[0], PARENT.keys)


@_query("changed_child")
def changed_child(fx: Fixtures) -> DataFrame:
    return changed_entity_keys(*_pairs(fx, CHILD)[0], CHILD.keys)


@_query("changed_keys")
def changed_family(fx: Fixtures) -> DataFrame:
    return _changed(fx)


@_query("changed_keys_vanished")
def changed_family_vanished(fx: Fixtures) -> DataFrame:
    """Some records have left the cohort, some have lost all their child rows; only the latter count."""
    cohort = fx.cohort_in_changed.where(F.col("rec_id") % 7 != 0)
    rows = fx.child.where(F.col("rec_id") % 31 != 0)
    current = [fingerprint(in_periods(r, fx.changed_fys, "fy"), cohort, spec, "fy") for r, spec in ((fx.parent, PARENT), (rows, CHILD))]
    pairs = list(zip(current, [fx.previous_in_changed(PARENT), fx.previous_in_changed(CHILD)], strict=True))
    return changed_keys(pairs, PARENT.keys, detect_vanished=True, cohort=cohort)


# -- state by the folder read ---------------------------------------------------------------------------------------


def _unfiled(rows: DataFrame) -> DataFrame:
    """Rows with the period of their folder; some have no FY, some have another than their folder's."""
    key = F.col("rec_id")
    fy = F.when(key % 11 == 0, F.lit(None)).when(key % 13 == 0, F.lit("1990/91")).otherwise(F.col("fy"))
    return rows.withColumns({READ_PERIOD: F.col("fy"), "fy": fy})


def _by_folder(fx: Fixtures, rows: DataFrame, cohort: DataFrame, spec: EntitySpec, *, changed_only: bool = True) -> DataFrame:
    rows = _unfiled(rows)
    return fingerprint(in_periods(rows, fx.changed_fys, READ_PERIOD) if changed_only else rows, cohort, spec, "fy", scope=[READ_PERIOD])


@_query("fingerprint_by_folder")
def fingerprint_by_folder(fx: Fixtures) -> DataFrame:
    fx.prepare(previous=False)
    return _by_folder(fx, fx.child, fx.cohort_in_changed, CHILD)


@_query("changed_keys_by_folder")
def changed_keys_by_folder(fx: Fixtures) -> DataFrame:
    fx.prepare()
    members = ((fx.parent, fx.parent_previous, PARENT), (fx.child, fx.child_previous, CHILD))
    pairs = [(_by_folder(fx, now, fx.cohort_in_changed, spec), _by_folder(fx, before, fx.cohort_previous, spec)) for now, before, spec in members]
    return changed_keys(pairs, PARENT.keys)


@_query("merge_snapshot_by_folder")
def merge_snapshot_by_folder(fx: Fixtures) -> DataFrame:
    fx.prepare()
    current = _by_folder(fx, fx.parent, fx.cohort_in_changed, PARENT)
    return merge_snapshot(current, _by_folder(fx, fx.parent_previous, fx.cohort_previous, PARENT, changed_only=False), fx.changed_fys, READ_PERIOD)


@_query("changed_keys_from_buckets")
def changed_keys_from_buckets(fx: Fixtures) -> DataFrame:
    """Current and previous fingerprints stored in buckets by key, and compared where they lie."""
    base, stored = scratch_path(fx.spark, "buckets"), []
    for i, frame in enumerate(f for pair in _pairs(fx, PARENT, CHILD) for f in pair):
        write_buckets(frame, f"{base}/{i}", ["rec_id"], "fy", 8)
        stored.append(read_buckets(fx.spark, f"{base}/{i}", frame.schema, ["rec_id"], 8))
    return changed_keys(zip(stored[::2], stored[1::2], strict=True), PARENT.keys, in_place=True)


@_query("family_changes")
def family_change_flags(fx: Fixtures) -> DataFrame:
    """What happened to each key: new, edited, left or without child rows; some records have left the cohort."""
    cohort = fx.cohort_in_changed.where(F.col("rec_id") % 7 != 0)
    rows = fx.child.where(F.col("rec_id") % 31 != 0)
    current = [fingerprint(in_periods(r, fx.changed_fys, "fy"), cohort, spec, "fy") for r, spec in ((fx.parent, PARENT), (rows, CHILD))]
    return family_changes(list(zip(current, [fx.previous_in_changed(PARENT), fx.previous_in_changed(CHILD)], strict=True)), PARENT.keys)


# -- delivery -------------------------------------------------------------------------------------------------------


@_query("delta_parent")
def delta_parent(fx: Fixtures) -> DataFrame:
    changed = _changed(fx)
    return extract_delta(in_periods(fx.parent, fx.changed_fys, "fy"), changed, PARENT, SALT)


@_query("delta_child")
def delta_child(fx: Fixtures) -> DataFrame:
    changed = _changed(fx)
    return extract_delta(in_periods(fx.child, fx.changed_fys, "fy"), changed, CHILD, SALT)


@_query("csv_roundtrip")
def csv_roundtrip(fx: Fixtures) -> DataFrame:
    path = scratch_path(fx.spark, "delivery")
    write_delivery(project(fx.child, CHILD, SALT), path, target_rows=25_000)
    return fx.spark.read.csv(path, header=True, sep="|")


@_query("record_counts")
def counts(fx: Fixtures) -> DataFrame:
    return record_counts({"parent": fx.parent, "child": fx.child, "conversations": fx.table("conversations")})


@_query("part_counts")
def part_counts(fx: Fixtures) -> DataFrame:
    targets = F.explode(F.array(*[F.lit(t).cast("long") for t in PART_TARGETS]))
    sized = counts(fx).select("entity", "records", targets.alias("target_rows"))
    return sized.withColumn("parts", part_count(F.col("records"), F.col("target_rows")))


def _control_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a control file; of the names of parts only folder and number stay, the rest differs from run to run."""
    return spark.read.text(path).select(F.regexp_replace("value", r"(part-[0-9]+)-[^|]*\.csv\.gz", "$1").alias("line"))


@_query("control_file")
def control_file(fx: Fixtures) -> DataFrame:
    """The control file of three outputs that have really been written in parts."""
    fx.store_sources()
    base = scratch_path(fx.spark, "control")

    def entries(name: str, frame: DataFrame) -> DataFrame:
        records = write_delivery(frame, f"{base}/{name}", CONTROL_TARGET)
        return delivered_files(fx.spark, f"{base}/{name}").select(F.array("file").alias("files"), F.lit(records).alias("records"))

    frames = {"parent": fx.parent, "child": fx.child, "conversations": fx.table("conversations")}
    with charset_allowed(fx.spark, ENCODING):
        written = side_by_side([partial(entries, *item) for item in frames.items()])
    write_control(control_rows(reduce(DataFrame.unionByName, written), "order_date"), f"{base}/list")
    return _control_lines(fx.spark, f"{base}/list")


# -- snapshot -------------------------------------------------------------------------------------------------------


@_query("snapshot_roundtrip")
def snapshot_roundtrip(fx: Fixtures) -> DataFrame:
    path = scratch_path(fx.spark, "snapshot")
    write_by_period(fx.previous_fingerprints(CHILD), path, "fy")
    return read_or_empty(fx.spark, path, SNAPSHOT)


@_query("bootstrap_snapshot")
def bootstrap_snapshot(fx: Fixtures) -> DataFrame:
    previous = read_or_empty(fx.spark, scratch_path(fx.spark, "no_snapshot"), SNAPSHOT)
    return changed_entity_keys(fx.current_fingerprints(PARENT), previous, PARENT.keys)


@_query("previous_in_scope")
def scope(fx: Fixtures) -> DataFrame:
    return previous_in_scope(fx.previous_fingerprints(PARENT), fx.periods(), "fy")


@_query("carry_over")
def carried(fx: Fixtures) -> DataFrame:
    return carry_over(fx.previous_fingerprints(PARENT), fx.periods(), "fy")


def _merged(fx: Fixtures, spec: EntitySpec) -> DataFrame:
    builds = partial(fx.current_fingerprints, spec), partial(fx.previous_fingerprints, spec)
    return merge_snapshot(*_fingerprints(fx, *builds), fx.changed_fys, "fy")


@_query("merge_snapshot")
def merge_snapshot_parent(fx: Fixtures) -> DataFrame:
    return _merged(fx, PARENT)


@_query("merge_snapshot_child")
def merge_snapshot_child(fx: Fixtures) -> DataFrame:
    return _merged(fx, CHILD)


@_query("live_keys")
def live_key_list(fx: Fixtures) -> DataFrame:
    return live_keys(_merged(fx, PARENT), PARENT, SALT)


# -- whole feed -----------------------------------------------------------------------------------------------------


def fixture_feed(base: str, dimensions: tuple[Dimension, ...], **settings: Any) -> FeedSpec:
    mapping: Mapping[str, Any] = {"entities": {"parent": PARENT_MAPPING, "child": CHILD_MAPPING}}
    tree = {"parent": {"basePath": f"{base}/parent", "children": {"child": {"basePath": f"{base}/child/"}}}}
    defaults = {"fy_column": "fy", "datum": "order_date", "output_path": f"{base}/out", "dimensions": dimensions}
    return FeedSpec.build("orders", tree, mapping, **{**defaults, **settings})


def fixture_dimensions(fx: Fixtures, base: str) -> tuple[Dimension, ...]:
    fx.providers.write.mode("overwrite").parquet(f"{base}/providers")
    fx.gp_practices.write.mode("overwrite").parquet(f"{base}/practices")
    return (
        Dimension("org_code", "region_code", PROVIDER_REGION, "provider_code", f"{base}/providers"),
        Dimension("org_code", "region_code", GP_REGION, "gp_code", f"{base}/practices"),
    )


@_query("run_feed")
def feed_second_run(fx: Fixtures) -> DataFrame:
    """Two runs of the whole job; returns every delivered line of the second one except headers of outputs, and its control file."""
    fx.store_sources()
    base = scratch_path(fx.spark, "feed")
    feed = fixture_feed(base, fixture_dimensions(fx, base))
    sources = {
        "parent": (fx.parent_previous, fx.parent),
        "child": (fx.child_previous, fx.child),
    }
    fys = [r.fy for r in fx.parent_previous.select("fy").distinct().collect()]
    for name, (previous, _) in sources.items():
        _write_folders(previous, f"{base}/{name}", fys)
    run_feed(fx.spark, feed, SALT)

    changed = fx.changed_fys
    for name, (_, current) in sources.items():
        _write_folders(current, f"{base}/{name}", changed)
    run = run_feed(fx.spark, feed, SALT)

    lines = _delivered_lines(fx.spark, run)
    lines.append(_control_lines(fx.spark, f"{run.delivery_path}/{feed.name}_control").select(F.lit("control").alias("output"), "line"))
    return reduce(DataFrame.unionByName, lines)


def _delivered_lines(spark: SparkSession, run: FeedRun, prefix: str = "") -> list[DataFrame]:
    lines = []
    for label in ("parent", "child", "parentDeletes"):
        read = spark.read.text(f"{run.delivery_path}/{label}").withColumnRenamed("value", "line")
        lines.append(read.where(~F.col("line").startswith("record_id")).select(F.lit(prefix + label).alias("output"), "line"))
    return lines


@_query("run_feed_without_fy")
def feed_of_unfiled_rows(fx: Fixtures) -> DataFrame:
    """Three runs over rows of which some have no FY and some another than their folder's: the lines of the second, and of a third after folders were written anew with the same rows."""
    fx.store_sources()
    base = scratch_path(fx.spark, "feed")
    feed = fixture_feed(base, fixture_dimensions(fx, base))
    sources = {"parent": (fx.parent_previous, fx.parent), "child": (fx.child_previous, fx.child)}
    fys = [r.fy for r in fx.parent_previous.select("fy").distinct().collect()]
    for name, (previous, _) in sources.items():
        _write_folders(_unfiled(previous), f"{base}/{name}", fys, by=READ_PERIOD)
    run_feed(fx.spark, feed, SALT)

    lines = []
    for prefix in ("", "again_"):
        for name, (_, current) in sources.items():
            _write_folders(_unfiled(current), f"{base}/{name}", fx.changed_fys, by=READ_PERIOD)
        lines += _delivered_lines(fx.spark, run_feed(fx.spark, feed, SALT), prefix)
    return reduce(DataFrame.unionByName, lines)


@_query("run_feed_retired_folder")
def feed_with_retired_folder(fx: Fixtures) -> DataFrame:
    """Two runs, the second without the folder of the first year: every line that it delivers."""
    fx.store_sources()
    base = scratch_path(fx.spark, "feed")
    dimensions = fixture_dimensions(fx, base)
    fys = sorted(r.fy for r in fx.parent_previous.select("fy").distinct().collect())
    runs = []
    for sources, there in ((f"{base}/all", fys), (f"{base}/without", fys[1:])):
        for name, rows in (("parent", fx.parent_previous), ("child", fx.child_previous)):
            _write_folders(rows, f"{sources}/{name}", there)
        runs.append(run_feed(fx.spark, fixture_feed(sources, dimensions, output_path=f"{base}/out"), SALT, retire_folders=True))
    return reduce(DataFrame.unionByName, _delivered_lines(fx.spark, runs[-1]))
