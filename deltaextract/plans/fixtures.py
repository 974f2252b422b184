"""Current and previous states of a parent/child family, derived from the order tables.

Orders are the parent, their line items the child; the customer's nation plays the provider and the customer the
practice. Financial years run from April to March.
"""

from __future__ import annotations

from functools import cached_property
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deltaextract.config import EntitySpec
from deltaextract.operators import CohortLists, changed_periods, cohort_keys, fingerprint, in_periods, org_filter
from deltaextract.plans.concurrent import side_by_side
from deltaextract.sources.shared import scratch_path, stored

SALT = "test-salt"
PROVIDER_REGION = "ASIA"
GP_REGION = "BUILDING"
REMOVED_OFFSET = 10_000_000
NEWEST_FOLDER = "FY2001-02/"

PARENT_MAPPING = {
    "columns": [
        ["rec_id", "record_id"],
        "provider_code",
        ["gp_code", ["gp_pseudonym", "practice_pseudonym"]],
        ["", "status"],
        "total_price",
        ["order_date", "ordered_on"],
        "priority",
    ],
    "keys": ["rec_id"],
    "encrypt": ["rec_id", "gp_code"],
    "transform": {},
    "filter": None,
}
CHILD_MAPPING = {
    "columns": [
        ["rec_id", "record_id"],
        "line_no",
        ["part_id", "part_ref"],
        "quantity",
        "price",
        "return_flag",
        ["ship_date", "shipped_on"],
    ],
    "keys": ["rec_id"],
    "encrypt": ["rec_id"],
    "transform": {},
    "filter": None,
}
PARENT = EntitySpec.from_mapping("parent", PARENT_MAPPING)
CHILD = EntitySpec.from_mapping("child", CHILD_MAPPING)


class Fixtures:
    """The views of one data folder as lazy frames, each built once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    # -- sources ------------------------------------------------------------------------------------------------

    @cached_property
    def parent(self) -> DataFrame:
        start = F.year("o_orderdate") - F.when(F.month("o_orderdate") >= 4, 0).otherwise(1)
        return (
            self.table("orders")
            .join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .select(
                F.col("o_orderkey").alias("rec_id"),
                F.concat(start.cast("string"), F.lit("/"), F.lpad(((start + 1) % 100).cast("string"), 2, "0")).alias("fy"),
                F.concat(F.lit("P"), F.col("c_nationkey").cast("string")).alias("provider_code"),
                F.concat(F.lit("G"), F.col("o_custkey").cast("string")).alias("gp_code"),
                F.col("o_orderstatus").alias("status"),
                F.col("o_totalprice").cast("decimal(18,2)").alias("total_price"),
                F.col("o_orderdate").cast("date").alias("order_date"),
                F.col("o_orderpriority").alias("priority"),
            )
        )

    @cached_property
    def child(self) -> DataFrame:
        return (
            self.table("lineitem")
            .join(self.parent.select("rec_id", "fy"), F.col("l_orderkey") == F.col("rec_id"))
            .select(
                "rec_id",
                "fy",
                F.col("l_linenumber").alias("line_no"),
                F.col("l_partkey").alias("part_id"),
                F.col("l_quantity").cast("decimal(18,2)").alias("quantity"),
                F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
                F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")).alias("return_flag"),
                F.col("l_shipdate").cast("date").alias("ship_date"),
            )
        )

    @cached_property
    def parent_previous(self) -> DataFrame:
        current = self.parent
        edited = F.when(F.col("rec_id") % 37 == 0, (F.col("total_price") + 1).cast("decimal(18,2)"))
        kept = current.where(F.col("rec_id") % 50 != 0).withColumn(
            "total_price", edited.otherwise(F.col("total_price"))
        )
        removed = current.where(F.col("rec_id") % 41 == 0).withColumn("rec_id", F.col("rec_id") + REMOVED_OFFSET)
        return kept.unionByName(removed)

    @cached_property
    def child_previous(self) -> DataFrame:
        added = (F.col("rec_id") % 29 == 0) & (F.col("line_no") == 1)
        return self.child.where((F.col("rec_id") % 50 != 0) & ~added)

    @cached_property
    def parent_multi(self) -> DataFrame:
        rows = self.parent.select("rec_id", "fy", "status", "total_price")
        again = rows.where((F.col("rec_id") % 61 == 0) & (F.col("fy") != "2000/01")).withColumn("fy", F.lit("2000/01"))
        return rows.unionByName(again)

    def store_sources(self) -> None:
        """Write parent and child once, by FY; what is derived from them then reads the FYs it needs and joins nothing again."""
        for name in ("parent", "child"):
            rows, path = getattr(self, name), scratch_path(self.spark, name)
            rows.write.partitionBy("fy").parquet(path)
            setattr(self, name, self.spark.read.schema(rows.schema).parquet(path).select(rows.columns))

    # -- organisation lists -------------------------------------------------------------------------------------

    @cached_property
    def providers(self) -> DataFrame:
        return (
            self.table("nation")
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.concat(F.lit("P"), F.col("n_nationkey").cast("string")).alias("org_code"), F.col("r_name").alias("region_code"))
        )

    @cached_property
    def gp_practices(self) -> DataFrame:
        return self.table("customer").select(
            F.concat(F.lit("G"), F.col("c_custkey").cast("string")).alias("org_code"),
            F.col("c_mktsegment").alias("region_code"),
        )

    def org_pairs(self) -> list[tuple[DataFrame, str]]:
        return [
            (org_filter(self.providers, "org_code", "region_code", PROVIDER_REGION), "provider_code"),
            (org_filter(self.gp_practices, "org_code", "region_code", GP_REGION), "gp_code"),
        ]

    # -- folder state -------------------------------------------------------------------------------------------

    @cached_property
    def folders(self) -> DataFrame:
        """Stored as a feed run stores its listing."""
        fys = self.parent.select("fy").distinct()
        folder = F.concat(F.lit("FY"), F.substring("fy", 1, 4), F.lit("-"), F.substring("fy", 6, 2), F.lit("/"))
        modified = F.when(F.col("fy") >= "1998/99", F.lit("2024-02-01 00:00:00")).otherwise(F.lit("2024-01-01 00:00:00"))
        listing = fys.select(
            F.explode(F.array(F.lit("parent"), F.lit("child"))).alias("data_source"),
            folder.alias("folder"),
            modified.cast("timestamp").alias("last_modified"),
        )
        return stored(listing.coalesce(1), "folders")

    def folders_previous(self) -> DataFrame:
        return (
            self.folders
            .where(F.col("folder") != NEWEST_FOLDER)
            .withColumn("last_modified", F.lit("2024-01-01 00:00:00").cast("timestamp"))
        )

    # -- derived steps ------------------------------------------------------------------------------------------

    def periods(self) -> DataFrame:
        return changed_periods(self.folders, self.folders_previous())

    @cached_property
    def changed_fys(self) -> list[str]:
        """A few per calendar decade."""
        return [p.fy for p in self.periods().collect()]

    @cached_property
    def org_lists(self) -> CohortLists:
        return CohortLists.measure(self.org_pairs())

    def cohort(self) -> DataFrame:
        return cohort_keys(self.parent, self.org_lists, PARENT, "fy")

    # Stored as in a feed run: parent and child read the same key sets.

    @cached_property
    def cohort_current(self) -> DataFrame:
        return stored(self.cohort(), "cohort")

    @cached_property
    def cohort_previous(self) -> DataFrame:
        return stored(cohort_keys(self.parent_previous, self.org_lists, PARENT, "fy"), "cohort_previous")

    @property
    def cohort_in_changed(self) -> DataFrame:
        return in_periods(self.cohort_current, self.changed_fys, "fy")

    def prepare(self, *, previous: bool = True) -> None:
        """Submit the independent first jobs side by side."""

        def cohorts() -> None:
            _ = self.org_lists
            side_by_side([lambda: self.cohort_current] + [lambda: self.cohort_previous] * previous)

        _ = self.parent_previous
        side_by_side([cohorts, lambda: self.changed_fys])

    def current_fingerprints(self, spec: EntitySpec, **options: Any) -> DataFrame:
        source = self.parent if spec is PARENT else self.child
        return fingerprint(in_periods(source, self.changed_fys, "fy"), self.cohort_in_changed, spec, "fy", **options)

    def previous_fingerprints(self, spec: EntitySpec) -> DataFrame:
        source = self.parent_previous if spec is PARENT else self.child_previous
        return fingerprint(source, self.cohort_previous, spec, "fy")

    def previous_in_changed(self, spec: EntitySpec) -> DataFrame:
        """The previous snapshot of the changed FYs; only their rows are read."""
        source = self.parent_previous if spec is PARENT else self.child_previous
        return fingerprint(in_periods(source, self.changed_fys, "fy"), self.cohort_previous, spec, "fy")
