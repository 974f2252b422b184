"""Which parent records belong to the cohort."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deltaextract.config import EntitySpec
from deltaextract.operators.project import source_rows
from deltaextract.operators.sizing import BROADCAST_BYTES, are_small


def org_filter(dimension: DataFrame, code_column: str, region_column: str, region: str) -> DataFrame:
    """Distinct organisation codes of one region, as ``org_code``."""
    return (
        dimension.where(F.col(region_column) == region)
        .select(F.col(code_column).alias("org_code"))
        .dropDuplicates(["org_code"])
    )


@dataclass(frozen=True)
class CohortLists:
    """Organisation lists paired with the parent column each is matched on, measured once for any number of parents."""

    pairs: tuple[tuple[DataFrame, str], ...]
    small: bool

    @classmethod
    def measure(cls, pairs: Sequence[tuple[DataFrame, str]], broadcast_bytes: int = BROADCAST_BYTES) -> CohortLists:
        """``pairs`` hold frames of distinct ``org_code``."""
        return cls(tuple(pairs), are_small([orgs for orgs, _ in pairs], broadcast_bytes))


def in_lists(rows: DataFrame, lists: CohortLists) -> tuple[DataFrame, Column]:
    """Rows joined to the lists (each adds a column of its own, and no row), and whether a row is in any of them. Lists measured as small are broadcast."""
    hits = []
    for i, (orgs, column) in enumerate(lists.pairs):
        codes = orgs.where("org_code IS NOT NULL").withColumnRenamed("org_code", f"__org{i}")
        rows = rows.join(F.broadcast(codes) if lists.small else codes, F.col(column) == F.col(f"__org{i}"), "left")
        hits.append(F.col(f"__org{i}").isNotNull())
    return rows, reduce(lambda a, b: a | b, hits, F.lit(False))


def cohort_keys(parent: DataFrame, lists: CohortLists, spec: EntitySpec, fy: str) -> DataFrame:
    """Distinct (keys, FY) of parent rows matched by any of the organisation lists.

    Lists measured as small are broadcast and looked up in one pass over the parent. Otherwise each list is a left semi
    join of its own, which Spark may sort-merge and split on skewed codes; the final distinct merges the matches, so
    both give the same rows.
    """
    rows = source_rows(parent, spec)
    key_fy = [*spec.keys, fy]

    if lists.small:
        matched, hit = in_lists(rows, lists)
        return matched.where(hit).select(*key_fy).distinct()

    parts = [
        rows.join(orgs, F.col(column) == F.col("org_code"), "left_semi").select(*key_fy) for orgs, column in lists.pairs
    ]
    return reduce(DataFrame.unionByName, parts).distinct()
