"""Order-independent SHA-256 fingerprints per (keys, FY), or per (keys, FY, folder read).

Each row has a SHA-256 digest; a group's hash is made of the sums of its digests and its number of rows. The definition is the same for
groups of any size, and sums combine map-side, so a key that holds a large share of a table is one small row from each task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deltaextract.config import EntitySpec
from deltaextract.functions import group_digest, row_hash
from deltaextract.operators.cohort import CohortLists, in_lists
from deltaextract.operators.keyfilter import KeyFilter
from deltaextract.operators.project import ROW_ALIAS, hash_columns, source_rows


def fingerprint(
    source: DataFrame,
    cohort: DataFrame,
    spec: EntitySpec,
    fy: str,
    *,
    encoding: str = "joined",
    fan_out: bool = False,
    scope: Sequence[str] = (),
    key_filter: KeyFilter | None = None,
) -> DataFrame:
    """(keys, FY, hash, hash_count) of all source rows whose key is in the cohort.

    Columns of ``scope`` are grouped by as well and follow the FY: with the period of the folder that each row lies in, what a run read of a folder can be compared
    with what an earlier one read of the same folder, whatever FY the rows have, if any.

    Rows with a null key never match. By default a key matches once however many FYs it has in ``cohort``; with
    ``fan_out`` every cohort row of the key repeats its source rows, as a plain inner join does.

    Rows are hashed and aggregated before the join, so that what is shuffled is one narrow row per group and task, whatever the
    width of the source; nothing runs while the frame is built. The join has no hint: Spark broadcasts a cohort that it knows to be small, and then applies it to
    the source rows. For a larger one, ``key_filter`` keeps most rows outside the cohort from being hashed.
    """
    keys = list(spec.keys)
    source = source_rows(source, spec).dropna(subset=keys)
    if key_filter is not None:
        source = key_filter.keep(source, keys).alias(ROW_ALIAS)
    if fan_out:
        source = source.join(cohort.select(*keys), keys, "inner")
    groups = _groups(source, spec, [fy, *scope], encoding)
    return groups if fan_out else groups.join(cohort.select(*keys).distinct(), keys, "left_semi")


def _groups(source: DataFrame, spec: EntitySpec, by: Sequence[str], encoding: str, flag: str | None = None) -> DataFrame:
    hashed = row_hash(hash_columns(spec, source.columns), encoding).alias("__hash")
    rows = source.alias(ROW_ALIAS).select(*spec.keys, *by, *[flag] * bool(flag), hashed)
    totals = [group_digest(F.col("__hash")).alias("hash"), F.count(F.lit(1)).alias("hash_count")]
    if flag:
        totals.append(F.bool_or(flag).alias("matched"))
    return rows.groupBy(*spec.keys, *by).agg(*totals)


def cohort_fingerprint(parent: DataFrame, lists: CohortLists, spec: EntitySpec, fy: str, *, encoding: str = "joined", scope: Sequence[str] = ()) -> DataFrame:
    """Cohort and fingerprints of a parent in one pass: the rows of :func:`fingerprint` with the parent's own cohort, and ``matched``, whether a row of the group is in a list.

    The cohort's keys and FYs are those of the groups that matched. Membership is an aggregate beside the digest; a key that matched in one group takes its other groups along, which is
    decided on groups, not rows. Every row of the parent is hashed, so this saves a scan but not work where the cohort is a small part of the parent;
    :func:`deltaextract.operators.cohort.cohort_keys` and then :func:`fingerprint` read it twice and hash only the cohort.
    """
    keys = list(spec.keys)
    rows, matched = in_lists(source_rows(parent, spec).dropna(subset=keys), lists)
    groups = _groups(rows.withColumn("__matched", matched), spec, [fy, *scope], encoding, "__matched")
    return groups.withColumn("__in", F.bool_or("matched").over(Window.partitionBy(*keys))).where("__in").drop("__in")
