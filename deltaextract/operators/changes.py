"""What changed since the last run: period folders, and keys within them."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deltaextract.functions import folder_to_fy, folder_year, is_period_folder

log = logging.getLogger(__name__)


def changed_periods(listing: DataFrame, previous: DataFrame, floor: int | None = None) -> DataFrame:
    """Distinct (folder, fy, first_year) of folders that are new or have another modification time than before.

    A folder that changed for any data source counts for all of them. Folders not named like a period are ignored.
    """
    changed = listing.join(previous, ["data_source", "folder", "last_modified"], "left_anti")
    periods = changed.where(is_period_folder(F.col("folder"))).select(
        "folder", folder_to_fy(F.col("folder")).alias("fy"), folder_year(F.col("folder")).alias("first_year")
    )
    if floor is not None:
        periods = periods.where(F.col("first_year") >= floor)
    return periods.distinct().orderBy("folder")


def vanished_periods(listing: DataFrame, previous: DataFrame, floor: int | None = None) -> DataFrame:
    """Distinct (data_source, folder, fy, first_year) of period folders that were listed before and are not any more.

    What was read of them has no source left. A run that counts such a period among those it has read retires its fingerprints.
    """
    gone = previous.select("data_source", "folder").join(listing.select("data_source", "folder"), ["data_source", "folder"], "left_anti")
    periods = gone.where(is_period_folder(F.col("folder"))).select(
        "data_source", "folder", folder_to_fy(F.col("folder")).alias("fy"), folder_year(F.col("folder")).alias("first_year")
    )
    if floor is not None:
        periods = periods.where(F.col("first_year") >= floor)
    return periods.distinct()


def changed_folder_list(periods: DataFrame) -> DataFrame:
    """One row: the sorted array of changed folders (one element per period, so its size is that of the calendar)."""
    return periods.agg(F.sort_array(F.collect_set("folder")).alias("folders"))


def entity_folders(listing: DataFrame, periods: DataFrame) -> DataFrame:
    """Per data source, the changed folders it really has."""
    existing = listing.select("data_source", "folder").distinct()
    return existing.join(periods.select("folder"), "folder", "left_semi").select("data_source", "folder")


def in_periods(snapshot: DataFrame, fys: Sequence[str], fy: str) -> DataFrame:
    """Snapshot rows of the given FYs; a static predicate, so an FY-partitioned table is pruned when planned."""
    return snapshot.where(F.col(fy).isin(list(fys)))


def outside_periods(snapshot: DataFrame, fys: Sequence[str], fy: str) -> DataFrame:
    """Snapshot rows of all other FYs, including rows without one."""
    return snapshot.where(F.col(fy).isNull() | ~F.col(fy).isin(list(fys)))


def previous_in_scope(snapshot: DataFrame, periods: DataFrame, fy: str) -> DataFrame:
    """:func:`in_periods` for FYs that are themselves a frame."""
    return snapshot.join(periods.select(F.col("fy").alias(fy)), fy, "left_semi")


def changed_entity_keys(current: DataFrame, previous: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of current fingerprints that the previous snapshot does not hold with the same hash (new or edited)."""
    return current.join(previous.select(*keys, "hash"), [*keys, "hash"], "left_anti").select(*keys)


def family_changes(family: Iterable[tuple[DataFrame, DataFrame]], keys: Sequence[str], *, in_place: bool = False) -> DataFrame:
    """What happened to each key of a family, from (current, previous in scope) pairs of its members, parent first: keys and three booleans.

    ``changed``: a member's current fingerprint is not in its previous snapshot. ``known``: the family had fingerprints before. ``lost``: a child's
    rows of this key have all gone. A key that is ``changed`` is new if it is not ``known`` and edited otherwise; one that has only ``lost`` something shows no current trace of it.

    All fingerprints of the family are dealt out once, by key, and counted there by member and hash; hashes and flags are all that moves. A key has few
    fingerprints (one for each member, FY and folder), so no key is hot. With ``in_place`` nothing is dealt out here: frames
    that are tables of equally many buckets by key then meet without a shuffle, and others as Spark sees fit.
    """
    # Keys under names of their own: Spark sees that a union of tables is dealt out like each of them only if their attributes are not those of a named table.
    named = [f"__key_{k}" for k in keys]
    sides = []
    for member, pair in enumerate(family):
        for side, frame in enumerate(pair):
            columns = [F.col(f"`{k}`").alias(n) for k, n in zip(keys, named, strict=True)]
            sides.append(frame.select(*columns, "hash", F.lit(member).alias("__member"), F.lit(side == 0).alias("__current")))
    members = range(len(sides) // 2)
    placed = reduce(DataFrame.unionByName, sides)
    placed = placed if in_place else placed.repartition(*named)
    current, previous = F.col("__current"), ~F.col("__current")
    hashes = placed.groupBy(*named, "__member", "hash").agg(F.bool_or(current).alias("__current"), F.bool_or(previous).alias("__previous"))

    def gone(member: int) -> Column:
        of = F.col("__member") == member
        return F.bool_or(of & F.col("__previous")) & ~F.bool_or(of & F.col("__current"))

    flags = hashes.groupBy(*named).agg(
        F.bool_or(F.col("__current") & ~F.col("__previous")).alias("changed"),
        F.bool_or("__previous").alias("known"),
        reduce(lambda a, b: a | b, [gone(m) for m in members if m > 0], F.lit(False)).alias("lost"),
    )
    return flags.select(*[F.col(n).alias(k) for k, n in zip(keys, named, strict=True)], "changed", "known", "lost")


def changed_keys(
    family: Iterable[tuple[DataFrame, DataFrame]],
    keys: Sequence[str],
    *,
    detect_vanished: bool = False,
    cohort: DataFrame | None = None,
    in_place: bool = False,
) -> DataFrame:
    """Distinct keys changed in any member of a family, from (current, previous in scope) pairs, parent first.

    Removed parents show by absence from the live-key list. A child whose rows of one key have all gone leaves no
    current fingerprint; ``detect_vanished`` adds those keys, so that the family is sent again without them. A record that
    has left the cohort looks the same from its children's side, and must not be sent: only keys of ``cohort``, the current one,
    are added.
    """
    if detect_vanished and cohort is None:
        raise ValueError("vanished keys need the current cohort")
    found = family_changes(family, keys, in_place=in_place)
    if not detect_vanished:
        return found.where("changed").select(*keys)
    candidates = found.where("changed OR lost").join(cohort.select(*keys).distinct().withColumn("__here", F.lit(True)), list(keys), "left")
    return candidates.where("changed OR (lost AND __here)").select(*keys)
