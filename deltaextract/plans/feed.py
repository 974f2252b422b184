"""The composed job: one incremental run of a feed."""

from __future__ import annotations

import logging
import re
from collections.abc import Callable, Collection, Iterable, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone
from functools import partial, reduce
from typing import TypeVar

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deltaextract.config import EntitySpec, FamilySpec, FeedSpec
from deltaextract.operators.changes import (
    changed_keys,
    changed_periods,
    entity_folders,
    in_periods,
    vanished_periods,
)
from deltaextract.operators.cohort import CohortLists, cohort_keys, org_filter
from deltaextract.operators.control import control_rows
from deltaextract.operators.extract import extract_delta, plain_live_keys
from deltaextract.operators.fingerprint import cohort_fingerprint, fingerprint
from deltaextract.operators.keyfilter import KeyFilter
from deltaextract.operators.project import pseudonymised, secret_outputs, without_pseudonyms
from deltaextract.operators.sizing import BROADCAST_BYTES, are_small
from deltaextract.operators.snapshot import merge_snapshot, snapshot_schema
from deltaextract.plans.concurrent import side_by_side
from deltaextract.sources.delivery import ENCODING, charset_allowed, delivered_files, write_control, write_delivery
from deltaextract.sources.folders import FOLDER_STATE, folder_listing, read_folder_state, write_folder_state
from deltaextract.sources.runs import completed_runs, read_fingerprints, read_snapshot, record_run, write_fingerprints
from deltaextract.sources.tables import READ_PERIOD, period_schema, read_periods

log = logging.getLogger(__name__)

#: Name of the group digest and of what is grouped, stored with every run: hashes of another one cannot be compared.
DIGEST = "sums of 60-bit words, by folder read"

_A = TypeVar("_A")
_B = TypeVar("_B")


@dataclass(frozen=True)
class FeedRun:
    """Outcome of a run. ``records`` are the control totals; without changed periods nothing is written."""

    run_id: str
    periods: tuple[str, ...]
    records: dict[str, int] = field(default_factory=dict)
    delivery_path: str | None = None

    @property
    def changed(self) -> bool:
        return bool(self.periods)


def live_key_label(entity: str) -> str:
    """Name of an entity's list of live keys: the entity's name, with ``Deletes`` closing the part before its suffix (``_...``), if any."""
    return re.sub(r"^[^_]*", r"\g<0>Deletes", entity, count=1)


def run_feed(
    spark: SparkSession,
    feed: FeedSpec,
    salt: str | None = None,
    run_id: str | None = None,
    *,
    hash_encoding: str = "joined",
    rehash: bool = False,
    detect_vanished: bool = False,
    retire_folders: bool = False,
    one_pass: bool = False,
    key_filter_bytes: int = BROADCAST_BYTES,
    snapshot_buckets: int = 0,
    encoding: str = ENCODING,
    full_snapshot_every: int = 30,
    concurrency: int = 4,
) -> FeedRun:
    """Find changed periods, re-fingerprint the cohort in them, deliver changed families, and roll the state forward.

    Below ``feed.output_path``: ``delivery/<run>/`` holds one folder of parts per entity, one of live keys per parent
    and the control file; ``work/<run>/`` the tables between steps; ``state/`` what the next run compares against.
    Nothing in ``state`` counts until the run's last step. Entities of a step are independent, so up to ``concurrency``
    of their jobs are submitted side by side.

    State is kept by the folder that rows were read from, so rows without an FY, or filed under another FY than their folder's, are compared with what
    the same folder held before, and go when they are gone from it.

    A period folder that has disappeared is left alone, and its keys stay alive, unless ``retire_folders``: then it counts as read and empty, so its keys leave the list
    of live keys (unless another folder holds them). If it disappeared for one entity only, the others are read again.

    ``one_pass`` reads each parent once for cohort and fingerprints, hashing all its rows; it pays where the cohort is most of the parent. Otherwise the cohort is
    found first. A cohort of more than ``key_filter_bytes`` is not broadcast, and a filter of its keys (see ``operators.keyfilter``) keeps most other rows from being hashed.

    With ``snapshot_buckets`` fingerprints are stored in so many buckets by key instead of by period, and the comparison with the snapshot shuffles neither the snapshot nor the current fingerprints. Size a
    bucket like a shuffled partition. Runs may differ in it; the comparison then shuffles as usual until all visible runs agree.

    Of two runs of a feed that overlap, the first to complete counts; the other raises :class:`deltaextract.sources.runs.Overtaken` at its end, and what it has
    written is never read.

    A snapshot that was built with other hash settings, or by a release with another digest, is refused. With ``rehash`` such a run starts
    over instead: it reads all periods, delivers every record of the cohort, and writes a full snapshot.
    """
    run_id = run_id or datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    run = _Run(spark, feed, salt, run_id, hash_encoding, rehash, retire_folders, snapshot_buckets)
    if not run.find_changes():
        log.info("%s: no changed periods", feed.name)
        return FeedRun(run.run_id, ())

    with charset_allowed(spark, encoding):

        def each(step: Callable[[_A], _B], items: Iterable[_A]) -> list[_B]:
            return side_by_side([partial(step, item) for item in items], concurrency)

        run.read_lists()
        each(lambda family: run.store_cohort(family, one_pass, key_filter_bytes), run.families)
        each(lambda member: run.store_fingerprints(*member), [m for m in run.members if not (one_pass and m[1] is m[0].parent)])
        each(lambda family: run.store_changed_keys(family, detect_vanished), run.families)
        if run.is_full(full_snapshot_every) and run.earlier:
            each(lambda member: run.carry_over(member[1]), run.members)
        deliveries = [partial(run.deliver_delta, *member, encoding) for member in run.members]
        deliveries += [partial(run.deliver_live_keys, family.parent, encoding) for family in run.families]
        outputs = side_by_side(deliveries, concurrency)
        run.write_control_file([name for name, _ in outputs], dict(outputs), encoding)
    run.complete()
    return FeedRun(run.run_id, tuple(run.fys), dict(outputs), run.delivery)


class _Run:
    """Paths and step functions of one run; every step reads and writes tables."""

    def __init__(
        self, spark: SparkSession, feed: FeedSpec, salt: str | None, run_id: str, hash_encoding: str, rehash: bool, retire_folders: bool, buckets: int
    ):
        self.spark, self.feed, self.salt, self.run_id = spark, feed, salt, run_id
        self.retire_folders, self.buckets = retire_folders, buckets
        self.fy = feed.fy_column
        root = feed.output_path.rstrip("/")
        self.state, self.work, self.delivery = f"{root}/state", f"{root}/work/{run_id}", f"{root}/delivery/{run_id}"
        self.earlier = completed_runs(spark, f"{self.state}/runs")
        # Hashes built under other settings would make records look changed; timestamps enter them as local text.
        self.hashing = {
            "time_zone": spark.conf.get("spark.sql.session.timeZone"),
            "hash_encoding": hash_encoding,
            "digest": DIGEST,
        }
        if any(r.run_id == run_id for r in self.earlier):
            raise ValueError(f"run {run_id} is complete already")
        self.seq = self.earlier[-1].seq + 1 if self.earlier else 1
        for setting, value in self.hashing.items():
            if self.earlier and self.earlier[-1][setting] != value:
                if not rehash:
                    raise ValueError(f"{setting} is {value}, the snapshot was built with {self.earlier[-1][setting]}")
                self.earlier = []
        self.fys: list[str] = []
        self.families: list[FamilySpec] = []
        self.members: list[tuple[FamilySpec, EntitySpec]] = []
        self._sources: dict[str, DataFrame] = {}
        self._folders: dict[str, str] = {}
        self._key_filters: dict[str, KeyFilter] = {}
        self._is_full = False

    # -- which periods ------------------------------------------------------------------------------------------

    def find_changes(self) -> bool:
        # Saved before anything is read: files that land during the run are seen by the next one.
        listing_path = self._folder_state(self.run_id)
        paths = {e.name: e.base_path for e in self.feed.entities}
        write_folder_state(folder_listing(self.spark, paths), listing_path)
        listing = read_folder_state(self.spark, listing_path)
        if self.earlier:
            previous = read_folder_state(self.spark, self._folder_state(self.earlier[-1].run_id))
        else:
            previous = self.spark.createDataFrame([], FOLDER_STATE)

        # Driver-side lists of folders: a few per calendar year and entity.
        periods = changed_periods(listing, previous, self.feed.fy_floor)
        if self.retire_folders:
            periods = periods.union(vanished_periods(listing, previous, self.feed.fy_floor).select("folder", "fy", "first_year")).distinct()
        self.fys = sorted(p.fy for p in periods.collect())
        if not self.fys:
            return False
        changed = entity_folders(listing, periods).collect()
        existing = listing.select("data_source", "folder").collect()
        known = {r.data_source for r in previous.select("data_source").distinct().collect()}
        self.families = [
            FamilySpec(parent, tuple(self._open(c, parent, changed, existing, known) for c in family.children))
            for family in self.feed.families
            for parent in [self._open(family.parent, family.parent, changed, existing, known)]
        ]
        self.members = [(family, entity) for family in self.families for entity in family]
        return True

    def _open(
        self, entity: EntitySpec, parent: EntitySpec, changed: Sequence[Row], existing: Sequence[Row], known: set[str]
    ) -> EntitySpec:
        """Set up the scan of an entity's changed folders."""

        def paths(rows: Sequence[Row]) -> list[str]:
            return sorted(f"{entity.base_path}/{r.folder}".rstrip("/") for r in rows if r.data_source == entity.name)

        if paths(existing):
            # Without a changed folder there are no rows to read, but the columns are those of the latest folder.
            schema = None if paths(changed) else period_schema(self.spark, paths(existing)[-1:])
            self._sources[entity.name] = read_periods(self.spark, paths(changed), schema, with_period=True)
            return entity
        if entity.name in known:
            raise ValueError(f"{entity.name}: all folders below {entity.base_path} are gone since the last run")
        log.warning("%s: no folders yet", entity.name)
        key_types = {f.name: f.dataType for f in self._sources[parent.name].schema} if parent is not entity else {}
        names = dict.fromkeys(
            [*entity.keys, self.fy, *(c.source for c in entity.columns), *(d.fact_column for d in self.feed.dimensions)]
        )
        fields = [T.StructField(n, key_types.get(n, T.StringType()) if n in entity.keys else T.StringType()) for n in names]
        self._sources[entity.name] = read_periods(self.spark, [], T.StructType(fields), with_period=True)
        return replace(entity, filter=None, transform={})

    # -- which records ------------------------------------------------------------------------------------------

    def read_lists(self) -> None:
        pairs = []
        for i, d in enumerate(self.feed.dimensions):
            path = f"{self.work}/organisations_{i}"
            codes = org_filter(self.spark.read.parquet(d.path), d.code_column, d.region_column, d.region)
            codes.write.mode("overwrite").parquet(path)
            pairs.append((self.spark.read.schema(codes.schema).parquet(path), d.fact_column))
        self.lists = CohortLists.measure(pairs)

    def store_cohort(self, family: FamilySpec, one_pass: bool, key_filter_bytes: int) -> None:
        parent, source = family.parent, self._sources[family.parent.name]
        key_fy = [*parent.keys, self.fy]
        if one_pass:
            found = cohort_fingerprint(source, self.lists, parent, self.fy, encoding=self.hashing["hash_encoding"], scope=[READ_PERIOD])
            # Its flag is stored beside the fingerprints, where nobody else reads it.
            write_fingerprints(found, self._fingerprints(parent), parent.keys, READ_PERIOD, self.buckets)
            keys = read_fingerprints(self.spark, self._fingerprints(parent), found.schema, parent.keys, self.buckets).where("matched").select(*key_fy).distinct()
        else:
            keys = cohort_keys(source, self.lists, parent, self.fy)
        keys.write.mode("overwrite").parquet(self._cohort(family))
        cohort = self.spark.read.schema(keys.schema).parquet(self._cohort(family))
        if not are_small([cohort], key_filter_bytes):
            made = KeyFilter.of(cohort, parent.keys)
            path = f"{self.work}/{parent.name}_key_filter"
            made.bitmaps.write.mode("overwrite").parquet(path)
            self._key_filters[parent.name] = replace(made, bitmaps=self.spark.read.schema(made.bitmaps.schema).parquet(path))

    def store_fingerprints(self, family: FamilySpec, entity: EntitySpec) -> None:
        cohort = self.spark.read.parquet(self._cohort(family))
        current = fingerprint(
            self._sources[entity.name],
            cohort,
            entity,
            self.fy,
            encoding=self.hashing["hash_encoding"],
            scope=[READ_PERIOD],
            key_filter=self._key_filters.get(family.parent.name),
        )
        write_fingerprints(current, self._fingerprints(entity), entity.keys, READ_PERIOD, self.buckets)

    def store_changed_keys(self, family: FamilySpec, detect_vanished: bool) -> None:
        pairs = [(self._current(e), in_periods(self._previous(e), self.fys, READ_PERIOD)) for e in family]
        cohort = self.spark.read.parquet(self._cohort(family))
        keys = changed_keys(pairs, family.parent.keys, detect_vanished=detect_vanished, cohort=cohort, in_place=self.buckets > 0)
        # What is extracted is in the cohort now, whatever made it look changed.
        keys = keys.join(cohort.select(*family.parent.keys), list(family.parent.keys), "left_semi")
        keys.write.mode("overwrite").parquet(self._changed(family))

    # -- what is delivered --------------------------------------------------------------------------------------

    def deliver_delta(self, family: FamilySpec, entity: EntitySpec, encoding: str) -> tuple[str, int]:
        changed, source = self.spark.read.parquet(self._changed(family)), self._sources[entity.name]
        delta = extract_delta(source, changed, without_pseudonyms(entity))
        names = secret_outputs(entity, source.columns, [c.source for c in entity.columns])
        return entity.name, self._deliver(delta, entity, names, entity.name, entity.name, encoding)

    def deliver_live_keys(self, parent: EntitySpec, encoding: str) -> tuple[str, int]:
        runs = [*self.earlier, self._record()]
        if self._is_full:
            runs = runs[-1:]
        snapshot = read_snapshot(self.spark, self._snapshot(parent), self._schema(parent), parent.keys, READ_PERIOD, runs)
        names = secret_outputs(parent, parent.keys, parent.keys)
        return f"{parent.name}Deletes", self._deliver(plain_live_keys(snapshot, parent), parent, names, f"{parent.name}Deletes", live_key_label(parent.name), encoding)

    def _deliver(self, frame: DataFrame, entity: EntitySpec, secret: Collection[str], name: str, folder: str, encoding: str) -> int:
        # Stored as parquet first: the row count then comes from file footers, not from a second evaluation. Pseudonyms are made when rows are in their parts.
        path = f"{self.work}/{name}_out"
        frame.write.mode("overwrite").parquet(path)
        out = self.spark.read.schema(frame.schema).parquet(path)
        self._folders[name] = f"{self.delivery}/{folder}"
        return write_delivery(out, self._folders[name], self.feed.target_rows, encoding=encoding, finish=lambda rows: pseudonymised(rows, entity, secret, self.salt))

    def write_control_file(self, names: Sequence[str], records: dict[str, int], encoding: str) -> None:
        # A row for each file; their names are never gathered.
        entries = [delivered_files(self.spark, self._folders[n]).select(F.array("file").alias("files"), F.lit(records[n]).alias("records")) for n in names]
        rows = reduce(DataFrame.unionByName, entries)
        control = control_rows(rows, self.feed.datum, self.feed.period_start, self.feed.period_end)
        write_control(control, f"{self.delivery}/{self.feed.name}_control", encoding)

    # -- state --------------------------------------------------------------------------------------------------

    def is_full(self, every: int) -> bool:
        """Whether this run's fingerprints are completed to a full snapshot, so that older runs are no longer read."""
        self._is_full = not self.earlier or len(self.earlier) >= every
        return self._is_full

    def carry_over(self, entity: EntitySpec) -> None:
        kept = merge_snapshot(self._current(entity).limit(0), self._previous(entity), self.fys, READ_PERIOD)
        write_fingerprints(kept, self._fingerprints(entity), entity.keys, READ_PERIOD, self.buckets, mode="append")

    def complete(self) -> None:
        record_run(self.spark, f"{self.state}/runs", self._record())

    def _record(self) -> Row:
        return Row(seq=self.seq, run_id=self.run_id, fys=self.fys, full=self._is_full, **self.hashing, buckets=self.buckets)

    def _schema(self, entity: EntitySpec) -> T.StructType:
        source = self._sources[entity.name].schema
        return snapshot_schema([source[k] for k in entity.keys], self.fy, [READ_PERIOD])

    def _current(self, entity: EntitySpec) -> DataFrame:
        return read_fingerprints(self.spark, self._fingerprints(entity), self._schema(entity), entity.keys, self.buckets)

    def _previous(self, entity: EntitySpec) -> DataFrame:
        return read_snapshot(self.spark, self._snapshot(entity), self._schema(entity), entity.keys, READ_PERIOD, self.earlier)

    def _folder_state(self, run_id: str) -> str:
        return f"{self.state}/folders/{run_id}"

    def _snapshot(self, entity: EntitySpec) -> str:
        return f"{self.state}/snapshot/{entity.name}"

    def _fingerprints(self, entity: EntitySpec) -> str:
        return f"{self._snapshot(entity)}/run={self.run_id}"

    def _cohort(self, family: FamilySpec) -> str:
        return f"{self.work}/{family.parent.name}_cohort"

    def _changed(self, family: FamilySpec) -> str:
        return f"{self.work}/{family.parent.name}_changed"
