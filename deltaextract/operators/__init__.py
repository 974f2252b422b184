from deltaextract.operators.changes import (
    changed_entity_keys,
    changed_folder_list,
    changed_keys,
    changed_periods,
    entity_folders,
    family_changes,
    in_periods,
    outside_periods,
    previous_in_scope,
    vanished_periods,
)
from deltaextract.operators.cohort import CohortLists, cohort_keys, org_filter
from deltaextract.operators.control import control_rows, part_count, record_counts
from deltaextract.operators.extract import extract_delta, live_keys
from deltaextract.operators.fingerprint import cohort_fingerprint, fingerprint
from deltaextract.operators.keyfilter import KeyFilter
from deltaextract.operators.project import project, project_keys, source_rows
from deltaextract.operators.snapshot import carry_over, merge_snapshot, snapshot_schema

__all__ = [
    "CohortLists",
    "KeyFilter",
    "carry_over",
    "changed_entity_keys",
    "changed_folder_list",
    "changed_keys",
    "changed_periods",
    "cohort_fingerprint",
    "cohort_keys",
    "control_rows",
    "entity_folders",
    "extract_delta",
    "family_changes",
    "fingerprint",
    "in_periods",
    "live_keys",
    "merge_snapshot",
    "org_filter",
    "outside_periods",
    "part_count",
    "previous_in_scope",
    "project",
    "project_keys",
    "record_counts",
    "snapshot_schema",
    "source_rows",
    "vanished_periods",
]
