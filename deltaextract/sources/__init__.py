from deltaextract.sources.buckets import dealt_out, read_buckets, write_buckets
from deltaextract.sources.delivery import delivered_files, write_control, write_delivery
from deltaextract.sources.folders import folder_listing, read_folder_state, write_folder_state
from deltaextract.sources.shared import shared_dir, stored
from deltaextract.sources.tables import READ_PERIOD, period_schema, read_or_empty, read_periods, schema_groups, write_by_period

__all__ = [
    "READ_PERIOD",
    "dealt_out",
    "delivered_files",
    "folder_listing",
    "period_schema",
    "read_buckets",
    "read_folder_state",
    "read_or_empty",
    "read_periods",
    "schema_groups",
    "shared_dir",
    "stored",
    "write_buckets",
    "write_by_period",
    "write_control",
    "write_delivery",
    "write_folder_state",
]
