from deltaextract.functions.hashing import group_digest, pseudonymise, row_hash
from deltaextract.functions.periods import folder_to_fy, folder_year, is_period_folder, path_to_period
from deltaextract.functions.transforms import apply_transforms, register_transform, registered_transforms

__all__ = [
    "apply_transforms",
    "folder_to_fy",
    "folder_year",
    "group_digest",
    "is_period_folder",
    "path_to_period",
    "pseudonymise",
    "register_transform",
    "registered_transforms",
    "row_hash",
]
