"""Period folder names and financial years: ``FY2012-13/`` is the year ``2012/13``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the folder naming scheme.
PERIOD_FOLDER = r"^FY(\d{4})-(\d{2})/$"


def is_period_folder(folder: Column) -> Column:
    return folder.rlike(PERIOD_FOLDER)


def folder_to_fy(folder: Column) -> Column:
    """Financial year of a period folder; any other text is returned unchanged."""
    return F.regexp_replace(folder, PERIOD_FOLDER, "$1/$2")


def folder_year(folder: Column) -> Column:
    """First calendar year of a period folder as int; null for any other text."""
    return F.regexp_replace(folder, PERIOD_FOLDER, "$1").try_cast("int")


def path_to_period(path: Column) -> Column:
    """Financial year of the period folder that a file's path goes through; null if it goes through none."""
    folder = F.regexp_extract(path, PERIOD_FOLDER.replace("^", "^.*/(").replace("/$", "/)"), 1)
    return F.when(is_period_folder(folder), folder_to_fy(folder))
