"""Settings of the four hospital-activity feeds this library was made for; paths and mapping stay with the user."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from deltaextract.config import Dimension, FeedSpec

# Source column names, region code and sizes of these feeds.
REGION = "Y59"
PROVIDERS = {"code_column": "Organisation_Code", "region_column": "Region_Code", "fact_column": "Der_Provider_Code"}
GP_PRACTICES = {"code_column": "GP_Code", "region_column": "GP_Region_Code", "fact_column": "GP_Practice_Code"}
PRESETS: dict[str, dict[str, Any]] = {
    "inpatient_daily": {
        "fy_column": "Der_Spell_Financial_Year",
        "datum": "Discharge_Date",
        "target_rows": 10_000_000,
        "fy_floor": None,
    },
    "inpatient_history": {
        "fy_column": "Der_Spell_Financial_Year",
        "datum": "Discharge_Date",
        "target_rows": 10_000_000,
        "fy_floor": 2015,
    },
    "emergency": {
        "fy_column": "Der_Financial_Year",
        "datum": "Arrival_Date",
        "target_rows": 10_000_000,
        "fy_floor": None,
    },
    "outpatient": {
        "fy_column": "Der_Financial_Year",
        "datum": "Appointment_Date",
        "target_rows": 20_000_000,
        "fy_floor": 2015,
    },
}


def organisation_lists(providers_path: str, gp_path: str, region: str = REGION) -> Sequence[Dimension]:
    return (
        Dimension(path=providers_path, region=region, **PROVIDERS),
        Dimension(path=gp_path, region=region, **GP_PRACTICES),
    )


def feed_from_preset(
    preset: str,
    tree: Mapping[str, Mapping[str, Any]],
    mapping: Mapping[str, Mapping[str, Any]] | str,
    *,
    output_path: str,
    providers_path: str,
    gp_path: str,
    **overrides: Any,
) -> FeedSpec:
    settings = {"dimensions": organisation_lists(providers_path, gp_path), **PRESETS[preset], **overrides}
    return FeedSpec.build(settings.pop("name", preset), tree, mapping, output_path=output_path, **settings)
