"""The rows to deliver, and the list of keys still alive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deltaextract.config import EntitySpec
from deltaextract.operators.project import project, project_keys, pseudonymised, secret_outputs, source_rows, without_pseudonyms


def extract_delta(source: DataFrame, changed: DataFrame, spec: EntitySpec, salt: str | None = None) -> DataFrame:
    """All source rows of changed keys, projected as configured.

    A left semi join without a hint: Spark broadcasts the keys when they are small and otherwise splits skewed keys.
    """
    return project(source_rows(source, spec).join(changed, list(spec.keys), "left_semi"), spec, salt)


def live_keys(snapshot: DataFrame, spec: EntitySpec, salt: str | None = None) -> DataFrame:
    """Distinct keys of the current snapshot as delivered; a receiver drops what is not in it."""
    return pseudonymised(plain_live_keys(snapshot, spec), spec, secret_outputs(spec, spec.keys, spec.keys), salt)


def plain_live_keys(snapshot: DataFrame, spec: EntitySpec) -> DataFrame:
    """:func:`live_keys` before pseudonymisation; there are as many."""
    # Raw keys are made distinct first. The second time is for keys that a transform, or their text (which is what is pseudonymised), makes equal.
    plain = project_keys(snapshot.select(*spec.keys).distinct(), without_pseudonyms(spec))
    texts = secret_outputs(spec, spec.keys, spec.keys)
    return plain.select(*[F.col(f"`{n}`").cast("string").alias(n) if n in texts else F.col(f"`{n}`") for n in plain.columns]).distinct()
