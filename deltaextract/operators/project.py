"""Config-driven projections: the columns that are hashed, delivered, or listed as live keys."""

from __future__ import annotations

from collections.abc import Collection, Iterable
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deltaextract.config import EntitySpec
from deltaextract.functions import apply_transforms, pseudonymise

# Source rows carry this alias, so filters and expressions may write ``e.column``.
ROW_ALIAS = "e"


def source_rows(source: DataFrame, spec: EntitySpec) -> DataFrame:
    """Source rows that pass the entity's optional SQL filter. The filter sees source columns and source values."""
    rows = source.alias(ROW_ALIAS)
    return rows if spec.filter is None else rows.where(spec.filter)


def _value(spec: EntitySpec, column: str) -> Column:
    return apply_transforms(F.col(f"{ROW_ALIAS}.`{column}`"), spec.transform.get(column, ()), column)


def hash_columns(spec: EntitySpec, available: Collection[str]) -> list[Column]:
    """Non-key columns after transforms, before pseudonymisation; a column the source lacks counts as empty text."""
    return [_value(spec, c) if c in available else F.lit("") for c in spec.hashed_columns]


def _delivered(
    spec: EntitySpec, available: Collection[str], salt: str | None, columns: Iterable[tuple[str, tuple[str, ...]]]
) -> list[Column]:
    out: list[Column] = []
    for source, names in columns:
        if source not in available:
            out.append(F.lit("").alias(source))
            continue
        value = _value(spec, source)
        if source in spec.encrypt:
            if salt is None:
                raise ValueError(f"{spec.name}.{source} is pseudonymised: a salt is needed")
            value = pseudonymise(value, salt)
        out.extend(value.alias(name) for name in names)
    return out


def project(source: DataFrame, spec: EntitySpec, salt: str | None = None) -> DataFrame:
    """All configured columns: transformed, pseudonymised and renamed.

    A configured column absent from the source becomes ``""`` under its source name.
    """
    columns = ((c.source, c.outputs) for c in spec.columns)
    return source.alias(ROW_ALIAS).select(*_delivered(spec, source.columns, salt, columns))


def without_pseudonyms(spec: EntitySpec) -> EntitySpec:
    """The same entity, delivered with plain values."""
    return replace(spec, encrypt=frozenset())


def secret_outputs(spec: EntitySpec, available: Collection[str], sources: Iterable[str]) -> set[str]:
    """Names under which pseudonyms of these source columns are delivered."""
    return {name for source in sources if source in spec.encrypt and source in available for name in spec.outputs_of(source)}


def pseudonymised(plain: DataFrame, spec: EntitySpec, names: Collection[str], salt: str | None = None) -> DataFrame:
    """Rows of an entity :func:`without_pseudonyms`, as they are delivered otherwise: ``names`` (:func:`secret_outputs`) become pseudonyms.

    Pseudonyms are 64 characters that do not compress, so rows are better counted, stored and dealt out before.
    """
    if names and salt is None:
        raise ValueError(f"{spec.name}: {', '.join(sorted(names))} are pseudonymised: a salt is needed")
    return plain.select(*[pseudonymise(F.col(f"`{n}`"), salt).alias(n) if n in names else F.col(f"`{n}`") for n in plain.columns])


def project_keys(source: DataFrame, spec: EntitySpec, salt: str | None = None) -> DataFrame:
    """The key columns exactly as :func:`project` delivers them."""
    columns = ((k, spec.outputs_of(k)) for k in spec.keys)
    return source.alias(ROW_ALIAS).select(*_delivered(spec, source.columns, salt, columns))
