"""Feed configuration: what to read, which columns to deliver and under which names.

Everything here is plain metadata. The mapping grammar for one entity is::

    columns    list of "col" | ["src", "alias"] | ["src", ["a1", "a2"]] | ["", "col"]
    keys       list of key columns
    encrypt    list of source columns to pseudonymise
    transform  {column: [[function, [args]], ...]}, applied left to right
    filter     SQL predicate over source columns, or null
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from typing import Any

# Fixed values of the delivery contract.
DEFAULT_TARGET_ROWS = 10_000_000
PERIOD_START = datetime(1970, 4, 1)
PERIOD_END = datetime(2999, 1, 1)


@dataclass(frozen=True)
class ColumnSpec:
    """One source column and the output names it is delivered under."""

    source: str
    outputs: tuple[str, ...]

    @classmethod
    def parse(cls, entry: str | Sequence[Any]) -> ColumnSpec:
        if isinstance(entry, str):
            return cls(entry, (entry,))
        source, names = entry
        if source == "":
            return cls(names, (names,))
        return cls(source, (names,) if isinstance(names, str) else tuple(names))


@dataclass(frozen=True)
class EntitySpec:
    """Mapping of one entity (a parent or a child)."""

    name: str
    columns: tuple[ColumnSpec, ...]
    keys: tuple[str, ...]
    encrypt: frozenset[str] = frozenset()
    transform: Mapping[str, Sequence[tuple[str, Sequence[Any]]]] = field(default_factory=dict)
    filter: str | None = None
    base_path: str | None = None

    @classmethod
    def from_mapping(cls, name: str, mapping: Mapping[str, Any], base_path: str | None = None) -> EntitySpec:
        return cls(
            name=name,
            columns=tuple(ColumnSpec.parse(c) for c in mapping["columns"]),
            keys=tuple(mapping["keys"]),
            encrypt=frozenset(mapping.get("encrypt") or ()),
            transform={c: [(f, list(args)) for f, args in steps] for c, steps in (mapping.get("transform") or {}).items()},
            filter=mapping.get("filter"),
            base_path=base_path,
        )

    @property
    def hashed_columns(self) -> list[str]:
        """Source columns that enter the fingerprint: everything configured except the keys."""
        return [c.source for c in self.columns if c.source not in self.keys]

    def outputs_of(self, source: str) -> tuple[str, ...]:
        """Output names configured for a source column; its own name when it is not listed."""
        names = tuple(o for c in self.columns if c.source == source for o in c.outputs)
        return names or (source,)


@dataclass(frozen=True)
class FamilySpec:
    """A parent entity and the children that share its keys."""

    parent: EntitySpec
    children: tuple[EntitySpec, ...] = ()

    def __iter__(self) -> Iterator[EntitySpec]:
        yield self.parent
        yield from self.children


@dataclass(frozen=True)
class Dimension:
    """Organisation list: codes whose region equals ``region`` put a parent row in the cohort."""

    code_column: str
    region_column: str
    region: str
    fact_column: str
    path: str | None = None


@dataclass(frozen=True)
class FeedSpec:
    """Everything one feed run needs."""

    name: str
    output_path: str
    fy_column: str
    datum: str
    families: tuple[FamilySpec, ...]
    dimensions: tuple[Dimension, ...]
    target_rows: int = DEFAULT_TARGET_ROWS
    fy_floor: int | None = None
    period_start: datetime = PERIOD_START
    period_end: datetime = PERIOD_END

    @property
    def entities(self) -> list[EntitySpec]:
        return [e for family in self.families for e in family]

    @classmethod
    def build(
        cls,
        name: str,
        tree: Mapping[str, Mapping[str, Any]],
        mapping: Mapping[str, Mapping[str, Any]] | str,
        **settings: Any,
    ) -> FeedSpec:
        """Join an entity tree ``{parent: {"basePath", "children": {child: {"basePath"}}}}`` with its mapping config.

        ``mapping`` is ``{"entities": {name: {...}}}`` as a dict or as JSON text.
        """
        entities = (json.loads(mapping) if isinstance(mapping, str) else mapping)["entities"]

        def entity(label: str, node: Mapping[str, Any]) -> EntitySpec:
            return EntitySpec.from_mapping(label, entities[label], node["basePath"].rstrip("/"))

        families = tuple(
            FamilySpec(entity(p, node), tuple(entity(c, sub) for c, sub in node.get("children", {}).items()))
            for p, node in tree.items()
        )
        for family in families:
            for child in family.children:
                if child.keys != family.parent.keys:
                    raise ValueError(f"{child.name}: children share the keys of their parent {family.parent.name}")
        return cls(name=name, families=families, **settings)
