"""Named column transforms usable from the mapping config.

A transform is a function ``(column, *args) -> Column`` built from native expressions, so a chain stays inside
whole-stage codegen. Users add their own with :func:`register_transform`.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

Transform = Callable[..., Column]

_TRANSFORMS: dict[str, Transform] = {}


def register_transform(name: str, build: Transform) -> None:
    """Make ``build(column, *args)`` available to mapping configs as ``name``."""
    _TRANSFORMS[name] = build


def registered_transforms() -> list[str]:
    return sorted(_TRANSFORMS)


def apply_transforms(column: Column, steps: Sequence[tuple[str, Sequence[Any]]], label: str = "") -> Column:
    """Fold a chain of named transforms over ``column``."""

    def step(value: Column, call: tuple[str, Sequence[Any]]) -> Column:
        name, args = call
        if name not in _TRANSFORMS:
            raise ValueError(f"unknown transform {name!r} for column {label!r}; known: {registered_transforms()}")
        return _TRANSFORMS[name](value, *args)

    return reduce(step, steps, column)


# A value that is not a date becomes null, also under ANSI mode. Any format argument is accepted and ignored.
register_transform("to_date", lambda column, *_ignored: column.try_cast("date"))
# Replaces the column, and with it all earlier steps, by any SQL expression over the source row.
register_transform("expr", lambda _column, sql: F.expr(sql))
# String arguments name other source columns.
register_transform("concat", lambda column, *others: F.concat(column, *[F.col(o) for o in others]))
register_transform("instr", lambda column, text: F.instr(column, text))
register_transform("left", lambda column, length: F.substring(column, 1, length))
register_transform("substring", lambda column, start, length: F.substring(column, start, length))
