"""Submitting independent Spark jobs side by side, so that small ones do not leave the cluster idle."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

_A = TypeVar("_A")


def side_by_side(jobs: Sequence[Callable[[], _A]], concurrency: int = 4) -> list[_A]:
    """Run the jobs on up to ``concurrency`` threads; results in order, the first error is raised."""
    with ThreadPoolExecutor(concurrency) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]
