"""The star join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def star_join(fact: DataFrame, dims: Sequence[tuple[DataFrame, str | Sequence[str]]], how: str = "inner") -> DataFrame:
    """Join a fact to several dimensions, each ``(dim, key or keys)``.  No
    broadcast hints: the planner decides by the size in bytes, from file
    statistics before the run and from measured shuffles during it."""
    out = fact
    for dim, key in dims:
        out = out.join(dim, list(key) if not isinstance(key, str) else key, how)
    return out
