"""Vertical concatenation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_snapshots(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames; names and types must agree, as Spark would widen types."""
    if not frames:
        raise ValueError("nothing to concatenate")
    expected = sorted((f.name, f.dataType.simpleString()) for f in frames[0].schema)
    for position, frame in enumerate(frames[1:], start=2):
        found = sorted((f.name, f.dataType.simpleString()) for f in frame.schema)
        if found != expected:
            differing = sorted(set(found) ^ set(expected))
            raise ValueError(f"frame {position} differs from the first in {differing}")
    return reduce(DataFrame.unionByName, frames)
