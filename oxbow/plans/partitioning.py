"""Parallelism for write-heavy stages.

A scan yields one task per file split, so a small input can arrive as one
partition, and a join can leave uneven ones. ``spread`` asks for partitions of
the advisory size before a stage whose cost is per row (file encoding); the
planner splits and merges them at run time, and nothing runs beforehand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    return df.hint("rebalance")
