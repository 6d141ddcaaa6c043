"""Distinct counts that add up: HyperLogLog sketches stored per group and merged.

An exact distinct count over several runs has to see their facts again. A sketch of a group is a few
kilobytes however many rows it has; sketches of runs, cities or days are merged into the count of any
union of them without a fact being read. The relative error is about 0.8 % at 14 bits, whatever the size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sketches have 2^14 counters; their standard error is 1.04 / sqrt of that, less a little.
BITS = 14


def key_sketches(df: DataFrame, key: str | Column, by: Sequence[str], bits: int = BITS) -> DataFrame:
    """by, sketch and rows of each group. Null keys count as nothing."""
    value = F.col(key) if isinstance(key, str) else key
    return df.groupBy(*by).agg(
        F.hll_sketch_agg(value, F.lit(bits)).alias("sketch"), F.count(F.lit(1)).alias("rows")
    )


def merge_sketches(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sketches of the unions of groups: `by` is a part of their columns, or none for all together."""
    return sketches.groupBy(*by).agg(
        F.hll_union_agg("sketch").alias("sketch"), F.sum("rows").alias("rows")
    )


def estimated(sketches: DataFrame, name: str = "jobs") -> DataFrame:
    """The sketches' counts in their place."""
    kept = [c for c in sketches.columns if c != "sketch"]
    return sketches.select(*kept, F.hll_sketch_estimate("sketch").alias(name))
