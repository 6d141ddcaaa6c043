"""Bootstrap intervals of a share, computed from bucket sums instead of resampled rows.

Every row belongs to one of a fixed number of buckets by a hash of its key. A replicate draws a
Poisson(1) count for every bucket, from a hash of bucket and replicate, and weighs the bucket's sums
with it: that is a bootstrap over the buckets, whose interval is that over rows as long as rows are
dealt independently of the outcome. One aggregation reads the table; the draws are made once, as one
vector per replicate, and a group multiplies its list of bucket sums with each. The draws depend on
keys only, so the result does not depend on partitions, and any engine with MD5 repeats it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.functions.identity import hash32
from tallyfold.operators.shares import inverse_weight

# 500 replicates, seed 42, first and last of the 40-quantiles.
SAMPLES = 500
SEED = 42
PARTS = 40
BUCKETS = 1000
# Larger counts lie below the 32-bit grid of the draws.
POISSON_MAX = 12


def quantile_points(samples: int, parts: int = PARTS) -> tuple[tuple[int, int], tuple[int, int]]:
    """(lower index, remainder) of the first and last exclusive quantile, 1-based."""
    m = samples + 1
    points = []
    for i in (1, parts - 1):
        j = min(max(i * m // parts, 1), samples - 1)
        points.append((j, i * m - j * parts))
    return points[0], points[1]


def interval(sorted_shares: Column, samples: int) -> tuple[Column, Column]:
    """Lower and upper bound read from the sorted replicate shares."""
    def at(point: tuple[int, int]) -> Column:
        j, rest = point
        below = F.element_at(sorted_shares, j)
        above = F.element_at(sorted_shares, j + 1)
        return (below * (PARTS - rest) + above * rest) / PARTS

    first, last = quantile_points(samples)
    return at(first), at(last)


def poisson_steps(bits: int = 32) -> list[int]:
    """Thresholds of the Poisson(1) distribution function on a `bits`-bit integer."""
    total, steps = 0.0, []
    for k in range(POISSON_MAX):
        total += math.exp(-1.0) / math.factorial(k)
        steps.append(int(total * 2**bits))
    return steps


def poisson_one(u: Column) -> Column:
    steps = poisson_steps()
    draw = F.when(u < steps[0], F.lit(0))
    for k, limit in enumerate(steps[1:], start=1):
        draw = draw.when(u < limit, F.lit(k))
    return draw.otherwise(F.lit(len(steps)))


def draw_vectors(spark: SparkSession, samples: int, seed: int, buckets: int) -> DataFrame:
    """One row: for each replicate the array of its draws, one per bucket. They depend on bucket and
    replicate only, so all groups of a query share them: samples x buckets bytes."""
    replicates = spark.range(samples).select(
        F.col("id").cast("int").alias("_rep"),
        F.transform(
            F.sequence(F.lit(0), F.lit(buckets - 1)),
            lambda b: poisson_one(hash32(F.lit(seed), b, F.col("id"))).cast("tinyint"),
        ).alias("_draws"),
    )
    # As many entries as replicates.
    ordered = F.array_sort(F.collect_list(F.struct("_rep", "_draws")))
    return replicates.agg(F.transform(ordered, lambda x: x["_draws"]).alias("vectors"))


def bootstrap_shares(
    df: DataFrame,
    conditions: Mapping[str, Column],
    key: Sequence[str],
    weight: str | None = None,
    by: Sequence[str] = (),
    samples: int = SAMPLES,
    seed: int = SEED,
    buckets: int = BUCKETS,
) -> DataFrame:
    """For each named condition the share of rows meeting it, with a 95 % interval, as (by, metric,
    observed, lower, upper); no rows give 0, 0, 0.

    `key` names the columns that tell rows apart. With `weight`, rows count by its inverse. One
    aggregation over the rows leaves a group's bucket sums, one list of at most `buckets` entries; a
    replicate is the product of that list with its vector of draws, so no replicate ever becomes a row.
    Very small groups rest on few buckets, and their intervals are as coarse as that.
    """
    one = F.lit(1.0) if weight is None else inverse_weight(weight)
    names = list(conditions)
    hits = [
        F.sum(F.when(F.coalesce(c, F.lit(False)), one).otherwise(0.0)).alias(f"_hit{i}")
        for i, c in enumerate(conditions.values())
    ]
    cells = df.groupBy(*by, (hash32(F.lit(seed), *key) % buckets).cast("int").alias("_bucket")).agg(
        F.sum(one).alias("_all"), *hits
    )
    # As many entries as buckets, in order: sums of floats then repeat themselves.
    entry = F.struct("_bucket", "_all", *[f"_hit{i}" for i in range(len(names))])
    lists = cells.groupBy(*by).agg(F.array_sort(F.collect_list(entry)).alias("_cells"))
    vectors = draw_vectors(df.sparkSession, samples, seed, buckets).scalar()

    def summed(draws: Column | None) -> Column:
        """Sums over the cells, each weighed by its draw."""
        def add(acc: Column, cell: Column) -> Column:
            drawn = F.lit(1.0) if draws is None else F.get(draws, cell["_bucket"]).cast("double")
            return F.struct(*[
                (acc[n] + drawn * cell[n]).alias(n) for n in ("_all", *(f"_hit{i}" for i in range(len(names))))
            ])

        zero = F.struct(*[F.lit(0.0).alias(n) for n in ("_all", *(f"_hit{i}" for i in range(len(names))))])
        return F.aggregate("_cells", zero, add)

    def share(i: int) -> Callable[[Column], Column]:
        return lambda sums: F.coalesce(F.try_divide(sums[f"_hit{i}"], sums["_all"]), F.lit(0.0))

    replicated = lists.withColumn("_vectors", vectors).select(
        *by, summed(None).alias("_whole"), F.transform("_vectors", summed).alias("_replicates")
    )
    bounds = []
    for i, name in enumerate(names):
        shares = F.array_sort(F.transform("_replicates", share(i)))
        low, high = interval(shares, samples)
        observed = share(i)(F.col("_whole"))
        bounds.append(F.struct(
            F.lit(name).alias("metric"), observed.alias("observed"),
            F.coalesce(low, F.lit(0.0)).alias("lower"), F.coalesce(high, F.lit(0.0)).alias("upper"),
        ))
    return replicated.select(*by, F.inline(F.array(*bounds)))


def bootstrap_ci(
    df: DataFrame,
    condition: Column,
    key: Sequence[str],
    weight: str | None = None,
    by: Sequence[str] = (),
    samples: int = SAMPLES,
    seed: int = SEED,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Share of rows meeting `condition` with a 95 % interval; see `bootstrap_shares`."""
    one = bootstrap_shares(df, {"share": condition}, key, weight, by, samples, seed, buckets)
    return one.drop("metric")
