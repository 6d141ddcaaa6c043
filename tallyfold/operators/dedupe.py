"""One best row per key.

All forms are `row_number() <= k` filters. Catalyst turns the filter into a
WindowGroupLimit below the exchange, so every map task ships at most k rows per key and
a key holding a third of the table costs its reducer no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed order: most confident extraction first, then newest, then highest on the page.
BEST_ORDER = (("parser_confidence", "desc"), ("scraped_at", "desc"), ("page", "asc"),
              ("rank", "asc"))
TIE = "snapshot_id"


def ordering(spec: Sequence[tuple[str, str]]) -> list[Column]:
    """Sort columns with NULLs always last."""
    directions = {"desc": Column.desc_nulls_last, "asc": Column.asc_nulls_last}
    return [directions[direction](F.col(name)) for name, direction in spec]


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int = 1):
    """The first `k` rows of every key under a total order."""
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rn") <= k).drop("_rn")


def dedupe_best(
    df: DataFrame,
    keys: Sequence[str] = ("run_id", "job_id"),
    order: Sequence[tuple[str, str]] = BEST_ORDER,
    tie: str = TIE,
) -> DataFrame:
    """Best observation per key; `tie` makes the order total.

    Sorts compare a few bytes of their first column before whole rows: the last key, the finest, comes first.
    """
    return first_per_key(df, keys[::-1], ordering([*order, (tie, "asc")]))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[tuple[str, str]]) -> DataFrame:
    """First row per key under a stated order (a plain dropDuplicates has none)."""
    return first_per_key(df, keys, ordering(order))


def top_per_group(
    df: DataFrame, group: str | Sequence[str], value: str, k: int = 1
) -> DataFrame:
    """Most frequent values per group with their share of the group; ties go by value."""
    groups = [group] if isinstance(group, str) else list(group)
    counts = df.groupBy(*groups, value).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(*groups).agg(F.sum("n").alias("group_n"))
    order = Window.partitionBy(*groups).orderBy(F.desc("n"), F.col(value).asc_nulls_last())
    top = counts.withColumn("pos", F.row_number().over(order)).where(F.col("pos") <= k)
    totals = totals.select(*[F.col(g).alias(f"_g_{g}") for g in groups], "group_n")
    joined = top.join(totals, [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in groups])
    return joined.select(
        *groups, value, "pos", "n", "group_n", (F.col("n") / F.col("group_n")).alias("share")
    )


def exclude_seen(df: DataFrame, seen: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(seen.select(*keys), list(keys), "left_anti")


def union_batches(*batches: DataFrame) -> DataFrame:
    """Append batches by column name; columns a batch lacks are NULL."""
    first, *rest = batches
    for batch in rest:
        first = first.unionByName(batch, allowMissingColumns=True)
    return first
