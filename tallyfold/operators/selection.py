"""Where a running total reaches a limit in a fixed order, found without sorting.

Radix selection: a histogram of the highest eight bits of the sort key, combined map-side, says in
which of 256 ranges the limit of each group is reached; the next histogram refines that range alone.
After a few levels the range holds few rows, and only those need an order. Each level reads the
narrow input once and gives one row per group; no window sees more than 256 rows of a group.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.session import stored

DIGIT_BITS = 8
# A range with this many rows is not refined any further.
ENOUGH = 2000


@dataclass(frozen=True)
class Edge:
    """plan: group, edge, room, held. Rows of a group whose key, shifted right by `shift`, is below
    `edge` lie within the limit; the `held` rows that equal it share what is left, `room`."""

    plan: DataFrame
    shift: int

    def below(self, key: Column) -> Column:
        return F.shiftright(key, self.shift) < F.col("edge")

    def at(self, key: Column) -> Column:
        return F.shiftright(key, self.shift) == F.col("edge")


def radix_edge(
    rows: DataFrame, group: str, key: str, limits: DataFrame, bits: int,
    amount: Column | None = None, enough: int = ENOUGH,
) -> Edge:
    """The range of `key` (a bigint of `bits` bits, not negative) in which each group's running total of
    `amount` reaches its limit.

    `limits` has one row per group with `room`; groups without one, and limits of 0 or less, have no edge. A
    group that stays below its limit has its edge in the highest range. More than `enough` rows are
    left in an edge only where they all share one key.
    """
    amount = F.lit(1) if amount is None else amount
    # Written, so that Spark knows its size and chooses between broadcast and shuffle by it.
    plan = stored(
        limits.select(group, F.lit(0).cast("bigint").alias("edge"), F.col("room").cast("bigint")), "limits"
    )
    running = Window.partitionBy(group).orderBy("edge").rowsBetween(Window.unboundedPreceding, 0)
    shift = bits
    while shift > 0:
        above, shift = shift, max(0, shift - DIGIT_BITS)
        inside = rows.join(plan.select(group, F.col("edge").alias("_edge"), "room"), group).where(
            F.shiftright(key, above) == F.col("_edge")
        )
        counts = inside.groupBy(group, "room", F.shiftright(key, shift).alias("edge")).agg(
            F.sum(amount).alias("_sum"), F.count(F.lit(1)).alias("held")
        )
        before = F.sum("_sum").over(running) - F.col("_sum")
        reached = counts.withColumn("_before", before).where(F.col("_before") < F.col("room"))
        last = F.max(F.struct("edge", (F.col("room") - F.col("_before")).alias("room"), "held"))
        plan = stored(reached.groupBy(group).agg(last.alias("_e")).select(group, "_e.*"), "edges")
        if (plan.agg(F.max("held")).first()[0] or 0) <= enough:
            break
    return Edge(plan, shift)


def lowest(
    df: DataFrame, group: str, key: Column, bits: int, limits: DataFrame, tie: str,
    enough: int = ENOUGH,
) -> DataFrame:
    """The first `room` rows of each group by (key, tie), exactly as many, whatever repeats.

    Where more than `enough` rows of a group share the key at the limit, they go by a hash of the whole
    row instead of `tie`; those that share it too are repeated rows, of which any will do.
    """
    limits = limits.select(F.col(group).alias("_g"), "room")
    keyed = df.withColumn("_key", key)
    edge = radix_edge(
        keyed.select(F.col(group).alias("_g"), "_key"), "_g", "_key", limits, bits, enough=enough
    )
    placed = keyed.join(edge.plan, F.col(group) == F.col("_g"))
    whole = placed.where(edge.below(F.col("_key"))).select(*df.columns)
    partial = placed.where(edge.at(F.col("_key")))
    rank = F.row_number().over(Window.partitionBy(group).orderBy("_key", tie))
    few = partial.where(F.col("held") <= enough).withColumn("_rank", rank)
    out = whole.unionByName(few.where(F.col("_rank") <= F.col("room")).select(*df.columns))
    if (edge.plan.agg(F.max("held")).first()[0] or 0) <= enough:
        return out
    plain = [f.name for f in df.schema if "map" not in f.dataType.simpleString()]
    equal = partial.where(F.col("held") > enough).select(
        *df.columns, F.shiftrightunsigned(F.xxhash64(*plain), 1).alias("_row")
    )
    rest = edge.plan.where(F.col("held") > enough).select("_g", "room")
    inner = radix_edge(
        equal.select(F.col(group).alias("_g"), "_row"), "_g", "_row", rest, 63, enough=enough
    )
    placed = equal.join(inner.plan, F.col(group) == F.col("_g"))
    out = out.unionByName(placed.where(inner.below(F.col("_row"))).select(*df.columns))
    left = placed.where(inner.at(F.col("_row")))
    rank = F.row_number().over(Window.partitionBy(group).orderBy("_row"))
    few = left.where(F.col("held") <= enough).withColumn("_rank", rank)
    out = out.unionByName(few.where(F.col("_rank") <= F.col("room")).select(*df.columns))
    copies = left.where(F.col("held") > enough).groupBy("_g").agg(
        F.first(F.struct(*df.columns)).alias("_copy"), F.first("room").alias("_n")
    )
    repeated = copies.select(
        "_copy", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))).alias("_i")
    )
    return out.unionByName(repeated.select("_copy.*"))
