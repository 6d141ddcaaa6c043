"""Counts, shares, cross-tabs, top-k and concentration.

Totals come from a scalar subquery over the already grouped counts, whose exchange AQE
reuses, instead of a window without partitions, which would pull all groups into one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.functions.text import col, has_word, or_unknown


def total_of(df: DataFrame, column: str) -> Column:
    return df.agg(F.sum(column)).scalar()


def totals_of(df: DataFrame, *columns: str) -> Column:
    """Totals of all aggregated columns as one struct.

    Naming every column keeps the subquery's plan equal to the main one, so that the
    exchange below both is the same and runs once.
    """
    return df.agg(F.struct(*[F.sum(c).alias(c) for c in columns]).alias("t")).scalar()


def value_shares(df: DataFrame, segment: str | Column, name: str = "segment") -> DataFrame:
    """Rows and share per segment; a missing segment is 'Unknown'."""
    counts = df.groupBy(or_unknown(segment).alias(name)).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(name, "n", (F.col("n") / total_of(counts, "n")).alias("share"))


def inverse_weight(weight: str | Column) -> Column:
    """1 / target weight, where no weight (or 0) counts as 1."""
    w = col(weight)
    usable = F.when(w.isNull() | (w == 0), F.lit(1.0)).otherwise(w)
    return F.lit(1.0) / F.greatest(usable, F.lit(1e-9))


def weighted_shares(
    df: DataFrame, segment: str | Column, weight: str | Column, name: str = "segment"
) -> DataFrame:
    """Share per segment with every row counted by its inverse target weight."""
    sums = df.groupBy(or_unknown(segment).alias(name)).agg(
        F.count(F.lit(1)).alias("n"), F.sum(inverse_weight(weight)).alias("weighted")
    )
    total = totals_of(sums, "n", "weighted").getField("weighted")
    return sums.select(
        name, "n", "weighted", F.try_divide(F.col("weighted"), total).alias("share")
    )


def crosstab_long(df: DataFrame, row: str | Column, column: str | Column) -> DataFrame:
    """One line per occurring cell; safe for any number of values."""
    return df.groupBy(or_unknown(row).alias("row"), or_unknown(column).alias("col")).agg(
        F.count(F.lit(1)).alias("n")
    )


def crosstab(
    df: DataFrame, row: str | Column, column: str | Column, values: Sequence[str]
) -> DataFrame:
    """Wide cross-tab with the given headings, absent cells 0; other values are not shown.
    Where the headings are not known beforehand, `crosstab_long` has every cell.
    """
    cells = crosstab_long(df, row, column)
    return cells.groupBy("row").pivot("col", list(values)).agg(F.sum("n")).na.fill(0)


def share_in_group(
    df: DataFrame,
    group: str | Column,
    condition: Column,
    name: str = "segment",
    min_rows: int = 0,
) -> DataFrame:
    """Share of rows meeting a condition inside each group, optionally for large groups only."""
    out = df.groupBy(or_unknown(group).alias(name)).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(condition).alias("hits")
    )
    out = out.withColumn("share", F.col("hits") / F.col("n"))
    return out.where(F.col("n") >= min_rows) if min_rows else out


def group_label(value: str | Column, groups: Mapping[str, Sequence[str]]) -> Column:
    """Group a value belongs to, NULL outside all groups. The map is a constant, not a join."""
    pairs = [F.lit(x) for name, members in groups.items() for m in members for x in (m, name)]
    return F.try_element_at(F.create_map(*pairs), col(value))


def group_map_shares(
    df: DataFrame,
    value: str,
    groups: Mapping[str, Sequence[str]],
    weight: str | None = None,
    other: str | None = None,
) -> DataFrame:
    """Share of all rows per macro group; unmapped values stay outside or go to `other`."""
    label = group_label(value, groups)
    if other is not None:
        label = F.coalesce(label, F.lit(other))
    aggs = [F.count(F.lit(1)).alias("n")]
    if weight is not None:
        aggs.append(F.sum(inverse_weight(weight)).alias("weighted"))
    sums = df.groupBy(label.alias("segment")).agg(*aggs)
    measures = ["n"] if weight is None else ["n", "weighted"]
    totals = totals_of(sums, *measures)
    cols = ["segment", "n", (F.col("n") / totals.getField("n")).alias("share")]
    if weight is not None:
        share = F.try_divide(F.col("weighted"), totals.getField("weighted"))
        cols.append(share.alias("weighted_share"))
    return sums.select(*cols).where(F.col("segment").isNotNull())


def two_level_shares(
    df: DataFrame, value: str, groups: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Group totals and their members in one result; level 1 = group, 0 = member."""
    counts = df.groupBy(F.col(value).alias("member")).agg(F.count(F.lit(1)).alias("n"))
    grouped = counts.withColumn("segment", group_label("member", groups))
    rolled = (
        grouped.where(F.col("segment").isNotNull())
        .rollup("segment", "member")
        .agg(F.sum("n").alias("n"), F.grouping_id().alias("gid"))
        .where(F.col("gid") < 3)
    )
    return rolled.select(
        "segment", "member", F.col("gid").cast("int").alias("level"), "n",
        (F.col("n") / total_of(counts, "n")).alias("share"),
    )


def topk_segments(df: DataFrame, segment: str | Column, k: int) -> DataFrame:
    """The k most frequent segments with their share of all rows; ties go by name."""
    shares = value_shares(df, segment)
    return shares.orderBy(F.desc("n"), F.asc("segment")).limit(k)


def concentration(df: DataFrame, holder: str, ks: Sequence[int] = (10, 25)) -> DataFrame:
    """Distinct holders and the share of rows held by the largest k of them.

    Only max(ks) rows survive the distributed top-k; the positions are numbered on those.
    """
    counts = df.groupBy(holder).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.where(F.col(holder).isNotNull())
    largest = counts.orderBy(F.desc("n"), F.asc(holder)).limit(max(ks))
    ranked = largest.withColumn(
        "pos", F.row_number().over(Window.orderBy(F.desc("n"), F.asc(holder)))
    )
    held = ranked.agg(
        *[F.sum(F.when(F.col("pos") <= k, F.col("n"))).alias(f"top{k}_n") for k in ks]
    )
    totals = counts.agg(F.count(F.lit(1)).alias("holders"), F.sum("n").alias("total"))
    out = held.withColumn("holders", totals.select("holders").scalar()).withColumn(
        "total", totals.select("total").scalar()
    )
    shares = [
        F.try_divide(F.col(f"top{k}_n"), F.col("total")).alias(f"top{k}_share") for k in ks
    ]
    return out.select("holders", "total", *[f"top{k}_n" for k in ks], *shares)


def signal_shares(df: DataFrame, text: Column, signals: Mapping[str, str]) -> DataFrame:
    """Rows and share whose text names a signal's words, all signals in one pass."""
    names = list(signals)
    wide = df.select(F.lower(text).alias("_text")).agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(has_word(F.col("_text"), signals[name])).alias(f"s{i}")
          for i, name in enumerate(names)],
    )
    pairs = F.array(
        *[F.struct(F.lit(n).alias("signal"), F.col(f"s{i}").alias("n"))
          for i, n in enumerate(names)]
    )
    return wide.select("total", F.inline(pairs)).select(
        "signal", "n", F.try_divide(F.col("n"), F.col("total")).alias("share")
    )


def distinct_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows and distinct non-NULL values of some columns."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_distinct(F.col(c)).alias(f"distinct_{c}") for c in columns],
    )


def combo_counts(df: DataFrame, parts: Sequence[str], k: int = 20) -> DataFrame:
    """Most frequent combinations of values; a NULL part makes no combination."""
    joined = F.concat(*[x for p in parts for x in (F.lit(" "), F.col(p))][1:])
    with_combo = df.select(joined.alias("combo")).where(F.col("combo").isNotNull())
    return topk_segments(with_combo, "combo", k).withColumnRenamed("segment", "combo")


def ratio_metric(df: DataFrame, over: Column, under: Column) -> DataFrame:
    """Ratio of two conditional counts; NULL unless both occur."""
    counts = df.agg(F.count_if(over).alias("n_over"), F.count_if(under).alias("n_under"))
    both = (F.col("n_over") > 0) & (F.col("n_under") > 0)
    return counts.withColumn("ratio", F.when(both, F.col("n_over") / F.col("n_under")))


def search_accuracy(
    df: DataFrame, term: str, title: str, role: str, k_roles: int = 3
) -> DataFrame:
    """Per search term: rows, share of titles naming the term, most frequent actual roles."""
    named = F.lower(F.col(title)).contains(F.lower(F.col(term)))
    cells = df.groupBy(term, role).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(named).alias("named")
    )
    totals = cells.groupBy(F.col(term).alias("_term")).agg(
        F.sum("n").alias("jobs"), F.sum("named").alias("named")
    )
    order = Window.partitionBy(term).orderBy(F.desc("n"), F.col(role).asc_nulls_last())
    leading = cells.withColumn("pos", F.row_number().over(order)).where(F.col("pos") <= k_roles)
    # k_roles entries per term.
    lists = leading.groupBy(term).agg(
        F.array_sort(F.collect_list(F.struct("pos", F.col(role).alias("role")))).alias("roles")
    )
    joined = lists.join(totals, F.col(term).eqNullSafe(F.col("_term")))
    return joined.select(
        term, "jobs", (F.col("named") / F.col("jobs")).alias("match_rate"),
        F.array_join("roles.role", ", ").alias("top_roles"),
    )
