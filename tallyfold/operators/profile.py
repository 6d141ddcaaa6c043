"""Field completeness, row validation and progress counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.text import clean_text, col, is_blank

REQUIRED = ("title", "company", "location", "url")


def _unpivot_counts(wide: DataFrame, names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    pairs = F.array(
        *[F.struct(F.lit(n).alias("field"), F.col(f"c{i}").alias("count"))
          for i, n in enumerate(names)]
    )
    return wide.select(*by, "total", F.inline(pairs))


def required_missing(
    df: DataFrame, fields: Sequence[str] = REQUIRED, by: Sequence[str] = ()
) -> DataFrame:
    """Missing or blank values per field: one scan for all fields."""
    wide = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(is_blank(f)).alias(f"c{i}") for i, f in enumerate(fields)],
    )
    return _unpivot_counts(wide, fields, by).select(
        *by, "field", F.col("count").alias("missing"), "total",
        F.try_divide(F.col("count"), F.col("total")).alias("rate"),
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Non-NULL values and NULL percentage of every column."""
    wide = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count(F.col(c)).alias(f"c{i}") for i, c in enumerate(df.columns)],
    )
    missing = F.col("total") - F.col("count")
    return _unpivot_counts(wide, df.columns).select(
        "field", F.col("count").alias("non_null"),
        F.try_divide(missing * 100.0, F.col("total")).alias("null_pct"),
    )


def is_valid_row(title: str, url: str, confidence: str) -> Column:
    """Title with content, absolute http(s) url with a host, confidence within 0..1."""
    good = (
        (clean_text(title) != "")
        & col(url).rlike(r"^(?i:https?)://[^/?#]")
        & col(confidence).between(0.0, 1.0)
    )
    return F.coalesce(good, F.lit(False))


def validate_rows(
    df: DataFrame, title: str = "title", url: str = "url", confidence: str = "parser_confidence"
) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): faulty rows are set aside, not lost and not fatal."""
    good = is_valid_row(title, url, confidence)
    return df.where(good), df.where(~good)


def date_window_violations(df: DataFrame, days: int) -> DataFrame:
    """Rows posted before the collection window (plus one day of slack)."""
    return df.where(is_outside_window(days))


def is_outside_window(days: int) -> Column:
    earliest = F.col("scraped_at") - F.make_dt_interval(F.lit(days + 1))
    # As a filter this goes below the projection that derives `posted_at`: it names it once.
    return F.coalesce(F.col("posted_at") < earliest, F.lit(False))


def pending_queries(frame: DataFrame) -> DataFrame:
    return frame.where(F.coalesce(F.col("status"), F.lit("")) != "complete")


def failed_samples(frame: DataFrame, k: int = 10) -> DataFrame:
    """The first failed searches, for a progress display."""
    keys = ("city_name", "keyword", "experience_key")
    failed = frame.where(F.col("status") == "failed")
    order = [*[F.col(c).asc_nulls_last() for c in keys], F.col("query_id").asc_nulls_last()]
    return failed.orderBy(*order).limit(k).select(*keys, "last_error", "query_id")


def zero_result_rate(frame: DataFrame, by: Sequence[str] = ("run_id",)) -> DataFrame:
    empty = F.coalesce(F.col("result_count"), F.lit(0)) == 0
    counts = frame.groupBy(*by).agg(
        F.count_if(empty).alias("zero_queries"), F.count(F.lit(1)).alias("query_count")
    )
    return counts.withColumn("zero_rate", F.try_divide(F.col("zero_queries"), F.col("query_count")))


def status_counts(frame: DataFrame) -> DataFrame:
    return frame.groupBy("run_id", "status").agg(F.count(F.lit(1)).alias("queries"))
