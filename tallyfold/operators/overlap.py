"""How often the same entity was found, and by which paths."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def overlap_metrics(df: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows, distinct keys and rows per key, in one pass of two partial aggregations."""
    per_key = df.groupBy(*by, key).agg(F.count(F.lit(1)).alias("n"))
    named = F.col(key).isNotNull()
    out = per_key.groupBy(*by).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("raw_snapshots"),
        F.count_if(named).alias("canonical_jobs"),
        F.coalesce(F.avg("n"), F.lit(0.0)).alias("avg_discovery_paths"),
        F.coalesce(F.max("n"), F.lit(0)).alias("max_discovery_paths"),
    )
    spare = F.greatest(F.col("raw_snapshots") - F.col("canonical_jobs"), F.lit(0))
    return out.select(
        *by, "raw_snapshots", "canonical_jobs",
        spare.alias("duplicate_discovery_paths"), "avg_discovery_paths", "max_discovery_paths",
    )


def distinct_count(
    df: DataFrame, key: str, by: Sequence[str] = (), approximate: bool = False
) -> DataFrame:
    """Distinct keys; `approximate` trades about 5 % accuracy for a single small sketch."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.groupBy(*by).agg(count(F.col(key)).alias("jobs"))


def joined_set(value: str | Column, separator: str) -> Column:
    """Distinct values in order as text; NULL where there is none."""
    values = F.array_sort(F.collect_set(value))
    return F.when(F.size(values) > 0, F.array_join(values, separator))


def discovery_paths(df: DataFrame, keys: Sequence[str], path: str) -> DataFrame:
    """Rows and the distinct paths that led to each key.

    The first aggregation leaves one row per (key, path), so the list is as long as the
    number of searches, however often each search repeated itself.
    """
    per_path = df.groupBy(*keys, path).agg(F.count(F.lit(1)).alias("n"))
    return per_path.groupBy(*keys).agg(
        F.sum("n").alias("discovery_count"), joined_set(path, ",").alias("query_ids")
    )


def discovery_rollup(listings: DataFrame, frame: DataFrame) -> DataFrame:
    """Per job: rows, distinct queries, and the keywords and cities of those queries."""
    keys = ("run_id", "job_id")
    per_query = listings.groupBy(*keys, "query_id").agg(F.count(F.lit(1)).alias("n"))
    looked_up = per_query.join(
        frame.select("query_id", "keyword", "city_name"), "query_id", "left"
    )
    return looked_up.groupBy(*keys).agg(
        F.sum("n").alias("discovery_paths"),
        F.count("query_id").alias("discovery_queries"),
        joined_set("keyword", ", ").alias("discovered_keywords"),
        joined_set("city_name", ", ").alias("discovered_cities"),
    )


def search_log(frame: DataFrame, listings: DataFrame) -> DataFrame:
    """Per search: rows found and pages reached; searches without a result stay in."""
    found = listings.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("jobs_found"), F.max("page").alias("pages_scraped")
    )
    return frame.join(found, "query_id", "left").select(
        "query_id", "city_name", "location", "keyword", "experience_key",
        F.coalesce("jobs_found", F.lit(0)).alias("jobs_found"),
        F.coalesce("pages_scraped", F.lit(0)).alias("pages_scraped"),
    )
