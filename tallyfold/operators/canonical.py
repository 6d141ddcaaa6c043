"""The joins around the canonical row of each job.

No side carries a broadcast hint: the frame is small in every known deployment, and
Spark broadcasts it on its measured size; a large one is shuffled and AQE splits hot keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.operators.dedupe import dedupe_best
from tallyfold.operators.overlap import discovery_rollup

JOB = ["run_id", "job_id"]
FRAME_COLUMNS = ("city_name", "city_key", "target_weight", "keyword", "experience_key")


def canonical_with_frame(
    canonical: DataFrame, frame: DataFrame, columns: Sequence[str] = FRAME_COLUMNS
) -> DataFrame:
    """Canonical rows with the attributes of the query that found them."""
    return canonical.join(frame.select("query_id", *columns), "query_id", "left")


def best_listings(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The best row of each job: as stored under this name, or reduced here."""
    if "best_listings" in tables:
        return tables["best_listings"]
    return dedupe_best(tables["listing_snapshots"])


def canonical_jobs(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The 29-column export row: best snapshot, frame, detail, labels and discovery paths.

    Where `classified_best` is at hand, its labels are taken from the best row itself.
    """
    listings, frame = tables["listing_snapshots"], tables["search_queries"]
    labelled = tables["classified_best"] if "classified_best" in tables else None
    columns = (*JOB, "query_id", "url", "title", "company", "location", "posted_text", "posted_at")
    labels = (
        "role_family", "seniority", "track", F.col("workplace").alias("classified_workplace"),
        F.col("confidence").alias("classification_confidence"),
    )
    if labelled is None:
        label_side = tables["classifications"].select(*JOB, *labels)
        best = best_listings(tables).select(*columns).join(label_side, JOB, "left")
    else:
        best = labelled.select(*columns, *labels)
    frame_side = frame.select(
        "query_id",
        F.col("city_name").alias("canonical_city_name"),
        F.col("city_key").alias("canonical_city_key"),
        F.col("keyword").alias("canonical_keyword"),
        F.col("experience_key").alias("canonical_experience_key"),
        F.col("target_weight").alias("canonical_target_weight"),
    )
    detail_side = tables["job_details"].select(
        *JOB, "description", "workplace_type", "employment_type", "salary_min", "salary_max",
        "salary_currency", "applicants_signal",
    )
    joined = (
        best.join(frame_side, "query_id", "left")
        .join(detail_side, JOB, "left")
        .join(discovery_rollup(listings, frame), JOB, "left")
    )
    return joined.select(
        *columns[:2], *columns[3:], *frame_side.columns[1:], *detail_side.columns[2:],
        *best.columns[-5:],
        "discovery_paths", "discovery_queries", "discovered_keywords", "discovered_cities",
    )


def any_url(listings: DataFrame) -> DataFrame:
    return listings.groupBy(*JOB).agg(F.min("url").alias("url"))


def pending_details(
    listings: DataFrame, details: DataFrame, limit: int | None = None
) -> DataFrame:
    """Jobs without a detail row, in text order of their id; limit 0 or None means all."""
    pending = any_url(listings).join(details.select(*JOB), JOB, "left_anti")
    ordered = pending.orderBy("job_id", "run_id")
    return ordered.limit(limit) if limit else ordered


def frame_coverage(frame: DataFrame, listings: DataFrame) -> DataFrame:
    """Distinct jobs per run and city of the frame, cities without any included."""
    searches = frame.select("query_id", "run_id", "city_key")
    found = listings.select("query_id", "job_id").join(searches, "query_id")
    # The facts are shuffled once; what follows is as small as the frame.
    counts = found.select("run_id", "city_key", "job_id").distinct().groupBy(
        F.col("run_id").alias("_run"), F.col("city_key").alias("_city")
    ).agg(F.count("job_id").alias("jobs"))
    same = F.col("run_id").eqNullSafe(F.col("_run")) & F.col("city_key").eqNullSafe(F.col("_city"))
    return searches.select("run_id", "city_key").distinct().join(counts, same, "left").select(
        "run_id", "city_key", F.coalesce("jobs", F.lit(0)).alias("jobs")
    )


def expected_cities(runs: DataFrame, coverage: DataFrame, cities: Sequence[tuple[str, str]]):
    """Every configured city of every run with its job count, 0 where nothing was found."""
    entries = F.array(
        *[F.struct(F.lit(i).alias("ord"), F.lit(k).alias("city_key"), F.lit(n).alias("city_name"))
          for i, (k, n) in enumerate(cities)]
    )
    wanted = runs.select("run_id", F.inline(entries))
    return wanted.join(coverage, ["run_id", "city_key"], "left").select(
        "run_id", "ord", "city_key", "city_name",
        F.coalesce("jobs", F.lit(0)).cast("bigint").alias("jobs"),
    )


def detail_lookup(jobs: DataFrame, details: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """Jobs with what their detail page says, ready for classification; `more` names further columns."""
    found = details.select(*JOB, "description", F.col("workplace_type").alias("workplace_hint"), *more)
    return jobs.join(found, JOB, "left")


def label_eval(
    predicted: DataFrame, labelled: DataFrame, key: str, columns: Sequence[str]
) -> DataFrame:
    """Rows whose predicted labels differ from the expected ones, with both values."""
    expected = labelled.select(key, *[F.col(c).alias(f"expected_{c}") for c in columns])
    both = predicted.select(key, *columns).join(expected, key)
    wrong = F.lit(False)
    for c in columns:
        wrong = wrong | ~F.col(c).eqNullSafe(F.col(f"expected_{c}"))
    return both.where(wrong)
