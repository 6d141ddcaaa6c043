"""Explicit schemas of the pipeline tables. Nothing here is ever inferred."""

from __future__ import annotations

from pyspark.sql import types as T

STR, INT, LNG, DBL, TS = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.DoubleType(),
    T.TimestampNTZType(),
)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


SEARCH_RUNS = _struct(
    ("run_id", STR), ("config_hash", STR), ("code_version", STR), ("status", STR),
    ("target_population", STR), ("config_json", STR), ("started_at", TS), ("ended_at", TS),
)
SEARCH_QUERIES = _struct(
    ("query_id", STR), ("run_id", STR), ("city_key", STR), ("city_name", STR), ("location", STR),
    ("keyword", STR), ("role_family_key", STR), ("experience_key", STR), ("experience_param", STR),
    ("time_window_days", INT), ("target_weight", DBL), ("url", STR), ("status", STR),
    ("result_count", INT), ("pages_collected", INT), ("last_error", STR),
)
LISTING_SNAPSHOTS = _struct(
    ("snapshot_id", STR), ("run_id", STR), ("query_id", STR), ("job_id", STR), ("url", STR),
    ("title", STR), ("company", STR), ("location", STR), ("posted_text", STR), ("posted_at", TS),
    ("page", INT), ("rank", INT), ("raw_snapshot_path", STR), ("content_sha256", STR),
    ("parser_confidence", DBL), ("scraped_at", TS), ("extraction_status", STR),
)
JOB_DETAILS = _struct(
    ("run_id", STR), ("job_id", STR), ("url", STR), ("description", STR), ("workplace_type", STR),
    ("employment_type", STR), ("salary_min", DBL), ("salary_max", DBL), ("salary_currency", STR),
    ("applicants_signal", STR), ("criteria", T.MapType(STR, STR)), ("skills", T.ArrayType(STR)),
    ("raw_snapshot_path", STR), ("content_sha256", STR), ("parser_confidence", DBL),
    ("scraped_at", TS), ("extraction_status", STR),
)
CLASSIFICATIONS = _struct(
    ("run_id", STR), ("job_id", STR), ("role_family", STR), ("seniority", STR), ("track", STR),
    ("workplace", STR), ("confidence", DBL), ("reasons", T.ArrayType(STR)), ("classified_at", TS),
)
QUALITY_ISSUES = _struct(
    ("issue_id", STR), ("run_id", STR), ("scope", STR), ("severity", STR), ("code", STR),
    ("message", STR), ("details", T.MapType(STR, STR)), ("created_at", TS),
)
COMPANIES = _struct(("company_key", STR), ("canonical_name", STR), ("first_seen_at", TS))
LOCATIONS = _struct(("location_key", STR), ("canonical_name", STR), ("first_seen_at", TS))

TABLES = {
    "search_runs": SEARCH_RUNS,
    "search_queries": SEARCH_QUERIES,
    "listing_snapshots": LISTING_SNAPSHOTS,
    "job_details": JOB_DETAILS,
    "companies": COMPANIES,
    "locations": LOCATIONS,
    "classifications": CLASSIFICATIONS,
    "quality_issues": QUALITY_ISSUES,
}
# Dimensions outlive a run, so they carry no run_id and are exported whole.
SHARED_TABLES = ("companies", "locations")

# Job table with a header line, as collected by the CSV path.
CSV_JOBS = _struct(
    ("job_id", STR), ("url", STR), ("title", STR), ("company", STR), ("location", STR),
    ("posted_text", STR), ("scraped_at", TS), ("search_term", STR), ("search_location", STR),
    ("search_region", STR),
)
CSV_LABELS = _struct(
    ("title", STR), ("expected_role_family", STR), ("expected_seniority", STR),
    ("expected_track", STR),
)
