"""Data-quality rules: one metrics row per run, then one issue row per rule that fires.

All runs are judged in one job. The metrics come from three partial aggregations; the
rules are conditions over that single narrow row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.text import is_blank
from tallyfold.operators.canonical import expected_cities, frame_coverage
from tallyfold.operators.profile import REQUIRED, is_outside_window, zero_result_rate


@dataclass(frozen=True)
class Thresholds:
    """Limits of the rules; all but the city limit are strict upper bounds."""

    missing_rate: float = 0.05
    city_jobs: int = 25
    zero_rate: float = 0.25
    executive_share: float = 0.12
    other_share: float = 0.12


def _listing_metrics(listings: DataFrame, days: int) -> DataFrame:
    """Per run: rows, distinct jobs, missing fields, dates outside the window."""
    per_job = listings.groupBy("run_id", "job_id").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(is_blank(f)).alias(f"missing_{f}") for f in REQUIRED],
        F.count_if(is_outside_window(days)).alias("late"),
    )
    return per_job.groupBy("run_id").agg(
        F.sum("n").alias("raw_snapshots"),
        F.count("job_id").alias("canonical_jobs"),
        *[F.sum(f"missing_{f}").alias(f"missing_{f}") for f in REQUIRED],
        F.sum("late").alias("date_violations"),
    )


def _label_metrics(classifications: DataFrame) -> DataFrame:
    family = F.col("role_family")
    return classifications.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("classified"),
        F.count_if(family == "Executive").alias("executive"),
        F.count_if(family.isin("Product", "Program")).alias("product_program"),
        F.count_if(family == "Other").alias("other"),
    )


def quality_metrics(
    tables: Mapping[str, DataFrame], cities: Sequence[tuple[str, str]], days: int
) -> DataFrame:
    """One wide row per run; counts are 0 where a run has nothing."""
    runs = tables["search_runs"].select("run_id").distinct()
    frame, listings = tables["search_queries"], tables["listing_snapshots"]
    per_city = expected_cities(runs, frame_coverage(frame, listings), cities)
    # As many entries as the configuration names cities.
    city_lists = per_city.groupBy("run_id").agg(
        F.array_sort(
            F.collect_list(F.struct("ord", "city_key", "city_name", "jobs"))
        ).alias("cities")
    )
    joined = (
        runs.join(_listing_metrics(listings, days), "run_id", "left")
        .join(zero_result_rate(frame).drop("zero_rate"), "run_id", "left")
        .join(_label_metrics(tables["classifications"]), "run_id", "left")
        .join(city_lists, "run_id", "left")
    )
    counts = [c for c in joined.columns if c not in ("run_id", "cities")]
    return joined.select(
        "run_id", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in counts], "cities"
    )


def _details(*names: str | tuple[str, Column]) -> Column:
    pairs = [(n, F.col(n)) if isinstance(n, str) else n for n in names]
    flat = [x for name, value in pairs for x in (F.lit(name), value.cast("string"))]
    return F.create_map(*flat) if flat else F.expr("cast(map() as map<string,string>)")


def _issue(
    scope: str, severity: str, code: Column | str, message: Column | str, details: Column
) -> Column:
    lit = lambda v: F.lit(v) if isinstance(v, str) else v
    return F.struct(
        F.lit(scope).alias("scope"), F.lit(severity).alias("severity"),
        lit(code).alias("code"), lit(message).alias("message"), details.alias("details"),
    )


def quality_issues(
    metrics: DataFrame, limits: Thresholds = Thresholds(), check_cities: bool = True
) -> DataFrame:
    """Issue rows numbered in rule order within each run."""
    listings, queries, labels = "listing_snapshots", "search_queries", "classifications"
    raw, classified = F.col("raw_snapshots"), F.col("classified")

    def over(part: str, whole: str, limit: float) -> Column:
        return F.coalesce(F.try_divide(F.col(part), F.col(whole)) > limit, F.lit(False))

    single: list[tuple[Column, Column]] = [
        (raw == 0, _issue(listings, "error", "no_listings",
                          "This run holds no listings at all.", _details()))
    ]
    for f in REQUIRED:
        rate = F.try_divide(F.col(f"missing_{f}"), raw)
        single.append(
            (over(f"missing_{f}", "raw_snapshots", limits.missing_rate),
             _issue(listings, "warning", f"high_null_{f}",
                    F.format_string(f"%.1f%% of the listings lack a value in {f}.", rate * 100.0),
                    _details(("missing", F.col(f"missing_{f}")), ("total", raw))))
        )
    spare = raw - F.col("canonical_jobs")
    single.append(
        ((F.col("canonical_jobs") > 0) & (spare > 0),
         _issue(listings, "info", "discovery_overlap_deduped",
                "Several searches led to the same job; it is counted once.",
                _details("raw_snapshots", "canonical_jobs",
                         ("duplicate_discovery_paths", spare))))
    )
    small = F.filter(F.col("cities"), lambda c: c["jobs"] < limits.city_jobs)
    city_issues = F.transform(
        small if check_cities else F.slice(small, 1, 0),
        lambda c: _issue(
            queries, "warning", "low_city_sample",
            F.concat(F.lit(f"Sample below {limits.city_jobs} jobs in "), c["city_name"]),
            _details(("city_key", c["city_key"]), ("jobs", c["jobs"])),
        ),
    )
    later = [
        (over("zero_queries", "query_count", limits.zero_rate),
         _issue(queries, "warning", "many_zero_result_queries",
                f"Empty searches exceed {limits.zero_rate:.0%}.",
                _details("zero_queries", "query_count"))),
        (classified == 0,
         _issue(labels, "warning", "no_classifications",
                "Nothing has been labelled yet.", _details())),
        (over("executive", "classified", limits.executive_share),
         _issue(labels, "warning", "executive_share_spike",
                f"Executives exceed {limits.executive_share:.0%} of the labels.",
                _details("executive", ("total", classified)))),
        ((classified > 0) & (F.col("product_program") == 0),
         _issue(labels, "warning", "missing_product_program",
                "Labels of the product and program families are absent: check searches and rules.",
                _details())),
        (over("other", "classified", limits.other_share),
         _issue(labels, "warning", "high_other_share",
                f"Unassigned roles exceed {limits.other_share:.0%} of the labels.",
                _details("other", ("total", classified)))),
        (F.col("date_violations") > 0,
         _issue(listings, "warning", "date_window_violations",
                "Listings older than the window are present.",
                _details(("violations", F.col("date_violations"))))),
    ]

    def fired(rules: list[tuple[Column, Column]]) -> Column:
        return F.array_compact(F.array(*[F.when(cond, issue) for cond, issue in rules]))

    all_issues = F.concat(fired(single), city_issues, fired(later))
    numbered = metrics.select("run_id", F.posexplode(all_issues).alias("pos", "i"))
    issue_id = F.format_string("%s:%04d:%s", F.col("run_id"), F.col("pos") + 1, F.col("i.code"))
    return numbered.select(
        issue_id.alias("issue_id"), "run_id", "i.scope", "i.severity", "i.code", "i.message",
        "i.details",
    )


def actionable_issues(issues: DataFrame) -> DataFrame:
    return issues.where(F.col("severity") != "info")


def severity_rank(severity: str | Column) -> Column:
    c = F.col(severity) if isinstance(severity, str) else severity
    return F.when(c == "error", 0).when(c == "warning", 1).when(c == "info", 2).otherwise(3)


def order_issues(issues: DataFrame, by_text: bool = False) -> DataFrame:
    """Gravest first; `by_text` sorts the severity as text, descending."""
    first = F.desc("severity") if by_text else severity_rank("severity").asc()
    return issues.orderBy(first, F.asc("code"), F.asc("issue_id"))


def qa_summary(runs: DataFrame, issues: DataFrame) -> DataFrame:
    """Actionable and informational issues per run, runs without any included."""
    counts = issues.groupBy("run_id").agg(
        F.count_if(F.col("severity") != "info").alias("actionable"),
        F.count_if(F.col("severity") == "info").alias("info_notes"),
    )
    return runs.select("run_id").distinct().join(counts, "run_id", "left").na.fill(
        0, ["actionable", "info_notes"]
    )
