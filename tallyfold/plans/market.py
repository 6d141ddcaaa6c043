"""Composite results over the job tables: what an analyst actually asks for."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.text import NOT_AVAILABLE, col, or_unknown
from tallyfold.operators.bootstrap import bootstrap_shares
from tallyfold.operators.canonical import best_listings, canonical_with_frame, detail_lookup
from tallyfold.operators.classify import classify_jobs
from tallyfold.operators.dedupe import first_per_key, top_per_group
from tallyfold.operators.overlap import overlap_metrics
from tallyfold.operators.shares import inverse_weight, share_in_group, total_of, value_shares
from tallyfold.plans import taxonomy as tx
from tallyfold.session import stored

JOB = ["run_id", "job_id"]
LABELS = ("role_family", "seniority", "track", "workplace", "confidence", "reasons")


def classify_best(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Best row per job with its detail and labels, as stored under `classified_best` or made here."""
    hint = F.col("workplace_type")
    # The rules read a description only where there is no hint; other texts need not travel for them.
    details = tables["job_details"].withColumn(
        "_unhinted", F.when(hint.isNull() | (hint == ""), F.col("description"))
    )
    jobs = detail_lookup(best_listings(tables), details, ["_unhinted"])
    return classify_jobs(jobs, "title", "_unhinted", "workplace_hint").drop("_unhinted")


def classify_run(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Classifications of every run: best row per job, its detail, then the rules."""
    labelled = tables["classified_best"] if "classified_best" in tables else classify_best(tables)
    return labelled.select(*JOB, *LABELS, F.col("scraped_at").alias("classified_at"))


def classified_jobs(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Canonical jobs with frame attributes and labels: the table all reports start from."""
    columns = [*JOB, "query_id", "title", "company", "location"]
    frame, attributes = tables["search_queries"], ("city_name", "target_weight")
    if "classified_best" in tables:
        best = tables["classified_best"].select(*columns, *LABELS[:5])
        return canonical_with_frame(best, frame, attributes)
    framed = canonical_with_frame(best_listings(tables).select(*columns), frame, attributes)
    return framed.join(tables["classifications"].select(*JOB, *LABELS[:5]), JOB, "left")


def report_sections(jobs: DataFrame) -> DataFrame:
    """Raw and weighted shares by role, seniority and city x role, long format, per run.

    Jobs are first counted into cells (role, seniority, city); the sections are then
    regrouped from those few cells, so the jobs are read once.
    """
    cells = jobs.groupBy(
        "run_id",
        or_unknown("role_family").alias("role"),
        or_unknown("seniority").alias("level"),
        or_unknown("city_name").alias("city"),
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(inverse_weight("target_weight")).alias("weighted"),
    )

    def line(section: str, segment: Column, sub: Column) -> Column:
        return F.struct(
            F.lit(section).alias("section"), segment.alias("segment"), sub.alias("sub")
        )

    lines = F.array(
        line("role_family", F.col("role"), F.lit("")),
        line("seniority", F.col("level"), F.lit("")),
        line("city_role", F.col("city"), F.col("role")),
        line("total", F.lit("jobs"), F.lit("")),
    )
    sums = (
        cells.select("run_id", "n", "weighted", F.inline(lines))
        .groupBy("run_id", "section", "segment", "sub")
        .agg(F.sum("n").alias("n"), F.sum("weighted").alias("weighted"))
    )
    whole = sums.where(F.col("section") == "total").select(
        "run_id", F.col("n").alias("all_n"), F.col("weighted").alias("all_weighted")
    )
    return sums.join(whole, "run_id").select(
        "run_id", "section", "segment", "sub", "n",
        F.try_divide("n", "all_n").alias("share"),
        F.try_divide("weighted", "all_weighted").alias("weighted_share"),
    )


REPORT_COLUMNS = ("run_id", "job_id", "role_family", "seniority", "city_name", "target_weight")
HEADLINES = {"ai_share": ("role_family", "AI/ML"), "entry_share": ("seniority", "Entry")}


def report_intervals(jobs: DataFrame) -> DataFrame:
    """Bootstrap intervals of the two headline shares, per run, from one pass over the jobs."""
    conditions = {metric: F.col(column) == value for metric, (column, value) in HEADLINES.items()}
    return bootstrap_shares(jobs, conditions, ["job_id"], by=["run_id"])


def report_overlap(listings: DataFrame) -> DataFrame:
    """Overlap metrics per run as (metric, value) lines."""
    wide = overlap_metrics(listings, "job_id", ["run_id"])
    return wide.unpivot(
        ["run_id"],
        [F.col(c).cast("double").alias(c) for c in wide.columns if c != "run_id"],
        "metric", "value",
    )


def market_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All report sections as (run_id, section, segment, sub, n, share, weighted_share).

    The interval section has a line for each bound of a headline share. Every run has a line with its
    number of actionable issues, 0 included. The labelled jobs, six narrow columns of them, are used
    by several sections and written once; nothing else is.
    """
    jobs = stored(classified_jobs(tables).select(*REPORT_COLUMNS), "report-jobs")
    sections = report_sections(jobs)
    none = F.lit(None).cast("double")
    no_count = F.lit(None).cast("bigint").alias("n")

    def lines(df: DataFrame, section: str, segment: Column, sub: Column, share: Column) -> DataFrame:
        return df.select(
            "run_id", F.lit(section).alias("section"), segment.alias("segment"), sub.alias("sub"),
            no_count, share.alias("share"), none.alias("weighted_share"),
        )

    overlap = lines(
        report_overlap(tables["listing_snapshots"]), "overlap", F.col("metric"), F.lit(""), F.col("value")
    )
    bounds = report_intervals(jobs).unpivot(
        ["run_id", "metric"], ["observed", "lower", "upper"], "bound", "value"
    )
    intervals = lines(bounds, "interval", F.col("metric"), F.col("bound"), F.col("value"))
    counts = tables["quality_issues"].where(F.col("severity") != "info").groupBy("run_id").agg(
        F.count(F.lit(1)).alias("found")
    )
    runs = tables["search_runs"].select("run_id").distinct()
    issues = runs.join(counts, "run_id", "left").select(
        "run_id", F.lit("quality").alias("section"), F.lit("actionable").alias("segment"),
        F.lit("").alias("sub"), F.coalesce("found", F.lit(0)).alias("n"), none.alias("share"),
        none.alias("weighted_share"),
    )
    return sections.unionByName(overlap).unionByName(intervals).unionByName(issues)


def city_ai_share(jobs: DataFrame) -> DataFrame:
    """Per city: jobs, AI/ML jobs and share, and the wider AI/data/research share."""
    counts = jobs.groupBy(or_unknown("city_name").alias("city")).agg(
        F.count(F.lit(1)).alias("jobs"),
        F.count_if(F.col("role_family") == "AI/ML").alias("ai_jobs"),
        F.count_if(F.col("role_family").isin(*tx.AI_DATA_RESEARCH)).alias("adr_jobs"),
    )
    return counts.select(
        "city", "jobs", "ai_jobs", (F.col("ai_jobs") / F.col("jobs")).alias("ai_share"),
        (F.col("adr_jobs") / F.col("jobs")).alias("ai_data_research_share"),
    )


def junior_by_family(jobs: DataFrame, min_jobs: int = 50) -> DataFrame:
    """Entry and intern share of the families with enough jobs."""
    junior = F.col("seniority").isin(*tx.JUNIOR)
    return share_in_group(jobs, "role_family", junior, "role_family", min_jobs)


def top_companies(jobs: DataFrame, k: int = 20) -> DataFrame:
    """Largest companies with their AI jobs, main role and main seniority.

    Jobs are counted once into (company, role, seniority) cells; all that follows works
    on those.
    """
    known = jobs.where(~F.coalesce(F.col("company"), F.lit("")).isin("", NOT_AVAILABLE))
    cells = known.groupBy("company", "role_family", "seniority").agg(F.count(F.lit(1)).alias("n"))
    counts = cells.groupBy("company").agg(
        F.sum("n").alias("jobs"),
        F.sum(F.when(F.col("role_family") == "AI/ML", F.col("n")).otherwise(0)).alias("ai_jobs"),
    )
    largest = counts.orderBy(F.desc("jobs"), F.asc("company")).limit(k)
    theirs = cells.join(largest, "company")

    def main(label: str) -> DataFrame:
        sums = theirs.groupBy("company", "jobs", "ai_jobs", label).agg(F.sum("n").alias("n"))
        order = [F.desc("n"), F.col(label).asc_nulls_last()]
        return first_per_key(sums, ["company"], order)

    role = main("role_family").select(
        "company", "jobs", "ai_jobs", F.col("role_family").alias("top_role"),
        (F.col("n") / F.col("jobs")).alias("top_role_share"),
    )
    level = main("seniority").select("company", F.col("seniority").alias("top_seniority"))
    return role.join(level, "company")


def workplace_mix(jobs: DataFrame) -> DataFrame:
    """Share per workplace, over all jobs and over those that state one."""
    shares = value_shares(jobs, "workplace", "workplace")
    known = shares.where(F.col("workplace") != "Unknown")
    among = F.when(
        F.col("workplace") != "Unknown", F.try_divide(F.col("n"), total_of(known, "n"))
    )
    return shares.withColumn("share_of_known", among)


def region_profile(jobs: DataFrame, region: str, role: str, junior: Column) -> DataFrame:
    """Per region: jobs, most frequent role, junior share."""
    counts = jobs.groupBy(region).agg(
        F.count(F.lit(1)).alias("jobs"), F.count_if(junior).alias("junior_jobs")
    )
    top = top_per_group(jobs, region, role).select(
        F.col(region).alias("_r"), F.col(role).alias("top_role"), F.col("n").alias("top_role_jobs")
    )
    joined = counts.join(top, F.col(region).eqNullSafe(F.col("_r")))
    return joined.select(
        region, "jobs", "top_role", "top_role_jobs", "junior_jobs",
        (F.col("junior_jobs") / F.col("jobs")).alias("junior_share"),
    )


def insight_row(jobs: DataFrame, shares: Mapping[str, Column]) -> DataFrame:
    """Headline percentages, all from one aggregation."""
    total = F.count(F.lit(1))
    return jobs.agg(
        total.alias("total_jobs"),
        *[F.try_divide(F.count_if(cond) * 100.0, total).alias(f"{name}_pct")
          for name, cond in shares.items()],
    )


def company_total(jobs: DataFrame, company: str, condition: Column) -> DataFrame:
    """Matching jobs per company against that company's total, in one pass."""
    counts = jobs.where(F.coalesce(col(company), F.lit(NOT_AVAILABLE)) != NOT_AVAILABLE).groupBy(
        company
    ).agg(F.count_if(condition).alias("hits"), F.count(F.lit(1)).alias("total"))
    return counts.where(F.col("hits") > 0).withColumn(
        "pct_of_own", F.col("hits") * 100.0 / F.col("total")
    )


def ai_deep_dive(
    jobs: DataFrame, is_ai: Column, seniority: str, company: str, k: int = 10
) -> DataFrame:
    """AI jobs by seniority and by leading company, as (section, segment, n, share) lines."""
    ai = jobs.where(is_ai)
    levels = value_shares(ai, seniority).select(
        F.lit("seniority").alias("section"), "segment", "n", "share"
    )
    # The leading ten are taken before nameless companies drop out, as in a value count.
    lead = (
        jobs.groupBy(company).agg(
            F.count_if(is_ai).alias("n"), F.count(F.lit(1)).alias("total")
        )
        .where(F.col(company).isNotNull() & (F.col("n") > 0))
        .orderBy(F.desc("n"), F.asc(company)).limit(k)
        .where(F.col(company) != NOT_AVAILABLE)
        .select(
            F.lit("company").alias("section"), F.col(company).alias("segment"), "n",
            (F.col("n") / F.col("total")).alias("share"),
        )
    )
    return levels.unionByName(lead)


STATUSES = ("pending", "complete", "failed")


def run_progress(tables: Mapping[str, DataFrame], scalar_tables: Sequence[str]) -> DataFrame:
    """Progress of each run as (run_id, metric, detail, value) lines.

    Every run has every metric, 0 included. Searches with another or no status are counted under
    their own name. Each error text of failed searches has a line with its count.
    """
    listings, frame = tables["listing_snapshots"], tables["search_queries"]
    per_job = listings.groupBy(*JOB).agg(F.count(F.lit(1)).alias("n"))
    done = tables["job_details"].select(*JOB, F.lit(True).alias("has_detail")).distinct()
    found = per_job.join(done, JOB, "left").groupBy("run_id").agg(
        F.sum("n").alias("listing_snapshots"),
        F.count(F.lit(1)).alias("unique_jobs"),
        F.count_if(F.col("has_detail").isNull()).alias("pending_details"),
    )
    lines = found.unpivot(
        ["run_id"], ["listing_snapshots", "unique_jobs", "pending_details"], "metric", "value"
    )

    def counted(df: DataFrame, metric: Column) -> DataFrame:
        return df.groupBy("run_id", metric.alias("metric")).agg(F.count(F.lit(1)).alias("value"))

    lines = lines.unionByName(
        counted(frame, F.concat(F.lit("queries_"), F.coalesce("status", F.lit(""))))
    )
    for name in scalar_tables:
        lines = lines.unionByName(counted(tables[name], F.lit(name)))
    metrics = [
        "listing_snapshots", "unique_jobs", "pending_details", *scalar_tables,
        *(f"queries_{s}" for s in STATUSES),
    ]
    runs = tables["search_runs"].select("run_id").distinct()
    wanted = runs.select("run_id", F.explode(F.array(*map(F.lit, metrics))).alias("metric"))
    full = wanted.join(lines, ["run_id", "metric"], "full").select(
        "run_id", "metric", F.lit("").alias("detail"), F.coalesce("value", F.lit(0)).alias("value")
    )
    failed = frame.where(F.col("status") == "failed").groupBy(
        "run_id", F.lit("failed_sample").alias("metric"),
        F.coalesce("last_error", F.lit("")).alias("detail"),
    ).agg(F.count(F.lit(1)).alias("value"))
    return full.unionByName(failed)
