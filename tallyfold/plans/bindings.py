"""The given tables seen as job-market tables.

There are no postings among the given tables, so these projections give `events`,
`documents` and `customer` the columns the operators expect. Every row is used; modulo
only derives attribute values.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.functions.facts import detail_confidence, infer_workplace, posted_at
from tallyfold.functions.facts import salary_range, skills
from tallyfold.functions.identity import VIEW_BASE, config_hash
from tallyfold.functions.rules import pick
from tallyfold.functions.text import let
from tallyfold.operators.dedupe import dedupe_best
from tallyfold.operators.quality import quality_issues, quality_metrics
from tallyfold.plans.market import classify_best, classify_run
from tallyfold.schemas import TABLES

RUN_SPLIT = "2024-01-16 00:00:00"
WINDOW_DAYS = 7
UNITS = ("minute", "hour", "day", "week", "month")
CITIES = ("click", "error", "purchase", "signup", "view", "nowhere")
CITY_LIST = [(c, f"City {c}") for c in CITIES]

PREFIXES = ("", "Senior ", "Junior ", "Staff ", "Lead ", "Remote ", "Principal  ", "Hybrid ")
# Base titles that reach every role rule, and the known traps of word edges and precedence.
BASE_TITLES = (
    "Chief of Staff, Product", "Chief Data Officer", "CTO", "VP Engineering",
    "Director, Product Manager", "Head of Data", "Technical Recruiter", "HR Business Partner",
    "Product Manager, Growth", "Product Owner", "Technical Program Manager", "Project Analyst",
    "Engineering Manager", "Manager, Engineering", "Developer Advocate", "Solutions Engineer",
    "Pre-Sales Consultant", "Forward Deployed Engineer", "Data Annotation Specialist",
    "Data Labeling Lead", "AI Trainer", "QA Analyst", "Software Test Lead", "SDET",
    "Security Engineer", "Application Security Analyst", "Firmware Engineer, ML Acceleration",
    "ASIC Engineer", "Digital ASIC Engineer", "Robotics Engineer", "Self-Driving Specialist",
    "Machine Learning Engineer", "ML-Ops Engineer", "AI Applied Research Engineer",
    "Applied Scientist", "Data Scientist", "Research Engineer", "Staff Scientist",
    "Data Engineer", "Data Infra Developer", "ETL Developer", "Data & Identity Analyst",
    "Data Analyst", "BI Engineer", "Product Analytics Partner", "DevOps Engineer",
    "Site Reliability Engineer", "Dev Ops Specialist", "Cloud Engineer", "Systems Architect",
    "Data Center Technician", "Help Desk Agent", "Technical Support Agent", "UX Designer",
    "UI Artist", "Product Analyst", "Customer Success Partner", "Implementation Consultant",
    "Product Marketing Partner", "Go-to-Market Associate", "Clinical Nurse", "Medical Writer",
    "Retail Cashier", "Store Host", "Investment Buyer", "Construction Planner",
    "Field Technician", "Business Analyst", "Strategy Associate", "Office Assistant",
    "Survey Coordinator", "Math Tutor", "Education Specialist", "Software Engineer",
    "Software Engineering Partner", "Backend Engineer", "Full-Stack Engineer",
    "iOS Engineer", "Java Developer", "C++ Developer", "C++ Expert", "C++11 Expert",
    "Software Enginner", "Application Platform Engineer", "Member of Technical Staff",
    "Engineer II (Software)", "Office Manager", "Team Lead", "Lead Manager", "Intern, Data",
    "Internal Auditor", "New Grad Engineer", "Early Career Developer", "Jr Developer",
    "Barista", "Coordinator", "Éceo Assistant", "Growth Manager", "Chemist - Hiring multiple candidates",
    "Promoted: see more", "Distinguished Engineer",
)
PHRASES = (
    " Compensation $120k - $150k per year.",
    " This is a hybrid role with Python, SQL and machine learning.",
    " Remote. Pay: $95,500 - $110,000",
    " On-site with Kubernetes on AWS, Go or Rust.",
    " Java and 10-15 years; JavaScript to React.",
    "",
)
EMPLOYMENT = ("Full-time", "Part-time", "Contract")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def title_for(key: Column) -> Column:
    return F.concat(
        pick(key % len(PREFIXES), PREFIXES), pick((key * 7) % len(BASE_TITLES), BASE_TITLES)
    )


def v_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = load(spark, sf_dir, "customer")
    return customer.select(
        F.col("c_custkey").alias("title_id"), title_for(F.col("c_custkey")).alias("title"),
        "c_nationkey", "c_mktsegment", "c_acctbal",
    )


def v_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    events = load(spark, sf_dir, "events").withColumn("k", k)
    run = F.when(F.col("ts") < F.lit(RUN_SPLIT).cast("timestamp_ntz"), "run_a").otherwise("run_b")
    k = F.col("k")
    job = F.col("user_id").cast("string")

    def wording(k: Column) -> Column:
        text = F.concat(
            F.when(k % 10 == 7, F.lit("Reposted ")).otherwise(F.lit("")),
            F.when(k == 17, (F.col("event_id") % 900000 + 100000).cast("string"))
            .when(k == 18, F.lit("12345678901234567")).otherwise((k % 30 + 1).cast("string")),
            F.lit(" "), pick(k % len(UNITS), UNITS), F.lit("s ago"),
        )
        return (
            F.when(k == 13, F.lit("Just now")).when(k == 14, F.lit("30+ days ago"))
            .when(k == 15, F.lit(None)).when(k == 16, F.lit("")).otherwise(text)
        )

    # Filters on what is derived from it go below this projection, and would read `props` at every mention.
    posted = let(k, wording)
    company = (
        F.when(k % 20 == 0, F.lit(None)).when(k % 20 == 1, F.lit("")).when(k % 20 == 2, "N/A")
        .otherwise(F.concat(F.lit("Company "), (F.col("user_id") % 40).cast("string")))
    )
    city = F.concat(F.lit("City "), F.col("event_type"))
    rows = events.select(
        F.col("event_id").cast("string").alias("snapshot_id"), run.alias("run_id"),
        F.concat_ws("-", run, "event_type", (k % 7).cast("string")).alias("query_id"),
        job.alias("job_id"), F.concat(F.lit(VIEW_BASE), job, F.lit("/")).alias("url"),
        title_for(F.col("user_id")).alias("title"), company.alias("company"),
        F.when(k % 50 == 3, F.lit(None)).when(k % 50 == 4, "N/A").otherwise(city).alias("location"),
        posted.alias("posted_text"),
        F.floor(k / 25).cast("int").alias("page_0"), (k % 25 + 1).cast("int").alias("rank"),
        (F.lit(0.65) + F.lit(0.05) * (F.col("event_id") % 8)).alias("parser_confidence"),
        F.col("ts").alias("scraped_at"), "event_id", "event_type", "user_id", "k",
    )
    return rows.select(
        "snapshot_id", "run_id", "query_id", "job_id", "url", "title", "company", "location",
        "posted_text", posted_at("posted_text", "scraped_at").alias("posted_at"),
        (F.col("page_0") + 1).alias("page"), "rank",
        F.lit(None).cast("string").alias("raw_snapshot_path"),
        F.lit(None).cast("string").alias("content_sha256"),
        "parser_confidence", "scraped_at", F.lit("complete").alias("extraction_status"),
        "event_id", "event_type", "user_id", "k",
    )


def v_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame_of(v_listings(spark, sf_dir))


def frame_of(listings: DataFrame) -> DataFrame:
    k7 = F.col("k7")
    found = (
        listings
        .groupBy("run_id", "query_id", "event_type", (F.col("k") % 7).alias("k7"))
        .agg(F.count(F.lit(1)).cast("int").alias("rows"), F.max("page").alias("last_page"))
    )
    status = (
        F.when(k7 == 0, "pending").when(k7 == 1, "failed").when(k7 == 2, F.lit(None))
        .otherwise("complete")
    )
    weight = (
        F.when(k7 == 5, F.lit(0.0)).when(k7 == 6, F.lit(None).cast("double"))
        .otherwise(F.length("event_type").cast("double") * (k7 + 1) / F.lit(100.0))
    )
    level = (k7 % 3).cast("string")
    return found.select(
        "query_id", "run_id", F.col("event_type").alias("city_key"),
        F.concat(F.lit("City "), "event_type").alias("city_name"),
        F.concat(F.lit("Place, "), "event_type").alias("location"),
        F.concat(F.lit("kw"), k7.cast("string")).alias("keyword"),
        F.concat(F.lit("family"), (k7 % 2).cast("string")).alias("role_family_key"),
        F.concat(F.lit("level"), level).alias("experience_key"),
        F.concat(F.lit("f_E="), level).alias("experience_param"),
        F.lit(WINDOW_DAYS).alias("time_window_days"), weight.alias("target_weight"),
        F.concat(F.lit("https://jobs.example.com/q/"), "query_id").alias("url"),
        status.alias("status"),
        F.when(k7 == 0, F.lit(None)).when(k7 == 1, 0).otherwise(F.col("rows")).alias(
            "result_count"
        ),
        F.when(k7 == 0, 0).otherwise(F.col("last_page")).alias("pages_collected"),
        F.when(k7 == 1, F.concat(F.lit("timeout "), "event_type")).alias("last_error"),
    )


def v_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    docs = load(spark, sf_dir, "documents").select(
        F.when(F.col("lang").isin("en", "fr"), "run_a").otherwise("run_b").alias("run_id"),
        d.cast("string").alias("job_id"),
        F.concat(F.lit(VIEW_BASE), d.cast("string"), F.lit("/")).alias("url"),
        F.concat("text", pick(d % len(PHRASES), PHRASES)).alias("description"),
        pick(d % len(EMPLOYMENT), EMPLOYMENT).alias("employment_type"),
        F.concat((d % 200).cast("string"), F.lit(" applicants")).alias("applicants_signal"),
        "doc_id", "lang", "source",
    )
    facts = docs.withColumns({
        "workplace_type": infer_workplace("description"),
        "_s": salary_range("description"),
        "criteria": F.create_map(
            F.lit("Job type"), F.col("employment_type"), F.lit("Industry"), F.col("source")
        ),
        "skills": skills("description"),
    })
    return facts.select(
        "run_id", "job_id", "url", "description", "workplace_type", "employment_type",
        "_s.salary_min", "_s.salary_max", "_s.salary_currency", "applicants_signal", "criteria",
        "skills", F.lit(None).cast("string").alias("raw_snapshot_path"),
        F.sha2("description", 256).alias("content_sha256"),
        detail_confidence(
            "description", "criteria", "workplace_type", "employment_type", "skills"
        ).alias("parser_confidence"),
        F.lit("2024-02-01 00:00:00").cast("timestamp_ntz").alias("scraped_at"),
        F.lit("complete").alias("extraction_status"), "doc_id", "lang",
    )


def v_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs that occur, and one that collected nothing."""
    return runs_of(v_listings(spark, sf_dir))


def runs_of(listings: DataFrame) -> DataFrame:
    found = listings.groupBy("run_id").agg(F.min("scraped_at").alias("started_at"))
    empty = found.agg(F.min("started_at").alias("started_at")).select(
        F.lit("run_empty").alias("run_id"), "started_at"
    )
    return found.unionByName(empty).select(
        "run_id", config_hash({"run": "run_id"}).alias("config_hash"), F.lit("1").alias("code_version"),
        F.lit("running").alias("status"), F.lit("postings").alias("target_population"),
        F.lit("{}").alias("config_json"), "started_at",
        F.lit(None).cast("timestamp_ntz").alias("ended_at"),
    )


def dimension(listings: DataFrame, value: str, key: str) -> DataFrame:
    from tallyfold.operators.upsert import insert_if_absent

    empty = listings.sparkSession.createDataFrame(
        [], f"{key} string, canonical_name string, first_seen_at timestamp_ntz"
    )
    return insert_if_absent(empty, listings, value, "scraped_at", key)


class JobTables(Mapping):
    """Pipeline tables by name, each planned when it is first asked for and nothing written: a report
    reads the columns it uses. `classified_best` holds best rows, details and labels in one row, so
    that reports need not join labels to the rows they were made from.

    Whoever needs all tables whole gives `keep`, which writes one and reads it back: the tables made from
    it then read what was kept, and nothing is derived twice."""

    def __init__(
        self, spark: SparkSession, sf_dir: str, keep: Callable[[DataFrame, str], DataFrame] | None = None
    ):
        self._keep = keep
        self._made: dict[str, DataFrame] = {}
        self._makers: dict[str, Callable[[], DataFrame]] = {
            "search_runs": lambda: runs_of(self["listing_snapshots"]),
            "search_queries": lambda: frame_of(self["listing_snapshots"]),
            "listing_snapshots": lambda: v_listings(spark, sf_dir),
            "job_details": lambda: v_details(spark, sf_dir),
            "companies": lambda: dimension(self["listing_snapshots"], "company", "company_key"),
            "locations": lambda: dimension(self["listing_snapshots"], "location", "location_key"),
            "classifications": lambda: classify_run(self),
            "quality_issues": self._issues,
            "best_listings": lambda: dedupe_best(self["listing_snapshots"]),
            "classified_best": lambda: classify_best(self),
        }

    def _issues(self) -> DataFrame:
        issues = quality_issues(quality_metrics(self, CITY_LIST, WINDOW_DAYS))
        return issues.withColumn(
            "created_at", F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
        )

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            made = self._makers[name]()
            self._made[name] = self._keep(made, name) if self._keep and name in TABLES else made
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        """The pipeline tables; what is derived from them for reports is no table of its own."""
        return iter(TABLES)

    def __len__(self) -> int:
        return len(TABLES)


def job_tables(
    spark: SparkSession, sf_dir: str, keep: Callable[[DataFrame, str], DataFrame] | None = None
) -> Mapping[str, DataFrame]:
    """All pipeline tables; labels and issues are computed from the others, as kept if `keep` is given."""
    return JobTables(spark, sf_dir, keep)
