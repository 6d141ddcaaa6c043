"""Registered queries: reading, writing and maintaining tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.functions.identity import config_hash, hash32
from tallyfold.functions.text import json_fields
from tallyfold.operators import dedupe as dd
from tallyfold.operators import sampling as sm
from tallyfold.operators import upsert as up
from tallyfold.operators.classify import classify_jobs
from tallyfold.operators.quality import quality_issues, quality_metrics
from tallyfold.plans import bindings as b
from tallyfold.plans import taxonomy as tx
from tallyfold.plans.oracle_views import clean, hash32 as hash32_sql, norm, q, role_sql
from tallyfold.plans.registry import query
from tallyfold.schemas import LISTING_SNAPSHOTS, TABLES
from tallyfold.session import scratch_path
from tallyfold.sources import readers as rd
from tallyfold.sources import writers as wr

LISTING_COLUMNS = LISTING_SNAPSHOTS.fieldNames()


@query("read_tables", """
    SELECT run_id, query_id, count(*) AS n, max(page) AS last_page,
           count(posted_at) AS dated, max(scraped_at) AS newest
    FROM v_listings GROUP BY 1, 2""", "v_listings")
def read_tables(spark, sf):
    path = scratch_path(spark, "listing_snapshots")
    wr.replace_partition(b.v_listings(spark, sf).select(*LISTING_COLUMNS), path)
    stored = rd.read_table(spark, path, LISTING_SNAPSHOTS)
    return stored.groupBy("run_id", "query_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("page").alias("last_page"),
        F.count("posted_at").alias("dated"), F.max("scraped_at").alias("newest"),
    )


@query("read_snapshots", """
    SELECT page_id, sha256(html || chr(10)) AS content_sha256, length(html) + 1 AS n_chars
    FROM pages""")
def read_snapshots(spark, sf):
    """Every page as a file (the writer ends it with a line feed), read back."""
    path = scratch_path(spark, "page_files")
    wr.write_page_files(b.load(spark, sf, "pages"), path, "page_id", "html")
    return rd.read_snapshots(spark, path).select(
        F.regexp_extract("path", "page_id=([0-9]+)[./]", 1).cast("bigint").alias("page_id"),
        "content_sha256", F.length("html").cast("bigint").alias("n_chars"),
    )


@query("read_csv_jobs", """
    SELECT search_term, count(*) AS n, count(nullif(company, '')) AS companies,
           count(DISTINCT title) AS titles, max(scraped_at) AS newest
    FROM (SELECT l.*, f.keyword AS search_term FROM v_listings l JOIN v_frame f USING (query_id))
    GROUP BY 1""", ("v_listings", "v_frame"))
def read_csv_jobs(spark, sf):
    listings = b.v_listings(spark, sf)
    frame = b.v_frame(spark, sf).select(
        "query_id", F.col("keyword").alias("search_term"),
        F.col("location").alias("search_location"), F.col("city_key").alias("search_region"),
    )
    path = scratch_path(spark, "jobs_csv")
    jobs = listings.join(frame, "query_id")
    wr.write_csv(jobs.select(*rd.CSV_JOBS.fieldNames()), path)
    return rd.read_csv_jobs(spark, path).groupBy("search_term").agg(
        F.count(F.lit(1)).alias("n"), F.count("company").alias("companies"),
        F.count_distinct("title").alias("titles"), F.max("scraped_at").alias("newest"),
    )


@query("read_labels", f"""
    SELECT expected_role_family, count(*) AS n, count(DISTINCT title) AS titles,
           count(*) FILTER (contains(title, ',')) AS with_comma
    FROM (SELECT title, {role_sql(norm('title'))} AS expected_role_family FROM v_titles)
    GROUP BY 1""", "v_titles")
def read_labels(spark, sf):
    labelled = classify_jobs(b.v_titles(spark, sf)).select(
        "title", F.col("role_family").alias("expected_role_family"),
        F.col("seniority").alias("expected_seniority"), F.col("track").alias("expected_track"),
    )
    path = scratch_path(spark, "labels_csv")
    wr.write_csv(labelled, path)
    return rd.read_labels(spark, path).groupBy("expected_role_family").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("title").alias("titles"),
        F.count_if(F.col("title").contains(",")).alias("with_comma"),
    )


def table_configs(spark, sf):
    """A configuration drawn from the given tables: regions, segments and priorities."""
    regions, nations = b.load(spark, sf, "region"), b.load(spark, sf, "nation")
    customers, orders = b.load(spark, sf, "customer"), b.load(spark, sf, "orders")
    placed = customers.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n")).join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    everyone = customers.agg(F.count(F.lit(1))).scalar()
    # 5 regions, 25 nations, 5 segments, 3 states and 5 priorities: fixed by the tables.
    cities = (
        placed.join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy("r_regionkey", "r_name")
        .agg(
            (F.sum("n") / everyone).alias("weight"),
            F.collect_list("n_name").alias("locations"),
        )
        .agg(F.collect_list(F.struct(
            F.col("r_regionkey").cast("string").alias("key"), F.col("r_name").alias("name"),
            "weight", "locations",
        )))
    )
    bought = orders.join(
        customers, F.col("o_custkey") == F.col("c_custkey")
    ).select("c_mktsegment", "o_orderstatus").distinct()
    families = (
        bought.groupBy("c_mktsegment").agg(F.collect_list("o_orderstatus").alias("keywords"))
        .agg(F.collect_list(F.struct(
            F.lower("c_mktsegment").alias("key"), F.col("c_mktsegment").alias("name"), "keywords",
        )))
    )
    levels = (
        orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
        .agg(F.collect_list(F.struct(
            F.col("o_orderpriority").alias("key"),
            F.concat(F.lit("f_E="), F.substring("o_orderpriority", 1, 1)).alias("param"),
            (F.col("n") / orders.agg(F.count(F.lit(1))).scalar()).alias("weight"),
        )))
    )
    return customers.agg(F.lit("run_tables").alias("run_id")).select(
        "run_id", F.lit("tables").alias("name"), F.lit(7).alias("time_window_days"),
        F.lit(3).alias("max_pages"), cities.scalar().alias("cities"),
        families.scalar().alias("families"), levels.scalar().alias("levels"),
    )


FRAME_SQL = """
    cities AS (
        SELECT r_regionkey::VARCHAR AS city_key, r_name AS city_name,
               sum(n) / (SELECT count(*) FROM customer) AS w, count(*) AS locs
        FROM (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1) c
        JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
        GROUP BY 1, 2),
    places AS (SELECT DISTINCT n_regionkey::VARCHAR AS city_key, n_name AS location
               FROM nation JOIN customer ON c_nationkey = n_nationkey),
    kws AS (SELECT DISTINCT c_mktsegment AS seg, o_orderstatus AS keyword
            FROM orders JOIN customer ON c_custkey = o_custkey),
    fams AS (SELECT seg, count(*) AS kw_n FROM kws GROUP BY 1),
    levels AS (SELECT o_orderpriority AS level, count(*) / (SELECT count(*) FROM orders) AS w
               FROM orders GROUP BY 1),
    frame AS (
        SELECT 'q_' || substr(sha1(concat_ws('|', 'run_tables', c.city_key, p.location, lower(f.seg),
                                            k.keyword, l.level)), 1, 12) AS query_id,
               c.city_key, c.city_name, p.location, k.keyword, lower(f.seg) AS role_family_key,
               l.level AS experience_key, 'f_E=' || substr(l.level, 1, 1) AS experience_param,
               c.w * l.w * (1.0::DOUBLE / (SELECT count(*) FROM fams)) / (c.locs * f.kw_n)
                   AS target_weight
        FROM cities c JOIN places p USING (city_key) CROSS JOIN fams f
        JOIN kws k ON k.seg = f.seg CROSS JOIN levels l)"""
URL_SQL = (
    "'https://jobs.example.com/jobs/search/?keywords=' || replace(url_encode(keyword), '%20', '+')"
    " || '&location=' || replace(url_encode(location), '%20', '+') || '&f_TPR=r604800&'"
    " || experience_param || '&sortBy=DD'"
)


@query("search_frame", f"""WITH {FRAME_SQL}
    SELECT query_id, city_key, city_name, location, keyword, role_family_key, experience_key,
           round(target_weight, 9) AS target_weight, {URL_SQL} AS url FROM frame""")
def search_frame(spark, sf):
    frame = sm.search_frame(table_configs(spark, sf))
    return frame.select(
        "query_id", "city_key", "city_name", "location", "keyword", "role_family_key",
        "experience_key", "target_weight", "url",
    )


@query("search_grid", f"""WITH {FRAME_SQL}
    SELECT city_key, role_family_key, experience_key, count(*) AS searches,
           count(DISTINCT location) AS locations, count(DISTINCT keyword) AS keywords
    FROM frame GROUP BY 1, 2, 3""")
def search_grid(spark, sf):
    frame = sm.search_frame(table_configs(spark, sf))
    return frame.groupBy("city_key", "role_family_key", "experience_key").agg(
        F.count(F.lit(1)).alias("searches"), F.count_distinct("location").alias("locations"),
        F.count_distinct("keyword").alias("keywords"),
    )


@query("target_weight", f"""WITH {FRAME_SQL}
    SELECT 'run_tables' AS run_id, round(sum(target_weight), 9) AS weight_sum FROM frame""")
def target_weight(spark, sf):
    return sm.frame_weight_sums(sm.search_frame(table_configs(spark, sf)))


@query("config_problems", """
    SELECT 'run_tables' AS run_id, 'level weights must sum to 1' AS problem
    FROM (SELECT 2 * count(*) / (SELECT count(*) FROM orders) AS w FROM orders)
    WHERE abs(w - 1) > 0.01""")
def config_problems(spark, sf):
    doubled = F.transform(
        "levels", lambda x: x.withField("weight", x["weight"] * 2)
    )
    return sm.config_problems(table_configs(spark, sf).withColumn("levels", doubled))


@query("page_plan", f"""
    SELECT query_id, page::INT AS page, ((page - 1) * 25)::INT AS start,
           {URL_SQL} || CASE WHEN page > 1 THEN '&start=' || (page - 1) * 25 ELSE '' END AS page_url
    FROM v_frame CROSS JOIN (SELECT unnest([1, 2, 3, 4]) AS page)""", "v_frame")
def page_plan(spark, sf):
    return sm.page_plan(b.v_frame(spark, sf), 4)


# Columns that the content hash of an exported table covers; none of them is ever NULL.
EXPORTED = {
    "search_runs": ("v_runs", ("run_id",)),
    "search_queries": ("v_frame", ("query_id", "keyword")),
    "listing_snapshots": ("v_listings", ("snapshot_id", "job_id")),
    "job_details": ("v_details", ("job_id", "workplace_type")),
    "companies": (
        f"(SELECT DISTINCT {norm('company')} AS company_key FROM v_listings WHERE {clean('company')} <> '')",
        ("company_key",),
    ),
    "locations": (
        f"(SELECT DISTINCT {norm('location')} AS location_key FROM v_listings WHERE {clean('location')} <> '')",
        ("location_key",),
    ),
    "classifications": ("v_class", ("job_id", "role_family")),
    "quality_issues": ("v_issues", ("issue_id", "severity")),
    "canonical_jobs": ("v_best", ("job_id", "url")),
}


EXPORT_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS n, sum({hash32_sql(*columns)})::BIGINT AS content FROM {view}"
    for name, (view, columns) in EXPORTED.items()
)
EXPORT_VIEWS = ("v_details", "v_issues")


@query("export_run", EXPORT_SQL, EXPORT_VIEWS)
def export_run(spark, sf):
    root = scratch_path(spark, "export")
    paths = wr.export_run(b.job_tables(spark, sf), root)
    counts = [
        spark.read.parquet(path).agg(
            F.count(F.lit(1)).alias("n"), F.sum(hash32(*EXPORTED[name][1])).alias("content")
        ).select(F.lit(name).alias("table_name"), "n", "content")
        for path in paths for name in [path.rsplit("/", 1)[1]]
    ]
    return dd.union_batches(*counts)


@query("write_csv", """
    SELECT count(*) AS total_jobs, count(DISTINCT nullif(company, '')) AS unique_companies,
           count(DISTINCT title) AS unique_titles
    FROM v_best""", "v_best")
def write_csv(spark, sf):
    """Best rows as CSV plus a JSON summary taken from the stored file."""
    path = scratch_path(spark, "canonical_csv")
    best = dd.dedupe_best(b.v_listings(spark, sf)).select("job_id", "title", "company")
    wr.write_csv(best, path)
    schema = "job_id string, title string, company string"
    stored = rd.read_csv(spark, path, schema)
    summary = stored.agg(
        F.count(F.lit(1)).alias("total_jobs"), F.count_distinct("company").alias("unique_companies"),
        F.count_distinct("title").alias("unique_titles"),
    )
    wr.write_summary(summary, path + "_summary")
    return spark.read.schema(summary.schema).json(path + "_summary")


@query("upsert_by_key", """
    SELECT user_id, event_id, event_type, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY run_id DESC, event_id DESC) AS rn
        FROM v_raw) WHERE rn = 1""", "v_raw")
def upsert_by_key(spark, sf):
    """First half of the events as stored table, second half as incoming batch."""
    events = b.load(spark, sf, "events").select("user_id", "event_id", "event_type", "value", "ts")
    split = F.lit(b.RUN_SPLIT).cast("timestamp_ntz")
    stored = dd.keep_first(events.where(F.col("ts") < split), ["user_id"], [("event_id", "desc")])
    incoming = events.where(F.col("ts") >= split)
    return up.upsert_by_key(stored, incoming, ["user_id"], "event_id").drop("ts")


@query("upsert_keep_status", """
    SELECT query_id, city_key, coalesce(target_weight, 0.0) + 1 AS target_weight, status,
           result_count
    FROM v_frame WHERE run_id = 'run_b'
    UNION ALL
    SELECT 'new-' || query_id, city_key, coalesce(target_weight, 0.0) + 1, 'pending', NULL
    FROM v_frame WHERE run_id = 'run_a'
    UNION ALL
    SELECT query_id, city_key, target_weight, status, result_count
    FROM v_frame WHERE run_id = 'run_a'""", "v_frame")
def upsert_keep_status(spark, sf):
    """A redrawn frame: attributes are renewed, status and counts of known queries stay."""
    frame = b.v_frame(spark, sf).select(
        "query_id", "run_id", "city_key", "target_weight", "status", "result_count"
    )
    renewed = F.when(F.col("run_id") == "run_a", F.concat(F.lit("new-"), "query_id")).otherwise(
        F.col("query_id")
    )
    incoming = frame.select(
        renewed.alias("query_id"), "run_id", "city_key",
        (F.coalesce("target_weight", F.lit(0.0)) + 1).alias("target_weight"),
        F.lit("pending").alias("status"), F.lit(None).cast("int").alias("result_count"),
    )
    out = up.upsert_by_key(frame, incoming, ["query_id"], keep=["status", "result_count"])
    return out.drop("run_id")


@query("insert_if_absent", f"""
    SELECT company_key, arg_min(trim(company), (run_id, scraped_at, trim(company))) AS canonical_name,
           arg_min(scraped_at, (run_id, scraped_at)) AS first_seen_at
    FROM (SELECT *, {norm('company')} AS company_key FROM v_listings) WHERE company_key <> ''
    GROUP BY 1""", "v_listings")
def insert_if_absent(spark, sf):
    listings = b.v_listings(spark, sf)
    first = b.dimension(listings.where(F.col("run_id") == "run_a"), "company", "company_key")
    later = listings.where(F.col("run_id") == "run_b")
    return up.insert_if_absent(first, later, "company", "scraped_at", "company_key")


@query("first_seen", f"""
    SELECT location_key, min(scraped_at) AS first_seen_at,
           arg_min(trim(location), (scraped_at, trim(location))) AS canonical_name
    FROM (SELECT *, {norm('location')} AS location_key FROM v_listings) WHERE location_key <> ''
    GROUP BY 1""", "v_listings")
def first_seen(spark, sf):
    return b.dimension(b.v_listings(spark, sf), "location", "location_key")


@query("replace_partition", """
    SELECT run_id, issue_id, code, severity FROM v_issues WHERE run_id <> 'run_b'
    UNION ALL SELECT run_id, run_id || ':0001:replaced', 'replaced', 'info'
    FROM v_runs WHERE run_id = 'run_b'""", ("v_issues", "v_runs"))
def replace_partition(spark, sf):
    """All issues stored, then those of one run replaced by a new set."""
    path = scratch_path(spark, "quality_issues")
    tables = b.job_tables(spark, sf)
    issues = tables["quality_issues"].select("run_id", "issue_id", "code", "severity")
    wr.replace_partition(issues, path)
    new = tables["search_runs"].where(F.col("run_id") == "run_b").select(
        "run_id", F.lit("replaced").alias("code"), F.lit("info").alias("severity")
    )
    numbered = wr.number_issues(new, "code").select("run_id", "issue_id", "code", "severity")
    wr.replace_partition(numbered, path)
    return spark.read.schema("issue_id string, code string, severity string, run_id string").parquet(
        path
    )


@query("update_status", """
    SELECT query_id, CASE WHEN status = 'failed' THEN 'complete' ELSE status END AS status,
           CASE WHEN status = 'failed' THEN n ELSE result_count END AS result_count,
           pages_collected, CASE WHEN status = 'failed' THEN NULL ELSE last_error END AS last_error
    FROM v_frame JOIN (SELECT query_id, count(*)::INT AS n FROM v_listings GROUP BY 1)
         USING (query_id)""", ("v_frame", "v_listings"))
def update_status(spark, sf):
    """Failed searches are finished: count given, page count not, error cleared."""
    frame, listings = b.v_frame(spark, sf), b.v_listings(spark, sf)
    failed = frame.where(F.col("status") == "failed").select("query_id")
    updates = (
        listings.join(failed, "query_id", "left_semi").groupBy("query_id")
        .agg(F.count(F.lit(1)).cast("int").alias("result_count"))
        .select(
            "query_id", F.lit("complete").alias("status"), "result_count",
            F.lit(None).cast("int").alias("pages_collected"),
            F.lit(None).cast("string").alias("last_error"),
        )
    )
    return up.update_status(frame, updates).select(
        "query_id", "status", "result_count", "pages_collected", "last_error"
    )


@query("run_guard", """
    SELECT run_id, CASE run_id WHEN 'run_a' THEN 'resumed' WHEN 'run_b' THEN 'conflict'
                   ELSE 'new' END AS action,
           CASE WHEN run_id <> 'run_b' THEN 'running' END AS status
    FROM (SELECT DISTINCT run_id FROM v_raw UNION ALL SELECT DISTINCT 'run_' || event_type FROM v_raw)
    """, "v_raw")
def run_guard(spark, sf):
    runs = b.v_runs(spark, sf)
    changed = F.when(F.col("run_id") == "run_b", F.lit("other")).otherwise(F.col("config_hash"))
    again = runs.where(F.col("run_id") != "run_empty").select("run_id", changed.alias("config_hash"))
    fresh = b.load(spark, sf, "events").select(
        F.concat(F.lit("run_"), "event_type").alias("run_id"), F.lit("x").alias("config_hash")
    ).distinct()
    return up.run_guard(runs, again.unionByName(fresh), enforce=False).select(
        "run_id", "action", "status"
    )


@query("config_hash", """
    SELECT r_name AS name, sha256(to_json({'key': r_regionkey, 'name': r_name, 'nations': n}))
           AS config_hash
    FROM region JOIN (SELECT n_regionkey, count(*) AS n FROM nation GROUP BY 1)
         ON n_regionkey = r_regionkey""")
def config_hash_query(spark, sf):
    """Hash of a document per region; the order in which its fields are named does not matter."""
    nations = b.load(spark, sf, "nation").groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("n"))
    joined = b.load(spark, sf, "region").join(nations, F.col("n_regionkey") == F.col("r_regionkey"))
    fields = {"nations": "n", "name": "r_name", "key": "r_regionkey"}
    return joined.select(F.col("r_name").alias("name"), config_hash(fields).alias("config_hash"))


@query("json_fields", """
    SELECT doc_id, '{"Industry":"' || source || '","Job type":"' || employment_type || '"}'
           AS criteria_json FROM v_details""", "v_details")
def json_fields_query(spark, sf):
    return b.v_details(spark, sf).select(
        "doc_id", json_fields("criteria", "map").alias("criteria_json")
    )


@query("union_batches", """
    SELECT run_id, count(*) AS n, count(company) AS companies
    FROM (SELECT run_id, company FROM v_listings WHERE run_id = 'run_a'
          UNION ALL SELECT run_id, NULL FROM v_listings WHERE run_id = 'run_b') GROUP BY 1""",
    "v_listings")
def union_batches(spark, sf):
    listings = b.v_listings(spark, sf)
    first = listings.where(F.col("run_id") == "run_a").select("run_id", "job_id", "company")
    second = listings.where(F.col("run_id") == "run_b").select("run_id", "job_id")
    return dd.union_batches(first, second).groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n"), F.count("company").alias("companies")
    )


@query("exclude_seen", """
    SELECT c_custkey FROM customer WHERE c_custkey NOT IN (
        SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL AND o_orderpriority = '1-URGENT')""")
def exclude_seen(spark, sf):
    """Customers without an urgent order."""
    customers = b.load(spark, sf, "customer").select("c_custkey")
    urgent = b.load(spark, sf, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    return dd.exclude_seen(customers, urgent.select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("distinct_ids", "SELECT DISTINCT run_id, job_id FROM v_listings", "v_listings")
def distinct_ids(spark, sf):
    return b.v_listings(spark, sf).select("run_id", "job_id").distinct()


@query("membership", f"""
    SELECT title_id, title, {role_sql(norm('title'))} AS role_family FROM v_titles
    WHERE {role_sql(norm('title'))} IN ({', '.join(q(v) for v in tx.AI_DATA_RESEARCH)})""",
    "v_titles")
def membership(spark, sf):
    labelled = classify_jobs(b.v_titles(spark, sf))
    return labelled.where(F.col("role_family").isin(*tx.AI_DATA_RESEARCH)).select(
        "title_id", "title", "role_family"
    )


@query("known_company", """
    SELECT company, count(*) AS n FROM v_listings WHERE company <> 'N/A' GROUP BY 1""",
    "v_listings")
def known_company(spark, sf):
    listings = b.v_listings(spark, sf).where(F.col("company") != "N/A")
    return listings.groupBy("company").agg(F.count(F.lit(1)).alias("n"))


METRIC_COLUMNS = {
    "raw_snapshots": "raw", "canonical_jobs": "jobs", "missing_title": "m_title",
    "missing_company": "m_company", "missing_location": "m_location", "missing_url": "m_url",
    "date_violations": "late", "zero_queries": "zero_q", "query_count": "all_q",
    "classified": "classified", "executive": "exec", "product_program": "pp", "other": "other",
}


@query("quality_metrics", "SELECT run_id, " + ", ".join(
    f"{theirs} AS {ours}" for ours, theirs in METRIC_COLUMNS.items()
) + " FROM v_metrics", "v_metrics")
def metrics_query(spark, sf):
    tables = b.job_tables(spark, sf)
    return quality_metrics(tables, b.CITY_LIST, b.WINDOW_DAYS).drop("cities")


@query("quality_issues", """
    SELECT issue_id, run_id, scope, severity, code, message, details FROM v_issues""", "v_issues")
def issues_query(spark, sf):
    tables = b.job_tables(spark, sf)
    issues = quality_issues(quality_metrics(tables, b.CITY_LIST, b.WINDOW_DAYS))
    return issues.withColumn("details", json_fields("details", "map"))


