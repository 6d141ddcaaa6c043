"""Registered queries: joins, aggregations, windows, top-k and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.functions.text import keeps_title, norm_text
from tallyfold.operators import bootstrap as bs
from tallyfold.operators import canonical as cn
from tallyfold.operators import classify as cl
from tallyfold.operators import dedupe as dd
from tallyfold.operators import overlap as ov
from tallyfold.operators import profile as pf
from tallyfold.operators import quality as ql
from tallyfold.operators import sampling as sm
from tallyfold.operators import shares as sh
from tallyfold.operators.classify import classify_jobs
from tallyfold.plans import bindings as b
from tallyfold.plans import market as mk
from tallyfold.plans import taxonomy as tx
from tallyfold.plans.oracle_views import (
    LEFT, MISSING, RIGHT, hash32, iw, norm, q, role_sql,
)
from tallyfold.plans.registry import query

def jobs_of(spark, sf):
    return mk.classified_jobs(b.job_tables(spark, sf))


# --- Flagship: best row per job, its frame, weighted shares by city -------------------

FLAGSHIP_SQL = f"""
    SELECT segment, n, round(weighted, 9) AS weighted,
           round(weighted / sum(weighted) OVER (), 9) AS share
    FROM (SELECT coalesce(f.city_name, 'Unknown') AS segment, count(*) AS n,
                 sum({iw('f.target_weight')}) AS weighted
          FROM v_best b LEFT JOIN v_frame f USING (query_id) GROUP BY 1)"""


@query("weighted_shares", FLAGSHIP_SQL, ("v_best", "v_frame"))
def weighted_shares(spark, sf):
    best = dd.dedupe_best(b.v_listings(spark, sf))
    framed = cn.canonical_with_frame(best, b.v_frame(spark, sf))
    return sh.weighted_shares(framed, "city_name", "target_weight")


@query("weighted_shares_orders", f"""
    SELECT segment, n, round(weighted, 9) AS weighted,
           round(weighted / sum(weighted) OVER (), 9) AS share
    FROM (SELECT o_orderpriority AS segment, count(*) AS n, sum({iw('w')}) AS weighted
          FROM orders LEFT JOIN (SELECT c_custkey, CASE WHEN c_acctbal > 1000 THEN c_acctbal / 1000.0::DOUBLE
                                        WHEN c_acctbal > 0 THEN 0.0::DOUBLE END AS w FROM customer)
               ON c_custkey = o_custkey
          GROUP BY 1)""")
def weighted_shares_orders(spark, sf):
    """Every order, by its customer's balance; a small one gives weight 0 and a debt none."""
    balance = F.col("c_acctbal")
    weights = b.load(spark, sf, "customer").select(
        F.col("c_custkey").alias("o_custkey"),
        F.when(balance > 1000, balance / 1000.0).when(balance > 0, F.lit(0.0)).alias("w"),
    )
    joined = b.load(spark, sf, "orders").join(weights, "o_custkey", "left")
    return sh.weighted_shares(joined, "o_orderpriority", "w")


# --- Filters and profiles -------------------------------------------------------------


@query("required_missing", "UNION ALL".join(f"""
    SELECT run_id, '{f}' AS field, count(*) FILTER ({MISSING.format(c=f)}) AS missing,
           count(*) AS total,
           round(count(*) FILTER ({MISSING.format(c=f)}) / count(*), 9) AS rate
    FROM v_listings GROUP BY 1
    """ for f in pf.REQUIRED), "v_listings")
def required_missing(spark, sf):
    return pf.required_missing(b.v_listings(spark, sf), by=["run_id"])


PROFILED = (
    "snapshot_id", "run_id", "query_id", "job_id", "url", "title", "company", "location",
    "posted_text", "posted_at", "page", "rank", "raw_snapshot_path", "content_sha256",
    "parser_confidence", "scraped_at", "extraction_status", "event_id", "event_type", "user_id", "k",
)
CONSTANT = {"raw_snapshot_path": "NULL", "content_sha256": "NULL", "extraction_status": "'complete'"}


@query("null_profile", "UNION ALL".join(f"""
    SELECT '{c}' AS field, count({CONSTANT.get(c, c)}) AS non_null,
           round((count(*) - count({CONSTANT.get(c, c)})) * 100.0::DOUBLE / count(*), 9) AS null_pct
    FROM v_listings
    """ for c in PROFILED), "v_listings")
def null_profile(spark, sf):
    return pf.null_profile(b.v_listings(spark, sf))


@query("ui_text_filter", """
    SELECT title_id, title FROM v_titles
    WHERE length(title) >= 5 AND NOT (contains(lower(title), 'sign in')
          OR contains(lower(title), 'join now') OR contains(lower(title), 'promoted')
          OR contains(lower(title), 'see more'))""", "v_titles")
def ui_text_filter(spark, sf):
    titles = b.v_titles(spark, sf)
    return titles.where(keeps_title("title", min_length=5)).select("title_id", "title")


@query("validate_rows", """
    SELECT page_id, title <> '' AND regexp_matches(url, '^(?:http|https)://[^/?#]')
           AND confidence BETWEEN 0 AND 1 AS accepted
    FROM (SELECT page_id, CASE WHEN page_id % 11 = 0 THEN substr(url, 6) ELSE url END AS url,
                 trim(regexp_extract(html, '<title>([^<]*)</title>', 1)) AS title,
                 length(html) / 20000.0::DOUBLE AS confidence FROM pages)""")
def validate_rows(spark, sf):
    url = F.when(F.col("page_id") % 11 == 0, F.substr("url", F.lit(6))).otherwise(F.col("url"))
    pages = b.load(spark, sf, "pages").select(
        "page_id", url.alias("url"),
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
        (F.length("html") / F.lit(20000.0)).alias("parser_confidence"),
    )
    good, bad = pf.validate_rows(pages)
    return good.select("page_id", F.lit(True).alias("accepted")).unionByName(
        bad.select("page_id", F.lit(False).alias("accepted"))
    )


@query("date_window_violations", f"""
    SELECT snapshot_id, posted_at FROM v_listings
    WHERE posted_at < scraped_at - INTERVAL 1 DAY * {b.WINDOW_DAYS + 1}""", "v_listings")
def date_window_violations(spark, sf):
    late = pf.date_window_violations(b.v_listings(spark, sf), b.WINDOW_DAYS)
    return late.select("snapshot_id", "posted_at")


@query("pending_queries", """
    SELECT query_id, status FROM v_frame WHERE coalesce(status, '') <> 'complete'""", "v_frame")
def pending_queries(spark, sf):
    return pf.pending_queries(b.v_frame(spark, sf)).select("query_id", "status")


@query("failed_samples", """
    SELECT city_name, keyword, experience_key, last_error, query_id FROM v_frame
    WHERE status = 'failed' ORDER BY city_name, keyword, experience_key, query_id LIMIT 10""",
    "v_frame")
def failed_samples(spark, sf):
    return pf.failed_samples(b.v_frame(spark, sf))


@query("actionable_issues", """
    SELECT issue_id, severity, code FROM v_issues WHERE severity <> 'info'""", "v_issues")
def actionable_issues(spark, sf):
    issues = b.job_tables(spark, sf)["quality_issues"]
    return ql.actionable_issues(issues).select("issue_id", "severity", "code")


@query("order_issues", """
    SELECT issue_id, CASE severity WHEN 'error' THEN 0 WHEN 'warning' THEN 1 ELSE 2 END AS gravity
    FROM v_issues""", "v_issues")
def order_issues(spark, sf):
    issues = b.job_tables(spark, sf)["quality_issues"]
    return ql.order_issues(issues).select("issue_id", ql.severity_rank("severity").alias("gravity"))


@query("qa_summary", """
    SELECT r.run_id, coalesce(a, 0) AS actionable, coalesce(i, 0) AS info_notes FROM v_runs r
    LEFT JOIN (SELECT run_id, count(*) FILTER (severity <> 'info') AS a,
                      count(*) FILTER (severity = 'info') AS i FROM v_issues GROUP BY 1) s
         ON s.run_id = r.run_id""", ("v_issues", "v_runs"))
def qa_summary(spark, sf):
    tables = b.job_tables(spark, sf)
    return ql.qa_summary(tables["search_runs"], tables["quality_issues"])


# --- Joins ------------------------------------------------------------------------------


@query("canonical_with_frame", """
    SELECT b.run_id, b.job_id, b.snapshot_id, f.city_name, f.keyword, f.experience_key,
           round(f.target_weight, 9) AS target_weight
    FROM v_best b LEFT JOIN v_frame f USING (query_id)""", ("v_best", "v_frame"))
def canonical_with_frame(spark, sf):
    best = dd.dedupe_best(b.v_listings(spark, sf))
    framed = cn.canonical_with_frame(best, b.v_frame(spark, sf))
    return framed.select(
        "run_id", "job_id", "snapshot_id", "city_name", "keyword", "experience_key",
        "target_weight",
    )


ROLLUP_SQL = """
    SELECT l.run_id, l.job_id, count(*) AS discovery_paths,
           count(DISTINCT l.query_id) AS discovery_queries,
           string_agg(DISTINCT f.keyword, ', ' ORDER BY f.keyword) AS discovered_keywords,
           string_agg(DISTINCT f.city_name, ', ' ORDER BY f.city_name) AS discovered_cities
    FROM v_listings l LEFT JOIN v_frame f USING (query_id) GROUP BY 1, 2"""


CANONICAL_SQL = f"""
    SELECT b.run_id, b.job_id, b.url, b.title, b.company, b.location, b.posted_text, b.posted_at,
           f.city_name AS canonical_city_name, f.city_key AS canonical_city_key,
           f.keyword AS canonical_keyword, f.experience_key AS canonical_experience_key,
           round(f.target_weight, 9) AS canonical_target_weight,
           d.description, d.workplace_type, d.employment_type, d.salary_min, d.salary_max,
           d.salary_currency, d.applicants_signal, c.role_family, c.seniority, c.track,
           c.workplace AS classified_workplace,
           round(c.confidence, 9) AS classification_confidence, r.discovery_paths,
           r.discovery_queries, r.discovered_keywords, r.discovered_cities
    FROM v_best b
    LEFT JOIN v_frame f ON f.query_id = b.query_id
    LEFT JOIN v_details d ON d.run_id = b.run_id AND d.job_id = b.job_id
    LEFT JOIN v_class c ON c.run_id = b.run_id AND c.job_id = b.job_id
    LEFT JOIN ({ROLLUP_SQL}) r ON r.run_id = b.run_id AND r.job_id = b.job_id"""
CANONICAL_VIEWS = ("v_best", "v_frame", "v_details", "v_class")


@query("canonical_jobs", CANONICAL_SQL, CANONICAL_VIEWS)
def canonical_jobs(spark, sf):
    return cn.canonical_jobs(b.job_tables(spark, sf))


@query("pending_details", """
    SELECT run_id, job_id, min(url) AS url FROM v_listings l
    WHERE NOT EXISTS (SELECT 1 FROM v_docs d WHERE d.run_id = l.run_id AND d.job_id = l.job_id)
    GROUP BY 1, 2""", ("v_listings", "v_docs"))
def pending_details(spark, sf):
    return cn.pending_details(b.v_listings(spark, sf), b.v_details(spark, sf))


@query("frame_coverage", "SELECT * FROM v_coverage", "v_coverage")
def frame_coverage(spark, sf):
    return cn.frame_coverage(b.v_frame(spark, sf), b.v_listings(spark, sf))


@query("expected_cities", "SELECT run_id, city_key, city_name, jobs FROM v_expected", "v_expected")
def expected_cities(spark, sf):
    coverage = cn.frame_coverage(b.v_frame(spark, sf), b.v_listings(spark, sf))
    return cn.expected_cities(b.v_runs(spark, sf), coverage, b.CITY_LIST).drop("ord")


@query("detail_lookup", """
    SELECT b.run_id, b.job_id, sha256(d.description) AS description_hash,
           d.workplace_type AS workplace_hint
    FROM v_best b LEFT JOIN v_details d USING (run_id, job_id)""", ("v_best", "v_details"))
def detail_lookup(spark, sf):
    jobs = cn.detail_lookup(dd.dedupe_best(b.v_listings(spark, sf)), b.v_details(spark, sf))
    return jobs.select(
        "run_id", "job_id", F.sha2("description", 256).alias("description_hash"), "workplace_hint"
    )


@query("label_eval", """
    SELECT doc_id, p.quality, p.toxic, l.quality AS expected_quality, l.toxic AS expected_toxic
    FROM (SELECT doc_id, (length(text) >= 200)::INT AS quality, 0 AS toxic FROM documents) p
    JOIN labels l USING (doc_id)
    WHERE p.quality IS DISTINCT FROM l.quality OR p.toxic IS DISTINCT FROM l.toxic""")
def label_eval(spark, sf):
    predicted = b.load(spark, sf, "documents").select(
        "doc_id", (F.length("text") >= 200).cast("int").alias("quality"),
        F.lit(0).alias("toxic"),
    )
    return cn.label_eval(predicted, b.load(spark, sf, "labels"), "doc_id", ["quality", "toxic"])


@query("company_total", """
    SELECT company, count(*) FILTER (role_family = 'AI/ML') AS hits, count(*) AS total,
           round(count(*) FILTER (role_family = 'AI/ML') * 100.0::DOUBLE / count(*), 9)
               AS pct_of_own
    FROM v_jobs WHERE coalesce(company, 'N/A') <> 'N/A' GROUP BY 1 HAVING hits > 0""", "v_jobs")
def company_total(spark, sf):
    return mk.company_total(jobs_of(spark, sf), "company", F.col("role_family") == "AI/ML")


# --- Aggregations -------------------------------------------------------------------------


@query("value_shares", """
    SELECT coalesce(nullif(company, ''), 'Unknown') AS segment, count(*) AS n,
           round(count(*) / (SELECT count(*) FROM v_listings), 9) AS share
    FROM v_listings GROUP BY 1""", "v_listings")
def value_shares(spark, sf):
    return sh.value_shares(b.v_listings(spark, sf), "company")


@query("share_of_total", """
    SELECT p_type AS segment, count(*) AS n,
           round(count(*) / sum(count(*)) OVER (), 9) AS share
    FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1""")
def share_of_total(spark, sf):
    lines = b.load(spark, sf, "lineitem").select("l_partkey")
    parts = b.load(spark, sf, "part").select("p_partkey", "p_type")
    return sh.value_shares(lines.join(parts, F.col("l_partkey") == F.col("p_partkey")), "p_type")


SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@query("crosstab", "SELECT n_name AS row, " + ", ".join(
    f"count(*) FILTER (c_mktsegment = '{s}') AS {s}" for s in SEGMENTS
) + " FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1")
def crosstab(spark, sf):
    customers = b.load(spark, sf, "customer").select("c_nationkey", "c_mktsegment")
    nations = b.load(spark, sf, "nation").select("n_nationkey", "n_name")
    joined = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return sh.crosstab(joined, "n_name", "c_mktsegment", SEGMENTS)


@query("crosstab_long", """
    SELECT coalesce(city_name, 'Unknown') AS row, coalesce(role_family, 'Unknown') AS col,
           count(*) AS n
    FROM v_jobs GROUP BY 1, 2""", "v_jobs")
def crosstab_long(spark, sf):
    return sh.crosstab_long(jobs_of(spark, sf), "city_name", "role_family")


@query("overlap_metrics", """
    SELECT sum(n)::BIGINT AS raw_snapshots, count(*) AS canonical_jobs,
           (sum(n) - count(*))::BIGINT AS duplicate_discovery_paths,
           round(avg(n), 9) AS avg_discovery_paths, max(n) AS max_discovery_paths, run_id
    FROM (SELECT run_id, job_id, count(*) AS n FROM v_listings GROUP BY 1, 2)
    GROUP BY run_id""", "v_listings")
def overlap_metrics(spark, sf):
    return ov.overlap_metrics(b.v_listings(spark, sf), "job_id", ["run_id"])


@query("discovery_paths", """
    SELECT run_id, job_id, count(*) AS discovery_count,
           string_agg(DISTINCT query_id, ',' ORDER BY query_id) AS query_ids
    FROM v_listings GROUP BY 1, 2""", "v_listings")
def discovery_paths(spark, sf):
    return ov.discovery_paths(b.v_listings(spark, sf), ["run_id", "job_id"], "query_id")


@query("discovery_rollup", ROLLUP_SQL, ("v_listings", "v_frame"))
def discovery_rollup(spark, sf):
    return ov.discovery_rollup(b.v_listings(spark, sf), b.v_frame(spark, sf))


@query("distinct_jobs", """
    SELECT run_id, count(DISTINCT job_id) AS jobs FROM v_listings GROUP BY 1""", "v_listings")
def distinct_jobs(spark, sf):
    return ov.distinct_count(b.v_listings(spark, sf), "job_id", ["run_id"])


@query("status_counts", """
    SELECT run_id, status, count(*) AS queries FROM v_frame GROUP BY 1, 2""", "v_frame")
def status_counts(spark, sf):
    return pf.status_counts(b.v_frame(spark, sf))


@query("any_url", """
    SELECT run_id, job_id, min(url) AS url FROM v_listings GROUP BY 1, 2""", "v_listings")
def any_url(spark, sf):
    return cn.any_url(b.v_listings(spark, sf))


@query("zero_result_rate", """
    SELECT run_id, count(*) FILTER (coalesce(result_count, 0) = 0) AS zero_queries,
           count(*) AS query_count,
           round(count(*) FILTER (coalesce(result_count, 0) = 0) / count(*), 9) AS zero_rate
    FROM v_frame GROUP BY 1""", "v_frame")
def zero_result_rate(spark, sf):
    return pf.zero_result_rate(b.v_frame(spark, sf))


@query("share_in_group", """
    SELECT p_brand AS segment, count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS hits,
           round(count(*) FILTER (l_returnflag = 'R') / count(*), 9) AS share
    FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1 HAVING count(*) >= 50""")
def share_in_group(spark, sf):
    lines = b.load(spark, sf, "lineitem").select("l_partkey", "l_returnflag")
    parts = b.load(spark, sf, "part").select("p_partkey", "p_brand")
    joined = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return sh.share_in_group(joined, "p_brand", F.col("l_returnflag") == "R", min_rows=50)


def group_case(column: str, groups) -> str:
    whens = " ".join(
        f"WHEN {column} IN ({', '.join(q(m) for m in members)}) THEN {q(name)}"
        for name, members in groups.items()
    )
    return f"CASE {whens} END"


@query("group_map_shares", f"""
    SELECT segment, n, round(n / sum(n) OVER (), 9) AS share,
           round(w / sum(w) OVER (), 9) AS weighted_share
    FROM (SELECT coalesce({group_case('role_family', tx.MACRO_AREAS)},
                          'Non-core / search leakage') AS segment,
                 count(*) AS n, sum({iw('target_weight')}) AS w FROM v_jobs GROUP BY 1)""",
    "v_jobs")
def group_map_shares(spark, sf):
    return sh.group_map_shares(
        jobs_of(spark, sf), "role_family", tx.MACRO_AREAS, "target_weight",
        "Non-core / search leakage",
    )


@query("seniority_group_shares", f"""
    SELECT g AS segment, n, round(n / t, 9) AS share
    FROM (SELECT {group_case('seniority', tx.SENIORITY_GROUPS)} AS g, count(*) AS n,
                 sum(count(*)) OVER () AS t FROM v_legacy GROUP BY 1) WHERE g IS NOT NULL""",
    "v_legacy")
def seniority_group_shares(spark, sf):
    return sh.group_map_shares(legacy_jobs(spark, sf), "seniority", tx.SENIORITY_GROUPS)


@query("two_level_shares", f"""
    SELECT g AS segment, category AS member, 0 AS level, count(*) AS n,
           round(count(*) / (SELECT count(*) FROM v_legacy), 9) AS share
    FROM (SELECT *, {group_case('category', tx.CATEGORY_GROUPS)} AS g FROM v_legacy)
    WHERE g IS NOT NULL GROUP BY 1, 2
    UNION ALL
    SELECT g, NULL, 1, count(*), round(count(*) / (SELECT count(*) FROM v_legacy), 9)
    FROM (SELECT *, {group_case('category', tx.CATEGORY_GROUPS)} AS g FROM v_legacy)
    WHERE g IS NOT NULL GROUP BY 1""", "v_legacy")
def two_level_shares(spark, sf):
    return sh.two_level_shares(legacy_jobs(spark, sf), "category", tx.CATEGORY_GROUPS)


@query("distinct_profile", """
    SELECT count(*) AS total, count(DISTINCT company) AS distinct_company,
           count(DISTINCT title) AS distinct_title FROM v_listings""", "v_listings")
def distinct_profile(spark, sf):
    return sh.distinct_profile(b.v_listings(spark, sf), ["company", "title"])


def legacy_jobs(spark, sf):
    best = dd.dedupe_best(b.v_listings(spark, sf))
    return best.select(
        "run_id", "job_id", "query_id", "title", "company", F.col("event_type").alias("region"),
        cl.legacy_role_type("title").alias("role_type"),
        cl.legacy_seniority("title").alias("seniority"),
        cl.legacy_category_long("title").alias("category"),
        cl.legacy_seniority_short("title").alias("level"),
    )


@query("combo_counts", """
    SELECT seniority || ' ' || role_type AS combo, count(*) AS n,
           round(count(*) / (SELECT count(*) FROM v_legacy), 9) AS share
    FROM v_legacy GROUP BY 1 ORDER BY n DESC, combo LIMIT 20""", "v_legacy")
def combo_counts(spark, sf):
    return sh.combo_counts(legacy_jobs(spark, sf), ["seniority", "role_type"], 20)


IC = ("Software Engineering", "Frontend", "Backend", "Full Stack")


@query("ratio_metric", f"""
    SELECT o AS n_over, u AS n_under, CASE WHEN o > 0 AND u > 0 THEN round(o / u, 9) END AS ratio
    FROM (SELECT count(*) FILTER (level = 'Management') AS o,
                 count(*) FILTER (category IN ({', '.join(q(c) for c in IC)})) AS u
          FROM v_legacy)""", "v_legacy")
def ratio_metric(spark, sf):
    return sh.ratio_metric(
        legacy_jobs(spark, sf), F.col("level") == "Management", F.col("category").isin(*IC)
    )


@query("search_log", """
    SELECT query_id, city_name, location, keyword, experience_key,
           count(snapshot_id) AS jobs_found, coalesce(max(page), 0) AS pages_scraped
    FROM (SELECT f.*, l.snapshot_id, l.page FROM (
              SELECT query_id, city_name, location, keyword, experience_key FROM v_frame
              UNION ALL SELECT DISTINCT run_id || '-nowhere-0', 'City nowhere', NULL, 'kw0', 'level0' FROM v_frame) f
          LEFT JOIN v_listings l USING (query_id))
    GROUP BY ALL""", ("v_frame", "v_listings"))
def search_log(spark, sf):
    """All listings; one search of each run found nothing."""
    listings = b.v_listings(spark, sf)
    frame = b.frame_of(listings).select("run_id", "query_id", "city_name", "location", "keyword", "experience_key")
    empty = frame.select("run_id").distinct().select(
        "run_id", F.concat("run_id", F.lit("-nowhere-0")).alias("query_id"),
        F.lit("City nowhere").alias("city_name"), F.lit(None).cast("string").alias("location"),
        F.lit("kw0").alias("keyword"), F.lit("level0").alias("experience_key"),
    )
    return ov.search_log(frame.unionByName(empty), listings)


CITY_WEIGHTS = {"click": 0.35, "error": 0.2, "purchase": 0.2, "signup": 0.15, "view": 0.1,
                "nowhere": 0.05}


@query("quota_gap", f"""
    SELECT w.c AS event_type, floor(4000 * w.w)::BIGINT AS target, coalesce(e.n, 0) AS have,
           greatest(floor(4000 * w.w)::BIGINT - coalesce(e.n, 0), 0) AS gap
    FROM (VALUES {', '.join(f"('{c}', {w}::DOUBLE)" for c, w in CITY_WEIGHTS.items())}) w(c, w)
    LEFT JOIN (SELECT event_type, count(*) AS n FROM events GROUP BY 1) e ON e.event_type = w.c""")
def quota_gap(spark, sf):
    return sm.quota_gap(b.load(spark, sf, "events"), "event_type", CITY_WEIGHTS, 4000)


@query("capped_sample", f"""
    SELECT event_type, event_id FROM (
        SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type
               ORDER BY {hash32("42", "event_id")}, event_id) AS rn FROM events)
    JOIN (VALUES ('click', 700), ('error', 400), ('purchase', 400), ('signup', 300),
                 ('view', 100000000)) w(c, quota) ON event_type = c
    WHERE rn <= quota""")
def capped_sample(spark, sf):
    quotas = [("click", 700), ("error", 400), ("purchase", 400), ("signup", 300),
              ("view", 100_000_000)]
    events = b.load(spark, sf, "events").select("event_type", "event_id")
    return sm.capped_sample(
        events, "event_type", sm.strata_quotas(spark, "event_type", quotas), "event_id"
    )


@query("shuffled_frame", f"""
    SELECT query_id, copy::INT AS copy, {hash32("42", "query_id", "copy")} AS draw
    FROM v_frame, (SELECT unnest(range(1, 1 + (SELECT CASE WHEN count(*) < 250
                   THEN floor(5000 / (count(*) * 20))::INT + 1 ELSE 1 END FROM v_frame))) AS copy)
    """, "v_frame")
def shuffled_frame(spark, sf):
    drawn = sm.shuffled_frame(b.v_frame(spark, sf), "query_id", 5000)
    return drawn.select("query_id", "copy", "draw")


@query("page_loop_stop", """
    SELECT query_id, sum(n)::BIGINT AS result_count, max(page) AS pages_collected FROM (
        SELECT *, min(CASE WHEN n = 0 THEN page END) OVER (PARTITION BY query_id) AS stop
        FROM (SELECT f.job_id AS query_id, p.page::INT AS page, count(l.job_id) AS n
              FROM (SELECT DISTINCT job_id FROM v_listings) f
              CROSS JOIN (SELECT unnest(range(1, 21)) AS page) p
              LEFT JOIN (SELECT job_id, k // 5 + 1 AS page FROM v_listings) l
                   ON l.job_id = f.job_id AND l.page = p.page
              GROUP BY 1, 2))
    WHERE stop IS NULL OR page <= stop GROUP BY 1""", "v_listings")
def page_loop_stop(spark, sf):
    """Twenty pages per job; a page of a job may well be empty."""
    listings = b.v_listings(spark, sf)
    found = listings.groupBy(
        F.col("job_id").alias("query_id"), (F.floor(F.col("k") / 5) + 1).cast("int").alias("page")
    ).agg(F.count(F.lit(1)).alias("found"))
    planned = listings.select(F.col("job_id").alias("query_id")).distinct().select(
        "query_id", F.explode(F.sequence(F.lit(1), F.lit(20))).alias("page")
    )
    pages = planned.join(found, ["query_id", "page"], "left")
    return sm.page_loop_stop(
        pages.select("query_id", "page", F.coalesce("found", F.lit(0)).alias("n"))
    )


POISSON_SQL = "CASE " + " ".join(
    f"WHEN u < {limit} THEN {k}" for k, limit in enumerate(bs.poisson_steps())
) + f" ELSE {len(bs.poisson_steps())} END"


def interval_sql(source: str, hit: str, weight: str, *key: str) -> str:
    """run_id, observed, lower, upper by bucket sums and hash draws."""
    return f"""
    SELECT run_id, round(max(seen), 9) AS observed,
           round(max((19 * s[12] + 21 * s[13]) / 40.0::DOUBLE), 9) AS lower,
           round(max((21 * s[488] + 19 * s[489]) / 40.0::DOUBLE), 9) AS upper
    FROM (SELECT run_id, list_sort(list(share)) AS s, max(seen) AS seen FROM (
        SELECT run_id, rep, coalesce(sum(m * k) / nullif(sum(m * n), 0), 0.0) AS share,
               sum(k) / sum(n) AS seen
        FROM (SELECT *, {POISSON_SQL} AS m FROM (
            SELECT *, {hash32('42', 'bucket', 'rep')} AS u FROM (
                SELECT run_id, {hash32('42', *key)} % {bs.BUCKETS} AS bucket, sum({weight}) AS n,
                       coalesce(sum({weight}) FILTER ({hit}), 0) AS k
                FROM {source} GROUP BY 1, 2), (SELECT unnest(range(0, 500)) AS rep)))
        GROUP BY 1, 2) GROUP BY 1) GROUP BY 1"""


AI = "role_family = 'AI/ML'"


@query("bootstrap_ci", interval_sql("v_jobs", AI, "1.0::DOUBLE", "job_id"), "v_jobs")
def bootstrap_ci(spark, sf):
    return bs.bootstrap_ci(jobs_of(spark, sf), F.col("role_family") == "AI/ML", ["job_id"], by=["run_id"])


@query("bootstrap_ci_weighted", interval_sql("v_jobs", AI, iw("target_weight"), "job_id"), "v_jobs")
def bootstrap_ci_weighted(spark, sf):
    return bs.bootstrap_ci(
        jobs_of(spark, sf), F.col("role_family") == "AI/ML", ["job_id"], "target_weight", ["run_id"]
    )


@query("bootstrap_ci_hash", interval_sql("v_jobs", AI, "1.0::DOUBLE", "run_id", "job_id"), "v_jobs")
def bootstrap_ci_hash(spark, sf):
    """Buckets by run and job, so that a job's place differs between runs."""
    return bs.bootstrap_ci(
        jobs_of(spark, sf), F.col("role_family") == "AI/ML", ["run_id", "job_id"], by=["run_id"]
    )


@query("search_accuracy", f"""
    SELECT term, jobs, round(named / jobs, 9) AS match_rate, top_roles FROM (
        SELECT term, sum(n)::BIGINT AS jobs, sum(named) AS named,
               string_agg(role, ', ' ORDER BY n DESC, role) FILTER (rn <= 3) AS top_roles
        FROM (SELECT *, row_number() OVER (PARTITION BY term ORDER BY n DESC, role) AS rn FROM (
            SELECT split_part({norm('title')}, ' ', -1) AS term,
                   {role_sql(norm('title'))} AS role, count(*) AS n,
                   count(*) FILTER (contains(lower(title),
                       lower(split_part({norm('title')}, ' ', -1)))) AS named
            FROM v_titles GROUP BY 1, 2)) GROUP BY 1)""", "v_titles")
def search_accuracy(spark, sf):
    """Titles searched by their own last word."""
    titles = classify_jobs(b.v_titles(spark, sf)).withColumn(
        "term", F.element_at(F.split(norm_text("title"), " "), -1)
    )
    return sh.search_accuracy(titles, "term", "title", "role_family")


@query("concentration", """
    SELECT count(*) AS holders, sum(n)::BIGINT AS total,
           sum(n) FILTER (pos <= 10)::BIGINT AS top10_n, sum(n) FILTER (pos <= 25)::BIGINT AS top25_n,
           round(sum(n) FILTER (pos <= 10) / sum(n), 9) AS top10_share,
           round(sum(n) FILTER (pos <= 25) / sum(n), 9) AS top25_share
    FROM (SELECT l_suppkey, count(*) AS n,
                 row_number() OVER (ORDER BY count(*) DESC, l_suppkey) AS pos
          FROM lineitem GROUP BY 1)""")
def concentration(spark, sf):
    return sh.concentration(b.load(spark, sf, "lineitem"), "l_suppkey")


@query("signal_shares", " UNION ALL ".join(
    f"SELECT {q(name)} AS signal, count(*) FILTER (regexp_matches(d, "
    f"{q(f'{LEFT}(?:{words}){RIGHT}')})) AS n, round(count(*) FILTER (regexp_matches(d, "
    f"{q(f'{LEFT}(?:{words}){RIGHT}')})) / count(*), 9) AS share FROM "
    "(SELECT lower(description) AS d FROM v_docs)"
    for name, words in tx.SIGNALS.items()
), "v_docs")
def signal_shares(spark, sf):
    return sh.signal_shares(b.v_details(spark, sf), F.col("description"), tx.SIGNALS)


# --- Windows, sorts -----------------------------------------------------------------------

BEST_COLUMNS = ("run_id", "job_id", "snapshot_id", "query_id", "page", "rank", "scraped_at")


@query("dedupe_best", f"""
    SELECT {', '.join(BEST_COLUMNS)}, round(parser_confidence, 9) AS parser_confidence
    FROM v_best""", "v_best")
def dedupe_best(spark, sf):
    best = dd.dedupe_best(b.v_listings(spark, sf))
    return best.select(*BEST_COLUMNS, "parser_confidence")


@query("dedupe_report", """
    SELECT run_id, job_id, title, company, location, city_name,
           round(target_weight, 9) AS target_weight, role_family, seniority, track, workplace,
           round(confidence, 9) AS confidence
    FROM v_jobs""", "v_jobs")
def dedupe_report(spark, sf):
    return jobs_of(spark, sf).drop("query_id")


@query("keep_first", """
    SELECT o_custkey, o_orderkey, o_orderdate FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
        FROM orders) WHERE rn = 1""")
def keep_first(spark, sf):
    orders = b.load(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return dd.keep_first(orders, ["o_custkey"], [("o_orderdate", "asc"), ("o_orderkey", "asc")])


@query("top_per_group", """
    SELECT p_brand, p_type, pos::INT AS pos, n, group_n, round(n / group_n, 9) AS share FROM (
        SELECT p_brand, p_type, count(*) AS n, sum(count(*)) OVER (PARTITION BY p_brand)::BIGINT
                   AS group_n,
               row_number() OVER (PARTITION BY p_brand ORDER BY count(*) DESC, p_type) AS pos
        FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2) WHERE pos <= 3""")
def top_per_group(spark, sf):
    lines = b.load(spark, sf, "lineitem").select("l_partkey")
    parts = b.load(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    joined = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return dd.top_per_group(joined, "p_brand", "p_type", 3)


@query("top_seniority_of_top_roles", """
    SELECT role_type, level, n, round(n / group_n, 9) AS share FROM (
        SELECT role_type, level, count(*) AS n,
               sum(count(*)) OVER (PARTITION BY role_type)::BIGINT AS group_n,
               row_number() OVER (PARTITION BY role_type ORDER BY count(*) DESC, level) AS pos
        FROM v_legacy WHERE role_type IN (SELECT role_type FROM v_legacy GROUP BY 1
             ORDER BY count(*) DESC, role_type LIMIT 5) GROUP BY 1, 2) WHERE pos <= 5""",
    "v_legacy")
def top_seniority_of_top_roles(spark, sf):
    jobs = legacy_jobs(spark, sf)
    roles = sh.topk_segments(jobs, "role_type", 5).select(F.col("segment").alias("role_type"))
    theirs = jobs.join(roles, "role_type", "left_semi")
    return dd.top_per_group(theirs, "role_type", "level", 5).select(
        "role_type", "level", "n", "share"
    )


@query("topk_segments", """
    SELECT n_name AS segment, count(*) AS n,
           round(count(*) / (SELECT count(*) FROM orders), 9) AS share
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
    GROUP BY 1 ORDER BY n DESC, segment LIMIT 15""")
def topk_segments(spark, sf):
    orders = b.load(spark, sf, "orders").select("o_custkey")
    customers = b.load(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nations = b.load(spark, sf, "nation").select("n_nationkey", "n_name")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return sh.topk_segments(joined, "n_name", 15)


@query("order_jobs", """
    SELECT run_id, job_id, title FROM v_best""", "v_best")
def order_jobs(spark, sf):
    """Canonical rows in text order of their id."""
    best = dd.dedupe_best(b.v_listings(spark, sf)).select("run_id", "job_id", "title")
    return best.orderBy("job_id", "run_id")


# --- Composite results ----------------------------------------------------------------------

REPORT_SECTIONS = """
    SELECT run_id, section, segment, sub, n, round(n / t, 9) AS share,
           round(w / tw, 9) AS weighted_share
    FROM (SELECT *, sum(n) FILTER (section = 'total') OVER (PARTITION BY run_id) AS t,
                 sum(w) FILTER (section = 'total') OVER (PARTITION BY run_id) AS tw FROM (
        SELECT run_id, 'role_family' AS section, role_family AS segment, '' AS sub, count(*) AS n,
               sum(iw) AS w FROM j GROUP BY ALL
        UNION ALL SELECT run_id, 'seniority', seniority, '', count(*), sum(iw) FROM j GROUP BY ALL
        UNION ALL SELECT run_id, 'city_role', city_name, role_family, count(*), sum(iw)
        FROM j GROUP BY ALL
        UNION ALL SELECT run_id, 'total', 'jobs', '', count(*), sum(iw) FROM j GROUP BY ALL))"""
OVERLAP_LINES = " UNION ALL ".join(
    f"SELECT run_id, 'overlap', '{name}', '', NULL, round({expr}, 9), NULL FROM o"
    for name, expr in {
        "raw_snapshots": "raw::DOUBLE", "canonical_jobs": "jobs::DOUBLE",
        "duplicate_discovery_paths": "(raw - jobs)::DOUBLE", "avg_discovery_paths": "av",
        "max_discovery_paths": "mx::DOUBLE",
    }.items()
)


AI_INTERVAL = interval_sql("v_jobs", AI, "1.0::DOUBLE", "job_id")
ENTRY_INTERVAL = interval_sql("v_jobs", "seniority = 'Entry'", "1.0::DOUBLE", "job_id")


@query("market_report", f"""
    SELECT * FROM (WITH j AS (
        SELECT run_id, coalesce(role_family, 'Unknown') AS role_family,
               coalesce(seniority, 'Unknown') AS seniority,
               coalesce(city_name, 'Unknown') AS city_name, {iw('target_weight')} AS iw
        FROM v_jobs),
    o AS (SELECT run_id, sum(n) AS raw, count(*) AS jobs, avg(n) AS av, max(n) AS mx
          FROM (SELECT run_id, job_id, count(*) AS n FROM v_listings GROUP BY 1, 2) GROUP BY 1)
    {REPORT_SECTIONS} UNION ALL {OVERLAP_LINES}
    UNION ALL SELECT run_id, 'interval', metric, bound, NULL, value, NULL FROM (
        UNPIVOT (SELECT 'ai_share' AS metric, * FROM ({AI_INTERVAL})
                 UNION ALL SELECT 'entry_share', * FROM ({ENTRY_INTERVAL}))
        ON observed, lower, upper INTO NAME bound VALUE value)
    UNION ALL SELECT r.run_id, 'quality', 'actionable', '', count(i.run_id), NULL, NULL
    FROM v_runs r LEFT JOIN (SELECT run_id FROM v_issues WHERE severity <> 'info') i
         ON i.run_id = r.run_id GROUP BY 1)""", ("v_jobs", "v_issues"))
def market_report(spark, sf):
    return mk.market_report(b.job_tables(spark, sf))


@query("report_intervals", f"""
    SELECT 'ai_share' AS metric, * FROM ({AI_INTERVAL})
    UNION ALL SELECT 'entry_share', * FROM ({ENTRY_INTERVAL})""", "v_jobs")
def report_intervals(spark, sf):
    return mk.report_intervals(jobs_of(spark, sf))


ADR = ", ".join(q(v) for v in tx.AI_DATA_RESEARCH)


@query("city_ai_share", f"""
    SELECT coalesce(city_name, 'Unknown') AS city, count(*) AS jobs,
           count(*) FILTER (role_family = 'AI/ML') AS ai_jobs,
           round(count(*) FILTER (role_family = 'AI/ML') / count(*), 9) AS ai_share,
           round(count(*) FILTER (role_family IN ({ADR})) / count(*), 9)
               AS ai_data_research_share
    FROM v_jobs GROUP BY 1""", "v_jobs")
def city_ai_share(spark, sf):
    return mk.city_ai_share(jobs_of(spark, sf))


@query("junior_by_family", """
    SELECT role_family, count(*) AS n, count(*) FILTER (seniority IN ('Entry', 'Intern')) AS hits,
           round(count(*) FILTER (seniority IN ('Entry', 'Intern')) / count(*), 9) AS share
    FROM v_jobs GROUP BY 1 HAVING count(*) >= 10""", "v_jobs")
def junior_by_family(spark, sf):
    return mk.junior_by_family(jobs_of(spark, sf), 10)


@query("top_companies", """
    SELECT c.company, c.jobs, c.ai_jobs, r.role_family AS top_role,
           round(r.n / c.jobs, 9) AS top_role_share, s.seniority AS top_seniority
    FROM (SELECT company, count(*) AS jobs, count(*) FILTER (role_family = 'AI/ML') AS ai_jobs
          FROM v_jobs WHERE coalesce(company, '') NOT IN ('', 'N/A') GROUP BY 1
          ORDER BY jobs DESC, company LIMIT 20) c
    JOIN (SELECT company, role_family, count(*) AS n, row_number() OVER (PARTITION BY company
                 ORDER BY count(*) DESC, role_family) AS rn FROM v_jobs GROUP BY 1, 2) r
         ON r.company = c.company AND r.rn = 1
    JOIN (SELECT company, seniority, row_number() OVER (PARTITION BY company
                 ORDER BY count(*) DESC, seniority) AS rn FROM v_jobs GROUP BY 1, 2) s
         ON s.company = c.company AND s.rn = 1""", "v_jobs")
def top_companies(spark, sf):
    return mk.top_companies(jobs_of(spark, sf), 20)


@query("workplace_mix", """
    SELECT workplace, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 9) AS share,
           CASE WHEN workplace <> 'Unknown' THEN round(count(*) / sum(count(*))
                FILTER (workplace <> 'Unknown') OVER (), 9) END AS share_of_known
    FROM v_jobs GROUP BY 1""", "v_jobs")
def workplace_mix(spark, sf):
    return mk.workplace_mix(jobs_of(spark, sf))


@query("region_profile", """
    SELECT region, sum(n)::BIGINT AS jobs, max(role_type) FILTER (rn = 1) AS top_role,
           max(n) FILTER (rn = 1) AS top_role_jobs, sum(j)::BIGINT AS junior_jobs,
           round(sum(j) / sum(n), 9) AS junior_share
    FROM (SELECT region, role_type, count(*) AS n,
                 count(*) FILTER (seniority IN ('Junior', 'Intern')) AS j,
                 row_number() OVER (PARTITION BY region ORDER BY count(*) DESC, role_type) AS rn
          FROM v_legacy GROUP BY 1, 2) GROUP BY 1""", "v_legacy")
def region_profile(spark, sf):
    junior = F.col("seniority").isin(*tx.LEGACY_JUNIOR)
    return mk.region_profile(legacy_jobs(spark, sf), "region", "role_type", junior)


INSIGHTS = {
    "junior": ("seniority", ("Junior", "Intern")),
    "senior": ("seniority", ("Senior", "Staff", "Principal")),
    "management": ("seniority", ("Manager", "Director", "VP", "C-Suite")),
    "swe": ("role_type", ("Software Engineer",)),
    "ml": ("role_type", ("ML/AI Engineer",)),
}


@query("insight_row", "SELECT count(*) AS total_jobs, " + ", ".join(
    f"round(count(*) FILTER ({c} IN ({', '.join(q(v) for v in vs)})) * 100.0::DOUBLE / count(*), 9)"
    f" AS {name}_pct" for name, (c, vs) in INSIGHTS.items()
) + " FROM v_legacy", "v_legacy")
def insight_row(spark, sf):
    shares = {name: F.col(c).isin(*vs) for name, (c, vs) in INSIGHTS.items()}
    return mk.insight_row(legacy_jobs(spark, sf), shares)


@query("ai_deep_dive", """
    SELECT 'seniority' AS section, level AS segment, count(*) AS n,
           round(count(*) / sum(count(*)) OVER (), 9) AS share
    FROM v_legacy WHERE category = 'AI/ML Engineering' GROUP BY 2
    UNION ALL
    SELECT 'company', company, n, round(n / total, 9) FROM (
        SELECT company, count(*) FILTER (category = 'AI/ML Engineering') AS n, count(*) AS total
        FROM v_legacy WHERE company IS NOT NULL GROUP BY 1 HAVING n > 0
        ORDER BY n DESC, company LIMIT 10) WHERE company <> 'N/A'""", "v_legacy")
def ai_deep_dive(spark, sf):
    return mk.ai_deep_dive(
        legacy_jobs(spark, sf), F.col("category") == "AI/ML Engineering", "level", "company"
    )


PROGRESS = ("listing_snapshots", "unique_jobs", "pending_details", "job_details", "classifications",
            "quality_issues", "queries_pending", "queries_complete", "queries_failed")


@query("run_progress", f"""
    SELECT * FROM (WITH lines AS (
    SELECT run_id, 'queries_' || coalesce(status, '') AS metric, count(*) AS value
    FROM v_frame GROUP BY 1, 2
    UNION ALL SELECT run_id, 'unique_jobs', count(*) FROM v_best GROUP BY 1
    UNION ALL SELECT run_id, 'pending_details', count(*) FROM v_best b
    WHERE NOT EXISTS (SELECT 1 FROM v_docs d WHERE d.run_id = b.run_id AND d.job_id = b.job_id)
    GROUP BY 1
    UNION ALL SELECT run_id, 'listing_snapshots', count(*) FROM v_listings GROUP BY 1
    UNION ALL SELECT run_id, 'job_details', count(*) FROM v_docs GROUP BY 1
    UNION ALL SELECT run_id, 'classifications', count(*) FROM v_class GROUP BY 1
    UNION ALL SELECT run_id, 'quality_issues', count(*) FROM v_issues GROUP BY 1),
    wanted AS (SELECT run_id, metric FROM v_runs,
               (SELECT unnest([{', '.join(map(q, PROGRESS))}]) AS metric))
    SELECT run_id, metric, '' AS detail, coalesce(value, 0) AS value
    FROM wanted FULL JOIN lines USING (run_id, metric)
    UNION ALL SELECT run_id, 'failed_sample', coalesce(last_error, ''), count(*)
    FROM v_frame WHERE status = 'failed' GROUP BY 1, 3)""",
    ("v_docs", "v_issues", "v_runs"))
def run_progress(spark, sf):
    scalar = ("job_details", "classifications", "quality_issues")
    return mk.run_progress(b.job_tables(spark, sf), scalar)


@query("senior_title_rate", """
    SELECT count(*) AS n, count(*) FILTER (regexp_matches(lower(title), 'senior|sr\\.')) AS hits,
           round(count(*) FILTER (regexp_matches(lower(title), 'senior|sr\\.')) / count(*), 9)
               AS share
    FROM v_titles""", "v_titles")
def senior_title_rate(spark, sf):
    named = F.lower("title").rlike(r"senior|sr\.")
    return b.v_titles(spark, sf).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(named).alias("hits"),
        F.avg(F.when(named, 1.0).otherwise(0.0)).alias("share"),
    )
