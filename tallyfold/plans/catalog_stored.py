"""Registered queries: stored tables that take in batches, and work done once per distinct value."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.functions.facts import SKILLS
from tallyfold.functions.identity import hash32
from tallyfold.operators import bitmaps as bm
from tallyfold.operators import classify as cl
from tallyfold.operators import dedupe as dd
from tallyfold.operators import phrases as ph
from tallyfold.operators import sketches as sk
from tallyfold.operators import upsert as up
from tallyfold.plans import bindings as b
from tallyfold.plans import taxonomy as tx
from tallyfold.plans.catalog_shares import CANONICAL_SQL, CANONICAL_VIEWS
from tallyfold.plans.catalog_tables import EXPORT_SQL, EXPORT_VIEWS, EXPORTED
from tallyfold.plans.incremental import JobStore
from tallyfold.plans.oracle_views import LEFT, RIGHT, norm, q, role_sql, seniority_sql, skills_sql, track_sql
from tallyfold.plans.registry import query
from tallyfold.schemas import JOB_DETAILS, LISTING_SNAPSHOTS, SEARCH_QUERIES, TABLES
from tallyfold.session import scratch_path, stored
from tallyfold.sources import published as pb
from tallyfold.sources.bucketed import BucketedTable, buckets_for

BUCKETS = 8  # the least; more for larger tables
BATCHES = 3


def events_table(spark, sf):
    """The newest event per user and type, after three batches; the later batch wins."""
    events = b.load(spark, sf, "events").select("user_id", "event_type", "event_id", "value", "ts")
    table = BucketedTable.create(
        spark, scratch_path(spark, "events-table"), events.schema, ["user_id", "event_type"],
        by=["user_id"], buckets=buckets_for(events.count(), BUCKETS),
    )
    for number in range(BATCHES):
        batch = events.where(F.col("event_id") % BATCHES == number)
        table.upsert(batch, [F.desc("event_id")], number)
    return table


NEWEST = f"""
    SELECT user_id, event_type, event_id, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, event_type
                  ORDER BY event_id % {BATCHES} DESC, event_id DESC) AS rn FROM events) WHERE rn = 1"""


@query("stored_upserts", NEWEST)
def stored_upserts(spark, sf):
    return events_table(spark, sf).current().drop("ts")


@query("stored_compact", NEWEST)
def stored_compact(spark, sf):
    """The same rows from one run per bucket, with nothing else left on disk."""
    table = events_table(spark, sf)
    table.compact()
    table.sweep(keep=1)
    return BucketedTable(spark, table.root).current().drop("ts")


@query("stored_lookup", f"""
    SELECT * FROM ({NEWEST}) WHERE user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase')""")
def stored_lookup(spark, sf):
    """Everything stored about users who bought something."""
    buyers = b.load(spark, sf, "events").where(F.col("event_type") == "purchase").select("user_id")
    return events_table(spark, sf).lookup(buyers.distinct()).drop("ts")


@query("canonical_incremental", CANONICAL_SQL, CANONICAL_VIEWS)
def canonical_incremental(spark, sf):
    """Canonical jobs after listings, details and searches came in three batches."""
    tables = b.job_tables(spark, sf, keep=stored)
    given = {
        name: tables[name].select(*schema.fieldNames())
        for name, schema in (
            ("listing_snapshots", LISTING_SNAPSHOTS), ("job_details", JOB_DETAILS), ("search_queries", SEARCH_QUERIES),
        )
    }
    rows = max(df.count() for df in given.values())
    store = JobStore(spark, scratch_path(spark, "job-store"), buckets_for(rows, BUCKETS))
    for number in range(BATCHES):
        store.apply({
            name: df.where(F.pmod(F.xxhash64(df.columns[0], df.columns[1]), F.lit(BATCHES)) == number)
            for name, df in given.items()
        }, number)
    return store.jobs.current()


# --- Rules once per distinct title --------------------------------------------------------------

LISTING_LABELS = f"""
    SELECT snapshot_id, role_family, seniority, {track_sql('t', 'role_family', 'seniority')} AS track
    FROM (SELECT *, {seniority_sql('t', 'role_family')} AS seniority
          FROM (SELECT snapshot_id, {norm('title')} AS t, {role_sql(norm('title'))} AS role_family
                FROM v_listings))"""


@query("classify_listings", LISTING_LABELS, "v_listings")
def classify_listings(spark, sf):
    """Labels of every observation, from a dictionary of their distinct titles."""
    return cl.classify_distinct(b.v_listings(spark, sf)).select("snapshot_id", "role_family", "seniority", "track")


@query("classify_with_dictionary", LISTING_LABELS, "v_listings")
def classify_with_dictionary(spark, sf):
    """The dictionary of the first run is kept; the second run labels only titles that are new to it."""
    listings = b.v_listings(spark, sf)
    first = stored(cl.title_dictionary(listings.where(F.col("run_id") == "run_a")), "titles")
    return cl.classify_distinct(listings, dictionary=first).select("snapshot_id", "role_family", "seniority", "track")


# --- Many terms in one pass ---------------------------------------------------------------------


@query("signal_phrases", " UNION ALL ".join(
    f"SELECT {q(name)} AS label, n, round(n / total, 9) AS share FROM (SELECT count(*) AS total, "
    f"count(*) FILTER (regexp_matches(lower(description), {q(f'{LEFT}(?:{words}){RIGHT}')})) AS n FROM v_docs)"
    for name, words in tx.SIGNALS.items()), "v_docs")
def signal_phrases(spark, sf):
    """Shares of signals, their words found by a join."""
    terms = ph.term_table(spark, {name: words.split("|") for name, words in tx.SIGNALS.items()})
    return ph.term_counts(b.v_details(spark, sf), ["doc_id"], "description", terms)


@query("skill_phrases", f"""
    SELECT doc_id, array_to_string({skills_sql('description')}, ',') AS skills FROM v_docs""", "v_docs")
def skill_phrases(spark, sf):
    found = ph.terms_per_row(b.v_details(spark, sf), ["doc_id"], "description", SKILLS)
    return found.select("doc_id", F.array_join("terms", ",").alias("skills"))


PAIR = "[a-z0-9]+ [a-z0-9]+"


@query("search_terms", f"""
    WITH terms AS (SELECT DISTINCT regexp_extract(lower(text), '{PAIR}') AS term FROM benchmark),
    d AS (SELECT lower(text) AS text FROM documents)
    SELECT term AS label, count(text) AS n, round(count(text) / (SELECT count(*) FROM d), 9) AS share
    FROM terms LEFT JOIN d ON CASE WHEN contains(d.text, term)
        THEN regexp_matches(d.text, '{LEFT}' || term || '{RIGHT}') ELSE false END
    WHERE term <> '' GROUP BY 1""")
def search_terms(spark, sf):
    """For the first two words of every benchmark item: how many documents name them."""
    items = b.load(spark, sf, "benchmark").select(F.regexp_extract(F.lower("text"), PAIR, 0).alias("term"))
    terms = ph.as_terms(items.select(F.col("term").alias("label"), "term"))
    return ph.term_counts(b.load(spark, sf, "documents"), ["doc_id"], "text", terms)


# --- Published exports, mergeable counts, ends of runs --------------------------------------------


@query("export_published", EXPORT_SQL, EXPORT_VIEWS)
def export_published(spark, sf):
    """Everything published, then one run in its place again; the second version has the same tables."""
    root = scratch_path(spark, "published")
    tables = b.job_tables(spark, sf, keep=stored)
    given = {name: tables[name].select(*schema.fieldNames()) for name, schema in TABLES.items()}
    pb.publish(given, root)
    pb.publish(given, root, "run_a")
    pb.sweep(spark, root, keep=1)
    counts = [
        table.agg(F.count(F.lit(1)).alias("n"), F.sum(hash32(*EXPORTED[name][1])).alias("content"))
        .select(F.lit(name).alias("table_name"), "n", "content")
        for name, table in pb.read_published(spark, root).items()
    ]
    return dd.union_batches(*counts)


@query("sketch_counts", """
    SELECT scope, jobs, rows, true AS close FROM (
        SELECT 'run ' || run_id AS scope, count(DISTINCT job_id) AS jobs, count(*) AS rows FROM v_listings GROUP BY run_id
        UNION ALL SELECT 'place ' || coalesce(location, ''), count(DISTINCT job_id), count(*) FROM v_listings GROUP BY location
        UNION ALL SELECT 'all', count(DISTINCT job_id), count(*) FROM v_listings)""", "v_listings")
def sketch_counts(spark, sf):
    """Distinct jobs per run, per place and in all from sketches of (run, place), beside the exact counts;
    close: within 3 %."""
    listings = b.v_listings(spark, sf)
    kept = stored(sk.key_sketches(listings, "job_id", ["run_id", "location"]), "sketches")
    scopes = {
        "run_id": F.concat(F.lit("run "), "run_id"),
        "location": F.concat(F.lit("place "), F.coalesce("location", F.lit(""))), None: F.lit("all"),
    }
    lines = []
    for column, scope in scopes.items():
        by = [column] if column else []
        lines += [
            sk.estimated(sk.merge_sketches(kept, by), "estimate").select(scope.alias("scope"), "rows", "estimate"),
            listings.groupBy(*by).agg(F.count_distinct("job_id").alias("jobs")).select(scope.alias("scope"), "jobs"),
        ]
    both = dd.union_batches(*lines).groupBy("scope").agg(*[F.max(c).alias(c) for c in ("jobs", "rows", "estimate")])
    near = F.abs(F.col("estimate") - F.col("jobs")) <= F.col("jobs") * 0.03
    return both.select("scope", "jobs", "rows", near.alias("close"))


@query("finish_runs", """
    SELECT run_id, CASE run_id WHEN 'run_a' THEN 'complete' WHEN 'run_empty' THEN 'failed' ELSE 'running' END AS status,
           CASE WHEN run_id <> 'run_b' THEN started_at + INTERVAL 1 DAY END AS ended_at
    FROM v_runs""", "v_runs")
def finish_runs(spark, sf):
    """All runs end, one resumes and is still running, and a second end of a run that is over has no effect."""
    runs = stored(b.v_runs(spark, sf), "runs")
    status = F.when(F.col("run_id") == "run_empty", "failed").otherwise("complete")
    over = runs.select(
        "run_id", status.alias("status"), (F.col("started_at") + F.expr("INTERVAL 1 DAY")).alias("ended_at")
    )
    ended = up.finish_runs(runs, over)
    again = up.run_guard(ended, ended.where("run_id = 'run_b'"))
    resumed = up.resume_runs(ended, again)
    late = over.where("run_id <> 'run_b'").withColumn("status", F.lit("late"))
    return up.finish_runs(resumed, late).select("run_id", "status", "ended_at")


@query("bitmap_counts", """
    SELECT 'run ' || run_id AS scope, count(DISTINCT job_id) AS jobs FROM v_listings GROUP BY run_id
    UNION ALL SELECT 'place ' || coalesce(location, ''), count(DISTINCT job_id) FROM v_listings GROUP BY location
    UNION ALL SELECT 'search ' || query_id, count(DISTINCT job_id) FROM v_listings GROUP BY query_id
    UNION ALL SELECT 'all', count(DISTINCT job_id) FROM v_listings""", "v_listings")
def bitmap_counts(spark, sf):
    """Distinct jobs per run, place and search and in all, exact, from bitmaps of (run, search, place)."""
    listings = b.v_listings(spark, sf)
    numbers = stored(bm.key_numbers(listings, ["job_id"]), "job-numbers")
    by = ["run_id", "query_id", "location"]
    kept = stored(bm.group_bitmaps(listings, numbers, ["job_id"], by), "bitmaps")
    scopes = (("run_id", "run "), ("location", "place "), ("query_id", "search "), (None, "all"))
    lines = []
    for column, name in scopes:
        keys = [column] if column else []
        scope = F.concat(F.lit(name), F.coalesce(column, F.lit(""))) if column else F.lit(name)
        lines.append(bm.counted(bm.merge_bitmaps(kept, keys), keys).select(scope.alias("scope"), "jobs"))
    return dd.union_batches(*lines)


@query("runs_in_common", """
    SELECT count(*) FILTER (a AND NOT b) AS only_left, count(*) FILTER (a AND b) AS both,
           count(*) FILTER (b AND NOT a) AS only_right
    FROM (SELECT job_id, bool_or(run_id = 'run_a') AS a, bool_or(run_id = 'run_b') AS b FROM v_listings GROUP BY 1)""",
    "v_listings")
def runs_in_common(spark, sf):
    """Jobs that were found in one run, the other, or both, from their bitmaps."""
    listings = b.v_listings(spark, sf)
    numbers = stored(bm.key_numbers(listings, ["job_id"]), "job-numbers")
    kept = bm.group_bitmaps(listings, numbers, ["job_id"], ["run_id"])
    return bm.shared(kept, "run_id", "run_a", "run_b")
