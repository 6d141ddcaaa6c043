"""Registered queries: classification, scalar functions, pages and incremental arrival."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.functions import facts as fx
from tallyfold.functions import identity as idn
from tallyfold.functions import text as tt
from tallyfold.operators import classify as cl
from tallyfold.operators import pages as pg
from tallyfold.operators.sampling import sampling_weight
from tallyfold.plans import bindings as b
from tallyfold.plans import market as mk
from tallyfold.plans import taxonomy as tx
from tallyfold.plans.oracle_views import (
    BLANK, case_sql, clean, hash32, infer_sql, norm, posted_sql, present, role_sql,
    salary_sql, score_sql, seniority_sql, skills_sql, track_sql, workplace_sql,
)
from tallyfold.plans.registry import query
from tallyfold.session import scratch_path
from tallyfold.streaming import ingest as st

# --- Classification ---------------------------------------------------------------------

LABELLED = f"""(SELECT *, {seniority_sql('t', 'role_family')} AS seniority,
        {seniority_sql('t', 'role_family', 'reason')} AS seniority_reason
    FROM (SELECT title_id, title, t, {role_sql('t')} AS role_family,
                 {role_sql('t', 'reason')} AS role_reason
          FROM (SELECT *, {norm('title')} AS t FROM v_titles)))"""


@query("classify_role", f"""
    SELECT title_id, title, role_family, role_reason FROM {LABELLED}""", "v_titles")
def classify_role(spark, sf):
    titles = b.v_titles(spark, sf).withColumn("rule", cl.role_rule(tt.norm_text("title")))
    return titles.select(
        "title_id", "title", cl.role_label(F.col("rule")).alias("role_family"),
        cl.role_reason(F.col("rule")).alias("role_reason"),
    )


@query("classify_seniority", f"""
    SELECT title_id, seniority, seniority_reason FROM {LABELLED}""", "v_titles")
def classify_seniority(spark, sf):
    titles = b.v_titles(spark, sf).withColumn("t", tt.norm_text("title"))
    titles = titles.withColumn("family", cl.role_label(cl.role_rule(F.col("t"))))
    titles = titles.withColumn("rule", cl.seniority_rule(F.col("t"), F.col("family")))
    return titles.select(
        "title_id", cl.seniority_label(F.col("rule")).alias("seniority"),
        cl.seniority_reason(F.col("rule")).alias("seniority_reason"),
    )


@query("classify_track", f"""
    SELECT title_id, {track_sql('t', 'role_family', 'seniority')} AS track FROM {LABELLED}""",
    "v_titles")
def classify_track(spark, sf):
    return cl.classify_jobs(b.v_titles(spark, sf)).select("title_id", "track")


@query("classify_workplace", f"""
    SELECT doc_id, {workplace_sql('description')} AS workplace,
           {workplace_sql('description', 'reason')} AS workplace_reason FROM v_docs""", "v_docs")
def classify_workplace(spark, sf):
    docs = b.v_details(spark, sf).withColumn("rule", cl.workplace_rule("description"))
    return docs.select(
        "doc_id", cl.workplace_label(F.col("rule")).alias("workplace"),
        cl.workplace_reason(F.col("rule")).alias("workplace_reason"),
    )


@query("classify_jobs", """
    SELECT run_id, job_id, role_family, seniority, track, workplace,
           round(confidence, 9) AS confidence, reasons FROM v_class""", "v_class")
def classify_jobs(spark, sf):
    tables = {
        "listing_snapshots": b.v_listings(spark, sf), "job_details": b.v_details(spark, sf),
    }
    labelled = mk.classify_run(tables).drop("classified_at")
    return labelled.withColumn("reasons", F.array_join("reasons", "; "))


@query("infer_workplace", f"""
    SELECT doc_id, {infer_sql("description || ' ' || employment_type || ' ' || source")}
           AS workplace FROM v_docs""", "v_docs")
def infer_workplace(spark, sf):
    words = F.concat_ws(" ", "description", F.array_join(F.map_values("criteria"), " "))
    return b.v_details(spark, sf).select("doc_id", fx.infer_workplace(words).alias("workplace"))


def _legacy(name, function, rules, default):
    @query(name, f"""
        SELECT title_id, {case_sql('lower(title)', rules, default)} AS label FROM v_titles""",
        "v_titles")
    def run(spark, sf):
        return b.v_titles(spark, sf).select("title_id", function("title").alias("label"))

    return run


_legacy("legacy_role_type", cl.legacy_role_type, tx.LEGACY_ROLE_TYPES, "Other")
_legacy("legacy_seniority", cl.legacy_seniority, tx.LEGACY_SENIORITY, "Other")
_legacy("legacy_category", cl.legacy_category, tx.LEGACY_CATEGORIES, "Other Technical")
_legacy("legacy_category_long", cl.legacy_category_long, tx.LEGACY_CATEGORIES_LONG,
        "Uncategorized")
_legacy("legacy_seniority_short", cl.legacy_seniority_short, tx.LEGACY_SENIORITY_SHORT,
        "Mid-Level")


# --- Scalar functions -------------------------------------------------------------------


@query("norm_text", f"""
    SELECT doc_id, sha256({norm('text')}) AS norm_hash, sha256({clean('text')}) AS clean_hash
    FROM documents""")
def norm_text(spark, sf):
    return b.load(spark, sf, "documents").select(
        "doc_id", F.sha2(tt.norm_text("text"), 256).alias("norm_hash"),
        F.sha2(tt.clean_text("text"), 256).alias("clean_hash"),
    )


@query("posted_at", f"""
    SELECT snapshot_id, {posted_sql('posted_text', 'scraped_at')} AS posted_at
    FROM v_listings""", "v_listings")
def posted_at(spark, sf):
    return b.v_listings(spark, sf).select("snapshot_id", "posted_at")


@query("salary_range", f"""
    SELECT doc_id, {salary_sql('description', 1)} AS salary_min,
           {salary_sql('description', 3)} AS salary_max,
           CASE WHEN {salary_sql('description', 1)} IS NOT NULL THEN 'USD' END AS salary_currency
    FROM v_docs""", "v_docs")
def salary_range(spark, sf):
    found = fx.salary_range("description")
    return b.v_details(spark, sf).select("doc_id", found.alias("s")).select("doc_id", "s.*")


@query("skills", f"""
    SELECT doc_id, array_to_string({skills_sql('description')}, ',') AS skills
    FROM v_docs""", "v_docs")
def skills(spark, sf):
    return b.v_details(spark, sf).select(
        "doc_id", F.array_join(fx.skills("description"), ",").alias("skills")
    )


# Shapes in which an id may come, by event.
URL_SHAPES = """CASE event_id % 8
    WHEN 0 THEN 'https://jobs.example.com/jobs/view/' || user_id
    WHEN 1 THEN 'https://jobs.example.com/jobs/view/staff-engineer-2-at-x-' || user_id || '/?ref=a-9'
    WHEN 2 THEN 'https://jobs.example.com/jobs/search/?a=1&currentJobId=' || user_id || '&jobId=7'
    WHEN 3 THEN 'https://jobs.example.com/x?jobId=' || user_id || '%2D1#currentJobId=5'
    WHEN 4 THEN 'https://jobs.example.com/jobs/view/none/' || event_type
    WHEN 5 THEN '/jobs/view/' || user_id || '/'
    WHEN 6 THEN 'https://jobs.example.com/x?currentJobId=&jobId=' || user_id
    ELSE 'https://jobs.example.com/app#?currentJobId=' || user_id END"""


@query("job_id_from_url", f"""
    SELECT event_id, url, CASE event_id % 8 WHEN 3 THEN user_id || '-1' WHEN 4 THEN NULL
                               ELSE user_id::VARCHAR END AS job_id
    FROM (SELECT *, {URL_SHAPES} AS url FROM events)""")
def job_id_from_url(spark, sf):
    events = b.load(spark, sf, "events").withColumn("url", F.expr(URL_SHAPES))
    return events.select("event_id", "url", idn.job_id_from_url("url").alias("job_id"))


@query("canonical_url", f"""
    SELECT run_id, job_id, '{idn.VIEW_BASE}' || job_id || '/' AS url FROM v_best""", "v_best")
def canonical_url(spark, sf):
    from tallyfold.operators.dedupe import dedupe_best

    best = dedupe_best(b.v_listings(spark, sf))
    return best.select("run_id", "job_id", idn.canonical_url("job_id").alias("url"))


@query("search_url", """
    SELECT p_partkey, 'https://jobs.example.com/jobs/search/?keywords='
           || replace(replace(url_encode(p_name || ' ~*' || p_type), '%20', '+'), '%7E', '~')
           || '&location=' || replace(url_encode(p_brand), '%20', '+') || '&f_TPR=r'
           || (p_size % 30 + 1) * 86400 || '&f_E=4&sortBy=DD'
           || CASE WHEN p_size % 3 > 0 THEN '&start=' || p_size % 3 * 25 ELSE '' END AS url
    FROM part""")
def search_url(spark, sf):
    parts = b.load(spark, sf, "part").select(
        "p_partkey", F.concat("p_name", F.lit(" ~*"), "p_type").alias("keyword"), "p_brand",
        (F.col("p_size") % 30 + 1).alias("days"), F.lit("f_E=4").alias("param"),
        (F.col("p_size") % 3 * 25).alias("start"),
    )
    url = idn.search_url("keyword", "p_brand", "days", "param", F.col("start"))
    return parts.select("p_partkey", url.alias("url"))


@query("stable_id", """
    SELECT o_orderkey, 'q_' || substr(sha1(o_orderpriority || '|' || o_orderstatus || '|'
           || o_custkey), 1, 12) AS query_id FROM orders""")
def stable_id(spark, sf):
    return b.load(spark, sf, "orders").select(
        "o_orderkey",
        idn.stable_id("o_orderpriority", "o_orderstatus", F.col("o_custkey").cast("string")).alias(
            "query_id"
        ),
    )


@query("content_hash", "SELECT page_id, sha256(html) AS content_sha256 FROM pages")
def content_hash(spark, sf):
    return b.load(spark, sf, "pages").select(
        "page_id", idn.content_hash("html").alias("content_sha256")
    )


@query("listing_confidence", f"""
    SELECT snapshot_id, round({score_sql(
        0.35, (present('title'), 0.2), (present('company'), 0.15), (present('location'), 0.15),
        (present('posted_text'), 0.1), (present('url'), 0.05))}, 9) AS confidence
    FROM v_listings""", "v_listings")
def listing_confidence(spark, sf):
    score = fx.listing_confidence("title", "company", "location", "posted_text", "url")
    return b.v_listings(spark, sf).select("snapshot_id", score.alias("confidence"))


@query("detail_confidence", f"""
    SELECT doc_id, round({score_sql(
        0.25, (present('description'), 0.25), ('true', 0.2), ("workplace_type <> 'Unknown'", 0.1),
        (present('employment_type'), 0.1), (f"len({skills_sql('description')}) > 0", 0.1))}, 9)
           AS confidence FROM v_details""", "v_details")
def detail_confidence(spark, sf):
    return b.v_details(spark, sf).select("doc_id", F.col("parser_confidence").alias("confidence"))


@query("clean_company", f"""
    SELECT snapshot_id, CASE WHEN company IS NULL OR trim(company) = '' THEN 'N/A'
           ELSE regexp_replace(company, '^{BLANK}+|{BLANK}+$', '', 'g') END AS company
    FROM (SELECT snapshot_id, '  ' || company || chr(9) AS company FROM v_listings
          WHERE company <> '' OR company IS NULL
          UNION ALL SELECT snapshot_id, company FROM v_listings WHERE company = '')""",
    "v_listings")
def clean_company(spark, sf):
    padded = F.when(F.col("company") != "", F.concat(F.lit("  "), "company", F.lit("\t"))).otherwise(
        F.col("company")
    )
    return b.v_listings(spark, sf).select("snapshot_id", tt.clean_company(padded).alias("company"))


@query("clean_title", f"""
    SELECT title_id, regexp_replace(regexp_replace(title, '^{BLANK}+|{BLANK}+$', '', 'g'),
           '{BLANK}*-?{BLANK}*Hiring multiple candidates?$', '') AS title FROM v_titles""",
    "v_titles")
def clean_title(spark, sf):
    return b.v_titles(spark, sf).select("title_id", tt.clean_title("title").alias("title"))


@query("sampling_weight", """
    SELECT query_id, round(CASE WHEN target_weight <> 0 THEN 1.0::DOUBLE / target_weight END, 9)
           AS sampling_weight FROM v_frame""", "v_frame")
def sampling_weight_query(spark, sf):
    return b.v_frame(spark, sf).select(
        "query_id", sampling_weight("target_weight").alias("sampling_weight")
    )


@query("location_fallback", """
    SELECT snapshot_id, CASE WHEN location = 'N/A' THEN 'City ' || event_type ELSE location END
           AS location FROM v_listings""", "v_listings")
def location_fallback(spark, sf):
    searched = F.concat(F.lit("City "), "event_type")
    return b.v_listings(spark, sf).select(
        "snapshot_id", tt.location_fallback("location", searched).alias("location")
    )


@query("clean_url", "SELECT page_id, split_part(url, '?', 1) AS url FROM pages")
def clean_url(spark, sf):
    return b.load(spark, sf, "pages").select("page_id", idn.clean_url("url").alias("url"))


@query("hash_draw", f"SELECT event_id, {hash32('42', 'event_id')} AS draw FROM events")
def hash_draw(spark, sf):
    return b.load(spark, sf, "events").select(
        "event_id", idn.hash32(F.lit(42), "event_id").alias("draw")
    )


# --- Pages --------------------------------------------------------------------------------

NAV_LINKS = pg.CardSpec(
    cards=((pg.Pick("li"),),), link=(pg.Pick("a", (), "/"),), title=(pg.Pick("a"),)
)
LI_PATTERN = '<li><a href="([^"]*)">([^<]*)</a></li>'


def unescape(text: str) -> str:
    for entity, sign in (("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        text = f"replace({text}, '{entity}', '{sign}')"
    return text


CARDS_SQL = f"""
    SELECT page_id, rank::INT AS rank, {unescape('hrefs[rank]')} AS href,
           {clean(unescape('texts[rank]'))} AS title
    FROM (SELECT page_id, regexp_extract_all(html, '{LI_PATTERN}', 1) AS hrefs,
                 regexp_extract_all(html, '{LI_PATTERN}', 2) AS texts,
                 unnest(range(1, len(regexp_extract_all(html, '{LI_PATTERN}', 1)) + 1)) AS rank
          FROM pages)
    WHERE {clean(unescape('texts[rank]'))} <> ''"""


@query("extract_cards", CARDS_SQL)
def extract_cards(spark, sf):
    """Navigation entries as cards: every list item with a link, ranked within its page."""
    cards = pg.extract_cards(
        b.load(spark, sf, "pages").select("page_id", "html"), spec=NAV_LINKS,
        job_id=F.nullif("href", F.lit("")),
    )
    return cards.select("page_id", "rank", "href", "title")


@query("extract_cards_native", CARDS_SQL)
def extract_cards_native(spark, sf):
    """The same entries without Python: flat repeated tags need no markup reader."""
    pages = b.load(spark, sf, "pages")
    pairs = pg.pair_by_position(
        pages, "page_id", pg.tag_texts("html", LI_PATTERN, 1),
        pg.tag_texts("html", LI_PATTERN, 2), ("href", "title"),
    )

    def plain(name):
        value = F.col(name)
        for entity, sign in (("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
            value = F.replace(value, F.lit(entity), F.lit(sign))
        return value

    rows = pairs.select(
        "page_id", (F.col("pos") + 1).alias("rank"), plain("href").alias("href"),
        tt.clean_text(plain("title")).alias("title"),
    )
    return rows.where(F.col("title") != "")


DETAIL_HTML = """
    '<html><body><section class="description"><div class="show-more-less-html__markup"><p>'
    || replace(replace(replace(description, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')
    || '</p></div></section><ul><li class="description__job-criteria-item">'
    || '<h3 class="description__job-criteria-subheader">Job type</h3>'
    || '<span class="description__job-criteria-text">' || employment_type || '</span></li></ul>'
    || '<span class="num-applicants__caption">' || applicants_signal || '</span></body></html>'"""


@query("extract_detail", f"""
    SELECT doc_id, sha256(c) AS description_hash, {infer_sql("c || ' ' || employment_type")}
               AS workplace_type,
           employment_type, {salary_sql('c', 1)} AS salary_min, {salary_sql('c', 3)} AS salary_max,
           applicants_signal, array_to_string({skills_sql('c')}, ',') AS skills,
           round({score_sql(0.25, (present('c'), 0.25), ('true', 0.2),
                            (f'''{infer_sql("c || ' ' || employment_type")} <> 'Unknown' ''', 0.1),
                            ('true', 0.1), (f"len({skills_sql('c')}) > 0", 0.1))}, 9)
               AS parser_confidence
    FROM (SELECT *, {clean('description')} AS c FROM v_docs)""", "v_docs")
def extract_detail(spark, sf):
    """Detail pages built around the documents, read back by the page reader."""
    pages = b.v_details(spark, sf).select(
        "run_id", "job_id", "url", "raw_snapshot_path", "scraped_at",
        F.expr(DETAIL_HTML).alias("html"),
    )
    found = pg.extract_detail(pages)
    return found.select(
        F.col("job_id").cast("bigint").alias("doc_id"),
        F.sha2("description", 256).alias("description_hash"), "workplace_type",
        "employment_type", "salary_min", "salary_max", "applicants_signal",
        F.array_join("skills", ",").alias("skills"), "parser_confidence",
    )


P_PATTERN = "<p>([^<]*)</p>"


@query("pair_by_position", f"""
    SELECT page_id, (i - 1)::INT AS pos, links[i] AS link,
           coalesce(paragraphs[i], 'N/A') AS paragraph
    FROM (SELECT *, unnest(range(1, len(links) + 1)) AS i FROM (
        SELECT page_id, regexp_extract_all(html, '{LI_PATTERN}', 1) AS links,
               regexp_extract_all(html, '{P_PATTERN}', 1) AS paragraphs FROM pages))""")
def pair_by_position(spark, sf):
    """i-th link of a page with its i-th paragraph; links beyond the last one stay."""
    pairs = pg.pair_by_position(
        b.load(spark, sf, "pages"), "page_id", pg.tag_texts("html", LI_PATTERN),
        pg.tag_texts("html", P_PATTERN), ("link", "paragraph"),
    )
    return pairs.where(F.col("link").isNotNull()).select(
        "page_id", "pos", "link", F.coalesce("paragraph", F.lit("N/A")).alias("paragraph")
    )


def usable_sql(texts: str, furniture, longer_than: int) -> str:
    bad = " OR ".join(f"contains(lower(x), '{w}')" for w in furniture)
    cleaned = f"list_transform({texts}, lambda x: {clean('x')})"
    return f"list_filter({cleaned}, lambda x: length(x) > {longer_than} AND NOT ({bad}))"


LINK_TEXTS = f"regexp_extract_all(html, '{LI_PATTERN}', 2)"
P_TEXTS = f"regexp_extract_all(html, '{P_PATTERN}', 1)"


@query("pair_headings", f"""
    SELECT page_id, (i - 1)::INT AS pos, ts[i] AS title, cs[i] AS company
    FROM (SELECT *, unnest(range(1, least(len(ts), len(cs)) + 1)) AS i FROM (
        SELECT page_id, {LINK_TEXTS} AS found,
               {usable_sql(P_TEXTS, pg.TITLE_FURNITURE, pg.TITLE_LENGTH)} AS ts,
               {usable_sql(LINK_TEXTS, pg.COMPANY_FURNITURE, pg.COMPANY_LENGTH)} AS cs
        FROM pages) WHERE len(found) < 6)
    WHERE list_position(ts, ts[i]) = i AND NOT list_contains(found, ts[i])""")
def pair_headings(spark, sf):
    """Paragraphs as titles and link texts as companies, on pages with few links."""
    links = pg.tag_texts("html", LI_PATTERN, 2)
    return pg.pair_headings(
        b.load(spark, sf, "pages"), "page_id", pg.tag_texts("html", P_PATTERN), links, links, 6
    )


# --- Incremental arrival --------------------------------------------------------------------

# Buckets of the stored tables here, in proportion to the given tables.
SMALL = 8


@query("ingest_stream", """
    SELECT user_id, event_id, event_type, ts FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn
        FROM events) WHERE rn = 1""")
def ingest_stream(spark, sf):
    """All events taken in as a stream, newest row per user."""
    schema = b.load(spark, sf, "events").schema
    root = scratch_path(spark, "ingest")
    stream = st.stream_files(spark, f"{sf}/events.parquet*", schema)
    st.ingest_stream(
        stream, f"{root}/target", f"{root}/checkpoint", ["user_id"], ["event_id"], buckets=SMALL
    ).awaitTermination()
    return st.read_current(spark, f"{root}/target").select("user_id", "event_id", "event_type", "ts")


@query("stream_dedupe", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedupe(spark, sf):
    """First sight of each user and event type, kept across micro-batches."""
    schema = b.load(spark, sf, "events").schema
    root = scratch_path(spark, "stream_dedupe")
    stream = st.stream_files(spark, f"{sf}/events.parquet*", schema)
    first = st.stream_dedupe(stream, ["user_id", "event_type"], "ts", "60 days")
    (
        first.select("user_id", "event_type").writeStream.format("parquet")
        .option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True).start().awaitTermination()
    )
    return spark.read.schema("user_id bigint, event_type string").parquet(f"{root}/out")


BATCHES = 3


def arrivals(df, key, folder):
    """Appends the table to `folder` in three parts, one after each step of the iteration."""
    for part in range(BATCHES):
        df.where(F.col(key) % BATCHES == part).write.mode("append").parquet(folder)
        yield part


@query("ingest_pages", f"""
    SELECT href, page_id, rank, title FROM (
        SELECT *, row_number() OVER (PARTITION BY href
                  ORDER BY page_id % {BATCHES} DESC, page_id DESC, rank DESC) AS rn
        FROM ({CARDS_SQL})) WHERE rn = 1""")
def ingest_pages(spark, sf):
    """Pages arrive in three batches and become cards; of one link the later batch wins."""
    pages = b.load(spark, sf, "pages").select("page_id", "html")
    root = scratch_path(spark, "ingest_pages")

    def cards(df):
        found = pg.extract_cards(df, spec=NAV_LINKS, job_id=F.nullif("href", F.lit("")))
        return found.select("href", "page_id", "rank", "title")

    for _ in arrivals(pages, "page_id", f"{root}/in"):
        stream = st.stream_files(spark, f"{root}/in", pages.schema)
        st.ingest_stream(
            stream, f"{root}/target", f"{root}/checkpoint", ["href"], ["page_id", "rank"], cards, SMALL
        ).awaitTermination()
    return st.read_current(spark, f"{root}/target")


@query("first_sight", f"""
    SELECT user_id, event_id, event_type FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id % {BATCHES}, event_id) AS rn
        FROM events) WHERE rn = 1""")
def first_sight(spark, sf):
    """Events arrive in three batches; the first row of each user stays for good."""
    events = b.load(spark, sf, "events").select("user_id", "event_id", "event_type")
    root = scratch_path(spark, "first_sight")
    for _ in arrivals(events, "event_id", f"{root}/in"):
        stream = st.stream_files(spark, f"{root}/in", events.schema)
        st.first_sight(
            stream, f"{root}/target", f"{root}/checkpoint", ["user_id"], ["event_id"], SMALL
        ).awaitTermination()
    return st.read_current(spark, f"{root}/target").select(events.columns)


@query("first_seen_stream", """
    SELECT user_id, event_id, event_type, ts::TIMESTAMP AS ts FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
        FROM events) WHERE rn = 1""")
def first_seen_stream(spark, sf):
    """Events arrive in three batches, each over the whole period; earlier rows correct what was seen."""
    events = b.load(spark, sf, "events").select("user_id", "event_id", "event_type", "ts")
    root = scratch_path(spark, "first_seen")
    for _ in arrivals(events, "event_id", f"{root}/in"):
        stream = st.stream_files(spark, f"{root}/in", events.schema)
        st.first_seen_table(
            stream, f"{root}/target", f"{root}/checkpoint", ["user_id"], "ts", "event_id", "90 days", "1 days", SMALL
        ).awaitTermination()
    found = st.read_current(spark, f"{root}/target")
    return found.select("user_id", "event_id", "event_type", F.col("ts").cast("timestamp_ntz").alias("ts"))
