"""SQL text of the bindings and rule chains, for the DuckDB side of the comparison."""

from __future__ import annotations

from collections.abc import Sequence

from tallyfold.functions.facts import SKILLS, UNIT_SECONDS, WORKPLACE_PARTS
from tallyfold.functions.identity import VIEW_BASE
from tallyfold.functions.rules import PartRule, Rule
from tallyfold.plans import taxonomy as tx
from tallyfold.plans.bindings import (
    BASE_TITLES, CITY_LIST, EMPLOYMENT, PHRASES, PREFIXES, RUN_SPLIT, UNITS, WINDOW_DAYS,
)

W = r"[\p{L}\p{N}_]"
LEFT, RIGHT = r"(?:^|[^\p{L}\p{N}_])", r"(?:$|[^\p{L}\p{N}_])"
BLANK = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_list(values: Sequence[str]) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def word(text: str, phrases: str) -> str:
    return f"regexp_matches({text}, {q(f'{LEFT}(?:{phrases}){RIGHT}')})"


def clean(text: str) -> str:
    return f"trim(regexp_replace(coalesce({text}, ''), {q(BLANK + '+')}, ' ', 'g'))"


def norm(text: str) -> str:
    return f"lower({clean(text)})"


def rule_sql(text: str, rule: Rule | PartRule) -> str:
    if isinstance(rule, PartRule):
        cond = "(" + " OR ".join(f"contains({text}, {q(p)})" for p in rule.parts) + ")"
        for p in rule.also:
            cond += f" AND contains({text}, {q(p)})"
        for p in rule.but:
            cond += f" AND NOT contains({text}, {q(p)})"
        return cond
    forms = []
    if rule.words:
        forms.append(f"{LEFT}(?:{rule.words}){RIGHT}")
    if rule.stems:
        forms.append(f"{LEFT}(?:{rule.stems})")
    if rule.inner:
        forms.append(f"{W}(?:{rule.inner}){RIGHT}")
    if rule.outer:
        forms.append(f"{LEFT}(?:{rule.outer}){W}")
    return " OR ".join(f"regexp_matches({text}, {q(f)})" for f in forms)


def case_sql(text: str, rules, default: str, attr: str = "label") -> str:
    whens = " ".join(
        f"WHEN {rule_sql(text, r)} THEN {q(getattr(r, attr))}" for r in rules
    )
    return f"CASE {whens} ELSE {q(default)} END"


def role_sql(title: str, attr: str = "label") -> str:
    return case_sql(title, tx.ROLE_RULES, tx.DEFAULT_ROLE[0 if attr == "label" else 1], attr)


def seniority_sql(title: str, family: str, attr: str = "label") -> str:
    i = 0 if attr == "label" else 1
    first = " ".join(
        f"WHEN {rule_sql(title, r)} THEN {q(getattr(r, attr))}" for r in tx.SENIORITY_FIRST
    )
    then = " ".join(
        f"WHEN {rule_sql(title, r)} THEN {q(getattr(r, attr))}" for r in tx.SENIORITY_THEN
    )
    return (
        f"CASE {first} WHEN {family} = 'Executive' THEN {q(tx.SENIORITY_EXECUTIVE[i])} {then}"
        f" ELSE {q(tx.DEFAULT_SENIORITY[i])} END"
    )


def in_list(column: str, values: Sequence[str]) -> str:
    return f"{column} IN ({', '.join(q(v) for v in values)})"


def track_sql(title: str, family: str, seniority: str) -> str:
    return (
        f"CASE WHEN {family} = 'Executive' OR {seniority} = 'Executive' THEN 'Executive'"
        f" WHEN {in_list(family, tx.MANAGER_FAMILIES)} OR {in_list(seniority, tx.MANAGER_LEVELS)}"
        " THEN 'Manager'"
        f" WHEN ({in_list(family, tx.NON_TECHNICAL_BY_WORD)}"
        f" AND {word(title, tx.NON_TECHNICAL_WORDS)})"
        f" OR {in_list(family, tx.NON_TECHNICAL_FAMILIES)} THEN 'Non-technical' ELSE 'IC' END"
    )


def workplace_sql(text: str, attr: str = "label") -> str:
    return case_sql(
        norm(text), tx.WORKPLACE_RULES, tx.DEFAULT_WORKPLACE[0 if attr == "label" else 1], attr
    )


def infer_sql(text: str) -> str:
    whens = " ".join(
        "WHEN " + " OR ".join(f"contains(lower({text}), {q(p)})" for p in parts) + f" THEN {q(name)}"
        for name, parts in WORKPLACE_PARTS
    )
    return f"CASE {whens} ELSE 'Unknown' END"


def posted_sql(text: str, now: str) -> str:
    wording = f"regexp_replace(lower({text}), 'reposted|posted', '', 'g')"
    ago = f"([0-9]+){BLANK}*(minute|hour|day|week|month)s?{BLANK}*ago"
    unit = f"regexp_extract({wording}, {q(ago)}, 2)"
    size = " ".join(f"WHEN {q(u)} THEN {s}" for u, s in UNIT_SECONDS.items())
    amount = f"TRY_CAST(regexp_extract({wording}, {q(ago)}, 1) AS BIGINT)"
    age = f"TRY({amount} * CASE {unit} {size} END)"
    return (
        f"CASE WHEN {text} IS NULL OR {text} = '' THEN NULL"
        f" WHEN contains({wording}, 'just now') OR contains({wording}, 'today') THEN {now}"
        f" WHEN {age} <= date_diff('second', TIMESTAMP '0001-01-01', {now})"
        f" THEN {now} - to_seconds({age}) END"
    )


AMOUNT = r"([0-9]{2,3}(?:\.[0-9]+)?)"
SALARY = (
    rf"\$?{BLANK}*{AMOUNT}{BLANK}*(k|000)?{BLANK}*(?:-|to|–){BLANK}*\$?{BLANK}*{AMOUNT}"
    rf"{BLANK}*(k|000)?"
)


def salary_sql(text: str, group: int) -> str:
    return (
        f"TRY_CAST(regexp_extract(replace(coalesce({text}, ''), ',', ''), {q(SALARY)}, {group}, 'i')"
        " AS DOUBLE) * 1000.0::DOUBLE"
    )


def skills_sql(text: str) -> str:
    """Term by term, so that neighbouring hits cannot hide each other."""
    terms = ", ".join(f"CASE WHEN {word(f'lower({text})', s)} THEN {q(s)} END" for s in SKILLS)
    return f"list_sort(list_filter([{terms}], lambda x: x IS NOT NULL))"


def score_sql(base: float, *parts: tuple[str, float]) -> str:
    terms = " + ".join(
        f"CASE WHEN {cond} THEN {gain}::DOUBLE ELSE 0.0::DOUBLE END" for cond, gain in parts
    )
    return f"least({base}::DOUBLE + {terms}, 1.0::DOUBLE)"


def present(c: str) -> str:
    return f"({c} IS NOT NULL AND {c} <> '')"


def iw(weight: str) -> str:
    return (
        f"(1.0::DOUBLE / greatest(CASE WHEN {weight} IS NULL OR {weight} = 0 THEN 1.0::DOUBLE"
        f" ELSE {weight} END, 1e-9::DOUBLE))"
    )


def nth(values: Sequence[str], index: str) -> str:
    return f"{sql_list(values)}[({index}) + 1]"


def title_sql(key: str) -> str:
    prefix = nth(PREFIXES, f"{key} % {len(PREFIXES)}")
    base = nth(BASE_TITLES, f"({key} * 7) % {len(BASE_TITLES)}")
    return f"{prefix} || {base}"


def hash32(*parts: str) -> str:
    joined = " || ':' || ".join(f"({p})::VARCHAR" for p in parts)
    return f"('0x' || substr(md5({joined}), 1, 8))::BIGINT"


MISSING = "({c} IS NULL OR trim({c}) = '')"

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "v_titles": ((), f"""
        SELECT c_custkey AS title_id, {title_sql('c_custkey')} AS title, c_nationkey,
               c_mktsegment, c_acctbal
        FROM customer"""),
    "v_raw": ((), f"""
        SELECT *, json_extract_string(props, '$.k')::INT AS k,
               CASE WHEN ts < TIMESTAMP '{RUN_SPLIT}' THEN 'run_a' ELSE 'run_b' END AS run_id
        FROM events"""),
    "v_listings": (("v_raw",), f"""
        SELECT *, {posted_sql('posted_text', 'scraped_at')} AS posted_at FROM (
        SELECT event_id::VARCHAR AS snapshot_id, run_id,
               run_id || '-' || event_type || '-' || (k % 7)::VARCHAR AS query_id,
               user_id::VARCHAR AS job_id,
               '{VIEW_BASE}' || user_id::VARCHAR || '/' AS url,
               {title_sql('user_id')} AS title,
               CASE WHEN k % 20 = 0 THEN NULL WHEN k % 20 = 1 THEN '' WHEN k % 20 = 2 THEN 'N/A'
                    ELSE 'Company ' || (user_id % 40)::VARCHAR END AS company,
               CASE WHEN k % 50 = 3 THEN NULL WHEN k % 50 = 4 THEN 'N/A'
                    ELSE 'City ' || event_type END AS location,
               CASE WHEN k = 13 THEN 'Just now' WHEN k = 14 THEN '30+ days ago'
                    WHEN k = 15 THEN NULL WHEN k = 16 THEN ''
                    ELSE (CASE WHEN k % 10 = 7 THEN 'Reposted ' ELSE '' END)
                         || CASE WHEN k = 17 THEN (100000 + event_id % 900000)::VARCHAR
                                 WHEN k = 18 THEN '12345678901234567' ELSE (k % 30 + 1)::VARCHAR END || ' ' || {nth(UNITS, f'k % {len(UNITS)}')}
                         || 's ago' END AS posted_text,
               (k // 25 + 1)::INT AS page, (k % 25 + 1)::INT AS rank,
               0.65::DOUBLE + 0.05::DOUBLE * (event_id % 8) AS parser_confidence,
               ts AS scraped_at, event_id, event_type, user_id, k
        FROM v_raw)"""),
    "v_frame": (("v_listings",), f"""
        SELECT query_id, run_id, event_type AS city_key, 'City ' || event_type AS city_name,
               'Place, ' || event_type AS location, 'kw' || k7 AS keyword,
               'family' || (k7 % 2) AS role_family_key, 'level' || (k7 % 3) AS experience_key,
               'f_E=' || (k7 % 3) AS experience_param, {WINDOW_DAYS} AS time_window_days,
               CASE WHEN k7 = 5 THEN 0.0::DOUBLE WHEN k7 = 6 THEN NULL
                    ELSE length(event_type)::DOUBLE * (k7 + 1) / 100.0::DOUBLE END AS target_weight,
               'https://jobs.example.com/q/' || query_id AS url,
               CASE k7 WHEN 0 THEN 'pending' WHEN 1 THEN 'failed' WHEN 2 THEN NULL
                    ELSE 'complete' END AS status,
               CASE k7 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE n END AS result_count,
               CASE k7 WHEN 0 THEN 0 ELSE last_page END AS pages_collected,
               CASE WHEN k7 = 1 THEN 'timeout ' || event_type END AS last_error
        FROM (SELECT run_id, query_id, event_type, k % 7 AS k7, count(*)::INT AS n,
                     max(page) AS last_page
              FROM v_listings GROUP BY ALL)"""),
    "v_docs": ((), f"""
        SELECT CASE WHEN lang IN ('en', 'fr') THEN 'run_a' ELSE 'run_b' END AS run_id,
               doc_id::VARCHAR AS job_id, '{VIEW_BASE}' || doc_id::VARCHAR || '/' AS url,
               text || {nth(PHRASES, f'doc_id % {len(PHRASES)}')} AS description,
               {nth(EMPLOYMENT, f'doc_id % {len(EMPLOYMENT)}')} AS employment_type,
               (doc_id % 200)::VARCHAR || ' applicants' AS applicants_signal,
               doc_id, lang, source
        FROM documents"""),
    "v_details": (("v_docs",), f"""
        SELECT *, {infer_sql('description')} AS workplace_type,
               {salary_sql('description', 1)} AS salary_min,
               {salary_sql('description', 3)} AS salary_max,
               CASE WHEN {salary_sql('description', 1)} IS NOT NULL THEN 'USD' END
                   AS salary_currency
        FROM v_docs"""),
    "v_runs": (("v_listings",), """
        SELECT run_id, min(scraped_at) AS started_at FROM v_listings GROUP BY 1
        UNION ALL SELECT 'run_empty', min(scraped_at) FROM v_listings"""),
    "v_best": (("v_listings",), """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY run_id, job_id
                ORDER BY parser_confidence DESC, scraped_at DESC, page, rank, snapshot_id) AS rn
            FROM v_listings) WHERE rn = 1"""),
    "v_labelled": (("v_best", "v_details"), f"""
        SELECT *, {seniority_sql('t', 'role_family')} AS seniority,
               {seniority_sql('t', 'role_family', 'reason')} AS seniority_reason,
               {workplace_sql('place')} AS workplace,
               {workplace_sql('place', 'reason')} AS workplace_reason
        FROM (SELECT b.*, {norm('b.title')} AS t, {role_sql(norm('b.title'))} AS role_family,
                     {role_sql(norm('b.title'), 'reason')} AS role_reason,
                     CASE WHEN d.workplace_type IS NOT NULL AND d.workplace_type <> ''
                          THEN d.workplace_type
                          ELSE trim({norm('b.title')} || ' ' || {norm('d.description')}) END AS place
              FROM v_best b LEFT JOIN v_details d USING (run_id, job_id))"""),
    "v_class": (("v_labelled",), f"""
        SELECT run_id, job_id, role_family, seniority,
               {track_sql('t', 'role_family', 'seniority')} AS track, workplace,
               least({tx.CONFIDENCE_BASE}::DOUBLE
                 + CASE WHEN role_family <> 'Other' THEN {tx.CONFIDENCE_ROLE}::DOUBLE ELSE 0.0 END
                 + CASE WHEN seniority <> 'Mid' THEN {tx.CONFIDENCE_SENIORITY}::DOUBLE ELSE 0.0 END
                 + CASE WHEN workplace <> 'Unknown' THEN {tx.CONFIDENCE_WORKPLACE}::DOUBLE
                        ELSE 0.0 END, {tx.CONFIDENCE_CAP}::DOUBLE) AS confidence,
               role_reason || '; ' || seniority_reason || '; ' || workplace_reason AS reasons
        FROM v_labelled"""),
    "v_jobs": (("v_best", "v_frame", "v_class"), """
        SELECT b.run_id, b.job_id, b.query_id, b.title, b.company, b.location, f.city_name,
               f.target_weight, c.role_family, c.seniority, c.track, c.workplace, c.confidence
        FROM v_best b LEFT JOIN (SELECT query_id, city_name, target_weight FROM v_frame) f
             USING (query_id)
        LEFT JOIN v_class c ON c.run_id = b.run_id AND c.job_id = b.job_id"""),
    "v_cities": ((), "SELECT * FROM (VALUES " + ", ".join(
        f"({i}, {q(k)}, {q(n)})" for i, (k, n) in enumerate(CITY_LIST)
    ) + ") t(ord, city_key, city_name)"),
    "v_coverage": (("v_frame", "v_listings"), """
        SELECT f.run_id, f.city_key, count(DISTINCT l.job_id) AS jobs
        FROM v_frame f LEFT JOIN v_listings l USING (query_id) GROUP BY 1, 2"""),
    "v_expected": (("v_runs", "v_cities", "v_coverage"), """
        SELECT r.run_id, c.ord, c.city_key, c.city_name, coalesce(v.jobs, 0)::BIGINT AS jobs
        FROM v_runs r CROSS JOIN v_cities c LEFT JOIN v_coverage v
             ON v.run_id = r.run_id AND v.city_key = c.city_key"""),
    "v_metrics": (("v_runs", "v_listings", "v_frame", "v_class"), f"""
        SELECT r.run_id, coalesce(l.raw, 0) AS raw, coalesce(l.jobs, 0) AS jobs,
               coalesce(l.m_title, 0) AS m_title, coalesce(l.m_company, 0) AS m_company,
               coalesce(l.m_location, 0) AS m_location, coalesce(l.m_url, 0) AS m_url,
               coalesce(l.late, 0) AS late, coalesce(f.zero_q, 0) AS zero_q,
               coalesce(f.all_q, 0) AS all_q, coalesce(c.n, 0) AS classified,
               coalesce(c.exec, 0) AS exec, coalesce(c.pp, 0) AS pp, coalesce(c.other, 0) AS other
        FROM v_runs r
        LEFT JOIN (SELECT run_id, count(*) AS raw, count(DISTINCT job_id) AS jobs,
                     count(*) FILTER ({MISSING.format(c='title')}) AS m_title,
                     count(*) FILTER ({MISSING.format(c='company')}) AS m_company,
                     count(*) FILTER ({MISSING.format(c='location')}) AS m_location,
                     count(*) FILTER ({MISSING.format(c='url')}) AS m_url,
                     count(*) FILTER (posted_at IS NOT NULL
                         AND posted_at < scraped_at - INTERVAL 1 DAY * {WINDOW_DAYS + 1}) AS late
                   FROM v_listings GROUP BY 1) l ON l.run_id = r.run_id
        LEFT JOIN (SELECT run_id, count(*) FILTER (coalesce(result_count, 0) = 0) AS zero_q,
                     count(*) AS all_q FROM v_frame GROUP BY 1) f ON f.run_id = r.run_id
        LEFT JOIN (SELECT run_id, count(*) AS n,
                     count(*) FILTER (role_family = 'Executive') AS exec,
                     count(*) FILTER (role_family IN ('Product', 'Program')) AS pp,
                     count(*) FILTER (role_family = 'Other') AS other
                   FROM v_class GROUP BY 1) c ON c.run_id = r.run_id"""),
    "v_fired": (("v_metrics", "v_expected"), """
        SELECT run_id, 1 AS o, 0 AS s, 'listing_snapshots' AS scope, 'error' AS severity,
               'no_listings' AS code, 'This run holds no listings at all.' AS message, '{}' AS details
        FROM v_metrics WHERE raw = 0""" + "".join(f"""
        UNION ALL SELECT run_id, {i}, 0, 'listing_snapshots', 'warning', 'high_null_{f}',
               printf('%.1f', m_{f} / raw * 100.0::DOUBLE) || '% of the listings lack a value in {f}.',
               '{{"missing":"' || m_{f} || '","total":"' || raw || '"}}'
        FROM v_metrics WHERE raw > 0 AND m_{f} / raw > 0.05::DOUBLE"""
        for i, f in enumerate(("title", "company", "location", "url"), start=2)) + """
        UNION ALL SELECT run_id, 6, 0, 'listing_snapshots', 'info', 'discovery_overlap_deduped',
               'Several searches led to the same job; it is counted once.',
               '{"canonical_jobs":"' || jobs || '","duplicate_discovery_paths":"' || (raw - jobs)
               || '","raw_snapshots":"' || raw || '"}'
        FROM v_metrics WHERE jobs > 0 AND jobs < raw
        UNION ALL SELECT run_id, 7, ord, 'search_queries', 'warning', 'low_city_sample',
               'Sample below 25 jobs in ' || city_name,
               '{"city_key":"' || city_key || '","jobs":"' || jobs || '"}'
        FROM v_expected WHERE jobs < 25
        UNION ALL SELECT run_id, 8, 0, 'search_queries', 'warning', 'many_zero_result_queries',
               'Empty searches exceed 25%.',
               '{"query_count":"' || all_q || '","zero_queries":"' || zero_q || '"}'
        FROM v_metrics WHERE all_q > 0 AND zero_q / all_q > 0.25::DOUBLE
        UNION ALL SELECT run_id, 9, 0, 'classifications', 'warning', 'no_classifications',
               'Nothing has been labelled yet.', '{}'
        FROM v_metrics WHERE classified = 0
        UNION ALL SELECT run_id, 10, 0, 'classifications', 'warning', 'executive_share_spike',
               'Executives exceed 12% of the labels.',
               '{"executive":"' || exec || '","total":"' || classified || '"}'
        FROM v_metrics WHERE classified > 0 AND exec / classified > 0.12::DOUBLE
        UNION ALL SELECT run_id, 11, 0, 'classifications', 'warning', 'missing_product_program',
               'Labels of the product and program families are absent: check searches and rules.', '{}'
        FROM v_metrics WHERE classified > 0 AND pp = 0
        UNION ALL SELECT run_id, 12, 0, 'classifications', 'warning', 'high_other_share',
               'Unassigned roles exceed 12% of the labels.',
               '{"other":"' || other || '","total":"' || classified || '"}'
        FROM v_metrics WHERE classified > 0 AND other / classified > 0.12::DOUBLE
        UNION ALL SELECT run_id, 13, 0, 'listing_snapshots', 'warning', 'date_window_violations',
               'Listings older than the window are present.',
               '{"violations":"' || late || '"}'
        FROM v_metrics WHERE late > 0"""),
    "v_issues": (("v_fired",), """
        SELECT run_id || ':' || lpad(row_number() OVER (PARTITION BY run_id ORDER BY o, s)::VARCHAR,
                 4, '0') || ':' || code AS issue_id, run_id, scope, severity, code, message, details
        FROM v_fired"""),
    "v_legacy": (("v_best",), f"""
        SELECT run_id, job_id, query_id, title, company, event_type AS region,
               {case_sql('lower(title)', tx.LEGACY_ROLE_TYPES, 'Other')} AS role_type,
               {case_sql('lower(title)', tx.LEGACY_SENIORITY, 'Other')} AS seniority,
               {case_sql('lower(title)', tx.LEGACY_CATEGORIES_LONG, 'Uncategorized')} AS category,
               {case_sql('lower(title)', tx.LEGACY_SENIORITY_SHORT, 'Mid-Level')} AS level
        FROM v_best"""),
}


def using(names: Sequence[str] | str, body: str) -> str:
    """Query with the CTEs it needs, dependencies first."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for need in VIEWS[name][0]:
            add(need)
        if name not in wanted:
            wanted.append(name)

    for name in [names] if isinstance(names, str) else names:
        add(name)
    ctes = ",\n".join(f"{n} AS ({VIEWS[n][1]})" for n in wanted)
    return f"WITH {ctes}\n{body}" if wanted else body
