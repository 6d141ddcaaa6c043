"""Identifiers, urls and hashes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyfold.functions.text import col

# Fixed formats of the addressed job board; the hosts themselves are parameters.
SEARCH_BASE = "https://jobs.example.com/jobs/search/"
VIEW_BASE = "https://jobs.example.com/jobs/view/"
ID_PARAMS = ("currentJobId", "jobId")
PAGE_SIZE = 25


def job_id_from_url(url: str | Column) -> Column:
    """Id in the query string, else trailing digits of the view path, else NULL."""
    u = col(url)
    found = [
        F.try_url_decode(
            F.nullif(F.regexp_extract(u, rf"^[^?#]*\?(?:[^#]*?&)?{name}=([^&#]+)", 1), F.lit(""))
        )
        for name in ID_PARAMS
    ]
    by_path = F.regexp_extract(u, r"^[^?#]*/jobs/view/(?:[^?#]*?-)?([0-9]+)/?(?:[?#;]|$)", 1)
    anywhere = F.regexp_extract(u, rf"(?:^|[?&]){ID_PARAMS[0]}=([0-9]+)", 1)
    return F.coalesce(*found, F.nullif(by_path, F.lit("")), F.nullif(anywhere, F.lit("")))


def canonical_url(job_id: str | Column, base: str = VIEW_BASE) -> Column:
    return F.concat(F.lit(base), col(job_id), F.lit("/"))


def quote_plus(value: str | Column) -> Column:
    """Form encoding with `~` kept and `*` escaped, as browsers' peers do it."""
    encoded = F.url_encode(col(value))
    return F.replace(F.replace(encoded, F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def search_url(
    keyword: str | Column,
    location: str | Column,
    window_days: str | Column,
    level_param: str | Column,
    start: Column | None = None,
    base: str = SEARCH_BASE,
) -> Column:
    """Address of one search; `start` is left out when it is 0."""
    parts = [
        F.lit(f"{base}?keywords="), quote_plus(keyword),
        F.lit("&location="), quote_plus(location),
        F.lit("&f_TPR=r"), (col(window_days) * 86400).cast("string"),
        F.lit("&"), col(level_param),
        F.lit("&sortBy=DD"),
    ]
    if start is not None:
        offset = F.concat(F.lit("&start="), start.cast("string"))
        parts.append(F.when(start > 0, offset).otherwise(F.lit("")))
    return F.concat(*parts)


def stable_id(*parts: str | Column) -> Column:
    """Short id that depends on the parts only."""
    joined = F.concat_ws("|", *[col(p) for p in parts])
    return F.concat(F.lit("q_"), F.substring(F.sha1(joined), 1, 12))


def snapshot_id(query_id: Column, page: Column, rank: Column, job_id: Column) -> Column:
    return F.concat_ws(":", query_id, page.cast("string"), rank.cast("string"), job_id)


def content_hash(text: str | Column) -> Column:
    return F.sha2(col(text), 256)


def clean_url(url: str | Column) -> Column:
    return F.substring_index(col(url), "?", 1)


def config_hash(fields: Mapping[str, str | Column]) -> Column:
    """Hash of a configuration document: its JSON without blanks, keys in order, nulls written out.
    Nested values need an order of their own (structs keep theirs)."""
    document = F.struct(*[col(fields[k]).alias(k) for k in sorted(fields)])
    return F.sha2(F.to_json(document, {"ignoreNullFields": "false"}), 256)


def hash32(*parts: str | Column) -> Column:
    """Uniform integer in [0, 2^32) from the parts; the same in every engine with MD5."""
    text = F.concat_ws(":", *[col(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
