"""Content-addressed web archive.

Every page is a WARC record: exact header bytes and a payload. Payload bytes are stored once, under
their SHA-256 digest, and headers are stored separately with the digest they point to; original
records come back by joining the two. Reading recomputes the digest of every payload it joins, so a
damaged one is an error rather than a wrong record.

Digest groups are reduced map-side, to their smallest page id and to one copy of the payload, so a
payload that a third of the pages share costs one row per task. Payloads are deflated one by one, as is
usual for such archives, before they are shuffled and stored.
"""

from __future__ import annotations

import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.session import scratch_path

MIN_REVISIT_BYTES = 100
CRLF = "\r\n"


def deflated(payload: str) -> Column:
    @F.pandas_udf("binary")
    def run(values: pd.Series) -> pd.Series:
        return values.map(zlib.compress)

    return run(F.col(payload))


def inflated(packed: str) -> Column:
    @F.pandas_udf("binary")
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda x: None if x is None else zlib.decompress(x))

    return run(F.col(packed))


def digested(pages: DataFrame) -> DataFrame:
    """page_id, url, payload (UTF-8 bytes, null as empty), payload_digest, payload_bytes."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    return pages.select(
        "page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("payload_digest"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
    )


# Fixed value: the profile of revisits that have no block because the payload is known.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def header(date: str) -> Column:
    """WARC header up to and with the empty line; line breaks in a url are percent-encoded.

    Record ids are unique even where page ids are null or repeat, so page ids have fields of their own.
    """
    def line(name: str, value: Column | str) -> Column:
        return F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value, F.lit(CRLF))

    def uri(column: str) -> Column:
        url = F.coalesce(F.col(column), F.lit(""))
        return F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))

    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    revisit = F.col("record_type") == "revisit"
    block = F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes")).cast("string")
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), F.expr("uuid()"), F.lit(">"))),
        line("WARC-Page-ID", page),
        F.when(revisit, F.concat(
            line("WARC-Profile", PROFILE),
            line("WARC-Refers-To-Target-URI", uri("first_url")),
            line("WARC-Refers-To-Date", date),
            line("WARC-Refers-To-Page-ID", F.col("refers_to").cast("string")),
        )).otherwise(""),
        line("WARC-Target-URI", uri("url")),
        line("WARC-Date", date),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        line("Content-Type", "text/html; charset=utf-8"),
        line("Content-Length", block),
        F.lit(CRLF),
    ).cast("binary")


def write_archive(pages: DataFrame, path: str, date: str = "2026-01-01T00:00:00Z") -> None:
    """Writes `path`/payloads (digest, deflated payload; one row each) and `path`/headers (page_id,
    header, digest).

    Null html: empty payload. Of equal payloads of at least 100 bytes the smallest page_id is the
    response and others are revisits; rows repeated with that same page_id are responses as well.
    Null page ids are never referred to unless no other has the payload. Other columns are ignored.
    """
    rows = digested(pages)
    first = rows.groupBy("payload_digest").agg(
        F.min("page_id").alias("first_id"), F.min_by("url", "page_id").alias("first_url")
    )
    found = rows.drop("payload").join(first, "payload_digest")
    revisit = (F.col("payload_bytes") >= MIN_REVISIT_BYTES) & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    headers = found.select(
        "*",
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"),
    ).select("page_id", header(date).alias("header"), F.col("payload_digest").alias("digest"))
    headers.write.option("compression", "zstd").parquet(f"{path}/headers")
    # Copies within a task meet before the shuffle; any of the equal payloads will do.
    packed = rows.select(F.col("payload_digest").alias("digest"), deflated("payload").alias("packed"))
    payloads = packed.groupBy("digest").agg(F.any_value("packed").alias("packed"))
    payloads.write.parquet(f"{path}/payloads")


def read_records(spark, path: str) -> DataFrame:
    """Original records: page_id, header, payload, record (its exact bytes: header, block, closing lines).

    The block of a response is its payload. A revisit has none, as its header says; its payload, that
    of the record it refers to, stands in `payload` all the same. Fails on a payload whose digest is
    not the one it is stored under, and on a missing payload. page_id has the type it was written with.
    """
    headers = spark.read.parquet(f"{path}/headers").select("page_id", "header", "digest")
    payloads = spark.read.schema("digest string, packed binary").parquet(f"{path}/payloads")
    joined = headers.join(payloads, "digest", "left").select(
        "page_id", "header", "digest", inflated("packed").alias("payload")
    )
    # Every record's payload is checked, not only every stored one.
    wrong = F.when(F.col("payload").isNull(), F.lit("missing payload ")).otherwise(F.lit("damaged payload "))
    payload = F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(
        F.raise_error(F.concat(wrong, F.col("digest"))).cast("binary")
    )
    sound = joined.select("page_id", "header", payload.alias("payload"))
    revisit = F.col("header").cast("string").startswith(f"WARC/1.1{CRLF}WARC-Type: revisit{CRLF}")
    block = F.when(revisit, F.lit(b"")).otherwise(F.col("payload"))
    return sound.select("*", F.concat("header", block, F.lit(CRLF * 2).cast("binary")).alias("record"))


def described(records: DataFrame) -> DataFrame:
    """Per record, from its header and payload: page_id, payload_bytes, payload_digest, record_type,
    refers_to, url."""
    text = F.col("header").cast("string")

    def field(name: str) -> Column:
        return F.regexp_extract(text, rf"(?m)^{name}: (.*)$", 1)

    return records.select(
        "page_id",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.regexp_extract(field("WARC-Payload-Digest"), "^sha256:([0-9a-f]{64})$", 1).alias("payload_digest"),
        field("WARC-Type").alias("record_type"),
        F.when(
            field("WARC-Type") == "revisit",
            field("WARC-Refers-To-Page-ID").cast(records.schema["page_id"].dataType),
        ).alias("refers_to"),
        field("WARC-Target-URI").alias("url"),
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """Archive the pages below the shared folder and describe the records read back, one row per page row:
    nulls, repeated rows, very long payloads and empty tables as in `write_archive`."""
    spark = pages.sparkSession
    path = scratch_path(spark, "archive")
    write_archive(pages, path)
    return described(read_records(spark, path))
