"""Registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm import (
    archive, chat, decontaminate, fill_middle, licenses, mixing, overlap, packing, passages, rules, secrets, structure,
    toxicity,
)
from tallyfold.llm.common import stored, table
from tallyfold.llm.labels import remainder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_passage_quality")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), remainder("doc_id", 4) == 2
    model = passages.quality_model(docs, table(spark, sf_dir, "labels"), learn_from=~held_out)
    return passages.quality(docs, model).select(
        "*", held_out.alias("held_out"), (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


@query("op2_ngram_jaccard_join", overlap.oracle())
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.linked_documents(table(spark, sf_dir, "documents"))


OP3_SQL = """
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS payload FROM pages
), d AS (
  SELECT page_id, url, strlen(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM p
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to,
  url
FROM f
"""


@query("op3_warc_archive", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.round_trip(table(spark, sf_dir, "pages"))


@query("op4_decontamination", decontaminate.oracle())
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op5_best_fit_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op6_quality_rules")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return rules.quality_rules(docs, rules.quality_model(docs, table(spark, sf_dir, "labels")))


@query("op7_toxicity")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), remainder("doc_id", 5) == 0
    model = toxicity.toxicity_model(docs, table(spark, sf_dir, "labels"), learn_from=~held_out)
    return toxicity.toxicity(docs, model).select(
        "*", held_out.alias("held_out"), (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query("op8_chat_format")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    formatted = chat.format_turns(turns.unionByName(chat.control_conversation(turns)))
    return chat.read_back(stored(formatted, "chat"))


@query("op9_secret_scan")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


@query("op10_license_scan")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op11_structure_repair")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return structure.repair(structure.damaged(turns), turns)


@query("op12_source_mixing")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.by_source(table(spark, sf_dir, "documents"))


@query("op13_fill_in_middle", fill_middle.oracle())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(table(spark, sf_dir, "documents"))
