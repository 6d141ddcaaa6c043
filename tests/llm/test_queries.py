"""Queries against their SQL, and columns and row counts of the others."""

import pytest

from tallyfold.llm.queries import ORACLES, QUERIES
from tests.compare import compare, connect

COLUMNS = {
    "op1_passage_quality": {"doc_id", "held_out", "score", "predicted"},
    "op6_quality_rules": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    "op7_toxicity": {"doc_id", "held_out", "score", "predicted"},
    "op9_secret_scan": {"doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"},
    "op10_license_scan": {"doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"},
}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, name):
    assert compare(spark, connect(sf_dir), QUERIES[name], ORACLES[name], sf_dir) == []


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_one_row_per_document(spark, sf_dir, name):
    rows = QUERIES[name](spark, sf_dir)
    assert COLUMNS[name] <= set(rows.columns)
    n = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert rows.count() == n == rows.select("doc_id").distinct().count()


def test_every_operator_is_registered():
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
