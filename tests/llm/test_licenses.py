import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tallyfold.llm import licenses

PARTS = st.sampled_from(["under", "the", "mit", "license", "MIT License", "apache", "version", "2", "cc", "by", "nc", "CC-BY-NC", "é", "by\n", "x"])
LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def brute(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text.translate(LOWER))
    places = [
        (i, label) for phrase, label in licenses.PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()
    ]
    at = [i for i, _ in places]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({n for _, n in places}))


def base(rows):
    return {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows}


@settings(max_examples=3, deadline=None)
@given(st.lists(st.lists(PARTS, max_size=40).map(" ".join), min_size=150, max_size=200))
def test_places_are_those_of_a_full_scan(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert base(licenses.scan(df).collect()) == {i: brute(t) for i, t in enumerate(texts)}


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert base(licenses.scan(docs).collect()) == {r.doc_id: brute(r.text or "") for r in docs.collect()}


def test_notices_with_inserted_and_missing_words(spark):
    words = licenses.NOTICES["bsd"].split()
    changed = [*words[:8], "oh", "well", *words[8:14], *words[15:]]
    df = spark.createDataFrame([(1, "x " * 30 + " ".join(changed)), (2, " ".join(words[:9]))], "doc_id long, text string")
    found = {r.doc_id: r for r in licenses.scan(df).collect()}
    assert found[1].labels == "bsd" and 0.6 <= found[1].score < 1 and found[1].n_base == 0
    assert found[2].labels == "" and found[2].score == 0


def test_words_scattered_over_the_text_are_no_notice(spark):
    """Every 3-gram of the notice in order, each with a filler word behind it: the diagonals drift away."""
    words = licenses.NOTICES["bsd"].split()
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    some = " ".join(words[:8]) + " oh well " + " ".join(words[8:])
    df = spark.createDataFrame([(1, " filler ".join(grams)), (2, some + " and " + " ".join(words))], "doc_id long, text string")
    found = {r.doc_id: r for r in licenses.scan(df).collect()}
    assert found[1].labels == "" and found[1].score == 0
    assert found[2].labels == "bsd" and found[2].score == 1


def test_own_notices(spark):
    own = {"mine": "You may COPY this text as you please but never sell it", "mit": licenses.NOTICES["mit"]}
    df = spark.createDataFrame([(1, "a. you may copy this text, as you please but NEVER sell it"), (2, licenses.NOTICES["bsd"])], "doc_id long, text string")
    assert {r.doc_id: r.labels for r in licenses.scan(df, own).collect()} == {1: "mine", 2: ""}


def test_odd_rows(odd_docs, no_docs):
    rows = licenses.scan(odd_docs).collect()
    assert len(rows) == odd_docs.count() and {r.labels for r in rows} == {""}
    assert licenses.scan(no_docs).count() == 0
