import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyfold.llm import rules

WORD = re.compile("[^\x20\x09-\x0d]+")
PARTS = st.sampled_from(["a", "b", "c", " ", "  ", "\n", "é", "#", "<x>", "\x1c", "\x85", "\t", "a b c d e f g h ", "line\n"])


def brute(text):
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        dup += bool(WORD.search(line)) and line in seen
        seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    count, mark = Counter(windows), [False] * len(words)
    for i, w in enumerate(windows):
        if count[w] > 1:
            mark[i : i + 8] = [True] * 8
    return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), dup, sum(mark)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(PARTS, max_size=40).map("".join), max_size=6))
def test_counts_do_not_depend_on_the_slice(texts):
    got = list(zip(*(c.tolist() for c in rules.base_counts([t.encode() for t in texts]))))
    assert got == [brute(t) for t in texts]
    weights = np.random.default_rng(0).random((3, 1 << rules.BITS))
    whole = rules.raw_score([t.encode() for t in texts], weights)
    assert np.allclose(whole, [rules.raw_score([t.encode()], weights)[0] for t in texts])


def test_documents_and_kept(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = rules.quality_model(docs, labels)
    rows = {r.doc_id: r for r in rules.quality_rules(docs, model).collect()}
    for d in docs.collect():
        r = rows[d.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(d.text or "")
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (not r.base_failed and r.quality >= rules.MIN_QUALITY)
    clean = [rows[x.doc_id] for x in labels.where("quality = 1").collect()]
    assert sum(r.kept for r in clean) >= 0.95 * sum(not r.base_failed for r in clean)


def test_odd_rows(odd_docs, no_docs, no_labels):
    model = rules.quality_model(odd_docs, no_labels)
    rows = rules.quality_rules(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and [r.doc_id for r in rows if r.kept] == [4]
    assert rules.quality_rules(no_docs, model).count() == 0
