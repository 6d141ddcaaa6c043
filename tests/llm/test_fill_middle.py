import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyfold.llm import fill_middle as fim

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
TEXTS = st.text(st.sampled_from("ab é中\t\n\x0b\x1c <PSM>\U0001f600"), max_size=120)


def brute(doc_id, text, plan=fim.Plan()):
    text = text or ""
    h = hashlib.sha256(f"{plan.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    units = UNITS.findall(text)
    if not text or h3 % 100 >= plan.rate or any(x in text for x in (plan.prefix, plan.suffix, plan.middle)):
        return len(units), "plain", None, None, text
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < plan.suffix_first:
        return len(units), "spm", len(p), len(m), f"{plan.suffix}{s}{plan.prefix}{p}{plan.middle}{m}"
    return len(units), "psm", len(p), len(m), f"{plan.prefix}{p}{plan.suffix}{s}{plan.middle}{m}"


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXTS, max_size=6), st.integers(1, 4))
def test_chunk_counts_give_every_cut(texts, bits):
    memory = fim.Memory(limit=64)  # forgets all the time
    for _ in range(2):
        chunked = fim.Chunked([t.encode() for t in texts], memory, bits)
        for i, text in enumerate(texts):
            units = UNITS.findall(text)
            assert chunked.units[i] == len(units)
            for k in range(len(units) + 1):
                lead = "".join(units[:k])
                assert chunked.cut(i, k) == (len(lead.encode()), len(lead))


def test_equal_passages_fall_into_equal_chunks():
    passage = (" ".join(f"w{i * i % 997}" for i in range(900))).encode()
    one, two = b"some lead " + passage, b"another and longer lead, " * 9 + passage + b" tail"
    parts = []
    for text in (one, two):
        c = fim.Chunked([text], fim.Memory())
        parts.append({text[a:b] for a, b in zip(c.start, c.stop)})
    shared = parts[0] & parts[1]
    assert sum(map(len, shared)) > 0.7 * len(passage)


def test_memory_is_bounded_and_reused():
    memory = fim.Memory(limit=1000)
    for i in range(50):
        memory([f"{i} {k} some words".encode() for k in range(20)])
        assert sum(map(len, [*memory.known, *memory.older])) < 4000
    memory([b"again"])
    assert b"again" in memory.known


@pytest.mark.parametrize("plan", [fim.Plan(), fim.Plan(rate=100, suffix_first=50, seed=7), fim.Plan("<|pre|>", "<|suf|>", "<|mid|>", 90)])
def test_odd_rows(spark, odd_docs, no_docs, plan):
    docs = odd_docs.union(odd_docs.selectExpr("doc_id + 100", "concat(text, '\n', text, ' <', 'P')", *odd_docs.columns[2:]))
    out = fim.fill_in_middle(docs, plan)
    back = out.withColumn("back", fim.restored(F.col("output"), F.col("form"), plan))
    rows = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in back.collect()]
    want = [(r.doc_id, *brute(r.doc_id, r.text, plan), r.text or "") for r in docs.collect()]
    assert sorted(map(repr, rows)) == sorted(map(repr, want))
    assert fim.fill_in_middle(no_docs, plan).count() == 0


def test_invalid_bytes_survive(spark):
    docs = spark.range(40).selectExpr("id AS doc_id", "CAST(concat(X'61FF2062E4', encode(concat(' word ', id), 'utf-8')) AS STRING) AS text")
    out = fim.fill_in_middle(docs, fim.Plan(rate=100, suffix_first=0)).selectExpr("doc_id", "hex(CAST(output AS BINARY)) AS o").collect()
    texts = {r.doc_id: r.t for r in docs.selectExpr("doc_id", "hex(CAST(text AS BINARY)) AS t").collect()}
    marks = "|".join(m.encode().hex().upper() for m in ("<P>", "<S>", "<M>"))
    for r in out:
        p, s, m = re.split(marks, r.o)[1:]
        assert p + m + s == texts[r.doc_id]


def test_marks_never_join_their_neighbours(spark):
    rows = [(i, t) for i, t in enumerate(["<", "a <", "< P> <P", "<S <M <", "P> x", "S> M> P>"] * 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = fim.digests(docs, fim.Plan(rate=100))
    want = {i: hashlib.sha256(t.encode()).hexdigest() for i, t in rows}
    assert {r.doc_id: r.restored_sha256 for r in out.collect()} == want
