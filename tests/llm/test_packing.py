import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyfold.llm import packing

PARTS = ["a", "B", "'s", "don't", "It's,", "x.", "é", "ß", "İ", "́", " ", " ", "…", "!?", "12.5", "<|endoftext|>",
         "<|ENDOFTEXT|>", "\x1c", "\x85", "中", "文,", "Σ", "σς", "***,", " ", "\n", "\t", "word"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=25).map("".join))
def test_chunks_encode_like_whole_texts(text):
    encoder = ENCODER
    assert encoder.encode([text.encode()])[0].tolist() == encoder.tokenizer.encode(
        text, add_special_tokens=False
    ).ids


@settings(max_examples=50, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*PARTS, "|", "a|", "~"]), max_size=9).map("".join), max_size=6))
def test_slices_encode_like_whole_texts(texts):
    got = ENCODER.encode([t.encode() for t in texts])
    assert [g.tolist() for g in got] == [ENCODER.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_forgotten_words_are_tokenized_again(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 100)
    encoder = packing.Encoder(packing.default_tokenizer())
    for k in range(20):
        texts = [f"word{i} x{i * k} |{i} é{k}" for i in range(40)]
        want = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert [g.tolist() for g in encoder.encode([t.encode() for t in texts])] == want
        assert len(encoder.keys) <= 50 + 41 * 4 and encoder.used <= len(encoder.ids) < 20_000


def test_invalid_bytes_are_replacement_characters():
    got = ENCODER.encode([b"a \xff\xfeb c", b"fine"])
    assert got[0].tolist() == ENCODER.tokenizer.encode("a \ufffd\ufffdb c", add_special_tokens=False).ids
    assert got[1].tolist() == ENCODER.tokenizer.encode("fine", add_special_tokens=False).ids


ENCODER = packing.Encoder(packing.default_tokenizer())


def optimum(items, capacity):
    """Fewest rows by exhaustive search."""
    best = len(items)

    def go(i, rows):
        nonlocal best
        if len(rows) >= best:
            return
        if i == len(items):
            best = len(rows)
            return
        for k in range(len(rows)):
            if rows[k] + items[i] <= capacity:
                rows[k] += items[i]
                go(i + 1, rows)
                rows[k] -= items[i]
        go(i + 1, [*rows, items[i]])

    go(0, [])
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=9))
def test_search_is_as_good_as_exhaustive(items):
    counts = np.bincount(items, minlength=21)
    runs = packing.bin_completion(counts, 20)
    used = np.zeros(21, np.int64)
    for run in runs:
        assert sum(n * m for n, m in run.filling) <= 20
        for n, m in run.filling:
            used[n] += m * run.copies
    assert used.tolist() == counts.tolist()
    assert sum(r.copies for r in runs) == optimum(sorted(items, reverse=True), 20)


def check(rows, capacity):
    by_row = defaultdict(list)
    for r in rows:
        by_row[r.sequence_id].append((r.offset, r.length))
    for parts in by_row.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_row)


def test_query_against_plain_encoding(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = packing.pack(docs).collect()
    tokenizer, expected = Tokenizer.from_file(packing.default_tokenizer()), {}
    for doc in docs.collect():
        ids = np.array([*tokenizer.encode(doc.text or "", add_special_tokens=False).ids, 0], "<u4")
        for k, a in enumerate(range(0, len(ids), 2048)):
            part = ids[a : a + 2048]
            expected[doc.doc_id, k] = (a, len(part), zlib.crc32(part.tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == expected and len(rows) == len(expected)
    assert check(rows, 2048) == -(-sum(r.length for r in rows) // 2048)


def test_odd_rows(odd_docs, no_docs):
    rows = packing.pack(odd_docs, capacity=512).collect()
    check(rows, 512)
    assert sum(r.piece == 0 for r in rows) == odd_docs.count()
    assert {r.length for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert packing.pack(no_docs).count() == 0
