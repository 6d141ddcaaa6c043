import random

import pytest

from tallyfold.llm import overlap
from tallyfold.llm.graphs import components


def brute(docs, width=4, percent=85):
    """doc_id -> (set size, smallest id reachable) over rows (doc_id, text) with distinct ids."""
    sets = {}
    for i, text in docs:
        w = (text or "").encode().lower().split()
        grams = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()
        sets[i] = grams
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def group(rng, size, words, edits, start, shared=()):
    """Near copies of one text: each with up to `edits` words replaced by its own."""
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for i in range(size):
        text = [*base, *shared]
        for _ in range(rng.randrange(edits + 1)):
            text[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        out.append((start + i, " ".join(text)))
    return out


@pytest.mark.parametrize("seed, short, block", [(1, 40, 64), (2, 4, 3), (3, 2, 8)])
def test_components_are_those_of_all_pairs(spark, monkeypatch, seed, short, block):
    """With small limits the long-list path carries most of the links."""
    monkeypatch.setattr(overlap, "SHORT", short)
    monkeypatch.setattr(overlap, "BLOCK", block)
    rng = random.Random(seed)
    passage = [f"p{k}" for k in range(50)]
    docs = [(i, " ".join(f"r{rng.randrange(400)}" for _ in range(rng.randrange(1, 60)))) for i in range(60)]
    docs += group(rng, 45, 80, 4, 100) + group(rng, 12, 30, 3, 200) + group(rng, 25, 120, 6, 300, passage)
    docs += [(400 + i, " ".join([*passage, *(f"t{rng.randrange(10**6)}" for _ in range(rng.randrange(14)))])) for i in range(40)]
    docs += [(500 + i, docs[70 + i][1].upper()) for i in range(10)]
    rng.shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in overlap.linked_documents(df).collect()}
    assert found == brute(docs)
    kept = {r.doc_id for r in overlap.keep_one(df).collect()}
    assert kept == {c for _, c in found.values()}


def test_odd_rows(odd_docs, no_docs):
    rows = overlap.linked_documents(odd_docs).collect()
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in rows)
    assert got == [
        (0, 0, 0), (0, 4, 0), (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 59_997, 4), (5, 1, 5), (6, 4, 6), (7, 4, 6), (7, 4, 6), (8, 1, 8),
    ]
    kept = overlap.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 2
    assert overlap.linked_documents(no_docs).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in found} == {k: 0 for k in range(1, 41)} | {k: 100 for k in range(101, 140)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
