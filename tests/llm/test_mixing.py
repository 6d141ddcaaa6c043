import itertools
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tallyfold.llm import mixing

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes, weights, total, most=3):
    """In exact numbers, one source after the other."""
    capped, open_ = {}, set(sizes)
    while open_:
        left = total - sum(capped.values())
        share = {s: Fraction(left) * weights[s] / sum(weights[x] for x in open_) for s in open_}
        above = [s for s in open_ if share[s] > most * sizes[s]]
        if not above:
            return {**capped, **share}
        capped[above[0]] = Fraction(most * sizes[above[0]])
        open_.remove(above[0])
    return capped


def cheapest_flow(supplies, quotas, costs):
    """(words, cost) by successive cheapest paths over a plain arc list (Bellman and Ford)."""
    arcs = []

    def add(a, b, room, cost):
        arcs.append([a, b, room, cost])
        arcs.append([b, a, 0, -cost])

    for p, n in supplies.items():
        for c in costs:
            add("S", ("p", p), n, c)
        for s in p:
            if s in quotas:
                add(("p", p), ("s", s), 10**9, 0)
    for s, n in quotas.items():
        add(("s", s), "T", n, 0)
    words = cost = 0
    while True:
        best, via = {"S": 0}, {}
        for _ in range(len(arcs)):
            changed = False
            for i, (a, b, room, c) in enumerate(arcs):
                if room and a in best and best[a] + c < best.get(b, 10**9):
                    best[b], via[b], changed = best[a] + c, i, True
            if not changed:
                break
        if "T" not in best:
            return words, cost
        path, v = [], "T"
        while v != "S":
            path.append(via[v])
            v = arcs[via[v]][0]
        n = min(arcs[i][2] for i in path)
        for i in path:
            arcs[i][2] -= n
            arcs[i ^ 1][2] += n
        words, cost = words + n, cost + n * best["T"]


def cost_of(flow, size, costs):
    return sum(c * max(0, min(size, flow - i * size)) for i, c in enumerate(costs))


@pytest.mark.parametrize("seed", range(40))
def test_flow_is_as_large_and_as_cheap_as_can_be(seed):
    r = random.Random(seed)
    sources = ["a", "b", "c", None][: r.randint(1, 4)]
    every = [p for k in range(len(sources) + 1) for p in itertools.combinations(sources, k)]
    supplies = {p: r.choice([0, 1, r.randint(1, 30)]) for p in r.sample(every, r.randint(0, len(every)))}
    quotas = {s: r.randint(0, 60) for s in sources}
    costs = sorted(r.choices([0, 1, 2, 5], k=r.randint(1, 4)))
    routes = mixing.route(supplies, quotas, costs)
    out, into = defaultdict(int), defaultdict(int)
    for (p, s), n in routes.items():
        assert s in p and n >= 0
        out[p] += n
        into[s] += n
    assert all(out[p] <= len(costs) * supplies[p] for p in supplies)
    assert all(into[s] <= quotas[s] for s in quotas)
    got = sum(into.values()), sum(cost_of(out[p], supplies[p], costs) for p in supplies)
    assert got == cheapest_flow(supplies, quotas, costs)


def test_costs_must_be_convex():
    with pytest.raises(ValueError):
        mixing.route({("a",): 1}, {"a": 1}, (2, 1))


@pytest.mark.parametrize("seed", range(30))
def test_targets(seed):
    r = random.Random(seed)
    sizes = {f"s{i:02}": r.choice([0, 1, 10, r.randint(1, 1000)]) for i in range(r.randint(1, 9))}
    weights = mixing.repeating(sizes)
    total = sum(sizes.values())
    got, want = mixing.targets(sizes, weights, total), brute_targets(sizes, weights, total)
    assert all(abs(got[s] - want[s]) < 1e-6 * max(1, want[s]) for s in sizes)
    assert abs(sum(got.values()) - total) < 1e-6 * max(1, total)


def test_weights_repeat_by_code_point_and_null_is_last():
    got = mixing.repeating(["b", None, "a", "\U0001f600", "￮"])
    assert got == {"a": 5, "b": 2, "￮": 1, "\U0001f600": 5, None: 2}


def check_mix(rows, docs):
    """The contract of the query, from the texts."""
    sizes = {i: len(WORDS.findall(t or "")) for i, t, _ in docs}
    of = {i: s for i, _, s in docs}
    per = Counter()
    for i, s in of.items():
        per[s] += sizes[i]
    want = brute_targets(dict(per), mixing.repeating(per), sum(per.values()))
    taken, largest = Counter(), defaultdict(int)
    for r in rows:
        assert r["size"] == sizes[r.doc_id] and r.source_size == per[of[r.doc_id]]
        assert abs(r.target - want[of[r.doc_id]]) < 1e-6 * max(1, r.target)
        assert r.taken in [k * r["size"] for k in range(4)]
        taken[of[r.doc_id]] += r.taken
        largest[of[r.doc_id]] = max(largest[of[r.doc_id]], r["size"])
    assert sorted(r.doc_id for r in rows) == sorted(sizes)
    return {s: (taken[s], float(want[s])) for s in per}


def test_query_comes_near_the_targets_and_repeats(spark, sf_dir):
    from tallyfold.llm.queries import QUERIES

    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = QUERIES["op12_source_mixing"](spark, sf_dir).collect()
    for taken, want in check_mix(rows, docs).values():
        assert 0.94 * want <= taken <= want + 1  # ten documents a source
    again = QUERIES["op12_source_mixing"](spark, sf_dir).repartition(5).collect()
    assert {(r.doc_id, r.taken) for r in rows} == {(r.doc_id, r.taken) for r in again}


def test_overlapping_sources(spark):
    rows = []
    r = random.Random(5)
    for i in range(6000):
        members = r.choice([["a"], ["a", "b"], ["b", "c", "b"], ["c"], ["a", None], [], None])
        rows.append((i, " ".join(["w"] * r.randint(0, 40)), members))
    docs = spark.createDataFrame(rows, "doc_id long, text string, members array<string>")
    weigh = lambda found: {s: {"a": 1.0, "b": 6.0, "c": 0.0}.get(s, 1.0) for s in found}
    got = mixing.mix(docs.withColumn("key", F.lit(1)), F.col("members"), weigh, seed=9)
    sources = {s.source: s for s in got.sources.collect()}
    assert set(sources) == {"a", "b", "c", None} and sources["c"].routed == 0
    assert all(s.routed <= s.target + 1 for s in sources.values())
    by = defaultdict(int)
    for d in got.documents.collect():
        assert d.taken in [k * d["size"] for k in range(4)]
        by[tuple(d.members)] += d.taken
    assert by[("c",)] == 0 and by[()] == 0
    want = Counter()
    for (p, _), n in got.routes.items():
        want[p] += n
    assert all(want[p] - 5 <= by[p] <= want[p] for p in by)


def test_hot_source_and_one_huge_document(spark):
    docs = spark.range(30_000).selectExpr(
        "id AS doc_id", "repeat('w ', CAST(1 + id % 37 AS INT)) AS text", "IF(id % 3 < 2, 'hot', concat('s', id % 40)) AS source"
    ).union(spark.range(1).selectExpr("30001L", "repeat('x ', 200000)", "'hot'"))
    rows = mixing.by_source(docs.repartition(7)).collect()
    for taken, want in check_mix(rows, [(d.doc_id, d.text, d.source) for d in docs.collect()]).values():
        assert want - 40 <= taken <= want + 1


def test_odd_rows(spark, odd_docs, no_docs):
    none = odd_docs.withColumn("source", F.when(F.col("doc_id") < 6, F.col("source")))
    rows = mixing.by_source(none).collect()
    assert len(rows) == odd_docs.count()
    twice = {r.taken for r in rows if r.doc_id == 7}
    assert len(twice) == 1 and all(r.taken == 0 for r in rows if r["size"] == 0)
    assert {r.source for r in rows} == {"s", None} and all(r.source_size is not None for r in rows)
    assert mixing.by_source(no_docs).count() == 0
