import hashlib
import math

import pytest
from pyspark.sql import functions as F

from tallyfold.functions.identity import hash32
from tallyfold.operators import sampling as sm
from tallyfold.operators.selection import radix_edge

CONFIG = {
    "cities": [
        {"key": "sf", "name": "SF", "weight": 0.6, "locations": ["San Francisco, CA", "San Jose, CA"]},
        {"key": "ny", "name": "NY", "weight": 0.4, "locations": ["New York, NY"]},
    ],
    "families": [
        {"key": "swe", "name": "SWE", "keywords": ["software engineer", "backend"]},
        {"key": "ai", "name": "AI", "keywords": ["ml engineer"]},
    ],
    "levels": [{"key": "e", "param": "f_E=2", "weight": 0.3}, {"key": "s", "param": "f_E=4", "weight": 0.7}],
}


def test_frame_weights_sum_to_one(spark):
    frame = sm.search_frame(sm.config_rows(spark, {"r1": CONFIG, "r2": CONFIG}))
    assert frame.count() == 2 * 3 * 3 * 2
    for row in sm.frame_weight_sums(frame).collect():
        assert row["weight_sum"] == pytest.approx(1.0)
    row = frame.where("run_id = 'r1' and location = 'New York, NY' and keyword = 'ml engineer' and experience_key = 's'").first()
    assert row["target_weight"] == pytest.approx(0.4 * 0.7 * 0.5)
    digest = hashlib.sha1(b"r1|ny|New York, NY|ai|ml engineer|s").hexdigest()[:12]
    assert row["query_id"] == "q_" + digest
    assert "keywords=ml+engineer&location=New+York%2C+NY" in row["url"]


def test_config_problems(spark):
    bad = {**CONFIG, "time_window_days": 31, "max_pages": 0,
           "levels": [{"key": "e", "param": "p", "weight": 1.2}, {"key": "f", "param": "p", "weight": 0.0}]}
    edge = {**CONFIG, "levels": [{"key": "e", "param": "p", "weight": 1.009}]}
    got = sm.config_problems(sm.config_rows(spark, {"ok": CONFIG, "edge": edge, "bad": bad})).collect()
    assert {r["run_id"] for r in got} == {"bad"}
    assert sorted(r["problem"] for r in got) == [
        "level weights must be positive", "level weights must sum to 1", "max_pages out of range",
        "time_window_days out of range",
    ]


def test_page_plan(spark):
    frame = sm.search_frame(sm.config_rows(spark, {"r1": CONFIG}))
    plan = sm.page_plan(frame, 3).orderBy("query_id", "page").limit(3).collect()
    assert [r["start"] for r in plan] == [0, 25, 50]
    assert "start=" not in plan[0]["page_url"] and plan[2]["page_url"].endswith("&start=50")


def test_page_loop_stops_at_first_empty_page(spark):
    pages = spark.createDataFrame(
        [("a", 1, 5), ("a", 2, 0), ("a", 3, 9), ("b", 1, 2), ("b", 2, 3), ("c", 1, 0)],
        "query_id string, page int, n int",
    )
    got = {r["query_id"]: (r["result_count"], r["pages_collected"]) for r in sm.page_loop_stop(pages).collect()}
    assert got == {"a": (5, 2), "b": (5, 2), "c": (0, 1)}


def draw(seed, key):
    return int(hashlib.md5(f"{seed}:{key}".encode()).hexdigest()[:8], 16)


def test_capped_sample_is_exactly_the_lowest_hashes(spark):
    """One stratum holds most rows; the quota cuts inside one hash range."""
    n = 20000
    df = spark.range(0, n, 1, 6).select(
        "id", F.when(F.col("id") % 10 < 8, "hot").otherwise("cold").alias("s")
    )
    quotas = sm.strata_quotas(spark, "s", [("hot", 777), ("cold", 10**9), ("none", 5)])
    got = sm.capped_sample(df, "s", quotas, "id", 7)
    hot = sorted((draw(7, i), i) for i in range(n) if i % 10 < 8)[:777]
    cold = {i for i in range(n) if i % 10 >= 8}
    assert {r["id"] for r in got.where("s = 'hot'").collect()} == {i for _, i in hot}
    assert {r["id"] for r in got.where("s = 'cold'").collect()} == cold
    again = sm.capped_sample(df.repartition(3), "s", quotas, "id", 7)
    assert again.exceptAll(got).count() == 0


def test_capped_sample_with_zero_quota(spark):
    df = spark.range(10).select("id", F.lit("a").alias("s"))
    assert sm.capped_sample(df, "s", sm.strata_quotas(spark, "s", [("a", 0)]), "id").count() == 0


@pytest.mark.parametrize("target,copies", [(100, 1), (199, 1), (220, 2), (1000, 6)])
def test_shuffled_frame_repeats_small_grids(spark, target, copies):
    df = spark.createDataFrame([(f"q{i}",) for i in range(10)], "query_id string")
    got = sm.shuffled_frame(df, "query_id", target).collect()
    expected = target // (20 * 10) + 1 if 10 < target // 20 else 1
    assert expected == copies and len(got) == 10 * copies
    assert [r["draw"] for r in got] == sorted(r["draw"] for r in got)


def test_quota_gap(spark):
    df = spark.createDataFrame([("a",)] * 7, "c string")
    got = {r["c"]: (r["target"], r["have"], r["gap"]) for r in sm.quota_gap(df, "c", {"a": 0.35, "b": 0.65}, 15).collect()}
    assert got == {"a": (math.floor(15 * 0.35), 7, 0), "b": (math.floor(15 * 0.65), 0, 9)}


@pytest.mark.parametrize("quota", [0, 1, 2999, 3000, 9000, 20_000])
def test_sample_of_one_stratum_that_repeats_one_row(spark, quota):
    """A third of the rows are one row, and the others share its stratum: no order tells them apart."""
    same = spark.range(6000).selectExpr("'a' AS s", "'k' AS id", "map('x', 1) AS m")
    other = spark.range(3000).selectExpr("'a' AS s", "concat('id', id) AS id", "map('x', 2) AS m")
    df = same.union(other)
    got = sm.capped_sample(df, "s", sm.strata_quotas(spark, "s", [("a", quota)]), "id", 3)
    rows = [r["id"] for r in got.collect()]
    assert len(rows) == min(quota, 9000)
    draw = {r["id"]: r["h"] for r in df.select("id", hash32(F.lit(3), "id").alias("h")).distinct().collect()}
    every = sorted([r["id"] for r in df.select("id").collect()], key=lambda i: (draw[i], i))
    assert sorted(rows) == sorted(every[:quota])


def test_edges_are_refined_until_few_rows_are_left(spark):
    rows = spark.range(50_000).selectExpr("id % 3 AS g", "id % 1000 AS w", "abs(xxhash64(id)) AS k").where("k >= 0")
    limits = spark.createDataFrame([(0, 1_000_000), (1, 5), (2, 10**9)], "g long, room long")
    edge = radix_edge(rows, "g", "k", limits, 63, F.col("w"), enough=20)
    plan = {r["g"]: r for r in edge.plan.collect()}
    assert all(r["held"] <= 20 for r in plan.values())
    for g, limit in ((0, 1_000_000), (1, 5)):
        below = rows.join(edge.plan, "g").where((F.col("g") == g) & edge.below(F.col("k"))).agg(F.sum("w")).first()[0] or 0
        at = rows.join(edge.plan, "g").where((F.col("g") == g) & edge.at(F.col("k"))).agg(F.sum("w")).first()[0]
        assert below + plan[g]["room"] == limit and below < limit <= below + at
    every = rows.join(edge.plan, "g").where((F.col("g") == 2) & (edge.below(F.col("k")) | edge.at(F.col("k")))).count()
    assert every == rows.where("g = 2").count()
