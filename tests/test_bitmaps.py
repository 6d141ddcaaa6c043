"""Exact counts from stored bitmaps."""

import pytest
from pyspark.sql import functions as F

from tallyfold.operators import bitmaps as bm
from tallyfold.session import stored


@pytest.fixture(scope="module")
def facts(spark):
    return spark.range(200_000).selectExpr(
        "IF(id % 50 = 0, NULL, concat('j', id % 70000)) AS job", "IF(id % 11 = 0, NULL, id % 4) AS run", "id % 3 AS city",
    )


def test_counts_of_every_union_are_exact(spark, facts):
    numbers = stored(bm.key_numbers(facts, ["job"]), "numbers")
    assert numbers.count() == numbers.select("bucket", "place").distinct().count() == facts.agg(F.count_distinct("job")).first()[0]
    kept = stored(bm.group_bitmaps(facts, numbers, ["job"], ["run", "city"]), "bits")
    for by in (["run"], ["city"], [], ["run", "city"]):
        got = {tuple(r[c] for c in by): r.jobs for r in bm.counted(bm.merge_bitmaps(kept, by), by).collect()}
        exact = facts.groupBy(*by).agg(F.count_distinct("job").alias("n")).collect()
        assert got == {tuple(r[c] for c in by): r.n for r in exact}
    plan = bm.counted(bm.merge_bitmaps(kept, ["run"]), ["run"])._jdf.queryExecution().executedPlan().toString()
    assert "job#" not in plan


def test_what_two_groups_share(spark):
    rows = [("a", i) for i in range(100)] + [("b", i) for i in range(70, 130)] + [("c", 5000), ("a", 3)]
    df = spark.createDataFrame(rows, "g string, k long")
    kept = bm.group_bitmaps(df, bm.key_numbers(df, ["k"], 3), ["k"], ["g"])
    assert tuple(bm.shared(kept, "g", "a", "b").first()) == (70, 30, 30)
    assert tuple(bm.shared(kept, "g", "a", "none").first()) == (100, 0, 0)
    assert tuple(bm.shared(kept.limit(0), "g", "a", "b").first()) == (0, 0, 0)


def test_too_few_buckets_fail(spark):
    with pytest.raises(Exception, match="too many keys"):
        bm.key_numbers(spark.range(40_000), ["id"], 1).agg(F.sum("place")).collect()
