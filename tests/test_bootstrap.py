import math

import pytest
from pyspark.sql import functions as F

from tallyfold.operators import bootstrap as bs


def jobs(spark, hits, n, parts=4):
    return spark.range(0, n, 1, parts).select("id", (F.col("id") < hits).alias("hit"))


def test_quantile_points():
    assert bs.quantile_points(500) == ((12, 21), (488, 19))


def test_poisson_steps():
    steps = bs.poisson_steps()
    assert steps[0] == int(math.exp(-1) * 2**32)
    assert steps == sorted(steps) and steps[-1] < 2**32


def ci(df, **more):
    return bs.bootstrap_ci(df, F.col("hit"), ["id"], **more)


def test_published_interval(spark):
    """553 of 7354 gave 6.9 % to 8.1 % with 500 replicates."""
    row = ci(jobs(spark, 553, 7354)).first()
    assert row["observed"] == pytest.approx(553 / 7354)
    assert row["lower"] == pytest.approx(0.069, abs=0.002)
    assert row["upper"] == pytest.approx(0.081, abs=0.002)


@pytest.mark.parametrize("hits, n", [(300, 1000), (3000, 10000)])
def test_agrees_with_normal_approximation(spark, hits, n):
    row = ci(jobs(spark, hits, n)).first()
    half = 1.96 * math.sqrt(0.3 * 0.7 / n)
    assert row["observed"] == pytest.approx(0.3)
    assert row["lower"] == pytest.approx(0.3 - half, abs=half / 4)
    assert row["upper"] == pytest.approx(0.3 + half, abs=half / 4)


def test_weighted_interval(spark):
    df = jobs(spark, 400, 2000).withColumn("w", F.when(F.col("id") % 2 == 0, 0.1).otherwise(0.4))
    row = ci(df, weight="w").first()
    assert row["observed"] == pytest.approx(0.2)
    assert 0.17 < row["lower"] < 0.19 < 0.21 < row["upper"] < 0.23


@pytest.mark.parametrize("weight", [None, "w"])
def test_independent_of_partitions(spark, weight):
    a = jobs(spark, 30, 100, 1).withColumn("w", F.lit(0.5))
    b = jobs(spark, 30, 100, 7).withColumn("w", F.lit(0.5))
    assert ci(a, weight=weight).first() == ci(b, weight=weight).first()


@pytest.mark.parametrize("weight", [None, "w"])
def test_no_rows(spark, weight):
    empty = jobs(spark, 0, 0).withColumn("w", F.lit(0.5))
    assert tuple(ci(empty, weight=weight).first()) == (0.0, 0.0, 0.0)


def test_certain_share(spark):
    assert tuple(ci(jobs(spark, 50, 50)).first()) == (1.0, 1.0, 1.0)


@pytest.mark.parametrize("weight", [None, "w"])
def test_groups_with_a_null_one(spark, weight):
    group = F.when(F.col("id") % 2 == 1, F.lit(1))
    df = jobs(spark, 30, 100).withColumn("g", group).withColumn("w", F.lit(0.5))
    got = ci(df, by=["g"], weight=weight).orderBy("g").collect()
    assert [(r["g"], r["observed"]) for r in got] == [(None, 0.3), (1, 0.3)]


def test_no_replicate_becomes_a_row(spark):
    """Two aggregations over the rows, and draws that are made once, in a subquery."""
    df = ci(jobs(spark, 30, 100), by=["hit"])
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" not in plan and "Expand" not in plan and plan.count("scalar-subquery") == 1


def test_several_shares_from_one_pass(spark):
    df = jobs(spark, 300, 1000).withColumn("rare", F.col("id") < 50).withColumn("g", F.col("id") % 2)
    both = bs.bootstrap_shares(df, {"a": F.col("hit"), "b": F.col("rare")}, ["id"], by=["g"])
    got = {(r.g, r.metric): (r.observed, r.lower, r.upper) for r in both.collect()}
    for name, column in (("a", "hit"), ("b", "rare")):
        for r in bs.bootstrap_ci(df, F.col(column), ["id"], by=["g"]).collect():
            assert got[r.g, name] == (r.observed, r.lower, r.upper)
    assert len(got) == 4


def test_many_groups(spark):
    df = spark.range(30_000).select("id", (F.col("id") % 300).alias("g"), (F.col("id") % 7 < 2).alias("hit"))
    rows = ci(df, by=["g"]).collect()
    assert len(rows) == 300 and all(r.lower <= r.observed <= r.upper for r in rows)
