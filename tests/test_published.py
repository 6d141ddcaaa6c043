"""Exports that appear at once, sketches that merge, and runs that end."""

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyfold.operators import sketches as sk
from tallyfold.operators import upsert as up
from tallyfold.operators.canonical import canonical_jobs
from tallyfold.plans.bindings import job_tables
from tallyfold.schemas import SEARCH_RUNS, TABLES
from tallyfold.session import stored
from tallyfold.sources import published as pb


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    made = job_tables(spark, sf_dir)
    return {n: stored(made[n].select(*TABLES[n].fieldNames()), n) for n in TABLES}


def counts(spark, root):
    return {n: t.count() for n, t in pb.read_published(spark, root).items()}


def test_one_run_takes_the_place_of_its_earlier_export(spark, tables, tmp_path):
    root = str(tmp_path / "x")
    assert pb.publish(tables, root) == 1
    first = counts(spark, root)
    assert len(first) == 9 and first["listing_snapshots"] == tables["listing_snapshots"].count()
    less = {**tables, "listing_snapshots": tables["listing_snapshots"].where("run_id <> 'run_a' OR page = 1")}
    assert pb.publish({**less, "quality_issues": tables["quality_issues"].limit(0)}, root, "run_a") == 2
    back = pb.read_published(spark, root)
    assert back["listing_snapshots"].exceptAll(less["listing_snapshots"]).count() == 0
    assert back["listing_snapshots"].count() == less["listing_snapshots"].count()
    assert {r["run_id"] for r in back["quality_issues"].select("run_id").distinct().collect()} == {"run_b", "run_empty"}
    whole = canonical_jobs({n: back[n] for n in TABLES})
    assert back["canonical_jobs"].select(whole.columns).exceptAll(whole).count() == 0
    assert {n: t.count() for n, t in pb.read_published(spark, root, 1).items()} == first
    assert pb.sweep(spark, root, keep=1) > 0
    assert counts(spark, root)["canonical_jobs"] == back["canonical_jobs"].count()
    with pytest.raises(FileNotFoundError):
        pb.read_published(spark, root, 1)


def test_a_failure_half_way_leaves_the_old_tables(spark, tables, tmp_path, monkeypatch):
    root = str(tmp_path / "x")
    pb.publish(tables, root, "run_b")
    before = counts(spark, root)

    def fail(_):
        raise RuntimeError("lost")

    monkeypatch.setattr(pb, "canonical_jobs", fail)
    with pytest.raises(RuntimeError):
        pb.publish(tables, root)
    assert counts(spark, root) == before
    left = len(list(Path(root, "data").iterdir()))
    assert pb.sweep(spark, root, keep=1) > 0 and len(list(Path(root, "data").iterdir())) < left
    assert counts(spark, root) == before


def test_nothing_published(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        pb.read_published(spark, str(tmp_path / "none"))


def test_sketches_of_runs_merge_into_the_count_of_all(spark, tmp_path):
    facts = spark.range(300_000).selectExpr("id % 4 AS run", "id % 3 AS city", "IF(id % 10 = 0, NULL, id % 90000) AS job")
    sk.key_sketches(facts, "job", ["run", "city"]).write.parquet(str(tmp_path / "s"))
    kept = spark.read.parquet(str(tmp_path / "s"))
    for by in (["run"], ["city"], [], ["run", "city"]):
        got = {tuple(r[c] for c in by): (r.jobs, r.rows) for r in sk.estimated(sk.merge_sketches(kept, by)).collect()}
        exact = facts.groupBy(*by).agg(F.count_distinct("job").alias("n"), F.count(F.lit(1)).alias("rows")).collect()
        for r in exact:
            jobs, rows = got[tuple(r[c] for c in by)]
            assert abs(jobs - r.n) <= 0.03 * r.n and rows == r.rows
    plan = sk.estimated(sk.merge_sketches(kept, ["run"]))._jdf.queryExecution().executedPlan().toString()
    assert "job" not in plan.replace("jobs", "")


def test_runs_end_and_resume(spark):
    at, later = datetime(2026, 1, 1), datetime(2026, 1, 2)
    runs = spark.createDataFrame([
        ("a", "h", "1", "complete", "p", "{}", at, later), ("b", "h", "1", "running", "p", "{}", at, None),
        ("c", "h", "1", "failed", "p", "{}", at, later),
    ], SEARCH_RUNS)
    asked = spark.createDataFrame([("a", "h", later), ("c", "other", later), ("d", "h", None)], "run_id string, config_hash string, ended_at timestamp_ntz")
    started = up.run_guard(runs, asked, enforce=False)
    assert {r.run_id: (r.action, r.ended_at) for r in started.collect()} == {"a": ("resumed", None), "c": ("conflict", later), "d": ("new", None)}
    going = up.resume_runs(runs, started)
    assert {r.run_id: (r.status, r.ended_at) for r in going.collect()} == {
        "a": ("running", None), "b": ("running", None), "c": ("failed", later), "d": ("running", None)}
    end = spark.createDataFrame([("a", "complete", later), ("b", None, later), ("c", "complete", at)], "run_id string, status string, ended_at timestamp_ntz")
    done = {r.run_id: (r.status, r.ended_at) for r in up.finish_runs(going, end).collect()}
    assert done == {"a": ("complete", later), "b": ("complete", later), "c": ("failed", later), "d": ("running", None)}
