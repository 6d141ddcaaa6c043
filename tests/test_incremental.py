"""Canonical jobs after batches against one run over everything."""

import pytest
from pyspark.sql import functions as F

from tallyfold.operators.canonical import canonical_jobs
from tallyfold.plans import bindings as b
from tallyfold.plans.incremental import JobStore
from tallyfold.plans.market import classify_run
from tallyfold.schemas import JOB_DETAILS, LISTING_SNAPSHOTS, SEARCH_QUERIES
from tallyfold.session import stored

TABLES = (("listing_snapshots", LISTING_SNAPSHOTS), ("job_details", JOB_DETAILS), ("search_queries", SEARCH_QUERIES))


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    made = b.job_tables(spark, sf_dir)
    return {name: stored(made[name].select(*schema.fieldNames()), name) for name, schema in TABLES}


def full(tables):
    """Everything from the start, with labels as a table of their own."""
    return canonical_jobs({**tables, "classifications": classify_run(tables)})


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def parts(tables, n=3):
    """Listings by time, details and searches by hash: every batch touches jobs of earlier ones."""
    order = F.pmod(F.xxhash64("query_id"), F.lit(n))
    for i in range(n):
        yield {
            "listing_snapshots": tables["listing_snapshots"].where(F.col("snapshot_id").cast("long") % n == i),
            "job_details": tables["job_details"].where(F.pmod(F.xxhash64("job_id"), F.lit(n)) == (i + 1) % n),
            "search_queries": tables["search_queries"].where(order == (i + 2) % n),
        }


def test_three_batches_equal_one_run(spark, tables, tmp_path):
    store = JobStore(spark, str(tmp_path / "s"), buckets=2)
    for number, batch in enumerate(parts(tables)):
        assert store.apply(batch, number) > 0
    want = rows(full(tables))
    assert rows(store.jobs.current()) == want
    version = store.jobs.version
    assert store.apply(batch, number) == 0 and JobStore(spark, store.root, 2).jobs.version == version
    store.sweep()
    assert rows(JobStore(spark, store.root, 2).jobs.current()) == want


def test_a_small_batch_computes_its_jobs_only(spark, tables, tmp_path):
    store = JobStore(spark, str(tmp_path / "s"), buckets=2)
    store.apply(tables, 0)
    job = tables["listing_snapshots"].select("run_id", "job_id").orderBy("run_id", "job_id").limit(1)
    better = tables["listing_snapshots"].join(job, ["run_id", "job_id"], "left_semi").limit(1).withColumns({
        "snapshot_id": F.lit("999999999"), "parser_confidence": F.lit(2.0), "title": F.lit("Chief Data Officer"),
    })
    assert store.apply({"listing_snapshots": better.select(*LISTING_SNAPSHOTS.fieldNames())}, 1) == 1
    after = {**tables, "listing_snapshots": tables["listing_snapshots"].unionByName(better)}
    assert rows(store.jobs.current()) == rows(full(after))
    got = store.jobs.lookup(job).first()
    assert got["title"] == "Chief Data Officer" and got["role_family"] == "Executive"


def test_a_changed_search_touches_what_it_found(spark, tables, tmp_path):
    store = JobStore(spark, str(tmp_path / "s"), buckets=2)
    store.apply(tables, 0)
    one = tables["search_queries"].orderBy("query_id").limit(1)
    renamed = stored(one.withColumn("city_name", F.lit("Elsewhere")), "renamed")
    again = tables["search_queries"].withColumn("status", F.lit("complete"))  # not used by any job
    found = tables["listing_snapshots"].join(one, "query_id", "left_semi").select("run_id", "job_id").distinct().count()
    assert store.apply({"search_queries": again}, 1) == 0
    assert store.apply({"search_queries": renamed}, 2) == found > 0
    others = tables["search_queries"].join(renamed, "query_id", "left_anti")
    assert rows(store.jobs.current()) == rows(full({**tables, "search_queries": others.unionByName(renamed)}))


def test_an_attempt_that_died_is_finished(spark, tables, tmp_path, monkeypatch):
    store, batches = JobStore(spark, str(tmp_path / "s"), buckets=2), list(parts(tables, 2))
    store.apply(batches[0], 0)
    with monkeypatch.context() as m:
        def die(*_, **__):
            raise RuntimeError("lost")

        m.setattr(store.jobs, "upsert", die)
        with pytest.raises(RuntimeError):
            store.apply(batches[1], 1)
    assert JobStore(spark, store.root, 2).apply(batches[1], 1) > 0
    assert rows(JobStore(spark, store.root, 2).jobs.current()) == rows(full(tables))


def test_old_facts_are_read_through_the_touched_keys(spark, tables, tmp_path):
    store = JobStore(spark, str(tmp_path / "s"), buckets=4)
    store.apply(tables, 0)
    keys = tables["listing_snapshots"].select("run_id", "job_id").orderBy("run_id", "job_id").limit(1)
    listings, details, _ = store.facts(keys)
    for facts in (listings, details):
        assert "LeftSemi" in facts._jdf.queryExecution().optimizedPlan().toString()
    read = [f.split("bucket=")[1].split("/")[0] for f in listings.inputFiles() if "bucket=" in f]
    assert len(set(read)) == 1
