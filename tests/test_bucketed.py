"""The stored table: newest rows, what a write touches, replays, merges and what is left behind."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyfold.sources.bucketed import FAN, BucketedTable, Run, merged
from tallyfold.sources.versions import Conflict, Versions

SCHEMA = "k long, part string, v string, m map<string,int>"


def rows(spark, *values):
    return spark.createDataFrame([(k, "p", v, {"x": 1}) for k, v in values], SCHEMA)


def table(spark, tmp_path, **more):
    return BucketedTable.create(spark, str(tmp_path / "t"), rows(spark).schema, ["k"], **more)


def content(t):
    return sorted((r["k"] if r["k"] is not None else -1, r["v"]) for r in t.current().collect())


def files(t):
    root = Path(t.root)
    return {str(f.relative_to(root)) for f in root.rglob("*.parquet")}


def test_later_batches_win(spark, tmp_path):
    r, t, want = random.Random(1), table(spark, tmp_path, buckets=5), {}
    for batch in range(9):
        new = {r.randrange(40): f"{batch}-{i}" for i in range(r.randrange(1, 25))}
        assert t.upsert(rows(spark, *new.items()), batch_id=batch)
        want |= new
        assert content(t) == sorted(want.items())
        assert content(BucketedTable(spark, t.root)) == sorted(want.items())


def test_order_within_a_batch_and_null_keys(spark, tmp_path):
    t = table(spark, tmp_path, buckets=2)
    t.upsert(rows(spark, (1, "a"), (1, "c"), (1, "b"), (None, "n")), [F.desc("v")])
    t.upsert(rows(spark, (None, "o")))
    assert content(t) == [(-1, "o"), (1, "c")]
    t.upsert(rows(spark))
    assert content(t) == [(-1, "o"), (1, "c")]


def test_an_upsert_writes_to_the_buckets_it_hits_only(spark, tmp_path):
    t = table(spark, tmp_path, buckets=8)
    t.upsert(rows(spark, *[(k, "a") for k in range(100)]))
    before = files(t)
    t.upsert(rows(spark, (3, "b"), (3, "c")))
    new = files(t) - before
    assert before <= files(t) and len(new) == 1
    bucket = spark.createDataFrame([(3,)], "k long").select(t.bucket_of()).first()[0]
    assert f"/bucket={bucket}/" in next(iter(new))


def test_readers_touch_the_files_of_the_manifest_only(spark, tmp_path):
    t = table(spark, tmp_path, buckets=4)
    for batch in range(FAN + 1):
        t.upsert(rows(spark, *[(k, f"{batch}") for k in range(0, 40, batch + 1)]))
    named = {f"{t.root}/{run.path}" for run in t.runs}
    read = {f.removeprefix("file:").removeprefix("//").rsplit("/", 1)[0] for f in t.current().inputFiles()}
    assert read == named and len(files(t)) > len(read)
    key = spark.createDataFrame([(7,)], "k long")
    bucket = key.select(t.bucket_of()).first()[0]
    assert {f.split("bucket=")[1].split("/")[0] for f in t.lookup(key).inputFiles()} == {str(bucket)}
    assert "LeftSemi" in t.lookup(key)._jdf.queryExecution().executedPlan().toString()
    assert [r["k"] for r in t.lookup(key).collect()] == [7]


def test_a_replay_changes_nothing(spark, tmp_path):
    t = table(spark, tmp_path)
    batch = rows(spark, (1, "a"), (2, "b"))
    assert t.upsert(batch, batch_id=0) and t.upsert(rows(spark, (1, "c")), batch_id=1)
    before, version = files(t), t.version
    assert not BucketedTable(spark, t.root).upsert(batch, batch_id=0)
    assert files(t) == before and BucketedTable(spark, t.root).version == version
    assert content(t) == [(1, "c"), (2, "b")]
    assert t.upsert(batch, batch_id=0, source="another")


def test_absent_only(spark, tmp_path):
    t = table(spark, tmp_path, buckets=3)
    t.upsert(rows(spark, (1, "a"), (None, "n")), absent_only=True)
    t.upsert(rows(spark, (1, "b"), (2, "c"), (None, "m")), absent_only=True)
    assert content(t) == [(-1, "n"), (1, "a"), (2, "c")]


def test_merges_follow_size_tiers(spark, tmp_path):
    t = table(spark, tmp_path, buckets=1)
    for batch in range(30):
        t.upsert(rows(spark, *[(batch * 10 + i, f"{batch}") for i in range(10)], (-5, f"{batch}")))
        assert not merged(t.runs) and len(t.runs) <= 3 * (FAN - 1)
    assert t.current().count() == 301
    assert [r["v"] for r in t.current().where("k = -5").collect()] == ["29"]
    large = Run(0, "big", 10**6)
    assert merged([large, *[Run(0, f"f{i}", 10) for i in range(FAN)]]) == [[Run(0, f"f{i}", 10) for i in range(FAN)]]


def test_compact_and_sweep(spark, tmp_path):
    t = table(spark, tmp_path, buckets=3)
    for batch in range(3):
        t.upsert(rows(spark, *[(k, f"{batch}") for k in range(30)]))
    before = content(t)
    t.compact()
    assert len(t.runs) == 3 and content(t) == before
    assert t.sweep(keep=1) > 0 and len(files(t)) == 3
    assert content(BucketedTable(spark, t.root)) == before


def test_of_two_writers_one_fails(spark, tmp_path):
    a = table(spark, tmp_path)
    b = BucketedTable(spark, a.root)
    a.upsert(rows(spark, (1, "a")))
    with pytest.raises(Conflict):
        b.upsert(rows(spark, (1, "b")))
    assert content(BucketedTable(spark, a.root)) == [(1, "a")]


def test_a_torn_manifest_is_not_seen(spark, tmp_path):
    t = table(spark, tmp_path)
    t.upsert(rows(spark, (1, "a")))
    folder = Path(t.root) / "manifest"
    (folder / f"v{t.version + 1:012}.json").write_text('{"runs": [')
    again = BucketedTable(spark, t.root)
    assert content(again) == [(1, "a")]
    again.upsert(rows(spark, (2, "b")))
    assert content(BucketedTable(spark, t.root)) == [(1, "a"), (2, "b")]
    assert Versions(spark, t.root).numbers()[-1] == again.version


def test_buckets_by_a_part_of_the_key(spark, tmp_path):
    schema = "part string, k long, v string"
    t = BucketedTable.create(spark, str(tmp_path / "t"), spark.createDataFrame([], schema).schema, ["part", "k"], by=["part"], buckets=7)
    t.upsert(spark.createDataFrame([(f"p{i % 5}", i, "a") for i in range(50)], schema))
    t.upsert(spark.createDataFrame([("p1", 1, "b"), ("p1", 99, "c")], schema))
    got = t.lookup(spark.createDataFrame([("p1",)], "part string")).collect()
    assert sorted((r["k"], r["v"]) for r in got)[:2] == [(1, "b"), (6, "a")] and len(got) == 11


def test_buckets_follow_the_rows(spark, sf_dir, monkeypatch):
    from tallyfold.plans import catalog_stored
    from tallyfold.sources import bucketed

    assert [bucketed.buckets_for(n, 8) for n in (0, 1_600_000, 1_600_001, 36_000_000)] == [8, 8, 9, 180]
    monkeypatch.setattr(bucketed, "ROWS", 100)
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    assert rows > 800 and catalog_stored.events_table(spark, sf_dir).buckets == -(-rows // 100)
