from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyfold.operators.canonical import canonical_jobs
from tallyfold.plans.bindings import job_tables
from tallyfold.schemas import CSV_LABELS, TABLES
from tallyfold.session import checkpoint_dir, scratch_path
from tallyfold.sources import readers as rd
from tallyfold.sources import writers as wr


def test_run_filter_prunes_partitions(spark, tmp_path):
    schema = "run_id string, v int"
    path = str(tmp_path / "t")
    wr.replace_partition(spark.createDataFrame([("a", 1), ("b", 2)], schema), path)
    df = rd.read_table(spark, path, spark.createDataFrame([], schema).schema, "a")
    assert [r["v"] for r in df.collect()] == [1]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan


def test_replace_partition_keeps_other_runs(spark, tmp_path):
    schema, path = "run_id string, v int", str(tmp_path / "t")
    wr.replace_partition(spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], schema), path)
    wr.replace_partition(spark.createDataFrame([("b", 9)], schema), path)
    got = rd.read_table(spark, path, spark.createDataFrame([], schema).schema)
    assert sorted(tuple(r) for r in got.select("run_id", "v").collect()) == [("a", 1), ("b", 9)]


def test_replace_partition_empties_a_named_run(spark, tmp_path):
    schema, path = "run_id string, v int", str(tmp_path / "t")
    wr.replace_partition(spark.createDataFrame([("a", 1), ("b", 2)], schema), path)
    wr.replace_partition(spark.createDataFrame([("b", 9)], schema), path, values=["a", "b"])
    got = rd.read_table(spark, path, spark.createDataFrame([], schema).schema)
    assert [tuple(r) for r in got.select("run_id", "v").collect()] == [("b", 9)]
    with pytest.raises(ValueError):
        wr.replace_partition(got, path, values=["a/b"])


def test_number_issues(spark):
    df = spark.createDataFrame([("r", 2, "y"), ("r", 1, "x"), ("s", 1, "z")], "run_id string, o int, code string")
    got = sorted(r["issue_id"] for r in wr.number_issues(df, "o").collect())
    assert got == ["r:0001:x", "r:0002:y", "s:0001:z"]


def test_export_run(spark, sf_dir, tmp_path):
    tables = {n: t.select(*TABLES[n].fieldNames()) for n, t in job_tables(spark, sf_dir).items()}
    paths = wr.export_run(tables, str(tmp_path / "x"), "run_a")
    assert len(paths) == 9 and paths[-1].endswith("canonical_jobs")
    back = rd.read_tables(spark, str(tmp_path / "x"))
    assert {r["run_id"] for r in back["listing_snapshots"].select("run_id").distinct().collect()} == {"run_a"}
    assert back["companies"].count() == tables["companies"].count()
    stored = spark.read.parquet(paths[-1])
    assert len(stored.columns) == 29
    again = canonical_jobs(rd.read_tables(spark, str(tmp_path / "x"), "run_a"))
    assert again.select(sorted(stored.columns)).exceptAll(stored.select(sorted(stored.columns))).count() == 0


def test_csv_round_trip(spark, tmp_path):
    rows = [('Manager, "Growth"', "Product", None, ""), ("line\nbreak", "Other", "Mid", "IC")]
    path = str(tmp_path / "c")
    wr.write_csv(spark.createDataFrame(rows, CSV_LABELS), path)
    got = sorted(tuple(r) for r in rd.read_labels(spark, path, multi_line=True).collect())
    assert got == [('Manager, "Growth"', "Product", None, None), ("line\nbreak", "Other", "Mid", "IC")]


def test_csv_jobs_keep_microseconds(spark, tmp_path):
    at = datetime(2026, 5, 1, 12, 0, 0, 123456)
    names = rd.CSV_JOBS.fieldNames()
    row = tuple(at if n == "scraped_at" else n for n in names)
    wr.write_csv(spark.createDataFrame([row], rd.CSV_JOBS), str(tmp_path / "j"))
    assert tuple(rd.read_csv_jobs(spark, str(tmp_path / "j")).first()) == row


def test_snapshot_files(spark, tmp_path):
    folder = tmp_path / "run" / "search"
    folder.mkdir(parents=True)
    (folder / "q1_p1_abc.html").write_text("<p>a\n\nb</p>", encoding="utf-8")
    row = rd.read_snapshots(spark, str(folder / "*.html")).first()
    assert row["html"] == "<p>a\n\nb</p>" and row["path"].endswith("q1_p1_abc.html")
    assert len(row["content_sha256"]) == 64
    name = spark.range(1).select(rd.snapshot_name("search", F.lit("q1_p1"), F.lit("0123456789abcdef"))).first()
    assert name[0] == "search/q1_p1_0123456789ab.html"


def test_scratch_is_below_the_configured_folder(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(checkpoint_dir(spark))
    assert spark.conf.get("spark.checkpoint.dir") == checkpoint_dir(spark)


def test_no_local_folder_on_a_cluster():
    class Elsewhere:
        conf = {}
        sparkContext = type("Context", (), {"master": "spark://host:7077"})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Elsewhere())


def test_export_loses_what_a_run_has_lost(spark, sf_dir, tmp_path):
    tables = {n: job_tables(spark, sf_dir)[n] for n in TABLES}
    root = str(tmp_path / "export")
    wr.export_run(tables, root, "run_a")
    assert spark.read.parquet(f"{root}/quality_issues").where("run_id = 'run_a'").count() > 0
    wr.export_run({**tables, "quality_issues": tables["quality_issues"].limit(0)}, root, "run_a")
    assert spark.read.schema(TABLES["quality_issues"]).parquet(f"{root}/quality_issues").count() == 0
    wr.export_run(tables, root, "run_b")
    jobs = spark.read.parquet(f"{root}/canonical_jobs").groupBy("run_id").count().collect()
    assert {r["run_id"] for r in jobs} == {"run_a", "run_b"}


def test_replaced_partition_may_come_from_its_own_folder_copy(spark, tmp_path):
    path = str(tmp_path / "t")
    wr.replace_partition(spark.createDataFrame([("a", 1), ("b", 2)], "run_id string, v int"), path, values=["a"])
    wr.replace_partition(spark.createDataFrame([("b", 5)], "run_id string, v int"), path, values=["a", "b"])
    assert [(r.run_id, r.v) for r in spark.read.schema("v int, run_id string").parquet(path).collect()] == [("b", 5)]


def test_csv_is_read_in_splits_unless_told_otherwise(spark, tmp_path):
    path = str(tmp_path / "big")
    spark.range(40_000).selectExpr("repeat('x', 60) AS title").coalesce(1).write.option("header", True).csv(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        assert rd.read_csv(spark, path, "title string").rdd.getNumPartitions() > 4
        assert rd.read_csv(spark, path, "title string", multi_line=True).rdd.getNumPartitions() == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("name", TABLES)
def test_bound_tables_have_the_schema(spark, sf_dir, name):
    df = job_tables(spark, sf_dir)[name]
    for field in TABLES[name].fields:
        assert df.schema[field.name].dataType.simpleString() == field.dataType.simpleString()


def test_page_files_are_written_by_many_tasks(spark, tmp_path):
    from collections import Counter

    from tallyfold.sources.writers import write_page_files

    rows = [(i, f"<p>é {i}</p>") for i in range(200)] + [(7, "again"), (None, "x"), (300, None), (301, "a\nb")]
    pages = spark.createDataFrame(rows, "page_id long, html string").coalesce(1)
    for path in (f"{tmp_path}/a b", f"file:{tmp_path}/c"):
        write_page_files(pages, path, "page_id", "html")
        found = {r.path.rsplit("/", 1)[1]: r for r in rd.read_snapshots(spark, path).collect()}
        assert len(found) == 203 and found["page_id=301.txt"].html == "a\nb\n"
        assert found["page_id=7.txt"].html == "<p>é 7</p>\nagain\n" and found["page_id=300.txt"].html == "\n"
        # One task wrote all of them before, in a folder each.
        folders = Counter(r.path.rsplit("/", 2)[1] for r in found.values())
        assert 8 <= len(folders) <= 4 * spark.sparkContext.defaultParallelism and max(folders.values()) < 60
