"""Physical plans: what must not be in them, and what must."""

import re
from pathlib import Path

import pytest

from tallyfold.operators import canonical as cn
from tallyfold.operators import dedupe as dd
from tallyfold.operators import shares as sh
from tallyfold.operators import upsert as up
from tallyfold import session
from tallyfold.plans import bindings as b
from tallyfold.plans import market
from tallyfold.plans.catalog import QUERIES

def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def written(monkeypatch):
    """Columns of every intermediate that a query writes."""
    found, write = [], market.stored
    monkeypatch.setattr(market, "stored", lambda df, name: found.append(df.columns) or write(df, name))
    return found


@pytest.mark.parametrize("name", ["city_ai_share", "canonical_jobs", "quality_issues", "top_companies", "run_progress"])
def test_reports_write_nothing(spark, sf_dir, name, monkeypatch):
    def refuse(*_):
        raise AssertionError("a report wrote a table")

    monkeypatch.setattr(session, "scratch_path", refuse)
    monkeypatch.setattr(market, "stored", refuse)
    assert QUERIES[name](spark, sf_dir).columns


def test_the_report_writes_narrow_jobs_once(spark, sf_dir, written):
    QUERIES["market_report"](spark, sf_dir)
    assert written == [list(market.REPORT_COLUMNS)]


def test_labels_are_not_joined_to_their_own_rows(spark, sf_dir):
    """One window finds the best rows, and their labels come from the same row."""
    plan = plan_of(QUERIES["city_ai_share"](spark, sf_dir))
    assert plan.count("Window [") == 1 and "ReadSchema: struct<doc_id:bigint,lang:string>" in plan


def test_coverage_shuffles_the_facts_once(spark, sf_dir):
    listings = session.stored(b.v_listings(spark, sf_dir), "listings")
    frame = session.stored(b.frame_of(listings), "frame")
    plan = plan_of(cn.frame_coverage(frame, listings))
    # Every exchange but that of the distinct jobs is over rows as few as the frame has.
    assert plan.count("job_id#") and plan.count("Cartesian") == 0
    assert len(re.findall(r"Exchange hashpartitioning\(run_id#\d+, city_key#\d+, job_id#\d+", plan)) == 1
    assert "hashpartitioning(query_id#" not in plan


def test_upsert_moves_only_keys_of_the_stored_rows(spark):
    old = spark.range(100).selectExpr("id AS k", "id AS v")
    new = spark.createDataFrame([(1, 2)], "k long, v long")
    plan = plan_of(up.upsert_by_key(old, new, ["k"]))
    assert "LeftAnti" in plan and "FullOuter" not in plan


def test_no_window_pulls_a_table_into_one_task():
    """The one window without partitions numbers the rows of a finished top-k."""
    found = [
        (path.name, line.strip())
        for path in Path(sh.__file__).parents[1].rglob("*.py")
        for line in path.read_text(encoding="utf-8").splitlines()
        if re.search(r"Window\.orderBy", line)
    ]
    assert [name for name, _ in found] == ["shares.py"]


def test_columns_and_filters_reach_the_scan(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").where("l_quantity > 10")
    plan = plan_of(sh.value_shares(lines, "l_returnflag"))
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)]" in plan
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string>" in plan


def test_narrow_reports_do_not_read_the_texts(spark, sf_dir):
    plan = plan_of(QUERIES["distinct_jobs"](spark, sf_dir))
    assert "props" not in plan and "value" not in plan.replace("partial_", "")


def test_limit_reaches_below_the_exchange(spark, sf_dir):
    orders = b.load(spark, sf_dir, "orders")
    plan = plan_of(dd.keep_first(orders, ["o_custkey"], [("o_orderdate", "asc")]))
    assert plan.count("WindowGroupLimit") == 2


def test_classification_is_one_projection(spark, sf_dir):
    plan = plan_of(QUERIES["classify_track"](spark, sf_dir))
    assert "Exchange" not in plan and "Python" not in plan


def test_a_filter_on_the_posting_date_derives_it_once(spark, sf_dir):
    from tallyfold.operators.profile import date_window_violations
    from tallyfold.plans.bindings import v_listings

    late = date_window_violations(v_listings(spark, sf_dir), 7).select("snapshot_id", "posted_at")
    plan = late._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("get_json_object") <= 3 and plan.count("regexp_replace") <= 2


def test_tables_made_from_a_kept_one_read_it_back(spark, sf_dir):
    made = {}

    def keep(df, name):
        made[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return session.stored(df, name)

    kept, plain = b.job_tables(spark, sf_dir, keep=keep), b.job_tables(spark, sf_dir)
    for name in kept:
        columns = [f.name for f in kept[name].schema if f.dataType.typeName() != "map"]
        assert kept[name].columns == plain[name].columns
        assert kept[name].count() == plain[name].count()
        assert plain[name].select(columns).exceptAll(kept[name].select(columns)).count() == 0
    assert [n for n in made if "get_json_object" in made[n]] == ["listing_snapshots"]
    assert [n for n in made if "regexp_extract_all" in made[n]] == ["job_details"]
    assert sorted(made) == sorted(kept)


def test_export_published_derives_the_given_tables_once(spark, sf_dir, monkeypatch):
    from tallyfold.plans import catalog_stored

    derived, write = [], catalog_stored.stored

    def seen(df, name):
        if "get_json_object" in df._jdf.queryExecution().optimizedPlan().toString():
            derived.append(name)
        return write(df, name)

    monkeypatch.setattr(catalog_stored, "stored", seen)
    assert QUERIES["export_published"](spark, sf_dir).count() == 9
    assert derived == ["listing_snapshots"]


def test_labels_do_not_shuffle_descriptions_that_have_a_hint(spark, sf_dir):
    plan = plan_of(market.classify_run(b.job_tables(spark, sf_dir, keep=session.stored)))
    shipped = re.findall(r"Exchange.*\n[^\n]*Project \[(.*)\]\n", plan)
    assert any(columns.endswith("AS _unhinted#" + columns.rpartition("#")[2]) for columns in shipped)
    assert not any(re.search(r"(^|, )description#\d+(,|$)", columns) for columns in shipped)


def test_spellings_are_counted_before_they_are_cleaned(spark, sf_dir):
    listings = session.stored(b.v_listings(spark, sf_dir), "listings")
    plan = plan_of(b.dimension(listings, "company", "company_key"))
    aggregates = [n for n in plan.splitlines() if "Aggregate" in n]
    assert "HashAggregate(keys=[company" in aggregates[-1] and "regexp_replace" not in aggregates[-1]


def test_best_rows_are_sorted_by_job_first(spark, sf_dir):
    plan = plan_of(dd.dedupe_best(session.stored(b.v_listings(spark, sf_dir), "listings")))
    sorts = re.findall(r"Sort \[(\w+)#", plan)
    assert sorts and set(sorts) == {"job_id"}
