from datetime import datetime

import pytest

from tallyfold.operators import quality as ql

T0 = datetime(2026, 5, 1)
LISTING = ("run_id string, job_id string, query_id string, title string, company string, "
           "location string, url string, posted_at timestamp_ntz, scraped_at timestamp_ntz")
CITIES = [("sf", "SF"), ("ny", "NY")]


def tables(spark, listings=(), frame=(), labels=(), runs=("r",)):
    return {
        "search_runs": spark.createDataFrame([(r,) for r in runs], "run_id string"),
        "listing_snapshots": spark.createDataFrame(list(listings), LISTING),
        "search_queries": spark.createDataFrame(
            list(frame), "run_id string, query_id string, city_key string, result_count int"
        ),
        "classifications": spark.createDataFrame(list(labels), "run_id string, role_family string"),
    }


def listing(i, job=None, run="r", query="q1", title="t", company="c", location="l", url="u",
            posted=None):
    return (run, str(job if job is not None else i), query, title, company, location, url, posted, T0)


def codes(spark, *, cities=True, **parts):
    metrics = ql.quality_metrics(tables(spark, **parts), CITIES, 7)
    issues = ql.quality_issues(metrics, check_cities=cities).orderBy("issue_id").collect()
    return [(r["code"], r["severity"]) for r in issues], issues


def test_empty_run(spark):
    found, issues = codes(spark)
    assert found == [
        ("no_listings", "error"), ("low_city_sample", "warning"), ("low_city_sample", "warning"),
        ("no_classifications", "warning"),
    ]
    assert issues[0]["issue_id"] == "r:0001:no_listings"
    assert issues[2]["message"] == "Sample below 25 jobs in NY"
    assert issues[2]["details"] == {"city_key": "ny", "jobs": "0"}


def healthy():
    return dict(
        listings=[listing(i, query="q1" if i < 30 else "q2") for i in range(60)],
        frame=[("r", "q1", "sf", 30), ("r", "q2", "ny", 30)],
        labels=[("r", "Product")] * 10,
    )


def test_healthy_run(spark):
    assert codes(spark, **healthy())[0] == []


def test_missing_rate_must_exceed_limit(spark):
    data = healthy()
    rows = data["listings"]
    at_limit = rows[:57] + [listing(i, query="q2", company="") for i in range(57, 60)]
    assert codes(spark, **{**data, "listings": at_limit})[0] == []
    above = rows[:56] + [listing(i, query="q2", company=None) for i in range(56, 60)]
    found, issues = codes(spark, **{**data, "listings": above})
    assert found == [("high_null_company", "warning")]
    assert issues[0]["message"] == "6.7% of the listings lack a value in company."
    assert issues[0]["details"] == {"missing": "4", "total": "60"}


def test_overlap_note(spark):
    data = healthy()
    data["listings"].append(listing(60, job=0))
    found, issues = codes(spark, **data)
    assert found == [("discovery_overlap_deduped", "info")]
    assert issues[0]["details"]["duplicate_discovery_paths"] == "1"
    counts = ql.qa_summary(tables(spark)["search_runs"], spark.createDataFrame(issues)).first()
    assert (counts["actionable"], counts["info_notes"]) == (0, 1)


def test_low_city_and_smoke_switch(spark):
    data = healthy()
    data["listings"] = [listing(i, query="q1" if i < 36 else "q2") for i in range(60)]
    assert codes(spark, **data)[0] == [("low_city_sample", "warning")]
    assert codes(spark, cities=False, **data)[0] == []


@pytest.mark.parametrize("zero,fires", [(1, False), (2, True)])
def test_zero_results(spark, zero, fires):
    data = healthy()
    data["frame"] += [("r", f"z{i}", "sf", None if i else 0) for i in range(zero)]
    data["frame"] += [("r", "full", "sf", 3)]
    expected = [("many_zero_result_queries", "warning")] if fires else []
    assert codes(spark, **data)[0] == expected


@pytest.mark.parametrize("labels,expected", [
    (["Executive"] * 3 + ["Product"] * 22, []),
    (["Executive"] * 4 + ["Program"] * 21, ["executive_share_spike"]),
    (["SWE"], ["missing_product_program"]),
    (["Other"] * 4 + ["Product"] * 21, ["high_other_share"]),
    (["Other"], ["missing_product_program", "high_other_share"]),
    ([], ["no_classifications"]),
])
def test_label_rules(spark, labels, expected):
    data = healthy()
    data["labels"] = [("r", x) for x in labels]
    assert [c for c, _ in codes(spark, **data)[0]] == expected


def test_date_window(spark):
    data = healthy()
    data["listings"][0] = listing(0, posted=datetime(2026, 4, 23))
    assert codes(spark, **data)[0] == []
    data["listings"][0] = listing(0, posted=datetime(2026, 4, 22, 23))
    assert codes(spark, **data)[0] == [("date_window_violations", "warning")]


def test_runs_are_judged_apart(spark):
    data = healthy()
    data["listings"].append(listing(1, run="s"))
    metrics = ql.quality_metrics(tables(spark, runs=("r", "s"), **data), CITIES, 7)
    issues = ql.quality_issues(metrics)
    assert {r["run_id"] for r in issues.collect()} == {"s"}


def test_order_of_issues(spark):
    df = spark.createDataFrame(
        [("1", "info", "a"), ("2", "error", "z"), ("3", "warning", "b"), ("4", "warning", "a")],
        "issue_id string, severity string, code string",
    )
    assert [r["issue_id"] for r in ql.order_issues(df).collect()] == ["2", "4", "3", "1"]
    assert [r["issue_id"] for r in ql.order_issues(df, by_text=True).collect()] == ["4", "3", "1", "2"]
    assert ql.actionable_issues(df).count() == 3
