from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyfold.operators import canonical as cn
from tallyfold.operators import dedupe as dd
from tallyfold.operators import overlap as ov
from tallyfold.operators import profile as pf
from tallyfold.operators import shares as sh
from tallyfold.operators import upsert as up

T0 = datetime(2026, 5, 1)


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


# --- Dedupe ------------------------------------------------------------------------------

SNAP = "snapshot_id string, run_id string, job_id string, parser_confidence double, " \
       "scraped_at timestamp_ntz, page int, rank int"


def test_dedupe_order_and_ties(spark):
    later = T0 + timedelta(hours=1)
    df = spark.createDataFrame([
        ("a", "r", "1", 0.8, later, 1, 1), ("b", "r", "1", 0.9, T0, 5, 5),
        ("c", "r", "2", 0.9, T0, 1, 1), ("d", "r", "2", 0.9, later, 9, 9),
        ("e", "r", "3", 0.9, T0, 2, 1), ("f", "r", "3", 0.9, T0, 1, 9),
        ("h", "r", "4", 0.9, T0, 1, 2), ("g", "r", "4", 0.9, T0, 1, 2),
        ("i", "r", "5", None, T0, 1, 1), ("j", "r", "5", 0.1, T0, 1, 1),
        ("k", "s", "1", 0.1, T0, 1, 1),
    ], SNAP)
    best = dd.dedupe_best(df)
    assert rows(best.select("run_id", "job_id", "snapshot_id"), "run_id", "job_id") == [
        ("r", "1", "b"), ("r", "2", "d"), ("r", "3", "f"), ("r", "4", "g"), ("r", "5", "j"),
        ("s", "1", "k"),
    ]


def test_dedupe_ships_one_row_per_key_and_task(spark):
    plan = dd.dedupe_best(spark.createDataFrame([], SNAP))._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert text.index("WindowGroupLimit", text.index("Exchange")) > text.index("Exchange")


def test_dedupe_with_a_hot_key_matches_brute_force(spark):
    n = 6000
    df = spark.range(0, n, 1, 8).select(
        F.col("id").cast("string").alias("snapshot_id"), F.lit("r").alias("run_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 100).cast("string")).alias("job_id"),
        ((F.col("id") * 37) % 101 / 100.0).alias("parser_confidence"),
        F.lit(T0).cast("timestamp_ntz").alias("scraped_at"), F.lit(1).alias("page"),
        (F.col("id") % 7).cast("int").alias("rank"),
    )
    expected = {}
    for i in range(n):
        key = "hot" if i % 3 == 0 else str(i % 100)
        value = (-((i * 37) % 101 / 100.0), i % 7, str(i))
        expected[key] = min(expected.get(key, value), value)
    got = {r["job_id"]: r["snapshot_id"] for r in dd.dedupe_best(df).collect()}
    assert got == {k: v[2] for k, v in expected.items()}


def test_keep_first_and_exclude_seen(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 2, "b"), (2, None, "z"), (2, 9, "y")],
                               "k int, at int, v string")
    assert rows(dd.keep_first(df, ["k"], [("at", "asc")]), "k") == [(1, 2, "b"), (2, 9, "y")]
    seen = spark.createDataFrame([(1,)], "k int")
    assert rows(dd.exclude_seen(df, seen, ["k"]).select("k").distinct(), "k") == [(2,)]


def test_top_per_group_ties_and_null_group(spark):
    df = spark.createDataFrame(
        [("a", "y")] * 2 + [("a", "x")] * 2 + [("a", "z")] + [(None, "q")], "g string, v string"
    )
    top = dd.top_per_group(df, "g", "v", 2)
    assert rows(top.select("g", "v", "pos", "n", "group_n"), F.col("g").asc_nulls_last(), "pos") == [
        ("a", "x", 1, 2, 5), ("a", "y", 2, 2, 5), (None, "q", 1, 1, 1)
    ]


def test_union_batches_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(2,)], "k int")
    assert rows(dd.union_batches(a, b), "k") == [(1, "x"), (2, None)]


# --- Shares ------------------------------------------------------------------------------


def test_weighted_shares_edge_weights(spark):
    df = spark.createDataFrame(
        [("a", 0.5), ("a", 0.0), ("b", None), ("", 0.25), (None, 1e-12)], "s string, w double"
    )
    got = {r["segment"]: (r["n"], r["weighted"]) for r in sh.weighted_shares(df, "s", "w").collect()}
    assert got["a"] == (2, 3.0)
    assert got["b"] == (1, 1.0)
    assert got["Unknown"][0] == 2 and got["Unknown"][1] == pytest.approx(4.0 + 1e9)


def test_shares_of_nothing(spark):
    empty = spark.createDataFrame([], "s string, w double")
    assert sh.value_shares(empty, "s").collect() == []
    assert sh.weighted_shares(empty, "s", "w").collect() == []
    assert tuple(sh.concentration(empty, "s").first())[0] == 0


def test_crosstab_wide(spark):
    df = spark.createDataFrame([("r1", "b"), ("r1", "a"), ("r1", "a"), (None, "b"), ("r2", "")],
                               "r string, c string")
    wide = sh.crosstab(df, "r", "c", ["Unknown", "a", "b"])
    assert wide.columns == ["row", "Unknown", "a", "b"]
    assert rows(wide, "row") == [("Unknown", 0, 0, 1), ("r1", 0, 2, 1), ("r2", 1, 0, 0)]


def test_crosstab_has_no_limit(spark):
    df = spark.range(1500).select(F.lit("r").alias("r"), F.col("id").cast("string").alias("c"))
    assert sh.crosstab_long(df, "r", "c").count() == 1500


def test_group_maps(spark):
    df = spark.createDataFrame([("x",), ("y",), ("y",), ("z",)], "v string")
    groups = {"g1": ("x",), "g2": ("y", "unused")}
    got = {r["segment"]: (r["n"], r["share"]) for r in sh.group_map_shares(df, "v", groups).collect()}
    assert got == {"g1": (1, 0.25), "g2": (2, 0.5)}
    two = {(r["segment"], r["member"], r["level"]): r["n"]
           for r in sh.two_level_shares(df, "v", groups).collect()}
    assert two == {("g1", "x", 0): 1, ("g1", None, 1): 1, ("g2", "y", 0): 2, ("g2", None, 1): 2}


def test_concentration(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 3 + [("c",)] * 2 + [(None,)], "h string")
    row = sh.concentration(df, "h", (1, 2)).first()
    assert tuple(row) == (3, 10, 5, 8, 0.5, 0.8)


def test_combo_and_ratio(spark):
    df = spark.createDataFrame([("S", "E"), ("S", "E"), ("J", None)], "a string, b string")
    assert [tuple(r) for r in sh.combo_counts(df, ["a", "b"]).collect()] == [("S E", 2, 1.0)]
    assert sh.ratio_metric(df, F.col("a") == "S", F.col("a") == "X").first()["ratio"] is None


def test_signal_shares(spark):
    df = spark.createDataFrame([("Uses AI",), ("maintain",), (None,)], "t string")
    got = sh.signal_shares(df, F.col("t"), {"ai": "ai|ml"}).first()
    assert (got["n"], got["share"]) == (1, pytest.approx(1 / 3))


def test_search_accuracy_keeps_first_roles(spark):
    df = spark.createDataFrame(
        [("eng", "Eng a", r) for r in "aabbcd"] + [("eng", "other", "a")],
        "term string, title string, role string",
    )
    row = sh.search_accuracy(df, "term", "title", "role").first()
    assert (row["jobs"], row["top_roles"]) == (7, "a, b, c")
    assert row["match_rate"] == pytest.approx(6 / 7)


# --- Overlap, joins ----------------------------------------------------------------------


def test_overlap_of_nothing(spark):
    row = ov.overlap_metrics(spark.createDataFrame([], "job_id string"), "job_id").first()
    assert tuple(row) == (0, 0, 0, 0.0, 0)


def test_discovery_rollup_without_frame_rows(spark):
    listings = spark.createDataFrame([("r", "1", "q1"), ("r", "1", "q1"), ("r", "1", "q2"), ("r", "2", "qx")],
                                     "run_id string, job_id string, query_id string")
    frame = spark.createDataFrame([("q1", "kb", "c"), ("q2", "ka", "c")],
                                  "query_id string, keyword string, city_name string")
    assert rows(ov.discovery_rollup(listings, frame), "job_id") == [
        ("r", "1", 3, 2, "ka, kb", "c"), ("r", "2", 1, 1, None, None)
    ]


def test_pending_details_limit(spark):
    listings = spark.createDataFrame([("r", str(i), f"u{i}") for i in (1, 10, 2)],
                                     "run_id string, job_id string, url string")
    details = spark.createDataFrame([("r", "10")], "run_id string, job_id string")
    for limit, expected in ((None, ["1", "2"]), (0, ["1", "2"]), (1, ["1"])):
        got = cn.pending_details(listings, details, limit).collect()
        assert [r["job_id"] for r in got] == expected


def test_label_eval_counts_null_as_a_mismatch(spark):
    p = spark.createDataFrame([(1, "a"), (2, None), (3, None)], "id int, l string")
    e = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "id int, l string")
    assert rows(cn.label_eval(p, e, "id", ["l"]), "id") == [(3, None, "b")]


# --- Profiles ----------------------------------------------------------------------------


def test_required_missing_counts_blank(spark):
    df = spark.createDataFrame([("a", None), (" ", "x"), ("", "\t")], "title string, url string")
    got = rows(pf.required_missing(df, ["title", "url"]), "field")
    assert got == [("title", 2, 3, 2 / 3), ("url", 1, 3, 1 / 3)]


def test_validate_rows(spark):
    df = spark.createDataFrame([
        ("t", "https://a.b/c", 1.0), ("  ", "https://a.b", 0.5), ("t", "ftp://a", 0.5),
        ("t", "https:///x", 0.5), ("t", "HTTP://a", 0.0), ("t", "http://a", 1.01),
        ("t", None, 0.5), ("t", "http://a", None),
    ], "title string, url string, parser_confidence double")
    good, bad = pf.validate_rows(df)
    assert (good.count(), bad.count()) == (2, 6)


def test_date_window_edge(spark):
    df = spark.createDataFrame([
        (1, T0 - timedelta(days=8), T0), (2, T0 - timedelta(days=8, seconds=1), T0), (3, None, T0)
    ], "i int, posted_at timestamp_ntz, scraped_at timestamp_ntz")
    assert [r["i"] for r in pf.date_window_violations(df, 7).collect()] == [2]


# --- Upserts ------------------------------------------------------------------------------


def test_upsert_replay_changes_nothing(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, ver int")
    batch = spark.createDataFrame([(2, "c", 1), (2, "d", 2), (3, "e", 1)], "k int, v string, ver int")
    once = up.upsert_by_key(old, batch, ["k"], "ver")
    assert rows(once, "k") == [(1, "a", 1), (2, "d", 2), (3, "e", 1)]
    assert rows(up.upsert_by_key(once, batch, ["k"], "ver"), "k") == rows(once, "k")


def test_upsert_with_map_column(spark):
    old = spark.createDataFrame([(1, {"a": "1"})], "k int, m map<string,string>")
    new = spark.createDataFrame([(1, {"b": "2"}), (2, {})], "k int, m map<string,string>")
    assert rows(up.upsert_by_key(old, new, ["k"]), "k") == [(1, {"b": "2"}), (2, {})]


def test_upsert_keeps_status(spark):
    schema = "k int, w double, status string"
    old = spark.createDataFrame([(1, 0.1, "complete"), (2, 0.2, None)], schema)
    new = spark.createDataFrame([(1, 0.5, "pending"), (2, None, "pending"), (3, 0.7, "pending")], schema)
    assert rows(up.upsert_by_key(old, new, ["k"], keep=["status"]), "k") == [
        (1, 0.5, "complete"), (2, None, None), (3, 0.7, "pending")
    ]


def test_upsert_replaces_whole_rows_and_keeps_absent_columns(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (None, "n", 2.0), (3, "c", 3.0)], "k int, s string, w double")
    new = spark.createDataFrame([(1, "x", None), (None, "m", 5.0), (4, "d", 4.0)], "k int, s string, w double")
    assert set(rows(up.upsert_by_key(old, new, ["k"]), "s")) == {
        (3, "c", 3.0), (4, "d", 4.0), (None, "m", 5.0), (1, "x", None)
    }
    assert set(rows(up.upsert_by_key(old, new.drop("w"), ["k"]), "s")) == {
        (3, "c", 3.0), (4, "d", None), (None, "m", 2.0), (1, "x", 1.0)
    }


def test_insert_if_absent_puts_undated_rows_last(spark):
    dim = spark.createDataFrame([], "key string, canonical_name string, first_seen_at timestamp_ntz")
    new = spark.createDataFrame([("ACME", None), ("Acme", T0)], "name string, at timestamp_ntz")
    assert rows(up.insert_if_absent(dim, new, "name", "at"), "key") == [("acme", "Acme", T0)]


def test_insert_if_absent(spark):
    dim = spark.createDataFrame([("acme", "ACME", T0)], "key string, canonical_name string, first_seen_at timestamp_ntz")
    new = spark.createDataFrame([
        (" Acme ", T0), ("Beta  Co", T0 + timedelta(1)), ("beta co", T0), ("  ", T0), (None, T0)
    ], "name string, at timestamp_ntz")
    out = up.insert_if_absent(dim, new, "name", "at")
    assert rows(out, "key") == [("acme", "ACME", T0), ("beta co", "beta co", T0)]
    assert rows(up.insert_if_absent(out, new, "name", "at"), "key") == rows(out, "key")


def test_insert_if_absent_of_many_spellings_matches_brute_force(spark):
    dim = spark.createDataFrame([("known", "Known", T0)], "key string, canonical_name string, first_seen_at timestamp_ntz")
    given = [
        (["Acme", " acme", "ACME ", "ac  me", "AC ME", "known", " ", "", None, "\u00a0", "Zeta\t"][i * 7 % 11],
         None if i % 5 == 0 or i % 11 == 3 else T0 + timedelta(i * 13 % 17))
        for i in range(200)
    ]
    first = {}
    for name, at in given:
        key = " ".join((name or "").lower().split())
        if key and key != "known":
            value = (at is None, at or T0, name.strip(" "))
            first[key] = min(first.get(key, value), value)
    expected = [("known", "Known", T0), *[(k, name, None if undated else at) for k, (undated, at, name) in first.items()]]
    new = spark.createDataFrame(given, "name string, at timestamp_ntz").repartition(7)
    assert rows(up.insert_if_absent(dim, new, "name", "at"), "key") == sorted(expected)


def test_descriptions_are_read_where_a_job_has_no_hint(spark):
    from tallyfold.plans.market import classify_best

    best = spark.createDataFrame(
        [("r", j, "Engineer") for j in ("1", "2", "3", "4")], "run_id string, job_id string, title string")
    details = spark.createDataFrame([
        ("r", "1", "fully remote", None), ("r", "2", "fully remote", ""), ("r", "3", "fully remote", "Hybrid"),
    ], "run_id string, job_id string, description string, workplace_type string")
    got = classify_best({"best_listings": best, "job_details": details})
    assert rows(got.select("job_id", "workplace", "description"), "job_id") == [
        ("1", "Remote", "fully remote"), ("2", "Remote", "fully remote"), ("3", "Hybrid", "fully remote"),
        ("4", "Unknown", None),
    ]
    assert got.columns[:5] == ["run_id", "job_id", "title", "description", "workplace_hint"]


def test_update_status(spark):
    schema = "query_id string, status string, result_count int, pages_collected int, last_error string"
    frame = spark.createDataFrame([("a", "failed", 3, 1, "boom"), ("b", "pending", None, 0, None)], schema)
    u = spark.createDataFrame([("a", "complete", None, 2, None), ("zz", "x", 1, 1, "y")], schema)
    assert rows(up.update_status(frame, u), "query_id") == [
        ("a", "complete", 3, 2, None), ("b", "pending", None, 0, None)
    ]


def test_run_guard_fails_on_other_config(spark):
    runs = spark.createDataFrame([("r", "h1")], "run_id string, config_hash string")
    same = spark.createDataFrame([("r", "h1"), ("n", "h9")], "run_id string, config_hash string")
    got = rows(up.run_guard(runs, same).select("run_id", "action", "status"), "run_id")
    assert got == [("n", "new", "running"), ("r", "resumed", "running")]
    other = spark.createDataFrame([("r", "h2")], "run_id string, config_hash string")
    with pytest.raises(Exception, match="different config hash"):
        up.run_guard(runs, other).collect()
    assert up.run_guard(runs, other, enforce=False).first()["action"] == "conflict"
