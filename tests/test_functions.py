from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyfold.functions import facts as fx
from tallyfold.functions import identity as idn
from tallyfold.functions import text as tt

NOW = datetime(2026, 5, 1, 12, 0)


def values(spark, column, cases, kind="string"):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], f"i int, x {kind}")
    return [r["v"] for r in df.select("i", column.alias("v")).orderBy("i").collect()]


def test_posted_at(spark):
    cases = {
        "1 day ago": timedelta(days=1), "Reposted 7 days ago": timedelta(days=7),
        "Just now": timedelta(0), "Posted today": timedelta(0), "3 weeks ago": timedelta(days=21),
        "2 months ago": timedelta(days=60), "5 minutes ago": timedelta(minutes=5),
        "1hour ago": timedelta(hours=1), "4 days ago": timedelta(days=4),
        "Promoted": None, "30+ days ago": None, "yesterday": None, "an hour ago": None, "": None,
        "99999999999999999999 days ago": None,
    }
    got = values(
        spark, fx.posted_at("x", F.lit("2026-05-01 12:00:00").cast("timestamp_ntz")),
        [*cases, None],
    )
    assert got == [None if d is None else NOW - d for d in cases.values()] + [None]


@pytest.mark.parametrize("mode,expected", [
    ("compatible", [(180000.0, 240000.0), (500000.0, 110000.0), (10000.0, 15000.0),
                    (65000.0, 80000.0), (120500.0, 130000.0), None, None, (90000.0, 95000.0)]),
    ("strict", [(180000.0, 240000.0), None, None, (65000.0, 80000.0), (120500.0, 130000.0), None,
                None, (90000.0, 95000.0)]),
])
def test_salary(spark, mode, expected):
    cases = ["range is $180k - $240k.", "$95,500 - $110,000", "10-15 years", "$65 - $80 per hour",
             "120.5K to 130K", "no numbers", None, "pay 90k–95k"]
    got = values(spark, fx.salary_range("x", mode), cases)
    assert [None if r["salary_min"] is None else (r["salary_min"], r["salary_max"]) for r in got] == expected
    assert [r["salary_currency"] for r in got] == ["USD" if e else None for e in expected]


def test_salary_mode_is_checked():
    with pytest.raises(ValueError):
        fx.salary_range(F.lit("x"), "loose")


def test_skills(spark):
    cases = ["Python, JavaScript and Machine Learning.", "Java javaé éjava_", "go Go GO", None,
             "sparkling sqlite", "machine  learning"]
    assert values(spark, fx.skills("x"), cases) == [
        ["javascript", "machine learning", "python"], ["java"], ["go"], [], [], []
    ]


def test_skills_with_overlapping_terms(spark):
    terms = ("machine learning", "learning", "c++")
    assert values(spark, fx.skills("x", terms), ["Machine learning in C++"]) == [
        ["c++", "learning", "machine learning"]
    ]


def test_infer_workplace(spark):
    cases = ["Hybrid and remote", "fully remotely", "work from home", "onsite", "in office", "", None]
    assert values(spark, fx.infer_workplace("x"), cases) == [
        "Hybrid", "Remote", "Remote", "On-site", "On-site", "Unknown", "Unknown"
    ]


def test_job_id_from_url(spark):
    base = "https://jobs.example.com"
    cases = {
        f"{base}/jobs/view/staff-engineer-at-x-4211112222": "4211112222",
        f"{base}/jobs/view/4222223333/?trackingId=abc": "4222223333",
        f"{base}/jobs/search/?currentJobId=4333334444": "4333334444",
        f"{base}/x?jobId=9&currentJobId=8": "8",
        f"{base}/x?currentJobId=&jobId=7": "7",
        f"{base}/x?currentJobId=a%20b+c": "a b c",
        f"{base}/jobs/view/abc": None,
        f"{base}/app#?currentJobId=55": "55",
        "": None,
    }
    assert values(spark, idn.job_id_from_url("x"), list(cases)) == list(cases.values())


def test_search_url(spark):
    df = spark.createDataFrame([("software engineer", "San Francisco, CA", 7, "f_E=4")],
                               "k string, l string, d int, p string")
    url = df.select(
        idn.search_url("k", "l", "d", "p", F.lit(25)).alias("a"),
        idn.search_url("k", "l", "d", "p", F.lit(0)).alias("b"),
    ).first()
    assert url["a"] == (
        "https://jobs.example.com/jobs/search/?keywords=software+engineer"
        "&location=San+Francisco%2C+CA&f_TPR=r604800&f_E=4&sortBy=DD&start=25"
    )
    assert "start" not in url["b"]
    assert values(spark, idn.quote_plus("x"), ["a~b*c é/&"]) == ["a~b%2Ac+%C3%A9%2F%26"]


def test_hashes(spark):
    row = spark.range(1).select(
        idn.stable_id(F.lit("a"), F.lit("b")).alias("s"), idn.content_hash(F.lit("a")).alias("c"),
        idn.hash32(F.lit("a")).alias("h"),
    ).first()
    assert row["s"] == "q_" + __import__("hashlib").sha1(b"a|b").hexdigest()[:12]
    assert row["c"].startswith("ca978112ca1bbdca")
    assert row["h"] == 0x0CC175B9
    one, two = {"b": F.lit(1), "a": F.lit(None).cast("int")}, {"a": F.lit(None).cast("int"), "b": F.lit(1)}
    got = spark.range(1).select(idn.config_hash(one).alias("x"), idn.config_hash(two).alias("y")).first()
    assert got["x"] == got["y"] == __import__("hashlib").sha256(b'{"a":null,"b":1}').hexdigest()


def test_text(spark):
    cases = ["  A \tB\n", "", None, "x  y"]
    assert values(spark, tt.norm_text("x"), cases) == ["a b", "", "", "x y"]
    assert values(spark, tt.clean_text("x"), cases) == ["A B", "", "", "x y"]
    assert values(spark, tt.clean_company("x"), ["\t Acme ", "  ", "", None]) == [
        "Acme", "N/A", "N/A", "N/A"
    ]
    assert values(spark, tt.clean_title("x"), [
        " Chef - Hiring multiple candidates", "Chef Hiring multiple candidate", "Hiring multiple candidates x"
    ]) == ["Chef", "Chef", "Hiring multiple candidates x"]
    assert values(spark, tt.keeps_title("x", min_length=5), ["Chef", "Chefs", "Sign In now", None]) == [
        False, True, False, False
    ]
    assert values(spark, tt.location_fallback("x", F.lit("Here")), ["N/A", "There", None]) == [
        "Here", "There", None
    ]


def test_word_edges(spark):
    cases = ["the ceo", "éceo", "ceo_", "ceo2", "ceo-x", "CEO"]
    assert values(spark, tt.has_word(F.col("x"), "ceo|cto"), cases) == [
        True, False, False, False, True, False
    ]
    assert values(spark, tt.has_word(F.col("x"), "c.o"), ["the cfo", "cfoo"]) == [True, False]


def test_confidences(spark):
    df = spark.createDataFrame([("t", "c", "l", "p", "h"), ("t", None, "", None, "h")],
                               "t string, c string, l string, p string, h string")
    got = [r[0] for r in df.select(fx.listing_confidence("t", "c", "l", "p", "h")).collect()]
    assert got == pytest.approx([1.0, 0.6])


def test_json_fields(spark):
    row = spark.range(1).select(
        tt.json_fields(F.create_map(F.lit("b"), F.lit("1"), F.lit("a"), F.lit("2")), "map").alias("m"),
        tt.json_fields(F.array(F.lit("x")), "array").alias("a"),
    ).first()
    assert (row["m"], row["a"]) == ('{"a":"2","b":"1"}', '["x"]')
