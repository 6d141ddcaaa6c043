"""Labels written by hand, so that a wrong rule cannot confirm itself."""

import pytest
from pyspark.sql import functions as F

from tallyfold.functions.rules import Rule, label_by_rules
from tallyfold.operators import classify as cl
from tallyfold.plans import taxonomy as tx
from tallyfold.plans.bindings import BASE_TITLES
from tests.title_labels import TITLES

# title, family, seniority, track
LABELS = [
    ("Chief Data Officer", "Executive", "Executive", "Executive"),
    ("Chief of Staff, Product", "Management", "Director+", "Manager"),
    ("Staff Software Engineer, Infrastructure", "SWE", "Staff+", "IC"),
    ("Technical Program Manager, AI Platform", "Program", "Manager", "Manager"),
    ("Firmware Engineer, ML Acceleration", "Hardware/Embedded", "Mid", "IC"),
    ("Director, Product Manager", "Management", "Director+", "Manager"),
    ("Lead Manager", "Management", "Senior", "Manager"),
    ("Product Manager", "Product", "Manager", "Manager"),
    ("Product Manager, Growth", "Product", "Manager", "Manager"),
    ("Product Owner", "Product", "Mid", "Manager"),
    ("Entry Level Product Manager", "Product", "Entry", "Manager"),
    ("VP of Engineering", "Management", "Director+", "Manager"),
    ("Head of Data", "Management", "Director+", "Manager"),
    ("Senior Recruiter", "People/Recruiting", "Senior", "Non-technical"),
    ("Engineering Manager", "Management", "Manager", "Manager"),
    ("Staff Development Manager", "Management", "Staff+", "Manager"),
    ("Developer Advocate", "Developer Relations", "Mid", "IC"),
    ("Sales Engineer", "Solutions/Sales Engineering", "Mid", "IC"),
    ("Solution Architect", "Solutions/Sales Engineering", "Mid", "IC"),
    ("Presales Consultant", "Solutions/Sales Engineering", "Mid", "IC"),
    ("Data Annotator", "Data Operations/Annotation", "Mid", "IC"),
    ("Data Labelling Specialist", "Data Operations/Annotation", "Mid", "IC"),
    ("QA Engineer", "QA/Test", "Mid", "IC"),
    ("Application Security Engineer", "Security", "Mid", "IC"),
    ("Cybersecurity Engineer", "Security", "Mid", "IC"),
    ("Senior ASIC Engineer", "Hardware/Embedded", "Senior", "IC"),
    ("ASIC Engineer", "Other", "Mid", "IC"),
    ("Robotics Engineer", "Robotics/Autonomy", "Mid", "IC"),
    ("Computer Vision Engineer", "AI/ML", "Mid", "IC"),
    ("MLOps Engineer", "AI/ML", "Mid", "IC"),
    ("AI Applied Research Engineer", "AI/ML", "Mid", "IC"),
    ("Data Scientist", "Data Science", "Mid", "IC"),
    ("Data Science Intern", "Data Science", "Intern", "IC"),
    ("Principal Scientist", "Research", "Staff+", "IC"),
    ("Analytics Engineer", "Data Engineering", "Mid", "IC"),
    ("Data Infrastructure Lead", "Data Engineering", "Senior", "IC"),
    ("Data Analyst", "Analytics/BI", "Mid", "IC"),
    ("Site Reliability Engineer", "DevOps/SRE", "Mid", "IC"),
    ("Cloud Engineer", "Infrastructure/Platform", "Mid", "IC"),
    ("Platform Engineer", "Infrastructure/Platform", "Mid", "IC"),
    ("Help Desk Technician", "IT/Support", "Mid", "IC"),
    ("Principal Product Designer", "Design", "Staff+", "IC"),
    ("UX Researcher", "Design", "Mid", "IC"),
    ("Product Analyst", "Product", "Mid", "Manager"),
    ("Customer Success Associate", "Customer Success/Implementation", "Mid", "Non-technical"),
    ("Marketing Specialist", "Marketing/Growth", "Mid", "Non-technical"),
    ("Registered Nurse", "Healthcare/Clinical", "Mid", "Non-technical"),
    ("Retail Cashier", "Retail/Service", "Mid", "Non-technical"),
    ("Procurement Specialist", "Finance/Investment", "Mid", "Non-technical"),
    ("Construction Worker", "Facilities/Field Ops", "Mid", "Non-technical"),
    ("Business Analyst", "Business/Ops", "Mid", "Non-technical"),
    ("Office Assistant", "Admin/Operations", "Mid", "Non-technical"),
    ("Math Tutor", "Education/Training", "Mid", "Non-technical"),
    ("Software Engineer Intern", "SWE", "Intern", "IC"),
    ("New Grad Frontend Engineer", "SWE", "Entry", "IC"),
    ("iOS Engineer", "SWE", "Mid", "IC"),
    ("C++ Developer", "SWE", "Mid", "IC"),
    ("C++ Expert", "Other", "Mid", "IC"),
    ("C++11 Expert", "SWE", "Mid", "IC"),
    ("Software Enginner", "SWE", "Mid", "IC"),
    ("Engineer II (Software)", "SWE", "Mid", "IC"),
    ("Office Manager", "Management", "Manager", "Manager"),
    ("Barista", "Other", "Mid", "IC"),
    ("Éceo Assistant", "Other", "Mid", "IC"),
    ("Internal Auditor", "Other", "Mid", "IC"),
    ("Senior  Product \t Manager", "Product", "Senior", "Manager"),
    ("  DATA   ENGINEER ", "Data Engineering", "Mid", "IC"),
    *TITLES,
]


@pytest.fixture(scope="module")
def labelled(spark):
    df = spark.createDataFrame(LABELS, "title string, f string, s string, t string")
    return {r["title"]: r for r in cl.classify_jobs(df).collect()}


@pytest.mark.parametrize("title,family,seniority,track", LABELS)
def test_labels(labelled, title, family, seniority, track):
    row = labelled[title]
    assert (row["role_family"], row["seniority"], row["track"]) == (family, seniority, track)


def test_at_least_300_titles_reach_every_rule(spark):
    assert len({t for t, *_ in LABELS}) >= 300
    found = spark.createDataFrame([(t,) for t, *_ in LABELS], "t string").select(cl.role_rule(F.lower("t")).alias("r"))
    assert {r["r"] for r in found.distinct().collect()} == set(range(len(tx.ROLE_RULES) + 1))


def test_labels_are_members_of_the_closed_sets(spark):
    titles = [(p + t,) for t in BASE_TITLES for p in ("", "Senior ", "Junior ", "Principal ")]
    rows = cl.classify_jobs(spark.createDataFrame(titles, "title string")).collect()
    assert {r["role_family"] for r in rows} == set(tx.ROLE_FAMILIES)
    assert {r["seniority"] for r in rows} == set(tx.SENIORITIES)
    assert {r["track"] for r in rows} == set(tx.TRACKS)


def test_confidence_and_reasons(spark):
    df = spark.createDataFrame(
        [("Senior Data Engineer", "we are remote"), ("Barista", None)], "title string, d string"
    )
    first, second = cl.classify_jobs(df, description="d").collect()
    assert first["confidence"] == pytest.approx(0.92)
    assert first["reasons"] == ["data engineering title", "senior title", "remote signal"]
    assert second["confidence"] == pytest.approx(0.62)
    assert second["reasons"][2] == "no workplace signal"


def test_workplace_hint_beats_description_even_if_unknown(spark):
    df = spark.createDataFrame(
        [("Engineer", "hybrid role", None), ("Engineer", "hybrid role", "Unknown"),
         ("Remote Engineer", "on-site", ""), ("Engineer", "work from  home", None),
         ("Engineer", "in office", None), ("Engineer", "remotely", None)],
        "title string, d string, h string",
    )
    rows = cl.classify_jobs(df, description="d", hint="h").collect()
    assert [r["workplace"] for r in rows] == [
        "Hybrid", "Unknown", "Remote", "Remote", "On-site", "Unknown"
    ]


def test_legacy_substring_traps(spark):
    df = spark.createDataFrame(
        [("Director of Sales",), ("Internal Auditor",), ("Coordinator",), ("Product Manager",),
         ("Team Leader",), (None,), ("Clinical Researcher",), ("Technical Program Manager",)],
        "title string",
    )
    rows = df.select(
        cl.legacy_seniority("title").alias("s"), cl.legacy_category_long("title").alias("c"),
        cl.legacy_role_type("title").alias("r"),
    ).collect()
    assert [r["s"] for r in rows] == [
        "C-Suite", "Intern", "C-Suite", "Manager", "Other", "Unknown", "Other", "Manager"
    ]
    assert [r["c"] for r in rows][:4] == ["C-Suite", "Uncategorized", "C-Suite",
                                         "Management (Other)"]
    assert rows[6]["c"] == "Life Sciences"
    assert rows[7]["r"] == "Other"


def test_first_rule_wins_and_default(spark):
    rules = [Rule("a", words="x|y z"), Rule("b", stems="y")]
    df = spark.createDataFrame([("y z",), ("yy",), ("xx",)], "t string")
    got = df.select(label_by_rules(F.col("t"), rules, "none").alias("l")).collect()
    assert [r["l"] for r in got] == ["a", "b", "none"]
