"""Terms found by a join against a regular expression per term, and labels by distinct titles."""

import random
import re
import time

from pyspark.sql import functions as F

from tallyfold.operators import classify as cl
from tallyfold.operators import phrases as ph

WORD = re.compile(r"\w")
TERMS = {"c": ["c", "c++", "c#"], "net": [".net", "asp.net"], "ml": ["machine learning", "ml"], "to": ["go-to-market"], "e": ["École"], "none": ["absent"], "x": ["a b c d"], "dots": ["..."]}


def names(text, term):
    text, term = text.lower(), term.lower()
    for m in re.finditer(f"(?={re.escape(term)})", text):
        a, b = m.start(), m.start() + len(term)
        if not (a and WORD.match(text[a - 1])) and not (b < len(text) and WORD.match(text[b])):
            return True
    return False


def test_terms_as_whole_words(spark):
    r = random.Random(2)
    bits = ["c", "c++", "c#", "C++11", ".NET", "asp.net", "machine", "learning", "ml", "go-to-market", "école", "a", "b", "d", " ", "  ", ",", "\n", "_", "...", "x"]
    rows = [(i, "".join(r.choice(bits) + r.choice(["", " ", " "]) for _ in range(r.randint(0, 12)))) for i in range(800)]
    rows += [(900, None), (901, ""), (902, "a b c d"), (None, "c++ c++"), (None, "ml")]
    df = spark.createDataFrame(rows, "id long, text string").withColumn("label", F.lit("own")).withColumn("first", F.lit(1))
    want = {(i, label) for i, text in rows for label, several in TERMS.items() for t in several if names(text or "", t)}
    got = [tuple(x) for x in ph.phrase_hits(df, ["id"], "text", ph.term_table(spark, TERMS)).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    lists = {x.id: x.terms for x in ph.terms_per_row(df, ["id"], "text", ["c", "ml", "c++"]).collect()}
    assert lists[900] == [] and lists[902] == ["c"] and lists[None] == ["c", "c++", "ml"] and len(lists) == 804
    assert ph.phrase_hits(df, ["id"], "text", ph.term_table(spark, {"a": [""]})).count() == 0


def test_counts_have_every_label(spark):
    df = spark.range(10).select("id", F.when(F.col("id") < 4, "uses ml daily").otherwise("html").alias("text"))
    got = {r.label: (r.n, r.share) for r in ph.term_counts(df, ["id"], "text", ph.term_table(spark, TERMS)).collect()}
    assert got["ml"] == (4, 0.4) and got["none"] == (0, 0.0) and len(got) == len(TERMS)


def test_hundreds_of_terms_cost_one_pass(spark):
    words = [f"word{i}" for i in range(3000)]
    r = random.Random(1)
    rows = [(i, " ".join(r.choices(words, k=400))) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, text string").repartition(4).cache()
    df.count()

    def seconds(n):
        terms = ph.term_table(spark, {w: [w] for w in words[:n]})
        best = 99.0
        for _ in range(2):
            start = time.perf_counter()
            ph.term_counts(df, ["id"], "text", terms).collect()
            best = min(best, time.perf_counter() - start)
        return best

    few, many = seconds(5), seconds(500)
    df.unpersist()
    assert many < 2 * few + 1


def test_rules_sit_above_the_distinct_titles(spark):
    df = spark.range(1000).select("id", F.concat(F.lit("Data  Engineer "), (F.col("id") % 3).cast("string")).alias("title"))
    plan = cl.classify_distinct(df)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    rules = [i for i, line in enumerate(lines) if "RLIKE" in line or "rlike" in line.lower()]
    grouped = [i for i, line in enumerate(lines) if "Aggregate [" in line]
    assert rules and grouped and max(rules) <= min(grouped)  # in its result, or above


def test_distinct_titles_give_the_labels_of_every_row(spark, sf_dir):
    from tallyfold.plans import bindings as b

    listings = b.v_listings(spark, sf_dir).withColumn("title", F.when(F.col("k") != 5, F.col("title")))
    columns = ["snapshot_id", "role_family", "seniority", "track"]
    want = cl.classify_jobs(listings).select(*columns, F.element_at("reasons", 1).alias("role_reason"), F.element_at("reasons", 2).alias("seniority_reason"))
    got = cl.classify_distinct(listings).select(want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    part = cl.title_dictionary(listings.where("k < 40"))
    kept = cl.classify_distinct(listings, dictionary=part).select(want.columns)
    assert kept.exceptAll(want).count() == 0 and got.count() == kept.count()
