"""Many search terms in one pass over the texts.

A text is cut into tokens once: runs of word characters, and every other character on its own. Each token
offers itself with the few tokens behind it, and a join on the first token finds the terms that may begin
there; the rest is compared in place. The texts are read once and the join looks a token up in a hash
table, so hundreds of terms cost what a handful does, where a regular expression per term costs a pass
each. Terms and texts are compared in lower case, and a term counts as a whole: next to a word
character of its own it has none from the text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.functions.text import WORD, col
from tallyfold.session import stored

TOKEN = rf"{WORD}+|(?s:.)"
WORD_TOKEN = rf"^{WORD}"


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def as_terms(listed: DataFrame) -> DataFrame:
    """label, parts (the tokens of the term) and first, of rows with label and term; empty terms drop out.
    Written, so that Spark knows its size and broadcasts it or not by that."""
    lowered = listed.select("label", F.trim(F.lower("term")).alias("term")).where("term <> ''").distinct()
    parts = lowered.select("label", tokens(F.col("term")).alias("parts"))
    return stored(parts.withColumn("first", F.element_at("parts", 1)), "terms")


def term_table(spark: SparkSession, terms: Mapping[str, Sequence[str]]) -> DataFrame:
    """`as_terms` of labels with one or more terms each."""
    rows = [(label, term) for label, several in terms.items() for term in several]
    return as_terms(spark.createDataFrame(rows, "label string, term string"))


def phrase_hits(df: DataFrame, key: Sequence[str], text: str | Column, terms: DataFrame) -> DataFrame:
    """Distinct (key, label) of the rows whose text names a term of the label.

    `terms` comes from `term_table`. Null texts name nothing. Rows that share a key count as one.
    """
    longest = terms.agg(F.max(F.size("parts"))).first()[0] or 0
    if not longest:
        return df.select(*key, F.lit(None).cast("string").alias("label")).limit(0)
    named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(key)]
    cut = df.select(*named, tokens(F.lower(col(text))).alias("_tokens"))
    # A token with what stands before it, the tokens a term could have, and one that must not be a word.
    places = F.transform(
        "_tokens",
        lambda token, i: F.struct(
            token.alias("first"), F.get("_tokens", i - 1).alias("before"),
            F.slice("_tokens", i + 1, longest + 1).alias("ahead"),
        ),
    )
    solid = F.filter(places, lambda place: place["first"] != " ")
    starts = cut.select(*[f"_k{i}" for i in range(len(key))], F.inline(solid))
    met = starts.join(terms.select("label", "parts", "first"), "first")
    size = F.size("parts")

    def word(token: Column) -> Column:
        return F.coalesce(token.rlike(WORD_TOKEN), F.lit(False))

    # Tokens of word characters are as long as can be, so equal tokens end where the text's word ends.
    whole = (
        (F.slice("ahead", 1, size) == F.col("parts"))
        & ~word(F.col("before")) & ~word(F.get("ahead", size))
    )
    hits = met.where(whole).select(*[F.col(f"_k{i}").alias(k) for i, k in enumerate(key)], "label")
    return hits.distinct()


def term_counts(df: DataFrame, key: Sequence[str], text: str | Column, terms: DataFrame) -> DataFrame:
    """label, n (rows that name one of its terms), share of all rows; labels without a hit have 0.

    `key` tells the rows apart; `terms` comes from `term_table` or `as_terms`.
    """
    hits = phrase_hits(df, key, text, terms).groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1))).scalar()
    n = F.coalesce("n", F.lit(0))
    return terms.select("label").distinct().join(hits, "label", "left").select(
        "label", n.alias("n"), F.try_divide(n, total).alias("share")
    )


def terms_per_row(df: DataFrame, key: Sequence[str], text: str | Column, terms: Sequence[str]) -> DataFrame:
    """key and the sorted distinct terms that the row's text names, empty where there is none."""
    hits = phrase_hits(df, key, text, term_table(df.sparkSession, {t: [t] for t in terms}))
    # As many entries as terms.
    lists = hits.groupBy(*key).agg(F.array_sort(F.collect_list("label")).alias("terms"))
    named = lists.select(*[F.col(k).alias(f"_l{i}") for i, k in enumerate(key)], "terms")
    same = [F.col(k).eqNullSafe(F.col(f"_l{i}")) for i, k in enumerate(key)]
    found = F.coalesce("terms", F.array().cast("array<string>"))
    return df.select(*key).distinct().join(named, same, "left").select(*key, found.alias("terms"))
