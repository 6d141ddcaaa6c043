"""Title classification as one projection; no shuffle, no Python on the executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.rules import label_by_rules, pick, rule_number
from tallyfold.functions.text import col, has_word, norm_text
from tallyfold.plans import taxonomy as tx


def role_rule(title: Column) -> Column:
    """Number of the first role rule that matches a normalised title."""
    return rule_number(title, tx.ROLE_RULES)


def role_label(number: Column) -> Column:
    return pick(number, [r.label for r in tx.ROLE_RULES] + [tx.DEFAULT_ROLE[0]])


def role_reason(number: Column) -> Column:
    return pick(number, [r.reason for r in tx.ROLE_RULES] + [tx.DEFAULT_ROLE[1]])


def seniority_rule(title: Column, family: Column) -> Column:
    """Number of the first seniority test; the executive family is one of them."""
    first, then = tx.SENIORITY_FIRST, tx.SENIORITY_THEN
    early = rule_number(title, first)
    late = rule_number(title, then) + len(first) + 1
    return (
        F.when(early < len(first), early)
        .when(family == tx.SENIORITY_EXECUTIVE[0], F.lit(len(first)))
        .otherwise(late)
    )


def _seniority_entries(position: int) -> list[str]:
    first = [(r.label, r.reason) for r in tx.SENIORITY_FIRST]
    then = [(r.label, r.reason) for r in tx.SENIORITY_THEN]
    return [e[position] for e in [*first, tx.SENIORITY_EXECUTIVE, *then, tx.DEFAULT_SENIORITY]]


def seniority_label(number: Column) -> Column:
    return pick(number, _seniority_entries(0))


def seniority_reason(number: Column) -> Column:
    return pick(number, _seniority_entries(1))


def classify_track(title: Column, family: Column, seniority: Column) -> Column:
    worded = family.isin(*tx.NON_TECHNICAL_BY_WORD) & has_word(title, tx.NON_TECHNICAL_WORDS)
    return (
        F.when((family == "Executive") | (seniority == "Executive"), F.lit("Executive"))
        .when(
            family.isin(*tx.MANAGER_FAMILIES) | seniority.isin(*tx.MANAGER_LEVELS),
            F.lit("Manager"),
        )
        .when(worded | family.isin(*tx.NON_TECHNICAL_FAMILIES), F.lit("Non-technical"))
        .otherwise(F.lit("IC"))
    )


def workplace_rule(text: str | Column) -> Column:
    return rule_number(norm_text(text), tx.WORKPLACE_RULES)


def workplace_label(number: Column) -> Column:
    return pick(number, [r.label for r in tx.WORKPLACE_RULES] + [tx.DEFAULT_WORKPLACE[0]])


def workplace_reason(number: Column) -> Column:
    return pick(number, [r.reason for r in tx.WORKPLACE_RULES] + [tx.DEFAULT_WORKPLACE[1]])


def workplace_source(
    title: str | Column, description: str | Column | None, hint: str | Column | None
) -> Column:
    """Text that tells the workplace: the hint if there is any, else title and description.

    "Unknown" is a hint like any other, so a job with a detail row is judged by it alone.
    """
    parts = [norm_text(title)]
    if description is not None:
        parts.append(norm_text(description))
    combined = F.trim(F.concat_ws(" ", *parts))
    if hint is None:
        return combined
    h = col(hint)
    return F.when(h.isNotNull() & (h != ""), h).otherwise(combined)


def classify_jobs(
    df: DataFrame,
    title: str = "title",
    description: str | None = None,
    hint: str | None = None,
) -> DataFrame:
    """Adds role_family, seniority, track, workplace, confidence and reasons.

    The rule numbers are columns of their own step: each rule chain is evaluated once
    per row and its label and reason are list lookups.
    """
    staged = df.withColumns(
        {"_title": norm_text(title), "_place_text": workplace_source(title, description, hint)}
    ).withColumns(
        {"_role": role_rule(F.col("_title")), "_place": workplace_rule("_place_text")}
    )
    staged = staged.withColumn("role_family", role_label(F.col("_role")))
    staged = staged.withColumn("_level", seniority_rule(F.col("_title"), F.col("role_family")))
    staged = staged.withColumn("seniority", seniority_label(F.col("_level")))

    def gain(known: Column, value: float) -> Column:
        return F.when(known, F.lit(value)).otherwise(F.lit(0.0))

    confidence = (
        F.lit(tx.CONFIDENCE_BASE)
        + gain(F.col("role_family") != tx.DEFAULT_ROLE[0], tx.CONFIDENCE_ROLE)
        + gain(F.col("seniority") != tx.DEFAULT_SENIORITY[0], tx.CONFIDENCE_SENIORITY)
        + gain(F.col("_place") < len(tx.WORKPLACE_RULES), tx.CONFIDENCE_WORKPLACE)
    )
    labelled = staged.withColumns(
        {
            "track": classify_track(F.col("_title"), F.col("role_family"), F.col("seniority")),
            "workplace": workplace_label(F.col("_place")),
            "confidence": F.least(confidence, F.lit(tx.CONFIDENCE_CAP)),
            "reasons": F.array(
                role_reason(F.col("_role")),
                seniority_reason(F.col("_level")),
                workplace_reason(F.col("_place")),
            ),
        }
    )
    return labelled.drop("_title", "_place_text", "_role", "_place", "_level")


TITLE_LABELS = ("role_family", "seniority", "track", "role_reason", "seniority_reason")


def title_dictionary(titles: DataFrame, title: str = "title") -> DataFrame:
    """Each distinct normalised title once, as `title_key`, with what the rules say of it."""
    distinct = titles.select(norm_text(title).alias("title_key")).distinct()
    key = F.col("title_key")
    staged = distinct.withColumn("_role", role_rule(key))
    staged = staged.withColumn("role_family", role_label(F.col("_role")))
    staged = staged.withColumn("_level", seniority_rule(key, F.col("role_family")))
    staged = staged.withColumns({
        "seniority": seniority_label(F.col("_level")),
        "role_reason": role_reason(F.col("_role")),
        "seniority_reason": seniority_reason(F.col("_level")),
    })
    track = classify_track(key, F.col("role_family"), F.col("seniority")).alias("track")
    return staged.select("title_key", "role_family", "seniority", track, *TITLE_LABELS[3:])


def classify_distinct(
    df: DataFrame, title: str = "title", dictionary: DataFrame | None = None
) -> DataFrame:
    """Adds role_family, seniority, track and the two reasons, with rules run once per distinct title.

    Observations repeat their titles many times over. The distinct ones are found with a map-side
    combine, so a title that holds a third of the rows ships one row per task; their labels come
    back by a join on the normalised title, which Spark broadcasts if the dictionary is small by its
    measured size, and otherwise shuffles, where AQE splits hot titles. `dictionary` can be one that
    was kept from an earlier run; titles it lacks are labelled anew.
    """
    keyed = df.withColumn("_title_key", norm_text(title))
    if dictionary is None:
        labels = title_dictionary(df, title)
    else:
        known = dictionary.select("title_key", *TITLE_LABELS)
        unknown = keyed.select(F.col("_title_key").alias("title_key")).distinct().join(
            known.select("title_key"), "title_key", "left_anti"
        )
        labels = known.unionByName(title_dictionary(unknown, "title_key"))
    joined = keyed.join(labels, F.col("_title_key") == F.col("title_key"), "left")
    return joined.drop("_title_key", "title_key")


def _legacy(title: str | Column, rules, default: str, missing: str | None = "Unknown") -> Column:
    label = label_by_rules(F.lower(col(title)), rules, default)
    return F.when(col(title).isNull(), F.lit(missing)).otherwise(label)


def legacy_role_type(title: str | Column) -> Column:
    return _legacy(title, tx.LEGACY_ROLE_TYPES, "Other")


def legacy_seniority(title: str | Column) -> Column:
    return _legacy(title, tx.LEGACY_SENIORITY, "Other")


def legacy_category(title: str | Column) -> Column:
    return _legacy(title, tx.LEGACY_CATEGORIES, "Other Technical", None)


def legacy_category_long(title: str | Column) -> Column:
    return _legacy(title, tx.LEGACY_CATEGORIES_LONG, "Uncategorized", None)


def legacy_seniority_short(title: str | Column) -> Column:
    return _legacy(title, tx.LEGACY_SENIORITY_SHORT, "Mid-Level", None)
