"""Facts read out of free text: dates, salaries, skills, workplace, confidences."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyfold.functions.text import BLANK, WORD, col, contains_any, let

# Skills looked for in descriptions.
SKILLS = (
    "python", "java", "javascript", "typescript", "react", "node", "go", "rust", "kubernetes",
    "aws", "gcp", "azure", "sql", "spark", "pytorch", "tensorflow", "llm", "machine learning",
)

# Seconds per unit of a relative posting date (a month counts 30 days).
UNIT_SECONDS = {"minute": 60, "hour": 3600, "day": 86400, "week": 604800, "month": 2592000}

# Fixed formats.
AGO = rf"([0-9]+){BLANK}*(minute|hour|day|week|month)s?{BLANK}*ago"
AMOUNT = r"([0-9]{2,3}(?:\.[0-9]+)?)"
SALARY = (
    rf"(?i){AMOUNT}{BLANK}*(k|000)?{BLANK}*(?:-|to|–){BLANK}*\$?{BLANK}*{AMOUNT}{BLANK}*(k|000)?"
)
# A currency sign in front changes neither the numbers nor which amount comes first, and a
# pattern that starts with a digit is found three times as fast.
SALARY_SIGNED = SALARY.replace("(?i)", rf"(?i)\$?{BLANK}*", 1)

# Workplace labels in order of precedence, with their wording.
WORKPLACE_PARTS = (
    ("Hybrid", ("hybrid",)),
    ("Remote", ("remote", "work from home")),
    ("On-site", ("on-site", "onsite", "in office")),
)


def posted_at(text: str | Column, now: str | Column) -> Column:
    """Timestamp meant by '3 days ago', seen from `now`; NULL if the text names none."""
    at = col(now)
    sizes = F.create_map(*[F.lit(x) for pair in UNIT_SECONDS.items() for x in pair])
    # Only a date before the calendar's first year cannot be given.
    first = F.lit("0001-01-01 00:00:00").cast("timestamp_ntz")

    def usable(age: Column) -> Column:
        return F.when(age <= F.timestamp_diff("SECOND", first, at.cast("timestamp_ntz")), age)

    def meant(c: Column) -> Column:
        return F.when(c.isNull() | (c == ""), F.lit(None)).otherwise(
            let(F.regexp_replace(F.lower(c), "reposted|posted", ""), dated)
        )

    def dated(wording: Column) -> Column:
        amount = F.regexp_extract(wording, AGO, 1).try_cast("bigint")
        seconds = F.try_element_at(sizes, F.regexp_extract(wording, AGO, 2)).cast("bigint")
        age = let(F.try_multiply(amount, seconds), usable)
        return F.when(contains_any(wording, ("just now", "today")), at).otherwise(
            F.timestamp_add("SECOND", -age, at)
        )

    return let(col(text), meant)


def salary_range(text: str | Column, mode: str = "compatible") -> Column:
    """First 'low - high' amount as struct<salary_min, salary_max, salary_currency>.

    `compatible` reads any two- or three-digit pair and scales both ends by 1000, so
    "10-15 years" gives 10000-15000. `strict` wants a currency sign or a `k` in the match
    and low <= high.
    """
    if mode not in ("compatible", "strict"):
        raise ValueError(f"unknown salary mode {mode!r}")
    pattern = SALARY_SIGNED if mode == "strict" else SALARY
    plain = F.replace(F.coalesce(col(text), F.lit("")), F.lit(","), F.lit(""))
    # One scan of the text finds the amount; the groups are then read from those few letters.
    amount = F.regexp_extract(plain, pattern, 0)

    def group(n: int) -> Column:
        return F.regexp_extract(amount, pattern, n)

    low = group(1).try_cast("double") * F.lit(1000.0)
    high = group(3).try_cast("double") * F.lit(1000.0)
    usable = low.isNotNull()
    if mode == "strict":
        marked = group(0).contains("$") | (F.lower(group(2)) == "k") | (F.lower(group(4)) == "k")
        usable = usable & marked & (low <= high)
    return F.struct(
        F.when(usable, low).alias("salary_min"),
        F.when(usable, high).alias("salary_max"),
        F.when(usable, F.lit("USD")).alias("salary_currency"),
    )


def skills(text: str | Column, terms: Sequence[str] = SKILLS) -> Column:
    """Sorted distinct terms that occur as whole words.

    Terms sharing no word are found in one pass over the text; otherwise a hit of one
    could swallow another, and each term gets its own pass.
    """
    lowered = F.lower(F.coalesce(col(text), F.lit("")))
    words = [w for term in terms for w in re.split(r"[^\w]+", term) if w]
    if len(words) == len(set(words)):
        pattern = rf"(?<!{WORD})({'|'.join(re.escape(t) for t in terms)})(?!{WORD})"
        hits = F.regexp_extract_all(lowered, F.lit(pattern), F.lit(1))
        return F.array_sort(F.array_distinct(hits))
    found = [
        F.when(lowered.rlike(rf"(?<!{WORD}){re.escape(t)}(?!{WORD})"), F.lit(t))
        for t in sorted(set(terms))
    ]
    return F.array_compact(F.array(*found))


def infer_workplace(text: str | Column) -> Column:
    """Workplace label by plain substring, for text of detail pages."""
    lowered = F.lower(F.coalesce(col(text), F.lit("")))
    (first, parts), *rest = WORKPLACE_PARTS
    label = F.when(contains_any(lowered, parts), F.lit(first))
    for name, parts in rest:
        label = label.when(contains_any(lowered, parts), F.lit(name))
    return label.otherwise(F.lit("Unknown"))


def _present(value: str | Column) -> Column:
    c = col(value)
    return c.isNotNull() & (c != "")


def _score(base: float, *parts: tuple[Column, float]) -> Column:
    total = F.lit(base)
    for condition, gain in parts:
        total = total + F.when(condition, F.lit(gain)).otherwise(F.lit(0.0))
    return F.least(total, F.lit(1.0))


def listing_confidence(
    title: str | Column,
    company: str | Column,
    location: str | Column,
    posted_text: str | Column,
    href: str | Column,
) -> Column:
    """How complete an extracted card is, 0.35..1."""
    return _score(
        0.35,
        (_present(title), 0.2),
        (_present(company), 0.15),
        (_present(location), 0.15),
        (_present(posted_text), 0.1),
        (_present(href), 0.05),
    )


def detail_confidence(
    description: str | Column,
    criteria: str | Column,
    workplace: str | Column,
    employment: str | Column,
    skill_list: str | Column,
) -> Column:
    """How complete an extracted detail page is, 0.25..1."""
    return _score(
        0.25,
        (_present(description), 0.25),
        (F.size(col(criteria)) > 0, 0.2),
        (col(workplace) != "Unknown", 0.1),
        (_present(employment), 0.1),
        (F.size(col(skill_list)) > 0, 0.1),
    )
