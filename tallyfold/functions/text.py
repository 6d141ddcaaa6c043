"""Text normalisation and word-edge matching, as plain Column expressions."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# One class for "any Unicode blank": Java's \s alone is ASCII only.
BLANK = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
# Word characters spelled out, so that word edges do not depend on the Java version.
WORD = r"[\p{L}\p{N}_]"

# Markers of page furniture that is not a posting title.
UI_MARKERS = ("sign in", "join now", "promoted", "see more")
UI_MARKERS_SHORT = ("promoted", "sign in", "join now")

NOT_AVAILABLE = "N/A"


def col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once per row, however often `use` refers to it."""
    return F.transform(F.array(value), use)[0]


def clean_text(value: str | Column) -> Column:
    """Collapse blanks and trim; NULL becomes ''."""
    return F.trim(F.regexp_replace(F.coalesce(col(value), F.lit("")), BLANK + "+", " "))


def norm_text(value: str | Column) -> Column:
    """Lower-cased `clean_text`, the form used for keys and for rule matching."""
    return F.lower(clean_text(value))


def is_blank(value: str | Column) -> Column:
    """NULL or nothing but ASCII spaces."""
    c = col(value)
    return c.isNull() | (F.trim(c) == "")


def or_unknown(value: str | Column, label: str = "Unknown") -> Column:
    """Segment label for a missing value."""
    c = col(value)
    return F.when(c.isNull() | (c == ""), F.lit(label)).otherwise(c)


def has_word(text: Column, phrases: str) -> Column:
    """True if one of the `|`-separated phrases occurs with word edges on both sides.

    Plain phrases are looked for as substrings first, which skips the expression for most
    texts.
    """
    found = text.rlike(rf"(?<!{WORD})(?:{phrases})(?!{WORD})")
    parts = phrases.split("|")
    if all(part == re.escape(part).replace("\\ ", " ") for part in parts):
        return contains_any(text, parts) & found
    return found


def contains_any(text: Column, parts: Sequence[str]) -> Column:
    """True if any of the literal substrings occurs."""
    found = text.contains(parts[0])
    for part in parts[1:]:
        found = found | text.contains(part)
    return found


def looks_like_ui(title: str | Column, markers: Sequence[str] = UI_MARKERS) -> Column:
    return contains_any(F.lower(col(title)), markers)


def keeps_title(
    title: str | Column, markers: Sequence[str] = UI_MARKERS, min_length: int = 1
) -> Column:
    """A usable posting title: long enough and not page furniture."""
    c = F.coalesce(col(title), F.lit(""))
    return (F.length(c) >= min_length) & ~looks_like_ui(c, markers)


def clean_company(value: str | Column) -> Column:
    trimmed = F.trim(F.regexp_replace(col(value), rf"^{BLANK}+|{BLANK}+$", ""))
    return F.when(col(value).isNull() | (trimmed == ""), F.lit(NOT_AVAILABLE)).otherwise(trimmed)


def clean_title(value: str | Column) -> Column:
    """Trim and drop a trailing multiple-candidates remark."""
    trimmed = F.regexp_replace(col(value), rf"^{BLANK}+|{BLANK}+$", "")
    return F.regexp_replace(trimmed, rf"{BLANK}*-?{BLANK}*Hiring multiple candidates?$", "")


def location_fallback(location: str | Column, searched: str | Column) -> Column:
    """The searched place where the posting itself names none."""
    return F.when(col(location) == NOT_AVAILABLE, col(searched)).otherwise(col(location))


def json_fields(value: str | Column, kind: str) -> Column:
    """Nested value as JSON text; maps are written in key order."""
    c = col(value)
    if kind == "map":
        c = F.map_from_entries(F.array_sort(F.map_entries(c)))
    return F.to_json(c)
