"""Records out of stored web pages.

Reading the markup is the one thing Spark has no expression for: a pandas UDF receives
only the html column and returns arrays of raw strings. Everything after that (exploding,
ids, dates, salaries, filters, confidences) is Spark.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.facts import (
    detail_confidence, infer_workplace, listing_confidence, posted_at, salary_range, skills,
)
from tallyfold.functions.identity import (
    VIEW_BASE, canonical_url, content_hash, job_id_from_url, snapshot_id,
)
from tallyfold.functions.text import clean_text, contains_any, keeps_title


@dataclass(frozen=True)
class Pick:
    """Selects elements by tag, classes and a part of their link; empty means any."""

    tag: str = ""
    classes: tuple[str, ...] = ()
    link_part: str = ""


@dataclass(frozen=True)
class CardSpec:
    """Where a result page keeps its records. Each list is tried in order."""

    cards: tuple[tuple[Pick, ...], ...]
    link: tuple[Pick, ...]
    title: tuple[Pick, ...]
    company: tuple[Pick, ...] = ()
    location: tuple[Pick, ...] = ()
    posted: tuple[Pick, ...] = ()


# Markup of result pages and detail pages.
LISTING_CARDS = CardSpec(
    cards=(
        (Pick("div", ("base-search-card", "job-search-card")),),
        (Pick("li", ("jobs-search-results__list-item",)), Pick("div", ("job-card-container",))),
    ),
    link=(Pick("a", (), "/jobs/view/"),),
    title=(Pick("", ("base-search-card__title",)), Pick("", ("job-search-card__title",)),
           Pick("h3"), Pick("a", ("base-card__full-link",))),
    company=(Pick("", ("base-search-card__subtitle",)), Pick("h4"),
             Pick("", ("job-card-container__company-name",))),
    location=(Pick("", ("job-search-card__location",)),
              Pick("", ("job-card-container__metadata-item",))),
    posted=(Pick("", ("job-search-card__listdate",)), Pick("time")),
)
DETAIL_DESCRIPTION = (
    Pick("", ("show-more-less-html__markup",)), Pick("", ("description__text",)),
    Pick("", ("jobs-description-content__text",)), Pick("section", ("description",)),
)
DETAIL_APPLICANTS = (
    Pick("", ("num-applicants__caption",)),
    Pick("", ("jobs-unified-top-card__applicant-count",)),
)
DETAIL_ITEM = (Pick("", ("description__job-criteria-item",)),)
DETAIL_KEY = (Pick("", ("description__job-criteria-subheader",)), Pick("h3"))
DETAIL_VALUE = (Pick("", ("description__job-criteria-text",)), Pick("span"))
EMPLOYMENT_KEYS = ("Employment type", "Job type")

VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
HIDDEN = frozenset(("script", "style", "template"))

CARD_TYPE = (
    "array<struct<rank:int,href:string,link_text:string,title:string,company:string,"
    "location:string,posted_text:string>>"
)
DETAIL_TYPE = (
    "struct<description:string,applicants:string,"
    "criteria:array<struct<key:string,value:string>>>"
)


class Outline(HTMLParser):
    """Elements of a page in document order, each with the range of its descendants."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.nodes: list[list] = []  # [tag, classes, href, first text, end node, end text]
        self.texts: list[str] = []
        self._open: list[int] = []
        self.feed(html)
        self.close()
        while self._open:
            self._end(self._open.pop())

    def handle_starttag(self, tag, attrs):
        found = dict(attrs)
        classes = frozenset((found.get("class") or "").split())
        self.nodes.append([tag, classes, found.get("href") or "", len(self.texts), None, None])
        if tag in VOID:
            self._end(len(self.nodes) - 1)
        else:
            self._open.append(len(self.nodes) - 1)

    def handle_endtag(self, tag):
        if any(self.nodes[i][0] == tag for i in self._open):
            while True:
                last = self._open.pop()
                self._end(last)
                if self.nodes[last][0] == tag:
                    break

    def handle_data(self, data):
        if not (self._open and self.nodes[self._open[-1]][0] in HIDDEN):
            self.texts.append(data)

    def _end(self, i: int):
        self.nodes[i][4:] = len(self.nodes), len(self.texts)

    def find(self, picks: Sequence[Pick], within: int | None = None) -> list[int]:
        """Elements matching any of the picks, in document order."""
        first, last = (0, len(self.nodes)) if within is None else (within + 1, self.nodes[within][4])
        return [
            i for i in range(first, last)
            if any(
                (not p.tag or self.nodes[i][0] == p.tag)
                and self.nodes[i][1].issuperset(p.classes)
                and p.link_part in self.nodes[i][2]
                for p in picks
            )
        ]

    def text(self, i: int) -> str:
        return " ".join(" ".join(self.texts[self.nodes[i][3]:self.nodes[i][5]]).split())

    def first_text(self, picks: Sequence[Pick], within: int | None = None) -> str | None:
        """Text of the first element of the first pick that has any."""
        for p in picks:
            for i in self.find((p,), within)[:1]:
                if text := self.text(i):
                    return text
        return None


def _cards(html: str, spec: CardSpec) -> list[dict]:
    page = Outline(html)
    cards = next((hits for picks in spec.cards if (hits := page.find(picks))), [])
    rows = []
    for rank, card in enumerate(cards, start=1):
        links = page.find(spec.link, card)
        rows.append({
            "rank": rank,
            "href": page.nodes[links[0]][2] if links else None,
            "link_text": page.text(links[0]) if links else None,
            "title": page.first_text(spec.title, card),
            "company": page.first_text(spec.company, card),
            "location": page.first_text(spec.location, card),
            "posted_text": page.first_text(spec.posted, card),
        })
    return rows


def _detail(html: str) -> dict:
    page = Outline(html)
    pairs = {}
    for item in page.find(DETAIL_ITEM):
        key, value = page.first_text(DETAIL_KEY, item), page.first_text(DETAIL_VALUE, item)
        if key and value:
            pairs[key] = value
    return {
        "description": page.first_text(DETAIL_DESCRIPTION),
        "applicants": page.first_text(DETAIL_APPLICANTS),
        "criteria": [{"key": k, "value": v} for k, v in pairs.items()],
    }


def read_cards(html: str | Column, spec: CardSpec = LISTING_CARDS) -> Column:
    """Raw cards of a page, in page order."""
    @F.pandas_udf(CARD_TYPE)
    def cards(pages: pd.Series) -> pd.Series:
        return pd.Series([_cards(p or "", spec) for p in pages], dtype=object)

    return cards(html)


def read_detail(html: str | Column) -> Column:
    @F.pandas_udf(DETAIL_TYPE)
    def detail(pages: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(
            [_detail(p or "") for p in pages], columns=["description", "applicants", "criteria"]
        )

    return detail(html)


def extract_cards(
    pages: DataFrame,
    html: str = "html",
    spec: CardSpec = LISTING_CARDS,
    job_id: Column | None = None,
) -> DataFrame:
    """One row per usable card. Ranks count all cards of the page, dropped ones too.

    A card needs a link, an id and a title that is not page furniture. `job_id` overrides
    how the id is read from `href`.
    """
    raw = pages.select("*", F.inline(read_cards(html, spec)))
    ident = job_id_from_url("href") if job_id is None else job_id
    title = F.coalesce(F.nullif("title", F.lit("")), F.nullif(clean_text("link_text"), F.lit("")))
    named = raw.withColumns({"job_id": ident, "title": title})
    usable = (
        F.col("href").isNotNull() & (F.coalesce("job_id", F.lit("")) != "")
        & F.col("title").isNotNull() & keeps_title("title")
    )
    return named.where(usable)


def listings_from_pages(pages: DataFrame, html: str = "html", base: str = VIEW_BASE) -> DataFrame:
    """Listing snapshots from pages with run_id, query_id, page, scraped_at (and path)."""
    cards = extract_cards(pages.withColumn("content_sha256", content_hash(html)), html)
    return cards.select(
        snapshot_id(F.col("query_id"), F.col("page"), F.col("rank"), F.col("job_id")).alias(
            "snapshot_id"
        ),
        "run_id", "query_id", "job_id", canonical_url("job_id", base).alias("url"), "title",
        "company", "location", "posted_text",
        posted_at("posted_text", "scraped_at").alias("posted_at"),
        "page", "rank", "raw_snapshot_path", "content_sha256",
        listing_confidence("title", "company", "location", "posted_text", "href").alias(
            "parser_confidence"
        ),
        "scraped_at", F.lit("complete").alias("extraction_status"),
    )


def extract_detail(pages: DataFrame, html: str = "html") -> DataFrame:
    """Detail columns for pages with run_id, job_id, url, scraped_at (and path)."""
    read = pages.withColumn("_d", read_detail(html)).withColumns({
        "description": F.col("_d.description"),
        "criteria": F.map_from_entries("_d.criteria"),
        "applicants_signal": F.col("_d.applicants"),
        "content_sha256": content_hash(html),
    })
    words = F.concat_ws(
        " ", F.coalesce("description", F.lit("")), F.array_join(F.map_values("criteria"), " ")
    )
    facts = read.withColumns({
        "workplace_type": infer_workplace(words),
        "employment_type": F.coalesce(
            *[F.try_element_at("criteria", F.lit(k)) for k in EMPLOYMENT_KEYS]
        ),
        "_s": salary_range("description"),
        "skills": skills("description"),
    })
    return facts.select(
        "run_id", "job_id", "url", "description", "workplace_type", "employment_type",
        "_s.salary_min", "_s.salary_max", "_s.salary_currency", "applicants_signal", "criteria",
        "skills", "raw_snapshot_path", "content_sha256",
        detail_confidence(
            "description", "criteria", "workplace_type", "employment_type", "skills"
        ).alias("parser_confidence"),
        "scraped_at", F.lit("complete").alias("extraction_status"),
    )


def tag_texts(html: str | Column, pattern: str, group: int = 1) -> Column:
    """All texts a markup pattern captures, without leaving the JVM."""
    column = F.col(html) if isinstance(html, str) else html
    return F.regexp_extract_all(column, F.lit(pattern), F.lit(group))


def pair_by_position(
    pages: DataFrame, key: str, left: Column, right: Column, names: tuple[str, str]
) -> DataFrame:
    """i-th element of one list with the i-th of another; pairs inside the row, no join."""
    a, b = names
    pairs = F.arrays_zip(left.alias(a), right.alias(b))
    spread = pages.select(key, F.posexplode(pairs).alias("pos", "p"))
    return spread.select(key, "pos", F.col(f"p.{a}").alias(a), F.col(f"p.{b}").alias(b))


# Heading texts that are page furniture, and lengths a usable one exceeds.
TITLE_FURNITURE = ("sign", "join", "filter", "sort")
COMPANY_FURNITURE = ("experience", "type", "function", "industry")
TITLE_LENGTH, COMPANY_LENGTH = 5, 1
ENOUGH_CARDS = 5


def usable_texts(texts: Column, furniture: Sequence[str], longer_than: int) -> Column:
    """Cleaned texts of some headings without the page furniture."""
    cleaned = F.transform(texts, lambda t: clean_text(F.regexp_replace(t, "<[^>]*>", " ")))
    return F.filter(
        cleaned, lambda t: (F.length(t) > longer_than) & ~contains_any(F.lower(t), furniture)
    )


def pair_headings(
    pages: DataFrame,
    key: str,
    titles: Column,
    companies: Column,
    found: Column,
    enough: int = ENOUGH_CARDS,
    title_furniture: Sequence[str] = TITLE_FURNITURE,
) -> DataFrame:
    """Fallback for pages that gave too few cards: i-th title heading with i-th company.

    Titles found already, and repeats of a title on the page, are skipped. All of it
    happens inside the row.
    """
    short = pages.select(
        key, found.alias("_found"),
        usable_texts(titles, title_furniture, TITLE_LENGTH).alias("_t"),
        usable_texts(companies, COMPANY_FURNITURE, COMPANY_LENGTH).alias("_c"),
    ).where(F.size("_found") < enough)
    both = F.least(F.size("_t"), F.size("_c"))
    spread = short.select(
        key, "_found", "_t", F.posexplode(F.arrays_zip(
            F.slice("_t", F.lit(1), both).alias("title"), F.slice("_c", F.lit(1), both).alias("company")
        )).alias("pos", "p"),
    )
    fresh = (F.array_position("_t", F.col("p.title")) == F.col("pos") + 1) & ~F.array_contains(
        "_found", F.col("p.title")
    )
    return spread.where(fresh).select(key, "pos", "p.title", "p.company")
