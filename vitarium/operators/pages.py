"""Rule sets for the pages of a biography catalogue.

Every operator takes captured pages, or what :func:`parse_pages` made of them: pages parsed
once for everything, of which each operator picks its own rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitarium import fixed
from vitarium.functions.text import first_text, first_truthy, join_labels, leading_int, normalize_text
from vitarium.operators.extract import Part, Rule, extract, extract_parts

CARD_RULES = [
    Rule("names", fixed.CARD_NAME_LINK),
    Rule("hrefs", fixed.CARD_NAME_LINK, attr="href"),
    Rule("urls", fixed.CARD_NAME_LINK, attr="href", resolve=True),
    Rule("dates", fixed.CARD_DATES),
    Rule("activities", fixed.CARD_ACTIVITY),
]
DETAIL_RULES = [
    Rule("given", fixed.GIVEN_NAME),
    Rule("family", fixed.FAMILY_NAME),
    Rule("og_title", fixed.OG_TITLE, attr="content"),
    Rule("born", fixed.BIRTH_DATE),
    Rule("died", fixed.DEATH_DATE),
    Rule("tags", fixed.HEADER_TAGS),
    Rule("description", fixed.DESCRIPTION),
]
PAGER_RULES = [Rule("links", fixed.PAGER_LINKS), Rule("link_ids", fixed.PAGER_LINKS, attr="id"), Rule("spans", fixed.PAGER_CURRENT)]
PAGER_LINK_RULES = [Rule("ids", "", attr="id"), Rule("labels", "")]
INDEX_RULES = [Rule("hrefs", fixed.INDEX_LINKS, attr="href", resolve=True)]
CARDS = Part("card", tuple(CARD_RULES), fixed.CARD)
PAGER = Part("pager", tuple(PAGER_RULES))
PAGER_LINKS = Part("pager_link", tuple(PAGER_LINK_RULES), fixed.PAGER_LINKS)
INDEX = Part("index", tuple(INDEX_RULES))
DETAILS = Part("detail", tuple(DETAIL_RULES))
LISTING_PARTS = (CARDS, PAGER, PAGER_LINKS, INDEX)


def http_error(status: str, url: str) -> Column:
    """What is noted of a page that was answered with an error status."""
    return F.concat(F.lit("HTTP "), F.col(status).cast("string"), F.lit(" for "), F.col(url))


def parse_pages(pages: DataFrame, parts: Sequence[Part] = LISTING_PARTS, *, keep: Sequence[str] = ("url",),
                base: str = "url") -> DataFrame:
    """Pages parsed once: the rows of every part, told apart by ``part``, and one error row for each page that cannot
    be read or was answered with an error status.  Write it, and all that is asked of the pages comes from there."""
    if "status" not in pages.columns:
        return extract_parts(pages, parts, keep=keep, base=base)
    bad = ~F.coalesce(F.col("status").between(200, 299), F.lit(True))
    answered = pages.withColumn("html", F.when(~bad, F.col("html"))).withColumn(
        "__answer", F.when(bad, http_error("status", "url")))
    parsed = extract_parts(answered, parts, keep=[*keep, "__answer"], base=base)
    return parsed.withColumn("extract_error", F.coalesce("__answer", "extract_error")).drop("__answer")


def _rows(pages: DataFrame, part: Part, keep: Sequence[str], base: str = "url") -> DataFrame:
    """The rows of one part, and those of pages that cannot be read."""
    if "part" not in pages.columns:
        return extract(pages, part.rules, scope=part.scope, keep=keep, base=base)
    fields = list(dict.fromkeys(rule.field for rule in part.rules))
    wanted = pages.filter((F.col("part") == part.name) | F.col("part").isNull())
    return wanted.select(*keep, "scope_pos", *fields, "extract_error")


def listing_cards(pages: DataFrame, *, keep: Sequence[str] = ("url",), base: str = "url",
                  page_url: str = "page_url") -> DataFrame:
    """One row per person card: where it was found, its place, and the listing fields.

    A card without a link has an empty ``url`` and is still a row.
    """
    found = _rows(pages, CARDS, keep, base)
    kept = [F.col(c).alias(page_url if c == "url" else c) for c in keep]
    has_link = F.coalesce(F.get("hrefs", F.lit(0)), F.lit("")) != ""
    return found.filter(F.col("scope_pos").isNotNull()).select(
        *kept,
        F.col("scope_pos").alias("card_pos"),
        F.when(has_link, F.get("urls", F.lit(0))).otherwise("").alias("url"),
        first_text("names").alias("name"),
        first_text("dates").alias("dates"),
        join_labels("activities").alias("activity"),
    )


def page_errors(pages: DataFrame, *, keep: Sequence[str] = ("url",)) -> DataFrame:
    """Pages that cannot be read, with the reason; the other operators have no rows for them."""
    found = pages.filter(F.col("part").isNull()) if "part" in pages.columns else extract(pages, [Rule("root", "html")], keep=keep)
    return found.filter(F.col("extract_error").isNotNull()).select(*keep, F.col("extract_error").alias("error"))


def detail_fields(pages: DataFrame, *, keep: Sequence[str] = ("url",)) -> DataFrame:
    """The biography fields of each page; ``biography_url`` is the page's own URL.

    A page that cannot be read has only ``biography_url`` and ``biography_error``.
    """
    found = _rows(pages, DETAILS, keep)
    full_name = normalize_text(F.concat_ws(" ", first_text("given"), first_text("family")))
    fine = F.col("extract_error").isNull()

    def present(value):
        return F.when(fine, value)

    return found.select(
        *[c for c in keep if c != "url"],
        F.col("url").alias("biography_url"),
        present(first_truthy(full_name, first_text("og_title"))).alias("biography_name"),
        present(first_text("born")).alias("biography_birth_date"),
        present(first_text("died")).alias("biography_death_date"),
        present(join_labels("tags", distinct=True)).alias("biography_activities"),
        present(first_text("description")).alias("biography_text"),
        F.col("extract_error").alias("biography_error"),
    )


def index_links(pages: DataFrame, *, selector: str = fixed.INDEX_LINKS, keep: Sequence[str] = ("url",),
                base: str = "url", alias: str = "index_url", otherwise: str | None = None) -> DataFrame:
    """Distinct absolute links under ``selector``, numbered per page as first seen.

    A page without any gives the value of its column ``otherwise``, if that is named.
    """
    found = _rows(pages, Part("index", (Rule("hrefs", selector, attr="href", resolve=True),)), keep, base)
    links = F.array_distinct(F.filter("hrefs", lambda h: h != ""))
    if otherwise is not None:
        links = F.when(F.size(links) > 0, links).otherwise(F.array(otherwise))
    return found.select(*keep, F.posexplode(links).alias("link_pos", alias))


def pager_summary(pages: DataFrame, *, keep: Sequence[str] = ("url",), onward: bool = False) -> DataFrame:
    """Highest page number any pager entry shows, and the current one; 1 if none does.

    ``onward`` adds whether the page links any further: to the number after the current one, or by ``>``.
    """
    found = _rows(pages, PAGER, keep)

    def highest(labels):
        numbers = F.transform(labels, lambda label: leading_int(normalize_text(label)))
        return F.coalesce(F.array_max(numbers), F.lit(1).cast("bigint"))

    summary = found.filter(F.col("extract_error").isNull()).select(
        *keep,
        highest(F.concat("links", "spans")).alias("total_pages"),
        highest(F.col("spans")).alias("current_page"),
        "links", "link_ids",
    )
    if onward:
        def leads(link):
            label = normalize_text(link["links"])
            next_page = label.rlike("^[0-9]+$") & (label.try_cast("bigint") == F.col("current_page") + 1)
            return (F.coalesce(link["link_ids"], F.lit("")) != "") & (next_page | (label == fixed.PAGER_NEXT_LABEL))

        summary = summary.withColumn("onward", F.coalesce(F.exists(F.arrays_zip("links", "link_ids"), leads), F.lit(False)))
    return summary.drop("links", "link_ids")


def pager_links(pages: DataFrame, *, keep: Sequence[str] = ("url",)) -> DataFrame:
    """Pager links that carry an id: numbered pages and the ``>`` link.

    ``page_no`` is NULL for ``>``.  Of several links with one label the last counts.
    ``target`` is the form target the id stands for.
    """
    found = _rows(pages, PAGER_LINKS, keep)
    links = found.select(
        *keep, "scope_pos", F.get("ids", F.lit(0)).alias("dom_id"), first_text("labels").alias("label")
    ).filter(
        (F.coalesce("dom_id", F.lit("")) != "")
        & (F.col("label").rlike("^[0-9]+$") | (F.col("label") == fixed.PAGER_NEXT_LABEL))
    )
    return (
        links.select(
            *keep, "scope_pos", "dom_id",
            F.col("label").try_cast("bigint").alias("page_no"),
            (F.col("label") == fixed.PAGER_NEXT_LABEL).alias("is_next"),
        )
        .groupBy(*keep, "page_no", "is_next")
        .agg(F.max_by("dom_id", "scope_pos").alias("dom_id"))
        .withColumn("target", postback_target("dom_id"))
    )


def postback_target(dom_id):
    """Form target for a DOM id."""
    return F.replace(F.col(dom_id) if isinstance(dom_id, str) else dom_id, F.lit("_"), F.lit("$"))


