"""HTML expressions over stored pages.

A page is parsed once into arrays (``functions/markup.py``); these expressions choose from them. Blocks are found by
class name fragments, as a crawler's CSS selectors do. Every expression takes the HTML or, to parse a page once for many
fields, the ``Page`` of its parsed column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.functions.markup import parsed
from newslake.functions.text import or_none, strip


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, inside a lambda too. What ``use`` needs of the page is part of the
    value, since a lambda may not call the parser."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


class Page:
    """Expressions over the struct that ``markup.parsed`` made of a page."""

    def __init__(self, page: Column):
        self.page = page

    def elements(self, tag: str) -> Column:
        return F.filter(self.page["elements"], lambda e: e["tag"] == tag)

    def text_of(self, element: Column) -> Column:
        """Text inside an element, tags dropped, stripped; null without one."""
        def inside(both: Column) -> Column:
            e = both["element"]
            text = F.array_join(F.slice(both["texts"], e["first"] + 1, e["last"] - e["first"]), "")
            return F.when(e.isNotNull(), strip(text))
        return _let(F.struct(element.alias("element"), self.page["texts"].alias("texts")), inside)

    def divs_with_class(self, fragment: str) -> Column:
        """The ``<div>`` elements whose class contains the fragment, a pattern."""
        return F.filter(self.elements("div"), lambda e: F.coalesce(e["attributes"]["class"].rlike(f"(?i){fragment}"), F.lit(False)))

    def class_text(self, fragment: str) -> Column:
        return self.text_of(F.get(self.divs_with_class(fragment), F.lit(0)))

    def body_text(self, container_class: str) -> Column:
        """The paragraphs of all matching containers but the last, joined by a space."""
        found = self.divs_with_class(container_class)
        kept = F.slice(found, F.lit(1), F.greatest(F.size(found) - 1, F.lit(0)))
        ranges = F.transform(kept, lambda e: F.struct(e["first"].alias("first"), e["last"].alias("last")))

        def paragraphs(both: Column) -> Column:
            chosen = F.filter(both["paragraphs"], lambda p: F.exists(both["ranges"], lambda r: (p["at"] >= r["first"]) & (p["at"] < r["last"])))
            return F.array_join(F.filter(F.transform(chosen, lambda p: strip(p["text"])), lambda t: t != ""), " ")
        return _let(F.struct(ranges.alias("ranges"), self.page["paragraphs"].alias("paragraphs")), paragraphs)

    def first_attribute(self, tag: str, name: str) -> Column:
        """The attribute of the first element of a kind that has it; null if none or empty."""
        return or_none(F.get(F.array_compact(F.transform(self.elements(tag), lambda e: e["attributes"][name])), F.lit(0)))

    def first_link(self) -> Column:
        return self.first_attribute("a", "href")

    def language(self) -> Column:
        return self.first_attribute("html", "lang")

    def element_text(self, tag: str) -> Column:
        return or_none(self.text_of(F.get(self.elements(tag), F.lit(0))))

    def meta_contents(self, *names: str) -> Column:
        """Stripped contents of ``<meta name|property|itemprop="...">`` of any of the names, in page order, empty ones dropped."""
        def named(e: Column) -> Column:
            keys = F.array(*(F.lower(strip(e["attributes"][k])) for k in ("name", "property", "itemprop")))
            return F.coalesce(F.arrays_overlap(keys, F.array(*map(F.lit, names))), F.lit(False))
        found = F.transform(F.filter(self.elements("meta"), named), lambda e: strip(e["attributes"]["content"]))
        return F.filter(found, lambda t: t != "")

    def meta_content(self, *names: str) -> Column:
        return F.get(self.meta_contents(*names), F.lit(0))

    def meta_list(self, *names: str) -> Column:
        """Contents that list several values, split at commas; each value once."""
        parts = F.transform(F.flatten(F.transform(self.meta_contents(*names), lambda t: F.split(t, ","))), strip)
        return F.array_distinct(F.filter(parts, lambda t: t != ""))


def with_page(pages: DataFrame, name: str = "_page") -> DataFrame:
    """Add the parsed page as a column, for ``Page``."""
    return pages.withColumn(name, parsed(F.col("html")))


def with_body_text(pages: DataFrame, container_class: str, name: str = "content") -> DataFrame:
    """Add the paragraphs of all matching containers but the last, joined by a space; empty without any."""
    text = F.coalesce(Page(F.col("_page")).body_text(container_class), F.lit(""))
    return with_page(pages).withColumn(name, text).select(*pages.columns, name)


def class_text(html: Column, fragment: str) -> Column:
    """Text of the first ``<div>`` with the class fragment; null if none."""
    return Page(parsed(html)).class_text(fragment)


def first_link(html: Column) -> Column:
    return Page(parsed(html)).first_link()


def element_text(html: Column, tag: str) -> Column:
    """Text of the first element of a kind; null if absent or empty."""
    return Page(parsed(html)).element_text(tag)


def meta_content(html: Column, name: str) -> Column:
    """``content`` of the first ``<meta>`` of a name that has one; null if absent."""
    return Page(parsed(html)).meta_content(name)


def language(html: Column) -> Column:
    return Page(parsed(html)).language()


def host(url: Column) -> Column:
    """Host of a URL without its port."""
    return or_none(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
