"""String expressions used by refinement, keys and ids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Sources whose articles carry agency boilerplate start with this prefix.
CLEANED_SOURCE_PREFIX = "coinness"
# Boilerplate: e-mail address, copyright tag, agency by-line, bracketed by-line.
BOILERPLATE = [
    r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}",
    r"<저작권자.*?>",
    r"\(.*?=.*?\).*?기자 =",
    r"\[.*?기자\]",
]
# A text without any of these matches none of the patterns above.
BOILERPLATE_SIGNS = ["@", "<저작권자", "기자"]
NO_TITLE = "제목 없음"
# Every character Unicode counts as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# -----------------------------------------------------------------------------


def strip(text: Column) -> Column:
    """Trim all Unicode white space; the built-in ``trim`` takes spaces only."""
    return F.btrim(text, F.lit(WHITESPACE))


def or_none(text: Column) -> Column:
    """Empty text counts as absent."""
    return F.nullif(text, F.lit(""))


def first_present(*texts: Column) -> Column:
    """The first text that is neither null nor empty, else ''."""
    return F.coalesce(*[or_none(t) for t in texts], F.lit(""))


def clean_boilerplate(text: Column) -> Column:
    """Remove e-mail addresses, copyright tags and by-lines, then trim.

    ``(?d)`` makes the dot stop at line feeds only, whatever other line ends the
    text holds. Texts without a sign of boilerplate skip the pattern, which tries
    an address at every letter.
    """
    cleaned = F.regexp_replace(text, "(?d)" + "|".join(BOILERPLATE), "")
    has_sign = reduce(Column.__or__, [F.contains(text, F.lit(s)) for s in BOILERPLATE_SIGNS])
    return strip(F.when(has_sign, cleaned).otherwise(text))


def refined_content(source: Column, content: Column) -> Column:
    """Clean the sources that need it; trim the others."""
    matches = F.coalesce(source.startswith(CLEANED_SOURCE_PREFIX), F.lit(False))
    return F.when(matches, clean_boilerplate(content)).otherwise(strip(content))


def source_label(source: Column, news_type: Column) -> Column:
    """``source-news_type``; an absent or empty type adds nothing."""
    return F.when(source.isNotNull(), F.concat_ws("-", source, or_none(news_type)))


def article_url(link: Column, url: Column) -> Column:
    """``link`` if present, else ``url``, else ''."""
    return first_present(link, url)


def article_id(url: Column, content: Column) -> Column:
    """Stable id: hash of the URL, of the text where there is no URL."""
    return F.md5(F.coalesce(or_none(url), content))


def chunk_id(url: Column, content: Column, chunk_index: Column) -> Column:
    """Stable id of one chunk, so that re-running an ingest overwrites it."""
    base = F.coalesce(or_none(url), content)
    return F.md5(F.concat(base, F.lit("#"), chunk_index.cast("string")))
