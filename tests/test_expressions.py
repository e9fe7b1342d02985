"""Text, time and HTML expressions on literal rows."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from newslake.functions import html, text, times
from newslake.operators import news


def value(spark, column, **inputs):
    frame = spark.range(1).withColumns({k: F.lit(v) for k, v in inputs.items()})
    return frame.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "given, wanted",
    [
        ("홍길동 a.b+c@mail.example.com 기사", "홍길동  기사"),
        ("본문 <저작권자 ⓒ 뉴스, 무단전재 금지>", "본문"),
        ("(서울=뉴스) 홍길동 기자 = 본문", "본문"),
        ("[서울 홍길동 기자] 본문", "본문"),
        ("　\n 본문\t ", "본문"),
        ("(서울=뉴스)\n홍길동 기자 = 본문", "(서울=뉴스)\n홍길동 기자 = 본문"),
        ("", ""),
        (None, None),
    ],
)
def test_clean_boilerplate(spark, given, wanted):
    got = value(spark, text.clean_boilerplate(F.col("t")), t=given) if given is not None else value(
        spark, text.clean_boilerplate(F.lit(None).cast("string"))
    )
    assert got == wanted


def test_only_matching_sources_are_cleaned(spark):
    mail = " x@y.example "
    assert value(spark, text.refined_content(F.lit("coinness"), F.lit(mail))) == ""
    assert value(spark, text.refined_content(F.lit("coindesk"), F.lit(mail))) == mail.strip()
    none = F.lit(None).cast("string")
    assert value(spark, text.refined_content(none, F.lit(mail))) == mail.strip()
    assert value(spark, text.refined_content(F.lit("coinness"), none)) is None


@pytest.mark.parametrize(
    "source, kind, wanted",
    [("a", "b", "a-b"), ("a", "", "a"), ("a", None, "a"), (None, "b", None)],
)
def test_source_label(spark, source, kind, wanted):
    columns = [F.lit(v).cast("string") for v in (source, kind)]
    assert value(spark, text.source_label(*columns)) == wanted


def test_url_and_ids(spark):
    none = F.lit(None).cast("string")
    assert value(spark, text.article_url(F.lit(""), F.lit("u"))) == "u"
    assert value(spark, text.article_url(F.lit("l"), F.lit("u"))) == "l"
    assert value(spark, text.article_url(none, none)) == ""
    by_text = value(spark, text.article_id(F.lit(""), F.lit("body")))
    assert by_text == value(spark, F.md5(F.lit("body")))
    assert by_text != value(spark, text.article_id(F.lit("u"), F.lit("body")))
    one = value(spark, text.chunk_id(F.lit("u"), F.lit("x"), F.lit(1)))
    assert one == value(spark, F.md5(F.lit("u#1")))


def test_titles(spark):
    none = F.lit(None).cast("string")
    assert value(spark, news.pick_title(F.lit(""), F.lit("listed"))) == "listed"
    assert value(spark, news.pick_title(none, none)) == text.NO_TITLE


@pytest.mark.parametrize(
    "given, wanted",
    [
        ("2026-01-27T18:38:17.200263+00:00", datetime(2026, 1, 27, 18, 38, 17, 200263)),
        ("2026-01-27T18:38:17+09:00", datetime(2026, 1, 27, 9, 38, 17)),
        ("not a date", None),
        ("", None),
    ],
)
def test_parse_time(spark, given, wanted):
    got = value(spark, times.parse_time(F.lit(given)).cast("timestamp_ntz"))
    assert got == wanted


@pytest.mark.parametrize(
    "clock, anchor, wanted",
    [
        ("23:58", "2026-01-28 00:05:00", datetime(2026, 1, 27, 23, 58)),
        ("00:05", "2026-01-28 00:05:00", datetime(2026, 1, 28, 0, 5)),
        ("3:07", "2026-01-28 12:00:00", datetime(2026, 1, 28, 3, 7)),
        ("25:00", "2026-01-28 12:00:00", None),
        ("now", "2026-01-28 12:00:00", None),
    ],
)
def test_clock(spark, clock, anchor, wanted):
    at = times.clock_to_time(F.lit(clock), F.lit(anchor).cast("timestamp"))
    assert value(spark, at.cast("timestamp_ntz")) == wanted


@pytest.mark.parametrize(
    "day, clock, wanted",
    [
        ("2026년 1월 23일 금요일", "13:09", datetime(2026, 1, 23, 13, 9)),
        ("날짜 정보 없음", "13:09", datetime(2026, 2, 2, 13, 9)),
        ("2026년 2월 31일", "13:09", datetime(2026, 2, 2, 13, 9)),
        ("2026년 1월 23일", "soon", datetime(2026, 2, 2, 8, 0, 5)),
    ],
)
def test_korean_date(spark, day, clock, wanted):
    anchor = F.lit("2026-02-02 08:00:05").cast("timestamp")
    at = times.dated_clock_to_time(F.lit(day), F.lit(clock), anchor)
    assert value(spark, at.cast("timestamp_ntz")) == wanted


def test_time_texts(spark):
    at = F.lit("2026-01-27 18:38:17.200263").cast("timestamp")
    assert value(spark, times.iso(at)) == "2026-01-27T18:38:17.200263+00:00"
    assert value(spark, times.display(at)) == "2026-01-27 18:38:17 UTC"
    assert value(spark, times.iso_or_raw(F.lit("Tue, 27 Jan"))) == "Tue, 27 Jan"


PAGE = """
<div class="top"><p>menu</p></div>
<div class="a document-body b"><p> one &amp; <b>two</b></p><div class="box"><p>three<p>four</div>
  <p></p><p>five</p></div>
<p>outside</p>
<DIV CLASS="document-body"><p>six</p><script>var t = "<p>no</p>";</script></DIV>
<div class="document-body"><p>last is dropped</p></div>
"""


def test_body_text(spark):
    pages = spark.createDataFrame([(PAGE,), ("<p>x</p>",)], "html string")
    got = [r.content for r in html.with_body_text(pages, "document-body").collect()]
    assert got == ["one & two three four five six", ""]


def test_html_fields(spark):
    block = '<div class="TimeBlock"> 03:22 </div><div class="T"><div>a</div> &lt;b&gt;</div><a href="u">x</a>'
    assert value(spark, html.class_text(F.lit(block), "TimeBlock")) == "03:22"
    assert value(spark, html.class_text(F.lit(block), "T\\b")) == "a <b>"
    assert value(spark, html.class_text(F.lit(block), "Absent")) is None
    assert value(spark, html.first_link(F.lit(block))) == "u"
    assert value(spark, html.first_link(F.lit("<a>x</a>"))) is None


def test_page_metadata(spark):
    page = '<html lang="ko"><title>t</title><meta name="author" content="A &amp; B">'
    assert value(spark, html.meta_content(F.lit(page), "author")) == "A & B"
    assert value(spark, html.language(F.lit(page))) == "ko"
    assert value(spark, html.host(F.lit("https://user@news.example:8080/a?b"))) == "news.example"
    assert value(spark, html.host(F.lit("not a url"))) is None


@pytest.mark.parametrize(
    "given, wanted",
    [
        ("Tue, 27 Jan 2026 15:10:00 +0000", "2026-01-27T15:10:00.000000+00:00"),
        ("Tue, 27 Jan 2026 15:10:00 +0900", "2026-01-27T06:10:00.000000+00:00"),
        ("7 feb 2026 15:10 GMT", "2026-02-07T15:10:00.000000+00:00"),
        ("Tue, 99 Jan 2026 15:10:00 GMT", "Tue, 99 Jan 2026 15:10:00 GMT"),
        ("2026-01-27T15:10:00Z", "2026-01-27T15:10:00.000000+00:00"),
        ("soon", "soon"),
    ],
)
def test_feed_dates(spark, given, wanted):
    assert value(spark, times.iso_or_raw(F.col("t")), t=given) == wanted
