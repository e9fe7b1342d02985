"""The page reader, its expressions and the main text, against hand-made pages and plain versions."""

from __future__ import annotations

import random
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from newslake.functions import html, markup
from newslake.functions.markup import BESIDE, read_page
from newslake.operators import main_text
from tests.test_expressions import value


@pytest.mark.parametrize(
    "page, wanted",
    [
        ("<p>it&#8217;s caf&eacute; &#x27;x&#x27; &amp;lt; &bogus; &</p>", ["it\u2019s caf\u00e9 'x' &lt; &bogus; &"]),
        ("<p title='a>b'>one<p title=it's>two</P><div>no</div><p>three", ["one", "two", "three"]),
        ("<p>a<b>b<p>c</b>d</p>e", ["ab", "cd"]),
        ("<p>x<!-- <p>no</p> -->y</p><script>'<p>no</p>'</script><style><p></style><p>z", ["xy", "z"]),
        ("<p>a < b and 1<2</p></nope></p>", ["a < b and 1<2"]),
        ("<p>a<ul><li>no</ul>no<p>b<br>c", ["a", "bc"]),
        ("<p>open <a href=", ["open <a href="]),
        ("<!-- never closed <p>no</p>", []),
        ("", []),
    ],
)
def test_paragraphs(page, wanted):
    assert [p["text"].strip() for p in read_page(page)["paragraphs"]] == wanted


def test_attributes_in_any_form(spark):
    page = ("<HTML lang=ko><meta content='A &amp; &eacute;' NAME=author><meta property='og:site_name' content=\"it's\">"
            "<meta name=keywords content='a, b,,a'><meta property=article:tag content=c><meta name=author content=second>"
            "<meta name=description><div data-x='</div>' class='x Time&#66;lock'>03<i>:</i>22</div><a>no</a><a rel=x href='u?a=1&amp;b=2&copy=3&notit;&lt'>x</a>")
    at = html.Page(F.col("_page"))
    got = html.with_page(spark.createDataFrame([(page,), (None,), ("",)], "html string")).select(
        at.language(), at.meta_content("author"), at.meta_content("og:site_name"), at.meta_list("keywords", "article:tag"),
        at.meta_content("description"), at.class_text("timeblock"), at.first_link(), at.element_text("h1")).collect()
    assert list(got[0]) == ["ko", "A & \u00e9", "it's", ["a", "b", "c"], None, "03:22", "u?a=1&b=2&copy=3&notit;<", None]
    assert list(got[1]) == [None] * 8
    assert list(got[2]) == [None, None, None, [], None, None, None, None]
    assert value(spark, html.class_text(F.lit(page), "Absent")) is None


def test_time_grows_with_the_page_only():
    for piece in ("<a ", "<p x=\"'>", "</b><div>", "<!--x", "<script>", "<p><b>x", "&amp;<", "<a b='"):
        start = time.process_time()
        read_page(piece * 40000)
        assert time.process_time() - start < 5, piece


def plain_main_text(page):
    """The docstring of ``main_text`` in plain Python over the parsed arrays."""
    parsed = read_page(page)
    blocks = parsed["blocks"]
    raw = [0 if b["beside"] else 100 * (b["words"] - b["link_words"]) ** 2 // b["words"] for b in blocks]
    score = [0 if b["beside"] else (2 * raw[i] + (raw[i - 1] if i else 0) + (raw[i + 1] if i + 1 < len(raw) else 0)) // 4 for i, b in enumerate(blocks)]
    sums = {}
    for b, s in zip(blocks, score):
        if not b["beside"]:
            sums[b["parent"]] = sums.get(b["parent"], 0) + 2 * s
            sums[b["above"]] = sums.get(b["above"], 0) + s
    tag = lambda e: parsed["elements"][e]["tag"] if e >= 0 else ""
    if not sums:
        return []
    body = max(sums, key=lambda e: (sums[e] * (2 if tag(e) in main_text.PREFERRED else 1), -e))
    good = [not b["beside"] and 2 * b["link_words"] <= b["words"] for b in blocks]
    inside = [body in (b["parent"], b["above"]) for b in blocks]
    core = [s for s, g, i in zip(score, good, inside) if g and i]
    cut = sum(core) // len(core) if core and tag(body) not in main_text.PREFERRED else None
    return [b["text"] for b, s, g, i in zip(blocks, score, good, inside) if g and (i or (cut is not None and s >= cut))]


def test_main_text_against_a_plain_version(spark):
    rng = random.Random(3)
    words = lambda n: " ".join(rng.choice(["coin", "rate", "caf&eacute;", "x"]) for _ in range(n))

    def piece(depth):
        kind = rng.choice(["p", "p", "p", "div", "ul", "a", "text", "nav", "section", "article", "h2"])
        if kind == "text" or depth > 3:
            return words(rng.randint(0, 30))
        if kind == "a":
            return f"<a href=u>{words(rng.randint(1, 5))}</a>"
        if kind in ("p", "h2"):
            return f"<{kind}>{words(rng.randint(0, 60))}{rng.choice(['', '<a>x y</a>'])}" + rng.choice(["", f"</{kind}>"])
        return f"<{kind}>" + "".join(piece(depth + 1) for _ in range(rng.randint(0, 4))) + f"</{kind}>"

    pages = ["".join(piece(0) for _ in range(rng.randint(0, 6))) for _ in range(150)] + ["", None]
    frame = spark.createDataFrame(list(enumerate(pages)), "id int, html string")
    got = {r.id: r for r in main_text.with_main_text(frame, "id").collect()}
    assert len(got) == len(pages)
    for i, page in enumerate(pages):
        wanted = plain_main_text(page) if page else []
        assert (got[i].content, got[i].n_blocks) == ("\n".join(wanted), len(wanted)), page


def test_main_text_without_marks(spark):
    """Planted menus and footers go, planted bodies stay, whole and in order."""
    long = [" ".join(f"w{i}x{j}" for j in range(25 + i)) for i in range(4)]
    menu = "<div class=m><ul>" + "".join(f"<li><a href=/{i}>Go to place {i}</a></li>" for i in range(9)) + "</ul></div>"
    more = "<div>Read <a>another long story about coins and rates here</a> <a>and one more of them</a></div>"
    body = f"<div><h2>Short head</h2><p>{long[0]}<p>{long[1]}</p><p>Two words.</p><div><p>{long[2]}</div>{long[3]}</div>"
    page = f"<body>{menu}{body}{more}<div>Copyright someone</div><footer>{long[0]}</footer>{menu}"
    row = main_text.with_main_text(spark.createDataFrame([(1, page)], "id int, html string"), "id").first()
    assert row.content.split("\n") == ["Short head", long[0], long[1], "Two words.", long[2], long[3]]
    assert "footer" in BESIDE


def test_main_text_of_a_long_block(spark):
    """The square of its words is beyond an int."""
    body = " ".join(f"w{i}" for i in range(6000))
    row = main_text.with_main_text(spark.createDataFrame([(1, f"<p>{body}</p>")], "id int, html string"), "id").first()
    assert (row.content, row.n_blocks) == (body, 1)


def test_pages_of_a_batch_are_held_in_slices(monkeypatch):
    """Whatever a batch holds, the arrays of at most one slice are made at a time, in order."""
    monkeypatch.setattr(markup, "SLICE_BYTES", 100)
    pages = ["<p>" + "x" * n + "</p>" for n in (10, 300, 20, 20, 20, 60)]
    pages = [None, *pages[:3], "", *pages[3:], None]
    given = markup.read_batches(iter([pa.array(pages, pa.string()), pa.array([], pa.string()), pa.array([None, "a"], pa.string())]))
    parts = list(given)
    assert [len(p) for p in parts] == [2, 1, 4, 2, 2]
    found = [r for p in parts for r in p.to_pylist()]
    texts = [None if r is None else [p["text"] for p in r["paragraphs"]] for r in found]
    assert texts == [None if p is None else ["x" * p.count("x")] if p else [] for p in pages] + [None, []]
