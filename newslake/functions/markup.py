"""Stored HTML to arrays: elements with their attributes, paragraphs and blocks of text.

One pass over a page with a stack of open elements, in time linear in the page. Everything that is chosen, joined or
scored afterwards is column expressions over the arrays (``functions/html.py``, ``operators/main_text.py``).

* Attributes stand in either quotes or in none, in any order; the first of a name counts. Named and numeric character
  references are resolved in text, as HTML does also without a semicolon; in attributes only where no letter, digit or "="
  follows, so the parameters of a URL stay.
* Comments, scripts, styles and declarations have no text. What is left of an unfinished tag at the end is text.
* A paragraph ends with its end tag, the next paragraph, or the start or end of any other block. An end tag closes
  everything open inside its element; one without an element is ignored. What is still open ends with the page.
* Null HTML gives null, empty HTML empty arrays.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from html.entities import html5

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# Kinds of elements as HTML defines them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
# Blocks that stand in a container rather than being one.
LEAVES = frozenset("dd dt figcaption h1 h2 h3 h4 h5 h6 hr li p pre summary tbody td tfoot th thead tr".split())
RAW = frozenset("script style noscript template iframe".split())  # no text at all
NO_BODY = frozenset("title textarea select button option".split())  # text that is not of the body
BESIDE = frozenset("nav footer aside form".split())  # blocks beside the body

SCHEMA = (
    "struct<elements: array<struct<tag: string, attributes: map<string, string>, first: int, last: int>>, "
    "texts: array<string>, paragraphs: array<struct<text: string, at: int>>, "
    "blocks: array<struct<text: string, words: int, link_words: int, parent: int, above: int, beside: boolean>>>"
)
_ELEMENT = pa.struct([("tag", pa.string()), ("attributes", pa.map_(pa.string(), pa.string())), ("first", pa.int32()), ("last", pa.int32())])
_PARAGRAPH = pa.struct([("text", pa.string()), ("at", pa.int32())])
_BLOCK = pa.struct([("text", pa.string()), ("words", pa.int32()), ("link_words", pa.int32()), ("parent", pa.int32()), ("above", pa.int32()), ("beside", pa.bool_())])
_PAGE = pa.struct([("elements", pa.list_(_ELEMENT)), ("texts", pa.list_(pa.string())), ("paragraphs", pa.list_(_PARAGRAPH)), ("blocks", pa.list_(_BLOCK))])

# A quote opens a value only after "=", so a lone apostrophe swallows nothing; possessive, so nothing is tried twice.
_MARK = re.compile(
    r"<(?:!--.*?(?:-->|\Z)|(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)"
    r"(?P<rest>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)>|[!?/][^>]*+>)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s]+)))?")
_REFERENCE = re.compile(r"&(?:#[0-9a-zA-Z]++|[a-zA-Z][a-zA-Z0-9]*+)(?:;|(?![=a-zA-Z0-9]))")
SLICE_BYTES = 1 << 20  # of HTML whose arrays a task holds at once; they take many times the page
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW}


def _attribute(value: str) -> str:
    return _REFERENCE.sub(lambda m: unescape(m[0]) if m[0][1] == "#" or m[0][1:] in html5 else m[0], value)


class _Builder:
    """What is open, and what was found so far."""

    def __init__(self):
        self.elements, self.texts, self.paragraphs, self.blocks = [], [], [], []
        self.open: list[tuple[str, int]] = []
        self.count = Counter()
        self.containers: list[int] = []
        self.paragraph: tuple[list[str], int] | None = None
        self.block: list[str] = []
        self.links: list[str] = []

    def text(self, raw: str) -> None:
        if not raw:
            return
        plain = unescape(raw) if "&" in raw else raw
        self.texts.append(plain)
        if self.paragraph:
            self.paragraph[0].append(plain)
        if not any(self.count[t] for t in NO_BODY):
            self.block.append(plain)
            if self.count["a"]:
                self.links.append(plain)

    def boundary(self) -> None:
        """The start or end of a block ends the paragraph and the block before."""
        if self.paragraph:
            self.paragraphs.append({"text": "".join(self.paragraph[0]), "at": self.paragraph[1]})
            self.paragraph = None
        words = "".join(self.block).split()
        if words:
            up = [-1, -1, *self.containers[-2:]]
            self.blocks.append({"text": " ".join(words), "words": len(words), "link_words": min(len(words), len(" ".join(self.links).split())),
                                "parent": up[-1], "above": up[-2], "beside": any(self.count[t] for t in BESIDE)})
        self.block, self.links = [], []

    def start(self, tag: str, attributes: list[tuple[str, str]]) -> None:
        if tag in BLOCKS:
            self.boundary()
            if self.count["p"]:
                self.close("p")
        place = len(self.elements)
        self.elements.append({"tag": tag, "attributes": attributes, "first": len(self.texts), "last": len(self.texts)})
        if tag in VOID:
            return
        self.open.append((tag, place))
        self.count[tag] += 1
        if tag == "p":
            self.paragraph = [], len(self.texts)
        elif tag in BLOCKS and tag not in LEAVES:
            self.containers.append(place)

    def close(self, tag: str) -> None:
        """Close the innermost element of a kind and all that is open inside."""
        while self.count[tag]:
            name, place = self.open.pop()
            if name in BLOCKS:
                self.boundary()
            self.elements[place]["last"] = len(self.texts)
            self.count[name] -= 1
            if self.containers and self.containers[-1] == place:
                self.containers.pop()
            if name == tag:
                break

    def end(self, tag: str) -> None:
        if tag in BLOCKS:
            self.boundary()
        self.close(tag)


def read_page(html: str) -> dict:
    """The arrays of one page."""
    found = _Builder()
    at, limit = 0, html.rfind(">") + 1
    while mark := _MARK.search(html, at, limit):
        found.text(html[at : mark.start()])
        at = mark.end()
        if not mark["tag"]:
            continue
        tag = mark["tag"].lower()
        if mark["end"]:
            found.end(tag)
            continue
        attributes: dict[str, str] = {}
        for name, *values in _ATTRIBUTE.findall(mark["rest"]):
            attributes.setdefault(name.lower(), _attribute("".join(values)))
        found.start(tag, list(attributes.items()))
        if tag in RAW:
            end = _RAW_END[tag].search(html, at)
            at = end.start() if end else len(html)
    found.text(html[at:])
    while found.open:
        found.close(found.open[-1][0])
    found.boundary()
    return {"elements": found.elements, "texts": found.texts, "paragraphs": found.paragraphs, "blocks": found.blocks}


def slices(pages: pa.Array) -> Iterator[pa.Array]:
    """A batch of pages in runs of at most ``SLICE_BYTES``; a longer page is a run of its own."""
    start = held = 0
    for i, size in enumerate(pc.fill_null(pc.binary_length(pages), 0).to_pylist()):
        if held and held + size > SLICE_BYTES:
            yield pages.slice(start, i - start)
            start, held = i, 0
        held += size
    if len(pages):
        yield pages.slice(start)


def read_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The arrays of all pages, given out slice by slice, so that no batch is held as a whole."""
    for batch in batches:
        for part in slices(batch):
            yield pa.array([None if p is None else read_page(p) for p in part.to_pylist()], _PAGE)


def parsed(html: Column) -> Column:
    """The arrays of a page, a struct as in ``SCHEMA``."""

    @F.arrow_udf(SCHEMA)
    def read(pages: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from read_batches(pages)

    return read(html)
