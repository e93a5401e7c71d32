"""Main text of web pages by the distribution of text over lines.

A page is cut into lines at its block elements, and its markup is stripped. Lines inside
menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments are left out, unless such an
element is known by a class or id name only and holds most of the page's text. A line
weighs as much as it has text, a line of links nothing (one between two lines of text stays with them, though). The weights of ``WINDOW`` consecutive lines
are summed. Where the sums rise beyond the surge level a stretch of text begins, and where
they fall to nothing it ends.

The heaviest stretch tells what article markup is worth on a page. If half of it lies in
``article`` or ``main``, these hold the text, and their lines are taken, however short. If less
than a quarter does, they are cards beside the text and weigh nothing. Otherwise the text is
the lines of the stretches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from addrspark.llm.tables import table

#: Lines in a window.
WINDOW = 3
#: A stretch of text begins where a window reaches this share of the largest window.
SURGE = 0.1

# Elements of HTML, fixed by its standard.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html li main menu nav ol option p pre search section summary table tbody td tfoot th thead title tr ul video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "noscript", "template", "iframe", "textarea", "object", "canvas", "select", "title", "desc", "metadata", "annotation")
CLOSED_BY_BLOCK = frozenset(["p"])
BOILERPLATE = frozenset("nav footer aside form dialog menu head search".split())
MAIN = frozenset(["article", "main"])

#: Words of class and id names that mark boilerplate.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup "
    "modal newsletter subscribe subscription signup login sidebar side menu menus nav navbar navigation breadcrumb breadcrumbs footer header masthead "
    "topbar toolbar comment comments commentlist disqus reply replies respond discussion related recommended share sharing social widget pagination pager "
    "legal copyright disclaimer skip hidden".split())
#: Those of what readers write, which may be longer than the article.
COMMENTS = frozenset("comment comments commentlist disqus reply replies respond discussion".split())
#: Words beside which a mark tells of the layout, and beside which a header is that of the text.
LAYOUT, OF_TEXT = frozenset("no not with without has have hide hides category tag type format status".split()), frozenset("post entry article story".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar".split())

# An attribute by the states of the standard: quotes have a meaning only at the beginning of a value. One that is never closed has none.
_ATTRIBUTE = r"""([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?"""
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</?([a-zA-Z][^\s/>]*)((?:[\s/=]+|"
    + re.sub(r"\((?!\?)", "(?:", _ATTRIBUTE) + r")*+)(?:>|\Z)", re.S)
_ATTRIBUTES = re.compile(_ATTRIBUTE, re.S)
_NAMES = frozenset(["class", "id", "role", "hidden", "aria-hidden", "style"])
_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}
_WORDS = re.compile(r"[a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


PLAIN, NAMED, COMMENT, MARKED = range(4)


@dataclass
class Line:
    parts: list[str]
    mark: int
    main: bool
    heading: bool = False
    linked: int = 0
    boilerplate: bool = False

    @cached_property
    def text(self) -> str:
        return " ".join(unescape("".join(self.parts)).split())


def _marked(tag: str, attributes: str, in_main: bool) -> int:
    """Whether an element is boilerplate: ``MARKED`` by its tag, role or as hidden, or by its names, as a ``COMMENT`` or otherwise ``NAMED``."""
    if tag in BOILERPLATE or tag == "header" and not in_main:
        return MARKED
    if not attributes or tag in ("html", "body"):
        return PLAIN
    out = PLAIN
    for name, *values in _ATTRIBUTES.findall(attributes):
        value, name = "".join(values), name.lower()
        if name not in _NAMES:
            continue
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return MARKED
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return MARKED
        if name == "role" and value.lower() in ROLES:
            return MARKED
        if name in ("class", "id"):
            out = max(out, PLAIN, *(_named(_WORDS.findall(_CAMEL.sub(" ", one).lower()), in_main) for one in value.split()))
    return out


def _named(words: list[str], in_main: bool) -> int:
    """What one class or id says."""
    marks = MARKS.intersection(words)
    if in_main or not OF_TEXT.isdisjoint(words):
        marks -= {"header"}
    if not marks or words[0] in LAYOUT:
        return PLAIN
    return NAMED if marks.isdisjoint(COMMENTS) else COMMENT


def lines_of(html: str) -> list[Line]:
    """The page's lines in order. Unclosed elements end with the element around them."""
    out: list[Line] = []
    stack: list[tuple[str, int, bool, bool]] = []  # tag, innermost mark, inside article markup, inside a heading
    marks = [(PLAIN, 0, False, False)]  # kind, mark around it, inside article markup, on article markup
    mark, main, heading = 0, False, False
    links = at = 0
    line = Line([], 0, False)

    def cut() -> None:
        nonlocal line
        if line.parts:
            out.append(line)
        line = Line([], mark, main, heading)

    def text(begin: int, end: int) -> None:
        if end > begin:
            line.parts.append(html[begin:end])
            if links:
                line.linked += len(html[begin:end].strip())

    while match := _TOKEN.search(html, at):
        text(at, match.start())
        at = match.end()
        tag = (match[1] or "").lower()
        if not tag:
            continue
        if match[0][1] == "/":
            if tag == "a":
                links = max(0, links - 1)
            if tag in BLOCKS or any(t == tag and (b, m) != (mark, main) for t, b, m, _ in stack):
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == tag:
                        cut()
                        _, mark, main, heading = stack[k]
                        del stack[k:]
                        links = 0
                        line = Line([], mark, main, heading)
                        break
            continue
        if tag == "br":
            line.parts.append(" ")
            continue
        if tag in _RAW_END:
            end = _RAW_END[tag].search(html, at)
            at = end.end() if end else len(html)
            if tag == "select":
                line.parts.append(" ")
            continue
        if tag == "a":
            links += 1
        if tag in VOID:
            if tag in BLOCKS:
                cut()
            continue
        kind = _marked(tag, match[2] or "", main)
        if tag in BLOCKS or kind:
            if stack and stack[-1][0] in CLOSED_BY_BLOCK and tag in BLOCKS:
                _, mark, main, heading = stack.pop()
                links = 0
            cut()
            stack.append((tag, mark, main, heading))
            if kind:
                marks.append((kind, mark, main, tag in MAIN))
                mark = len(marks) - 1
            main, heading = main or tag in MAIN, heading or tag == "h1"
            line = Line([], mark, main, heading)
    text(at, len(html))
    cut()
    _judge(out, marks)
    return out


def _judge(lines: list[Line], marks: list[tuple[int, int, bool, bool]]) -> None:
    """Tell which lines are boilerplate. A name does not make one of an element that holds most of the page's text."""
    whole = [PLAIN] * len(marks)  # kind with those around
    size, main, comments = ([0] * len(marks) for _ in range(3))  # characters inside: of text, of that in article markup, of comments
    for i, (kind, around, *_) in enumerate(marks[1:], 1):
        whole[i] = max(kind, whole[around])
    for line in lines:
        if whole[line.mark] == COMMENT:
            comments[line.mark] += len(line.text)
        elif whole[line.mark] != MARKED:
            size[line.mark] += len(line.text)
            main[line.mark] += len(line.text) * line.main
    outside = main[0]  # in article markup without a mark
    for i in range(len(marks) - 1, 0, -1):
        for counts in (size, main, comments):
            counts[marks[i][1]] += counts[i]
    boilerplate = [False] * len(marks)
    for named_articles in (True, False):  # their names do not count if hardly any text is left, as in a list of them
        for i, (_, around, in_main, on_main) in enumerate(marks[1:], 1):
            most = 3 * size[i] > 2 * size[0] or 2 * size[i] > size[0] and 2 * main[i] > size[i] and not in_main
            stays = (most or on_main and not named_articles) and outside <= SURGE * size[i]
            boilerplate[i] = boilerplate[around] or whole[i] != NAMED or not stays
        left = sum(len(line.text) for line in lines if not boilerplate[line.mark])
        if left >= SURGE * size[0]:
            break
    for i, (kind, around, *_) in enumerate(marks[1:], 1):  # comments alone are the text
        if kind == whole[i] == COMMENT and not boilerplate[around]:
            boilerplate[i] = whole[around] != COMMENT and left >= SURGE * comments[i]
    for line in lines:
        line.boilerplate = boilerplate[line.mark]


def _stretches(weights: np.ndarray, window: int, surge: float) -> list[tuple[int, int]]:
    """First line and end of each stretch between a surge and a dive."""
    sums = np.convolve(weights, np.ones(window, np.int64))[window - 1 :]  # of the lines i to i + window - 1
    out: list[tuple[int, int]] = []
    i, level = 0, surge * sums.max()
    while i < len(weights):
        if weights[i] and sums[i] > level:  # a surge: the text goes on until a window is empty
            end = i
            while end < len(weights) and sums[end] > 0:
                end += 1
            out.append((i, end))
            i = end
        else:
            i += 1
    return out


def main_lines(lines: list[Line], window: int = WINDOW, surge: float = SURGE) -> list[str]:
    """The texts of the lines between surge and dive points, or of the article markup that holds them."""
    kept = [line for line in lines if line.text and not line.boilerplate]
    main = np.array([line.main for line in kept], bool)
    weights = np.array([0 if 2 * line.linked > len(line.text) else len(line.text) for line in kept], np.int64)
    if not weights.any():
        return [line.text for line in kept if line.main]  # links only
    begin, end = max(_stretches(weights, window, surge), key=lambda s: weights[s[0] : s[1]].sum())
    shares = [weights[a:b][main[a:b]].sum() / weights[a:b].sum() for a, b in ((begin, end), (0, len(kept)))]
    if max(shares) >= 0.5:
        return [line.text for line in kept if line.main]
    cards = main & (max(shares) < 0.25)
    weights = weights * ~cards
    stretches = _stretches(weights, window, surge)
    good = np.zeros(len(kept), bool)
    texts = weights > 0
    alone = ~texts & ~cards  # a linked line between two lines of text is one of them; several are a menu
    alone[1:-1] &= texts[:-2] & texts[2:]
    alone[[0, -1]] = False
    for begin, end in stretches:
        good[begin:end] = texts[begin:end] | alone[begin:end]
    before = np.flatnonzero(weights[: stretches[0][0]])[-1:].tolist()
    if before and kept[before[0]].heading:  # a title that links cut off
        good[before] = True
    return [line.text for line, g in zip(kept, good) if g]


def main_text(html: str | None) -> str:
    """The article of a page, its blocks joined by line ends; empty for a missing or empty page."""
    return "\n".join(main_lines(lines_of(html))) if html else ""


def extracted(pages: DataFrame, html: str = "html") -> DataFrame:
    """The rows of ``pages`` with ``text`` and ``n_chars`` (code points) of the main text.

    Defined cases: null and empty pages have an empty text; a page without markup is one block;
    a page without text outside of boilerplate has an empty text, but names alone do not make boilerplate of most of a page; unclosed and
    nested elements end with the element around them; repeated rows give repeated rows; an
    empty table gives an empty result. A column of the input named text or n_chars is replaced.
    """
    kept = [c for c in pages.columns if c not in (html, "text", "n_chars")]
    source = pages.select(*[F.col(f"`{c}`") for c in kept], F.col(html).alias("_html"))
    schema = source.drop("_html").withColumn("text", F.lit("")).withColumn("n_chars", F.lit(0).cast("long")).schema

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column("_html").to_pylist()]
            columns = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=[*kept, "text", "n_chars"])

    return source.mapInArrow(extract, schema)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extracted(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
