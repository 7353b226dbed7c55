"""Main text of web pages as a maximum-scoring subsequence.

A page is a sequence of words and tags. Words score positive and tags negative, words in
links and in furniture (navigation, forms, adverts and the like) negative too. The weights
are log odds from labelled pages, that is pages that mark their main text by an ``article``
or ``main`` element. One linear scan finds the contiguous region with the greatest sum; its
text without furniture is the result.
"""

from __future__ import annotations

import html as references
import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Elements of HTML that start and end a line of text.
BLOCKS = frozenset("""
    address article aside blockquote body br caption center dd details dialog dir div dl dt
    fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend
    li main menu nav ol option p pre search section summary table tbody td tfoot th thead
    title tr ul
""".split())
# Elements whose content is no markup.
RAW = frozenset("script style title textarea noscript iframe noframes noembed xmp template svg math".split())
# Elements that are furniture wherever they stand.
FURNITURE = frozenset("head nav footer aside form menu button select dialog object canvas".split())
CONTENT = frozenset(("article", "main"))
# Words in a class, id or role that mark furniture.
MARKS = frozenset("""
    ad ads adbox advert adverts advertisement advertising banner breadcrumb breadcrumbs comment
    comments complementary contentinfo cookie cookies consent disqus footer gdpr login masthead
    menu modal nav navbar navigation newsletter notice notices pagination paywall popup promo
    related replies respond share sharing sidebar signup skip social sponsor sponsored subscribe
    toolbar topbar widget
""".split())

_TAG = re.compile(
    r"<!--(?:.*?--!?>|.*)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^>\"']*+)*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>"
    r"|<[!?/][^>]*>?"
    r"|<[a-zA-Z][^>]*\Z", re.S)
_NAMED = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())

# Words of a name that say what kind of box an element is.
_BOXES = frozenset("""
    area bar block bottom box button buttons container icon icons inner links list main outer
    panel site slot top unit wrap wrapper
""".split())
# Elements that no class or id makes furniture.
_UNMARKED = frozenset("html body h1 h2 h3 h4 h5 h6 hgroup".split())

# Fixed values, after the HTML standard: what the start of an element ends, and the elements
# beyond which it ends nothing.
_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
_TABLE = frozenset("table caption colgroup thead tbody tfoot tr td th".split())
_TABLES = frozenset(("table",))
_SCOPE = frozenset("button caption object table td th".split())
_LISTS = BLOCKS - {"address", "body", "br", "dd", "div", "dt", "html", "li", "option", "p"} | _SCOPE
_SELECTS = frozenset("select datalist".split())
_GROUPS = _SELECTS | {"optgroup"}
_BLOCK_WALL = BLOCKS
_NO_WALL: frozenset[str] = frozenset()
_WALLS = (_TABLES, _SCOPE, _LISTS, _SELECTS, _GROUPS, _BLOCK_WALL, _NO_WALL)
_WALLS_OF = {name: [w for w in _WALLS if name in w] for name in frozenset().union(*_WALLS)}
_P_END = frozenset("""
    address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section
    summary table ul
""".split())
_CELLS, _ROWS = ("td", "th"), ("tr", "td", "th")
_SECTIONS = ("caption", "colgroup", "thead", "tbody", "tfoot", *_ROWS)
_ENDED_BY: dict[str, list[tuple[tuple[str, ...], frozenset[str]]]] = {
    "li": [(("li",), _LISTS)], "dd": [(("dd", "dt"), _LISTS)], "dt": [(("dd", "dt"), _LISTS)],
    "td": [(_CELLS, _TABLES)], "th": [(_CELLS, _TABLES)], "tr": [(_ROWS, _TABLES)],
    "thead": [(_SECTIONS, _TABLES)], "tbody": [(_SECTIONS, _TABLES)], "tfoot": [(_SECTIONS, _TABLES)],
    "option": [(("option",), _GROUPS)], "optgroup": [(("option", "optgroup"), _SELECTS)],
}
for _name in _P_END:
    _ENDED_BY.setdefault(_name, []).append((("p",), _SCOPE))

WORD, LINK, FURNITURE_WORD = "word", "link word", "furniture word"
LIMIT = 3.0


@dataclass(frozen=True)
class Item:
    """A piece of text, or a tag where ``tag`` is set."""

    tag: str = ""
    text: str = ""
    link: bool = False
    furniture: bool = False
    content: bool = False  # inside the element that marks the main text

    def features(self) -> Iterator[tuple[str, int]]:
        if self.tag:
            yield f"<{self.tag}>", 1
        elif words := len(self.text.split()):
            yield FURNITURE_WORD if self.furniture else LINK if self.link else WORD, words


def _is_mark(name: str) -> bool:
    """Whether a class, id or role says as a whole that its element is furniture: all its
    words are marks, or say no more than what kind of box it is. So ``cookie-notice`` and
    ``footer-links``, but not ``has-sidebar``."""
    words = {w.lower() for w in _NAME_WORD.findall(name)}
    return bool(words & MARKS) and all(w in MARKS or w in _BOXES or w.isdigit() for w in words)


def _marked(name: str, attributes: str) -> bool:
    """Whether an element is furniture by its name, class, id or role."""
    if name in FURNITURE:
        return True
    if not attributes or name in CONTENT or name in _UNMARKED:
        return False
    return any(_is_mark(n) for found in _NAMED.findall(attributes) for n in "".join(found).split())


class _Open:
    """Elements that are open, with HTML's implied end tags."""

    def __init__(self) -> None:
        self._stack: list[str] = []
        self._at: dict[str, list[int]] = {}  # places in the stack by name
        self._walls: dict[frozenset[str], list[int]] = {w: [] for w in _WALLS}  # places in the stack
        self.furniture = -1  # place of the element that is furniture

    def _last(self, name: str) -> int:
        at = self._at.get(name)
        return at[-1] if at else -1

    def _cut(self, size: int) -> None:
        while len(self._stack) > size:
            name = self._stack.pop()
            self._at[name].pop()
            for wall in _WALLS_OF.get(name, ()):
                self._walls[wall].pop()
        if self.furniture >= size:
            self.furniture = -1

    def _end_within(self, name: str, wall: frozenset[str]) -> bool:
        at, walls = self._last(name), self._walls[wall]
        if at < 0 or (walls and walls[-1] > at):
            return False
        self._cut(at)
        return True

    def start(self, name: str) -> None:
        """End what the start of ``name`` ends, then open it."""
        if self._at.get("head") and name not in _HEAD:
            self._cut(self._last("head"))
        for ended, wall in _ENDED_BY.get(name, ()):
            while any(self._end_within(e, wall) for e in ended):
                pass
        if name in _VOID:
            return
        for wall in _WALLS_OF.get(name, ()):
            self._walls[wall].append(len(self._stack))
        self._at.setdefault(name, []).append(len(self._stack))
        self._stack.append(name)

    def mark(self) -> None:
        self.furniture = len(self._stack) - 1

    def end(self, name: str) -> None:
        """Close the nearest such element and all in it. An end tag in a cell ends nothing
        outside of its table, and one of an inline element no block."""
        if self.furniture >= 0 and self._last(name) == self.furniture:
            self._cut(self.furniture)
        elif name in _TABLE:
            self._end_within(name, _TABLES)
        elif name in BLOCKS or name in _SCOPE:
            self._end_within(name, _SCOPE if name not in _SCOPE else _NO_WALL)
        else:
            self._end_within(name, _BLOCK_WALL)


def items(page: str) -> list[Item]:
    """Words and tags in page order. Furniture lasts to the end of its element, that is its
    end tag, one implied by what follows, or the end of its parent, or to the start of the
    marked main text; ``header`` is furniture outside of that."""
    out: list[Item] = []
    links = content = 0
    opened = _Open()
    position = 0
    while position < len(page):
        match = _TAG.search(page, position)
        text = page[position:match.start() if match else len(page)]
        if text:
            out.append(Item(text=references.unescape(text), link=links > 0,
                            furniture=opened.furniture >= 0, content=content > 0))
        if not match:
            break
        position = match.end()
        name = (match[2] or match[5] or "").lower()
        if not name:
            continue
        closing = bool(match[1] or match[4])
        attributes = match[3] or match[6] or ""
        if not closing and name in RAW and not attributes.rstrip().endswith("/"):
            end = re.compile(rf"</{name}\b[^>]*>?", re.I).search(page, position)
            position = end.end() if end else len(page)
            out.append(Item(tag=name, furniture=True, content=content > 0))
            continue
        if name in CONTENT and not closing and not content:
            opened.furniture = -1
        if name in CONTENT:
            content = max(0, content + (-1 if closing else 1))
        if name == "a":
            links = 0 if closing else 1
        if closing:
            opened.end(name)
        else:
            opened.start(name)
            if opened.furniture < 0 and name not in _VOID and (
                    _marked(name, attributes) or (name == "header" and not content)):
                opened.mark()
        out.append(Item(tag=name, furniture=opened.furniture >= 0, content=content > 0))
    return out


def best_region(found: list[Item], weights: Mapping[str, float]) -> tuple[int, int]:
    """Bounds of the contiguous items with the greatest sum, the first such; empty if none is positive."""
    best, region, total, start = 0.0, (0, 0), 0.0, 0
    for i, item in enumerate(found):
        total += sum(n * weights.get(name, weights["<>"]) for name, n in item.features())
        if total <= 0:
            total, start = 0.0, i + 1
        elif total > best:
            best, region = total, (start, i + 1)
    return region


def main_text(page: str, weights: Mapping[str, float]) -> str:
    """Lines of the best region without furniture: white space is one blank, blocks are lines."""
    found = items(page)
    start, end = best_region(found, weights)
    lines, line = [], []
    for item in found[start:end]:
        if item.tag:
            if item.tag in BLOCKS:
                lines.append("".join(line))
                line = []
        elif not item.furniture:
            line.append(item.text)
    lines.append("".join(line))
    return "\n".join(t for t in (" ".join(x.split()) for x in lines) if t)


DEFAULT_WEIGHTS = {WORD: 1.0, LINK: -0.5, FURNITURE_WORD: -1.0, "<>": -0.5}


def learn_weights(pages: DataFrame, *, html: str = "html") -> dict[str, float]:
    """Log odds of each feature inside and outside the marked main text of all labelled pages.

    At most as many features as HTML has elements, and three for words, reach the driver;
    names that are no common elements count as one. Without labelled pages the default
    weights hold.
    """
    known = BLOCKS | RAW | FURNITURE | _VOID | {"a", "b", "i", "em", "strong", "span", "u", "small", "code"}

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[tuple[str, bool]] = Counter()
        for batch in batches:
            for page in batch.column(0):
                found = items(page.as_py())
                if any(item.content for item in found):
                    for item in found:
                        for name, n in item.features():
                            if name[0] == "<" and name[1:-1] not in known:
                                name = "<>"
                            total[name, item.content] += n
        yield pa.RecordBatch.from_pylist(
            [{"feature": f, "inside": c, "n": n} for (f, c), n in total.items()],
            schema=pa.schema([("feature", pa.string()), ("inside", pa.bool_()), ("n", pa.int64())]))

    rows = (
        pages.select(F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"))
        .mapInArrow(counted, "feature string, inside boolean, n long")
        .groupBy("feature").pivot("inside", [True, False]).agg(F.sum("n")).collect()
    )
    counts = {r["feature"]: (r["true"] or 0, r["false"] or 0) for r in rows}
    if WORD not in counts:
        return dict(DEFAULT_WEIGHTS)
    inside, outside = (sum(c[i] for c in counts.values()) + 1 for i in (0, 1))
    weights = dict(DEFAULT_WEIGHTS)
    for name, (a, b) in counts.items():
        odds = math.log((a + 1) / inside) - math.log((b + 1) / outside)
        odds = max(-LIMIT, min(LIMIT, odds))
        weights[name] = max(odds, 0.1) if name == WORD else min(odds, -0.01)
    return weights


def extract(html: Column, weights: Mapping[str, float]) -> Column:
    """The main text; empty for a null or empty page and where nothing scores positive."""

    @F.pandas_udf("string")
    def extracted(pages: pd.Series) -> pd.Series:
        return pages.map(lambda page: main_text(page, weights))

    return extracted(F.coalesce(html.cast("string"), F.lit("")))
