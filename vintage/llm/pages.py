"""Main text of web pages by a tree-structured graphical model over DOM nodes."""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintage.llm.common import arrow_schema, batch_of, bounded_batches
from vintage.llm.layouts import labelled_pages

#: Pages of the table, by the hash of their text, that join the labelled ones if they name their article.
SAMPLE = 1000
OUT = "page_id long, url string, text string, n_chars long"

# Classes of elements in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noframes noembed xmp svg math object canvas".split())
SKIPPED = frozenset("head button select option optgroup datalist audio video map dialog".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark meter nobr output progress q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote center details div dl dir fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
CLOSED_BY = {
    "li": frozenset({"li"}),
    "dt": frozenset({"dt", "dd"}),
    "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr", "td", "th"}),
    "td": frozenset({"td", "th"}),
    "th": frozenset({"td", "th"}),
    "tbody": frozenset({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}),
    "thead": frozenset({"caption", "colgroup"}),
    "tfoot": frozenset({"thead", "tbody", "tr", "td", "th"}),
}
#: Names of elements that are no content even within an article.
BESIDE = frozenset("nav aside form footer header".split())
ASIDES = frozenset("ad ads advert advertisement banner comment comments cookie footer menu nav newsletter notice promo related replies share sidebar signup social sponsored widget".split())
SCOPES = {"li": frozenset({"ul", "ol", "menu"}), "dt": frozenset({"dl"}), "dd": frozenset({"dl"})}
SCOPES |= dict.fromkeys(("tr", "td", "th", "tbody", "thead", "tfoot"), frozenset({"table"}))

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"""|<([a-zA-Z][^\s/>]*)((?>(?:[^>"']|"[^"]*"|'[^']*'){0,20000}))>|<([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Page:
    """Elements in document order: the parent of each comes before it."""

    tag: list[str] = field(default_factory=lambda: ["#page"])
    parent: list[int] = field(default_factory=lambda: [-1])
    names: list[tuple[str, ...]] = field(default_factory=lambda: [()])
    marks: list[str] = field(default_factory=lambda: [""])
    #: Blocks of text: the element, and its text.
    blocks: list[tuple[int, str]] = field(default_factory=list)
    #: Characters of text below each element, and those within links.
    chars: list[int] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)


def parse(source: str | None) -> Page:
    """Elements and blocks of text of a page, unclosed and misplaced tags repaired as browsers mostly do."""
    page, stack, pending = Page(), [0], []
    own, own_linked, opened = Counter(), Counter(), Counter()  # opened: tags on the stack; "" stands for what is not shown
    source = source or ""

    def flush() -> None:
        text = " ".join("".join(pending).split())
        pending.clear()
        if text:
            page.blocks.append((block(), text))

    def block() -> int:
        return next(n for n in reversed(stack) if page.tag[n] not in INLINE)

    def add_text(raw: str) -> None:
        if raw.strip() and not opened["body"]:
            imply_body()
        if opened[""]:
            return
        text = html.unescape(raw) if "&" in raw else raw
        pending.append(text)
        size = len(text.strip())
        own[stack[-1]] += size
        if opened["a"]:
            own_linked[stack[-1]] += size

    def imply_body() -> None:
        """What stands outside head and body is in the body, as in browsers' trees."""
        for depth in range(len(stack) - 1, 0, -1):
            if page.tag[stack[depth]] == "head":
                close_to(depth)
                break
        open_element("body", "")

    def open_element(tag: str, attributes: str) -> None:
        found = {a[0].lower(): html.unescape(a[1].strip("\"'")) for a in _ATTRIBUTE.findall(attributes)} if attributes else {}
        page.tag.append(tag)
        page.parent.append(stack[-1])
        page.names.append(tuple(sorted({w.lower() for key in ("class", "id", "role") for w in _NAME.findall(found.get(key, ""))})))
        mark = "hidden" if "hidden" in found or re.search(r"display\s*:\s*none", found.get("style", "")) else ""
        page.marks.append(mark or next((k for k in ("data-main", "data-not") if k in found), ""))
        stack.append(len(page.tag) - 1)
        opened[tag] += 1
        opened[""] += unseen(stack[-1])

    def close_to(depth: int) -> None:
        if any(page.tag[n] not in INLINE for n in stack[depth:]):
            flush()
        for n in stack[depth:]:
            opened[page.tag[n]] -= 1
            opened[""] -= unseen(n)
        del stack[depth:]

    def unseen(n: int) -> bool:
        return page.tag[n] in SKIPPED or page.marks[n] == "hidden"

    def close_open(tags: frozenset[str], scope: frozenset[str]) -> None:
        if not any(opened[t] for t in tags):
            return
        for depth in range(len(stack) - 1, 0, -1):
            tag = page.tag[stack[depth]]
            if tag in tags:
                close_to(depth)
                return
            if tag in scope:
                return

    at = 0
    while at < len(source):
        m = _TOKEN.search(source, at)
        if m is None:
            add_text(source[at:])
            break
        if m.start() > at:
            add_text(source[at : m.start()])
        at = m.end()
        if m[1]:
            tag = m[1].lower()
            if tag == "br":
                pending.append(" ")
            elif not opened[tag] or tag in ("html", "body"):  # what follows those is still in the body
                if tag not in INLINE:
                    flush()
            else:
                depth = next((d for d in range(len(stack) - 1, 0, -1) if page.tag[stack[d]] == tag), 0)
                barrier = next((d for d in range(len(stack) - 1, 0, -1) if page.tag[stack[d]] in ("table", "article", "main", "body")), 0)
                if depth and (tag not in INLINE or depth > barrier):
                    close_to(depth)
            continue
        name = m[2] or m[4]
        if not name:
            continue
        tag, attributes = name.lower(), m[3] or m[5] or ""
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(source, at)
            if not attributes.rstrip().endswith("/") or tag not in ("svg", "math"):
                at = end.end() if end else len(source)
            continue
        if tag == "br":
            pending.append(" ")
            continue
        if tag in ("html", "body"):
            if opened[tag] or tag == "html" and opened["body"]:
                continue
            if tag == "body" and opened["head"]:
                close_open(frozenset({"head"}), frozenset())
        elif tag not in VOID and tag != "head" and not opened["body"]:
            imply_body()
        if tag not in INLINE:
            if tag in CLOSES_P:
                close_open(frozenset({"p"}), frozenset({"table", "td", "th", "button", "object"}))
            if tag in CLOSED_BY:
                close_open(CLOSED_BY[tag], SCOPES.get(tag, frozenset()))
            flush()
        if tag in VOID:
            continue
        open_element(tag, attributes)
    flush()
    page.chars = [own[n] for n in range(len(page.tag))]
    page.linked = [own_linked[n] for n in range(len(page.tag))]
    for n in range(len(page.tag) - 1, 0, -1):
        page.chars[page.parent[n]] += page.chars[n]
        page.linked[page.parent[n]] += page.linked[n]
    return page


def evidence(page: Page, n: int) -> Iterator[tuple[str, str]]:
    """What an element shows: its tag with how much text it has and how much of that is linked, and its names."""
    chars = page.chars[n]
    linked = min(2, 3 * page.linked[n] // chars) if chars else 0
    yield "shape", f"{page.tag[n]} {min(4, chars.bit_length() // 3)} {linked}"
    yield "tag", page.tag[n]
    for name in page.names[n]:
        yield "name", name


def labels(page: Page) -> list[bool]:
    """Content or not, from the marks of a labelled page."""
    out = [False] * len(page.tag)
    for n in range(1, len(page.tag)):
        out[n] = page.marks[n] == "data-main" or (out[page.parent[n]] and page.marks[n] != "data-not")
    return out


def own_labels(page: Page) -> list[bool] | None:
    """Labels of a page that names its article itself: one article element, without what is named otherwise in it."""
    if page.tag.count("article") != 1:
        return None
    out = [False] * len(page.tag)
    for n in range(1, len(page.tag)):
        aside = page.tag[n] in ("nav", "aside", "form", "footer") or not ASIDES.isdisjoint(page.names[n])
        out[n] = page.tag[n] == "article" or (out[page.parent[n]] and not aside)
    return out


PAIRS = ((True, True), (True, False), (False, True), (False, False))


@dataclass
class TreeModel:
    """Logarithms of potentials of a parent's and its child's states (PAIRS), given what the child shows."""

    base: tuple[float, ...]
    seen: dict[tuple[str, str], tuple[float, ...]]

    def potential(self, page: Page, n: int) -> list[float]:
        out = list(self.base)
        shape, *others = evidence(page, n)
        if shape in self.seen:
            others = others[1:]  # the tag speaks only for a shape that no labelled page showed
        for shown in (shape, *others):
            if (more := self.seen.get(shown)) is not None:  # what none showed says nothing
                for k in range(4):
                    out[k] += more[k]
        return out

    def marginals(self, page: Page) -> list[float]:
        """The probability that each element is content: messages go up to the page, then down."""
        size = len(page.tag)
        up0, up1, sent = [0.0] * size, [0.0] * size, [(0.0, 0.0)] * size
        up0[0] = -1e9  # the page itself is no content
        edges = [[0.0] * 4, *(self.potential(page, n) for n in range(1, size))]
        for n in range(size - 1, 0, -1):
            e = edges[n]
            sent[n] = to0, to1 = _add(e[0] + up0[n], e[1] + up1[n]), _add(e[2] + up0[n], e[3] + up1[n])
            up0[page.parent[n]] += to0
            up1[page.parent[n]] += to1
        all0, all1, out = up0[:], up1[:], [0.0] * size
        for n in range(1, size):
            p, e = page.parent[n], edges[n]
            rest0, rest1 = all0[p] - sent[n][0], all1[p] - sent[n][1]
            shift = max(rest0, rest1)
            all0[n] = up0[n] + _add(rest0 - shift + e[0], rest1 - shift + e[2])
            all1[n] = up1[n] + _add(rest0 - shift + e[1], rest1 - shift + e[3])
            out[n] = 1 / (1 + math.exp(max(-700.0, min(700.0, all1[n] - all0[n]))))
        return out


def _add(a: float, b: float) -> float:
    high, low = (a, b) if a > b else (b, a)
    return high + math.log1p(math.exp(low - high))


def train(pages: Iterable[tuple[Page, list[bool]]], smooth: float = 0.05) -> TreeModel:
    """Potentials from counts over labelled pages: a child's state by its parent's, and what it shows by both."""
    pairs, shown, totals = Counter(), Counter(), Counter()
    for page, label in pages:
        for n in range(1, len(page.tag)):
            pair = label[page.parent[n]], label[n]
            pairs[pair] += 1
            for kind, value in evidence(page, n):
                shown[kind, value, pair] += 1
                totals[kind, pair] += 1
    log = lambda n, of, ways: math.log((n + smooth) / (of + smooth * ways))
    base = tuple(log(pairs[p], pairs[p[0], True] + pairs[p[0], False], 2) for p in PAIRS)
    values = {(kind, value) for kind, value, _ in shown}
    ways = Counter(kind for kind, _ in values)
    seen = {(k, v): tuple(log(shown[k, v, p], totals[k, p], ways[k]) for p in PAIRS) for k, v in values}
    return TreeModel(base, seen)


def fit(pages: DataFrame, sample: int = SAMPLE, html_column: str = "html") -> TreeModel:
    """Train on the labelled layouts, and on pages of the table that name their article.

    sample bounds the pages taken from the table, the first by the hash of their source.
    """
    known = [(p, labels(p)) for p in map(parse, labelled_pages())]
    named = pages.select(F.col(html_column).alias("html")).where(F.col("html").contains("<article"))
    hashed = F.xxhash64("html")
    last = named.select(hashed.alias("h")).distinct().orderBy("h").limit(sample).agg(F.max("h")).first()[0] if sample else None
    taken = [] if last is None else named.where(hashed <= last).distinct().toArrow().column("html").to_pylist()
    for page in map(parse, sorted(taken)):
        if (own := own_labels(page)) is not None:
            known.append((page, own))
    return train(known)


def main_text(page: Page, model: TreeModel, least: float = 0.5) -> str:
    """The blocks whose element is content by ``least``.

    Where none is, the blocks below the parent of the likeliest one, other than those in what
    is beside an article by its tag or name: a page of a single paragraph is its own article.
    """
    content = model.marginals(page)
    found = [text for n, text in page.blocks if content[n] >= least]
    if not found and page.blocks:
        beside = [False] * len(page.tag)
        for n in range(1, len(page.tag)):
            beside[n] = beside[page.parent[n]] or page.tag[n] in BESIDE or not ASIDES.isdisjoint(page.names[n])
        left = [(n, text) for n, text in page.blocks if not beside[n]]
        if left:
            best = max((n for n, _ in left), key=lambda n: (content[n], -n))
            top = best if page.tag[best] == "body" else page.parent[best]
            below = [n == top for n in range(len(page.tag))]
            for n in range(1, len(page.tag)):
                below[n] |= below[page.parent[n]]
            found = [text for n, text in left if below[n]]
    return "\n".join(found)


def extract(pages: DataFrame, model: TreeModel) -> DataFrame:
    """The main text of every page.

    pages: page_id, url, html, any others. The whole html is read; a NULL one counts as
    empty and gives an empty text, as does a page of nothing but menus, notices and the like.
    Text and elements outside a body are in an implied one; see main_text where no element
    is content. Character references are decoded, white space in a block becomes one
    space, blocks are joined by line feeds in page order. Repeated rows stay, a NULL
    page_id or url stays NULL; an empty table gives none.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, own = arrow_schema(OUT), shared.value
        for b in batches:
            texts = [main_text(parse(h), own) for h in b.column(2).to_pylist()]
            yield batch_of(schema, {"page_id": b.column(0), "url": b.column(1), "text": texts, "n_chars": [len(t) for t in texts]})

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(run, OUT)
