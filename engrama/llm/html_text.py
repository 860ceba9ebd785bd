"""Main text of web pages by the maximum-scoring subsequence of their words and tags.

A page is a run of tokens: words score above zero where they stand in containers that
hold articles, below zero in others; tags cost.  One linear scan finds the contiguous
region with the largest sum, which is the article.

The weights are learned from labelled pages: pages that mark their article with an
``article`` or ``main`` element label each of their tokens as inside or outside.  A
container (element name and classes) gives the words directly in it the log odds of
being inside, and a tag costs the log odds of being outside, plus a constant.  What no
labelled page shows has a prior from the names below.  At most ``SAMPLE`` pages, the
first by a hash of their id, are learned from; counts are made on the cluster.

Within the region, and only there, elements that are no running text are left out:
menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and
comments by readers.  An element is known as such by its name, or by a whole class
name or id such as ``site-footer``; ``has-sidebar`` isn't one, and html, body, main and
article stay whatever their classes say.  Tags are read leniently, as browsers do: an unclosed paragraph
ends at the next block, a closing tag that was never opened is ignored, and so is the
tag of a graphic, frame or the like that is never closed.

Results for odd input: null or empty html, or a page without words, gives an empty
text; text outside any tag is content; rows with null ids are kept, repeated rows
each; a page cut off anywhere is read as far as it goes.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engrama.llm.common import map_arrow

SAMPLE = 5_000
TAG_COST = 0.5        # of a tag, besides what was learned
TEXT_TAG_COST = 0.1   # of a tag within running text, so that short paragraphs still count
LIMIT = 4.0           # of a learned weight, either way
LEFT_OUT_COST = -0.2  # of a word in an element that is left out
OUTSIDE = -1.0        # at most, of a word outside the element that marks the article
MOST = 0.8            # of the words: a container with these isn't left out for its class
LEAST_PAGES = 3       # labelled pages a container must be on

# fixed values: element names of HTML
_RAW = "script style noscript template iframe textarea svg math object canvas".split()
_FOREIGN = {"svg", "math"}  # "/>" closes them
_LEFT_OUT = {*_RAW, *"head title nav header footer aside form button select option label input dialog menu".split()}
_CONTAINERS = {*_LEFT_OUT, *"html body article main section div ul ol dl table tr td th blockquote figure details".split()}
_BLOCKS = {*_CONTAINERS, *"p h1 h2 h3 h4 h5 h6 li dt dd pre br hr address figcaption caption summary thead tbody tfoot center fieldset".split()}
_VOID = set("br hr img input meta link area base col embed source track wbr".split())
_CLOSED_BY_BLOCK = {"p", "li", "dt", "dd", "td", "th", "tr", "option"}
_TEXT_TAGS = set("p br b i em strong u sub sup code h1 h2 h3 h4 h5 h6 blockquote pre".split())
_ARTICLE = {"article", "main"}
_PAGE = {"html", "body", *_ARTICLE}  # never left out by class or id
# fixed values: class names and ids of what isn't running text, whole names only
_UNWANTED_WORD = (
    r"(?:ad|ads|advert[a-z0-9]*|banner|promo[a-z0-9]*|sponsor[a-z0-9]*|nav|navs|navbar|navigation|navmenu|navlinks|menu|menus|menubar|menuitems?|breadcrumb[a-z0-9]*|sidebar|side|footer|foot|header|masthead|topbar|toolbar|"
    r"comments?|commentlist|commentform|commentbox|commenter|respond|responses?|disqus|reply|replies|cookie[a-z0-9]*|consent|notice[a-z0-9]*|notification[a-z0-9]*|alert|popup|modal|overlay|subscribe[a-z0-9]*|"
    r"newsletter|signup|login|share|sharing|social[a-z0-9]*|related|recommend[a-z0-9]*|pagination|pager|search|searchbox|searchform|searchbar|form|widget[a-z0-9]*|tags?|hidden|copyright|legal|disclaimer)"
)
_BEFORE = r"(?:site|main|top|bottom|left|right|primary|secondary|global|post|article|entry)"  # which of them
_AFTER = (  # what sort of box
    r"(?:bar|box|block|list|links?|area|wrap|wrapper|container|inner|outer|section|panel|buttons?|icons?|items?|slot|unit|message|posts|articles|"
    r"top|bottom|left|right|primary|secondary|mobile|desktop|toggle|\d+(?:x\d+)?)"
)
_UNWANTED = re.compile(rf"(?<!\S)(?:{_BEFORE}[-_]+)*{_UNWANTED_WORD}(?:[-_]+(?:{_UNWANTED_WORD}|{_AFTER}))*(?!\S)")
_WANTED = re.compile(r"(?:^|[-_ ])(?:article\w*|content|post|entry\w*|story\w*|main|body|text)(?:$|[-_ ])")

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"  # quotes that don't match
    r"|<[!?][^>]*(?:>|\Z)"
    r"|</[^>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_NAMES = re.compile(r"\b(?P<key>class|id|role|hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_RAW_ENDS = {name: re.compile(rf"</{name}\s*>", re.I) for name in _RAW}
_SPACE = re.compile(r"\s+")


def container_name(name: str, attrs: str) -> str:
    """Element name and its class and id, as the key of a learned weight."""
    marks = []
    for m in _NAMES.finditer(attrs):
        value = m[2] or m[3] or m[4] or ""
        marks.append("hidden" if m["key"].lower() == "hidden" else value.lower().strip())
    return f"{name} {' '.join(sorted(x for x in marks if x))}".strip()


def unwanted(key: str) -> bool:
    name, _, marks = key.partition(" ")
    return name in _LEFT_OUT or (name not in _PAGE and bool(marks and _UNWANTED.search(marks)))


def prior(key: str) -> float:
    """The weight of a word in a container that no labelled page showed."""
    if unwanted(key):
        return -2.0
    name, _, marks = key.partition(" ")
    return 1.5 if name in _ARTICLE or (marks and _WANTED.search(marks)) else 1.0


def _tokens(page: str) -> Iterator[re.Match]:
    """Texts and tags in page order, without raw elements.

    Of a raw element that is never closed only the tag goes, except that a script runs to the end.
    """
    at, unclosed = 0, set()
    while at < len(page):
        for m in _TOKEN.finditer(page, at):
            at = m.end()
            name = (m["name"] or m["name2"] or "").lower()
            if name not in _RAW_ENDS or m["end"] or m["end2"]:
                yield m
                continue
            if name in unclosed or (name in _FOREIGN and page.endswith("/>", m.start(), at)):
                continue
            close = _RAW_ENDS[name].search(page, at)
            if close:
                at = close.end()
                break
            if name == "script":
                return
            unclosed.add(name)  # looked for once: there is none further on either


class Piece:
    """A run of text, or a tag, with where it stands."""

    __slots__ = ("text", "tag", "key", "dropped", "inside")

    def __init__(self, text: str | None, tag: str | None, key: str, dropped: bool, inside: bool):
        self.text, self.tag, self.key, self.dropped, self.inside = text, tag, key, dropped, inside


class _Open:
    """A container while it is open, and what is known of it at the end of the page."""

    __slots__ = ("name", "key", "parent", "hard", "soft", "in_article", "articles", "words", "dropped")

    def __init__(self, name: str, key: str, parent: _Open | None):
        self.name, self.key, self.parent = name, key, parent
        self.hard = name in _LEFT_OUT and name != "form"       # the element says so
        self.soft = not self.hard and unwanted(key)            # its class or id does, or it is a form
        self.in_article = name in _ARTICLE or bool(parent and parent.in_article)
        self.articles, self.words, self.dropped = 0, 0, False


def pieces(page: str) -> list[Piece]:
    """Texts and tags in page order.

    A container whose class, id or being a form speaks against it is left out, but not
    if it holds an article, nor ``MOST`` of the words of its article or, where none is
    marked, of the page: then its words count as those of a plain container.
    """
    top = _Open("body", "body", None)
    opened, stack, found = [top], [top], []
    for m in _tokens(page):
        here = stack[-1]
        if m["text"] is not None:
            found.append((m["text"], None, here))
            here.words += len(m["text"].split())
            continue
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue  # comments and declarations
        closing = bool(m["end"] or m["end2"])
        if name in _CONTAINERS and not closing and name not in _VOID:
            if name in _CLOSED_BY_BLOCK and here.name == name and len(stack) > 1:
                stack.pop()
            stack.append(_Open(name, container_name(name, m["attrs"] or ""), stack[-1]))
            opened.append(stack[-1])
            stack[-1].articles = int(name in _ARTICLE)
        elif name in _CONTAINERS and closing and any(o.name == name for o in stack[1:]):
            while stack.pop().name != name:
                pass
        found.append((None, name, stack[-1]))
    for o in reversed(opened[1:]):  # children come after their parents
        if not o.hard:
            o.parent.words += o.words
            o.parent.articles += o.articles
    marked = sum(o.words for o in opened if o.name in _ARTICLE and not (o.parent and o.parent.in_article))
    for o in opened:
        of = marked if o.in_article else 0 if marked else top.words
        most = o.articles > 0 or (of > 0 and o.words >= MOST * of)
        o.dropped = o.hard or (o.soft and not most) or bool(o.parent and o.parent.dropped)
        if o.soft and most:
            o.key = "div"
    return [Piece(text, tag, o.key, o.dropped, o.in_article) for text, tag, o in found]


class Weights:
    """What words in a container and what tags are worth."""

    def __init__(self, words: dict[str, float] | None = None, tags: dict[str, float] | None = None):
        self.words, self.tags = words or {}, tags or {}

    def word(self, key: str) -> float:
        if key not in self.words:
            self.words[key] = prior(key)
        return self.words[key]

    def tag(self, name: str) -> float:
        return self.tags.get(name, 0.0) - (TEXT_TAG_COST if name in _TEXT_TAGS else TAG_COST)


def best_region(scores: list[float]) -> tuple[int, int]:
    """Bounds of the contiguous run with the largest sum; the first of equals, empty if none is above zero."""
    best, low, high = 0.0, 0, 0
    total, start = 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, low, high = total, start, i + 1
    return low, high


def main_text(page: str | None, weights: Weights) -> str:
    """The article's blocks, one per line."""
    if not page:
        return ""
    found = pieces(page)
    marked = any(p.inside for p in found)
    scores = []
    for p in found:
        if p.tag is not None:
            scores.append(LEFT_OUT_COST * TAG_COST if p.dropped else weights.tag(p.tag))
            continue
        weight = weights.word(p.key)
        if p.dropped:  # an advert amid the article isn't printed anyway and shouldn't end it
            weight = LEFT_OUT_COST
        elif marked and not p.inside:
            weight = min(weight, OUTSIDE)
        scores.append(weight * len(p.text.split()))
    low, high = best_region(scores)
    blocks, parts = [], []

    def end_block() -> None:
        text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
        if text:
            blocks.append(text)
        parts.clear()

    for p in found[low:high]:
        if p.tag is not None:
            if p.tag in _BLOCKS:
                end_block()
        elif not p.dropped:
            parts.append(p.text)
    end_block()
    return "\n".join(blocks)


def _count(batch: pa.RecordBatch) -> pa.RecordBatch:
    """For pages that mark an article: words and tags by container or name, inside and outside."""
    rows: list[tuple[str, str, int, int, int]] = []
    for page in batch.column(0).to_pylist():
        if not page:
            continue
        sums: dict[tuple[str, str], list[int]] = {}
        marked = False
        for p in pieces(page):
            marked |= p.inside
            kind, key, n = ("tag", p.tag, 1) if p.tag is not None else ("word", p.key, len(p.text.split()))
            if n:
                sums.setdefault((kind, key), [0, 0])[p.inside and not p.dropped] += n
        if marked:
            rows.extend((kind, key, inside, outside, 1) for (kind, key), (outside, inside) in sums.items())
    columns = list(zip(*rows)) or [[]] * 5
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()))],
        ["kind", "key", "inside", "outside", "pages"],
    )


def learn(pages: DataFrame) -> Weights:
    """Weights from a bounded sample of pages that mark their article."""
    ids = pages.where("page_id is not null").select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(SAMPLE)
    sample = pages.select("page_id", F.col("html").cast("string").alias("html")).join(F.broadcast(ids), "page_id", "left_semi")
    counts = map_arrow(sample.select("html"), _count, "kind string, key string, inside bigint, outside bigint, pages bigint")
    table = counts.groupBy("kind", "key").agg(
        F.sum("inside").alias("inside"), F.sum("outside").alias("outside"), F.sum("pages").alias("pages")
    ).where(F.col("pages") >= LEAST_PAGES).collect()  # bounded by the sample
    words, tags = {}, {}
    for r in table:
        odds = max(-LIMIT, min(LIMIT, math.log((r.inside + 1) / (r.outside + 1))))
        if r.kind == "word":
            words[r.key] = odds
        else:
            tags[r.key] = min(0.0, odds / LIMIT)
    return Weights(words, tags)


def extract(pages: DataFrame, weights: Weights | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    sent = pages.sparkSession.sparkContext.broadcast(weights or learn(pages))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(page, sent.value) for page in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )

    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return map_arrow(rows, work, "page_id bigint, url string, text string, n_chars bigint")
