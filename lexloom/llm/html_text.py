"""Main text of web pages by tag-path ratios.

A page becomes a sequence of text blocks, each in an element that has a
root-to-leaf tag path.  Text length and punctuation are summed for each path
and divided by the number of its blocks; both ratios are smoothed over the
neighbouring blocks and fused, links and boilerplate labels weigh them down, and
the paths whose mean score reaches a share of the page's are the content.
Short blocks (headings, list items) come along if the element around them is
mostly content.  Every step is linear in the page, however deep its markup.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import release

#: A comment, a declaration, or a tag with its attributes; an unended one reaches the end.
_MARK = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))|[^>])*+)(>|\Z)", re.S)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？、]")
_SPLIT = re.compile(r"[^a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template iframe textarea title xmp noembed noframes".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
#: A start tag ends open elements of these kinds.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Elements that hold no text of a page, whatever it is about.
_CUT = frozenset("head select button datalist svg object audio video canvas".split())
#: Labels of boilerplate: by element, role, and words of class and id names.
_OUTSIDE = frozenset("nav footer aside form dialog menu search fieldset".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
_NAMES = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist cookie cookies consent disclaimer disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification outbrain overlay pager pagination popup promo promotion recommended register related replies respond share sharing sidebar signup skip social sponsor sponsored subscribe subscription taboola toolbar topbar widget".split()
)
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: Share of the page's mean score that a path's score must reach; weight of
#: what a label marks; share of an element's text that is content if its short
#: blocks come along; share of all text in an element whose label says nothing.
THRESHOLD, LABELLED, MOSTLY, WRAPPER = 0.7, 0.02, 0.5, 0.9
#: Share of a block's text in links, two or more, from which it is a link list.
LINKED = 0.75


@dataclass
class Blocks:
    """Text blocks in page order, and the tree of elements that they lie in."""

    text: list[str] = field(default_factory=list)
    node: list[int] = field(default_factory=list)  # element of each block
    linked: list[int] = field(default_factory=list)  # its characters inside links
    links: list[int] = field(default_factory=list)  # its links
    parent: list[int] = field(default_factory=lambda: [-1])  # of each element; 0 is the page
    tag: list[str] = field(default_factory=lambda: [""])
    path: list[int] = field(default_factory=lambda: [0])  # number of its tag path
    marked: list[bool] = field(default_factory=lambda: [False])  # carries a label


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(raw)}


def _hidden(attrs: dict[str, str]) -> bool:
    return "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", "").lower()


def _labelled(tag: str, attrs: dict[str, str]) -> bool:
    """Whether an element is boilerplate by its kind, role or names."""
    if tag in _OUTSIDE:
        return True
    if not attrs or tag in ("html", "body", "main"):
        return False
    if attrs.get("role", "").lower() in _ROLES:
        return True
    named = _CAMEL.sub(" ", f"{attrs.get('class', '')} {attrs.get('id', '')}").lower()
    return not _NAMES.isdisjoint(_SPLIT.split(named))


def blocks(page: str) -> Blocks:
    """The page's blocks: text between block elements, entities decoded, white
    space turned into single spaces; hidden and scripted text left out."""
    out = Blocks()
    paths: dict[tuple[int, str], int] = {}
    stack: list[tuple[str, int, bool, bool]] = []  # tag, element or -1, cut out, block
    open_at: dict[str, list[int]] = {}
    block_at: list[int] = []
    chain = [0]  # elements that are open
    articles: list[int] = []  # blocks before each open article
    cut = links = inside = linked = 0
    text: list[str] = []

    def flush() -> None:
        nonlocal links, linked
        if text:
            body = "".join(text)
            body = " ".join((html.unescape(body) if "&" in body else body).split())
            if body:
                out.text.append(body)
                out.node.append(chain[-1])
                out.linked.append(min(linked, len(body)))
                out.links.append(links)
            text.clear()
        links = 1 if inside else 0
        linked = 0

    def close(depth: int) -> None:
        nonlocal cut, inside
        while len(stack) > depth:
            tag, element, gone, block = stack.pop()
            open_at[tag].pop()
            cut -= gone
            if block:
                block_at.pop()
            if element >= 0:
                flush()
                chain.pop()
            if tag == "a":
                inside -= 1
            elif tag == "article":
                articles.pop()

    pos, size = 0, len(page)
    while pos < size:
        m = _MARK.search(page, pos)
        if not cut and (end := m.start() if m else size) > pos:
            text.append(page[pos:end])
            if inside:
                linked += end - pos
        if not m:
            break
        pos = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        block = tag in _BLOCK
        if m[1]:
            if block:
                flush()
            at = open_at.get(tag)
            if at and (block or not block_at or at[-1] > block_at[-1]):
                close(at[-1])
            continue
        if tag in _RAW:
            at = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(page, pos)
            pos = at.start() if at else size
            end = page.find(">", pos)
            pos = end + 1 if end >= 0 else size
            continue
        if tag in _VOID:
            if tag == "hr":
                flush()
            elif not cut:
                text.append(" ")
            continue
        if block:
            flush()
            kinds = _ENDS.get(tag, ())
            while block_at and ((top := stack[block_at[-1]][0]) == "p" or top in kinds):
                close(block_at[-1])
        elif tag == "a":
            links += 1
        attrs = _attributes(m[3]) if m[3].strip() else {}
        mark = _labelled(tag, attrs) or tag == "header" and not articles and not open_at.get("main")
        if tag == "article":
            # one inside another, below its text, is a reader's comment
            mark = mark or bool(articles) and len(out.text) > articles[-1]
            articles.append(len(out.text))
        gone = tag in _CUT or bool(attrs) and _hidden(attrs) and tag not in ("html", "body")
        if gone or mark:
            flush()
        element = -1
        if block or mark:
            first = attrs.get("class", "").split() if attrs else ()
            name = f"{tag}.{first[0]}" if first else f"{tag}#{attrs['id']}" if attrs.get("id") and tag in ("div", "section", "table", "td") else tag
            element = len(out.parent)
            above = chain[-1]
            out.parent.append(above)
            out.tag.append(tag)
            out.path.append(paths.setdefault((out.path[above], name), len(paths) + 1))
            out.marked.append(mark)
            chain.append(element)
        open_at.setdefault(tag, []).append(len(stack))
        if block:
            block_at.append(len(stack))
        stack.append((tag, element, gone, block))
        cut += gone
        if tag == "a":
            inside += 1
    flush()
    return out


def _smooth(values: np.ndarray) -> np.ndarray:
    """Each value with its neighbours, weighted 1, 2, 1."""
    padded = np.pad(values, 1, mode="edge")
    return (padded[:-2] + 2 * padded[1:-1] + padded[2:]) / 4


def ratios(path: np.ndarray, length: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text length and punctuation for each block of a block's tag path."""
    _, at = np.unique(path, return_inverse=True)
    n = np.bincount(at)
    return (np.bincount(at, length) / n)[at], (np.bincount(at, points) / n)[at]


def fused(by_text: np.ndarray, by_point: np.ndarray) -> np.ndarray:
    """One score of both ratios, each smoothed over the neighbouring blocks as a
    logarithm, so that a short block beside a long one stays short."""
    return np.exp((_smooth(np.log1p(by_text)) + _smooth(np.log1p(by_point))) / 2)


def _mean_by(path: np.ndarray, values: np.ndarray) -> np.ndarray:
    _, at = np.unique(path, return_inverse=True)
    return (np.bincount(at, values) / np.bincount(at))[at]


def _labels(b: Blocks, length: np.ndarray) -> np.ndarray:
    """Whether each element is marked as boilerplate, itself or from above.

    A form or plain element around nearly all of the page's text is a wrapper,
    whatever its names.
    """
    total = np.zeros(len(b.parent))
    np.add.at(total, np.array(b.node), length)
    for k in range(len(total) - 1, 0, -1):
        total[b.parent[k]] += total[k]
    under = [False] * len(total)
    for k in range(1, len(total)):
        wraps = b.tag[k] in ("div", "section", "form", "table", "tr", "td", "tbody", "center") and total[k] >= WRAPPER * total[0]
        under[k] = under[b.parent[k]] or b.marked[k] and not wraps
    return np.array(under)


def picked(b: Blocks) -> np.ndarray:
    """Which blocks are the main text."""
    node = np.array(b.node)
    path = np.array(b.path)[node]
    length = np.array([len(t) for t in b.text], float)
    points = np.array([len(_PUNCTUATION.findall(t)) for t in b.text], float)
    link = np.array(b.linked) / length
    labelled = _labels(b, length)[node]
    if labelled.all():
        return np.zeros(len(node), bool)
    score = fused(*ratios(path, length, points)) * np.where(labelled, LABELLED, 1.0) * (1 - 0.9 * link)
    score = _mean_by(path * 2 + labelled, score)
    free = ~labelled
    content = score >= THRESHOLD * np.average(score[free], weights=length[free])
    listed = (link >= LINKED) & (np.array(b.links) >= 2)
    content &= ~listed
    # what an element mostly made of content holds beside it
    own, every = np.zeros(len(b.parent)), np.zeros(len(b.parent))
    np.add.at(own, node[content], length[content])
    np.add.at(every, node[free], length[free])
    for k in range(len(own) - 1, 0, -1):
        own[b.parent[k]] += own[k]
        every[b.parent[k]] += every[k]
    home = list(range(len(own)))  # the nearest element with content, itself included
    for k in range(1, len(own)):
        if not own[k]:
            home[k] = home[b.parent[k]]
    home = np.array(home)[node]
    inner = np.array([t not in ("", "html", "body") for t in b.tag])[home]
    along = free & ~content & ~listed & (link < MOSTLY) & inner & (own[home] >= MOSTLY * every[home])
    heads = np.array([t in _HEADINGS for t in b.tag])[node] & free & ~content & (link < MOSTLY)
    before = np.append(content[1:], False)
    return content | along | heads & before


def main_text(page: str) -> str:
    """The article of a page: its blocks in page order, one a line."""
    found = blocks(page)
    if not found.text:
        return ""
    return "\n".join(t for t, k in zip(found.text, picked(found).tolist(), strict=True) if k)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """Main text of every page, and its length in code points.

    A null or empty page, or one whose text is all labelled boilerplate, gives
    an empty text; repeated rows give repeated rows; unended markup reaches to
    the end of the page; other columns are ignored.  One narrow pass.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [key, url, "text", "n_chars"])
            release()

    plain = pages.select(F.col(key).cast("long").alias(key), F.col(url).cast("string").alias(url), F.coalesce(F.col(page).cast("string"), F.lit("")).alias(page))
    return plain.mapInArrow(run, f"`{key}` long, `{url}` string, text string, n_chars long")
