"""Main text of web pages by tag-path ratios.

Text nodes are grouped by the path of tags from the root. Each path has a ratio of text and of punctuation per node;
ratios are smoothed over neighbouring nodes in page order, fused, and compared with the page's own mean. The element
whose nodes exceed that threshold by most text is the article, with the articles beside it. Parts that their tag or
name calls boilerplate are left out beforehand; where a name only hints at it, the score of the path decides.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from martloom.llm.common import chunks, whole_text

TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*?)(?:>|(?P<cut>$))",
    re.S,
)
MARK = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg object canvas annotation".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr math mrow mi mo mn mtext msup msub mfrac msqrt semantics".split()
)
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"},
}
SCOPES = frozenset("ul ol dl table select article section main div nav aside header footer form body html".split())
#: Parts of a page that are never its article.
BOILERPLATE_TAGS = frozenset("head nav footer aside menu button select dialog".split())
COMMENT_WORDS = frozenset("comment comments discussion disqus replies reply respond review reviews".split())
BOILERPLATE_WORDS = COMMENT_WORDS | frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs consent cookie cookies footer gdpr header menu "
    "modal nav navbar navigation newsletter notice outbrain pagination popup promo promoted recommended related share "
    "sharing sidebar signup skip social sponsor sponsored subscribe taboola tags teaser toolbar widget complementary "
    "contentinfo search".split()
)
#: Words at the end of a name that do not say what the element is.
NEUTRAL_WORDS = frozenset(
    "area bar block body bottom box col column container content group holder inner item items left list main outer "
    "panel primary right row secondary section slot thread top unit wrap wrapper zone".split()
)
#: What follows these words in a name is not what the element is.
MODIFIERS = frozenset("has with without no".split())
ARTICLES = frozenset(("article", "main"))
PUNCTUATION = re.compile(r"[.,;:!?\"'()…、。，！？¿¡«»-]")
SPACE = re.compile(r"\s+")


class Node:
    """An element: its place in the tree, its path by number, and what its tag and names say of it.

    ``named``: 3 boilerplate by name, 2 by a compound name or a form, which does not count around most of the page,
    1 a name that hints at boilerplate, which only lowers the score.
    """

    __slots__ = ("parent", "tag", "path", "depth", "dropped", "named", "article", "link", "hint", "inside", "value", "size")

    def __init__(self, parent: Node | None, tag: str, marks: list[str], paths: dict[tuple, int]):
        self.parent, self.tag, self.value, self.size = parent, tag, 0.0, 0
        self.path = paths.setdefault((parent.path if parent else -1, tag, *marks), len(paths))
        self.depth = parent.depth + 1 if parent else 0
        self.link = tag == "a" or bool(parent and parent.link)
        within = bool(parent and parent.article)
        self.article = tag in ARTICLES or within
        self.dropped = tag in BOILERPLATE_TAGS or tag == "header" and not within or bool(parent and parent.dropped)
        self.named = 0 if tag in ("html", "body", *ARTICLES) else max((boilerplate_name(m, within) for m in marks), default=0)
        if tag == "form":
            self.named = max(self.named, 2)
        self.hint = self.named == 1 or bool(parent and parent.hint)
        self.inside = False


def boilerplate_name(name: str, within: bool = False) -> int:
    """What a class or id says, 0 to 3 as in ``Node.named``. A compound is what its last word says, neutral words
    aside: ``user-reviews`` are reviews, ``related-work`` only hints, ``has-sidebar`` tells of a sidebar elsewhere. A
    header ``within`` an article is its own.
    """
    words = [w for w in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", name).lower()) if w]
    if not words or within and "header" in words:
        return 0
    if len(words) == 1:
        return 3 * (words[0] in BOILERPLATE_WORDS)
    about = next((i for i, w in enumerate(words) if w in MODIFIERS), len(words))
    words = words[:about]
    if BOILERPLATE_WORDS.isdisjoint(words):
        return 0
    while words[-1] in NEUTRAL_WORDS or len(words[-1]) == 1:
        words.pop()
    if words[-1] in COMMENT_WORDS:
        return 3
    return 2 if words[-1] in BOILERPLATE_WORDS else 1


def text_nodes(page: str) -> tuple[list[tuple[Node, int, str]], list[Node]]:
    """(element, block, decoded text) in page order, where texts of one block belong to one line, and all elements,
    each after its parent."""
    paths: dict[tuple, int] = {}
    root = Node(None, "", [], paths)
    top, block, at, found, tree = root, 0, 0, [], [root]

    def text(raw: str) -> None:
        if raw.strip():
            found.append((top, block, html.unescape(raw)))
        elif raw and found and found[-1][1] == block:
            found.append((top, block, " "))

    size = len(page)
    while at < size:
        m = TOKEN.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag or m["cut"] is not None:
            continue
        if tag not in INLINE:
            block += 1
        if m["close"]:
            node = top
            while node.parent and node.tag != tag and not (node.tag in SCOPES and tag in INLINE | {"p", "li"}):
                node = node.parent
            if node.parent and node.tag == tag:
                top = node.parent
            continue
        if tag == "br":
            text(" ")
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(f"</{tag}\\s*>", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if tag not in INLINE:  # an open paragraph, with its inline marks, ends where a block begins
            node = top
            while node.parent and (node.tag in INLINE or node.tag == "p"):
                if node.tag == "p":
                    top = node.parent
                    break
                node = node.parent
        if tag in CLOSED_BY:
            node = top
            while node.parent and node.tag not in SCOPES:
                if node.tag in CLOSED_BY[tag]:
                    top = node.parent
                node = node.parent
        marks = [x for g in MARK.findall(m["attrs"]) for x in " ".join(g).split()] if m["attrs"] else []
        top = Node(top, tag, marks, paths)
        tree.append(top)
    return found, tree


def path_scores(nodes: list[tuple[Node, int, str]], radius: int = 2) -> tuple[np.ndarray, float]:
    """Fused, smoothed ratio of each node's path, and the page's threshold."""
    paths: dict[str, int] = {}
    of = np.array([paths.setdefault(n.path, len(paths)) for n, _, _ in nodes])
    size = np.array([len(t.strip()) for _, _, t in nodes], float)
    points = np.array([len(PUNCTUATION.findall(t)) for _, _, t in nodes], float)
    doubt = np.array([(0.3 if n.link else 1.0) * (0.6 if n.hint else 1.0) for n, _, _ in nodes])
    count = np.bincount(of)
    text_ratio, point_ratio = np.bincount(of, size) / count, np.bincount(of, points) / count
    fused = text_ratio / (text_ratio + 40) * (1 + np.log1p(point_ratio))
    per_node = fused[of] * doubt
    kernel = np.exp(-0.5 * np.arange(-radius, radius + 1) ** 2)
    padded = np.pad(per_node, radius, mode="edge")
    smooth = np.convolve(padded, kernel / kernel.sum(), mode="valid")
    by_path = np.bincount(of, smooth) / count
    score = np.sqrt(by_path[of] * per_node)
    return score, 0.5 * float((score * size).sum() / max(size.sum(), 1))


def outside_boilerplate(nodes: list[tuple[Node, int, str]], tree: list[Node]) -> list[tuple[Node, int, str]]:
    """The nodes in no element that is boilerplate by tag or name.

    A compound name or a form does not count around most of the page's text, nor a plain name where nothing else would
    be left.
    """
    nodes = [x for x in nodes if not x[0].dropped]
    for node, _, t in nodes:
        node.size += len(t.strip())
    for node in reversed(tree):
        if node.parent:
            node.parent.size += node.size
    total = tree[0].size
    for wrappers in (False, True):
        out: set[int] = set()
        for node in tree:
            most = 2 * node.size > total and (wrappers or node.named == 2)
            if id(node.parent) in out or node.named > 1 and not most:
                out.add(id(node))
        found = [x for x in nodes if id(x[0]) not in out]
        if any(t.strip() for _, _, t in found):
            break
    return found


def main_text(page: str) -> str:
    """The article's text, one block to a line; empty if there is none."""
    nodes, tree = text_nodes(page)
    nodes = outside_boilerplate(nodes, tree)
    if not any(t.strip() for _, _, t in nodes):
        return ""
    score, threshold = path_scores(nodes)
    around: set[int] = set()
    for (node, _, t), s in zip(nodes, score, strict=True):
        node.value += len(t.strip()) * (s - threshold)
        around.add(id(node))
    for node in reversed(tree):
        if node.parent and id(node) in around:
            node.parent.value += node.value
            around.add(id(node.parent))
    held = [n for n in tree if id(n) in around]
    options = [n for n in held if n.tag in ARTICLES and n.value > 0] or held
    best = max(options, key=lambda n: (n.value, n.depth))
    for node in tree:
        beside = best.tag == "article" == node.tag and node.parent is best.parent and node.value > 0
        node.inside = node is best or beside or bool(node.parent and node.parent.inside)
    prose = {block for node, block, t in nodes if not node.link and any(map(str.isalnum, t))}  # blocks with text outside links
    lines: dict[int, list[str]] = {}
    for (node, block, t), s in zip(nodes, score, strict=True):
        above = s >= threshold if node.hint else block in prose or not (s < 0.25 * threshold and node.link)
        if node.inside and above:
            lines.setdefault(block, []).append(t)
    cleaned = (SPACE.sub(" ", "".join(parts)).strip() for parts in lines.values())
    return "\n".join(x for x in cleaned if x)


def extract_pages(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    A null html is empty and gives an empty text, as does a page without article text. A page of plain text is its
    own article. Broken markup is read as far as it goes: open elements end with the page, a cut tag at the end is
    left out. Repeated rows and null ids or urls are kept as they are, very long or deep pages are read whole, other
    columns, of whatever names, are not read, and an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            texts = [main_text(p) for p in batch.column(2).to_pylist()]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    ids = pages.schema["page_id"].dataType.simpleString()
    asked = pages.select("page_id", "url", whole_text("html").alias("html"))
    return asked.mapInArrow(run, f"page_id {ids}, url string, text string, n_chars long")
