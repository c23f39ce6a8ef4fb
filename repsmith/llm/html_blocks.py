"""Main text from HTML: flat text blocks classified by a decision tree.

A page becomes a flat list of text blocks, cut at block-level tags. Each block is described by
its word count and link density, those of the blocks before and after it, and three facts of
its place: inside an element marked as page furniture, inside the article, a heading. A
decision tree, trained here on the small labelled table below, decides which blocks are main
text. Pages are independent, so the job is one narrow pass.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: HTML's elements by their meaning for text blocks.
RAW = ("script", "style", "textarea", "title")
HOLDERS = ("noscript", "template", "svg", "math", "object", "iframe", "select")
HEAD = frozenset("html head base basefont bgsound link meta title script style noscript template".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FURNITURE = frozenset("nav footer aside form button menu dialog fieldset".split())
ARTICLE = frozenset(("article", "main"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: Words of class, id and role that mark page furniture.
MARKS = frozenset("""ad ads advert advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar navigation menu sidebar aside
footer masthead breadcrumb breadcrumbs cookie cookies consent gdpr notice notification newsletter subscribe signup login popup modal overlay share sharing
social related recommended widget comment comments commentlist reply replies disqus respond copyright toolbar pagination pager search contentinfo
complementary skip topbar""".split())
#: Words beside a mark that make a class name one of furniture ("nav-bar", "widget-title", "share-buttons").
PARTS = frozenset("""area bar block body bottom box btn button buttons col column container content count desktop footer form global group header holder icon icons inner
item items label left link links list main mobile module page panel primary right secondary section site slot sticky top title toggle unit wrap wrapper""".split())
#: First words that say what a page has, is about or is like, not what the element is ("has-sidebar", "tag-search").
STATES = frozenset("about category domain format has hentry hide in is keyword no not show supports tag term theme topic type with without".split())
#: Words that end the article's own header's exemption: a header outside the article is furniture.
HEADER = "header"

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<holder>" + "|".join(HOLDERS) + r")(?=[\s/>])[^>]*>"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?>=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)(?:>|\Z)"
    r"|</?[a-zA-Z][^>]*(?:>|\Z)", re.S | re.I)
_HOLDER = {name: re.compile(r"<!--.*?(?:-->|\Z)|<script(?=[\s/>]).*?(?:</script\s*>|\Z)|<(?P<close>/?)(?P<name>" + name + r")(?=[\s/>])[^>]*>", re.S | re.I) for name in HOLDERS}
_ATTR = re.compile(r"""\b(class|id|role|style)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)|\b(hidden)\b""", re.I)
_WORD = re.compile(r"[^\W_]+", re.U)
#: A tag that the page ends in; a "<" before anything but a name is text.
_CUT_OFF = re.compile(r"<(?:/?[a-zA-Z]|[!?])[^\s<>]*\Z")
_CAMEL, _PART = re.compile(r"(?<=[a-z])(?=[A-Z])"), re.compile(r"[^a-z0-9]+")


def _names_furniture(token: str, whole_only: bool) -> bool:
    """Whether one class name, id or role is a mark: as it is, or with nothing but PARTS and numbers beside it
    or before it a name ("site-footer"). In a name of several words a mark elsewhere says something else
    ("comment-open", "social-science", "has-sidebar")."""
    if token in MARKS:
        return True
    words = [w for w in _PART.split(token) if w]
    if whole_only or len(words) < 2 or words[0] in STATES:
        return False
    rest = [w for w in words if w not in MARKS]
    return len(rest) < len(words) and (words[-1] in MARKS or all(w in PARTS or w.isdigit() for w in rest))


def _marked(attrs: str, element: str) -> bool:
    """Hidden, or marked as furniture by class, id or role; article and main only by a name that is a mark itself."""
    for name, value, hidden in _ATTR.findall(attrs):
        if hidden:
            return True
        value = value.strip("\"'")
        if name.lower() == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value.lower()):
                return True
        elif any(_names_furniture(t, element in ARTICLE) for t in _CAMEL.sub("-", value).lower().split()):
            return True
    return False


class Block:
    __slots__ = ("text", "words", "link_words", "furniture", "article", "heading")

    def __init__(self, text: str, link_words: int, furniture: bool, article: bool, heading: bool):
        self.text, self.words = text, len(text.split())
        self.link_words, self.furniture, self.article, self.heading = link_words, furniture, article, heading


def _empty(name: str, tag: str) -> bool:
    return name in ("svg", "math") and tag.endswith("/>")


def _ends(page: str, name: str) -> dict[int, int]:
    """Start of each element of this name that is closed -> its end."""
    out, opened = {}, []
    for m in _HOLDER[name].finditer(page):
        if m["close"]:
            if opened:
                out[opened.pop()] = m.end()
        elif m["name"] and not _empty(name, m[0]):
            opened.append(m.start())
    return out


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order. Unclosed, crossed and cut-off tags are tolerated: an
    unclosed element of HOLDERS loses its tag only, and the head ends where something stands that it cannot hold."""
    out: list[Block] = []
    text: list[str] = []
    linked = 0
    stack: list[tuple[str, bool, bool, bool]] = []  # name, furniture, article, heading; with what surrounds it
    links, in_head = 0, False

    def flush() -> None:
        nonlocal linked
        joined = " ".join(html.unescape("".join(text)).split())
        if joined:
            _, furniture, article, heading = stack[-1] if stack else ("", False, False, False)
            out.append(Block(joined, linked, furniture, article, heading))
        text.clear()
        linked = 0

    def add(piece: str) -> None:
        nonlocal linked, in_head
        in_head = in_head and not piece.strip()
        if piece and not in_head:
            text.append(piece)
            if links:
                linked += len(piece.split())

    at = 0
    ends: dict[str, dict[int, int]] = {}
    while m := _TAG.search(page, at):
        add(page[at:m.start()])
        at = m.end()
        name = (m["name"] or "").lower()
        element = (m["raw"] or m["holder"] or name).lower()
        if element and not m["close"] and element not in HEAD:
            in_head = False
        if m["holder"] and not _empty(element, m[0]):
            if element not in ends:
                ends[element] = _ends(page, element)
            at = ends[element].get(m.start(), at)
        if not name:
            if element and element != "title":
                text.append(" ")
            continue
        if name in ("head", "body"):
            flush()
            in_head = name == "head" and not m["close"]
            continue
        if name == "a":
            links = max(0, links - 1) if m["close"] else 1
            continue
        if name == "br":
            text.append(" ")
        marked = not m["close"] and bool(m["attrs"]) and name not in ("html",) and _marked(m["attrs"], name)
        if name in INLINE and not marked and not (m["close"] and any(s[0] == name for s in stack)):
            continue
        flush()
        if name == "hr" or name in VOID:
            continue
        if m["close"]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
            links = 0
            continue
        if stack and stack[-1][0] == name and name in ("p", "li", "dt", "dd", "option", "tr", "td", "th"):
            stack.pop()
        _, furniture, article, heading = stack[-1] if stack else ("", False, False, False)
        own = marked or name in FURNITURE or (name == HEADER and not article)
        stack.append((name, furniture or own, article or name in ARTICLE, heading or name in HEADINGS))
    cut_off = _CUT_OFF.search(page, at)
    add(page[at:cut_off.start()] if cut_off else page[at:])
    flush()
    return out


FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "furniture", "article", "heading")


def features(words: np.ndarray, link_words: np.ndarray, furniture: np.ndarray, article: np.ndarray, heading: np.ndarray) -> np.ndarray:
    """One row per block of one page, columns as FEATURES; before the first and after the last block is an empty one."""
    density = link_words / np.maximum(words, 1)
    shift = lambda x, by: np.concatenate(([0.0], x[:-1])) if by < 0 else np.concatenate((x[1:], [0.0]))
    words = words.astype(float)
    return np.stack([words, density, shift(words, -1), shift(density, -1), shift(words, 1), shift(density, 1), furniture, article, heading], axis=1).astype(float)


#: The labelled table: pages of (place, words, linked words, is main text). Places: f furniture,
#: a article, h heading in the article, x furniture inside the article, b plain body, t heading in plain body.
TABLE: tuple[tuple[tuple[str, int, int, int], ...], ...] = (
    (("f", 1, 1, 0), ("f", 1, 1, 0), ("f", 1, 1, 0), ("f", 15, 0, 0), ("h", 10, 0, 1), ("a", 60, 0, 1), ("a", 4, 0, 1), ("a", 120, 0, 1), ("f", 12, 0, 0)),
    (("f", 6, 6, 0), ("h", 8, 0, 1), ("a", 9, 0, 1), ("a", 33, 1, 1), ("x", 25, 0, 0), ("a", 75, 4, 1), ("a", 2, 0, 1), ("f", 30, 0, 0)),
    (("f", 3, 3, 0), ("f", 40, 2, 0), ("h", 5, 0, 1), ("a", 200, 3, 1), ("a", 7, 0, 1), ("a", 18, 18, 0), ("f", 5, 5, 0)),
    (("b", 2, 2, 0), ("b", 3, 3, 0), ("b", 5, 4, 0), ("t", 9, 0, 1), ("b", 80, 2, 1), ("b", 45, 0, 1), ("b", 60, 5, 1), ("b", 4, 4, 0), ("b", 6, 0, 0)),
    (("b", 1, 1, 0), ("b", 4, 0, 0), ("t", 7, 0, 1), ("b", 25, 0, 1), ("b", 12, 0, 1), ("b", 30, 1, 1), ("b", 3, 3, 0), ("b", 3, 3, 0), ("b", 10, 1, 0)),
    (("f", 2, 2, 0), ("f", 55, 0, 0), ("f", 20, 0, 0), ("t", 6, 0, 1), ("b", 90, 0, 1), ("b", 17, 0, 1), ("b", 110, 9, 1), ("f", 35, 0, 0), ("f", 28, 0, 0), ("f", 60, 1, 0)),
    (("b", 3, 3, 0), ("b", 8, 7, 0), ("b", 14, 12, 0), ("b", 22, 20, 0), ("b", 2, 0, 0), ("b", 5, 5, 0)),
    (("f", 4, 4, 0), ("h", 12, 0, 1), ("a", 1, 0, 1), ("a", 3, 0, 1), ("a", 2, 0, 1), ("x", 2, 2, 0), ("x", 70, 0, 0), ("a", 15, 0, 1), ("f", 9, 1, 0)),
    (("f", 8, 0, 0), ("h", 4, 4, 1), ("a", 28, 14, 1), ("a", 40, 10, 1), ("a", 6, 6, 0), ("a", 5, 5, 0), ("a", 50, 0, 1), ("f", 3, 0, 0)),
    (("b", 150, 0, 1), ("b", 70, 3, 1), ("b", 9, 0, 1), ("b", 85, 0, 1), ("b", 5, 0, 0)),
    (("b", 2, 0, 0), ("b", 3, 0, 0), ("b", 4, 2, 0), ("b", 21, 0, 1), ("b", 35, 0, 1), ("b", 2, 1, 0), ("b", 4, 0, 0)),
    (("a", 30, 0, 1), ("a", 3, 0, 1)),
    (("h", 5, 0, 1), ("a", 2, 0, 1), ("a", 40, 0, 1), ("a", 1, 0, 1), ("a", 8, 0, 1), ("a", 2, 0, 1), ("a", 1, 0, 1), ("a", 5, 0, 1)),
    (("f", 3, 3, 0), ("h", 6, 0, 1), ("a", 2, 0, 1), ("a", 12, 0, 1), ("a", 50, 0, 1), ("a", 2, 0, 1), ("a", 20, 0, 1), ("a", 6, 0, 1)),
    (("f", 5, 5, 0), ("a", 1, 0, 1), ("a", 9, 0, 1), ("a", 76, 0, 1), ("a", 1, 0, 1), ("a", 33, 0, 1), ("a", 4, 0, 1), ("f", 7, 0, 0)),
    (("h", 1, 0, 1), ("a", 1, 0, 1), ("a", 1, 0, 1), ("a", 2, 1, 1), ("a", 10, 0, 1), ("a", 3, 0, 1), ("f", 2, 2, 0)),
    (("b", 60, 0, 1), ("b", 40, 0, 1)),
    (("b", 3, 3, 0), ("b", 40, 8, 1), ("b", 55, 12, 1), ("b", 30, 5, 1), ("b", 4, 4, 0), ("b", 12, 9, 0)),
    (("b", 1, 0, 0), ("b", 2, 0, 0), ("b", 28, 0, 1), ("b", 95, 0, 1), ("b", 26, 2, 1)),
    (("f", 100, 0, 0), ("f", 6, 0, 0), ("h", 14, 0, 1), ("a", 300, 6, 1), ("h", 3, 0, 1), ("a", 90, 0, 1), ("f", 80, 0, 0), ("f", 45, 2, 0)),
)


def training_table() -> tuple[np.ndarray, np.ndarray]:
    rows, labels = [], []
    for page in TABLE:
        place, words, links, label = zip(*page)
        is_ = lambda kinds: np.array([p in kinds for p in place])
        rows.append(features(np.array(words), np.array(links), is_("fx"), is_("ahx"), is_("ht")))
        labels += label
    return np.concatenate(rows), np.array(labels)


Tree = tuple  # (feature, threshold, left, right), or (probability,)


def grow(x: np.ndarray, y: np.ndarray, depth: int = 7, least: int = 2) -> Tree:
    """A binary tree by the largest fall of the Gini impurity; ties go to the first feature and lowest threshold."""
    share = float(y.mean())
    if depth == 0 or share in (0.0, 1.0):
        return (share,)
    best: tuple = (1e-9,)
    impurity = share * (1 - share) * len(y)
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, c = x[order, f], np.cumsum(y[order])
        n = np.arange(1, len(y))
        ok = (v[1:] > v[:-1]) & (n >= least) & (len(y) - n >= least)
        left, right = c[:-1] / n, (c[-1] - c[:-1]) / (len(y) - n)
        gain = np.where(ok, impurity - left * (1 - left) * n - right * (1 - right) * (len(y) - n), 0)
        at = int(gain.argmax()) if len(gain) else 0
        if len(gain) and gain[at] > best[0] + 1e-9:
            best = (float(gain[at]), f, float((v[at] + v[at + 1]) / 2))
    if len(best) == 1:
        return (share,)
    _, f, cut = best
    low = x[:, f] <= cut
    return (f, cut, grow(x[low], y[low], depth - 1, least), grow(x[~low], y[~low], depth - 1, least))


def predict(tree: Tree, x: np.ndarray) -> np.ndarray:
    if len(tree) == 1:
        return np.full(len(x), tree[0])
    f, cut, left, right = tree
    out, low = np.empty(len(x)), x[:, f] <= cut
    out[low], out[~low] = predict(left, x[low]), predict(right, x[~low])
    return out


def main_text(page: str, tree: Tree) -> str:
    found = blocks(page)
    if not found:
        return ""
    column = lambda name: np.array([getattr(b, name) for b in found])
    main = predict(tree, features(*(column(n) for n in ("words", "link_words", "furniture", "article", "heading")))) >= 0.5
    return "\n\n".join(b.text for b, keep in zip(found, main) if keep)


def _extract(tree: Tree) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page, tree) if page else "" for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])
    return run


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars per row. Null or empty html, and pages without main text: an empty
    text. Repeated rows are extracted each; other columns are ignored; pages are read whole."""
    plain = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return plain.mapInArrow(_extract(grow(*training_table())), "page_id long, url string, text string, n_chars long")
