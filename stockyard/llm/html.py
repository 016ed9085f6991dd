"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the DOM.

A page becomes a sequence of blocks, each the text between two block-level tags with the tags above it. A block is main
text or not; the field scores it by its ancestors' tags and the words of their class, id and role, by its own text,
and by the label of the block before, and Viterbi's algorithm finds the best labelling of the page.

Training pages are labelled by their making: the field learns from pages of the table itself, whose semantic tags tell
the label (``semantic_labels``), and from other layouts of their text blocks, in which each block is put where main
text, menus, notices, forms, adverts or comments usually stand (``layouts``).
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stockyard.llm.common import mapped

SAMPLE_PAGES = 240  # pages of the table that are learnt from, at most about this many
MAX_TRAIN_BLOCKS = 120  # training pages with more blocks are left out
SLOTS = 1 << 12
EPOCHS, RATE = 12, 0.15
SLICE_BYTES = 1 << 20

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?][^>]*>|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)>",
    re.S,
)
_HINT = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")
#: all up to the closing tag is no text of the page, or all of the rest where there is none
RAW = frozenset("script style title textarea iframe".split())
#: dropped with their closing tag; one without it is a tag like any other
HIDDEN = frozenset("noscript template select".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html label legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
#: a new one ends an open one, unless a tag of the second list stands between
ENDS = {
    **{t: ({"p"}, {"button"}) for t in BLOCK},
    "li": ({"li", "p"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd", "p"}, {"dl"}), "dd": ({"dt", "dd", "p"}, {"dl"}),
    "tr": ({"tr", "td", "th", "p"}, {"table"}), "td": ({"td", "th", "p"}, {"tr", "table"}), "th": ({"td", "th", "p"}, {"tr", "table"}),
    "body": ({"head"}, set()),
}
PARTS = frozenset("article main nav header footer aside form section".split())
_SCOPES = frozenset("article aside body div footer form header html main nav section table td th ul ol".split())


@lru_cache(1 << 16)
def _features_of(label: str) -> tuple[str, tuple[str, ...], int]:
    """Tag, hints, and a bit for the slot of each."""
    tag, *hints = label.split(".")
    bits = 0
    for feature in (f"in:{tag}", *(f"hint:{w}" for w in hints)):
        bits |= 1 << _slot(feature)
    return tag, tuple(hints), bits


class Path:
    """An open tag with its hints (``div.sidebar``) and, through ``up``, those around it.

    All blocks inside share it, and the features of what stands above are shared as long as they stay the same, so a page
    needs memory in proportion to its length, however deep its tags are nested.
    """

    __slots__ = ("label", "tag", "up", "above", "part", "near")

    def __init__(self, label: str, up: Path | None):
        self.label, self.up = label, up
        self.tag, hints, own = _features_of(label)
        above = up.above if up else 0
        self.above = above if above | own == above else above | own  # a bit per slot
        self.part = self.tag if self.tag in PARTS else up.part if up else "none"
        self.near = hints if hints else up.near if up else ()

    def tags(self) -> list[list[str]]:
        """Tag and hints of each, from the outermost on."""
        out, node = [], self
        while node is not None:
            out.append(node.label.split("."))
            node = node.up
        return out[::-1]

    def key(self) -> tuple:
        """Paths with one key have the same features."""
        return self.above, self.tag, self.up.tag if self.up else "", self.part, self.near


class Block:
    __slots__ = ("path", "text", "linked")

    def __init__(self, path: Path | None, text: str, linked: int):
        self.path, self.text, self.linked = path, text, linked


def _closed(page: str, name: str) -> dict[int, int]:
    """For the elements of this name that have a closing tag: where the opening tag ends, and where the closing one does."""
    out: dict[int, int] = {}
    opened: list[int] = []
    raw = None
    for found in _TAG.finditer(page):
        own, end = (found["name"] or found["name2"] or "").lower(), found["end"] or found["end2"]
        if raw:
            if end and own == raw:
                raw = None
        elif own == name and not end:
            opened.append(found.end())
        elif own == name and opened:
            out[opened.pop()] = found.end()
        elif own in ("script", "style") and not end:
            raw = own
    return out


def blocks(page: str) -> list[Block]:
    """Leaf blocks in page order: path of tags with hints (``div.sidebar``), text, characters inside links."""
    out: list[Block] = []
    stack: list[str] = []
    labels: list[Path] = []
    opened: Counter[str] = Counter()  # open tags by name
    parts: list[str] = []
    hidden: dict[str, dict[int, int]] = {}
    linked = 0
    at, n = 0, len(page)

    def close(since: int) -> None:
        for tag in stack[since:]:
            opened[tag] -= 1
        del stack[since:], labels[since:]

    def flush() -> None:
        nonlocal linked
        if parts:
            raw = "".join(parts)
            text = " ".join((html.unescape(raw) if "&" in raw else raw).split())
            if text:
                out.append(Block(labels[-1] if labels else None, text, linked))
            parts.clear()
        linked = 0

    while at < n:
        found = _TAG.search(page, at)
        if found is None:
            parts.append(page[at:])
            break
        if found.start() > at:
            piece = page[at : found.start()]
            parts.append(piece)
            if opened["a"]:
                linked += len(piece)
        at = found.end()
        name = found["name"] or found["name2"]
        if name is None:
            if found[0].startswith("<![CDATA["):
                parts.append(html.escape(found[0][9:-3]))
            continue
        name = name.lower()
        if found["end"] or found["end2"]:
            if opened[name]:
                last = len(stack) - 1
                while stack[last] != name and (name in BLOCK or stack[last] not in BLOCK):
                    last -= 1
                if name in BLOCK:
                    flush()
                    close(last)
                elif stack[last] == name:  # an inline tag is not closed across a block
                    close(last)
            elif name in BLOCK:
                flush()
            continue
        rest = found["rest"] if found["name"] else found["rest2"]
        if name in RAW:
            foreign = bool(opened["svg"] or opened["math"])
            if foreign and rest.endswith("/"):
                continue
            ending = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
            if ending or not foreign:
                at = ending.end() if ending else n
                continue
        if name in HIDDEN:
            if name not in hidden:
                hidden[name] = _closed(page, name)
            if at in hidden[name]:
                at = hidden[name][at]
                continue
        if name == "br":
            parts.append(" ")
        if name in VOID:
            if name == "hr":
                flush()
            continue
        if name in BLOCK:
            flush()
            ended, walls = ENDS.get(name, (set(), set()))
            for i in range(len(stack) - 1, -1, -1):
                if stack[i] in walls or (stack[i] in _SCOPES and stack[i] not in ended):
                    break
                if stack[i] in ended:
                    close(i)
        hints = ""
        if rest and "=" in rest:
            hints = ".".join(w for m in _HINT.finditer(rest) for w in _WORD.findall((m[1] or m[2] or m[3] or "").lower()))
        if rest.endswith("/") and name not in BLOCK:
            continue
        labels.append(Path(f"{name}.{hints}" if hints else name, labels[-1] if labels else None))
        stack.append(name)
        opened[name] += 1
    flush()
    return out


@lru_cache(1 << 16)
def _slot(feature: str) -> int:
    value = 2166136261
    for c in feature.encode():
        value = (value ^ c) * 16777619 & 0xFFFFFFFF
    return (value ^ value >> 15) % SLOTS


def path_features(path: Path | None) -> list[int]:
    """Tags and hints anywhere above, the last two tags, and the closest tag that divides a page."""
    last, before = (path.tag, path.up.tag if path.up else None) if path else ("", None)
    found = {
        _slot(f"last:{last}"), _slot("pair:" + (f"{before}>{last}" if before is not None else last)),
        _slot(f"part:{path.part if path else 'none'}"), *(_slot(f"near:{w}") for w in (path.near if path else ())),
    }
    above, at = path.above if path else 0, 0
    while above:
        skip = (above & -above).bit_length()
        at += skip
        found.add(at - 1)
        above >>= skip
    return sorted(found)


def text_features(block: Block, place: int, count: int) -> list[int]:
    text = block.text
    words = text.count(" ") + 1
    found = [
        f"words:{min(7, int(math.log2(words)))}", f"links:{min(4, 4 * block.linked // max(1, len(text)))}",
        f"end:{text[-1] if text[-1] in '.!?:…' else 'a' if text[-1].isalpha() else 'o'}", f"commas:{min(3, text.count(','))}",
        f"sentences:{min(3, text.count('. '))}", f"place:{4 * place // count}", f"first:{place == 0}", f"last:{place == count - 1}",
        f"sign:{'©' in text or 'copyright' in text.lower()}",
    ]
    return [_slot(f) for f in found]


class Field:
    """Weights of the features for label 1, and of the pairs of neighbouring labels; label 0 has score 0."""

    def __init__(self) -> None:
        self.w = np.zeros(SLOTS)
        self.pair = np.zeros((2, 2))
        self.paths: dict[tuple, float] = {}

    def features(self, page: list[Block]) -> list[list[int]]:
        return [path_features(b.path) + text_features(b, i, len(page)) for i, b in enumerate(page)]

    def scores(self, page: list[Block]) -> np.ndarray:
        """Score of label 1 per block; the part of its path is kept for other pages."""
        out = np.empty(len(page))
        w = self.w
        for i, b in enumerate(page):
            key = b.path.key() if b.path else None
            known = self.paths.get(key)
            if known is None:
                if len(self.paths) > 50_000:
                    self.paths.clear()
                known = self.paths[key] = float(w[path_features(b.path)].sum())
            out[i] = known + sum(w.item(k) for k in text_features(b, i, len(page)))
        return out

    def viterbi(self, one: np.ndarray) -> list[int]:
        (a, b), (c, d) = self.pair.tolist()
        zero_best, one_best = 0.0, float(one[0])
        back = []
        for s in one[1:].tolist():
            from_zero = (zero_best + a >= one_best + c, zero_best + b >= one_best + d)
            zero_best, one_best = max(zero_best + a, one_best + c), max(zero_best + b, one_best + d) + s
            back.append(from_zero)
        label = int(one_best > zero_best)
        out = [label]
        for from_zero in reversed(back):
            label = 0 if from_zero[label] else 1
            out.append(label)
        return out[::-1]

    def learn(self, pages: list[tuple[list[list[int]], list[int]]], seed: int = 1) -> None:
        """Gradient ascent on the likelihood, page by page, with a step per weight that falls as it is used."""
        rng = np.random.default_rng(seed)
        used, used_pair = np.full(SLOTS, 1.0), np.full((2, 2), 1.0)
        for _ in range(EPOCHS):
            for i in rng.permutation(len(pages)):
                features, labels = pages[i]
                one = np.array([self.w[f].sum() for f in features])
                p, expected = self._marginals(one)
                grad_pair = -expected
                np.add.at(grad_pair, (labels[:-1], labels[1:]), 1.0)
                used_pair += grad_pair**2
                self.pair += RATE * (grad_pair - 0.001 * self.pair) / np.sqrt(used_pair)
                for f, y, q in zip(features, labels, p):
                    g = y - q
                    if abs(g) > 1e-4:
                        used[f] += g * g
                        self.w[f] += RATE * (g - 0.001 * self.w[f]) / np.sqrt(used[f])
        self.paths.clear()

    def _marginals(self, one: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(one)
        unary = np.stack([np.zeros(n), one], 1)
        forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
        forward[0] = unary[0]
        for t in range(1, n):
            forward[t] = np.logaddexp.reduce(forward[t - 1][:, None] + self.pair, axis=0) + unary[t]
        for t in range(n - 2, -1, -1):
            backward[t] = np.logaddexp.reduce(self.pair + unary[t + 1] + backward[t + 1], axis=1)
        total = np.logaddexp.reduce(forward[-1])
        joint = np.exp(forward[:-1, :, None] + self.pair[None] + (unary[1:] + backward[1:])[:, None, :] - total)
        return np.exp(forward[:, 1] + backward[:, 1] - total), joint.sum(0)

    def main_text(self, page: str) -> str:
        found = blocks(page)
        if not found:
            return ""
        if all(b.path is None for b in found):  # no markup: the page is its text
            return "\n".join(b.text for b in found)
        labels = self.viterbi(self.scores(found))
        return "\n".join(b.text for b, y in zip(found, labels) if y)


#: words that name parts of a page which are not main text, in tags or hints
SIDE_TAGS = frozenset("nav footer aside form button head menu dialog".split())
SIDE_HINTS = frozenset(
    "ad ads advert advertisement banner breadcrumb comment comments cookie copyright disqus footer header login menu modal nav navbar "
    "navigation newsletter notice popup promo related replies search share sidebar social sponsored subscribe toolbar widget".split()
)


def semantic_labels(page: list[Block]) -> list[int] | None:
    """1 inside an article or main element but no side part; None where the page has neither element."""
    out, any_main = [], False
    for b in page:
        tags = b.path.tags() if b.path else []
        inside = max((i for i, p in enumerate(tags) if p[0] in ("article", "main")), default=None)
        any_main |= inside is not None
        side = any(p[0] in SIDE_TAGS or SIDE_HINTS & set(p[1:]) for p in tags)
        headed = inside is not None and any(p[0] == "header" for p in tags[inside:]) and not tags[-1][0].startswith("h1")
        out.append(int(inside is not None and not side and not headed))
    return out if any_main else None


#: places of main text and of the other parts, as opening and closing markup around a block
MAIN_PLACES = [
    ("<article>", "</article>"), ("<main>", "</main>"), ("<main><article>", "</article></main>"), ('<div class="content">', "</div>"),
    ('<div id="main-content">', "</div>"), ('<div class="post"><div class="entry-content">', "</div></div>"), ('<section class="article-body">', "</section>"),
    ('<div id="wrapper"><div class="story-text">', "</div></div>"), ('<div role="main">', "</div>"), ("<div>", "</div>"), ("<section>", "</section>"),
]
MENUS = [("<nav><ul>", "</ul></nav>"), ('<div class="menu"><ul>', "</ul></div>"), ('<ul id="navigation">', "</ul>"), ('<div class="breadcrumb">', "</div>"), ("<header><nav>", "</nav></header>")]
HEADERS = [("<header>", "</header>"), ('<div id="header">', "</div>"), ('<div class="site-header"><p>', "</p></div>")]
FOOTERS = [("<footer>", "</footer>"), ('<div id="footer">', "</div>"), ('<div class="site-footer"><p>', "</p></div>"), ('<footer><div class="copyright">', "</div></footer>")]
SIDES = [("<aside>", "</aside>"), ('<div class="sidebar">', "</div>"), ('<aside class="related"><p>', "</p></aside>"), ('<div id="sidebar"><div class="widget">', "</div></div>")]
ADVERTS = [('<div class="ad">', "</div>"), ('<div class="advert">', "</div>"), ('<div class="banner-ads"><p>', "</p></div>"), ('<div class="sponsored">', "</div>"), ('<section class="promo">', "</section>")]
NOTICES = [('<div class="cookie-notice">', "</div>"), ('<div class="notice"><p>', "</p></div>"), ('<div id="newsletter-popup">', "</div>"), ('<div role="dialog"><p>', "</p></div>"), ('<div role="alert">', "</div>")]
FORMS = [("<form>", "</form>"), ('<form class="search"><label>', "</label></form>"), ('<form id="subscribe"><p>', "</p></form>"), ('<form><button>', "</button></form>")]
COMMENTS = [
    ('<div id="comments"><div class="comment"><p>', "</p></div></div>"), ('<section class="comments"><p>', "</p></section>"),
    ('<ol class="commentlist"><li>', "</li></ol>"), ('<div class="reader-comments"><p>', "</p></div>"), ('<section class="replies"><article class="comment"><p>', "</p></article></section>"),
    ('<div class="discussion"><p>', "</p></div>"), ('<div id="responses"><ul><li>', "</li></ul></div>"),
]


def layouts(main: list[str], other: list[str], rng: np.random.Generator) -> list[tuple[str, str]]:
    """A page as (label and markup) parts: where each of the texts ``main`` and ``other`` stands is drawn anew."""

    def pick(places: list[tuple[str, str]]) -> tuple[str, str]:
        return places[rng.integers(len(places))]

    def side(places: list[tuple[str, str]], text: str) -> tuple[str, str]:
        a, z = pick(places)
        return "0", f"{a}{html.escape(text)}{z}"

    def some(n: int) -> list[str]:
        return [other[rng.integers(len(other))] for _ in range(n)]

    a, z = pick(MENUS)
    item = "<li><a href='/x'>{}</a></li>" if "<ul" in a else "<a href='/x'>{}</a> "
    before = [("0", a + "".join(item.format(html.escape(w)) for t in some(1) for w in t.split()[:6]) + z)]
    for places in (HEADERS, NOTICES, ADVERTS, FORMS, SIDES):
        if rng.random() < 0.5:
            before.append(side(places, some(1)[0]))
    rng.shuffle(before)
    after = [side(places, t) for places in (SIDES, ADVERTS, COMMENTS, COMMENTS, FORMS, NOTICES) for t in some(int(rng.random() < 0.5))]
    after.append(side(FOOTERS, "© " + some(1)[0] if rng.random() < 0.5 else some(1)[0]))
    a, z = pick(MAIN_PLACES)
    inner: list[tuple[str, str]] = [("0", a)]
    if rng.random() < 0.6:
        level = rng.integers(1, 3)
        inner.append(("1", f"<h{level}>{html.escape(main[0][:60])}</h{level}>"))
        if level == 1 and rng.random() < 0.4:  # in a header of its own, above who wrote it and when
            inner[1:1] = [("0", "<header>")]
            inner.append(("0", f"<p>{html.escape(' '.join(some(1)[0].split()[:4]))}</p></header>"))
    kind = rng.random()
    for i, t in enumerate(main):
        tag = "p" if kind < 0.75 else "div" if kind < 0.85 else ("li" if i % 4 == 1 else "blockquote" if i % 4 == 3 else "p")
        inner.append(("1", f"<{tag}>{html.escape(t)}</{tag}>"))
        if rng.random() < 0.08:
            inner.append(side([*ADVERTS, *SIDES, *FORMS, *NOTICES], some(1)[0]))
    if rng.random() < 0.4:  # a list of short points, often at the end
        listing = "ul" if rng.random() < 0.6 else "ol"
        points = [("1", f"<li>{html.escape(' '.join(t.split()[: rng.integers(1, 7)]))}</li>") for t in main[: rng.integers(2, 5)]]
        at = len(inner) if rng.random() < 0.6 else int(rng.integers(1, len(inner) + 1))
        inner[at:at] = [("0", f"<{listing}>"), *points, ("0", f"</{listing}>")]
    if rng.random() < 0.3:
        inner.append(side(COMMENTS, some(1)[0]))
    inner.append(("0", z))
    return [("0", "<html><body>"), *before, *inner, *after, ("0", "</body></html>")]


def labelled_layout(parts: list[tuple[str, str]]) -> tuple[list[Block], list[int]] | None:
    """The blocks of a page with labels; each main part is marked by a character that its block is then known by."""
    mark = ""
    page = blocks("".join(markup.replace(">", f">{mark}", 1) if label == "1" else markup for label, markup in parts))
    labels = [int(mark in b.text) for b in page]
    for b in page:
        b.text = b.text.replace(mark, "").strip() or "-"
    return (page, labels) if page else None


def train(pages: list[str], seed: int = 9) -> Field:
    """A field from pages of the table; see the module's text on where labels come from."""
    rng = np.random.default_rng(seed)
    learnt = []
    field = Field()

    def add(page: list[Block], labels: list[int]) -> None:
        if 0 < len(page) <= MAX_TRAIN_BLOCKS:
            learnt.append((field.features(page), labels))

    phrases = ["Accept all cookies", "Subscribe to our newsletter", "Search", "Leave a comment", "Share this page", "All rights reserved", "Sign in"]
    for text in pages:
        page = blocks(text)
        labels = semantic_labels(page)
        main = [b.text for b, y in zip(page, labels or []) if y]
        other = [b.text for b, y in zip(page, labels or []) if not y] + phrases
        if labels:
            add(page, labels)
        if main:
            for _ in range(3):
                made = labelled_layout(layouts(main, [*other, *main[:2]], rng))
                if made:
                    add(*made)
    if learnt:
        field.learn(learnt)
    else:  # nothing to learn from: what the names of the parts say
        field.w[_slot("in:article")] = field.w[_slot("in:main")] = field.w[_slot("last:p")] = 2.0
        for name in SIDE_TAGS:
            field.w[_slot(f"in:{name}")] = -5.0
        for name in SIDE_HINTS:
            field.w[_slot(f"hint:{name}")] = -5.0
    return field


def fit(pages: DataFrame, page_id: str, page_html: str, sample: int = SAMPLE_PAGES) -> Field:
    """Trained on about ``sample`` pages, chosen by a hash of their id and text."""
    rows = pages.where(F.col(page_html).isNotNull()).select(F.xxhash64(page_id, page_html).alias("h"), F.col(page_html).alias("html"))
    most = rows.count()
    if most > sample:
        rows = rows.where(F.pmod("h", F.lit(1 << 30)) < int((1 << 30) * sample / most))
    return train([r.html for r in sorted(rows.where(F.length("html") < 100_000).collect())])


def main_texts(pages: DataFrame, page_id: str = "page_id", url: str = "url", page_html: str = "html") -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages``.

    ``text`` holds the blocks of main text in page order, one a line, with character references decoded and white
    space inside a block as one space; it is empty where there is none, as for null or empty html. Ids and urls may
    be null or repeated. Other columns are ignored; an empty table gives no rows.
    """
    held = pages.sparkSession.sparkContext.broadcast(fit(pages, page_id, page_html))

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = [held.value.main_text(p) if p else "" for p in b.column(2).to_pylist()]
        # a reference to half a surrogate pair cannot be written as UTF-8
        texts = [t.encode("utf-8", "replace").decode() for t in texts]
        return pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )

    columns = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(page_html).alias("html"))
    return mapped(columns, each, "page_id long, url string, text string, n_chars long", text=2, limit=SLICE_BYTES)
