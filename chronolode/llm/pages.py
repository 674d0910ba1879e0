"""Main text of web pages by gradient-boosted trees over DOM nodes.

A page is parsed into block elements (inline elements only where they carry a class, id or role). Boosted trees give each
node the chance that it holds main text, from its tag, attribute tokens, depth, the text and link density of its subtree
and what its siblings hold. Hierarchical decoding then picks the likeliest labels of the whole tree in which no node is
kept under one that is dropped.

There are no labelled pages, so the trees are trained on a bounded sample of the given ones: pages that mark their
article by an element give labels as they are, and the same texts are laid out anew in generated pages of other
structure, whose labels are known: other wrappers, menus, sidebars, notices, adverts, forms, comments and footers.
"""

from __future__ import annotations

import html
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronolode.llm.common import fresh, parts_of, text_of, tidy

#: Bounds of training: pages read, characters of a page that is, and generated pages.
SAMPLE_PAGES = 200
SAMPLE_CHARS = 100_000
LAYOUTS = 500
TREES = 40
LEVELS = 4
BINS = 32
RATE = 0.2

#: Element names of HTML by their part in parsing.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("head script style noscript template title textarea select option svg math iframe object canvas audio video button datalist".split())
RAW = frozenset("script style noscript template title textarea iframe".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
GROUPS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "tr": {"table"}, "tbody": {"table"}, "thead": {"table"}, "tfoot": {"table"}}
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}}
ENDS |= {k: {"tbody", "thead", "tfoot", "tr", "td", "th"} for k in ("tbody", "thead", "tfoot")}

#: Words of classes, ids and roles by what such elements usually hold.
TOKENS = {
    "main": "article articlebody main content post entry story body text page blog single hentry prose".split(),
    "menu": "nav navigation navbar menu menubar breadcrumb breadcrumbs tabs toolbar topbar pagination pager skip toc".split(),
    "head": "header head masthead banner logo branding hero".split(),
    "foot": "footer foot copyright legal colophon bottom imprint credits contentinfo".split(),
    "side": "sidebar side aside widget widgets rail related recommended recommendations more trending popular teaser complementary archive archives tags tag".split(),
    "advert": "ad ads adv advert advertisement advertising sponsor sponsored promo promotion promoted adsense dfp outbrain taboola".split(),
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay dialog newsletter subscribe subscription signup paywall message warning".split(),
    "form": "form search login signin register contact input field fieldset button buttons".split(),
    "talk": "comment comments commentlist reply replies respond disqus discussion thread response responses feedback review reviews".split(),
    "share": "share sharing social follow byline author meta date timestamp tools print hidden sr only".split(),
}
KINDS = list(TOKENS)
KIND_OF = {w: i for i, k in enumerate(KINDS) for w in TOKENS[k]}
TAGS = {
    name: i
    for i, names in enumerate(
        ["p", "h1 h2 h3 h4 h5 h6", "ul ol menu dl", "li dt dd", "div", "section", "article main", "nav", "header hgroup", "footer", "aside", "form fieldset", "table tbody thead tfoot tr td th caption", "blockquote pre figure figcaption address", "html body", "dialog details summary"]
    )
    for name in names.split()
}
N_TAGS = max(TAGS.values()) + 2

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"'=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=|[\"'])*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|hidden|aria-hidden|style|data-truth)\b\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_HIDES = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_MARKS = re.compile(r"[.!?,;:]")


@dataclass
class Page:
    """A parsed page: nodes in page order, and pieces of text (node, text); node -1 is a block border."""

    tag: list[str] = field(default_factory=lambda: ["html"])
    kinds: list[dict] = field(default_factory=lambda: [{}])
    parent: list[int] = field(default_factory=lambda: [-1])
    depth: list[int] = field(default_factory=lambda: [0])
    truth: list[str | None] = field(default_factory=lambda: [None])
    hidden: list[bool] = field(default_factory=lambda: [False])
    linked: list[int] = field(default_factory=lambda: [0])
    pieces: list[tuple[int, str]] = field(default_factory=list)

    def add(self, tag: str, parent: int) -> int:
        self.tag.append(tag)
        self.kinds.append({})
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.truth.append(None)
        self.hidden.append(False)
        self.linked.append(0)
        return len(self.tag) - 1


def parse(source: str) -> Page:
    """The page's nodes and texts. Anything parses: unclosed, stray and crossing tags are read as browsers do, roughly."""
    page = Page()
    stack: list[tuple[str, int]] = [("html", 0)]  # open elements and the node their text belongs to
    open_tags, silent, links, at = Counter(["html"]), 0, 0, 0
    pieces = page.pieces

    def text(chunk: str) -> None:
        if not silent and chunk and not chunk.isspace():
            chunk = html.unescape(chunk) if "&" in chunk else chunk
            pieces.append((stack[-1][1], chunk))
            if links:
                page.linked[stack[-1][1]] += len(chunk)
        elif not silent and chunk:
            pieces.append((stack[-1][1], " "))

    def pop_to(depth: int) -> None:
        nonlocal silent, links
        while len(stack) > depth:
            name, _ = stack.pop()
            open_tags[name] -= 1
            silent -= name in SILENT
            links -= name == "a"
            if name not in INLINE:
                pieces.append((-1, ""))

    def closes(ends: set[str] | tuple, stops: set[str] | None) -> None:
        """End the innermost element of ``ends`` that is not beyond one of ``stops`` (none: beyond a block)."""
        if not any(open_tags[e] for e in ends):
            return
        for i in range(len(stack) - 1, 0, -1):
            name = stack[i][0]
            if name in ends:
                pop_to(i)
                return
            if name in stops if stops is not None else name not in INLINE:
                return

    while True:
        found = _TAG.search(source, at)
        if not found:
            text(source[at:])
            break
        text(source[at : found.start()])
        at = found.end()
        name = found[2]
        if not name:
            continue
        name = name.lower()
        if found[1]:
            if open_tags[name] and name != "html":
                crossing = name in INLINE
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == name:
                        pop_to(i)
                        break
                    if crossing and stack[i][0] not in INLINE:
                        break
            continue
        if name == "br":
            text(" ")
            if not silent:
                pieces.append((stack[-1][1], " "))
            continue
        if name in VOID:
            if name == "hr":
                closes(("p",), None)
                pieces.append((-1, ""))
            continue
        if name == "body":
            closes({"head"}, {"body"})
        if name not in INLINE:
            closes(("p",), None)
            if name in ENDS:
                while any(open_tags[e] for e in ENDS[name]):
                    before = len(stack)
                    closes(ENDS[name], GROUPS[name])
                    if len(stack) == before:
                        break
            pieces.append((-1, ""))
        node = stack[-1][1]
        attributes = found[3]
        marked = {}
        if attributes and not silent:
            for a in _ATTRIBUTE.finditer(attributes):
                marked.setdefault(a[1].lower(), a[2] or a[3] or a[4] or "")
        if name not in SILENT and not silent and name != "html" and (name not in INLINE or marked.keys() & {"class", "id", "role", "hidden", "aria-hidden", "data-truth"}):
            node = page.add(name, node)
            for key in ("class", "id", "role", "itemprop"):
                for word in _WORD.findall(marked.get(key, "")):
                    kind = KIND_OF.get(word.lower())
                    if kind is not None:
                        page.kinds[node][kind] = page.kinds[node].get(kind, 0) + 1
            page.truth[node] = marked.get("data-truth")
            page.hidden[node] = "hidden" in marked or marked.get("aria-hidden", "").lower() == "true" or bool(_HIDES.search(marked.get("style", "")))
        stack.append((name, node))
        open_tags[name] += 1
        silent += name in SILENT
        links += name == "a"
        if name in RAW:
            end = re.compile(rf"</{name}\b", re.I).search(source, at)
            at = end.start() if end else len(source)
    return page


def _ranges(parent: np.ndarray) -> np.ndarray:
    """For nodes in page order, one past the last node of each subtree."""
    end = np.arange(1, len(parent) + 1)
    for i in range(len(parent) - 1, 0, -1):
        p = parent[i]
        if p >= 0 and end[p] < end[i]:
            end[p] = end[i]
    return end


def features(page: Page) -> np.ndarray:
    """A row of numbers for each node of the page."""
    n = len(page.tag)
    own = np.zeros((n, 5))  # characters, words, marks, capitals, pieces
    for node, chunk in page.pieces:
        if node >= 0 and chunk != " ":
            words = chunk.count(" ") + 1
            own[node] += (len(chunk), words, len(_MARKS.findall(chunk)), chunk[:1].isupper(), 1)
    parent, depth = np.array(page.parent), np.array(page.depth)
    end = _ranges(parent)
    tag = np.array([TAGS.get(t, N_TAGS - 1) for t in page.tag])
    kinds = np.zeros((n, len(KINDS) + 1))
    for i, k in enumerate(page.kinds):
        for kind, count in k.items():
            kinds[i, kind] = count
        kinds[i, -1] = page.hidden[i]
    above = kinds.copy()  # of the node and all above it
    up_tag = np.zeros((n, N_TAGS), bool)
    up_tag[np.arange(n), tag] = True
    for i in range(1, n):
        above[i] += above[parent[i]]
        up_tag[i] |= up_tag[parent[i]]
    stacked = np.column_stack([own, page.linked, np.ones(n), tag == TAGS["p"], tag == TAGS["li"], own[:, 0] * (tag == TAGS["p"])])
    sums = np.concatenate([np.zeros((1, stacked.shape[1])), np.cumsum(stacked, axis=0)])
    sub = sums[end] - sums[:-1]
    chars, words, marks, _, pieces, linked, nodes, paragraphs, items, p_chars = sub.T
    total = max(chars[0], 1.0)
    siblings, place, before, after, alike = (np.zeros(n) for _ in range(5))
    children: dict[int, list[int]] = {}
    for i in range(1, n):
        children.setdefault(int(parent[i]), []).append(i)
    for group in children.values():
        at = np.array(group)
        siblings[at], place[at] = len(at), np.arange(len(at)) / max(len(at) - 1, 1)
        before[at[1:]], after[at[:-1]] = chars[at[:-1]], chars[at[1:]]
        same = Counter(tag[at].tolist())
        alike[at] = [same[int(t)] for t in tag[at]]
    outer = chars[np.maximum(parent, 0)]
    middle = (sums[:-1, 0] + chars / 2) / total
    below = np.column_stack([((np.concatenate([[0.0], np.cumsum(kinds[:, k])]))[end] - np.concatenate([[0.0], np.cumsum(kinds[:, k])])[:-1]) / nodes for k in range(len(KINDS))])
    columns = [tag, depth, np.log1p(own[:, 0]), np.log1p(chars), chars / total, linked / np.maximum(chars, 1), words / np.maximum(pieces, 1), marks / np.maximum(words, 1)]
    columns += [np.log1p(nodes), chars / nodes, paragraphs / nodes, items / nodes, p_chars / np.maximum(chars, 1), siblings, place, np.log1p(before), np.log1p(after), alike / np.maximum(siblings, 1)]
    columns += [chars / np.maximum(outer, 1), middle, own[:, 2] / np.maximum(own[:, 1], 1), np.full(n, np.log1p(total)), own[:, 3] / np.maximum(own[:, 4], 1)]
    one_hot = (tag[:, None] == np.arange(N_TAGS)[None, :]).astype(float)
    return np.column_stack([*columns, kinds, above, below, one_hot, up_tag.astype(float)])


@dataclass
class Trees:
    """Boosted trees of fixed depth over binned features; nodes of a tree as in a heap."""

    edges: np.ndarray  # [feature, bin border]
    feature: np.ndarray  # [tree, inner node]
    border: np.ndarray  # [tree, inner node]: to the right if the bin is above it
    value: np.ndarray  # [tree, leaf]
    base: float

    def log_odds(self, rows: np.ndarray) -> np.ndarray:
        used = np.unique(self.feature)
        bins = np.zeros(rows.shape, np.uint8)
        for f in used:
            bins[:, f] = np.searchsorted(self.edges[f], rows[:, f], "left")
        out, index = np.full(len(rows), self.base), np.arange(len(rows))
        for feature, border, value in zip(self.feature, self.border, self.value):
            at = np.zeros(len(rows), np.int64)
            for _ in range(LEVELS):
                at = 2 * at + 1 + (bins[index, feature[at]] > border[at])
            out += value[at - (2**LEVELS - 1)]
        return out


def boost(rows: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> Trees:
    """Trees for the logistic loss, each level split at the bins of largest gain."""
    edges = np.quantile(rows, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T.copy()
    bins = np.column_stack([np.searchsorted(e, c, "left") for e, c in zip(edges, rows.T)])
    n, width = bins.shape
    flat = bins + np.arange(width)[None, :] * BINS
    base = float(np.log((weights @ labels + 1) / (weights @ (1 - labels) + 1)))
    guess = np.full(n, base)
    inner, leaves = 2**LEVELS - 1, 2**LEVELS
    made = Trees(edges, np.zeros((TREES, inner), np.int64), np.full((TREES, inner), BINS), np.zeros((TREES, leaves)), base)
    for t in range(TREES):
        p = 1 / (1 + np.exp(-guess))
        slope, bend = weights * (labels - p), weights * p * (1 - p)
        at = np.zeros(n, np.int64)
        for level in range(LEVELS):
            first, size = 2**level - 1, 2**level
            key = ((at - first)[:, None] * (width * BINS) + flat).ravel()
            g, h = (np.bincount(key, np.repeat(v, width), size * width * BINS).reshape(size, width, BINS) for v in (slope, bend))
            left_g, left_h = g.cumsum(axis=2)[:, :, :-1], h.cumsum(axis=2)[:, :, :-1]
            all_g, all_h = g[:, 0].sum(axis=1)[:, None, None], h[:, 0].sum(axis=1)[:, None, None]
            gain = left_g**2 / (left_h + 1) + (all_g - left_g) ** 2 / (all_h - left_h + 1) - all_g**2 / (all_h + 1)
            gain = np.where((left_h > 1) & (all_h - left_h > 1), gain, 0).reshape(size, -1)
            best = gain.argmax(axis=1)
            split = gain[np.arange(size), best] > 1e-6
            made.feature[t, first : first + size] = np.where(split, best // (BINS - 1), 0)
            made.border[t, first : first + size] = np.where(split, best % (BINS - 1), BINS)
            at = 2 * at + 1 + (bins[np.arange(n), made.feature[t, at]] > made.border[t, at])
        leaf = at - inner
        made.value[t] = RATE * np.bincount(leaf, slope, leaves) / (np.bincount(leaf, bend, leaves) + 1)
        guess += made.value[t][leaf]
    return made


def decode(parent: list[int], log_odds: np.ndarray) -> np.ndarray:
    """The likeliest labels with no kept node under a dropped one; the root is kept."""
    n = len(parent)
    keep, drop = -np.logaddexp(0, -log_odds), -np.logaddexp(0, log_odds)
    for i in range(n - 1, 0, -1):
        keep[parent[i]] += max(keep[i], drop[i])
        drop[parent[i]] += drop[i]
    kept_nodes = np.zeros(n, bool)
    kept_nodes[0] = True
    for i in range(1, n):
        kept_nodes[i] = kept_nodes[parent[i]] and keep[i] >= drop[i]
    return kept_nodes


def blocks(page: Page, kept_nodes: np.ndarray) -> list[str]:
    """Texts of the blocks of kept nodes, in page order."""
    found, here = [], []

    def close() -> None:
        block = " ".join("".join(here).split())
        if block:
            found.append(block)
        here.clear()

    for node, chunk in page.pieces:
        if node < 0:
            close()
        elif kept_nodes[node]:
            here.append(chunk)
    close()
    return found


def _truth(page: Page) -> np.ndarray:
    """1 for nodes that hold main text or are in it. Marks hold for what is below them until another mark."""
    n = len(page.tag)
    inside, holds = np.zeros(n, bool), np.zeros(n, bool)
    for i in range(1, n):
        mark = page.truth[i]
        inside[i] = mark == "1" if mark is not None else inside[page.parent[i]]
    for i in range(n - 1, -1, -1):
        holds[i] |= inside[i]
        if i:
            holds[page.parent[i]] |= holds[i]
    return holds


def _given_truth(page: Page) -> np.ndarray | None:
    """Labels of a page with one article element."""
    marks = [i for i, t in enumerate(page.tag) if t == "article"]
    if len(marks) != 1:
        return None
    page.truth[marks[0]] = "1"
    for i, (t, k) in enumerate(zip(page.tag, page.kinds)):
        if t in ("nav", "footer", "aside", "form", "header") or any(KINDS[x] in ("advert", "talk", "notice", "side") for x in k):
            page.truth[i] = "0"
    return _truth(page)


def layout(rng: random.Random, paragraphs: list[str]) -> str:
    """A page of a random structure with ``paragraphs`` as its texts; data-truth marks main text and what interrupts it."""
    pick = rng.choice

    def words(low: int, high: int) -> str:
        source = pick(paragraphs).split() or ["text"]
        at = rng.randrange(len(source))
        return html.escape(" ".join(source[at : at + rng.randint(low, high)]), quote=False)

    def classed(kind: str, plain: float = 0.15) -> str:
        if rng.random() < plain:
            return ""
        token = pick(TOKENS[kind])
        token = pick([token, f"{token}-{pick(['box', 'wrap', 'area', 'list', 'inner', 'container', 'section', '1'])}", f"{pick(['site', 'page', 'js', 'main', 'c'])}-{token}"])
        return f' {pick(["class", "class", "id"])}="{token}"'

    def box(kind: str, body: str, names: str = "div div section", truth: str = "0", plain: float = 0.0) -> str:
        name = pick(names.split())
        return f'<{name}{classed(kind, plain)} data-truth="{truth}">{body}</{name}>'

    def link(low: int = 1, high: int = 3) -> str:
        return f'<a href="/{rng.randrange(999)}">{words(low, high)}</a>'

    def link_list() -> str:
        return f"<ul>{''.join(f'<li>{link(1, rng.randint(1, 9))}</li>' for _ in range(rng.randint(2, 9)))}</ul>"

    def prose(n: int, low: int = 8, high: int = 90) -> str:
        return "".join(f"<p>{words(low, high)}</p>" for _ in range(n))

    def menu() -> str:
        return box("menu", pick([link_list(), " | ".join(link() for _ in range(rng.randint(3, 8)))]), "nav nav div ul", plain=0.0)

    def head() -> str:
        inner = pick([words(1, 4), f"<h1>{words(1, 4)}</h1>", f"<h2>{link()}</h2><p>{words(3, 10)}</p>"])
        return box("head", inner + pick(["", menu()]), pick(["header", "header", "div"]))

    def side() -> str:
        parts = [f"<h3>{words(1, 4)}</h3>{pick([link_list(), prose(rng.randint(1, 3), 5, 50)])}" for _ in range(rng.randint(1, 3))]
        return box("side", "".join(parts), pick(["aside", "aside", "div", "div", "section"]))

    def advert() -> str:
        return box("advert", pick([words(2, 25), prose(1, 3, 30), link(3, 9), f"<p>{link(2, 8)}</p>{words(2, 9)}"]), "div div aside section")

    def notice() -> str:
        return box("notice", pick([f"<p>{words(5, 40)}</p><button>{words(1, 2)}</button>", words(5, 30) + link(), prose(2, 4, 30)]), "div div section aside dialog")

    def form() -> str:
        fields = "".join(f"<label>{words(1, 2)}</label><input name=x>" for _ in range(rng.randint(1, 4)))
        return box("form", f"{pick(['', f'<p>{words(3, 15)}</p>', f'<h3>{words(1, 4)}</h3>'])}{fields}<button>{words(1, 1)}</button>", pick(["form", "form", "div"]))

    def talk() -> str:
        one = lambda: box("talk", f"{pick(['', f'<span class=author>{words(1, 2)}</span>', f'<h4>{words(1, 3)}</h4>'])}{prose(rng.randint(1, 2), 4, 70)}", pick(["div", "li", "article", "div"]))
        return box("talk", f"{pick(['', f'<h2>{words(1, 3)}</h2>', f'<h3>{words(1, 3)}</h3>'])}{''.join(one() for _ in range(rng.randint(1, 6)))}{pick(['', form()])}", "div section div ol")

    def share() -> str:
        return box("share", " ".join(link(1, 2) for _ in range(rng.randint(2, 5))), "div ul p span")

    def foot() -> str:
        return box("foot", pick([f"&copy; {words(2, 9)}", f"<p>{words(4, 30)}</p>{link_list()}", link_list()]), pick(["footer", "footer", "div"]))

    texts = rng.sample(paragraphs, min(len(paragraphs), rng.choice([1, 2, 4, 8, 14])))
    inner = [f"<h1>{words(2, 9)}</h1>"] if rng.random() < 0.8 else []
    for t in texts:
        t = html.escape(t, quote=False)
        bits = t.split()
        if rng.random() < 0.25 and len(bits) > 8:
            t = " ".join(bits[:4]) + f" {pick([link(), f'<b>{bits[4]}</b>', f'<em>{bits[4]}</em>', f'<code>{bits[4]}</code>'])} " + " ".join(bits[5:])
        inner.append(pick(["<p>{}</p>"] * 9 + ["<div>{}</div>", "<blockquote><p>{}</p></blockquote>", "<p>{}"]).format(t))
        if rng.random() < 0.15:
            inner.append(pick([f"<h2>{words(1, 6)}</h2>", f"<ul>{''.join(f'<li>{words(2, 20)}</li>' for _ in range(rng.randint(2, 6)))}</ul>", f"<table><tr><td>{words(1, 4)}</td><td>{words(1, 4)}</td></tr></table>", f"<pre>{words(3, 20)}</pre>", f"<figure><figcaption>{words(3, 12)}</figcaption></figure>"]))
        if rng.random() < 0.12:
            inner.append(pick([advert, advert, share, notice, form, side])())
    if rng.random() < 0.3:
        inner.append(share())
    body = "".join(inner)
    main = box("main", body, "article div div div main section td", "1", plain=0.3)
    if rng.random() < 0.3:
        main = f"<{pick(['main', 'div', 'section'])}>{pick(['', share(), menu()])}{main}{pick(['', talk(), side()])}</div>"
    around = [head, menu, side, advert, notice, form]
    before = [f() for f in rng.sample(around, rng.randint(0, 4))]
    after = [f() for f in rng.sample([talk, side, foot, advert, notice, share, form, talk], rng.randint(0, 4))]
    whole = "".join([*before, main, *after]) + (foot() if rng.random() < 0.6 else "")
    for _ in range(rng.choice([0, 0, 1, 2])):
        whole = f'<div{pick(["", f" class={chr(34)}{pick(["wrapper", "container", "page", "site", "row", "col", "layout"])}{chr(34)}"])}>{whole}</div>'
    return f"<html><head><title>{words(2, 6)}</title></head><body>{whole}</body></html>"


def fit(sources: list[str], layouts: int = LAYOUTS, seed: int = 11) -> Trees:
    """Trees from sample pages."""
    rng = random.Random(seed)
    rows, labels, weights, paragraphs = [], [], [], []

    def learn(page: Page, truth: np.ndarray, weight: float) -> None:
        table = features(page)
        heavy = weight * np.minimum(1 + table[:, 3], 6)  # text at stake
        rows.append(table[1:])
        labels.append(truth[1:].astype(float))
        weights.append(heavy[1:])

    for source in sources:
        page = parse(source)
        everything = blocks(page, np.ones(len(page.tag), bool))
        paragraphs += [b for b in everything if len(b) > 20]
        truth = _given_truth(page)
        if truth is not None:
            learn(page, truth, 0.5)
    paragraphs = paragraphs or ["Some words that stand for a text of a page, as none was given."]
    for _ in range(layouts):
        page = parse(layout(rng, rng.sample(paragraphs, min(40, len(paragraphs)))))
        learn(page, _truth(page), 1.0)
    return boost(np.concatenate(rows), np.concatenate(labels), np.concatenate(weights))


def learn_pages(pages: DataFrame) -> Trees:
    """Trees from at most SAMPLE_PAGES of ``pages`` (page_id, html): those of at most SAMPLE_CHARS with the smallest hash."""
    sample = pages.select(F.col("page_id").alias("id"), text_of("html").alias("html")).where(F.char_length("html").between(1, SAMPLE_CHARS))
    return fit([r["html"] for r in sample.orderBy(F.xxhash64("id", "html"), "html").limit(SAMPLE_PAGES).collect()])


def extract(sources: list[str], trees: Trees) -> list[str]:
    """The main text of each page."""
    pages = [parse(s) for s in sources]
    tables = [features(p) for p in pages]
    odds = trees.log_odds(np.concatenate(tables)) if tables else np.zeros(0)
    found, at = [], 0
    for page, rows in zip(pages, tables):
        found.append("\n\n".join(blocks(page, decode(page.parent, odds[at : at + len(rows)]))))
        at += len(rows)
    return found


def main_text(pages: DataFrame, trees: Trees) -> DataFrame:
    """``pages`` with column main_text, the main text of html; blocks are joined by two line feeds.

    Pages without any (null or empty html, too) have an empty one. All rows and columns stay; an input column of that
    name is replaced. An empty table gives no rows.
    """
    pages = pages.drop("main_text")
    own = fresh(pages, "page_source")
    names, at = [*pages.columns, "main_text"], len(pages.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts_of(batches):
            texts = pa.array(extract(part.column(at).to_pylist(), trees), pa.string())
            yield pa.RecordBatch.from_arrays([*part.columns[:at], texts], names=names)

    schema = T.StructType([*pages.schema.fields, T.StructField("main_text", T.StringType())])
    return pages.withColumn(own, text_of("html")).mapInArrow(tidy(run), schema)
