"""Main-text extraction by gradient-boosted trees over DOM nodes.

Each element of a page's tree gets features of its subtree (text, link and tag density,
paragraphs, punctuation), its attribute tokens and those above it, its depth and its
siblings. Boosted trees give the log-odds that the element belongs to the main text, and
a dynamic programme over the tree picks the likeliest choice in which nothing below a
dropped element is kept. The trees are fitted, with a fixed seed, on pages that
`training_pages` lays out at random with known parts, so no label of the corpus is used.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconframe.llm.naming import carried, unused
from beaconframe.session import ship, table

_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r"[\"'>]")
_MARKUP = re.compile(r"<[^>]*>")
#: Deeper elements are not told apart from the one they lie in.
DEEPEST = 512
_ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math noframes xmp".split())
#: Elements whose text is never shown as text of the page.
UNSEEN = frozenset("head script style textarea title noscript template iframe svg noframes select option datalist object audio video canvas".split())
BLOCK = frozenset("html body address article aside blockquote center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split())
#: Parts of forms, which are not of the text wherever they lie unless the trees say so.
CONTROLS = frozenset("button label input fieldset form select".split())
_END = {t: re.compile(rf"</{t}\b[^>]*>?", re.I) for t in RAW}
#: What an opening tag closes, up to the nearest element that bounds it.
_CLOSES = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table tbody thead tfoot"), "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select"), "tbody": ("tbody thead tfoot tr td th", "table")}
_CLOSES = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in _CLOSES.items()}

#: Families of attribute tokens.
FAMILIES = {
    "content": "content article post entry story body text main prose markdown page blog news richtext copy articlebody",
    "nav": "nav navigation navbar menu breadcrumb breadcrumbs crumbs pagination pager tabs toc topnav sitenav subnav",
    "header": "header masthead banner topbar branding logo hero head site",
    "footer": "footer foot bottom copyright legal colophon",
    "side": "sidebar aside side rail widget widgets related recommended more popular trending teaser teasers tags toplist",
    "comment": "comment comments reply replies discussion disqus respond responses thread feedback reader",
    "ad": "ad ads advert advertisement advertising sponsor sponsored promo promotion promoted adsense dfp affiliate adbox adslot adunit",
    "notice": "cookie cookies consent notice gdpr alert popup modal overlay banner disclaimer privacy paywall newsbar announcement",
    "form": "form search login signup subscribe subscription newsletter register input field",
    "share": "share sharing social follow buttons toolbar tools print byline meta author date timestamp",
}
_FAMILY = {}
for _i, _words in enumerate(FAMILIES.values()):
    for _w in _words.split():
        _FAMILY[_w] = _FAMILY.get(_w, 0) | 1 << _i
#: Groups of tags, each a feature.
GROUPS = ["p", "div", "article", "main", "section", "nav menu", "header hgroup", "footer", "aside", "ul ol dl", "li dt dd", "form fieldset input button label select", "table tbody thead tr td th", "a", "h1", "h2 h3 h4 h5 h6", "blockquote pre figure figcaption", "body html"]
_GROUP = {t: i for i, g in enumerate(GROUPS) for t in g.split()}
_OF_TAG = {"nav": "nav", "menu": "nav", "header": "header", "footer": "footer", "aside": "side", "form": "form", "article": "content", "main": "content"}
_OF_TAG = {t: 1 << list(FAMILIES).index(f) for t, f in _OF_TAG.items()}


class Page:
    """The elements in document order; text pieces with their element; the order of all that happens."""

    __slots__ = ("events", "flags", "gold", "parents", "tags")

    def __init__(self) -> None:
        self.tags: list[str] = []
        self.parents: list[int] = []
        self.flags: list[int] = []
        self.gold: list[int] = []
        #: (element, text), and (element, None) where a block begins or ends.
        self.events: list[tuple[int, str | None]] = []


def _attributes(text: str) -> tuple[int, int]:
    return _few_attributes(text) if len(text) <= 400 else _few_attributes.__wrapped__(text)


@lru_cache(maxsize=20_000)
def _few_attributes(text: str) -> tuple[int, int]:
    """Families of the tokens of class, id, role and item properties; the mark of training pages (0 unknown, 1 drop, 2 keep)."""
    flags = gold = 0
    for name, *values in _ATTR.findall(text):
        name = name.lower()
        if name in ("class", "id", "role", "itemprop", "data-role", "aria-label"):
            for w in _WORDS.findall(_CAMEL.sub(" ", "".join(values)).lower()):
                flags |= _FAMILY.get(w, 0) or (_FAMILY.get(w[:-1], 0) if w[-1:] == "s" else 0)
        elif name == "data-gold":
            gold = 2 if values[0] == "1" else 1
    return flags, gold


def _tag_end(source: str, at: int) -> int:
    """Where the tag whose name ends at `at` has its `>`, quoted ones left out; -1 if the page ends before. A quote that is never closed ends the tag at the next `>`."""
    while m := _STOP.search(source, at):
        if m[0] == ">":
            return m.start()
        close = source.find(m[0], m.end())
        if close < 0:
            return source.find(">", m.end())
        at = close + 1
    return -1


def tokens(source: str) -> Iterator[tuple[str, str, str, int]]:
    """(kind, name, attributes or text, end) of each piece in order: kind is text, open or close. What is skipped is told by send(place). Each character is looked at a bounded number of times."""
    at, n = 0, len(source)
    while at < n:
        lt = source.find("<", at)
        if lt < 0:
            yield "text", "", source[at:], n
            return
        if lt > at:
            yield "text", "", source[at:lt], lt
        if source.startswith("<!--", lt):
            end = source.find("-->", lt + 4)
            at = n if end < 0 else end + 3
        elif source.startswith(("<!", "<?"), lt):
            end = source.find(">", lt)
            at = n if end < 0 else end + 1
        elif m := _NAME.match(source, lt):
            end = _tag_end(source, m.end())
            if end < 0:
                return  # a tag that the page's end cuts off
            close = source[lt + 1] == "/"
            skip = yield "close" if close else "open", m[1].lower(), source[m.end() : end], end + 1
            at = end + 1
            if skip is not None:
                at = skip
                yield "", "", "", at
        else:
            yield "text", "", "<", lt + 1
            at = lt + 1


def parse(source: str) -> Page:
    """The element tree of any text, with the usual repairs: implied ends of p, li and cells, stray and missing end tags. Time is linear in the text."""
    page = Page()
    tags, parents, events = page.tags, page.parents, page.events
    stack: list[int] = []
    count: dict[str, int] = {}
    unopened: dict[str, int] = {}
    n = len(source)

    def text(s: str) -> None:
        if s and stack:
            events.append((stack[-1], s))
        elif s.strip():
            begin("body", "")
            events.append((stack[-1], s))

    def begin(tag: str, attributes: str) -> None:
        flags, gold = _attributes(attributes) if attributes else (0, 0)
        k = len(tags)
        parents.append(stack[-1] if stack else -1)
        tags.append(tag)
        page.flags.append(flags)
        page.gold.append(gold)
        stack.append(k)
        count[tag] = count.get(tag, 0) + 1
        if tag in BLOCK:
            events.append((k, None))

    def pop_to(depth: int) -> None:
        while len(stack) > depth:
            k = stack.pop()
            count[tags[k]] -= 1
            if tags[k] in BLOCK:
                events.append((k, None))

    def find(names: frozenset[str] | set[str], stop: frozenset[str]) -> int:
        if not any(count.get(t) for t in names):
            return -1
        for d in range(len(stack) - 1, -1, -1):
            t = tags[stack[d]]
            if t in names:
                return d
            if t in stop:
                return -1
        return -1

    pieces = tokens(source)
    for kind, tag, inside, at in pieces:
        if kind == "text":
            text(inside)
            continue
        if kind == "close":
            if tag == "br":
                text("\n")
            elif unopened.get(tag):
                unopened[tag] -= 1
            elif (d := find({tag}, frozenset())) >= 0 and not (d == 0 and tag in ("html", "body")):
                pop_to(d)
            continue
        if tag in VOID:
            if tag in ("br", "hr", "img"):
                text("\n")
            if tag == "hr" and stack:
                events.append((stack[-1], None))
            continue
        if tag in ("html", "body") and count.get(tag):
            continue
        if tag == "body" and (d := find({"head"}, frozenset())) >= 0:
            pop_to(d)
        if tag in BLOCK and (d := find({"p"}, frozenset(("td", "th", "li", "div", "article", "section", "body", "button")))) >= 0:
            pop_to(d)
        if tag in _CLOSES:
            names, stop = _CLOSES[tag]
            while (d := find(names, stop)) >= 0:
                pop_to(d)
        empty = inside.rstrip().endswith("/")
        if tag in RAW and not (tag in ("svg", "math") and empty):
            e = _END[tag].search(source, at)
            inner = source[at : e.start()] if e else source[at:]
            begin(tag, inside)
            if tag == "math":  # a formula is one text
                text(_MARKUP.sub("", inner))
            elif tag == "xmp":
                text(inner.replace("&", "&amp;"))
            pop_to(len(stack) - 1)
            pieces.send(e.end() if e else n)
        elif empty and tag not in BLOCK:
            begin(tag, inside)
            pop_to(len(stack) - 1)
        elif len(stack) >= DEEPEST:
            unopened[tag] = unopened.get(tag, 0) + 1
            if tag in BLOCK:
                events.append((stack[-1], None))
        else:
            begin(tag, inside)
    pop_to(0)
    return page


def followers(page: Page) -> list[bool]:
    """Whether each element is inline, with no block within it: it goes with the element that it lies in."""
    n = len(page.tags)
    inline = [t not in BLOCK and t not in UNSEEN and t not in CONTROLS and page.parents[k] >= 0 for k, t in enumerate(page.tags)]
    for k in range(n - 1, -1, -1):
        p = page.parents[k]
        if p >= 0 and not inline[k] and page.tags[k] not in UNSEEN and page.tags[k] not in CONTROLS:
            inline[p] = False
    return inline


def features(page: Page) -> np.ndarray:
    """A row for each element."""
    n = len(page.tags)
    parents, tags = page.parents, page.tags
    own, words, marks, links, before = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
    depth, above, unseen, linked = [0] * n, [0] * n, [False] * n, [False] * n
    mine = [0] * n
    for k in range(n):
        p = parents[k]
        mine[k] = page.flags[k] | _OF_TAG.get(tags[k], 0)
        linked[k] = tags[k] == "a"
        unseen[k] = tags[k] in UNSEEN
        if p >= 0:
            depth[k], above[k] = depth[p] + 1, above[p] | mine[p]
            linked[k] |= linked[p]
            unseen[k] |= unseen[p]
    seen, first = 0, [-1] * n
    for k, s in page.events:
        if first[k] < 0:
            first[k] = seen
        if s is not None and not unseen[k]:
            c = len(s)
            seen += c
            own[k] += c
            words[k] += s.count(" ") + 1
            marks[k] += s.count(".") + s.count(",")
            if linked[k]:
                links[k] += c
    total, tw, tm, tl = own[:], words[:], marks[:], links[:]
    elements, paragraphs, items, inputs = [1] * n, [0] * n, [0] * n, [0] * n
    kids: list[list[int]] = [[] for _ in range(n)]
    for k in range(n - 1, -1, -1):
        p, t = parents[k], tags[k]
        paragraphs[k] += t == "p"
        items[k] += t == "li"
        inputs[k] += t in ("input", "button", "select", "textarea")
        if p >= 0:
            total[p] += total[k]
            tw[p] += tw[k]
            tm[p] += tm[k]
            tl[p] += tl[k]
            elements[p] += elements[k]
            paragraphs[p] += paragraphs[k]
            items[p] += items[k]
            inputs[p] += inputs[k]
            kids[p].append(k)
    place, brothers, alike, prev, nxt = [0.0] * n, [1] * n, [1.0] * n, [0] * n, [0] * n
    for group in kids:
        if group:
            group.reverse()
            m = len(group)
            count: dict[str, int] = {}
            for k in group:
                count[tags[k]] = count.get(tags[k], 0) + 1
            for i, k in enumerate(group):
                place[k], brothers[k], alike[k] = i / m, m, count[tags[k]] / m
                prev[k] = total[group[i - 1]] if i else 0
                nxt[k] = total[group[i + 1]] if i + 1 < m else 0
    f = lambda x: np.array(x, np.float64)
    total_, tw_, elements_, own_ = f(total), f(tw), f(elements), f(own)
    whole = max(1, seen)
    up = f([total[p] if p >= 0 else whole for p in parents])
    columns = [
        np.log1p(total_), np.log1p(tw_), f(tl) / np.maximum(total_, 1), np.log1p(elements_), total_ / elements_, f(tm) / np.maximum(tw_, 1), np.log1p(f(paragraphs)), np.log1p(f(items)), f(inputs),
        np.log1p(own_), total_ / whole, total_ / np.maximum(up, 1), f(depth), f(place), np.log1p(f(brothers)), f(alike), np.log1p(f(prev)), np.log1p(f(nxt)), f(first) / whole, np.log1p(total_ / np.maximum(f(paragraphs), 1)),
    ]
    groups = np.array([_GROUP.get(t, -1) for t in tags])
    bits = np.arange(len(FAMILIES))
    return np.concatenate(
        [
            np.stack(columns, 1).reshape(n, -1),
            (groups[:, None] == np.arange(len(GROUPS))).astype(float),
            (np.array(mine, int).reshape(-1, 1) >> bits & 1).astype(float),
            (np.array(above, int).reshape(-1, 1) >> bits & 1).astype(float),
        ],
        1,
    )


@dataclass
class Boosted:
    """Trees of a fixed depth: split feature and value of each inner node, value of each leaf."""

    feature: np.ndarray
    split: np.ndarray
    leaf: np.ndarray
    start: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.start), np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, split, leaf in zip(self.feature, self.split, self.leaf, strict=True):
            node = np.zeros(len(x), int)
            for _ in range(inner.bit_length()):
                node = 2 * node + 1 + (x[rows, feature[node]] > split[node])
            out += leaf[node - inner]
        return out


def boost(x: np.ndarray, y: np.ndarray, trees: int = 45, depth: int = 4, rate: float = 0.25, bins: int = 32, l2: float = 2.0) -> Boosted:
    """Logistic gradient boosting with histograms of quantile bins."""
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], 1)
    p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(p / (1 - p)))
    z, inner = np.full(n, start), 2**depth - 1
    model = Boosted(np.zeros((trees, inner), int), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)), start)
    for t in range(trees):
        s = 1 / (1 + np.exp(-z))
        g, h = s - y, s * (1 - s)
        node = np.zeros(n, int)
        for d in range(depth):
            base, m = 2**d - 1, 2**d
            local = node - base
            best = np.full(m, 1e-6)
            for j in range(width):
                at = local * bins + binned[:, j]
                gs, hs = (np.bincount(at, v, m * bins).reshape(m, bins).cumsum(1) for v in (g, h))
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + l2) + (gt - gs) ** 2 / (ht - hs + l2) - gt**2 / (ht + l2)
                gain[:, len(edges[j]) :] = 0
                k = gain.argmax(1)
                better = gain[np.arange(m), k] > best
                for b in np.flatnonzero(better):
                    best[b] = gain[b, k[b]]
                    model.feature[t, base + b], model.split[t, base + b] = j, edges[j][k[b]]
            node = 2 * node + 1 + (x[np.arange(n), model.feature[t, node]] > model.split[t, node])
        leaf = node - inner
        model.leaf[t] = -rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + l2)
        z += model.leaf[t, leaf]
    return model


def choose(page: Page, logits: np.ndarray) -> list[bool]:
    """The likeliest keep-or-drop of all elements in which nothing below a dropped element is kept and inline elements go with theirs."""
    n = len(page.tags)
    follows = followers(page)
    logits = np.where(follows, 0.0, logits)
    keep, drop = (-np.logaddexp(0, -logits)).tolist(), (-np.logaddexp(0, logits)).tolist()
    for k in range(n - 1, -1, -1):  # children before parents: best and all-dropped sums gather in keep and drop
        if page.tags[k] in UNSEEN:
            keep[k] = -1e18
        p = page.parents[k]
        if p >= 0:
            keep[p] += keep[k] if follows[k] else max(keep[k], drop[k])
            drop[p] += drop[k]
    chosen = [False] * n
    for k in range(n):
        p = page.parents[k]
        chosen[k] = chosen[p] if follows[k] else (p < 0 or chosen[p]) and keep[k] > drop[k]
    return chosen


def blocks(page: Page, chosen: list[bool]) -> str:
    out, now = [], []

    def end() -> None:
        if now:
            if block := " ".join(html_lib.unescape("".join(now)).split()):
                out.append(block)
            now.clear()

    for k, s in page.events:
        if s is None:
            end()
        elif chosen[k]:
            now.append(s)
    end()
    return "\n\n".join(out)


def extract(sources: list[str], model: Boosted) -> list[str]:
    pages = [parse(s) for s in sources]
    rows = [features(p) if p.tags else None for p in pages]
    x = [r for r in rows if r is not None]
    z = model.logits(np.concatenate(x)) if x else np.zeros(0)
    out, a = [], 0
    for p, r in zip(pages, rows, strict=True):
        if r is None:
            out.append("")
            continue
        out.append(blocks(p, choose(p, z[a : a + len(r)])))
        a += len(r)
    return out


def training_pages(n: int, seed: int = 5) -> Iterator[str]:
    """Pages of many layouts whose elements bear data-gold (1: of the main text or around it, 0: not)."""
    rng = np.random.default_rng(seed)
    pick = lambda *options: options[rng.integers(len(options))]
    chance = lambda p: rng.random() < p
    syllables = "an er th in on re at en nd st es ou le de la ra ti ve ro ma que der sch ung ción mente eau".split()
    word = lambda: "".join(rng.choice(syllables, rng.integers(1, 4)))
    words = lambda a, b: " ".join(word() for _ in range(rng.integers(a, b)))
    sentence = lambda: words(3, 16).capitalize() + pick(".", ".", ".", "!", "?", ", " + words(2, 6) + ".")
    prose = lambda a, b: " ".join(sentence() for _ in range(rng.integers(a, b)))
    noise = lambda: pick("", "", " ", "\n", "\n  ")

    def code() -> str:
        lines = "\n".join(f"{pick('', '    ', '        ')}{word()}{pick(' = ', '(', ' += ', ': ')}{word()}{pick(')', ';', '', ' # ' + words(1, 4))}" for _ in range(rng.integers(1, 12)))
        return pick(prose(1, 4), lines, f"<code>{lines}</code>")

    def attr(family: str | None, gold: int) -> str:
        names = FAMILIES[family].split() if family and chance(0.75) else [word() for _ in range(3)]
        made = [pick("{}", "{}", "{}-wrap", "site-{}", "{}__inner", "{}-box", "js-{}", "main-{}" if family == "content" else "{}-1").format(pick(*names)) for _ in range(rng.integers(1, 3))]
        kind = pick("class", "class", "id")
        return f' data-gold="{gold}"' + (f' {kind}="{" ".join(made)}"' if family or chance(0.4) else "")

    def paragraph(gold: int, long: float = 0.7) -> str:
        body = f"{words(1, 5).capitalize()}." if gold and chance(0.15) else prose(1, 9) if chance(long) else prose(1, 3)
        if chance(0.25):
            body = f'<{(t := pick("b", "i", "em", "strong", "span"))} data-gold="{gold}">{sentence()}</{t}> ' + body
        if chance(0.15):
            body += f' <a data-gold="{gold}" href="/x">{words(1, 4)}</a> {sentence()}'
        if chance(0.12):
            return f'<p data-gold="{gold}"><b data-gold="{gold}">{body}<br>'
        return f'<p data-gold="{gold}">{body}' + pick("</p>", "</p>", "</p>", "")

    def links(gold: int) -> str:
        item = lambda: f'<a data-gold="{gold}" href="/{word()}">{words(1, 4)}</a>'
        if chance(0.7):
            return f'<ul data-gold="{gold}">' + "".join(f'<li data-gold="{gold}">{item()}' + pick("</li>", "</li>", "") for _ in range(rng.integers(2, 9))) + "</ul>"
        return " ".join(item() for _ in range(rng.integers(2, 9)))

    def box(tag: str, family: str | None, inner: str, gold: int = 0) -> str:
        return f"<{tag}{attr(family, gold)}>{noise()}{inner}{noise()}</{tag}>"

    def comments() -> str:
        one = lambda: box(pick("div", "article", "li", "section"), pick("comment", "comment", None), (box("span", "share", words(1, 3)) if chance(0.6) else "") + (paragraph(0, 0.4) if chance(0.8) else prose(1, 4)))
        return box(pick("div", "section", "section", "ol"), "comment", (f'<h3 data-gold="0">{words(1, 3)}</h3>' if chance(0.7) else "") + "".join(one() for _ in range(rng.integers(1, 7))))

    def junk() -> str:
        return {
            "nav": lambda: box(pick("nav", "nav", "div", "ul"), "nav", links(0)),
            "header": lambda: box(pick("header", "header", "div"), "header", (f'<h1 data-gold="0">{words(1, 4)}</h1>' if chance(0.4) else box("div", "header", words(1, 5))) + (links(0) if chance(0.5) else "")),
            "footer": lambda: box(pick("footer", "footer", "div"), "footer", pick("&copy; ", "") + prose(1, 4) + (links(0) if chance(0.4) else "")),
            "side": lambda: box(pick("aside", "aside", "div"), "side", (f'<h3 data-gold="0">{words(1, 4)}</h3>' if chance(0.6) else "") + (links(0) if chance(0.6) else paragraph(0, 0.3))),
            "ad": lambda: box(pick("div", "div", "aside", "section", "p"), "ad", prose(1, 4) if chance(0.6) else f'<a data-gold="0" href="/ad">{sentence()}</a>'),
            "notice": lambda: box(pick("div", "div", "section", "p"), "notice", prose(1, 4) + (f' <button data-gold="0">{words(1, 3)}</button>' if chance(0.6) else "")),
            "form": lambda: box("form", "form", f'<label data-gold="0">{words(1, 4)}</label><input name="q"><button data-gold="0">{word()}</button>' + (f'<p data-gold="0">{sentence()}</p>' if chance(0.4) else "")),
            "share": lambda: box(pick("div", "ul"), "share", links(0) if chance(0.6) else words(1, 5)),
            "comment": comments,
            "script": lambda: f"<script>var a='<p>{word()}</p>';</script><style>.x{{}}</style><!-- {words(1, 6)} -->",
        }[pick("nav", "header", "footer", "side", "ad", "notice", "form", "share", "comment", "script")]()

    for _ in range(n):
        parts = []
        if chance(0.8):
            parts.append(f'<h1 data-gold="1">{words(2, 12)}</h1>')
        for _ in range(int(rng.integers(1, 14)) if chance(0.75) else 1):
            parts.append(paragraph(1) if chance(0.86) else {"h": lambda: f'<h2 data-gold="1">{words(1, 7)}</h2>', "l": lambda: '<ul data-gold="1">' + "".join(f'<li data-gold="1">{sentence()}</li>' for _ in range(rng.integers(2, 7))) + "</ul>", "q": lambda: f'<blockquote data-gold="1"><p data-gold="1">{prose(1, 4)}</p></blockquote>', "d": lambda: f'<div data-gold="1">{prose(1, 6)}</div>', "t": lambda: f'<table data-gold="1"><tr data-gold="1"><td data-gold="1">{words(1, 5)}</td><td data-gold="1">{words(1, 5)}</td></tr></table>', "p": lambda: f'<pre data-gold="1">{code()}</pre>', "f": lambda: f'<figure data-gold="1"><img src="x.png"><figcaption data-gold="1">{sentence()}</figcaption></figure>'}[pick("h", "l", "q", "d", "t", "p", "p", "f")]())
        if chance(0.35):
            parts.insert(int(rng.integers(len(parts) + 1)), junk())
        main = box(pick("article", "article", "article", "div", "div", "main", "section", "td"), "content" if chance(0.75) else None, noise().join(parts), 1)
        for _ in range(int(rng.integers(0, 3))):
            before = [junk()] if chance(0.25) else []
            after = [junk()] if chance(0.3) else []
            main = box(pick("div", "div", "main", "section"), "content" if chance(0.5) else None, "".join([*before, main, *after]), 1)
        top = [junk() for _ in range(rng.integers(0, 5))]
        end = [junk() for _ in range(rng.integers(0, 5))]
        body = noise().join([*top, main, *end])
        yield f'<!DOCTYPE html><html data-gold="1"><head data-gold="0"><title>{words(2, 9)}</title></head><body data-gold="1">{body}' + pick("</body></html>", "</body></html>", "")


@lru_cache(maxsize=1)
def trained(pages: int = 500) -> Boosted:
    x, y = [], []
    for source in training_pages(pages):
        page = parse(source)
        rows, gold = features(page), np.array(page.gold)
        known = (gold > 0) & np.array([t not in UNSEEN and not f for t, f in zip(page.tags, followers(page), strict=True)])
        x.append(rows[known])
        y.append(gold[known] - 1.0)
    return boost(np.concatenate(x), np.concatenate(y))


def _extracted(batches: Iterator[pa.RecordBatch], model: Boosted, names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        source = batch.column(batch.num_columns - 1)
        for a in range(0, batch.num_rows, 200):
            part = batch.slice(a, 200)
            texts = extract([t or "" for t in source.slice(a, 200).to_pylist()], model)
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=[*names, "text", "n_chars"])


def main_text(pages: DataFrame, carry: list[str], html: str = "html", model: Boosted | None = None) -> DataFrame:
    """The columns `carry`, text and n_chars (its code points).

    Blocks are joined by two line feeds, white space within a block is one space. A null
    or empty page, and one without main text, gives an empty text. Rows are kept as they
    are; other columns are ignored, and carried ones named like the two made ones. No rows
    give no rows.
    """
    ship(pages.sparkSession)
    fitted = model or trained()
    kept = carried(carry, ("text", "n_chars"))
    rows = pages.select(*[F.col(f"`{c}`") for c in kept], F.col(html).cast("string").alias(unused(kept, "html")))
    declared = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in kept)
    return rows.mapInArrow(lambda it: _extracted(it, fitted, kept), f"{declared}text string, n_chars bigint")


def query(spark, sf_dir: str) -> DataFrame:
    """op8: the main text of `pages`, whole table and whole pages."""
    return main_text(table(spark, sf_dir, "pages"), ["page_id", "url"])
