"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded along the tree.

Every block element of a page is a node with features of its place (depth, siblings, position), its
subtree (text, density of links, tags and list items) and its tag and attribute tokens, its own and
those of its ancestors. Boosted trees give each node the probability of holding main text. Decoding
takes the most probable choice for all nodes together in which a kept node has kept ancestors, so a
paragraph can't be kept in a rejected sidebar, and plain paragraphs of one element tend to stay together. The text that stands directly in a kept node is a block of
the result; blocks follow each other in page order.

The trees are trained on a bounded sample of pages (``SAMPLE_PAGES``): on the pages themselves, labelled
by their semantic elements, and on pages built anew from their text, in which the article and menus,
headers, footers, sidebars, notices, adverts, forms and comments come in many elements, attributes and
places, or the article stands there without any element of its own. What training takes does not depend on the number of pages; extraction runs where they are read.

Defined cases: null and empty pages give an empty text; markup that is cut off or not closed is read as
far as it goes; text without any element is one block; a very long page is read as a whole; equal pages give
equal texts, of equally probable choices (ties) the one that drops is taken; null ids and URLs are kept, and
repeated rows stay; an empty table gives an empty result, without training. Only the named columns are read.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_PAGES = 160
VARIANTS = 18
PLAIN_PAGES = 0.25  # share of the pages built for training whose article has no element of its own
TREES, DEPTH, RATE, LEAST_HESSIAN = 160, 6, 0.2, 1.0
# Each tree is grown on some of the rows and features.
ROWS_PER_TREE, FEATURES_PER_TREE = 16_000, 96
BINS = 32
BOND = 1.5  # log odds that a plain paragraph needs to be dropped from a kept element
PAGES_AT_ONCE = 256

# Elements of HTML and customary attribute tokens.
BLOCK_TAGS = (
    "body div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption article section "
    "main nav header footer aside form fieldset figure figcaption blockquote pre address details summary "
    "dialog menu label button select option textarea hgroup center"
).split()
SKIPPED_TAGS = "script style noscript template svg math iframe object title head canvas audio video".split()
TOKENS = (
    "content article post entry story body text main page container wrapper row column nav navigation menu "
    "navbar breadcrumb breadcrumbs links header masthead top banner logo footer bottom copyright legal sidebar "
    "side aside widget related recommended trending notice notices cookie cookies consent alert popup modal "
    "gdpr newsletter subscribe signup promo promoted sponsor sponsored advert adverts advertisement ad ads form "
    "search login contact comments comment commentlist respond reply replies disqus discussion responses reviews "
    "share social meta tags pagination pager complementary contentinfo search banner dialog"
).split()
TOKENS = [*dict.fromkeys(TOKENS)]

TEXT_TAGS = {BLOCK_TAGS.index(t) for t in "p h1 h2 h3 h4 h5 h6 li dt dd tr td blockquote pre".split()}
TAG_OF = {tag: i for i, tag in enumerate(BLOCK_TAGS)}
TOKEN_OF = {token: i for i, token in enumerate(TOKENS)}
NUMBERS = 14
NAMES = len(BLOCK_TAGS) + len(TOKENS)
WIDTH = NUMBERS + 2 * NAMES

MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:"[^"]*"|'[^']*'|[^>"']|["'])*+)>?""", re.S
)
ATTRIBUTE = re.compile(r"""(class|id|role|data-main)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
PUNCTUATION = re.compile(r"[.,;:!?]")
# An element closes an open one of these, up to the element that holds them.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}


class Page(NamedTuple):
    """Nodes in page order, the body first, and pieces of text with their node and whether they link."""

    parent: list[int]
    tag: list[int]
    tokens: list[list[int]]
    markup: list[int]  # inline elements directly in the node
    label: list[int | None]
    texts: list[tuple[int, str, bool]]


def parse(html: str, *, built: bool = False) -> Page:
    """The block elements of a page and its text; scripts, styles, head and comments are left out.

    Only pages ``built`` for training have labels in their attributes.
    """
    page = Page([-1], [TAG_OF["body"]], [[]], [0], [None], [])
    stack, here, link, at, end = [0], 0, False, 0, len(html)
    names = ["body"]
    while at < end:
        found = MARKUP.search(html, at)
        if found is None:
            page.texts.append((here, html[at:], link))
            break
        if found.start() > at:
            page.texts.append((here, html[at : found.start()], link))
        at = found.end()
        closing, name, attributes = found.groups()
        if name is None:
            continue
        name = name.lower()
        if name == "a":
            link = not closing
        elif name in SKIPPED_TAGS and not closing:
            if not attributes.endswith("/"):
                after = re.compile(rf"</{name}\s*>", re.I).search(html, at)
                if after is not None:
                    at = after.end()
                elif name != "head":
                    at = end
        elif name == "body":
            if not closing:
                _attributes(page, 0, attributes, built)
        elif name not in TAG_OF:
            page.markup[here] += 1
            if name in ("br", "hr"):
                page.texts.append((here, " ", link))
        elif closing:
            if name in names:
                while names.pop() != name:
                    stack.pop()
                stack.pop()
                here, link = stack[-1], False
        else:
            if names[-1] == "p":
                names.pop()
                stack.pop()
            shut, holders = CLOSES.get(name, ((), ()))
            depth = len(names) - 1
            while depth > 0 and names[depth] not in holders:
                if names[depth] in shut:
                    del names[depth:], stack[depth:]
                depth -= 1
            node = len(page.parent)
            page.parent.append(stack[-1])
            page.tag.append(TAG_OF[name])
            page.tokens.append([])
            page.markup.append(0)
            page.label.append(None)
            if attributes:
                _attributes(page, node, attributes, built)
            stack.append(node)
            names.append(name)
            here, link = node, False
            # The text of a node that goes on after a child is another block.
    return page


def _attributes(page: Page, node: int, attributes: str, built: bool) -> None:
    for name, *values in ATTRIBUTE.findall(attributes):
        value = "".join(values)
        if name.lower() == "data-main":
            if built:
                page.label[node] = int(value)
        else:
            parts = {part.lower() for part in PART.findall(value)}
            page.tokens[node] += [TOKEN_OF[p] for p in parts if p in TOKEN_OF]


def features(page: Page) -> np.ndarray:
    """A row of small numbers per node."""
    n = len(page.parent)
    parent = np.array(page.parent)
    own, linked, marks = np.zeros(n), np.zeros(n), np.zeros(n)
    place = np.zeros(n)
    seen = 0
    first = [-1] * n
    for node, text, link in page.texts:
        size = len(text.strip())
        own[node] += size
        if link:
            linked[node] += size
        marks[node] += len(PUNCTUATION.findall(text))
        if first[node] < 0:
            first[node] = seen
        seen += size
    total, links, points = own.copy(), linked.copy(), marks.copy()
    tags, items, children = np.array(page.markup, float) + 1, np.zeros(n), np.zeros(n)
    items[np.array(page.tag) == TAG_OF["li"]] = 1
    depth, index, same = np.zeros(n), np.zeros(n), np.zeros(n)
    kinds: dict[tuple[int, int], int] = {}
    at = 0
    for i in range(1, n):
        p = page.parent[i]
        depth[i] = depth[p] + 1
        index[i] = children[p]
        children[p] += 1
        kinds[p, page.tag[i]] = kinds.get((p, page.tag[i]), 0) + 1
    for i in range(n):
        place[i] = at = first[i] if first[i] >= 0 else at
    for i in range(n - 1, 0, -1):
        p = page.parent[i]
        for sums in (total, links, points, tags, items):
            sums[p] += sums[i]
    same[1:] = [kinds[p, t] for p, t in zip(page.parent[1:], page.tag[1:])]
    beside = children[parent]
    beside[0] = 0
    around = total[parent] / np.maximum(beside, 1)
    around[0] = total[0]
    whole = max(1.0, total[0])
    log = lambda x: np.log2(1 + x) * 1.5
    share = lambda x: x * (BINS - 1)
    numbers = [
        depth,
        index,
        beside,
        same,
        children,
        log(total),
        log(own),
        share(links / np.maximum(total, 1)),
        log(1000 * tags / np.maximum(total, 1)),
        log(1000 * points / np.maximum(total, 1)),
        share(total / whole),
        share(place / whole),
        items,
        log(around),
    ]
    rows = np.zeros((n, WIDTH), np.uint8)
    rows[:, :NUMBERS] = np.stack(numbers, axis=1).clip(0, BINS - 1)
    for i in range(n):
        row = rows[i]
        row[NUMBERS + page.tag[i]] = 1
        for token in page.tokens[i]:
            row[NUMBERS + len(BLOCK_TAGS) + token] = 1
        if i:
            above = rows[page.parent[i]]
            np.maximum(above[NUMBERS : NUMBERS + NAMES], above[NUMBERS + NAMES :], out=row[NUMBERS + NAMES :])
    return rows


# Boosted trees


class Trees(NamedTuple):
    """Complete trees of depth ``DEPTH``: feature and bin of each inner node, value of each leaf."""

    feature: np.ndarray
    upto: np.ndarray
    value: np.ndarray

    def log_odds(self, rows: np.ndarray) -> np.ndarray:
        total, every = np.zeros(len(rows)), np.arange(len(rows))
        for feature, upto, value in zip(self.feature, self.upto, self.value):
            node = np.zeros(len(rows), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (rows[every, feature[node]] > upto[node])
            total += value[node - (2**DEPTH - 1)]
        return total


def boost(rows: np.ndarray, label: np.ndarray, seed: int = 7) -> Trees:
    """Second-order boosting of the logistic loss on binned features, a depth at a time."""
    pick = np.random.default_rng(seed)
    odds = np.zeros(len(rows))
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    grown = []
    for _ in range(TREES):
        at = np.sort(pick.permutation(len(rows))[:ROWS_PER_TREE])
        columns = np.sort(pick.permutation(rows.shape[1])[:FEATURES_PER_TREE])
        own = rows[at]
        n, width = len(own), len(columns)
        cell = np.arange(width) * BINS + own[:, columns]
        p = 1 / (1 + np.exp(-odds[at]))
        slope, curve = p - label[at], np.maximum(p * (1 - p), 1e-6)
        feature, upto = np.zeros(inner, np.int64), np.full(inner, BINS)
        node = np.zeros(n, np.int64)
        for depth in range(DEPTH):
            first, count = 2**depth - 1, 2**depth
            slot = ((node - first)[:, None] * (width * BINS) + cell).ravel()
            shape = (count, width, BINS)
            g = np.bincount(slot, np.repeat(slope, width), count * width * BINS).reshape(shape).cumsum(axis=2)
            h = np.bincount(slot, np.repeat(curve, width), count * width * BINS).reshape(shape).cumsum(axis=2)
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + 1) + (all_g - g) ** 2 / (all_h - h + 1) - all_g**2 / (all_h + 1)
            gain[(h < LEAST_HESSIAN) | (all_h - h < LEAST_HESSIAN)] = 0
            best = gain.reshape(count, -1).argmax(axis=1)
            some = gain.reshape(count, -1).max(axis=1) > 1e-9
            feature[first : first + count] = np.where(some, columns[best // BINS], 0)
            upto[first : first + count] = np.where(some, best % BINS, BINS)
            node = 2 * node + 1 + (own[np.arange(n), feature[node]] > upto[node])
        leaf = node - inner
        value = -RATE * np.bincount(leaf, slope, leaves) / (np.bincount(leaf, curve, leaves) + 1)
        grown.append((feature, upto, value))
        odds += Trees(*(np.stack([x]) for x in grown[-1])).log_odds(rows)
    return Trees(*(np.stack(x) for x in zip(*grown)))


# Training pages


def labelled(page: Page, inside: Iterable[int] = ()) -> np.ndarray:
    """1 for nodes that hold main text: marked ones and what is in them, and all that hold such nodes."""
    label = [0] * len(page.parent)
    for i, p in enumerate(page.parent):
        own = page.label[i]
        label[i] = own if own is not None else (label[p] if i else 0)
    for i in range(len(label) - 1, 0, -1):
        if label[i]:
            label[page.parent[i]] = 1
    return np.array(label)


def _semantic(page: Page) -> np.ndarray | None:
    """Labels of a page that has an article or main element, by its semantic elements; else none."""
    good, bad = {TAG_OF["article"], TAG_OF["main"]}, {TAG_OF[t] for t in ("nav", "header", "footer", "aside", "form")}
    if not good & set(page.tag):
        return None
    for i, tag in enumerate(page.tag):
        page.label[i] = 1 if tag in good else 0 if tag in bad else None
    return labelled(page)


def shortened(page: Page, label: np.ndarray, pieces: int, words: int) -> tuple[Page, np.ndarray]:
    """The page with the first ``pieces`` of its main text only, of ``words`` words each."""
    texts, main = [], 0
    for node, text, link in page.texts:
        if label[node] and text.strip():
            main += 1
            if main > pieces:
                continue
            text = " ".join(text.split()[:words])
        texts.append((node, text, link))
    needed = {0} | {node for node, text, _ in texts if text.strip()} | {i for i, x in enumerate(label) if not x}
    for i in range(len(label) - 1, 0, -1):
        if i in needed:
            needed.add(page.parent[i])
    order = sorted(needed)
    place = {node: i for i, node in enumerate(order)}
    of = lambda values: [values[i] for i in order]
    parent = [place.get(page.parent[i], -1) for i in order]
    texts = [(place[node], text, link) for node, text, link in texts if node in place]
    return Page(parent, of(page.tag), of(page.tokens), of(page.markup), of(page.label), texts), label[order]


class _Builder:
    """Pages in many forms, from the text blocks of other pages."""

    def __init__(self, texts: list[str], seed: int):
        self.random, self.texts = random.Random(seed), texts or ["Text"]

    def words(self, least: int, most: int) -> str:
        words = self.random.choice(self.texts).split()
        size = self.random.randint(least, most)
        first = self.random.randint(0, max(0, len(words) - size))
        return entities.escape(" ".join(words[first : first + size]))

    def element(self, tags: str, tokens: str, inner: str, label: int | None = None, bare: float = 0.3) -> str:
        tag = self.random.choice(tags.split())
        given = ""
        # A plain element says nothing by itself, mostly its attributes do.
        if self.random.random() > (bare if tag in ("div", "section", "ul", "ol", "p") else 0.6):
            token = self.random.choice(tokens.split())
            extra = self.random.choice(["", "", "-wrapper", "-container", "-area", "-box", " row", "-block", "s"])
            given = f' {self.random.choice(["class", "class", "id"])}="{token}{extra}"'
        mark = "" if label is None else f' data-main="{label}"'
        return f"<{tag}{given}{mark}>{inner}</{tag}>"

    def links(self, least: int, most: int) -> str:
        count = self.random.randint(least, most)
        anchors = [f'<a href="/{i}">{self.words(1, 4)}</a>' for i in range(count)]
        if self.random.random() < 0.7:
            return "<ul>" + "".join(f"<li>{a}</li>" for a in anchors) + "</ul>"
        return self.random.choice([" | ", " ", ", "]).join(anchors)

    def prose(self, least: int, most: int) -> str:
        if self.random.random() < 0.3 and most > 25:  # as long as an article
            return "".join(f"<p>{self.words(3, 100)}</p>" for _ in range(self.random.randint(2, 9)))
        body = self.words(least, most)
        return body if self.random.random() < 0.4 else f"<p>{body}</p>"

    def unwanted(self, kind: str) -> str:
        r, e = self.random, self.element
        if kind == "menu":
            return e("nav div ul", "nav menu navbar navigation breadcrumb breadcrumbs links", self.links(3, 9), 0)
        if kind == "header":
            inner = f"<h1>{self.words(1, 4)}</h1>" if r.random() < 0.5 else self.prose(2, 12)
            return e("header div", "header masthead top banner logo", inner + (self.links(2, 6) if r.random() < 0.5 else ""), 0)
        if kind == "footer":
            return e("footer div", "footer bottom copyright legal contentinfo", "&copy; " + self.prose(3, 25) + (self.links(2, 5) if r.random() < 0.5 else ""), 0)
        if kind == "sidebar":
            head = f"<h3>{self.words(1, 3)}</h3>" if r.random() < 0.6 else ""
            return e("aside div section", "sidebar side aside widget related recommended trending complementary", head + (self.links(3, 7) if r.random() < 0.6 else self.prose(5, 40)), 0, 0)
        if kind == "notice":
            return e("div section p dialog aside", "notice notices cookie cookies consent alert popup modal gdpr newsletter subscribe", self.prose(4, 35), 0, 0)
        if kind == "advert":
            return e("div aside section", "ad ads advert adverts advertisement sponsored sponsor promo promoted", self.prose(3, 35), 0, 0)
        if kind == "form":
            inner = f"<label>{self.words(1, 4)}</label><input type=text><button>{self.words(1, 2)}</button>"
            return e("form", "form search login contact signup", self.prose(1, 10) + inner, 0)
        if kind == "share":
            return e("div ul p", "share social meta tags pagination pager", self.links(2, 6), 0, 0)
        each = [
            e("div li article p section", "comment reply review", (f"<p>{self.words(1, 3)}</p>" if r.random() < 0.5 else "") + self.prose(4, 60), 0)
            for _ in range(r.randint(1, 5))
        ]
        head = f"<h3>{self.words(1, 2)}</h3>" if r.random() < 0.6 else ""
        return e("div section ol ul aside", "comments commentlist comment disqus discussion responses replies reviews respond", head + "".join(each), 0, 0)

    def article(self) -> str:
        r, parts = self.random, []
        brief = r.random() < 0.2
        for _ in range(r.randint(1, 2 if brief else 9)):
            kind = r.random()
            if kind < 0.78:
                parts.append(f"<p>{self.words(1, 8 if brief else 120)}</p>")
            elif kind < 0.86:
                parts.append(f"<h{r.randint(2, 4)}>{self.words(1, 7)}</h{r.randint(2, 4)}>")
            elif kind < 0.92:
                parts.append("<ul>" + "".join(f"<li>{self.words(2, 20)}</li>" for _ in range(r.randint(2, 5))) + "</ul>")
            elif kind < 0.96:
                parts.append(f"<blockquote><p>{self.words(5, 40)}</p></blockquote>")
            else:
                parts.append(f"<p>{self.words(3, 20)} <a href='/x'>{self.words(1, 3)}</a> {self.words(3, 20)}</p>")
        title = f"<h1>{self.words(2, 10)}</h1>"
        if r.random() < 0.8:
            parts.insert(0, title)
        for kind in ("advert", "notice", "share", "sidebar", "form", "menu", "footer", "comments"):
            if r.random() < 0.12:
                last = kind in ("footer", "comments")
                parts.insert(len(parts) if last else r.randint(0, len(parts)), self.unwanted(kind))
        return self.element("article article main section div div", "content article post entry story body text main", "".join(parts), 1, 0.25)

    def plain(self) -> str:
        """An article in elements that say nothing: paragraphs of the page itself, or divs in divs."""
        r, most = self.random, self.random.choice([6, 25, 120])
        form = r.random()
        if form < 0.45:
            head = [f'<h{r.randint(1, 2)} data-main="1">{self.words(1, 9)}</h1>'] if r.random() < 0.6 else []
            return "".join(head + [f'<p data-main="1">{self.words(1, most)}</p>' for _ in range(r.randint(1, 8))])
        if form < 0.6:
            tag = r.choice(["p", "p", "pre", "blockquote", "div"])
            return f'<{tag} data-main="1">{self.words(1, most)}</{tag}>'
        tags = r.choice([["div"], ["div"], ["div", "section"], ["center", "div"], ["p"]])
        inner = "".join(f"<{t}>{self.words(1, most)}</{t}>" for t in r.choices(tags, k=r.randint(1, 8)))
        if r.random() < 0.4:
            inner = f"<h1>{self.words(1, 9)}</h1>" + inner
        for _ in range(r.randint(0, 7)):
            inner = f"<div>{inner}</div>"
        return f'<div data-main="1">{inner}</div>'

    def page(self) -> str:
        r = self.random
        if r.random() < PLAIN_PAGES:
            before = [self.unwanted(k) for k in ("header", "menu", "notice") if r.random() < 0.25]
            last = [self.unwanted(k) for k in ("sidebar", "advert", "comments", "footer") if r.random() < 0.2]
            return "<html><body>" + "".join([*before, self.plain(), *last]) + "</body></html>"
        body = self.article()
        after = [self.unwanted("comments")] if r.random() < 0.4 else []
        beside = [self.unwanted("sidebar")] if r.random() < 0.5 else []
        inner = beside + [body, *after] if r.random() < 0.5 else [body, *after, *beside]
        middle = "".join(inner)
        for _ in range(r.randint(0, 3)):
            middle = self.element("div main section div", "page container wrapper row column main content", middle, None, 0.4)
        before = [self.unwanted(k) for k in ("header", "menu", "notice", "advert", "form") if r.random() < 0.5]
        r.shuffle(before)
        last = [self.unwanted(k) for k in ("form", "notice", "advert", "menu", "footer") if r.random() < 0.45]
        return "<html><body>" + "".join(before) + middle + "".join(last) + "</body></html>"


def train(pages: list[str], *, variants: int = VARIANTS, seed: int = 7) -> Trees:
    """Trees from sample pages: these themselves as far as they label themselves, and built ones."""
    rows, labels, texts = [], [], []
    for source in pages:
        page = parse(source)
        texts += [t for _, t, link in page.texts if not link and len(t) > 40]
        label = _semantic(page)
        if label is not None:
            pick = random.Random(len(source))
            short = [shortened(page, label, pick.randint(1, 3), pick.randint(1, 8)) for _ in range(4)]
            for each, own in [(page, label)] * 2 + short:
                rows.append(features(each))
                labels.append(own)
    builder = _Builder([entities.unescape(t) for t in texts], seed)
    for _ in range(variants * max(len(pages), SAMPLE_PAGES // 2)):
        page = parse(builder.page(), built=True)
        rows.append(features(page))
        labels.append(labelled(page))
    return boost(np.concatenate(rows), np.concatenate(labels).astype(float))


# Extraction


def bonds(page: Page) -> np.ndarray:
    """What it costs to drop a node from a kept parent: for plain text elements, which go together."""
    plain = [t in TEXT_TAGS and not own and p > 0 for t, own, p in zip(page.tag, page.tokens, page.parent)]
    return np.where(plain, BOND, 0.0)


def decode(parent: list[int], odds: np.ndarray, bond: np.ndarray) -> np.ndarray:
    """The most probable choice in which every kept node has a kept parent; the body is kept.

    Nodes come after their parents. ``keep`` is the best total of a subtree whose top is kept, ``drop``
    that of the subtree left out, which costs a bond more where the parent is kept.
    """
    bond = bond.tolist()
    keep = (-np.logaddexp(0, -odds)).tolist()
    drop = (-np.logaddexp(0, odds)).tolist()
    n = len(parent)
    for i in range(n - 1, 0, -1):
        p = parent[i]
        keep[p] += max(keep[i], drop[i] - bond[i])
        drop[p] += drop[i]
    kept = np.zeros(n, bool)
    kept[0] = True
    for i in range(1, n):
        kept[i] = kept[parent[i]] and keep[i] > drop[i] - bond[i]
    return kept


def assemble(page: Page, kept: np.ndarray) -> str:
    """Blocks of the kept nodes: text of one node without another block between, white space as one space."""
    blocks, last, parts = [], -1, []
    for node, text, _ in page.texts:
        if node != last:
            blocks.append((last, parts))
            last, parts = node, []
        parts.append(text)
    blocks.append((last, parts))
    lines = (" ".join(entities.unescape("".join(p)).split()) for node, p in blocks if node >= 0 and kept[node])
    return "\n".join(line for line in lines if line)


def extract(pages: list[str], trees: Trees) -> list[str]:
    """Main texts of some pages at a time."""
    parsed = [parse(page) for page in pages]
    sizes = [len(p.parent) for p in parsed]
    odds = trees.log_odds(np.concatenate([features(p) for p in parsed])) if parsed else np.zeros(0)
    texts, at = [], 0
    for page, size in zip(parsed, sizes):
        texts.append(assemble(page, decode(page.parent, odds[at : at + size], bonds(page))))
        at += size
    return texts


def fit(pages: DataFrame, *, html: str = "html", sample: int = SAMPLE_PAGES) -> Trees | None:
    """Train on ``sample`` pages at most, picked by a hash of the page; nothing to train on gives none.

    The least hashes are wanted; a share of the hashes that holds about twice as many goes to the driver.
    """
    own = pages.select(F.col(html).alias("html")).filter("html is not null and html <> ''")
    count = own.count()
    if not count:
        return None
    share = min(1.0, 2 * sample / count)
    own = own.withColumn("h", F.pmod(F.xxhash64("html"), F.lit(1 << 40))).filter(F.col("h") < int(share * (1 << 40)))
    rows = sorted(own.collect(), key=lambda row: row.h)
    return train([row.html for row in rows[:sample]])


def main_text(
    pages: DataFrame,
    *,
    id: str = "page_id",
    url: str = "url",
    html: str = "html",
    trees: Trees | None = None,
) -> DataFrame:
    """``(id, url, text)`` per row; without ``trees`` they are trained on a sample of the pages."""
    trees = fit(pages, html=html) if trees is None else trees
    own = pages.select(F.col(id).cast("bigint").alias("id"), F.col(url).alias("url"), F.col(html).alias("html"))
    if trees is None:  # no page has any text
        return own.select(F.col("id").alias(id), F.col("url").alias(url), F.lit("").alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, PAGES_AT_ONCE):
                part = batch.slice(i, PAGES_AT_ONCE)
                texts = extract([x or "" for x in part["html"].to_pylist()], trees)
                yield pa.RecordBatch.from_arrays(
                    [part["id"], part["url"], pa.array(texts, pa.string())], names=["id", "url", "text"]
                )

    return own.mapInArrow(run, "id bigint, url string, text string").withColumnsRenamed({"id": id, "url": url})
