"""The article of a page without the frame of its site (problem 4).

Gradient-boosted trees score units of text from features of their place in the element tree: density of text and links in the
subtrees around it, tokens of attributes, depth, statistics of its siblings, its place against the headline.  Hierarchical
decoding then labels the tree as a whole: an element is kept, dropped or mixed, and below a kept or dropped one nothing may say
otherwise.

The headline is the first unit that agrees with the page's title; on a page where none does, trees of their own choose it among all units, by
their place and looks alone.  Units of the headline's element from the headline on are scored by the same trees on both kinds of pages, and nothing tells
them of which kind a page is, so an article under another title is as good as any.

No page comes labelled, so the trees learn from a bounded sample of pages whose labels follow from what only all pages show: text that
recurs on other pages, of all captures, is frame, the page's title names the headline, and the element around the headline holds the
article.  Sample pages without a unit that agrees with the title count as pages without an article.
"""

from __future__ import annotations

import gc
import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pages import Page, decoded, is_html, parse, plain
from .words import hash_sample, pieces

_LETTERS = re.compile(r"[^\W\d_]+")
_DIGITS = re.compile(r"\d+")
_COUNTED = re.compile(r"\(\d+\)\s*$")
_SHUTS = frozenset(".!?)%»\"”")
_SHUT = re.compile(r"[.!?)%»\"”]\s*$")
#: Fixed values of HTML: elements that a unit may stand in, and that may stand around it.
_TAGS = ("p", "div", "span", "li", "td", "h1", "h2", "h3", "h4", "blockquote", "button", "center", "body", "section", "aside")
_FRAMES = ("nav", "header", "footer", "aside", "form", "button", "ul", "table", "article", "main", "section", "center")


def letters(text: str) -> str:
    return "".join(_LETTERS.findall(text.lower()))


@dataclass(slots=True)
class View:
    """What features and labels share about a page; ``titled`` tells that the headline agrees with the title.  ``first`` and ``end`` bound the units of every element."""

    page: Page
    headline: int
    container: int
    first: list[int]
    end: list[int]
    titled: bool

    def candidates(self) -> range:
        """The units that can be article: in the headline's element, from the headline on (an element's units stand next to each other)."""
        return range(self.headline, self.end[self.container]) if self.headline >= 0 else range(0)


def view(page: Page) -> View:
    """Find the headline (the first unit that begins the title, or that the title begins) and the element around it that holds more text."""
    title, headline = letters(page.title), -1
    for i, u in enumerate(page.units) if title else ():
        if not u.in_head and u.pieces and len(u.text) >= 12 and next((c for c in u.text if c.isalpha()), "").lower()[:1] == title[0]:
            t = letters(u.text)
            if len(t) >= 12 and (title.startswith(t) or (len(title) >= 30 and t.startswith(title))):
                headline = i
                break
    n = len(page.units)
    first, end = [n] * len(page.nodes), [0] * len(page.nodes)
    for i, u in enumerate(page.units):
        if first[u.node] == n:
            first[u.node] = i
        end[u.node] = i + 1
    for k in range(len(page.nodes) - 1, 0, -1):  # children come after their parents
        if end[k]:
            up = page.nodes[k].parent
            first[up], end[up] = min(first[up], first[k]), max(end[up], end[k])
    v = View(page, -1, -1, first, end, headline >= 0)
    if headline >= 0:
        place_headline(v, headline)
    return v


def place_headline(v: View, headline: int) -> None:
    """Take a unit for the headline: its element is the nearest above it with a longer unit after it."""
    units, nodes = v.page.units, v.page.nodes
    k = units[headline].node
    longer = [i for i in range(headline + 1, len(units)) if len(units[i].text.split()) >= 5]
    while k > 0 and not (longer and longer[0] < v.end[k]):
        k = nodes[k].parent
    v.headline, v.container = headline, max(k, 0)


_FLAG = {x: 1 << i for i, x in enumerate(_FRAMES)}
_TAG_NO = {x: i for i, x in enumerate(_TAGS)}


@dataclass
class Trees:
    """Boosted trees; an empty set says ``base``."""

    split: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), int))
    cut: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    leaf: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    base: float = -5.0

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        r = np.arange(len(x))
        for split, cut, leaf in zip(self.split, self.cut, self.leaf):
            at = np.zeros(len(x), int)
            while True:
                f = split[at]
                if (f < 0).all():
                    break
                right = x[r, np.maximum(f, 0)] > cut[at]
                at = np.where(f < 0, at, 2 * at + 1 + right)
            out += leaf[at]
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def _accumulated(x: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros((1, x.shape[1])), np.cumsum(x, 0)])


@dataclass
class ArticleModel:
    names: dict = field(default_factory=dict)
    words: dict = field(default_factory=dict)
    trees: Trees = field(default_factory=Trees)
    headlines: Trees = field(default_factory=Trees)
    mixed_cost: float = 0.5
    least_headline: float = 0.2
    texts: dict = field(default_factory=dict)

    def __getstate__(self):
        return self.__dict__ | {"texts": {}}

    def _text(self, t: str) -> tuple:
        """Numbers of a unit's words and signs alone; remembered for short ones, since frames recur."""
        found = self.texts.get(t)
        if found is None:
            table, split = self.words, t.split()
            low = _LETTERS.findall(t.lower())
            lw = [x for x in map(table.get, low) if x is not None]
            found = (
                sum(map(len, _DIGITS.findall(t))) / max(len(t), 1), sum([w[0].isupper() for w in split]) / max(len(split), 1), "|" in t, "©" in t, t[-1:] == ")" and bool(_COUNTED.search(t)),
                sum(lw) / len(lw) if lw else 0.0, min(lw, default=0.0), table.get(("^", *low[:2]), 0.0),
            )
            if len(t) < 120:
                if len(self.texts) > 200_000:
                    self.texts.clear()
                self.texts[t] = found
        return found

    def features(self, views: list[View], wanted: list) -> np.ndarray:
        """One row of numbers for each of the ``wanted`` units of every page, the pages in turn."""
        table, text = self.names, self._text
        unit, node, pick, of_page = [], [], [], []
        page = []  # per page: first unit, units, whether it is closed, headline
        for v, want in zip(views, wanted):
            nodes, units = v.page.nodes, v.page.units
            if not len(want):
                continue
            # only what is around the wanted units counts: the elements below the top one, and the units two elements further up, with their neighbours
            top = v.container if v.headline >= 0 and want[0] >= v.headline else 0
            above = [top]
            while above[-1] > 0:
                above.append(nodes[above[-1]].parent)
            out = above[min(2, len(above) - 1)]
            lo, hi = max(v.first[out] - 1, 0), min(v.end[out] + 1, len(units))
            u0 = len(unit) - lo
            unit.extend([(len(u.text.split()), len(u.text), u.linked, u.text[-1:] == "…" or u.text[-3:] == "...", u.text[-1:] in _SHUTS) for u in units[lo:hi]])
            chain, k = {}, units[v.headline].node if v.headline >= 0 else -1
            while k >= 0:
                chain[k] = len(chain)
                k = nodes[k].parent
            flags, odds, meets, own = {0: 0}, {0: (0.0, 0, 0.0, 0.0)}, {0: chain.get(0, 12)}, {0: (0.0, 0)}
            for k in (*reversed(above), *range(top + 1, max(units[i].node for i in want) + 1)):  # parents come first
                if k == 0:
                    continue
                d = nodes[k]
                up = d.parent
                flags[k] = flags[up] | _FLAG.get(d.tag, 0)
                meets[k] = chain[k] if k in chain else meets[up]
                found = [table[x] for x in d.names if x in table] if d.names else ()
                if found:
                    own[k] = (sum(found), len(found))
                    total, n, low, high = odds[up]
                    odds[k] = (total + own[k][0], n + len(found), min(found) if not n else min(low, *found), max(found) if not n else max(high, *found))
                else:
                    own[k], odds[k] = (0.0, 0), odds[up]
            for i in want:
                k = units[i].node
                up = max(nodes[k].parent, 0)
                over = max(nodes[up].parent, 0)
                d, o, w, z = nodes[k], odds[k], own[k], own[up]
                before, after = units[i - 1].node if i else -1, units[i + 1].node if i + 1 < len(units) else -1
                node.append((
                    d.depth, flags[k], meets[k], v.first[k], v.end[k], v.first[up], v.end[up], v.first[over], v.end[over], o[0] / max(o[1], 1), o[2], o[3], (w[0] + z[0]) / max(w[1] + z[1], 1), _TAG_NO.get(d.tag, -1),
                    k == v.container, up == v.container, before >= 0 and nodes[before].tag[:1] == "h", after == k, before == k, units[i].in_head, len(units[i].pieces), *text(units[i].text),
                ))
            pick.extend([u0 + i for i in want])
            of_page.extend([len(page)] * len(want))
            page.append((u0, len(units), v.page.closed, v.headline))
        if not pick:
            return np.zeros((0, 1))
        u, w, p = np.array(unit, float), np.array(node, float), np.array(page, np.int64)
        at, of = np.array(pick), np.array(of_page)
        begin, count, closed, headline = p[of].T
        link = u[:, 2] / np.maximum(u[:, 1], 1)
        u[:, 2] = np.minimum(u[:, 2], u[:, 1])
        sums = _accumulated(u)  # words, characters, linked, dots, shut
        here = u[at]

        def stats(c: int) -> list[np.ndarray]:
            i, j = w[:, c].astype(int) + begin, w[:, c + 1].astype(int) + begin
            i = np.minimum(i, j)
            s, m = sums[j] - sums[i], np.maximum(j - i, 1)
            return [j - i, s[:, 0] / m, s[:, 2] / np.maximum(s[:, 1], 1), s[:, 3] / m, s[:, 4] / m, np.log1p(s[:, 0])]

        local = at - begin
        dist = np.where(headline >= 0, np.clip(local - headline, -20, 40), -30)
        start, end = local == 0, local == count - 1
        to, on = np.where(start, at, at - 1), np.where(end, at, at + 1)
        prev, nxt = u[to], u[on]
        bits = w[:, 1].astype(int)
        columns = [
            here[:, 0], here[:, 1], link[at], here[:, 3], here[:, 4], *w[:, 21:26].T, w[:, 19], w[:, 20],
            w[:, 0], local / count, count, local == headline, dist, w[:, 2], w[:, 14], w[:, 15], end & (closed == 0), closed,
            *stats(3), *stats(5), *stats(7), *((w[:, 13] == i) for i in range(len(_TAGS))), *((bits & f) > 0 for f in _FLAG.values()),
            w[:, 9], w[:, 10], w[:, 11], w[:, 12], *w[:, 26:29].T,
            np.where(start, 0, prev[:, 0]), np.where(end, 0, nxt[:, 0]), np.where(start, 0, link[to]), np.where(end, 0, link[on]), np.where(start, 0, prev[:, 3]), np.where(end, 0, nxt[:, 3]), w[:, 16], w[:, 17], w[:, 18],
        ]
        return np.column_stack(columns).astype(float)

    def choose_headlines(self, views: list[View]) -> None:
        """Give pages without a unit that agrees with the title the likeliest headline, if it is likely enough."""
        left = [v for v in views if v.headline < 0 and len(self.headlines.split)]
        wanted = [[i for i, u in enumerate(v.page.units) if u.pieces and not u.in_head] for v in left]
        p = self.headlines.probabilities(self.features(left, wanted)) if any(wanted) else np.zeros(0)
        at = 0
        for v, want in zip(left, wanted):
            mine = p[at : at + len(want)]
            at += len(want)
            if len(want) and mine.max() >= self.least_headline:
                place_headline(v, want[int(mine.argmax())])

    def kept(self, v: View, found: np.ndarray) -> list[bool]:
        """Which units are the article, decoded over the tree; ``found`` are the candidates' probabilities."""
        units, nodes, first, end = v.page.units, v.page.nodes, v.first, v.end
        if not units:
            return []
        p = np.full(len(units), 1e-4)
        p[v.headline : v.headline + len(found)] = np.clip(found, 1e-4, 1 - 1e-4)
        keep_cost, drop_cost = (-np.log(p)).tolist(), (-np.log(1 - p)).tolist()
        keep_to, drop_to = list(accumulate(keep_cost, initial=0.0)), list(accumulate(drop_cost, initial=0.0))
        mixed = [self.mixed_cost] * len(nodes)
        for u, a, b in zip(units, keep_cost, drop_cost):
            mixed[u.node] += a if a < b else b
        say = [0] * len(nodes)  # 0 drop, 1 keep, 2 mixed
        for k in range(len(nodes) - 1, -1, -1):  # children come after their parents
            i, j = first[k], end[k]
            if j <= i:
                continue
            keep, drop = keep_to[j] - keep_to[i], drop_to[j] - drop_to[i]
            best = min(keep, drop, mixed[k])
            say[k] = 1 if best == keep else 0 if best == drop else 2
            if k:
                mixed[nodes[k].parent] += best
        # what an element says holds below it unless it is mixed
        for k in range(1, len(nodes)):
            if say[nodes[k].parent] != 2:
                say[k] = say[nodes[k].parent]
        return [not u.in_head and (say[u.node] == 1 or (say[u.node] == 2 and a < b)) for u, a, b in zip(units, keep_cost, drop_cost)]

    def decoded_pages(self, texts: list[str]) -> list[tuple[View, list[bool]] | None]:
        """View and kept units of each page, none for what is no page with a headline; one run of the trees for all.

        Pages are many small objects without cycles, so the collector of cycles rests meanwhile.
        """
        on = gc.isenabled()
        gc.disable()
        try:
            return self._decoded_pages(texts)
        finally:
            if on:
                gc.enable()

    def _decoded_pages(self, texts: list[str]) -> list[tuple[View, list[bool]] | None]:
        views = [view(parse(t)) if t and is_html(t) else None for t in texts]
        self.choose_headlines([v for v in views if v])
        views = [v if v and v.headline >= 0 else None for v in views]
        found = [v for v in views if v]
        p = self.trees.probabilities(self.features(found, [v.candidates() for v in found])) if found else np.zeros(0)
        out, at = [], 0
        for v in views:
            if v is None:
                out.append(None)
                continue
            n = len(v.candidates())
            out.append((v, self.kept(v, p[at : at + n])))
            at += n
        return out

    def articles(self, texts: list[str]) -> list[list[int]]:
        """Numbers of the pieces of each page's article; none for a page without one or a text that is no HTML."""
        return [[n for u, k in zip(d[0].page.units, d[1]) if k for n in u.pieces] if d and d[1][d[0].headline] else [] for d in self.decoded_pages(texts)]

    def article(self, text: str) -> list[int]:
        return self.articles([text])[0]


def _cell(v: View, u) -> bool:
    """A cell of a table around which there is a headline's element; its words may recur anywhere."""
    return v.page.nodes[u.node].tag in ("td", "th") and u.node != v.container and v.container in _up(v, u.node)


def _up(v: View, k: int) -> list[int]:
    out = []
    while k >= 0:
        out.append(k)
        k = v.page.nodes[k].parent
    return out


def weak_labels(v: View, frame: set[str]) -> list[int]:
    """1 article, 0 frame for each candidate; see the module's text.  A page whose headline doesn't agree with its title has no article here."""
    nodes, units = v.page.nodes, v.page.units
    if not v.titled:
        return [0] * len(v.candidates())
    shut_from: dict[int, int] = {}
    for i in v.candidates():
        u = units[i]
        if i > v.headline and nodes[u.node].tag in ("h1", "h2", "h3", "h4", "h5", "h6") and letters(u.text) in frame:
            scope = nodes[u.node].parent if u.node != v.container else v.container
            shut_from.setdefault(max(scope, 0), i)
    out = []
    for i in v.candidates():
        u = units[i]
        k, dead = u.node, u.in_head or not u.pieces and not u.text
        while k >= 0 and not dead:
            dead = k in shut_from and i >= shut_from[k]
            k = nodes[k].parent
        t, tag = u.text, nodes[u.node].tag
        if dead or (letters(t) in frame and not _cell(v, u)) or u.linked > 0.8 * len(t) or t.endswith(("…", "...")) or tag == "button":
            out.append(0)
            continue
        n, own = len(t.split()), u.node != v.container
        part = own and tag in ("li", "td", "th", "blockquote", "h2", "h3", "h4", "h5")
        sentence = n >= 4 and _SHUT.search(t) and not re.search(r"\(\d+\)\s*$", t[:-1] if n < 7 else "")
        broken_off = i == len(units) - 1 and not v.page.closed and n >= 3
        out.append(int(bool(i == v.headline or part or sentence or broken_off)))
    return out


def _boost(x: np.ndarray, y: np.ndarray, trees: int, depth: int, rate: float, bins: int = 48, l2: float = 1.0, least: int = 20):
    """Trees of logistic loss by histograms, the larger child's being its parent's less the smaller one's; each tree is complete with ``split < 0`` where it ends."""
    n, f = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(f)]
    code = np.stack([np.searchsorted(e, x[:, j]) for j, e in enumerate(edges)], 1)
    base = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    z = np.full(n, base)
    size = 2 ** (depth + 1) - 1
    splits, cuts, leaves = [], [], []
    flat = code + np.arange(f) * bins
    for _ in range(trees):
        p = 1 / (1 + np.exp(-z))
        g, h = y - p, p * (1 - p)
        split, cut, leaf, at = np.full(size, -1), np.zeros(size), np.zeros(size), np.zeros(n, int)

        def histogram(rows: np.ndarray) -> np.ndarray:
            hit = flat[rows].ravel()
            return np.stack([np.bincount(hit, np.repeat(g[rows], f), f * bins), np.bincount(hit, np.repeat(h[rows], f), f * bins), np.bincount(hit, minlength=f * bins)]).reshape(3, f, bins)

        live = {0: (np.arange(n), histogram(np.arange(n)))}
        for level in range(depth + 1):
            nxt = {}
            for node, (rows, sums) in live.items():
                sg, sh = g[rows].sum(), h[rows].sum()
                leaf[node] = rate * sg / (sh + l2)
                if level == depth or len(rows) < 2 * least:
                    continue
                hg, hh, hc = sums.cumsum(2)
                gain = hg**2 / (hh + l2) + (sg - hg) ** 2 / (sh - hh + l2) - sg**2 / (sh + l2)
                gain[(hc < least) | (len(rows) - hc < least)] = -1
                j, b = np.unravel_index(gain.argmax(), gain.shape)
                if gain[j, b] <= 1e-3 or b >= len(edges[j]):
                    continue
                split[node], cut[node], leaf[node] = j, edges[j][b], 0
                right = code[rows, j] > b
                sides = [rows[~right], rows[right]]
                if level + 1 < depth:
                    few = int(len(sides[1]) < len(sides[0]))
                    small = histogram(sides[few])
                    both = [sums - small, small] if few else [small, sums - small]
                else:
                    both = [None, None]
                nxt[2 * node + 1], nxt[2 * node + 2] = zip(sides, both)
            for node, (rows, _) in live.items():
                if split[node] < 0:
                    at[rows] = node
            live = nxt
        z = z + leaf[at]
        splits.append(split)
        cuts.append(cut)
        leaves.append(leaf)
    return np.array(splits), np.array(cuts), np.array(leaves), base


def _token_odds(good: Counter, bad: Counter, least: int) -> dict:
    a, b = sum(good.values()) + 1, sum(bad.values()) + 1
    return {t: float(np.clip(np.log(((good[t] + 0.5) / a) / ((bad[t] + 0.5) / b)), -3, 3)) for t in {*good, *bad} if good[t] + bad[t] >= least}


def _views(texts: list[str]) -> list[View]:
    return [view(parse(t)) for t in texts if t and is_html(t)]


#: What lies between two pieces of a page, and a page's title; enough to count recurring texts without a tree.
_BETWEEN = re.compile(r"<!--.*?(?:-->|\Z)|<(?:script|style)\b.*?(?:</(?:script|style)\s*>|\Z)|<[^<>]*(?:>|\Z)", re.S | re.I)
_TITLE = re.compile(r"<title[^<>]*>([^<]*)", re.I)


def _title_key(text: str) -> str:
    m = _TITLE.search(text)
    return letters(plain(m[1]))[:40] if m else ""


_NO_LETTERS = re.compile(r"[^\w\x1e]+|[\d_]+")


def _pieces_as_letters(text: str) -> set[str]:
    """What is left of the texts between tags of a page if only letters count."""
    t = _BETWEEN.sub("\x1e", text.lower())
    return set(_NO_LETTERS.sub("", html.unescape(t).lower() if "&" in t else t).split("\x1e"))


def _recurring(text: str) -> set[str]:
    """The texts of a page whose recurrence on other pages is counted."""
    return {key for key in _pieces_as_letters(text) if len(key) >= 4}


def _frame(views: list[View], often: set[str]) -> set[str]:
    """What recurs, and the units of several pieces all of which recur (but for those of a few letters)."""
    out = set(often)
    for v in views:
        for u in v.page.units:
            keys = [letters(x) for x in u.parts] if len(u.parts) > 1 else ()
            if any(k in often for k in keys) and all(k in often or len(k) < 4 for k in keys):
                out.add(letters(u.text))
    return out


def often_seen(pages: DataFrame, wanted: set[str], frame_pages: int = 3) -> set[str]:
    """Those texts of ``wanted`` that stand on ``frame_pages`` of all ``pages`` of different titles.

    Pages are only split at tags for this, and only hashes of a text and a title are shuffled, and only of wanted texts.
    """
    import xxhash

    named = {xxhash.xxh3_64_intdigest(k) - (1 << 63): k for k in wanted}
    shared = pages.sparkSession.sparkContext.broadcast(frozenset(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, told = shared.value, set()
        for b in batches:
            new = set()
            for text in dict.fromkeys(decoded(x, k) for x, k in zip(b.column("body").to_pylist(), b.column("content_type").to_pylist())):
                if found := is_html(text) and _pieces_as_letters(text) & wanted:
                    title = xxhash.xxh3_64_intdigest(_title_key(text)) - (1 << 63)
                    new.update((xxhash.xxh3_64_intdigest(k) - (1 << 63), title) for k in found)
            new -= told
            told = (told if len(told) < 1_000_000 else set()) | new
            yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in new], pa.int64()), pa.array([t for _, t in new], pa.int64())], names=["key", "title"])

    on = pages.where(F.octet_length("body") > 0).select("content_type", "body").mapInArrow(run, "key bigint, title bigint").distinct().groupBy("key").agg(F.count("*").alias("n"))
    return {named[r.key] for r in on.where(F.col("n") >= frame_pages).select("key").collect()}


def fit(texts: list[str], trees: int = 40, depth: int = 4, rate: float = 0.25, frame_pages: int = 3) -> ArticleModel:
    """Fit to sample pages; a text that stands on ``frame_pages`` pages of different titles is frame."""
    on: dict[str, set] = defaultdict(set)
    good = [t for t in texts if t and is_html(t)]
    for t in good:
        for key in _recurring(t):
            on[key].add(_title_key(t))
    return fit_views(_views(good), {k for k, s in on.items() if len(s) >= frame_pages}, trees, depth, rate)


def fit_views(views: list[View], often: set[str], trees: int = 40, depth: int = 4, rate: float = 0.25, headline_trees: int = 12, most_units: int = 20_000) -> ArticleModel:
    """Fit to sample pages; ``often`` holds their texts that recur.  Headlines are learned from all of theirs and at most about ``most_units`` other units."""
    # the headline and the cells of a table may say what others say
    own = {letters(v.page.units[v.headline].text) for v in views if v.titled}
    frame = _frame(views, often - own)
    labels = [weak_labels(v, frame) for v in views]
    good_n, bad_n, good_w, bad_w = Counter(), Counter(), Counter(), Counter()
    for v, y in zip(views, labels):
        yes = {i for i, l in zip(v.candidates(), y) if l}
        for i, u in enumerate(v.page.units):
            k, names = u.node, set()
            while k > 0:
                names.update(v.page.nodes[k].names)
                k = v.page.nodes[k].parent
            (good_n if i in yes else bad_n).update(names)
            low = [w.lower() for w in _LETTERS.findall(u.text)]
            (good_w if i in yes else bad_w).update({*low, ("^", *low[:2])})
    model = ArticleModel(_token_odds(good_n, bad_n, 5), _token_odds(good_w, bad_w, 5))
    titled = [v for v in views if v.titled]
    if not any(any(y) for y in labels):
        return model
    # where headlines stand and what they look like, as if no title had told
    blind = [View(v.page, -1, -1, v.first, v.end, False) for v in titled]
    every = max(1, -(-sum(len(v.page.units) for v in blind) // most_units))
    wanted = [[i for i, u in enumerate(v.page.units) if u.pieces and not u.in_head and (i == t.headline or (i + n) % every == 0)] for n, (v, t) in enumerate(zip(blind, titled))]
    y = np.array([float(i == v.headline) for v, want in zip(titled, wanted) for i in want])
    model.headlines = Trees(*_boost(model.features(blind, wanted), y, headline_trees, depth, rate))
    model.choose_headlines(views)
    found = [v for v in views if v.headline >= 0]
    x = model.features(found, [v.candidates() for v in found])
    y = np.array([l for v in found for l in weak_labels(v, frame)], float)
    model.trees = Trees(*_boost(x, y, trees, depth, rate))
    return model


def captures(warc: DataFrame, fetches: DataFrame) -> DataFrame:
    """``capture_id, url, content_type, body`` of all captures that may hold a page: answered with 200 (or unstated).  No body is read to tell that."""
    w = warc.select(
        "capture_id", F.col("target_url").alias("url"), F.element_at("http_headers", "content-type").alias("content_type"), "body",
        (F.coalesce("http_status", F.lit(200)) == 200) & F.coalesce(F.col("warc_type") == "response", F.lit(True)),
    ).toDF("capture_id", "url", "content_type", "body", "good")
    p = fetches.select("capture_id", "url", "content_type", F.coalesce("content", "html_bytes").alias("body"), F.coalesce("status_code", F.lit(200)) == 200).toDF("capture_id", "url", "content_type", "body", "good")
    return w.unionByName(p).where(F.col("good") & F.col("capture_id").isNotNull()).drop("good")


def fit_to(pages: DataFrame, most_pages: int = 2000, most_page_bytes: int = 200_000) -> ArticleModel:
    """Fit to the ``most_pages`` captures of at most ``most_page_bytes`` with the least hash of their id; what is frame on them is counted over all captures.

    Bounds hold for the sample that trains, of at most their product in bytes; every page is counted and every page gets its article.
    """
    sample = hash_sample(pages.where(F.octet_length("body") <= most_page_bytes), "capture_id", most_pages, pages.select("capture_id")).select("body", "content_type").collect()
    good = [t for t in (decoded(bytes(r.body), r.content_type) for r in sample) if t and is_html(t)]
    wanted = set().union(*map(_recurring, good))
    return fit_views(_views(good), often_seen(pages, wanted))


def article_pieces(pages: DataFrame, model: ArticleModel) -> DataFrame:
    """``capture_id, piece_no`` of the pieces that belong to a capture's article.

    ``pages`` needs ``capture_id, content_type, body``.  Pieces are numbered from 0 over the whole page; bodies that are no HTML, error
    pages and pages without an article have none; rows delivered again give their pieces once; pages are read whole.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            ids, out, at = [], [], 0
            captures = b.column("capture_id").to_pylist()
            once: dict[str, list] = {}
            for i, x, k in zip(captures, b.column("body").to_pylist(), b.column("content_type").to_pylist()):
                once.setdefault(decoded(x, k), []).append(i)
            same = list(once.values())
            for part in pieces(list(once)):
                for equal, found in zip(same[at : at + len(part)], m.articles(part)):
                    for i in equal:
                        ids.extend([i] * len(found))
                        out.extend(found)
                at += len(part)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.int64())], names=["capture_id", "piece_no"])

    rows = pages.where(F.octet_length("body") > 0).select(F.col("capture_id").cast("long").alias("capture_id"), "content_type", "body")
    return rows.mapInArrow(run, "capture_id bigint, piece_no bigint").distinct()


def article_texts(pages: DataFrame, model: ArticleModel) -> DataFrame:
    """``capture_id, url, title, text``: the article's units, one a line; an empty text where there is no article."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            titles, texts = [], []
            for part in pieces([decoded(x, k) for x, k in zip(b.column("body").to_pylist(), b.column("content_type").to_pylist())]):
                for d in m.decoded_pages(part):
                    titles.append(d[0].page.units[d[0].headline].text if d else "")
                    texts.append("\n".join(u.text for u, k in zip(d[0].page.units, d[1]) if k) if d and d[1][d[0].headline] else "")
            yield pa.RecordBatch.from_arrays([b.column("capture_id"), b.column("url"), pa.array(titles, pa.string()), pa.array(texts, pa.string())], names=["capture_id", "url", "title", "text"])

    rows = pages.select(F.col("capture_id").cast("long").alias("capture_id"), "url", "content_type", "body")
    return rows.mapInArrow(run, "capture_id bigint, url string, title string, text string").dropDuplicates(["capture_id"])
