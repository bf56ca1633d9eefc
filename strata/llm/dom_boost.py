"""Main-text extraction by gradient-boosted trees over DOM-node features.

Pages are parsed to a tree of block elements with text blocks as leaves. Trees trained here on a bounded sample of
pages give each node the log-odds that its text is content, and hierarchical decoding picks the best labelling in
which a subtree is content, boilerplate or divided among its children - so no descendant contradicts an ancestor.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import bounded_batches, strings

# Elements by their role in HTML.
BLOCK = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
            "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot "
            "th thead tr ul".split())
DROPPED = set("script style title textarea template svg iframe object canvas select audio video noembed noframes".split())
#: Of these, the ones whose content is text alone: only their end tag ends them. The others hold markup, and end with the block about them.
RAW = set("script style title textarea iframe noembed noframes".split())
VOID = set("area base br col embed hr img input link meta source track wbr".split())
CLOSES_P = BLOCK - {"body", "head", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr"}
#: An element that opens ends an open one of these kinds, up to the nearest of the bounds.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"})}
BODY_TAGS = {"article", "main"}
NOISE_TAGS = {"nav", "aside", "footer", "form", "menu", "dialog", "search"}
#: Words of class, id and role attributes.
BODY_WORDS = set("article content entry main post story text body".split())
NOISE_WORDS = set("ad ads advert advertisement banner breadcrumb breadcrumbs byline comment comments consent cookie cookies copyright disqus "
                  "footer form header legal links login masthead menu modal nav navbar navigation newsletter notice notification pager "
                  "pagination popup promo promotion recommended related reply replies respond search share sharing sidebar signup social "
                  "sponsor sponsored subscribe tags toolbar topbar warning widget".split())
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_ATTR = re.compile(r"""(?ai)\b(class|id|role|hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_PIECES = re.compile(r"[a-z]+")

#: Pages learned from, rounds, depth, learning rate and bins of the boosted trees.
SAMPLE, ROUNDS, DEPTH, RATE, BINS = 300, 40, 4, 0.25, 32
#: What dividing a subtree costs, in log-odds.
DIVIDE = 0.5


@dataclass
class Page:
    """Nodes in document order; ``text`` holds a leaf's text, None for an element."""

    parent: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    words: list[frozenset] = field(default_factory=list)
    text: list[str | None] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)

    def add(self, parent: int, tag: str, words: frozenset, text: str | None, linked: int = 0) -> int:
        for x, v in ((self.parent, parent), (self.tag, tag), (self.words, words), (self.text, text), (self.linked, linked)):
            x.append(v)
        return len(self.parent) - 1


def _words(attributes: str) -> frozenset:
    out = set()
    for m in _ATTR.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or name == "style" and re.search(r"display\s*:\s*none", value):
            out.add("hidden")
        elif name != "style":
            out.update(_PIECES.findall(re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "-", m[2] or m[3] or m[4] or "").lower()))
    return frozenset(out)


def parse(html: str) -> Page:
    """The block tree of a page, however it is formed; text that no markup separates is one leaf."""
    page, n, at, stack = Page(), len(html), 0, [(0, "#root")]
    page.add(-1, "#root", frozenset(), None)
    text: list[str] = []
    link, linked = 0, 0
    none = {'"': False, "'": False}  # no such quote from here on

    def flush() -> None:
        nonlocal linked
        if text:
            words = entities.unescape("".join(text)).split()
            if words:
                page.add(stack[-1][0], "#text", frozenset(), " ".join(words), linked)
            text.clear()
        linked = 0

    def tag_end(i: int) -> int:
        """The place of the ``>`` that ends a tag, quoted values skipped."""
        end = html.find(">", i)
        while end >= 0:
            opened = None
            for k, c in ((k, html[k]) for k in range(i, end) if html[k] in "\"'"):
                opened = c if opened is None else None if c == opened else opened
            if opened is None or none[opened]:
                return end
            close = html.find(opened, end)
            if close < 0:
                none[opened] = True
                return end
            later = html.find(">", close)
            if later < 0:
                return end
            i, end = close + 1, later
        return -1

    def about(i: int, stop: int) -> int | None:
        """Where, before ``stop``, an end tag closes the innermost open block, blocks that open from ``i`` on set aside; or None."""
        if len(stack) < 2:
            return None
        tag, depth = stack[-1][1], 0
        for m in re.compile(rf"<(/?){tag}(?=[\s/>])", re.I | re.A).finditer(html, i, stop):
            depth += -1 if m[1] else 1
            if depth < 0:
                return m.start()
        return None

    while at < n:
        i = html.find("<", at)
        if i < 0:
            text.append(html[at:])
            break
        if i > at:
            text.append(html[at:i])
            linked += (i - at) if link else 0
        nxt = html[i + 1:i + 2]
        if nxt in "!?":
            if html.startswith("<!--", i):
                end = html.find("-->", i + 4)
                at = n if end < 0 else end + 3
            else:
                end = html.find(">", i)
                at = n if end < 0 else end + 1
            if not nxt:
                text.append("<")
                at = n
            continue
        m = _TAG.match(html, i)
        if not m:
            text.append("<")
            at = i + 1
            continue
        end = tag_end(m.end())
        if end < 0:
            break
        closing, tag, at = bool(m[1]), m[2].lower(), end + 1
        if tag in DROPPED:
            if not closing and html[end - 1] != "/":
                close = re.compile(rf"</{tag}(?=[\s/>])", re.I | re.A).search(html, at)
                around = None if tag in RAW else about(at, close.start() if close else n)
                if around is not None:  # never closed inside its block: that block's end tag ends it
                    at = around
                    continue
                stop = html.find(">", close.end()) if close else -1
                at = n if stop < 0 else stop + 1
            continue
        if tag not in BLOCK:
            if tag == "a":
                link = 0 if closing else 1
            elif tag == "br":
                text.append(" ")
            continue
        flush()
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][1] == tag:
                    del stack[k:]
                    break
            link = 0
            continue
        if tag in CLOSES_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][1] == "p":
                    del stack[k:]
                    break
                if stack[k][1] in {"div", "td", "th", "li", "section", "article", "main", "body"}:
                    break
        if tag in ENDS:
            kinds, bounds = ENDS[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][1] in bounds:
                    break
                if stack[k][1] in kinds:
                    del stack[k:]
                    break
        node = page.add(stack[-1][0], tag, _words(html[m.end():end]), None)
        if tag not in VOID:
            stack.append((node, tag))
    flush()
    return page


NAMES = ["is_text", "body_tag", "noise_tag", "header_tag", "heading", "paragraph", "item", "body_word", "noise_word", "hidden", "in_body", "in_noise",
         "in_header", "depth", "chars", "link_share", "leaves", "mean_leaf", "elements", "density", "stops", "share", "before", "siblings", "place",
         "sibling_chars", "paragraphs", "headings", "noise_below", "body_below"]


def features(page: Page) -> np.ndarray:
    """A row of ``NAMES`` for each node: its own tag and attribute words, what is above it, the text density of its
    subtree, and its siblings."""
    n = len(page.tag)
    own = {k: [0.0] * n for k in NAMES}
    chars, linked, leaves, elements, stops = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
    kids, before, seen = [0] * n, [0] * n, 0
    for i in range(n):
        p, tag, words = page.parent[i], page.tag[i], page.words[i]
        t = page.text[i]
        before[i] = seen
        if t is not None:
            own["is_text"][i] = 1.0
            chars[i], linked[i], leaves[i] = len(t), min(len(t), page.linked[i]), 1
            stops[i] = sum(map(t.count, ".,;:!?"))
            seen += len(t)
        else:
            elements[i] = 1
        own["body_tag"][i], own["noise_tag"][i], own["header_tag"][i] = tag in BODY_TAGS, tag in NOISE_TAGS, tag == "header"
        own["heading"][i], own["paragraph"][i], own["item"][i] = len(tag) == 2 and tag[0] == "h" and tag[1] in "123456", tag == "p", tag in ("li", "td", "dd")
        own["body_word"][i], own["noise_word"][i], own["hidden"][i] = bool(words & BODY_WORDS), bool(words & NOISE_WORDS), "hidden" in words
        if p >= 0:
            kids[p] += 1
            own["place"][i] = kids[p]
            own["depth"][i] = own["depth"][p] + 1
            own["in_body"][i] = max(own["in_body"][p], own["body_tag"][p], own["body_word"][p])
            own["in_noise"][i] = max(own["in_noise"][p], own["noise_tag"][p], own["noise_word"][p], own["hidden"][p])
            own["in_header"][i] = max(own["in_header"][p], own["header_tag"][p])
    for i in range(n - 1, 0, -1):
        p = page.parent[i]
        for x in (chars, linked, leaves, elements, stops):
            x[p] += x[i]
        own["paragraphs"][p] += own["paragraphs"][i] + own["paragraph"][i]
        own["headings"][p] += own["headings"][i] + own["heading"][i]
        own["noise_below"][p] = max(own["noise_below"][p], own["noise_below"][i], own["noise_word"][i], own["noise_tag"][i])
        own["body_below"][p] = max(own["body_below"][p], own["body_below"][i], own["body_word"][i], own["body_tag"][i])
    total = max(1, chars[0])
    for i in range(n):
        p, c = page.parent[i], chars[i]
        own["chars"][i], own["link_share"][i] = math.log1p(c), linked[i] / c if c else 0.0
        own["leaves"][i], own["mean_leaf"][i] = math.log1p(leaves[i]), math.log1p(c / leaves[i]) if leaves[i] else 0.0
        own["elements"][i], own["density"][i] = math.log1p(elements[i]), math.log1p(c / (1 + elements[i]))
        own["stops"][i], own["share"][i], own["before"][i] = stops[i] / c if c else 0.0, c / total, before[i] / total
        if p >= 0:
            own["siblings"][i], own["place"][i] = math.log1p(kids[p]), own["place"][i] / kids[p]
            own["sibling_chars"][i] = math.log1p((chars[p] - c) / max(1, kids[p] - 1))
    return np.array([own[k] for k in NAMES]).T


@dataclass
class Trees:
    """Boosted regression trees over log-odds; each is arrays of feature, cut, left, right and value."""

    base: float
    trees: list[tuple[np.ndarray, ...]]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, cut, left, right, value in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                inner = left[at] >= 0
                at = np.where(inner, np.where(x[rows, feature[at]] <= cut[at], left[at], right[at]), at)
            out += value[at]
        return out


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Trees:
    """Newton boosting of the logistic loss with histogram splits. One class (or no rows) gives a constant."""
    if not len(y) or y.min() == y.max():
        return Trees(3.0 if not len(y) or y[0] else -3.0, [])
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    share = float(np.clip((y * weight).sum() / weight.sum(), 0.01, 0.99))
    model = Trees(math.log(share / (1 - share)), [])
    score = np.full(len(y), model.base)
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-score))
        grad, hess = (p - y) * weight, np.maximum(p * (1 - p), 1e-6) * weight
        nodes: list[list] = []

        def grow(rows: np.ndarray, depth: int) -> int:
            me, g, h = len(nodes), grad[rows].sum(), hess[rows].sum()
            nodes.append([0, 0.0, -1, -1, -RATE * g / (h + 1.0)])
            best = (1e-3, None)
            if depth < DEPTH and len(rows) > 1:
                for f, c in enumerate(cuts):
                    if not len(c):
                        continue
                    gl = np.cumsum(np.bincount(binned[rows, f], grad[rows], len(c) + 1))[:-1]
                    hl = np.cumsum(np.bincount(binned[rows, f], hess[rows], len(c) + 1))[:-1]
                    gain = np.where((hl > 0.5) & (h - hl > 0.5), gl ** 2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g ** 2 / (h + 1), 0)
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (float(gain[k]), (f, k))
            if best[1]:
                f, k = best[1]
                low = binned[rows, f] <= k
                nodes[me][:4] = [f, float(cuts[f][k]), grow(rows[low], depth + 1), 0]
                nodes[me][3] = grow(rows[~low], depth + 1)
                nodes[me][4] = 0.0
            return me

        grow(np.arange(len(y)), 0)
        tree = tuple(np.array(c) for c in zip(*nodes, strict=True))
        model.trees.append(tree)
        score += Trees(0.0, [tree])(x)
    return model


def decode(page: Page, odds: np.ndarray) -> list[str]:
    """The texts of the leaves that the best consistent labelling calls content, in page order. Each node votes with
    its log-odds; a node is content, boilerplate, or divided among its children, and the first two bind all below."""
    n = len(page.tag)
    total, split = odds.copy(), np.zeros(n)
    leaf = [t is not None for t in page.text]
    best = np.zeros(n)
    for i in range(n - 1, -1, -1):
        best[i] = abs(total[i]) if leaf[i] else max(abs(total[i]), split[i] - DIVIDE)
        p = page.parent[i]
        if p >= 0:
            total[p] += total[i]
            split[p] += best[i]
    state, out = np.zeros(n, np.int8), []  # 1 content, -1 boilerplate, 0 divided
    for i in range(n):
        above = state[page.parent[i]] if i else 0
        if above:
            state[i] = above
        elif leaf[i] or best[i] <= abs(total[i]):
            state[i] = 1 if total[i] >= 0 else -1
        if leaf[i] and state[i] == 1:
            out.append(page.text[i])
    return out


def labels(page: Page) -> list[float]:
    """The share of each node's text that is content, as far as elements tell it: inside the article or main
    element where the page has one, and not inside noise."""
    n, has = len(page.tag), any(t in BODY_TAGS for t in page.tag)
    inside, noise = [False] * n, [False] * n
    chars, content = [0] * n, [0] * n
    for i in range(n):
        p, tag = page.parent[i], page.tag[i]
        inside[i] = p >= 0 and inside[p] or tag in BODY_TAGS
        noise[i] = p >= 0 and noise[p] or tag in NOISE_TAGS or tag == "header" and not inside[i] \
            or bool(page.words[i] & NOISE_WORDS) and tag not in BODY_TAGS or "hidden" in page.words[i]
        if page.text[i] is not None:
            chars[i] = len(page.text[i])
            content[i] = chars[i] if (inside[i] or not has) and not noise[i] else 0
    for i in range(n - 1, 0, -1):
        chars[page.parent[i]] += chars[i]
        content[page.parent[i]] += content[i]
    return [c / m if m else -1.0 for c, m in zip(content, chars, strict=True)]


def variants(html: str, rnd: random.Random) -> Iterator[tuple[str, bool]]:
    """The page itself, and the page with boilerplate of other kinds and with plain elements in place of telling
    ones, so that the trees learn from density, words and place as well as from tags. The flag says that
    ``labels`` must be taken before the plain elements."""
    text = " ".join(x for x in parse(html).text if x)
    cut = lambda k: entities.escape(" ".join(rnd.choices(text.split() or ["x"], k=k)))
    blocks = ['<div class="cookie-notice"><p>{a}</p></div>', '<aside class="sidebar"><h3>{b}</h3><ul><li><a href="/">{b}</a></li><li><a href="/">{b}</a></li></ul></aside>',
              '<header class="site-header"><p>{b}</p></header>', '<form action="/s"><label>{b}</label><input name="q"><p>{b}</p></form>',
              '<section id="comments"><h2>{b}</h2><div class="comment"><p>{a}</p><p>{a}</p></div></section>', '<div class="related"><ul><li>{b}</li><li>{b}</li></ul></div>',
              '<div class="advert"><p>{a}</p></div>', '<div role="navigation"><a href="/">{b}</a> <a href="/">{b}</a></div>', '<div id="share-links"><p>{b}</p></div>']
    yield html, False
    more = html
    for place in ("<article", "</article>", "<footer"):
        for b in rnd.sample(blocks, 2):
            added = b.replace("{a}", cut(rnd.randint(8, 80))).replace("{b}", cut(rnd.randint(1, 5)))
            k = more.find(place)
            if k >= 0:
                k += 0 if place[1] != "/" else len(place) if rnd.random() < 0.7 else 0
                more = more[:k] + added + more[k:]
    yield more, False
    yield more, True


_PLAIN = {"article": ["post-content", "entry", "story", ""], "main": ["content", ""], "nav": ["menu", "navbar", ""], "footer": ["footer", "site-footer", ""],
          "aside": ["sidebar", "widget"], "header": ["header", "masthead"], "form": ["search-form"]}


def _plain(html: str, rnd: random.Random) -> str:
    for tag, names in _PLAIN.items():
        name = rnd.choice(names)
        html = re.sub(rf"<{tag}\b", f'<div class="{name}"' if name else "<div", html).replace(f"</{tag}>", "</div>")
    return html


def examples(html: str, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows and labels of a page and its variants; nodes that hold both kinds of text are left out."""
    rnd, xs, ys = random.Random(seed), [], []
    for own, plain in variants(html, rnd):
        page = parse(own)
        y = np.array(labels(page))
        if plain:  # the same nodes in the same order
            page = parse(_plain(own, rnd))
            if len(page.tag) != len(y):
                continue
        clear = (y >= 0.95) | ((y >= 0) & (y <= 0.05))
        xs.append(features(page)[clear])
        ys.append(y[clear] > 0.5)
    return np.concatenate(xs), np.concatenate(ys)


def train(spark: SparkSession, pages: DataFrame, sample: int = SAMPLE) -> Trees:
    """Trees from ``sample`` pages of ``pages(page_id, url, html)``, chosen by hash; their features are made on the
    executors. Without pages the trees call everything content."""
    chosen = (pages.filter(F.col("html").isNotNull()).select(F.col("html").cast("string").alias("html"), F.xxhash64("page_id", "url", "html").alias("hash"))
              .orderBy("hash").limit(sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text, h in zip(strings(b.column(0)), b.column(1).to_pylist(), strict=True):
                x, y = examples(text, h)
                yield pa.RecordBatch.from_arrays([pa.array([h]), pa.array([x.astype(np.float32).tobytes()]), pa.array([y.astype(np.uint8).tobytes()])], ["h", "x", "y"])

    got = sorted(chosen.repartition(8).mapInArrow(run, "h long, x binary, y binary").collect(), key=lambda r: (r["h"], bytes(r["x"])))
    xs = [np.frombuffer(r["x"], np.float32).reshape(-1, len(NAMES)) for r in got]
    ys = [np.frombuffer(r["y"], np.uint8) for r in got]
    if not got:
        return fit(np.empty((0, len(NAMES))), np.empty(0), np.empty(0))
    weight = np.concatenate([np.full(len(y), 1 / max(1, len(y))) for y in ys])
    y = np.concatenate(ys).astype(float)
    return fit(np.concatenate(xs).astype(float), y, weight * len(y) / weight.sum())


def extract(spark: SparkSession, pages: DataFrame, model: Trees) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for each row of ``pages(page_id, url, html)``: the content blocks in page
    order, joined by newlines, white space inside a block as one space.

    Null and empty pages, and pages without content, give an empty text. Null ids and urls stay; repeated rows are
    extracted each; broken markup is read as far as it goes; an empty table gives no rows; other columns are not
    read."""
    bounded_batches(spark)
    own = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                trees = [parse(h) for h in strings(part.column(2))]
                rows = [features(t) for t in trees]
                odds = own.value(np.concatenate(rows))
                ends = np.cumsum([len(r) for r in rows])
                texts = ["\n".join(decode(t, o)) for t, o in zip(trees, np.split(odds, ends[:-1]), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                                                 ["page_id", "url", "text", "n_chars"])

    return (pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
            .mapInArrow(run, "page_id long, url string, text string, n_chars long"))
