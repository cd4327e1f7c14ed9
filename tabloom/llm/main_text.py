"""Main text of web pages: boosted trees over the nodes of the page's tree, and a joint choice for all nodes.

Each element gets features of its subtree (density of text, links, tags), its attribute tokens, depth
and siblings. Two ensembles give the chance that the subtree holds main text and that the node itself
is main text; a dynamic program over the tree then picks states that don't contradict each other.
Trees are fitted on a bounded sample of pages whose own landmarks tell the main part; half of the
copies hide names and attributes, so pages without landmarks are judged by their shape.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.bpe import _arrow
from tabloom.llm.common import batch, text_of

#: Pages to fit on, at most; those longer than that don't serve for fitting.
SAMPLE, LONGEST = 250, 100_000
TREES, DEPTH, RATE, BINS = 24, 3, 0.4, 32

# Element classes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NO_TEXT = frozenset("head title script style template noscript svg math iframe object canvas select button textarea datalist audio video".split())
INLINE = frozenset("a abbr b bdi bdo cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
HOLDS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
TAGS = {t: i for i, t in enumerate("article main section div p h1 h2 h3 h4 h5 h6 ul ol li a nav footer header aside form table tr td blockquote pre figure span b i em strong br body html img input label dl dt dd".split())}
ROOTS = frozenset(("article", "main"))
APART = frozenset("nav footer aside form menu dialog".split())
GOOD_TOKENS = frozenset("article articlebody main content post entry story body text".split())
BAD_TOKENS = frozenset(
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments cookie consent copyright disclaimer footer header login masthead menu modal nav navbar navigation "
    "newsletter notice pagination pager popup promo recommended related respond share sharing sidebar signup social sponsor sponsored subscribe tags toolbar widget reply replies".split()
)
HASHED = 24
_SPLIT = re.compile(r"[a-z0-9]+")
_SENTENCE = re.compile(r"[.!?](?:\s|$)")


class Page(HTMLParser):
    """The elements of a page in order, and its pieces of text with the element each lies in."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.tokens = ["#page"], [-1], [()]
        self.pieces: list[tuple[int, str | None]] = []  # None parts blocks
        self.open = [0]
        self.feed(html)
        self.close()

    def _pop_to(self, names: tuple[str, ...], stop: tuple[str, ...]) -> None:
        for depth in range(len(self.open) - 1, 0, -1):
            tag = self.tag[self.open[depth]]
            if tag in names:
                del self.open[depth:]
                return
            if tag in stop:
                return

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_P:
            self._pop_to(("p",), ("table", "td", "th", "button", "object", "li", "blockquote"))
        if tag in SAME:
            self._pop_to(SAME[tag], HOLDS[tag])
        words = [w for k, v in attrs if k in ("class", "id", "role", "itemprop", "aria-label") and v for w in _SPLIT.findall(v.lower())]
        self.parent.append(self.open[-1])
        self.tag.append(tag)
        self.tokens.append(tuple(words))
        if tag not in INLINE:
            self.pieces.append((self.open[-1], None))
        if tag not in VOID:
            self.open.append(len(self.tag) - 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag in VOID:
            return
        for depth in range(len(self.open) - 1, 0, -1):
            if self.tag[self.open[depth]] == tag:
                del self.open[depth:]
                break
        if tag not in INLINE:
            self.pieces.append((self.open[-1], None))

    def handle_data(self, data):
        self.pieces.append((self.open[-1], data))

    def unknown_decl(self, data):
        pass

    def parse_marked_section(self, i, report=1):  # odd <![...]> sections are skipped to the next ">"
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else len(self.rawdata)


def silent(page: Page) -> np.ndarray:
    """Nodes within elements that never show text."""
    out = np.zeros(len(page.tag), bool)
    for i in range(1, len(page.tag)):
        out[i] = out[page.parent[i]] or page.tag[i] in NO_TEXT
    return out


def node_features(page: Page, hide: np.ndarray | None = None) -> np.ndarray:
    """One row for each node; ``hide`` marks nodes whose name and attributes are left out."""
    n = len(page.tag)
    parent = page.parent
    quiet = silent(page)
    own, marks, sentences = np.zeros(n), np.zeros(n), np.zeros(n)
    for i, data in page.pieces:
        if data and not quiet[i]:
            own[i] += len(data.strip())
            sentences[i] += len(_SENTENCE.findall(data))
            marks[i] += data.count(",")
    chars, tags, links, ends, commas = own.copy(), np.ones(n), np.zeros(n), sentences.copy(), marks.copy()
    depth, rank, siblings, height = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    for i in range(n - 1, 0, -1):
        if page.tag[i] == "a":
            links[i] = chars[i]
        p = parent[i]
        chars[p] += chars[i]
        tags[p] += tags[i]
        links[p] += links[i]
        ends[p] += ends[i]
        commas[p] += commas[i]
        height[p] = max(height[p], height[i] + 1)
    largest = np.zeros(n)
    for i in range(1, n):
        p = parent[i]
        depth[i] = depth[p] + 1
        rank[i] = siblings[p]
        siblings[p] += 1
        largest[p] = max(largest[p], chars[i])
    up = np.array([max(0, p) for p in parent])
    total = max(1.0, chars[0])
    shape = [
        depth, height, np.log1p(chars), chars / total, np.log1p(own), chars / tags, links / np.maximum(1, chars), np.log1p(tags), np.log1p(ends),
        ends / np.maximum(1, chars) * 100, commas / np.maximum(1, chars) * 100, rank, siblings[up], rank / np.maximum(1, siblings[up] - 1),
        chars / np.maximum(1, chars[up]), chars / np.maximum(1, largest[up]), np.log1p(chars[up]), links[up] / np.maximum(1, chars[up]), (chars == 0).astype(float),
    ]
    named = np.zeros((n, 3 + 3 * 1 + HASHED))
    for i in range(n):
        if hide is not None and hide[i]:
            named[i, :2] = -1
            continue
        words = page.tokens[i]
        named[i, 0] = TAGS.get(page.tag[i], len(TAGS))
        named[i, 1] = TAGS.get(page.tag[up[i]], len(TAGS))
        named[i, 2] = len(words)
        named[i, 3] = sum(w in GOOD_TOKENS for w in words) + (page.tag[i] in ROOTS)
        named[i, 4] = sum(w in BAD_TOKENS for w in words) + (page.tag[i] in APART)
        for w in words:
            named[i, 6 + sum(map(ord, w)) % HASHED] = 1
    # Good and bad names above a node, counted down the tree.
    above = np.zeros((n, 2))
    for i in range(1, n):
        above[i] = above[parent[i]] + named[i, 3:5]
    return np.column_stack([*shape, named, above])


def landmarks(page: Page) -> tuple[np.ndarray, np.ndarray] | None:
    """(holds main text, is main text) of every node as the page's own names tell; None without a landmark."""
    n = len(page.tag)
    roots = [i for i in range(1, n) if page.tag[i] in ROOTS or "articlebody" in page.tokens[i]]
    if not roots:
        return None
    quiet, inside = silent(page), np.zeros(n, bool)
    for i in range(1, n):
        bad = page.tag[i] in APART or (page.tag[i] not in ("body", "html") and any(w in BAD_TOKENS for w in page.tokens[i]))
        inside[i] = (inside[page.parent[i]] or i in roots) and not bad and not quiet[i]
    holds = inside.copy()
    for i in range(n - 1, 0, -1):
        holds[page.parent[i]] |= holds[i]
    return holds, inside


@dataclass
class Trees:
    """A boosted ensemble of full binary trees: split features, thresholds and leaf values."""

    first: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def chance(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.first)
        rows = np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            score += leaf[at - (2**DEPTH - 1)]
        return 1 / (1 + np.exp(-np.clip(score, -20, 20)))


def boost(x: np.ndarray, y: np.ndarray) -> Trees:
    """Gradient boosting of the logistic loss over binned features, by second-order gains."""
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in x.T]
    binned = np.column_stack([np.searchsorted(c, column, side="left") for c, column in zip(cuts, x.T, strict=True)])
    base = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    first = float(np.log(base / (1 - base)))
    score, inner = np.full(len(y), first), 2**DEPTH - 1
    features, thresholds, leaves = [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        feature, threshold, at = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(len(y), np.int64)
        for node in range(inner):
            rows = np.flatnonzero(at == node)
            best = (1e-6, 0, np.inf, -1)
            if len(rows) > 20:
                total_g, total_h = g[rows].sum(), h[rows].sum()
                for f, cut in enumerate(cuts):
                    if len(cut) == 0:
                        continue
                    b = binned[rows, f]
                    left_g = np.cumsum(np.bincount(b, g[rows], len(cut) + 1))[:-1]
                    left_h = np.cumsum(np.bincount(b, h[rows], len(cut) + 1))[:-1]
                    gain = left_g**2 / (left_h + 1) + (total_g - left_g) ** 2 / (total_h - left_h + 1) - total_g**2 / (total_h + 1)
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (float(gain[k]), f, float(cut[k]), k)
            _, feature[node], threshold[node], k = best
            right = binned[rows, feature[node]] > k if k >= 0 else np.zeros(len(rows), bool)
            at[rows] = 2 * node + 1 + right
        leaf_of = at - inner
        leaf = -RATE * np.bincount(leaf_of, g, inner + 1) / (np.bincount(leaf_of, h, inner + 1) + 1)
        score += leaf[leaf_of]
        features.append(feature)
        thresholds.append(threshold)
        leaves.append(leaf)
    return Trees(first, np.array(features), np.array(thresholds), np.array(leaves))


Model = tuple[Trees, Trees]


def _with_asides(html: str, draw: np.random.Generator) -> str:
    """The page with some of its own words in blocks that are named as no part of the article, inside and after it.

    A sample may lack notices or comments; so the names of such blocks are learned all the same.
    """
    words = re.sub(r"<[^>]*>", " ", html[-4000:]).split() or ["word"]
    names = sorted(BAD_TOKENS)

    def block() -> str:
        tag = ("div", "section", "ul", "p")[draw.integers(4)]
        inner = "".join(f"<p>{' '.join(words[: draw.integers(2, 60)])}</p>" for _ in range(draw.integers(1, 4)))
        return f'<{tag} {("class", "id")[draw.integers(2)]}="{names[draw.integers(len(names))]}">{inner if tag != "p" else " ".join(words[:20])}</{tag}>'

    return re.sub(r"(?i)</(article|main)>", lambda m: block() + m[0] + block(), html)


def fit(pages: DataFrame, key: str = "page_id", html: str = "html", sample: int = SAMPLE) -> Model | None:
    """Fit on at most ``sample`` pages with a landmark, chosen by a hash of key and page. None without any."""
    marked = F.col("html").rlike("(?i)<(article|main)[ >]|articleBody") & (F.length("html") <= LONGEST)
    rows = pages.select(text_of(html).alias("html"), F.xxhash64(key, html).alias("_h")).filter(marked)
    draw = np.random.default_rng(0)
    xs, holds, inside = [], [], []
    for row in rows.orderBy("_h", "html").limit(sample).collect():
        page = Page(row["html"])
        truth = landmarks(page)
        if truth is None:
            continue
        views = [(page, truth, hide) for hide in (None, np.full(len(page.tag), True), draw.random(len(page.tag)) < 0.5)]
        other = Page(_with_asides(row["html"], draw))
        if (marked_again := landmarks(other)) is not None:
            views.append((other, marked_again, None))
        for view, (has, main), hide in views:
            show = ~silent(view)
            xs.append(node_features(view, hide)[show])
            holds.append(has[show])
            inside.append(main[show])
    if not xs:
        return None
    x = np.vstack(xs)
    return boost(x, np.concatenate(holds).astype(float)), boost(x, np.concatenate(inside).astype(float))


def decode(parent: list[int], holds: np.ndarray, inside: np.ndarray, quiet: np.ndarray) -> np.ndarray:
    """The likeliest states 0 (no main text), 1 (holds some) and 2 (is main text) of all nodes together.

    Below 0 all is 0, below 2 only 0 and 2 may come, below 1 anything.
    """
    n = len(parent)
    h, c = np.clip(holds, 1e-6, 1 - 1e-6), np.clip(inside, 1e-6, 1 - 1e-6)
    best = np.log(np.column_stack([1 - h, h * (1 - c), h * c]))
    best[quiet, 1:] = -1e9
    best[0, 2] = -1e9
    for i in range(n - 1, 0, -1):
        none, some, main = best[i]
        best[parent[i]] += (none, max(none, some, main), max(none, main))
    state = np.zeros(n, np.int8)
    state[0] = best[0].argmax()
    for i in range(1, n):
        above = state[parent[i]]
        if above == 1:
            state[i] = best[i].argmax()
        elif above == 2:
            state[i] = 2 if best[i, 2] >= best[i, 0] else 0
    return state


def joined_text(page: Page, state: np.ndarray) -> str:
    parts = [" " if data is None else data for i, data in page.pieces if data is None or state[i] == 2]
    return " ".join("".join(parts).split())


def extract(pages: DataFrame, model: Model | None, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``key``, ``url`` and ``text``, the main text of every whole page, blocks joined by one space.

    Null and empty pages, pages without text and, without a model, pages without a landmark give an
    empty text. Repeated rows give equal ones; other columns are not read; an empty table gives none.
    """
    kind = pages.schema[key].dataType.simpleString()
    schema = pa.schema([("key", _arrow(kind)), ("url", pa.string()), ("text", pa.string())])

    def states(some: list[Page]) -> Iterator[np.ndarray]:
        if model is None:
            for page in some:
                truth = landmarks(page)
                yield np.where(truth[1], 2, 0) if truth else np.zeros(len(page.tag), np.int8)
            return
        x = np.vstack([node_features(page) for page in some])
        holds, inside = (trees.chance(x) for trees in model)
        done = 0
        for page in some:
            stop = done + len(page.tag)
            yield decode(page.parent, holds[done:stop], inside[done:stop], silent(page))
            done = stop

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = part.column(2).to_pylist()
            for a in range(0, len(texts), 64):
                some = [Page(t) for t in texts[a : a + 64]]
                out = [joined_text(page, state) for page, state in zip(some, states(some), strict=True)]
                yield batch(schema, part.column(0).slice(a, len(some)).cast(schema.field(0).type), part.column(1).slice(a, len(some)).cast(pa.string()), out)

    rows = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), text_of(html).alias("html"))
    out = rows.mapInArrow(work, f"key {kind}, url string, text string")
    return out.select(F.col("key").alias(key), F.col("url").alias(url), "text")
