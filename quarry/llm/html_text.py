"""Main text of web pages by minimum cuts.

A page becomes text blocks (runs of text between block-level tags) in a tree of
elements.  A logistic model scores every block; its log odds are the block's
capacity from the source (content) or to the sink (boilerplate).  Smoothness edges
join neighbours in page order, the stronger the fewer elements lie between
them, and DOM proximity edges join blocks to a node for the element around them
and these nodes to each other upwards.  The maximum flow saturates a minimum cut;
the blocks left on the source's side are the main text.

The model is trained here on weak labels: blocks below ``article`` or ``main``
(or elements named so) against blocks below ``nav``, ``footer``, ``aside``,
``form`` and elements whose class, id or role names such a part.  Each labelled
block is taken twice, with and without the evidence of its landmark, so that
length, links and punctuation get weights of their own and pages without
landmarks are judged too.  The weights are held near ``UNTRAINED``, since the
pages of one table may share a template, and what a block's text says counts
``TEXT_SAYS`` at most.  The model is fitted on at most ``SAMPLE_PAGES`` pages and
``SAMPLE_BLOCKS`` blocks of each (the smallest hashes of id and url).

Defined results: null and empty pages have the empty text; markup that never
ends runs to the end of the page; character references are decoded once, after
the markup is cut out; a page id or url may be null or repeated, each row is
judged by its own page; equal flows leave a block out (the cut nearest the
source); an empty table gives no rows, and a table without landmarks of both
kinds uses ``UNTRAINED``.  Other columns are never read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quarry.llm.runtime import prepare

SAMPLE_PAGES = 2000
SAMPLE_BLOCKS = 40
ADJACENT, AROUND, UPWARDS = 1.0, 0.6, 0.3   # capacities of the smoothness edges
_UNIT = 1000                                # of integer capacities

# -- fixed values: elements and words that tell the parts of a page ------------
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BREAKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table "
    "tbody td tfoot th thead tr ul".split())
_HIDDEN = frozenset("audio button canvas datalist head math noscript object option select svg template video".split())
_RAW = "script|style|textarea|title|xmp|iframe|noembed|noframes"
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
         "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
         "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
         **dict.fromkeys(("tbody", "thead", "tfoot"), ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}))}
_BODY_TAGS = frozenset("article main".split())
_FRAME_TAGS = frozenset("nav footer aside form dialog menu search".split())
_BODY_WORDS = frozenset("article articlebody body content entry main post prose story text".split())
_FRAME_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising alert aside banner bottombar breadcrumb breadcrumbs comment comments "
    "complementary consent contentinfo cookie cookies copyright dialog disclaimer discussion disqus foot footer form gdpr "
    "login masthead menu modal nav navbar navigation newsletter notice notification overlay pager pagination popular popup "
    "promo promoted promotion recommended related replies reply search share sharing sidebar signup skip social sponsor "
    "sponsored subscribe subscription toolbar topbar trending widget".split())
_HEADER_WORDS = frozenset("header head".split())
# ------------------------------------------------------------------------------

_ATTRIBUTES = r"""((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)"""
_MARKUP = re.compile(
    rf"""<!--.*?(?:--!?>|\Z)|<({_RAW})(?=[\s/>]){_ATTRIBUTES}>.*?(?:</\1(?=[\s/>])[^>]*+(?:>|\Z)|\Z)"""
    rf"""|<(/?)([a-zA-Z][^\s/>]*+){_ATTRIBUTES}>|<[a-zA-Z/!?][^>]*+(?:>|\Z)""", re.S | re.I)
_NAMED = re.compile(r"""(?:^|[\s"'/])(class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_WORD = re.compile(r"[a-z]+")
_SENTENCE_END = frozenset(".!?…:;。！？।")

BODY, UNKNOWN, FRAME = 1, 0, -1
_HOPS = 6


def _part(name: str, attributes: str, inside: int) -> int:
    """What an element says of itself and all below it."""
    if inside == FRAME:
        return BODY if name == "main" else FRAME
    if name in _FRAME_TAGS:
        return FRAME
    if name in ("html", "body"):
        return inside
    told = BODY if name in _BODY_TAGS else inside
    if name == "header" and told != BODY:
        return FRAME
    words: set[str] = set()
    if "-" in name:
        words.update(_WORD.findall(name))
    if "=" in attributes:
        for _, value in _NAMED.findall(attributes):
            words.update(_WORD.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", value).lower()))
    if words:
        if words & _FRAME_WORDS or (told != BODY and words & _HEADER_WORDS):
            return FRAME
        if words & _BODY_WORDS:
            return BODY
    return told


class Page:
    """Text blocks of a page: ``texts``, ``links`` (characters in links), ``tags``,
    ``parts``, ``holders`` (element around the block) and the ``parents`` of all
    elements."""

    def __init__(self, html: str):
        self.texts: list[str] = []
        self.links: list[int] = []
        self.tags: list[str] = []
        self.parts: list[int] = []
        self.holders: list[int] = []
        self.parents = [-1]
        self._read(html)

    def _read(self, html: str) -> None:
        stack = [("", 0, UNKNOWN, False)]     # name, element, part, hidden
        opened: dict[str, int] = {}
        pieces: list[str] = []
        linked: list[str] = []
        in_link = False
        parents = self.parents

        def flush() -> None:
            text = " ".join("".join(pieces).split())
            if text:
                name, element, part, _ = stack[-1]
                self.texts.append(text)
                self.links.append(len(" ".join("".join(linked).split())))
                self.tags.append(name)
                self.parts.append(part)
                self.holders.append(element)
            pieces.clear()
            linked.clear()

        def pop() -> None:
            opened[stack.pop()[0]] -= 1

        def take(piece: str) -> None:
            if stack[-1][3]:
                return
            if "&" in piece:
                piece = unescape(piece)
            pieces.append(piece)
            if in_link:
                linked.append(piece)

        at = 0
        for m in _MARKUP.finditer(html):
            if m.start() > at:
                take(html[at:m.start()])
            at = m.end()
            name = m[4]
            if name is None:
                continue
            name = name.lower()
            if m[3]:                                        # an end tag
                if name == "a":
                    in_link = False
                elif opened.get(name):
                    flush()
                    while stack[-1][0] != name:
                        pop()
                    pop()
                    in_link = False
                elif name in _BREAKS:
                    flush()
                continue
            if name == "br":
                pieces.append(" ")
            elif name == "a":
                in_link = True
            if name in _VOID and name != "hr":
                continue
            if name not in _BREAKS and name not in _HIDDEN and "-" not in name:
                continue
            flush()
            if name == "hr":
                continue
            if name in _BREAKS and opened.get("p") and stack[-1][0] == "p":
                pop()
            if name in _ENDS and any(opened.get(x) for x in _ENDS[name][0]):
                close, stop = _ENDS[name]
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] in stop:
                        break
                    if stack[k][0] in close:
                        while len(stack) > k:
                            pop()
                        # outer ones of the same kind end too (a cell and its row)
            if name == "body":                              # nothing of the head goes on
                while len(stack) > 1 and stack[-1][0] != "html":
                    pop()
            in_link = False
            _, element, part, hidden = stack[-1]
            parents.append(element)
            attributes = m[5] or ""
            if attributes.endswith("/") and "-" in name:
                continue
            stack.append((name, len(parents) - 1, _part(name, attributes, part), hidden or name in _HIDDEN))
            opened[name] = opened.get(name, 0) + 1
        if at < len(html):
            take(html[at:])
        flush()

    def features(self, k: int) -> tuple[float, ...]:
        text, tag = self.texts[k], self.tags[k]
        n = len(text)
        return (1.0, self.parts[k] == BODY, self.parts[k] == FRAME, math.log1p(n) / 5, min(1.0, self.links[k] / n),
                text[-1] in _SENTENCE_END, tag[:1] == "h" and tag[1:].isdigit(),
                tag in ("li", "td", "th", "dt", "dd"), tag in ("p", "pre", "blockquote"))


FEATURES = 9
_LANDMARKS = (1, 2)
#: starting weights, kept for tables without landmarks of both kinds: long
#: paragraphs that end as sentences are content, links and list items are not
UNTRAINED = (-2.0, 5.0, -5.0, 2.0, -4.0, 1.0, 0.5, -1.0, 1.0)
TEXT_SAYS = 3.0
NEARNESS = 0.02     # of the weights to the starting ones, against the mean loss of a block


def score(features: tuple[float, ...], weights: tuple[float, ...]) -> float:
    """Log odds of content: the landmark's share, and the text's within bounds."""
    text = weights[0] + sum(map(mul, weights[3:], features[3:]))
    return weights[1] * features[1] + weights[2] * features[2] + max(-TEXT_SAYS, min(TEXT_SAYS, text))


def smoothness(page: Page) -> tuple[int, list[tuple[int, int, float]]]:
    """Number of nodes and the edges (node, node, capacity); the first nodes are
    the blocks, the others the elements around them."""
    parents, holders = page.parents, page.holders
    n = len(holders)
    edges: list[tuple[int, int, float]] = []
    for k in range(n - 1):
        a, b, hops = holders[k], holders[k + 1], 0
        while a != b and hops < _HOPS:  # elements are numbered in page order: the later one goes up
            if a > b:
                a = parents[a]
            else:
                b = parents[b]
            hops += 1
        edges.append((k, k + 1, ADJACENT / (1 + hops)))
    around = [max(0, parents[h]) for h in holders]
    node = {e: n + i for i, e in enumerate(dict.fromkeys(around))}
    above: dict[int, int] = {0: -1}     # nearest element with a node, further up
    for k, e in enumerate(around):
        edges.append((k, node[e], AROUND))
    for e, i in node.items():
        path, up = [], e
        while up not in above:
            path.append(up)
            up = parents[up]
            if up in node:
                break
        found = up if up in node and up != e else above.get(up, -1)
        for x in path:
            above[x] = found
        if above[e] >= 0:
            edges.append((i, node[above[e]], UPWARDS))
    return n + len(node), edges


def minimum_cut(scores: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes stay with the source when the flow is at its maximum.

    ``scores``: capacity from the source (positive) or to the sink (negative);
    ``edges``: both ways with one capacity.  Shortest augmenting paths, a whole
    level graph at a time.
    """
    n = len(scores)
    rest = list(scores)
    to: list[int] = []
    cap: list[int] = []
    out: list[list[int]] = [[] for _ in range(n)]
    for a, b, c in edges:
        if c > 0:
            out[a].append(len(to))
            out[b].append(len(to) + 1)
            to += (b, a)
            cap += (c, c)
    while True:
        level = [-1] * n
        front = [i for i in range(n) if rest[i] > 0]
        sources = front
        for i in front:
            level[i] = 0
        reached = False
        while front and not reached:
            ahead = []
            for i in front:
                for e in out[i]:
                    j = to[e]
                    if cap[e] and level[j] < 0:
                        level[j] = level[i] + 1
                        ahead.append(j)
                        reached = reached or rest[j] < 0
            front = ahead
        if not reached:
            return [x >= 0 for x in level]
        tried = [0] * n
        for s in sources:
            path: list[int] = []
            i = s
            while rest[s] > 0:
                if rest[i] < 0:
                    send = min(rest[s], -rest[i], *(cap[e] for e in path)) if path else 0
                    for e in path:
                        cap[e] -= send
                        cap[e ^ 1] += send
                    rest[s] -= send
                    rest[i] += send
                    path, i = [], s
                    continue
                options = out[i]
                while tried[i] < len(options):
                    e = options[tried[i]]
                    if cap[e] and level[to[e]] == level[i] + 1:
                        break
                    tried[i] += 1
                else:
                    if not path:
                        break
                    i = to[path.pop() ^ 1]
                    tried[i] += 1
                    continue
                path.append(e)
                i = to[e]


def main_text(html: str | None, weights=UNTRAINED) -> str:
    """The blocks of the main text, one a line."""
    if not html:
        return ""
    page = Page(html)
    if not page.texts:
        return ""
    scores = [round(_UNIT * score(page.features(k), weights)) for k in range(len(page.texts))]
    if min(scores) > 0:
        return "\n".join(page.texts)
    if max(scores) <= 0:
        return ""
    n, edges = smoothness(page)
    scores += [0] * (n - len(scores))
    stay = minimum_cut(scores, [(a, b, round(_UNIT * c)) for a, b, c in edges])
    return "\n".join(t for t, ok in zip(page.texts, stay, strict=False) if ok)


def _sample_fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features of the weakly labelled blocks of a page, as bytes."""
    for batch in batches:
        rows = []
        for html in batch.column(1):
            page = Page(html.as_py() or "")
            told = [k for k, p in enumerate(page.parts) if p != UNKNOWN]
            if len(told) > SAMPLE_BLOCKS:
                told = [told[i * len(told) // SAMPLE_BLOCKS] for i in range(SAMPLE_BLOCKS)]
            rows.append(np.array([page.features(k) for k in told], np.float32).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], names=["h", "blocks"])


def fit(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> tuple[float, ...]:
    """Weights from a bounded sample: the ``SAMPLE_PAGES`` smallest hashes are
    found on ids and urls alone, then only those pages are read into blocks; rows
    that share a hash cannot widen the sample."""
    prepare(pages.sparkSession)
    keyed = pages.select(F.xxhash64(F.col(id_col), F.col(url_col)).alias("h"), F.col(html_col).alias("html"))
    last = keyed.select("h").orderBy("h").limit(SAMPLE_PAGES).agg(F.max("h")).first()[0]
    if last is None:
        return UNTRAINED
    got = (keyed.filter(F.col("h") <= last).mapInArrow(_sample_fn, "h long, blocks binary")
           .orderBy("h", "blocks").limit(SAMPLE_PAGES).collect())
    x = np.concatenate([np.frombuffer(r.blocks, np.float32).reshape(-1, FEATURES) for r in got]).astype(float)
    y = x[:, _LANDMARKS[0]]
    if not 0 < y.sum() < len(y):
        return UNTRAINED
    bare = x.copy()
    bare[:, _LANDMARKS] = 0
    return logistic(np.concatenate([x, bare]), np.concatenate([y, y]))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = NEARNESS, rounds: int = 50) -> tuple[float, ...]:
    """Logistic regression by Newton's method, both classes of equal weight, with
    a ridge around the starting weights."""
    start = np.array(UNTRAINED)
    w = start.copy()
    share = np.where(y > 0, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (share * (y - p)) - ridge * (w - start)
        curve = (x * (share * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(curve, slope)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


def _extract_fn(weights: tuple[float, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py(), weights) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["id", "url", "text", "n_chars"])
    return run


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            weights: tuple[float, ...] | None = None) -> DataFrame:
    """One row per page: ``id_col``, ``url_col``, text and n_chars."""
    prepare(pages.sparkSession)
    weights = weights or fit(pages, id_col, url_col, html_col)
    kind = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    found = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")).mapInArrow(
        _extract_fn(tuple(weights)), f"id {kind[id_col]}, url {kind[url_col]}, text string, n_chars long")
    return found.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")
