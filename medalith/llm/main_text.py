"""Main text of web pages by minimum-cut labelling of their blocks.

A page becomes a list of text blocks with their path of elements. A classifier (logistic regression on a few features
of the block and its path) gives each block a cost for either label; the costs are the capacities to the two ends of a
flow network. Blocks next to each other and blocks under the same element are joined by edges that get weaker with
their distance in the element tree, so a doubtful block follows its surroundings. The minimum cut separates main text
from the rest.

The classifier is fitted on at most ``SAMPLE_PAGES`` different pages (chosen by their hash), whose blocks are labelled
where the markup is explicit; each such block is used a second time without its path features, so that the text
features also carry pages without telling markup. Pages never leave their partition.

Defined results: null or empty html, and pages without a main block, give an empty text. Unclosed and stray tags are
repaired as browsers do in simple cases; a head without end tag ends at the first element or text that is not its own.
In a compound class, id or role the last part that is not a mere container decides (``site-header``, ``cookie-bar``), where
no negation precedes it (``no-sidebar``); other parts are counted evidence of the classifier. A form around an article or
another main part does not count, and a header inside of an article belongs to it. Scripts, styles and the head are no
blocks. Repeated pages get equal texts.
"""

from __future__ import annotations

import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from medalith.llm.frames import column, hash_share

SAMPLE_PAGES = 2000
SMOOTHNESS = 0.7
RIDGE = 0.5

#: Fixed sets of element names.
BLOCKS = frozenset((
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div",
    "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr",
    "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td",
    "tfoot", "th", "thead", "tr", "ul",
))
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
UNSEEN = frozenset(("head", "iframe", "noscript", "object", "script", "style", "svg", "template", "title"))
AROUND = frozenset(("aside", "button", "dialog", "footer", "form", "header", "menu", "nav", "select", "textarea"))
MAIN = frozenset(("article", "main"))
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: Fixed words in class, id and role that mark surroundings, or the main text.
AROUND_WORDS = frozenset((
    "ad", "ads", "advert", "advertisement", "adverts", "alert", "banner", "breadcrumb", "breadcrumbs", "comment",
    "comments", "complementary", "consent", "contentinfo", "cookie", "cookies", "disclaimer", "disqus", "footer", "gdpr", "header",
    "login", "masthead", "menu", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "popup", "promo",
    "promoted", "related", "replies", "reply", "respond", "search", "share", "sharing", "sidebar", "signup", "social",
    "sponsor", "sponsored", "subscribe", "toolbar", "widget",
))
#: Those of them whose elements have articles that are not the page's own.
OTHER_ARTICLES = frozenset((
    "ad", "ads", "advert", "advertisement", "adverts", "comment", "comments", "disqus", "promo", "promoted", "related", "replies",
    "reply", "respond", "sidebar", "sponsor", "sponsored", "widget",
))
MAIN_WORDS = frozenset(("article", "content", "entry", "main", "post", "story"))
#: Fixed last parts of compound names that name a container or a place, so that the part before them decides.
CONTAINERS = frozenset((
    "area", "articles", "bar", "block", "body", "bottom", "box", "button", "buttons", "column", "container", "content", "dialog",
    "form", "group", "inner", "item", "items", "left", "link", "links", "list", "main", "modal", "outer", "overlay", "panel",
    "post", "posts", "region", "right", "row", "section", "slot", "text", "thread", "top", "unit", "wrap", "wrapper", "zone",
))
#: Fixed parts that turn the meaning of those behind them.
NEGATIONS = frozenset(("has", "hide", "no", "non", "not", "with", "without"))
#: Elements that leave the head open; any other one ends it, as its end tag may be left out.
HEAD = frozenset(("base", "basefont", "bgsound", "head", "html", "link", "meta", "noframes", "noscript", "script", "style", "template", "title"))
_SENTENCE_END = re.compile(r"[.!?…:;。！？]['\")\]»”]*$")
_NAMES = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


class _Element:
    """An element of a page: what its tag and names say, and what lies in it (2 a main part, 1 a title, 0 neither)."""

    __slots__ = ("tag", "above", "parent", "depth", "words", "hints", "holds", "side", "in_article")

    def __init__(self, tag: str, above: _Element | None, words: set[str], hints: tuple[int, int]):
        self.tag, self.above, self.words, self.hints = tag, above, words, hints
        # the next block element above, and how many there are
        self.parent = above if above is None or above.tag in BLOCKS else above.parent
        self.depth = self.parent.depth + 1 if self.parent else 0
        self.holds = self.side = 0
        self.in_article = False

    def settle(self) -> None:
        """Side, once the whole page is read and the elements above are settled: -2 around with its articles, -1 around, 1 main, 0 unknown."""
        side, in_article = (self.above.side, self.above.in_article) if self.above else (0, False)
        own_header = in_article or (side == 1 and self.holds > 0)
        words = self.words - {"header"} if own_header else self.words
        if self.tag == "main":
            side = 1
        elif side == -2 or words & OTHER_ARTICLES:
            side = -2
        elif self.tag in AROUND and not (self.tag == "form" and self.holds == 2) and not (self.tag == "header" and own_header):
            side = -2
        elif self.tag == "article":
            side, in_article = 1, True
        elif side == -1 or words & AROUND_WORDS:
            side = -1
        elif words & MAIN_WORDS:
            side = 1
        self.side, self.in_article = side, in_article


class Block:
    __slots__ = ("text", "element", "linked", "heading", "listed")

    def __init__(self, text: str, element: _Element | None, linked: float, heading: bool, listed: bool):
        self.text, self.element = text, element
        self.linked, self.heading, self.listed = linked, heading, listed

    @property
    def place(self) -> _Element | None:
        """The block element that the text stands in."""
        return self.element if self.element is None or self.element.tag in BLOCKS else self.element.parent

    @property
    def side(self) -> int:
        return max(self.element.side, -1) if self.element else 0

    @property
    def hints(self) -> tuple[int, int]:
        return self.element.hints if self.element else (0, 0)


def _deciding(parts: list[str]) -> str | None:
    """The part of a compound name that says what it marks, if one does."""
    last = len(parts) - 1
    while last > 0 and parts[last] in CONTAINERS:
        last -= 1
    before = set(parts[:last])
    if parts[last] not in AROUND_WORDS and not (parts[last] in MAIN_WORDS and not before & AROUND_WORDS):
        return None
    if before & NEGATIONS:
        return None
    # headers of an article or a page hold its title, and "content-sidebar" names a layout of both
    if parts[last] in ("header", "sidebar") and before & (MAIN_WORDS | {"page"}):
        return None
    return parts[last]


def _words(attrs: list[tuple[str, str | None]]) -> tuple[set[str], int, int]:
    """Words of the class, id and role values that decide, and how many parts of the other values point around or to the
    main text (``no-sidebar`` and ``post-header`` are hints, ``sidebar`` and ``cookie-bar`` are words)."""
    words, around, main = set(), 0, 0
    for name, value in attrs:
        if name in ("class", "id", "role") and value:
            for token in value.split():
                parts = [p.lower() for p in _NAMES.findall(token)]
                if not parts:
                    continue
                if AROUND_WORDS.issuperset(parts) or MAIN_WORDS.issuperset(parts):
                    words.update(parts)
                elif decides := _deciding(parts):
                    words.add(decides)
                else:
                    around += sum(p in AROUND_WORDS for p in set(parts))
                    main += sum(p in MAIN_WORDS for p in set(parts))
    return words, around, main


class _Blocks(HTMLParser):
    """Collects the text blocks of a page with the elements that they stand in."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.open: list[_Element] = []
        self.elements: list[_Element] = []
        self.tags: Counter[str] = Counter()  # open elements by tag
        self.parts: list[str] = []
        self.link_chars = self.chars = 0
        self.unseen = 0

    def _end_head(self, tag: str = "") -> None:
        if self.tags["head"] and (tag == "body" or (self.open[-1].tag == "head" and tag not in HEAD)):
            self._cut(next(k for k, e in enumerate(self.open) if e.tag == "head"))

    def handle_starttag(self, tag, attrs):
        if self.unseen:
            self._end_head(tag)
        if tag in VOID:
            if tag == "hr":
                self._flush()
            elif tag == "br":
                self.parts.append(" ")
            return
        if tag in BLOCKS:
            self._flush()
            self._close_open("p")
        for other in CLOSES.get(tag, ()):
            self._close_open(other, ("ul", "ol", "dl", "table"))
        above = self.open[-1] if self.open else None
        hints = above.hints if above else (0, 0)
        words: set[str] = set()
        if tag not in ("html", "body"):
            words, around, main = _words(attrs)
            hints = (hints[0] + around, hints[1] + main)
        element = _Element(tag, above, words, hints)
        self.elements.append(element)
        self.open.append(element)
        if tag in MAIN or (tag in BLOCKS and words & MAIN_WORDS):
            self._holds(above, 2)
        elif tag in ("h1", "h2"):
            self._holds(above, 1)
        self.tags[tag] += 1
        self.unseen += tag in UNSEEN

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self._flush()
        if not self.tags[tag]:
            return
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k].tag == tag:
                self._cut(k)
                return

    @staticmethod
    def _holds(element: _Element | None, what: int) -> None:
        while element and element.holds < what:  # what lies in an element lies in all above it
            element.holds = what
            element = element.above

    def handle_data(self, data):
        if self.unseen and not data.isspace():
            self._end_head()
        if not self.unseen:
            self.parts.append(data)
            size = len(data.strip())
            self.chars += size
            if self.tags["a"]:
                self.link_chars += size

    def _close_open(self, tag: str, until: tuple[str, ...] = ()) -> None:
        for k in range(len(self.open) - 1, -1, -1):
            name = self.open[k].tag
            if name == tag:
                self._flush()
                self._cut(k)
                return
            if name in until or (tag == "p" and name in BLOCKS):
                return

    def _cut(self, k: int) -> None:
        for element in self.open[k:]:
            self.tags[element.tag] -= 1
            self.unseen -= element.tag in UNSEEN
        del self.open[k:]

    def _flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            heading, linked = any(self.tags[h] for h in HEADINGS), self.link_chars / max(1, self.chars)
            self.blocks.append(Block(text, self.open[-1] if self.open else None, linked, heading, self.tags["li"] > 0))
        self.parts, self.link_chars, self.chars = [], 0, 0

    def finish(self) -> list[Block]:
        self.close()
        self._flush()
        for element in self.elements:  # those above come first
            element.settle()
        return self.blocks


def page_blocks(page: str) -> list[Block]:
    parser = _Blocks()
    try:
        parser.feed(page)
        return parser.finish()
    except AssertionError:  # the standard parser gives up on some broken declarations
        parser = _Blocks()
        parser.feed(re.sub(r"<!\[?[^>]*>?", " ", page))
        return parser.finish()


FEATURES = 10
PATH_FEATURES = 4


def features(block: Block) -> list[float]:
    words = block.text.count(" ") + 1
    return [
        1.0,
        math.log(words),
        block.linked,
        1.0 if _SENTENCE_END.search(block.text) else 0.0,
        1.0 if block.heading else 0.0,
        1.0 if block.listed else 0.0,
        1.0 if block.side > 0 else 0.0,
        1.0 if block.side < 0 else 0.0,
        math.log1p(block.hints[0]),
        math.log1p(block.hints[1]),
    ]


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, labels = [], []
        for page in batch.column("html").to_pylist():
            for block in page_blocks(page or ""):
                if block.side:
                    own = features(block)
                    rows += [own, [*own[:-PATH_FEATURES], *[0.0] * PATH_FEATURES]]
                    labels += [block.side > 0] * 2
        yield pa.RecordBatch.from_arrays(
            [pa.array([np.array(rows, dtype="<f8").tobytes()], pa.binary()), pa.array([np.array(labels, dtype="<f8").tobytes()], pa.binary()),
             pa.array([batch.num_rows], pa.int32())],
            names=["rows", "labels", "pages"],
        )


def _sampled(hashed: DataFrame, sample: int) -> list[Row]:
    # copies of a page are one before they are gathered
    chosen = hashed.groupBy("hash").agg(F.min("html").alias("html")).orderBy("hash").limit(sample).select("html")
    return chosen.mapInArrow(_training_rows, "rows binary, labels binary, pages int").collect()  # of ``sample`` pages at most


def fit(pages: DataFrame, html_col: str = "html", sample: int = SAMPLE_PAGES) -> np.ndarray:
    """Weights of the block classifier, from the explicitly marked blocks of at most ``sample`` pages."""
    chosen = pages.select(column(pages, html_col).cast("string").alias("html")).where("html is not null")
    hashed = chosen.withColumn("hash", F.xxhash64("html"))
    different = hashed.agg(F.approx_count_distinct("hash").alias("n")).first().n
    packed = _sampled(hashed.where(hash_share(F.col("hash"), different, sample)), sample)
    if sum(r.pages for r in packed) < sample < different:  # the estimate was far too high
        packed = _sampled(hashed, sample)
    x = np.frombuffer(b"".join(r.rows for r in packed), dtype="<f8").reshape(-1, FEATURES)
    y = np.frombuffer(b"".join(r.labels for r in packed), dtype="<f8")
    # a mild prior holds the weights where the sample has no or one-sided evidence
    prior = np.array([-1.0, 0.4, -3.0, 0.8, 0.5, -0.5, 5.0, -8.0, -0.7, 0.7])
    weights = prior.copy()
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (y - p) - RIDGE * (weights - prior)
        curvature = (x * (p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(FEATURES)
        step = np.linalg.solve(curvature, gradient)
        weights = weights + step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def _distance(one: _Element | None, two: _Element | None) -> int:
    """Steps from one block element to the other in the tree of them."""
    steps = 0
    while one is not two:
        deeper = two is None or (one is not None and one.depth >= two.depth)
        if deeper:
            one = one.parent
        else:
            two = two.parent
        steps += 1
    return steps


def smooth_edges(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Edges between neighbours in page order, and between a block and the last one under the same parent element."""
    edges, last = [], {}
    for k, block in enumerate(blocks):
        before = {k - 1} if k else set()
        parent = block.place and block.place.parent
        if parent in last:
            before.add(last[parent])
        last[parent] = k
        edges += [(b, k, SMOOTHNESS / (1 + _distance(blocks[b].place, block.place) / 2)) for b in before]
    return edges


def minimum_cut(gains: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """The labelling with the least cost: a node pays |gain| for the label against its gain's sign, an edge its weight
    when its ends differ.

    A node whose gain outweighs all its edges keeps its own label in some minimum cut, so it is fixed and its edges are
    added to the gains of its neighbours; what stays open goes through a maximum flow.
    """
    size = len(gains)
    gains = list(gains)
    near: list[dict[int, float]] = [{} for _ in range(size)]
    for a, b, w in edges:
        if a != b:
            near[a][b] = near[a].get(b, 0.0) + w
            near[b][a] = near[b].get(a, 0.0) + w
    label: list[bool | None] = [None] * size
    todo = deque(range(size))
    while todo:
        k = todo.popleft()
        if label[k] is not None or abs(gains[k]) < sum(near[k].values()):
            continue
        label[k] = gains[k] > 0
        for other, w in near[k].items():
            gains[other] += w if label[k] else -w
            del near[other][k]
            todo.append(other)
        near[k] = {}
    left = [k for k in range(size) if label[k] is None]
    if left:
        reached = _source_side(left, gains, near)
        for k in left:
            label[k] = k in reached
    return [bool(x) for x in label]


def _source_side(nodes: list[int], gains: list[float], near: list[dict[int, float]]) -> set[int]:
    """Nodes on the source's side of a minimum cut, by shortest augmenting paths."""
    source, sink = -1, -2
    rest: dict[int, dict[int, float]] = {k: dict(near[k]) for k in nodes}
    rest[source], rest[sink] = {}, {}
    for k in nodes:
        if gains[k] > 0:
            rest[source][k] = gains[k]
            rest[k][source] = 0.0
        else:
            rest[k][sink] = -gains[k]
            rest[sink][k] = 0.0
    while True:
        came = {source: source}
        queue = deque([source])
        while queue and sink not in came:
            a = queue.popleft()
            for b, room in rest[a].items():
                if room > 1e-12 and b not in came:
                    came[b] = a
                    queue.append(b)
        if sink not in came:
            return set(came) - {source}
        path, b = [], sink
        while b != source:
            path.append((came[b], b))
            b = came[b]
        flow = min(rest[a][b] for a, b in path)
        for a, b in path:
            rest[a][b] -= flow
            rest[b][a] = rest[b].get(a, 0.0) + flow


def main_text(page: str, weights: list[float]) -> str:
    """Main blocks of a page in its order, with an empty line between them."""
    blocks = page_blocks(page)
    if not blocks:
        return ""
    gains = [sum(w * f for w, f in zip(weights, features(b), strict=True)) for b in blocks]
    labels = minimum_cut(gains, smooth_edges(blocks))
    return "\n\n".join(b.text for b, main in zip(blocks, labels, strict=True) if main)


def with_main_text(
    spark: SparkSession, pages: DataFrame, into: str = "text", html_col: str = "html", weights: np.ndarray | None = None
) -> DataFrame:
    """``pages`` with the main text in the column ``into``."""
    model = [float(w) for w in (fit(pages, html_col) if weights is None else weights)]

    @F.arrow_udf("string")
    def extracted(rows: pa.Array) -> pa.Array:
        return pa.array([main_text(r, model) if r else "" for r in rows.to_pylist()], pa.string())

    return pages.withColumn(into, extracted(column(pages, html_col).cast("string")))

