"""HTML extraction (operator 4): minimum-cut labelling of a page's text blocks.

A page is read once into blocks of text with what surrounds them. A logistic
classifier of a block's own text (lengths, links, punctuation, place) and a bounded prior from the
landmark element or the name that it stands in give its costs of being content or boilerplate, the
capacities of its edges to the two terminals. Smoothness edges tie blocks that follow each other, the more the
nearer they stand in the DOM and less where one landmark or named area ends, and blocks of one parent element. A
maximum flow separates content from boilerplate at the least total cost.

No block's costs outweigh the ties of a block between two siblings (``TEXT_CAP`` and the largest of ``PRIOR`` against two times
``TIE``), so neither its words nor its surroundings alone settle such a block: the cut does.

The classifier is trained on the pages themselves: blocks inside article or main
elements are content, blocks inside navigation, headers, footers, asides, forms and elements whose class
or id says so are boilerplate. The landmarks are the labels, never features. The fit uses
at most ``max_pages`` pages, chosen by a hash of the page's url and html, and of their marked blocks at most
``max_rows``, by a hash too; every page is extracted with the model.

Names are compared as whole words of a class, id or role: ``share-bar`` is one, ``shared-memory`` or
``related-work`` is not. The names of article and main elements don't count, nor do the ids of
headings and sections inside them, where an id is a link's target.

Text: character references are decoded, white space inside a block becomes one
space, blocks are joined by a line break in page order. Scripts, styles, comments
and other elements that show no text are skipped to their end.

Defined cases: null and empty html give an empty text; html without any tag is
one block; unclosed elements end with the page; blocks without letters or digits
are kept if labelled content; pages of any length are read in linear time;
repeated rows get equal results; other columns are never read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderstream.llm.common import map_arrow, sliced, text_or_empty

MAX_PAGES, MAX_ROWS = 1000, 100_000
TEXT_CAP = 2.0  # of the classifier's margin
TIE, ACROSS = 2.5, 0.25  # of two blocks of one parent; what is left of a tie across the edge of an area
NOTHING, CONTENT, ELEMENT, NAMED, MAYBE, COMMENTS = range(6)  # what a block stands in
PRIOR = np.array([0.0, 1.5, -2.5, -2.5, -0.5, -2.5])

#: Elements that don't end a block of text.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong "
                   "sub sup time tt u var wbr math mi mo mn ms mtext mrow mfrac msup msub msubsup msqrt mroot mover munder munderover mstyle mspace mpadded "
                   "semantics".split())
#: Elements whose content shows no text of the page's own.
SILENT = frozenset("script style noscript template title textarea select svg iframe object audio video canvas button datalist head annotation annotation-xml".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
CONTENT_TAGS = frozenset(("article", "main"))
BOILER_TAGS = frozenset("nav footer aside form menu dialog".split())
#: Words of class, id or role that name boilerplate, that may name it, that name readers' comments, and that may stand beside them.
BOILER_WORDS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored sponsors banner promo nav navbar navigation menu sidebar breadcrumb "
                         "breadcrumbs footer masthead notice cookie cookies consent newsletter subscribe subscription copyright pagination pager popup modal "
                         "login share sharing social widget widgets toolbar related recommended".split())
MAYBE_WORDS = frozenset("side header search legal tags meta".split())
COMMENT_WORDS = frozenset("comment comments commentlist replies reply disqus".split())
PLAIN_WORDS = frozenset("bar box list block section container wrapper wrap area item items link links button buttons post posts site page main top bottom left "
                        "right inner outer group panel row column unit slot zone primary secondary article content entry user reader blog body".split())
OWN_WORDS = frozenset("header masthead".split())  # of an article itself, inside it
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(?:[a-zA-Z/]|[!?])(?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^<>])*+>?", re.S)
_NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:_-]*)")
_MARKS = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
IMPLIED_END = {"p": frozenset(("p",)), "li": frozenset(("li", "p")), "dt": frozenset(("dt", "dd", "p")), "dd": frozenset(("dt", "dd", "p")),
               "tr": frozenset(("tr", "td", "th", "p")), "td": frozenset(("td", "th", "p")), "th": frozenset(("td", "th", "p")), "option": frozenset(("option",))}
LEAFY = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th tr pre blockquote".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 section".split())


@dataclass
class Block:
    text: str
    state: int  # what it stands in
    tag: str
    parent: int
    link_chars: int
    area: int  # the element that says so
    steps: int  # in the DOM, from the block before


def name_state(words: str, inside: bool) -> int:
    """What the words of a class, id or role say; ``inside`` an article its own header is a part of it."""
    out = NOTHING
    for name in words.lower().split():
        parts = [x for x in _LETTERS.split(name) if x]
        known = [x for x in parts if x in BOILER_WORDS or x in MAYBE_WORDS or x in COMMENT_WORDS]
        if not known or any(x not in PLAIN_WORDS for x in parts if x not in known) or inside and all(x in OWN_WORDS for x in known):
            continue
        if any(x in COMMENT_WORDS for x in known):
            return COMMENTS
        out = NAMED if out == NAMED or any(x in BOILER_WORDS for x in known) else MAYBE
    return out


_LETTERS = re.compile(r"[^a-z]+")


def read_blocks(html: str) -> list[Block]:
    """The page's blocks with what they stand in, tag, parent element and linked characters."""
    blocks: list[Block] = []
    parts: list[str] = []
    # (tag, state, number of the element, number of the element that set the state)
    stack: list[tuple[str, int, int, int]] = [("", NOTHING, 0, 0)]
    open_count: dict[str, int] = {}
    link = linked = number = 0
    depth, lowest = 0, 0  # of the last block's parent, and of the stack since

    def close() -> None:
        nonlocal linked, depth, lowest
        if parts:
            raw = "".join(parts)
            parts.clear()
            text = " ".join((unescape(raw) if "&" in raw else raw).split())
            if text:
                k = len(stack) - 1
                tag = stack[k][0]
                while k and stack[k][0] in LEAFY:
                    k -= 1
                low = min(lowest, depth, k)
                blocks.append(Block(text, stack[-1][1], tag, stack[k][2], min(linked, len(text)), stack[-1][3], depth + k - 2 * low))
                depth = lowest = k
        linked = 0

    def pop() -> str:
        nonlocal lowest
        tag = stack.pop()[0]
        lowest = min(lowest, len(stack) - 1)
        open_count[tag] -= 1
        return tag

    at, n = 0, len(html)
    while at < n:
        m = _TOKEN.search(html, at)
        if m is None:
            parts.append(html[at:])
            break
        if m.start() > at:
            s = html[at:m.start()]
            parts.append(s)
            if link:
                linked += len(s.strip())
        at = m.end()
        name = _NAME.match(html, m.start(), m.end())
        if name is None:
            continue  # comments, doctypes, processing instructions
        tag = name.group(1).lower()
        ending = html[m.start() + 1] == "/"
        if tag in INLINE:
            if tag == "a":
                link = 0 if ending else 1
            elif tag == "br" or tag == "img":
                parts.append(" ")
            continue
        close()
        if ending:
            if open_count.get(tag):
                while pop() != tag:
                    pass
            link = 0
            continue
        if tag in SILENT:
            if not html.endswith("/>", 0, m.end()):
                end = _end_of(tag, html, at)
                at = end
            continue
        if tag in VOID:
            continue
        if tag in IMPLIED_END:
            ends = IMPLIED_END[tag]
            while stack[-1][0] in ends:
                pop()
        elif tag not in INLINE and stack[-1][0] == "p":
            pop()
        state, area = stack[-1][1], stack[-1][3]
        number += 1
        was = state
        if state in (ELEMENT, COMMENTS):
            pass
        elif tag in CONTENT_TAGS:
            state = CONTENT  # a wrapper's name doesn't speak for the article inside
        elif tag in BOILER_TAGS or tag == "header" and state != CONTENT:
            state = ELEMENT
        elif tag == "body":
            state = NOTHING
        if state not in (ELEMENT, COMMENTS) and tag not in ("html", "body") and tag not in CONTENT_TAGS and "=" in m.group():
            inside = state == CONTENT
            for kind, *v in _MARKS.findall(m.group()):
                if inside and kind.lower() == "id" and tag in HEADINGS:
                    continue
                said = name_state(v[0] or v[1] or v[2], inside)
                if said == COMMENTS or said and state != COMMENTS and (said == NAMED or state != NAMED):
                    state = said
        if state != was or tag in CONTENT_TAGS:
            area = number
        stack.append((tag, state, number, area))
        open_count[tag] = open_count.get(tag, 0) + 1
    close()
    return blocks


_ENDS: dict[str, re.Pattern] = {}


def _end_of(tag: str, html: str, at: int) -> int:
    """Where the silent element that began before ``at`` ends; a head also ends where the body begins."""
    pattern = _ENDS.get(tag)
    if pattern is None:
        pattern = _ENDS[tag] = re.compile(r"</head[^>]*>|(?=<body[\s>])" if tag == "head" else rf"</{tag}(?:[\s/][^>]*)?>", re.I)
    m = pattern.search(html, at)
    return m.end() if m else len(html) if tag != "head" else at


def block_features(blocks: list[Block]) -> np.ndarray:
    """The form of each block's text; nothing of its element or of what it stands in."""
    n = len(blocks)
    out = np.zeros((n, 10))
    for i, b in enumerate(blocks):
        t, size = b.text, len(b.text)
        words = t.count(" ") + 1
        stops = t.count(".") + t.count(",") + t.count("?") + t.count(";")
        out[i] = (1.0, np.log1p(size) / 5, b.link_chars / size, min(words, 40) / 40,
                  min(stops / words, 1.0), size / words / 10, t[-1:] in ".!?\"", t[:1].isupper(), "©" in t or "|" in t and words < 12, 2 * abs(i / max(n - 1, 1) - 0.5))
    return out


def ties(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness edges: of blocks that follow each other, by their distance in the DOM, and of a parent's blocks with others in between."""
    out, last = [], {}
    for i, b in enumerate(blocks):
        if i:
            same = b.area == blocks[i - 1].area
            out.append((i - 1, i, TIE / (1 + b.steps) ** 2 * (1.0 if same else ACROSS)))
        j = last.get(b.parent)
        if j is not None and j < i - 1:
            out.append((j, i, TIE * (1.0 if b.area == blocks[j].area else ACROSS)))
        last[b.parent] = i
    return out


def least_cut(unary: np.ndarray, edges: list[tuple[int, int, float]]) -> np.ndarray:
    """Labels (True: content) of least total cost. ``unary``: the cost of boilerplate
    less the cost of content; an edge costs its weight if its ends differ.

    A block whose own cost outweighs all its ties keeps its label in every least
    cut; such blocks are settled first and pass their ties on. The rest is cut by
    maximum flow: shortest augmenting paths in level graphs.
    """
    n = len(unary)
    cost = unary.astype(float).copy()
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, w in edges:
        if a != b and w > 0:
            near[a][b] = near[a].get(b, 0.0) + w
            near[b][a] = near[b].get(a, 0.0) + w
    total = [sum(x.values()) for x in near]
    label = np.zeros(n, bool)
    settled = np.zeros(n, bool)
    queue = [i for i in range(n) if abs(cost[i]) >= total[i]]
    while queue:
        i = queue.pop()
        if settled[i] or abs(cost[i]) < total[i]:
            continue
        settled[i], label[i] = True, cost[i] > 0
        for j, w in near[i].items():
            if not settled[j]:
                cost[j] += w if label[i] else -w
                total[j] -= w
                if abs(cost[j]) >= total[j] - 1e-12:
                    total[j] = min(total[j], abs(cost[j]))
                    queue.append(j)
    left = [i for i in range(n) if not settled[i]]
    if left:
        side = _flow(left, cost, near, settled)
        label[left] = side
    return label


def _flow(nodes: list[int], cost: np.ndarray, near: list[dict[int, float]], settled: np.ndarray) -> list[bool]:
    """Whether each node is on the source's (content) side of a minimum cut."""
    place = {v: i for i, v in enumerate(nodes)}
    n = len(nodes)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def edge(a: int, b: int, forth: float, back: float) -> None:
        out[a].append(len(to))
        to.append(b)
        room.append(forth)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for v in nodes:
        if cost[v] > 0:
            edge(source, place[v], float(cost[v]), 0.0)
        elif cost[v] < 0:
            edge(place[v], sink, float(-cost[v]), 0.0)
        for u, w in near[v].items():
            if v < u and not settled[u]:
                edge(place[v], place[u], w, w)
    eps = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = [source]
        for v in queue:
            for e in out[v]:
                if room[e] > eps and level[to[e]] < 0:
                    level[to[e]] = level[v] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        arc = [0] * (n + 2)
        path: list[int] = []
        v = source
        while True:
            if v == sink:
                push = min(room[e] for e in path)
                for e in path:
                    room[e] -= push
                    room[e ^ 1] += push
                k = next(i for i, e in enumerate(path) if room[e] <= eps)
                del path[k + 1:]
                v = to[path.pop() ^ 1]
                continue
            moved = False
            while arc[v] < len(out[v]):
                e = out[v][arc[v]]
                if room[e] > eps and level[to[e]] == level[v] + 1:
                    path.append(e)
                    v = to[e]
                    moved = True
                    break
                arc[v] += 1
            if not moved:
                if not path:
                    break
                e = path.pop()
                v = to[e ^ 1]
                arc[v] += 1


@dataclass
class Model:
    weights: np.ndarray

    def costs(self, blocks: list[Block]) -> np.ndarray:
        """Cost of boilerplate less cost of content, by the block itself and what it stands in."""
        return np.clip(block_features(blocks) @ self.weights, -TEXT_CAP, TEXT_CAP) + PRIOR[[b.state for b in blocks]]

    def labels(self, blocks: list[Block]) -> np.ndarray:
        return least_cut(self.costs(blocks), ties(blocks)) if blocks else np.zeros(0, bool)

    def extract(self, html: str) -> str:
        blocks = read_blocks(html)
        return "\n".join([b.text for b, k in zip(blocks, self.labels(blocks)) if k])


def prior_weights() -> np.ndarray:
    """Where no page marks its parts: long sentences outside links are content."""
    w = np.zeros(10)
    w[0], w[1], w[2], w[4], w[6] = -2.0, 2.0, -3.0, 2.0, 1.0
    return w


def train_classifier(x: np.ndarray, y: np.ndarray, ridge: float = 0.006) -> np.ndarray:
    """Logistic regression by Newton steps with a ridge of ``ridge`` a row: margins stay moderate, so that short
    paragraphs aren't certain boilerplate."""
    w, ridge = np.zeros(x.shape[1]), ridge * len(x)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (y - p) - ridge * w
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(pages: DataFrame, html_col: str = "html", max_pages: int = MAX_PAGES, max_rows: int = MAX_ROWS, seed: int = 2) -> Model:
    p = pages.select(text_or_empty(html_col).alias("html"))
    n = p.count()
    draw = F.pmod(F.xxhash64("html", F.lit(seed)), F.lit(1 << 30))
    some = p.where(draw < int(min(1.0, max_pages / max(n, 1)) * (1 << 30)))

    def rows(batches):
        for batch in batches:
            for h in batch.column("html"):
                blocks = read_blocks(h.as_py())
                marked = [i for i, b in enumerate(blocks) if b.state not in (NOTHING, MAYBE)]
                if marked:
                    x = block_features(blocks)[marked]
                    yield pa.RecordBatch.from_arrays([pa.array(x.tolist(), pa.list_(pa.float64())), pa.array([float(blocks[i].state == CONTENT) for i in marked])], names=["x", "y"])

    found = (map_arrow(some, rows, "x array<double>, y double").orderBy(F.xxhash64("x", F.lit(seed)), "x", "y").limit(max_rows).collect())
    y = np.array([r.y for r in found])
    if len(y) < 20 or y.min() == y.max():
        return Model(prior_weights())
    return Model(train_classifier(np.array([r.x for r in found]), y))


def extract(pages: DataFrame, model: Model, keep: list[str], html_col: str = "html") -> DataFrame:
    """The columns ``keep`` and text, n_chars (code points) for every row."""
    def run(batches):
        for batch in sliced(batches, "html", 8 << 20):
            text = [model.extract(h.as_py()) for h in batch.column("html")]
            own = [batch.column(f"k{i}") for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*own, pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())],
                                             names=[*(f"k{i}" for i in range(len(keep))), "text", "n_chars"])

    p = pages.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], text_or_empty(html_col).alias("html"))
    schema = ", ".join(f"k{i} {pages.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))
    out = map_arrow(p, run, f"{schema}, text string, n_chars long")
    return out.toDF(*keep, "text", "n_chars")
