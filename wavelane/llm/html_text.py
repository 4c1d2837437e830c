"""HTML extraction: a tree-structured graphical model over the page's elements.

The nodes are block elements and the stretches of text in them, each content or not. A node's own potential
is a logistic function of its features (tag, words of its class and id, length, links, punctuation); every
parent and child share a potential for agreeing or not. Messages go up the tree and down again (sum-product),
which gives each node's exact marginal. Stretches likelier content than not are the page's text.

The model is trained from labelled pages (html and the text that is right): a stretch is content if the text
holds it, an element if most of its characters are. Training climbs the trees' likelihood: the slope of every
weight and pair potential is what the labels show of it less what the same messages expect. Common names of
page parts come in as short made-up trees, so that parts the training pages lack, such as reader comments, are
known too, and that a paragraph alone is no sign of an article; together they weigh three fifths of the
labelled pages.

Defined results: null, empty or text-free html gives an empty text; broken or cut-off markup is read as far
as it goes, open elements end with the page; an element that is never read (buttons, drawings, the head) ends
at its own end tag or that of a block around it, without an end tag at the next block, and a head at the first
thing that can't be in one; pages of any length are read whole, in time that grows with their length;
of a labelled page with very many nodes the first are trained on; repeated rows are extracted each; without labelled pages the made-up examples decide; extra columns are not looked at.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from math import exp, log1p
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavelane.llm.common import hashed_sample

# Fixed values of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style noscript template head title iframe object svg canvas select textarea button".split())
RAW = frozenset("script style textarea title noscript iframe".split())
IN_HEAD = frozenset("base basefont bgsound head link meta noframes noscript script style template title".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
CLOSES = {
    "li": ("li", ("ul", "ol", "menu")),
    "p": ("p", ("div", "article", "section", "td", "th", "li", "blockquote", "body", "main", "aside", "footer", "header", "nav")),
    "td": ("td th", ("tr", "table")),
    "th": ("td th", ("tr", "table")),
    "tr": ("tr td th", ("table", "tbody", "thead", "tfoot")),
    "dt": ("dt dd", ("dl",)),
    "dd": ("dt dd", ("dl",)),
    "option": ("option", ("select",)),
}
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
BREAKS = ENDS_P | CLOSES.keys() - {"option"} | {"body", "caption", "html", "tbody", "tfoot", "thead"}
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORD = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")

#: Made-up examples: names of parts, as tag or in class and id, that are usually the article or usually not.
#: Paragraphs and lesser headings occur in both, what they are in decides.
USUALLY_CONTENT = "t:article t:main t:h1 c:article c:content c:post c:entry c:main c:story".split()
USUALLY_NOT = (
    "t:nav t:header t:footer t:aside t:form t:dialog t:menu c:ad c:ads c:advert c:advertisement c:sponsor c:sponsored c:banner "
    "c:promo c:nav c:navigation c:menu c:breadcrumb c:breadcrumbs c:sidebar c:aside c:widget c:footer c:header c:cookie c:cookies c:consent "
    "c:notice c:popup c:modal c:newsletter c:subscribe c:share c:social c:related c:recommended c:comment c:comments c:reply "
    "c:disqus c:login c:search c:copyright c:complementary"
).split()


@dataclass
class Page:
    """Nodes in page order, parents before children: parent, features, text (None for elements)."""

    parent: list[int] = field(default_factory=lambda: [-1])
    features: list[list[str]] = field(default_factory=lambda: [["t:#page"]])
    text: list[str | None] = field(default_factory=lambda: [None])


def _tags(source: str) -> tuple[list[tuple[int, int, str, bool, str]], set[int]]:
    """Every tag (begin, end, name, closing, attributes), an element of raw text being one tag, and the numbers
    of those that open an unseen element which has an end tag."""
    tags, closed, at = [], set(), 0
    begun: dict[str, list[int]] = {}
    for m in TAG.finditer(source):
        if m.start() < at:
            continue
        at = m.end()
        tag, closing, attributes = (m[2] or m[5] or "").lower(), bool(m[1] or m[4]), m[3] or m[6] or ""
        if tag in UNSEEN and closing:
            if begun.get(tag):
                closed.add(begun[tag].pop())
        elif tag in UNSEEN and not attributes.endswith("/"):
            if tag in RAW:  # its end is searched for as text
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(source, at)
                at = end.end() if end else len(source)
            else:
                opened = begun.setdefault(tag, [])
                if tag in ("button", "select"):  # these don't nest
                    opened.clear()
                opened.append(len(tags))
        tags.append((m.start(), at, tag, closing, attributes))
    return tags, closed


def parse(source: str | None) -> Page:
    page, source = Page(), source or ""
    stack: list[tuple[str, int]] = [("#page", 0)]  # open block elements and their nodes
    places: dict[str, list[int]] = {}  # where in the stack elements of a name are
    hidden: list[tuple[str, bool, Counter]] = []  # open elements that are never read: has an end tag, tags open inside
    hidden_names: Counter = Counter()
    parts: list[str] = []
    linked = 0
    in_link = False

    def flush() -> None:
        nonlocal linked
        text = SPACE.sub(" ", entities.unescape("".join(parts))).strip()
        parts.clear()
        if text:
            page.parent.append(stack[-1][1])
            page.text.append(text)
            share, n = min(1.0, linked / len(text)), len(text)
            words = text.count(" ") + 1
            page.features.append(
                [
                    "n:text",
                    f"n:chars{min(8, n.bit_length())}",
                    f"n:links{int(share * 3)}",
                    "n:stop" if text[-1] in ".!?:;\"'" else "n:nostop",
                    f"n:in:{stack[-1][0]}",
                    "n:many" if words > 8 else "n:few",
                ]
            )
        linked = 0

    def last(names: Iterable[str]) -> int:
        """Place of the innermost open element with one of the names, 0 if none is open."""
        return max((places[name][-1] for name in names if places.get(name)), default=0)

    def close_to(depth: int) -> None:
        flush()
        for name, _ in stack[depth:]:
            places[name].pop()
        del stack[depth:]

    def unhide() -> str:
        name = hidden.pop()[0]
        hidden_names[name] -= 1
        return name

    def ends_hidden(tag: str, closing: bool) -> bool:
        """Whether a tag that can be seen ends the innermost hidden element."""
        name, has_end, inner = hidden[-1]
        around = closing and last([tag]) > 0
        if name == "head":
            return around if closing else tag not in IN_HEAD
        if not has_end:
            return tag in BREAKS
        if closing and inner[tag]:
            inner[tag] -= 1
            return False
        if not closing and tag != "body":
            inner[tag] += 1
            return False
        return around or not closing

    at, n = 0, len(source)
    tags, closed = _tags(source)
    for number, (begin, end, tag, closing, attributes) in enumerate(tags):
        if hidden and hidden[-1][0] == "head" and source[at:begin].strip():
            unhide()
        if not hidden and begin > at:
            piece = source[at:begin]
            parts.append(piece)
            if in_link:
                linked += len(piece.strip())
        at = end
        if not tag:
            continue
        if tag in UNSEEN:
            if tag in RAW or attributes.endswith("/"):
                continue
            if closing:
                while hidden_names[tag] and unhide() != tag:
                    pass
                continue
            inner = hidden[-1][0] if hidden else None
            if inner and (tag not in IN_HEAD if inner == "head" else tag == inner and tag in ("button", "select")):
                unhide()
            if not hidden or hidden[-1][0] == "head" or number in closed:
                hidden.append((tag, number in closed, Counter()))
                hidden_names[tag] += 1
            continue
        while hidden and ends_hidden(tag, closing):
            unhide()
        if hidden:
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in VOID and tag != "hr":
            continue
        if tag in INLINE:
            if tag == "a":
                in_link = not closing
            continue
        if closing:
            depth = last([tag])
            if depth or tag == "p":  # other end tags of nothing are no break
                close_to(depth or len(stack))
                in_link = False
            continue
        flush()
        in_link = False
        if tag in ENDS_P and stack[-1][0] == "p":
            close_to(len(stack) - 1)
        if tag in CLOSES:
            ended, within = CLOSES[tag]
            depth = last(ended.split())
            if depth > last(x for x in within if x not in ended.split()):
                close_to(depth)
        if tag == "hr" or tag in ("html", "body") and last([tag]):
            continue
        names = [w for g in NAMES.findall(attributes) for w in WORD.findall("".join(g).lower())]
        page.parent.append(stack[-1][1])
        page.text.append(None)
        page.features.append([f"t:{tag}", *(f"c:{w}" for w in dict.fromkeys(names))])
        places.setdefault(tag, []).append(len(stack))
        stack.append((tag, len(page.parent) - 1))
    if at < n and (not hidden or hidden[-1][0] == "head"):
        parts.append(source[at:])
    flush()
    return page


@dataclass
class Model:
    """Weights of features, and the log potentials of (parent, child) being (not, not) ... (content, content)
    for children that are elements and that are stretches of text."""

    weights: dict[str, float]
    pair: tuple[tuple[float, float, float, float], tuple[float, float, float, float]]


def marginals(page: Page, model: Model) -> list[float]:
    """Log odds of being content for every node, exact on the tree: messages to the root, then back."""
    def add(a: float, b: float) -> float:
        d = b - a
        return a + log1p(exp(d)) if d <= 0 else b + log1p(exp(-d))

    n, parent = len(page.parent), page.parent
    own = [sum(model.weights.get(f, 0.0) for f in features) for features in page.features]
    pairs = [model.pair[text is not None] for text in page.text]
    # All messages and beliefs are log odds (content against not).
    inward, up = own[:], [0.0] * n
    for i in range(n - 1, 0, -1):
        nn, nc, cn, cc = pairs[i]
        up[i] = add(cn, cc + inward[i]) - add(nn, nc + inward[i])
        inward[parent[i]] += up[i]
    belief = inward[:]
    for i in range(1, n):
        nn, nc, cn, cc = pairs[i]
        rest = belief[parent[i]] - up[i]
        belief[i] += add(nc, cc + rest) - add(nn, cn + rest)
    return belief


def extract(source: str | None, model: Model) -> str:
    page = parse(source)
    belief = marginals(page, model)
    return "\n".join(t for t, b in zip(page.text, belief) if t is not None and b > 0)


def _labels(page: Page, gold: str) -> list[int]:
    """Whether each node is content, by the right text: stretches first, elements by their characters."""
    whole, lines = SPACE.sub(" ", gold).strip(), {SPACE.sub(" ", x).strip() for x in gold.split("\n")}
    n = len(page.parent)
    label, inside, outside = [0] * n, [0] * n, [0] * n
    for i in range(n - 1, 0, -1):
        text = page.text[i]
        if text is not None:
            label[i] = int(text in lines or (len(text) >= 25 and text in whole))
            (inside if label[i] else outside)[i] = len(text)
        else:
            label[i] = int(inside[i] > outside[i])
        inside[page.parent[i]] += inside[i]
        outside[page.parent[i]] += outside[i]
    label[0] = int(inside[0] > outside[0])
    return label


class Tree(NamedTuple):
    """A labelled tree to train on: parents (-1 at the root) come before children."""

    parent: list[int]
    features: list[list[str]]
    is_text: list[bool]
    label: list[bool]
    importance: float = 1.0


def labelled_tree(source: str | None, gold: str | None, max_nodes: int = 2000) -> Tree | None:
    """The first ``max_nodes`` nodes of a page (labels are those of the whole page); none if nothing of the right
    text is on it, such a page teaches nothing."""
    page = parse(source)
    label = _labels(page, gold or "")
    if not any(x and t for x, t in zip(label, page.text)):
        return None
    is_text = [t is not None for t in page.text]
    return Tree(page.parent[:max_nodes], page.features[:max_nodes], is_text[:max_nodes], [x > 0 for x in label[:max_nodes]])


class Forest:
    """Labelled trees side by side, for messages in all of them at once, a level at a time.

    Parameters are the weights of ``names`` and then the pair potentials, four for elements and four for
    stretches of text."""

    def __init__(self, trees: list[Tree]):
        begin = np.cumsum([0, *(len(t.parent) for t in trees)])
        self.n = int(begin[-1])
        self.parent = np.array([p + b if p >= 0 else -1 for t, b in zip(trees, begin) for p in t.parent], np.int64)
        self.kind = np.array([k for t in trees for k in t.is_text], np.int64)
        self.label = np.array([x for t in trees for x in t.label], np.int64)
        self.importance = np.repeat([t.importance for t in trees], np.diff(begin))
        features = [f for t in trees for f in t.features]
        self.names = {f: k for k, f in enumerate(dict.fromkeys(f for few in features for f in few))}
        self.row = np.repeat(np.arange(self.n), [len(few) for few in features])
        self.column = np.array([self.names[f] for few in features for f in few], np.int64)
        self.levels = [np.flatnonzero(self.parent < 0)]
        place = np.full(self.n, -1)
        place[self.levels[0]] = 0
        while True:
            below = np.flatnonzero((self.parent >= 0) & (place < 0) & (place[self.parent] == len(self.levels) - 1))
            if not len(below):
                break
            place[below] = len(self.levels)
            self.levels.append(below)

    def likelihood(self, theta: np.ndarray) -> tuple[float, np.ndarray]:
        """Log-likelihood of the labels and its slope: counts that the labels show less those expected."""
        weights, pair = theta[:-8], theta[-8:].reshape(2, 4)
        own = np.bincount(self.row, weights[self.column], self.n)
        inward, up, constant = own.copy(), np.zeros(self.n), np.zeros(self.n)
        for at in self.levels[:0:-1]:
            nn, nc, cn, cc = pair[self.kind[at]].T
            constant[at] = np.logaddexp(nn, nc + inward[at])
            up[at] = np.logaddexp(cn, cc + inward[at]) - constant[at]
            inward += np.bincount(self.parent[at], up[at], self.n)
        roots, below = self.levels[0], np.flatnonzero(self.parent >= 0)
        constant[roots] = np.logaddexp(0, inward[roots])
        belief, rest = inward.copy(), np.zeros(self.n)
        for at in self.levels[1:]:
            nn, nc, cn, cc = pair[self.kind[at]].T
            rest[at] = belief[self.parent[at]] - up[at]
            belief[at] += np.logaddexp(nc, cc + rest[at]) - np.logaddexp(nn, cn + rest[at])
        both = pair[self.kind[below]] + np.stack([0 * rest, inward, rest, rest + inward], axis=1)[below]
        expected = np.exp(both - np.logaddexp.reduce(both, axis=1)[:, None])
        state = 2 * self.label[self.parent[below]] + self.label[below]
        value = self.importance @ (own * self.label - constant) + self.importance[below] @ pair[self.kind[below], state]
        expected[np.arange(len(below)), state] -= 1
        expected *= -self.importance[below, None]
        of_nodes = self.importance * (self.label - np.exp(-np.logaddexp(0, -belief)))
        of_pairs = [expected[self.kind[below] == k].sum(axis=0) for k in (0, 1)]
        return float(value), np.concatenate([np.bincount(self.column, of_nodes[self.row], len(self.names)), *of_pairs])


def made_up_trees(nodes: int) -> list[Tree]:
    """A part of each usual name with a longer and a shorter paragraph in it, for training with ``nodes`` others.
    Labelled pages show paragraphs as content enough, so there these speak for the other parts."""
    whole, of_content = max(100.0, 0.6 * nodes), 0.3 if nodes else 0.5
    trees = []
    for names, kind, share in ((USUALLY_CONTENT, True, of_content), (USUALLY_NOT, False, 1 - of_content)):
        for name in names:
            of, _, word = name.partition(":")
            begin, end = (f"<{word}>", f"</{word}>") if of == "t" else (f'<div class="{word}">', "</div>")
            page = parse(f"{begin}<p>{'some words of a reader or an author. ' * 2}</p><p>A few.</p>{end}")
            trees.append(
                Tree(
                    [p - 1 for p in page.parent[1:]],
                    page.features[1:],
                    [t is not None for t in page.text[1:]],
                    [kind] * (len(page.parent) - 1),
                    whole * share / len(names) / 2,
                )
            )
    return trees


def train(trees: list[Tree], rounds: int = 300, ridge: float = 0.02, made_up: bool = True) -> Model:
    """Weights and pair potentials by climbing the trees' likelihood, less ``ridge`` times half their squares."""
    forest = Forest(trees + (made_up_trees(sum(len(t.parent) for t in trees)) if made_up else []))
    theta, squares = np.zeros(len(forest.names) + 8), np.zeros(len(forest.names) + 8)
    for _ in range(rounds):
        slope = forest.likelihood(theta)[1] - ridge * theta
        squares += slope * slope
        theta += 0.5 * slope / np.sqrt(squares + 1e-9)
    elements, stretches = theta[-8:].reshape(2, 4).tolist()
    return Model({f: float(theta[k]) for f, k in forest.names.items()}, (tuple(elements), tuple(stretches)))


def one_of_each(pages: DataFrame, max_pages: int, *others: str) -> DataFrame:
    """page_id, html and ``others`` of about ``max_pages`` page_ids at most, chosen by their hash: of rows with one
    page_id the least by html and ``others``, rows with a null page_id left out."""
    known = pages.where("page_id is not null")
    few = hashed_sample(known.select("page_id").distinct(), "page_id", max_pages)
    # At most about max_pages numbers: the bound of this broadcast.
    rows = known.join(F.broadcast(few), "page_id", "left_semi").groupBy("page_id")
    return rows.agg(F.min(F.struct("html", *others)).alias("x")).select("page_id", "x.*")


def fit(labelled: DataFrame, max_training_rows: int = 300, max_nodes: int = 2000) -> Model:
    """Train from rows (page_id, html, text), one of each of about ``max_training_rows`` page_ids at most. Pages are
    read in tasks; at most ``max_nodes`` nodes of each, in page order, are what the driver gets."""

    def trees(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for row in batch.to_pylist():
                tree = labelled_tree(row["html"], row["text"], max_nodes)
                if tree:
                    yield pa.RecordBatch.from_pylist([{"page_id": row["page_id"], **tree._asdict()}], schema)

    of_node = {"parent": pa.int32(), "features": pa.list_(pa.string()), "is_text": pa.bool_(), "label": pa.bool_()}
    schema = pa.schema([("page_id", pa.int64()), *((k, pa.list_(t)) for k, t in of_node.items())])
    rows = one_of_each(labelled, max_training_rows, "text").select(F.col("page_id").cast("long"), "html", "text")
    found = rows.mapInArrow(trees, "page_id long, parent array<int>, features array<array<string>>, is_text array<boolean>, label array<boolean>")
    found = sorted(found.toArrow().to_pylist(), key=lambda r: r["page_id"])
    return train([Tree(*(r[k] for k in of_node)) for r in found])


def extract_pages(pages: DataFrame, model: Model) -> DataFrame:
    """page_id, url, text, n_chars for every row."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [extract(source, model) for source in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    known = pages.select(F.col("page_id").cast("long"), "url", "html")
    return known.mapInArrow(batches, "page_id long, url string, text string, n_chars long")
