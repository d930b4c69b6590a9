"""Main text of web pages by a graphical model on the document tree.

The nodes are a page's block elements and the runs of text between block boundaries; each is main
text or not. A node's own features (tag, words of its class and id, text statistics) give its
potential, and a table for parent and child says how the two go together. As the graph is a tree,
messages passed once upward and once downward give the exact probability of every node. Text
runs more likely main text than not are kept.

The model is trained by gradient ascent on labelled pages: at most ``TRAINING_PAGES`` pages that
mark their article, each also in variants with other markup and more around the article.
"""

from __future__ import annotations

import collections
import html as references
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parityframe.llm.words import free_name, small_batches

TRAINING_PAGES = 80
TRAINING_CHARACTERS = 20_000

BLOCKS = set(
    "html body main article section div header footer nav aside p h1 h2 h3 h4 h5 h6 ul ol li dl dt "
    "dd table thead tbody tfoot tr td th caption blockquote pre form fieldset legend figure "
    "figcaption address hr details summary dialog center noscript button label menu".split()
)
VOID = set("br hr img input meta link area base col embed source track wbr".split())
#: Elements whose content is no text of the page; without an end tag only the start tag goes.
SKIPPED = set("template iframe select textarea title".split())
#: Of these everything up to the end tag is code, or up to the end of the page without one.
CODE = set("script style".split())
#: A start tag of the key ends an open element of the value, up to an element of the last set.
ENDED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^\"'>])*)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)>",
    re.S,
)
_END = {tag: re.compile(rf"</{tag}\b[^>]*>", re.I) for tag in SKIPPED | CODE}
_NAMES = re.compile(r"\b(?:class|id|role|data-y)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_LABEL = re.compile(r"data-y=\"([01])\"")

#: Words of class and id names by what they speak for.
WORDS = {
    "main": "article content post entry main story body text",
    "menu": "nav menu navbar breadcrumb breadcrumbs toc pagination",
    "edge": "header masthead footer copyright top bottom",
    "side": "sidebar side aside widget related recommended recommendations more",
    "advert": "ad ads advert advertisement banner promo sponsored sponsor",
    "notice": "cookie cookies consent notice alert modal popup newsletter subscribe warning",
    "reader": "comment comments reply replies disqus respond discussion reviews",
    "form": "form login search signup register share social",
}
_KIND = {word: kind for kind, words in WORDS.items() for word in words.split()}
_TAGS = [
    "article", "main", "section", "div", "p", "nav", "header", "footer", "aside", "form", "li",
    "blockquote", "button", "label", "noscript", "dialog",
]
FEATURES = (
    ["bias", "run", "heading", "table"]
    + [f"tag {t}" for t in _TAGS]
    + [f"word {k}" for k in WORDS]
    + ["long", "medium", "tiny", "linked", "stop", "copyright"]
    + ["under main", "under other"]  # what the nearest telling element around it speaks for
)
_AT = {name: k for k, name in enumerate(FEATURES)}


@dataclass
class Tree:
    parents: list[int] = field(default_factory=list)
    features: list[list[int]] = field(default_factory=list)
    texts: list[str | None] = field(default_factory=list)
    labels: list[int] = field(default_factory=list)


def parse(page: str) -> Tree:
    """The tree of a page: elements (text None) and runs of text, in page order."""
    tree = Tree()
    stack: list[tuple[str, int, int, list[int]]] = []  # tag, node, label, what it is under
    opened: collections.Counter[str] = collections.Counter()  # tags on the stack
    endless: set[str] = set()
    inline: list[str] = []
    links = 0
    linked = 0
    size = 0

    def add(parent: int, features: list[int], text: str | None, label: int) -> int:
        tree.parents.append(parent)
        tree.features.append(features)
        tree.texts.append(text)
        tree.labels.append(label)
        return len(tree.parents) - 1

    def close(k: int) -> None:
        for tag, *_ in stack[k:]:
            opened[tag] -= 1
        del stack[k:]

    def flush() -> None:
        nonlocal linked, size
        text = " ".join("".join(inline).split())
        inline.clear()
        if text:
            _, parent, label, under = stack[-1] if stack else ("", -1, 0, [])
            add(parent, _run_features(text, linked, size) + under, text, label)
        linked = size = 0

    at = 0
    while at < len(page):
        start = page.find("<", at)
        match = _TOKEN.match(page, start) if start >= 0 else None
        end = len(page) if start < 0 else start if match else start + 1
        if end > at:
            piece = references.unescape(page[at:end])
            inline.append(piece)
            size += len(piece)
            linked += len(piece) if links else 0
        if match is None:
            at = end
            continue
        at = match.end()
        closing, tag, rest = (match[1], match[2], match[3]) if match[2] else match.group(4, 5, 6)
        if not tag:
            continue
        tag = tag.lower()
        if tag in SKIPPED or tag in CODE:
            if not closing and not rest.rstrip().endswith("/") and tag not in endless:
                found = _END[tag].search(page, at)
                if found:
                    at = found.end()
                elif tag in CODE:
                    at = len(page)
                else:
                    endless.add(tag)  # there is no end tag further on either
            inline.append(" ")
        elif tag == "a":
            links = 0 if closing else 1
        elif tag == "br":
            inline.append(" ")
        elif tag in BLOCKS:
            flush()
            links = 0
            if closing:
                if opened[tag]:
                    k = len(stack) - 1
                    while stack[k][0] != tag:
                        k -= 1
                    close(k)
                continue
            if any(s[0] == "p" for s in stack[-1:]):
                close(len(stack) - 1)
            if tag in ENDED_BY:
                ended, limit = ENDED_BY[tag]
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in limit:
                        break
                    if stack[k][0] in ended:
                        close(k)
                        break
            _, parent, label, under = stack[-1] if stack else ("", -1, 0, [])
            told = _LABEL.search(rest)
            label = int(told[1]) if told else label
            features = _element_features(tag, rest)
            under = _told(features) or under
            node = add(parent, features + under, None, label)
            if tag not in VOID:
                stack.append((tag, node, label, under))
                opened[tag] += 1
    flush()
    return tree


def _element_features(tag: str, rest: str) -> list[int]:
    on = [_AT["bias"]]
    if tag in _TAGS:
        on.append(_AT[f"tag {tag}"])
    elif tag[0] == "h" and tag[1:].isdigit():
        on.append(_AT["heading"])
    elif tag in ("table", "tbody", "thead", "tr", "td", "th"):
        on.append(_AT["table"])
    names = " ".join(a or b or c for a, b, c in _NAMES.findall(rest)) if rest else ""
    kinds = {_KIND[w] for w in re.split(r"[^a-z]+", names.lower()) if w in _KIND}
    return on + sorted(_AT[f"word {k}"] for k in kinds)


_OTHER = {_AT[f"tag {t}"] for t in ("nav", "header", "footer", "aside", "form", "dialog")}
_OTHER |= {_AT[f"word {k}"] for k in WORDS if k != "main"}
_MAINLY = {_AT["tag article"], _AT["tag main"], _AT["word main"]}


def _told(features: list[int]) -> list[int]:
    if _OTHER.intersection(features):
        return [_AT["under other"]]
    return [_AT["under main"]] if _MAINLY.intersection(features) else []


def _run_features(text: str, linked: int, size: int) -> list[int]:
    words = text.count(" ") + 1
    on = [_AT["bias"], _AT["run"]]
    on.append(_AT["long"] if words >= 25 else _AT["medium"] if words >= 8 else _AT["tiny"])
    if 2 * linked > size:
        on.append(_AT["linked"])
    if text[-1] in ".!?":
        on.append(_AT["stop"])
    if "©" in text:
        on.append(_AT["copyright"])
    return on


class Model:
    """Potentials: ``weights`` per feature, ``pairs[kind, parent, child]`` (kind 1: text run)."""

    def __init__(self):
        self.weights = np.zeros(len(FEATURES))
        self.pairs = np.zeros((2, 2, 2))

    def marginals(self, forest: Forest) -> tuple[np.ndarray, np.ndarray]:
        """Probability of main text per node, and of (parent, child) per node with a parent."""
        own = np.zeros((forest.n, 2))
        own[:, 1] = np.add.reduceat(self.weights[forest.flat], forest.starts) if forest.n else 0
        psi = self.pairs[forest.kind]  # node, parent's value, own value
        up = own.copy()
        message = np.zeros((forest.n, 2))
        for level in reversed(forest.levels):  # from the leaves to the roots
            total = psi[level] + up[level][:, None, :]
            message[level] = np.logaddexp(total[:, :, 0], total[:, :, 1])
            inner = level[forest.parent[level] >= 0]
            np.add.at(up, forest.parent[inner], message[inner])
        down = np.zeros((forest.n, 2))
        both = np.zeros((forest.n, 2, 2))
        for level in forest.levels:  # from the roots to the leaves
            inner = level[forest.parent[level] >= 0]
            above = forest.parent[inner]
            rest = down[above] + up[above] - message[inner]
            joint = rest[:, :, None] + psi[inner] + up[inner][:, None, :]
            both[inner] = joint
            down[inner] = np.logaddexp.reduce(rest[:, :, None] + psi[inner], axis=1)
        belief = up + down
        belief -= np.logaddexp.reduce(belief, axis=1)[:, None]
        inner = np.flatnonzero(forest.parent >= 0)
        joint = both[inner]
        joint -= np.logaddexp.reduce(joint.reshape(-1, 4), axis=1)[:, None, None]
        both[inner] = np.exp(joint)
        return np.exp(belief[:, 1]), both

    def train(self, trees: list[Tree], rounds: int = 200, rate: float = 0.3) -> Model:
        """Gradient ascent (Adam) on the likelihood of the labels, with a small ridge."""
        forest = Forest(trees)
        labels = np.array([y for t in trees for y in t.labels])
        inner = np.flatnonzero(forest.parent >= 0)
        target = np.zeros_like(self.pairs)
        parents = labels[forest.parent[inner]]
        np.add.at(target, (forest.kind[inner], parents, labels[inner]), 1)
        value = np.concatenate([self.weights, self.pairs.ravel()])
        first, second = np.zeros_like(value), np.zeros_like(value)
        for step in range(1, rounds + 1):
            p, both = self.marginals(forest)
            wrong = np.repeat(labels - p, np.diff([*forest.starts, len(forest.flat)]))
            gradient = np.bincount(forest.flat, wrong, len(FEATURES))
            expected = np.zeros_like(self.pairs)
            np.add.at(expected, forest.kind[inner], both[inner])
            gradient = np.concatenate([gradient, (target - expected).ravel()]) / forest.n
            gradient -= 1e-4 * value
            first = 0.9 * first + 0.1 * gradient
            second = 0.99 * second + 0.01 * gradient**2
            move = (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
            value = value + rate * move * (1 - step / (rounds + 1))
            self.weights = value[: len(FEATURES)]
            self.pairs = value[len(FEATURES) :].reshape(2, 2, 2)
        return self

    def extract(self, pages: list[str]) -> list[str]:
        """The main text of every page."""
        trees = [parse(page) for page in pages]
        p, _ = self.marginals(Forest(trees))
        out, at = [], 0
        for tree in trees:
            chosen = p[at : at + len(tree.parents)]
            out.append("\n".join(t for t, q in zip(tree.texts, chosen) if t and q > 0.5))
            at += len(tree.parents)
        return out


class Forest:
    """Several trees as arrays, with their nodes by depth."""

    def __init__(self, trees: list[Tree]):
        self.n = sum(len(t.parents) for t in trees)
        parent, base = [], 0
        for t in trees:
            parent += [p + base if p >= 0 else -1 for p in t.parents]
            base += len(t.parents)
        self.parent = np.array(parent, np.int64)
        self.kind = np.array([int(x is not None) for t in trees for x in t.texts], np.int64)
        features = [f for t in trees for f in t.features]
        self.flat = np.array([k for f in features for k in f], np.int64)
        lengths = np.array([len(f) for f in features], np.int64)
        self.starts = np.cumsum(lengths) - lengths
        depth = np.zeros(self.n, np.int64)
        for k, p in enumerate(parent):  # a parent comes before its children
            depth[k] = depth[p] + 1 if p >= 0 else 0
        order = np.argsort(depth, kind="stable")
        cuts = np.flatnonzero(np.diff(depth[order])) + 1
        self.levels = np.split(order, cuts) if self.n else []


# --- labelled pages ----------------------------------------------------------------------

_FALLBACK = [
    "<html><body><nav><ul><li><a href='/a'>Home</a></li></ul></nav><article><h1>A title</h1>"
    "<p>Some words make a sentence here, and more of them follow.</p><p>Short.</p>"
    "</article><footer>&copy; Some site</footer></body></html>"
]
_MAIN = [
    ("<article>", "</article>"),
    ("<main>", "</main>"),
    ('<div class="content">', "</div>"),
    ('<div id="post-body">', "</div>"),
    ('<section class="entry-content">', "</section>"),
    ('<div class="wrap"><div class="article-text">', "</div></div>"),
]
_AROUND = [
    '<header><p>{0}</p></header>', '<div class="header">{0}</div>', '<aside><p>{0}</p><p>{1}</p></aside>',
    '<div class="sidebar"><h3>{2}</h3><p>{0}</p></div>', '<div class="cookie-notice"><p>{0}</p></div>',
    '<div class="notice">{0}</div>', '<form><p>{0}</p><label>{2}</label><button>{2}</button></form>',
    '<div class="newsletter"><form>{0}<input><button>{2}</button></form></div>',
    '<section class="comments"><h2>{2}</h2><div class="comment"><p>{0}</p></div><div class="comment"><p>{1}</p></div></section>',
    '<div id="comments"><ul><li><p>{0}</p></li><li>{1}</li></ul></div>', '<div class="ad">{0}</div>',
    '<div class="advert banner"><p>{1}</p></div>', '<div class="related"><ul><li><a href="#">{0}</a></li></ul></div>',
    '<div class="menu"><a href="/">{2}</a> <a href="/x">{2}</a></div>', '<nav><p>{2}</p></nav>',
    '<div class="footer"><p>{0}</p></div>', '<footer><p>{0}</p><p>&copy; {2}</p></footer>',
]


def labelled(pages: list[str], seed: int = 7) -> list[str]:
    """Training pages with ``data-y`` marks, made of pages that mark their article."""
    rng = random.Random(seed)
    marked = [p for p in pages if len(re.findall(r"<article\b", p)) == 1 and "</article>" in p]
    if len(marked) < 3:
        marked += _FALLBACK * 3
    sentences = [
        references.escape(t)
        for p in marked[:20]
        for t in parse(p).texts
        if t and len(t.split()) > 2
    ] or ["Some words of a page."]
    out = []
    for page in marked:
        out.append(re.sub(r"<article\b", '<article data-y="1"', page))
        head, rest = re.split(r"<article\b[^>]*>", page, maxsplit=1)
        body, tail = rest.split("</article>", 1)

        def block() -> str:
            picked = [rng.choice(sentences) for _ in range(2)]
            words = rng.choice(sentences).split()[: rng.randint(1, 3)]
            return rng.choice(_AROUND).format(*picked, " ".join(words))

        for _ in range(2):
            opening, closing = rng.choice(_MAIN)
            opening = re.sub(r"<(\w+)", r'<\1 data-y="1"', opening)
            if rng.random() < 0.5:  # something foreign inside the article
                inner = re.sub(r"^<(\w+)", r'<\1 data-y="0"', block())
                body_now = body + inner if rng.random() < 0.5 else inner + body
            else:
                body_now = body
            before = "".join(block() for _ in range(rng.randint(0, 3)))
            after = "".join(block() for _ in range(rng.randint(0, 3)))
            out.append(head + before + opening + body_now + closing + after + tail)
    return out


def train(pages: DataFrame, html: str = "html", sample: int = TRAINING_PAGES) -> Model:
    """A model trained on the ``sample`` pages with the smallest hashes that mark an article."""
    source = F.col(html).cast("string")
    usable = pages.select(source.alias("h")).filter(
        F.col("h").contains("<article") & (F.length("h") <= TRAINING_CHARACTERS)
    )
    mark = F.xxhash64("h")
    low = usable.select(mark.alias("m")).orderBy("m").limit(sample).agg(F.max("m")).first()[0]
    rows = [] if low is None else usable.filter(mark <= low).limit(2 * sample).collect()
    return Model().train([parse(p) for p in labelled(sorted({r["h"] for r in rows}))])


def extract(
    pages: DataFrame, html: str = "html", model: Model | None = None, into: str = "text"
) -> DataFrame:
    """``pages`` with the main text in the column ``into``; ``html`` is dropped.

    Blocks are joined by one newline in page order, white space inside a block is one space,
    character references are decoded. A null or empty page gives an empty text; pages of any
    form, broken ones too, give what their tree yields. Repeated pages get the same text, and a
    column named ``into`` is replaced. One pass without a shuffle.
    """
    small_batches(pages.sparkSession, 500)
    fitted = model or train(pages, html)
    columns = [c for c in pages.columns if c not in (html, into)]
    body = free_name(pages, "_html")
    rows = pages.withColumn(body, F.coalesce(F.col(html).cast("string"), F.lit("")))
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in columns), f"`{into}` string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = fitted.extract(batch.column(body).to_pylist())
            arrays = [batch.column(c) for c in columns] + [pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, [*columns, into])

    return rows.select(*columns, body).mapInArrow(run, schema)
