"""Main text of web pages by a tree-structured graphical model.

A page becomes a tree: its block elements, and its blocks of text as leaves. Every node is
content or not. A node has a score from its features (tag, words in class and id, length, share
of link text, sentence marks); every edge between parent and child has a table of four
potentials. Two passes of messages, leaves to root and root to leaves (sum-product, exact on a
tree), give the probability that a block is content given the whole page. Blocks above one half
make the text.

The model is trained on labelled pages: a sample of at most ``TRAINING_PAGES`` pages that have an
``article`` or ``main`` element, chosen by a hash of the page id, whose semantic elements are
the labels. As other pages name things differently, each is also used with its containers
renamed and with further page furniture around its article (``variants``), made of texts of the
same sample, so the model cannot rest on the tag alone. Node scores are fitted by logistic regression and edge
tables by counting (piecewise training).

Edge cases: a null or empty html, or one without text, gives an empty text; unclosed elements
are closed as browsers do (a head also at the first thing that may not stand in it); formulas are text; repeated rows are extracted each; a missing end of a comment or
script drops the rest; without a single labelled page the weights that the package
carries are used (``PRIOR``); pages are read whole, whatever their length; an empty table gives an empty result; extra columns are ignored;
attributes other than class, id and role are never read from a page.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape
from random import Random
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAINING_PAGES = 150
#: Labels of the training pages. An element outside of these takes that of the one around it.
CONTENT_TAGS = {"article", "main"}
OTHER_TAGS = {"nav", "footer", "aside", "form"}
#: Inside of these, that there is an article around them says nothing.
FURNITURE = frozenset(OTHER_TAGS | {"menu", "ad", "side", "comment", "notice", "foot", "share"})
MEANING = frozenset(CONTENT_TAGS | OTHER_TAGS | {"header", "table", "blockquote", "pre", "figure"})

# Elements by their role in HTML.
BLOCK_TAGS = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul caption legend".split()
)
VOID_TAGS = set("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is never text of the page.
SILENT_TAGS = set("script style template noscript noframes iframe svg object textarea select button title head canvas audio video".split())
RAW_TAGS = {"script", "style", "textarea", "title", "iframe", "noscript", "noframes", "template"}
#: What may stand in a head. Any other start tag, or a text, ends a head that is still open.
HEAD_TAGS = set("base basefont bgsound head html link meta noframes noscript script style template title".split())
#: End tags that end it too; others are passed over there.
HEAD_ENDS = {"body", "html", "br"}
HTML_SPACE = " \t\n\f\r"
#: A start tag that ends an open element of these kinds, up to the border elements.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}}
BORDERS = {"ul", "ol", "dl", "table", "body", "html", "menu"}
#: Words in class and id by what they usually stand for.
FAMILIES = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs toc tabs pagination pager toolbar skip sitemap",
    "ad": "ad ads advert advertisement adverts banner promo promotion sponsor sponsored commercial adsense dfp",
    "side": "sidebar side aside widget widgets related recommended teaser trending popular rail secondary more",
    "comment": "comment comments disqus reply replies respond responses discussion reader readers feedback",
    "notice": "cookie cookies consent notice gdpr popup modal overlay alert newsletter subscribe signup paywall message",
    "form": "form login search contact register input",
    "foot": "footer foot bottom copyright legal disclaimer credits imprint",
    "head": "header masthead top branding logo topbar hero",
    "share": "share social sharing follow tags tag meta byline author",
    "content": "article content post entry main story body text page blog news prose",
}
FAMILY = {word: family for family, words in FAMILIES.items() for word in words.split()}

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>?""",
    re.DOTALL,
)
NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
WORD = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")


@dataclass
class Node:
    tag: str
    parent: int
    features: list[str] = field(default_factory=list)
    text: str | None = None
    label: int | None = None
    chars: int = 0
    linked: int = 0
    under: frozenset[str] = frozenset()


def parse(html: str, mark: str | None = None) -> list[Node]:
    """The block elements and texts of a page; parents come before their children. Only in
    training is there a ``mark``, the attribute that ``labelled`` writes labels into."""
    written = re.compile(rf'\s{mark}="([01])"') if mark else None
    nodes = [Node("#page", -1)]
    stack: list[tuple[str, int]] = [("#page", 0)]  # open elements with their node (or that around)
    parts: list[str] = []
    counts = [0, 0]  # characters of the block so far, and those in links
    silent = links = 0

    def flush() -> None:
        text = SPACE.sub(" ", "".join(parts)).strip()
        if text:
            nodes.append(Node("#text", stack[-1][1], text=text, chars=len(text), linked=min(len(text), counts[1])))
        parts.clear()
        counts[:] = [0, 0]

    # where each tag stands in the stack, so that no tag is looked for element by element
    places: dict[str, list[int]] = {}

    def last(tags) -> int:
        return max((places[tag][-1] for tag in tags if places.get(tag)), default=0)

    def push(tag: str, node: int) -> None:
        places.setdefault(tag, []).append(len(stack))
        stack.append((tag, node))

    def close(index: int) -> None:
        nonlocal silent, links
        gone = stack[index:]
        # the block's text still belongs to the open element
        if any(tag in BLOCK_TAGS for tag, _ in gone):
            flush()
        silent -= sum(tag in SILENT_TAGS for tag, _ in gone)
        links -= sum(tag == "a" for tag, _ in gone)
        for tag, _ in gone:
            places[tag].pop()
        del stack[index:]

    def close_open(kinds: set[str], borders: set[str]) -> None:
        at = last(kinds)
        if at and at >= last(borders):
            close(at)

    def leave_head() -> None:
        close_open({"head"}, SILENT_TAGS)

    at = 0
    while at < len(html):
        begin = html.find("<", at)
        found = TOKEN.match(html, begin) if begin >= 0 else None
        until = len(html) if begin < 0 else begin if found else begin + 1
        if until > at:
            text = unescape(html[at:until])
            if silent and text.strip(HTML_SPACE):
                leave_head()
            if not silent:
                parts.append(text)
                if links:
                    counts[1] += len(text.strip())
        at = until
        if not found:
            continue
        at = found.end()
        tag = (found[2] or found[5] or "").lower()
        if not tag:
            continue
        ends = bool(found[1] or found[4])
        if silent and (tag in HEAD_ENDS if ends else tag not in HEAD_TAGS):
            leave_head()
        if ends:
            if places.get(tag):
                close(places[tag][-1])
            continue
        attributes = found[3] or found[6] or ""
        if tag == "br":
            parts.append(" ")
        if tag in BLOCK_TAGS:
            close_open({"p"}, {"td", "th", "button", "body", "html", "table"})
            flush()
        if tag in ENDS:
            close_open(ENDS[tag], BORDERS)
        if tag in VOID_TAGS or (attributes.endswith("/") and tag in SILENT_TAGS):
            continue
        node = stack[-1][1]
        if tag in BLOCK_TAGS and not silent:
            nodes.append(Node(tag, node))
            node = len(nodes) - 1
            label = written.search(attributes) if written else None
            if label:
                nodes[node].label = int(label[1])
            for _, *values in NAMED.findall(attributes):
                value = next((v for v in values if v), "")
                known = {FAMILY[word] for word in WORD.findall(value.lower()) if word in FAMILY}
                nodes[node].features += [f"family={family}" for family in sorted(known)]
        push(tag, node)
        silent += tag in SILENT_TAGS
        links += tag == "a"
        if tag in RAW_TAGS:
            end = re.compile(rf"</{re.escape(tag)}", re.IGNORECASE).search(html, at)
            at = end.start() if end else len(html)
    flush()
    describe(nodes)
    return nodes


def describe(nodes: list[Node]) -> None:
    """Add the features that all nodes have."""
    for node in reversed(nodes[1:]):
        nodes[node.parent].chars += node.chars
        nodes[node.parent].linked += node.linked
    for k, node in enumerate(nodes):
        # what stands around a node: names of containers and elements with a meaning
        around = nodes[node.parent] if k else node
        own = {name[7:] for name in node.features if name.startswith("family=")}
        node.under = around.under | own | ({node.tag} & MEANING)
        furniture = node.under & FURNITURE
        node.features += [f"under={name}" for name in sorted(furniture or node.under)]
        share = node.linked / node.chars if node.chars else 0.0
        size = 0 if not node.chars else min(5, int(math.log(node.chars, 4)))
        kind = "text" if node.text is not None else "element"
        node.features += ["bias", f"{kind} size={size}", f"{kind} links={min(3, int(share * 4))}"]
        if node.text is None:
            node.features.append(f"tag={node.tag}")
        else:
            words = node.text.count(" ") + 1
            node.features += [
                f"in={nodes[node.parent].tag}",
                f"ends={node.text[-1] in '.!?…»”’)'}",
                f"sentences={min(3, sum(node.text.count(mark) for mark in ('. ', '! ', '? ')))}",
                f"words={min(4, int(math.log(words, 3)))}",
                f"sign={any(sign in node.text for sign in '©·»')}",
            ]


@dataclass
class Model:
    """Weights of features and log-odds tables of edges, by the kind of the child."""

    weights: dict[str, float]
    edges: dict[str, tuple[float, float, float, float]]

    def score(self, node: Node) -> float:
        return sum([self.weights.get(name, 0.0) for name in node.features])


def kind_of(node: Node) -> str:
    return "text" if node.text is not None else "element"


def softplus(x: float) -> float:
    return x + math.log1p(math.exp(-x)) if x > 0 else math.log1p(math.exp(x))


def passed(belief: float, table: tuple[float, float, float, float]) -> float:
    """The message over an edge, as log-odds for the receiver, from the sender's log-odds.
    ``table`` holds log potentials for (receiver, sender) = 00, 01, 10, 11."""
    zero = table[0] + softplus(belief + table[1] - table[0])
    one = table[2] + softplus(belief + table[3] - table[2])
    return one - zero


def marginals(nodes: list[Node], model: Model) -> list[float]:
    """Log-odds of every node being content, by sum-product over the tree."""
    up = [model.score(node) for node in nodes]
    message = [0.0] * len(nodes)
    for k in range(len(nodes) - 1, 0, -1):  # children come after their parents
        message[k] = passed(up[k], model.edges[kind_of(nodes[k])])
        up[nodes[k].parent] += message[k]
    full = list(up)
    for k in range(1, len(nodes)):
        a, b, c, d = model.edges[kind_of(nodes[k])]
        full[k] = up[k] + passed(full[nodes[k].parent] - message[k], (a, c, b, d))
    return full


def main_text(html: str | None, model: Model) -> str:
    """The blocks that are content, in page order."""
    nodes = parse(html or "")
    odds = marginals(nodes, model)
    return "\n".join(node.text for node, x in zip(nodes, odds, strict=True) if node.text is not None and x > 0)


# -- training ---------------------------------------------------------------------------------

RENAMED = {
    "article": ('div class="{}"', ["post-content", "entry", "article-body", "content", "story", "main-text", "x1"]),
    "nav": ('div class="{}"', ["menu", "navbar", "top-nav", "breadcrumbs", "site-menu", "x2"]),
    "footer": ('div class="{}"', ["footer", "bottom", "page-foot", "legal", "x3"]),
}
SHORT = ("Home", "News", "About us", "Contact", "Log in", "Search", "Privacy", "Help", "More", "Archive")
OTHERS = (
    '<aside>{links}</aside>', '<aside><p>{prose}</p></aside>', '<div class="sidebar"><p>{prose}</p></div>',
    '<div id="comments"><p>{prose}</p></div>', '<div class="comment"><p>{prose}</p></div>',
    '<div class="sidebar"><h3>{short}</h3>{links}</div>', '<div class="widget related">{links}</div>',
    '<section id="comments"><h3>{short}</h3><div class="comment"><p>{prose}</p></div><div class="comment"><p>{prose}</p></div></section>',
    '<div class="comments"><ul><li>{prose}</li><li>{prose}</li></ul></div>',
    '<div class="cookie-notice">{prose}</div>', '<div class="notice"><p>{prose}</p></div>',
    '<div class="ad">{prose}</div>', '<div class="advert banner">{prose}</div>', '<div class="sponsored promo"><p>{prose}</p></div>',
    '<form><p>{short}</p><label>{short}</label></form>', '<div class="newsletter"><p>{prose}</p></div>',
    '<header><h1>{short}</h1><p>{short}</p></header>', '<div class="header">{short}</div>', '<div class="share">{links}</div>',
)


def labelled(html: str, mark: str) -> str | None:
    """The page with its labels written at its semantic elements, as values of the attribute
    ``mark``; None if it has none."""
    if not re.search(r"<(article|main)[\s>]", html):
        return None
    html = re.sub(rf"<({'|'.join(sorted(CONTENT_TAGS))})(?=[\s>])", rf'<\1 {mark}="1"', html)
    html = re.sub(rf"<({'|'.join(sorted(OTHER_TAGS))})(?=[\s>])", rf'<\1 {mark}="0"', html)
    return re.sub(r"<body(?=[\s>])", f'<body {mark}="0"', html)


def variants(html: str, prose: list[str], random: Random, mark: str) -> list[str]:
    """A labelled page as it is, and with containers renamed and furniture added."""
    out = [html]
    for _ in range(5):
        page = html
        for tag, (shape, names) in RENAMED.items():
            if random.random() < 0.6:
                page = re.sub(rf"<{tag}\b", "<" + shape.format(random.choice(names)), page)
                page = page.replace(f"</{tag}>", "</div>")

        def furniture() -> str:
            links = "<ul>" + "".join(f'<li><a href="/">{random.choice(SHORT)}</a></li>' for _ in range(4)) + "</ul>"
            made = random.choice(OTHERS).format(
                links=links, short=random.choice(SHORT), prose=" ".join(random.choice(prose).split()[:40]))
            return re.sub(r"^<(\w+)", rf'<\1 {mark}="0"', made)

        start = re.search(rf'<(?:article|main|div class="[^"]*") {mark}="1"', page)
        if start:
            page = page[: start.start()] + furniture() + furniture() + page[start.start() :]
        inside = page.rfind("</p>")
        if inside > 0 and random.random() < 0.7:
            page = page[: inside + 4] + furniture() + page[inside + 4 :]
        end = page.find("</body>")
        end = len(page) if end < 0 else end
        out.append(page[:end] + furniture() + furniture() + page[end:])
    return out


def spread_labels(nodes: list[Node]) -> list[int]:
    """A label for every node: texts take that of the nearest labelled element around them,
    elements are content if most of their text is."""
    labels = [0] * len(nodes)
    for k, node in enumerate(nodes):
        labels[k] = node.label if node.label is not None else labels[node.parent] if k else 0
    inside, whole = [0.0] * len(nodes), [0.0] * len(nodes)
    for k in range(len(nodes) - 1, 0, -1):
        if nodes[k].text is not None:
            inside[k], whole[k] = labels[k] * nodes[k].chars, nodes[k].chars
        inside[nodes[k].parent] += inside[k]
        whole[nodes[k].parent] += whole[k]
    return [
        labels[k] if node.text is not None or not whole[k] else int(2 * inside[k] > whole[k])
        for k, node in enumerate(nodes)
    ]


def train(pages: list[str], seed: int = 3, steps: int = 250) -> Model:
    """Fit the model to pages that have labels."""
    random = Random(seed)
    mark = f"data-{uuid4().hex}"  # a name of this run, which no page has; no result depends on it
    sources = [page for page in (labelled(html, mark) for html in pages) if page]
    prose = [node.text for page in sources[:50] for node in parse(page, mark)
             if node.text is not None and len(node.text) > 80] or ["Text."]
    trees = [parse(page, mark) for source in sources for page in variants(source, prose, random, mark)]
    if not trees:
        return PRIOR
    names: dict[str, int] = {}
    rows, columns, labels = [], [], []
    counts = {kind: np.ones((2, 2)) for kind in ("text", "element")}
    for nodes in trees:
        found = spread_labels(nodes)
        for k, node in enumerate(nodes):
            for name in node.features:
                rows.append(len(labels))
                columns.append(names.setdefault(name, len(names)))
            labels.append(found[k])
            if k:
                counts[kind_of(node)][found[node.parent], found[k]] += 1
    x = np.zeros((len(labels), len(names)), np.float32)
    x[rows, columns] = 1
    y = np.asarray(labels, np.float32)
    weights, slope = np.zeros(len(names), np.float32), np.zeros(len(names), np.float32)
    for _ in range(steps):
        gradient = x.T @ (1 / (1 + np.exp(-x @ weights)) - y) / len(y) + 1e-4 * weights
        slope = 0.9 * slope + gradient
        weights -= 1.0 * slope
    edges = {}
    for kind, table in counts.items():
        # how much more often a pair of labels occurs than by chance
        share = table / table.sum()
        chance = share.sum(axis=1, keepdims=True) * share.sum(axis=0, keepdims=True)
        edges[kind] = tuple(float(v) for v in np.log(share / chance).ravel())
    return Model({name: float(weights[k]) for name, k in names.items()}, edges)


#: Used only where no page of the table has a label.
PRIOR = Model(
    {"bias": -0.5, "under=article": 2.0, "under=main": 1.5, "under=nav": -4.0, "under=footer": -4.0,
     "under=aside": -3.0, "under=form": -3.0, "under=header": -2.0, "text links=3": -3.0, "text size=3": 1.0, "text size=4": 2.0, "text size=5": 2.0,
     "ends=True": 0.5, **{f"under={name}": -3.0 for name in FAMILIES if name != "content"}, "under=content": 1.5},
    {"text": (0.7, -1.0, -1.0, 0.7), "element": (0.5, -0.7, -0.7, 0.5)},
)


def training_pages(pages: DataFrame, at_most: int = TRAINING_PAGES) -> list[str]:
    """A bounded sample of pages with labels, the same at every run.

    The pages are chosen by their ids; only the chosen ones are sent with their text, one per id.
    """
    semantic = pages.filter(F.col("html").rlike(r"<(article|main)[\s>]") & F.col("page_id").isNotNull())
    places = semantic.select("page_id").distinct().orderBy(F.xxhash64("page_id", F.lit(11)), "page_id")
    chosen = [row.page_id for row in places.limit(at_most).collect()]
    found = semantic.filter(F.col("page_id").isin(chosen)).groupBy("page_id").agg(F.min("html").alias("html"))
    texts = {row.page_id: row.html for row in found.collect()}
    return [texts[key] for key in chosen]


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page."""

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html.as_py(), model) for html in batch.column("html")]
            yield pa.record_batch({
                "page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(texts, pa.string()),
                "n_chars": pa.array([len(text) for text in texts], pa.int64()),
            })

    shape = "page_id bigint, url string, text string, n_chars bigint"
    return pages.select("page_id", "url", "html").mapInArrow(extracted, shape)
