"""Main text of web pages by a tree-structured graphical model.

Each element of a page that makes a block is a node with one of three states: wrapper, content,
boilerplate. A node's features (tag, words of class and id, length and links of its own text) give
its own potential, a parent and child have a joint one. Sum-product messages go up from the leaves
and down from the root, which on a tree gives exact marginals; text whose node is most likely content
is kept. All potentials are counted on labelled pages.

The pages are independent, so the work is one pass without a shuffle.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from html import unescape
from itertools import product
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WRAPPER, CONTENT, BOILERPLATE = range(3)
STATES = (WRAPPER, CONTENT, BOILERPLATE)
LABEL = "data-label"
SMOOTH = 0.5  # of states and edges
SMOOTH_FEATURE = 1.0

# Fixed values of HTML: elements without end tag, elements within a line, elements whose text is not
# shown, and elements that end an open paragraph.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby s "
    "samp small span strike strong sub sup time tt u var wbr".split()
)
HIDDEN = set("script style template head title noscript iframe svg object canvas audio video select textarea button".split())
RAW = "script|style|textarea|title|noscript|iframe|template"
ENDS_P = set(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main menu nav ol p pre section table ul".split()
)
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BARE = {"#page", "html", "body"}
FENCES = {"ul", "ol", "dl", "table", "menu"}
KEEP_P = HIDDEN | FENCES | {"td", "th", "li", "button"}
BLOCKS = FENCES | ENDS_P

#: Attributes up to the end of a tag. A quote opens a value only behind "=", and only if it is closed.
_MARKS = r"(?:=\s*+(?:\"[^\"]*+\"|'[^']*+')|[^>])*+"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(?P<raw>{RAW})(?=[\s/>]|\Z){_MARKS}(?:>.*?(?:</(?P=raw)\s*>|\Z)|\Z)"
    r"|</(?P<end>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    rf"|<(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>{_MARKS})(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_ATTR = re.compile(r"([^\s=\"'>/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_SPACE = re.compile(r"[\x20\x09-\x0D]+")


class Node:
    __slots__ = ("parent", "tag", "words", "label", "n_chars", "n_link", "n_stops")

    def __init__(self, parent: int, tag: str, words: frozenset[str], label: str | None):
        self.parent, self.tag, self.words, self.label = parent, tag, words, label
        self.n_chars = self.n_link = self.n_stops = 0


class Page(NamedTuple):
    nodes: list[Node]  # parents before children
    runs: list[tuple[int, int, str]]  # text in page order: (node, block, text)


def parse(html: str) -> Page:
    """The page's nodes, and its shown text with the node and the block each piece belongs to."""
    nodes = [Node(-1, "#page", frozenset(), None)]
    stack: list[tuple[str, int]] = [("#page", 0)]  # open elements with the node they stand in
    runs: list[tuple[int, int, str]] = []
    places: dict[str, list[int]] = defaultdict(list)  # of the open elements of each tag
    block, hidden, links = 0, 0, 0

    def close(depth: int) -> None:
        nonlocal hidden, links, block
        while len(stack) > depth:
            tag, _ = stack.pop()
            places[tag].pop()
            hidden -= tag in HIDDEN
            links -= tag == "a"
            block += tag not in INLINE

    def top(tags: set[str]) -> int:
        return max((places[t][-1] for t in tags & places.keys() if places[t]), default=0)

    def last(tags: set[str], fences: set[str]) -> int | None:
        """The place of the innermost of some open elements, if none of the fences stands inside it."""
        at = top(tags)
        return at if at and at >= top(fences) else None

    for m in _TOKEN.finditer(html):
        kind = m.lastgroup
        if kind == "text":
            if hidden:
                continue
            text = unescape(m["text"])
            owner = stack[-1][1]
            shown = _SPACE.sub("", text)
            if shown and nodes[owner].tag in BARE:  # text that stands in no element is a node of its own
                nodes.append(Node(owner, "#text", frozenset(), None))
                owner = len(nodes) - 1
            node = nodes[owner]
            node.n_chars += len(shown)
            node.n_link += len(shown) if links else 0
            node.n_stops += sum(text.count(c) for c in ".!?")
            runs.append((owner, block, text))
        elif kind == "end":
            tag = m["end"].lower()
            at = last({tag}, FENCES - {tag} if tag in SIBLINGS else set())
            if at is not None and (tag not in INLINE or at > top(BLOCKS)):
                close(at)
            elif tag == "p":
                block += 1
        elif kind in ("attrs", "tag"):
            tag = m["tag"].lower()
            if tag in ENDS_P and (at := last({"p"}, KEEP_P)) is not None:
                close(at)
            if tag in SIBLINGS and (at := last(SIBLINGS[tag], FENCES)) is not None:
                close(at)
            if tag == "br" and not hidden:
                runs.append((stack[-1][1], block, " "))
            inside, marks = stack[-1][1], m["attrs"] or ""
            found = _ATTR.findall(marks) if "=" in marks else []
            attrs = {k.lower(): a or b or c for k, a, b, c in found}
            named = " ".join(attrs.get(k, "") for k in ("class", "id", "role"))
            if tag in VOID or marks.endswith("/"):
                block += tag not in INLINE
                continue
            if tag not in INLINE or named.strip():
                words = frozenset(w.rstrip("s") or w for w in _WORDS.findall(_CAMEL.sub(" ", named).lower()))
                nodes.append(Node(inside, tag, words, attrs.get(LABEL)))
                inside = len(nodes) - 1
            places[tag].append(len(stack))
            stack.append((tag, inside))
            hidden += tag in HIDDEN
            links += tag == "a"
            block += tag not in INLINE
    return _without_shells(Page(nodes, runs))


def _without_shells(page: Page) -> Page:
    """Leaves out nodes that tell nothing: elements without a name or text of their own, around a single node."""
    nodes = page.nodes
    children = [0] * len(nodes)
    for node in nodes[1:]:
        children[node.parent] += 1
    place, kept = [0] * len(nodes), [nodes[0]]
    for k, node in enumerate(nodes[1:], 1):
        node.parent = place[node.parent]
        if node.tag == "div" and not node.words and not node.label and not node.n_chars and children[k] == 1:
            place[k] = node.parent
        else:
            place[k] = len(kept)
            kept.append(node)
    return Page(kept, [(place[n], block, text) for n, block, text in page.runs])


def features(node: Node) -> list[str]:
    out = [f"tag={node.tag}", *(f"word={w}" for w in sorted(node.words))]
    n = node.n_chars
    out.append(f"chars={0 if not n else 1 + min(int(math.log2(n)) // 2, 4)}")
    if n:
        out.append(f"links={min(int(3 * node.n_link / n), 2)}")
        out.append(f"stops={node.n_stops > 0}")
    return out


class Model(NamedTuple):
    """Logarithms: start by state, edges by parent and child state, features by state."""

    start: list[float]
    edges: list[list[float]]
    seen: dict[str, list[float]]

    def own(self, node: Node) -> list[float]:
        out = [0.0, 0.0, 0.0]
        for f in features(node):
            if (w := self.seen.get(f)) is not None:
                for s in STATES:
                    out[s] += w[s]
        return out


def train(pages: Iterable[str]) -> Model:
    """Counts potentials on pages whose elements carry LABEL.

    An element without a label has its parent's; text that stands in no element is content.
    """
    names = {"wrapper": WRAPPER, "content": CONTENT, "boilerplate": BOILERPLATE}
    start, edges, kinds = [SMOOTH] * 3, [[SMOOTH] * 3 for _ in STATES], [0.0] * 3
    seen: dict[str, list[float]] = defaultdict(lambda: [SMOOTH_FEATURE] * 3)
    for html in pages:
        states: list[int] = []
        for node in parse(html).nodes:
            above = states[node.parent] if states else WRAPPER
            state = names[node.label] if node.label else CONTENT if node.tag == "#text" else above
            states.append(state)
            if node.parent < 0:
                start[state] += 1
            else:
                edges[above][state] += 1
            kinds[state] += 1
            for f in features(node):
                seen[f][state] += 1
    log = lambda row: [math.log(x / sum(row)) for x in row]
    return Model(log(start), [log(r) for r in edges], {f: [math.log(c[s] / (kinds[s] + 2 * SMOOTH_FEATURE)) for s in STATES] for f, c in seen.items()})


def _log_sum(x: list[float]) -> float:
    top = max(x)
    return top + math.log(sum(math.exp(v - top) for v in x))


def marginals(nodes: list[Node], model: Model) -> list[list[float]]:
    """Probability of each state of each node: messages upward, then downward."""
    up = [model.own(n) for n in nodes]
    sent: list[list[float]] = [[]] * len(nodes)
    for k in range(len(nodes) - 1, 0, -1):
        sent[k] = [_log_sum([model.edges[s][t] + up[k][t] for t in STATES]) for s in STATES]
        above = up[nodes[k].parent]
        for s in STATES:
            above[s] += sent[k][s]
    belief = [[a + b for a, b in zip(up[0], model.start, strict=True)], *([None] * (len(nodes) - 1))]
    for k in range(1, len(nodes)):
        rest = [belief[nodes[k].parent][s] - sent[k][s] for s in STATES]
        belief[k] = [up[k][t] + _log_sum([rest[s] + model.edges[s][t] for s in STATES]) for t in STATES]
    out = []
    for b in belief:
        z = _log_sum(b)
        out.append([math.exp(v - z) for v in b])
    return out


def main_text(html: str, model: Model) -> str:
    """Content text: blocks in page order, white space in a block as one space, joined by one space."""
    page = parse(html)
    kept = [p[CONTENT] > 0.5 for p in marginals(page.nodes, model)]
    blocks: dict[int, list[str]] = {}
    for node, block, text in page.runs:
        if kept[node]:
            blocks.setdefault(block, []).append(text)
    trimmed = (_SPACE.sub(" ", "".join(b)).strip(" ") for b in blocks.values())
    return " ".join(b for b in trimmed if b)


# Labelled pages. Each page is put together from the parts below: (tag, class, inner kind).
_SENTENCE = "A sentence of the main story that goes on for a while, as such sentences do."
_TEXTS = ["A few words.", "One short sentence of it.", "Some more of the story is told here.", _SENTENCE, f"{_SENTENCE} {_SENTENCE}", " ".join([_SENTENCE] * 4), " ".join([_SENTENCE] * 12), "Heading", "No.", "A line"]
_SHORT = _TEXTS[0]
CONTENT_PARTS = [("h1", ""), ("h2", "title"), ("h3", ""), ("p", ""), ("p", "lead"), ("p", ""), ("blockquote", ""), ("ul", ""), ("ol", ""), ("pre", ""), ("table", ""), ("figure", ""), ("div", "text")]
CONTENT_BOXES = [("article", ""), ("main", ""), ("article", "post entry"), ("div", "content main"), ("section", "article body story"), ("div", "entry text post")]
BOILERPLATE_PARTS = [
    ("nav", ""), ("nav", "menu main navigation"), ("div", "menu nav navbar"), ("ul", "menu breadcrumb"), ("header", ""), ("header", "site header top"),
    ("div", "header masthead logo"), ("footer", ""), ("footer", "site footer"), ("div", "footer bottom copyright legal"), ("aside", ""), ("aside", "sidebar"),
    ("div", "sidebar widget"), ("div", "ad"), ("div", "advert advertisement sponsor"), ("div", "banner promo promotion"), ("section", "sponsored ads"),
    ("div", "cookie notice consent"), ("div", "notice alert privacy"), ("div", "popup modal overlay"), ("form", ""), ("form", "search login"),
    ("div", "newsletter subscribe signup"), ("section", "comment"), ("div", "comments discussion reply"), ("ol", "comment list"), ("div", "respond response reader"),
    ("div", "related recommended more"), ("div", "share social follow"), ("div", "pagination pager"), ("div", "tag category meta"), ("dialog", ""),
]


def _inner(tag: str, n: int, label: str) -> str:
    link = f'<a href="/{n}">{_SHORT[: 3 + n % 9]}</a>'
    text = _TEXTS[n % len(_TEXTS) if label == "content" else n % 6]
    if tag in ("ul", "ol", "menu"):
        item = text if label == "content" or n % 3 == 2 else link
        return f"<li>{item}</li>" * 3
    if label == "boilerplate" and (tag == "nav" and n % 4 or n % 4 == 0):
        return f"<ul><li>{link}</li><li>{link}</li></ul>"
    if tag == "table":
        return f"<tr><th>{_SHORT}</th><td>{_SHORT}</td></tr>"
    if tag == "figure":
        return f"<figcaption>{text}</figcaption>"
    if tag == "form":
        return f"<label>{_SHORT}</label><input><p>{text}</p>"
    if label == "boilerplate" and n % 5 == 2:
        return link
    return f"<p>{text}</p>" if tag in ("footer", "aside", "section", "div", "dialog", "blockquote") and n % 4 == 1 else text


def _part(tag: str, name: str, n: int, label: str) -> str:
    marks = f' class="{name}"' if name else ""
    return f'<{tag}{marks} {LABEL}="{label}">{_inner(tag, n, label)}</{tag}>'


def labelled_pages() -> Iterator[str]:
    """Pages with a label on each part: every kind of box with every kind of boilerplate, before,
    inside and after it, plainly in the body or in a wrapper; and pages without a box, whose
    paragraphs stand in the body or in nested wrappers."""
    wrap = f'{LABEL}="wrapper"'

    def noise(n: int) -> str:
        return _part(*BOILERPLATE_PARTS[n % len(BOILERPLATE_PARTS)], n, "boilerplate")

    def page(n: int, body: str) -> str:
        if n % 2:
            body = f'<div class="page wrapper container" {wrap}>{body}</div>'
        return f"<html {wrap}><head><title>x</title></head><body {wrap}>{body}</body></html>"

    for n, ((tag, name), own) in enumerate(product(CONTENT_BOXES, BOILERPLATE_PARTS)):
        parts = [_part(*p, n + 3 * k, "content") for k, p in enumerate(CONTENT_PARTS) if (n + k) % 3 or k == 3]
        parts += [f'<p {LABEL}="content">{_TEXTS[(n + k) % len(_TEXTS)]} {link}</p>' for k, link in enumerate(["", "", f'<a href="/">{_SHORT}</a>'])]
        if n % 4 == 0:
            parts.insert(0, f'<header {LABEL}="content"><h1>{_TEXTS[n % len(_TEXTS)]}</h1></header>')
        if n % 4:
            inner = [BOILERPLATE_PARTS[(n * 5 + k) % len(BOILERPLATE_PARTS)] for k in range(3)]
            for k, p in enumerate(p for p in inner if p[0] != "header"):
                parts.insert(3 * k + 2, _part(*p, n + k, "boilerplate"))
        marks = f' class="{name}"' if name else ""
        box = f'<{tag}{marks} {LABEL}="content">{"".join(parts)}</{tag}>'
        yield page(n, f"{_part(*own, n, 'boilerplate')}{noise(n)}{noise(n + 7)}{box}{noise(n + 13)}{noise(n + 19)}")
    for n in range(3 * len(BOILERPLATE_PARTS)):
        bare = "".join(f'<{t} {LABEL}="content">{_TEXTS[(n + k) % len(_TEXTS)]}</{t}>' for k, t in enumerate(["h1", "p", "p", "p", "div"][: 1 + n % 5 + (n % 5 == 0)]))
        alone = f'<div {LABEL}="content">{_TEXTS[n % len(_TEXTS)]}</div>' if n % 3 else f'<p {LABEL}="content">{_TEXTS[n % len(_TEXTS)]}</p>'
        body = [bare, alone, f"<div {wrap}>{bare}</div>", f"<div {wrap}><div {wrap}>{alone}</div></div>"][n % 4]
        yield page(n // 4, f"{noise(n) if n % 3 else ''}{body}{noise(n + 11) if n % 2 else ''}")
    for n, text in enumerate(_TEXTS * 4):
        yield f"<html {wrap}><body {wrap}>{noise(n) if n % 2 else ''}{text}</body></html>"


def extract(pages: DataFrame, model: Model | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, url, text, n_chars (code points).

    Null, empty and textless html give an empty text. Broken markup is read as far as it goes; a page
    without any content node gives an empty text. Repeated rows are read alike; an empty table gives no
    rows; other columns are ignored. Without a model, one is trained on `labelled_pages`.
    """
    model = train(labelled_pages()) if model is None else model

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(h, model) for h in batch["html"]]
            yield batch[["id", "url"]].assign(text=texts, n_chars=[len(t) for t in texts])

    # Ids travel as text: pandas has no integer column with nulls.
    given = pages.select(F.col(id_col).cast("string").alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    found = given.mapInPandas(rows, "id string, url string, text string, n_chars long")
    return found.select(F.col("id").cast(pages.schema[id_col].dataType).alias(id_col), "url", "text", "n_chars")
