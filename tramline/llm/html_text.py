"""Main text of web pages by message passing in the tree of the page.

Every element and every block of text is a node that is main text or not. A
node's features (its tag, words of its class, id and role, how long its text is
and how much of it is linked) speak for one or the other, and so does the state
of its parent, by how often states follow each other on the labelled pages.
Sum-product messages go up from the leaves and down from the root; the blocks
whose marginal for main text is a half at least make up the text, in order.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.labelled_pages import PAGES

# Elements by kind, as HTML has them.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe textarea title xmp noembed noframes".split())
# What an open head may hold; all else ends it.
HEAD = set("base basefont bgsound link meta noframes noscript script style template title".split())
UNSEEN = RAW | set("head select object audio video canvas svg map datalist option annotation annotation-xml".split())
# Raw elements that browsers read to the end of the page when no end tag follows; of all others the start tag is passed over.
ENDLESS = set("script style".split())
BLOCKS = set(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr "
    "ul caption".split())
BOXES = set("body html div article section main table tbody tr td header footer aside nav center form fieldset dialog details #page".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "tbody": {"tbody", "thead", "tr", "td", "th"}, "thead": set(), "tfoot": {"tbody", "tr", "td", "th"}, "option": {"option"}}
WALLS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"},
         "tbody": {"table"}, "tfoot": {"table"}}

_OPENING = re.compile(r"<(?=[a-zA-Z!?/])")
#: A tag up to its ``>`` or the end of the page. A quote that never closes is taken as part of a name; nothing is tried twice.
_TAG = re.compile(
    r"""</?[a-zA-Z][^\s/>]*+(?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)?+)*+""")
#: What the end of a page leaves of a tag.
_CUT = re.compile(r"</?[a-zA-Z][^\s<>]*(?:\s+[^\s=<>]+\s*=|\s*[\w-]*\Z)")
_ZEROS = re.compile(r"(&#|&#[xX](?=0+[0-9a-fA-F]))0+(?=[0-9])|(&#[xX])0+(?=[a-fA-F])")
_HUGE = re.compile(r"&#(?:[0-9]{9,}|[xX][0-9a-fA-F]{9,});?")
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
_WORDS = re.compile(r"[A-Z]?[a-z]+")

SMOOTH = 0.02
#: How far the looks of a block of text count beside the names around it.
TEMPER = 0.25


class Node:
    """An element (``tag``) or a block of text (``tag`` empty) in its tree."""
    __slots__ = ("tag", "parent", "children", "names", "text", "linked", "main", "chars", "link_chars")

    def __init__(self, tag: str, parent: Node | None, names: tuple[str, ...] = (), main: bool = False):
        self.tag, self.parent, self.names, self.main = tag, parent, names, main
        self.children: list[Node] = []
        self.text, self.linked = "", 0
        self.chars = self.link_chars = 0
        if parent is not None:
            parent.children.append(self)


def _attributes(tag: str) -> tuple[tuple[str, ...], bool | None, bool]:
    """Words of class, id and role; a label, if the tag bears one; whether it is hidden."""
    names: list[str] = []
    label, hidden = None, False
    for key, a, b, c in _ATTRIBUTE.findall(tag, _NAME.match(tag).end()):
        key = key.lower()
        if key == "data-main":
            label = True
        elif key == "data-not":
            label = False
        elif key == "hidden":
            hidden = True
        elif key in ("class", "id", "role"):
            value = a or b or c
            names += [w.lower() for w in _WORDS.findall(value)] or [value.lower()]
    return tuple(sorted(set(names))), label, hidden


_cached_attributes = lru_cache(maxsize=10_000)(_attributes)


def _unescaped(raw: str) -> str:
    if "&" not in raw:
        return raw
    if "&#" in raw:
        raw = _HUGE.sub("\N{REPLACEMENT CHARACTER}", _ZEROS.sub(lambda m: m.group(1) or m.group(2), raw))
    return unescape(raw)


class _Scanner:
    """Splits a page into text and tags in one pass forward, in time proportional to its length.

    Comments, declarations and marked sections are passed over. A tag that is
    open at the end of the page ends at its first ``>``, and from there on
    quotes are not looked at any more; without any ``>`` it goes if it looks cut
    off, and is text otherwise.
    """

    def __init__(self, html: str):
        self.html = html
        self.at = 0
        self.last = html.rfind(">")
        self.quotes = True
        self.next_end: dict[str, int] = {}

    def _upto(self, mark: str, start: int, missing: int) -> int:
        found = self.html.find(mark, start)
        return missing if found < 0 else found + len(mark)

    def tokens(self) -> Iterator[tuple[bool, str]]:
        """(is a tag, the text or tag), in order; ``at`` may be moved forward after a tag."""
        html, n = self.html, len(self.html)
        said = 0
        while self.at < n:
            m = _OPENING.search(html, self.at)
            if m is None:
                break
            i = m.start()
            end = self._end(i)
            if end == i:
                self.at = i + 1
                continue
            if i > said:
                yield False, html[said:i]
            self.at = said = end
            if html[end - 1] == ">" and (html[i + 1].isalpha() or html[i + 1] == "/" and html[i + 2].isalpha()):
                yield True, html[i:end]
                said = self.at
        if said < n:
            yield False, html[said:]

    def _end(self, i: int) -> int:
        """The end of what the ``<`` at ``i`` opens, or ``i`` if it is text."""
        html, n = self.html, len(self.html)
        if html.startswith("<!--", i):
            if html.startswith((">", "->"), i + 4):
                return html.index(">", i + 4) + 1
            return self._upto("-->", i + 4, n)
        if i > self.last:
            return n if _CUT.match(html, i) else i
        if html.startswith("<![CDATA[", i):
            end = self.ending("]]>", i)
            return self._upto(">", i, n) if end < 0 else end + 3
        if self.quotes and _NAME.match(html, i):
            end = _TAG.match(html, i).end()
            if end < n:
                return end + 1
            self.quotes = False
        return self._upto(">", i, n)

    def ending(self, mark: str, start: int) -> int:
        """Where the next ``mark`` is, or the next end tag of the name ``mark``; -1 if there is none."""
        found = self.next_end.get(mark, 0)
        if 0 <= found < start or mark not in self.next_end:
            if mark[0] == "]":
                found = self.html.find(mark, start)
            else:
                m = _end_tag(mark).search(self.html, start)
                found = m.start() if m else -1
            self.next_end[mark] = found
        return found

    def skip(self, tag: str) -> bool:
        """Passes over all up to the end tag of a raw element; says whether there was one."""
        end = self.ending(tag, self.at)
        if end >= 0:
            self.at = self._upto(">", end, len(self.html))
        elif tag in ENDLESS:
            self.at = len(self.html)
        return end >= 0


@lru_cache(maxsize=100)
def _end_tag(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I)


class _Open:
    """The open elements, and by name where they are, so that no look at them walks over the others."""

    def __init__(self, root: Node):
        #: (tag, node that blocks go to, main, hidden, in a button); inline elements share the node of the block around them.
        self.stack: list[tuple[str, Node, bool, bool, bool]] = [("#page", root, False, False, False)]
        self.places: dict[str, list[int]] = defaultdict(list)
        self.blocks: list[int] = []

    def push(self, tag: str, node: Node, main: bool, hidden: bool, button: bool) -> None:
        self.places[tag].append(len(self.stack))
        if tag in BLOCKS:
            self.blocks.append(len(self.stack))
        self.stack.append((tag, node, main, hidden, button))

    def cut(self, count: int) -> bool:
        """Takes all from place ``count`` off; says whether a block was among them."""
        for tag, *_ in reversed(self.stack[count:]):
            self.places[tag].pop()
        del self.stack[count:]
        before = len(self.blocks)
        while self.blocks and self.blocks[-1] >= count:
            self.blocks.pop()
        return len(self.blocks) < before

    def top(self, tags: Iterable[str]) -> int:
        """The place of the innermost of these, 0 if none is open."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)


def parse(html: str) -> Node:
    """The tree of a page, however broken: missing and stray end tags, cut-off pages, unknown elements.

    Inline elements add their text to the block they are in. What browsers show
    no text of (scripts, forms' controls, hidden elements) gives none; a button
    counts as text if words of its block stand before and after it.
    """
    root = Node("", None)
    root.tag = "#page"
    opened = _Open(root)
    run: list[tuple[str, bool]] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if run:
            words = [k for k, (raw, button) in enumerate(run) if not button and not raw.isspace()]
            text = " ".join("".join(raw for k, (raw, button) in enumerate(run) if not button or (words and words[0] < k < words[-1])).split())
            run.clear()
            if text:
                _, block, main, *_ = opened.stack[-1]
                leaf = Node("", block, (), main)
                leaf.text, leaf.linked = text, min(linked, len(text))
            linked = 0

    def close(count: int) -> None:
        if any(b >= count for b in opened.blocks[-1:]):
            flush()
        opened.cut(count)

    def say(raw: str) -> None:
        nonlocal linked
        if opened.stack[-1][0] == "head" and raw.strip():
            close(len(opened.stack) - 1)
        _, _, _, hidden, button = opened.stack[-1]
        if raw and not hidden:
            text = _unescaped(raw)
            if text:
                run.append((text, button))
            if opened.places["a"]:
                linked += len(text.strip())

    page = _Scanner(html)
    for is_tag, token in page.tokens():
        if not is_tag:
            say(token)
            continue
        tag = _NAME.match(token).group(1).lower()
        if token[1] == "/":
            i = opened.top((tag,))
            if i and (tag in BLOCKS or i >= opened.top(("table", "td", "th"))):
                close(i)
            if tag == "p" and not opened.places["p"]:
                flush()
            continue
        if opened.stack[-1][0] == "head":
            if tag == "head":
                continue
            if tag not in HEAD:
                close(len(opened.stack) - 1)
        if tag == "br":
            run.append((" ", False))
            continue
        if tag in RAW:
            page.skip(tag)
            continue
        if tag in VOID:
            if tag in BLOCKS:
                flush()
            continue
        if tag in BLOCKS or tag in CLOSES:
            closes = CLOSES.get(tag, set()) | ({"p"} if tag in BLOCKS else set())
            walls = WALLS.get(tag)
            while True:
                i = opened.top(closes)
                if not i or i < (opened.top(walls) if walls else opened.blocks[-1] if opened.blocks else 0):
                    break
                close(i)
                if not walls:
                    break
                closes -= {"p"}
        names, label, hidden = _cached_attributes(token) if len(token) < 2000 else _attributes(token)
        _, block, main, unseen, button = opened.stack[-1]
        main = main if label is None else label
        unseen = unseen or hidden or (tag in UNSEEN and (tag in ("head", "option") or page.ending(tag, page.at) >= 0))
        if tag in BLOCKS:
            flush()
            block = Node(tag, block, names, main)
        if not token.endswith("/>") or tag in BLOCKS:
            opened.push(tag, block, main, unseen, button or tag == "button")
    flush()
    return root


def ordered(root: Node) -> list[Node]:
    """All nodes, parents first, in the order of the page; sizes of text filled in."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += reversed(node.children)
    for node in reversed(out):
        node.chars += len(node.text)
        node.link_chars += node.linked
        if node.parent is not None:
            node.parent.chars += node.chars
            node.parent.link_chars += node.link_chars
    return out


def _size(chars: int) -> str:
    return "0" if not chars else "s" if chars < 25 else "m" if chars < 100 else "l" if chars < 400 else "x"


def kind(node: Node) -> str:
    return "text" if not node.tag else "box" if node.tag in BOXES else "line"


def features(node: Node) -> list[str]:
    share = node.link_chars / node.chars if node.chars else 0.0
    linked = "0" if share == 0 else "s" if share < 0.3 else "m" if share < 0.8 else "l"
    if not node.tag:
        end = node.text[-1:] in ".!?:;\"'”»)"
        return [f"text {_size(node.chars)} {linked}", f"end {end}"]
    return [f"tag {node.tag}", f"linked {linked}", *(f"name {w}" for w in node.names)]


class Model:
    """Log odds of the features, and the shares of states that follow a parent's state by kind of node, counted on labelled pages.

    An element counts as main text if it is marked so, or lies in one that is,
    and half of its text at least is main text.
    """

    def __init__(self, pages: Iterable[str]):
        seen = [defaultdict(float), defaultdict(float)]
        total = [0.0, 0.0]
        follow = {kind: [[0.3, 0.3], [0.3, 0.3]] for kind in ("text", "box", "line")}
        for page in pages:
            nodes = ordered(parse(page))
            left_out = dict.fromkeys(nodes, 0)
            for node in reversed(nodes):
                left_out[node] += len(node.text) * (not node.main)
                if node.parent is not None:
                    left_out[node.parent] += left_out[node]
            state = {node: int(node.main and node.chars > 0 and 2 * left_out[node] <= node.chars) for node in nodes}
            for node in nodes:
                s = state[node]
                total[s] += 1
                for f in features(node):
                    seen[s][f] += 1
                if node.parent is not None:
                    follow[kind(node)][state[node.parent]][s] += 1
        names = set(seen[0]) | set(seen[1])
        self.odds = {f: math.log((seen[1][f] + SMOOTH) / (total[1] + 2 * SMOOTH))
                     - math.log((seen[0][f] + SMOOTH) / (total[0] + 2 * SMOOTH)) for f in names}
        self.follow = {kind: [[x / sum(row) for x in row] for row in rows] for kind, rows in follow.items()}

    def marginals(self, nodes: list[Node]) -> list[float]:
        """The probability of main text of every node, by one pass up and one down."""
        place = {id(node): i for i, node in enumerate(nodes)}
        n = len(nodes)
        odds = self.odds
        own0, own1 = [1.0] * n, [1.0] * n
        up0, up1 = [1.0] * n, [1.0] * n
        parent = [0] * n
        for i, node in enumerate(nodes):
            x = 0.0
            for f in features(node):
                x += odds.get(f, 0.0)
            if not node.tag:
                x *= TEMPER
            own1[i] = 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))
            own0[i] = 1 - own1[i] or 1e-13
            if node.parent is not None:
                parent[i] = place[id(node.parent)]
        own1[0] *= 1e-6
        for i in range(n - 1, 0, -1):
            (a, b), (c, d) = self.follow[kind(nodes[i])]
            m0, m1 = a * own0[i] + b * own1[i], c * own0[i] + d * own1[i]
            up0[i], up1[i] = m0, m1
            p = parent[i]
            x, y = own0[p] * m0, own1[p] * m1
            s = x + y
            own0[p], own1[p] = x / s, y / s
        out = [0.0] * n
        s = own0[0] + own1[0]
        out[0] = own1[0] / s
        down0, down1 = [own0[0] / s] * n, [out[0]] * n
        for i in range(1, n):
            p = parent[i]
            x, y = down0[p] / up0[i], down1[p] / up1[i]
            s = x + y
            x, y = x / s, y / s
            (a, b), (c, d) = self.follow[kind(nodes[i])]
            q0, q1 = (x * a + y * c) * own0[i], (x * b + y * d) * own1[i]
            s = q0 + q1
            down0[i], down1[i] = max(q0 / s, 1e-300), max(q1 / s, 1e-300)
            out[i] = q1 / s
        return out


def main_text(html: str, model: Model) -> str:
    """The blocks of main text, two line feeds between them; of a page without any block element, all that is not a link."""
    nodes = ordered(parse(html))
    if not any(node.tag for node in nodes[1:]):
        return "\n\n".join(node.text for node in nodes if not node.tag and node.link_chars < node.chars)
    return "\n\n".join(node.text for node, p in zip(nodes, model.marginals(nodes)) if not node.tag and p >= 0.5)


def extract(pages: DataFrame, labelled: Iterable[str] = PAGES) -> DataFrame:
    """Per row of ``pages``: ``page_id, url, text, n_chars``.

    The whole html is read; null is empty, and a page without main text has an
    empty text. Rows are taken one by one, so repeated rows repeat their result;
    other columns are not looked at.
    """
    model = pages.sparkSession.sparkContext.broadcast(Model(labelled))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                some = batch.slice(lo, 200)
                texts = [main_text(x.as_py() or "", model.value) for x in some.column("html")]
                yield pa.RecordBatch.from_arrays(
                    [some.column("page_id"), some.column("url"), pa.array(texts, pa.string()),
                     pa.array(np.fromiter(map(len, texts), np.int64, len(texts)))], ["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")) \
        .mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
