"""Main text of HTML pages by minimum-cut labelling.

A page is cut into blocks of text. A linear classifier gives each block the cost of calling it
boilerplate and the cost of calling it content; they are its capacities from the source and to the
sink. Neighbours in page order and neighbours below the same element are tied by edges whose capacity
falls with their distance in the element tree. The minimum cut is the labelling with the least sum of
costs and cut ties; the source's side is the content.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import defaultdict, deque
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streambed.llm import common

# Elements whose content is no text of the page.
SILENT = frozenset(
    "head title script style template noscript iframe object svg math select option button textarea "
    "audio video canvas noframes noembed xmp datalist".split()
)
# Their content ends at their own end tag only.
RAW = frozenset("script style textarea title iframe xmp noframes noembed".split())
# What may stand in a head, and the end tags that end one.
IN_HEAD = frozenset("base basefont bgsound head link meta noframes noscript script style template title".split())
HEAD_ENDS = frozenset("body html br".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that begin and end a block of text.
BLOCK = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table "
    "caption tbody td tfoot th thead tr ul".split()
)
# A start tag closes these open elements.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"),
    "thead": ("tr",), "tbody": ("tr",), "tfoot": ("tr",),
}
# They do not reach beyond these.
SCOPE = frozenset("ul ol dl table tr body article section div main aside nav footer header form".split())
# Elements that a block-level start tag does not close a paragraph in.
NO_PARAGRAPH_END = frozenset("a b i em strong span font u small s sub sup code q cite mark abbr time".split())

# The classifier: evidence of an element for content (above 0) or boilerplate, passed to all below it.
TAG_EVIDENCE = {
    "article": 4.0, "main": 3.0, "nav": -9.0, "aside": -8.0, "footer": -9.0, "form": -9.0, "menu": -8.0,
    "dialog": -8.0, "header": -6.0, "fieldset": -6.0,
}
NAME_EVIDENCE = {
    -8.0: "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner "
    "cookie cookies consent gdpr notice notices alert popup modal overlay subscribe newsletter signup login "
    "social share sharing related recommended recommendations comment comments disqus reply replies respond "
    "discussion sidebar side widget menu nav navbar navigation breadcrumb breadcrumbs footer foot masthead "
    "topbar toolbar pagination pager copyright legal disclaimer search form skip",
    -5.0: "header head top bottom tags meta byline author bio tools outbrain taboola",
    3.0: "article content main post entry story body text",
}
ROLE_EVIDENCE = {
    "navigation": -9.0, "banner": -7.0, "contentinfo": -9.0, "complementary": -8.0, "search": -9.0, "form": -9.0,
    "alert": -8.0, "dialog": -8.0, "menu": -8.0, "article": 4.0, "main": 3.0,
}
NAMES = {name: weight for weight, names in NAME_EVIDENCE.items() for name in names.split()}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

# Weights of a block's own features.
BIAS = -1.2
WORDS_WEIGHT = 1.1  # of the logarithm of its words
LINK_WEIGHT = -5.0  # of the part of its characters in links
STOP_WEIGHT = 0.6  # if it ends like a sentence
# Capacities of ties: between neighbours in page order and below one element.
ADJACENT = 1.0
SIBLING = 0.6
# Capacities are whole thousandths, so that the cut is exact.
UNIT = 1000

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)|</[^a-zA-Z][^>]*(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


def _own_evidence(tag: str, attributes: str, inherited: float, in_article: bool) -> float:
    weight = TAG_EVIDENCE.get(tag, 0.0)
    if tag == "header" and in_article:
        weight = 0.0
    if attributes:
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
        names = re.split(r"[^a-z0-9]+", f"{found.get('class', '')} {found.get('id', '')}".lower())
        weights = [NAMES[name] for name in names if name in NAMES]
        if in_article:
            weights = [w for w in weights if w != -5.0]
        if weights and tag not in ("html", "body"):
            weight += min(weights) if min(weights) < 0 else max(weights)
        weight += ROLE_EVIDENCE.get(found.get("role", "").lower(), 0.0)
        if "hidden" in found or found.get("aria-hidden") == "true" or _HIDDEN.search(found.get("style", "")):
            weight -= 9.0
    # Nothing below boilerplate wins it back.
    return min(weight, 0.0) if inherited < 0 else weight


class Block:
    __slots__ = ("text", "parent", "path", "evidence", "heading", "link_chars")

    def __init__(self, text, parent, path, evidence, heading, link_chars):
        self.text, self.parent, self.path = text, parent, path
        self.evidence, self.heading, self.link_chars = evidence, heading, link_chars


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order: their text, the elements above them, their classifier evidence."""
    out: list[Block] = []
    # An open element: tag, evidence, number of its nearest block element, that element's depth.
    stack: list[tuple[str, float, int, int]] = [("", 0.0, 0, 0)]
    above = [(0, 0)]  # by block element: its parent and depth
    opened: dict[str, int] = defaultdict(int)
    parts: list[str] = []
    links: list[str] = []

    def flush() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                linked = len(" ".join("".join(links).split()))
                _, evidence, node, depth = stack[-1]
                heading = any(opened[h] for h in HEADINGS)
                out.append(Block(text, node, depth, evidence, heading, linked))
            parts.clear()
            links.clear()

    def pop_to(size: int) -> None:
        while len(stack) > size:
            opened[stack.pop()[0]] -= 1

    def say(text: str) -> None:
        if text:
            # Each stretch between tags for itself: a reference does not reach over a tag.
            text = entities.unescape(text)
            parts.append(text)
            if opened["a"]:
                links.append(text)

    at, end = 0, len(page)
    while at < end:
        match = _TAG.search(page, at)
        if match is None:
            say(page[at:])
            break
        say(page[at : match.start()])
        at = match.end()
        tag = match[2] or match[5]
        if tag is None:
            continue
        tag, closing, attributes = tag.lower(), match[1] or match[4], match[3] or match[6] or ""
        if closing:
            if tag == "br":
                say(" ")
            elif opened[tag] > 0:
                if tag in BLOCK:
                    flush()
                size = len(stack)
                while stack[size - 1][0] != tag:
                    size -= 1
                if tag in BLOCK or not any(s[0] in BLOCK for s in stack[size:]):
                    pop_to(size - 1)
            continue
        if tag in SILENT:
            if tag in BLOCK:
                flush()
            if not attributes.rstrip().endswith("/"):
                at = _end_of(page, match.start(), at, tag)
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            else:
                say(" " if tag == "br" else "")
            continue
        if tag in BLOCK:
            flush()
            # An open paragraph ends, and what was left open in it.
            if opened["p"]:
                size = len(stack)
                while stack[size - 1][0] != "p" and (stack[size - 1][0] in NO_PARAGRAPH_END):
                    size -= 1
                if stack[size - 1][0] == "p":
                    pop_to(size - 1)
            ends = CLOSES.get(tag, ())
            if any(opened[e] for e in ends):
                size = len(stack)
                while size > 1 and stack[size - 1][0] not in ends and stack[size - 1][0] not in SCOPE:
                    size -= 1
                if stack[size - 1][0] in ends:
                    pop_to(size - 1)
        if attributes.rstrip().endswith("/") and tag not in BLOCK:
            continue
        _, evidence, node, depth = stack[-1]
        evidence += _own_evidence(tag, attributes, evidence, opened["article"] > 0 or opened["main"] > 0)
        if tag in BLOCK:
            above.append((node, depth + 1))
            node, depth = len(above) - 1, depth + 1
        stack.append((tag, evidence, node, depth))
        opened[tag] += 1
    flush()
    for block in out:
        block.path = above
    return out


_ENDS: dict[str, re.Pattern] = {}
_HEAD_END = re.compile(r"</head\s*>|<body[\s>]", re.IGNORECASE)


@lru_cache(maxsize=16)
def _closed(page: str, tag: str) -> dict[int, int]:
    """Where the elements of a name end, by where they begin; without those that are never closed."""
    opened, ends = [], {}
    for found in re.finditer(rf"<(/?){tag}(?=[\s/>])[^>]*>", page, re.IGNORECASE):
        if not found[1]:
            opened.append(found.start())
        elif opened:
            ends[opened.pop()] = found.end()
    return ends


def _end_of_head(page: str, at: int) -> int:
    """Where a head without end tag ends: before the first text or tag that may not stand in it."""
    while match := _TAG.search(page, at):
        if page[at : match.start()].strip():
            return at
        tag, closing = (match[2] or match[5] or "").lower(), match[1] or match[4]
        if tag in HEAD_ENDS if closing else tag and tag not in IN_HEAD:
            return match.start()
        start, at = match.start(), match.end()
        if tag in SILENT and not closing and not (match[3] or match[6] or "").rstrip().endswith("/"):
            at = _end_of(page, start, at, tag)
    return at


def _end_of(page: str, start: int, at: int, tag: str) -> int:
    """Where a silent element ends whose start tag stands from ``start`` to ``at``.

    Raw text that is never closed reaches to the page's end; of other elements that are never closed
    only the tag is silent.
    """
    if tag in RAW:
        ends = _ENDS.setdefault(tag, re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.IGNORECASE))
        found = ends.search(page, at)
        return found.end() if found else len(page)
    if tag == "head":
        # Its end tag may be left out.
        found = _HEAD_END.search(page, at)
        return found.end() if found and found[0][1] == "/" else _end_of_head(page, at)
    return _closed(page, tag).get(start, at)


def score(block: Block) -> float:
    """The classifier's log odds that a block is content."""
    words = block.text.count(" ") + 1
    linked = min(1.0, block.link_chars / len(block.text))
    z = BIAS + block.evidence + WORDS_WEIGHT * math.log(words) * (block.evidence >= 0) + LINK_WEIGHT * linked
    z += STOP_WEIGHT * (block.text[-1] in ".!?:;…\"”»")
    return z + 1.0 * block.heading * (block.evidence >= 0)


def _distance(above: list[tuple[int, int]], a: int, b: int, most: int = 6) -> int:
    """Steps between two block elements in the element tree, ``most`` at most."""
    steps = 0
    while a != b and steps < most:
        if above[a][1] >= above[b][1]:
            a = above[a][0]
        else:
            b = above[b][0]
        steps += 1
    return steps


def graph(found: list[Block]) -> tuple[list[int], list[int], dict[tuple[int, int], int]]:
    """Capacities from the source and to the sink, and of the ties (i < j)."""
    source, sink = [], []
    for block in found:
        z = max(-30.0, min(30.0, score(block)))
        source.append(round(UNIT * math.log1p(math.exp(z))))
        sink.append(round(UNIT * math.log1p(math.exp(-z))))
    ties: dict[tuple[int, int], int] = defaultdict(int)
    last: dict[int, int] = {}
    for k, block in enumerate(found):
        above = block.path
        if k:
            steps = _distance(above, found[k - 1].parent, block.parent)
            ties[k - 1, k] += round(UNIT * ADJACENT / (1 + steps))
        parent = above[block.parent][0]
        if parent in last:
            ties[last[parent], k] += round(UNIT * SIBLING)
        last[parent] = k
    return source, sink, ties


def min_cut(source: list[int], sink: list[int], ties: dict[tuple[int, int], int]) -> list[bool]:
    """True for the nodes on the source's side of the smallest minimum cut (found by maximum flow).

    Nodes whose own capacities outweigh all their ties are settled first, which changes no minimum
    cut: their ties become capacities of their neighbours. Augmenting paths settle the rest.
    """
    n = len(source)
    near: list[dict[int, int]] = [{} for _ in range(n)]
    for (a, b), capacity in ties.items():
        if capacity and a != b:
            near[a][b] = near[a].get(b, 0) + capacity
            near[b][a] = near[b].get(a, 0) + capacity
    # Excess of a node: what the source offers beyond the sink.
    excess = [a - b for a, b in zip(source, sink)]
    side: list[bool | None] = [None] * n
    queue = deque(range(n))
    while queue:
        k = queue.popleft()
        if side[k] is not None:
            continue
        pull = sum(near[k].values())
        if excess[k] > pull or excess[k] < -pull or not near[k]:
            side[k] = excess[k] > 0
            for other, capacity in near[k].items():
                excess[other] += capacity if side[k] else -capacity
                del near[other][k]
                queue.append(other)
            near[k] = {}
    rest = [k for k in range(n) if side[k] is None]
    if rest:
        reached = _flow(rest, excess, near)
        for k in rest:
            side[k] = k in reached
    return [bool(s) for s in side]


def _flow(nodes: list[int], excess: list[int], near: list[dict[int, int]]) -> set[int]:
    """The nodes that the source reaches after a maximum flow, by shortest augmenting paths in levels."""
    s, t = -1, -2
    room: dict[int, dict[int, int]] = {k: dict(near[k]) for k in nodes}
    room[s], room[t] = {}, {}
    for k in nodes:
        if excess[k] > 0:
            room[s][k], room[k][s] = excess[k], 0
        elif excess[k] < 0:
            room[k][t], room[t][k] = -excess[k], 0
    while True:
        level, queue = {s: 0}, deque([s])
        while queue:
            a = queue.popleft()
            for b, capacity in room[a].items():
                if capacity > 0 and b not in level:
                    level[b] = level[a] + 1
                    queue.append(b)
        if t not in level:
            return set(level) - {s}
        arcs = {a: iter(list(room[a])) for a in level}
        path = [s]
        while path:
            a = path[-1]
            if a == t:
                amount = min(room[x][y] for x, y in zip(path, path[1:]))
                cut = None
                for k, (x, y) in enumerate(zip(path, path[1:])):
                    room[x][y] -= amount
                    room[y][x] = room[y].get(x, 0) + amount
                    if room[x][y] == 0 and cut is None:
                        cut = k
                # The tail keeps its arc iterators; the saturated arc's start tries its next one.
                path = path[: cut + 1]
                continue
            for b in arcs[a]:
                if room[a][b] > 0 and level.get(b, -9) == level[a] + 1:
                    path.append(b)
                    break
            else:
                path.pop()


def main_text(page: str | None) -> str:
    """The content blocks of a page, joined by one space."""
    found = blocks(page or "")
    if not found:
        return ""
    return " ".join(block.text for block, kept in zip(found, min_cut(*graph(found))) if kept)


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row.

    A null or empty html, and a page without content, gives an empty text. Null ids and URLs and
    repeated rows are returned as they come; other columns are left out. A page is read whole,
    whatever its length, and by itself: no row needs another.
    """
    schema = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())]
    )

    def run(batches):
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1).cast(pa.string()),
                    pa.array(texts, pa.string()),
                    pa.array(map(len, texts), pa.int64()),
                ],
                schema=schema,
            )

    return (
        common.small_batches(pages)
        .select(
            F.col(id_col).cast("long").alias("page_id"),
            F.col(url_col).cast("string").alias("url"),
            F.col(html_col).cast("string").alias("html"),
        )
        .mapInArrow(run, "page_id long, url string, text string, n_chars long")
    )
