"""Main text of web pages by minimum-cut labelling.

A page is cut into text blocks at its block-level tags.  Every block gets a
content and a boilerplate cost from a small logistic classifier over its tags,
class names, links and wording; the costs are its capacities from the source
and to the sink.  Edges join blocks that follow each other, stronger the deeper
their common container, and blocks that are next siblings in one container.
The minimum cut then labels all blocks of the page together, so a short
paragraph follows its neighbours and an advert between paragraphs does not.
"""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tessera.llm.common import in_small_batches, runs

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<name>[A-Za-z][A-Za-z0-9:-]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[A-Za-z][A-Za-z0-9:-]*)[^>]*(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr img math maction menclose merror mfenced mfrac mi "
                   "mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub "
                   "msubsup msup mtable mtd mtext mtr munder munderover semantics".split())
DROPPED = frozenset("script style noscript template svg head iframe button select textarea option annotation "
                    "audio video canvas datalist".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Tags that end a drawing left open.
BREAK_OUT = frozenset("article aside blockquote body div dl footer form h1 h2 h3 h4 h5 h6 header html main nav ol p pre "
                      "section table ul".split())
#: Tags whose text is read only up to their own end tag.
RAW = frozenset("script style textarea title template noscript iframe".split())
BOILER_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
BODY_TAGS = frozenset("article main".split())
#: Words in class, id or role that mark boilerplate.
BOILER_WORDS = frozenset(
    "ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies copyright disclaimer discussion disqus footer gdpr header legal login masthead menu modal nav navbar "
    "navigation newsletter notice notices notification pagination popup promo promotion promoted related replies reply "
    "respond share sharing sidebar sidenav signup skip social sponsor sponsored subscribe subscription toolbar topbar "
    "widget widgets alert complementary contentinfo search".split())
BODY_WORDS = frozenset("article body content entry main post story text".split())


#: Names of these containers say nothing: they hold the page or the article.
WHOLE = frozenset("html body main article".split())


class Block:
    __slots__ = ("text", "path", "linked", "boiler", "body", "tag")

    def __init__(self, text, path, linked, tag):
        self.text, self.path, self.linked, self.tag = text, path, linked, tag
        self.boiler = self.body = 0


def closed(page: str, name: str, at: int, never: set[str]) -> bool:
    """Whether a dropped element that opens before ``at`` has an end tag of its
    own: one before the next such element opens (drawings may be nested)."""
    if name in never:
        return False
    m = re.compile(rf"<(/?){name}(?![\w-])", re.I).search(page, at)
    if name == "svg" and m and not m[1]:
        m = re.compile(r"<(/)svg(?![\w-])", re.I).search(page, at)
    if not m:
        never.add(name)
    return bool(m and m[1])


def _mark(out: list[Block], tagged: set[int], named: dict[int, tuple], body: dict[int, tuple]) -> None:
    """Count the boilerplate and body containers around each block.

    A container that only its names call boilerplate, but that holds the page's
    article, is none: if all body containers lie in it and most of the text, or,
    where there are none, nearly all text.
    """
    sizes: dict[int, int] = {}
    for b in out:
        for c in b.path:
            sizes[c] = sizes.get(c, 0) + len(b.text)
    total = sizes.get(0, 0)
    boiler = set(tagged)
    for c in named:
        whole = all(c in path for path in body.values())
        if not whole or sizes.get(c, 0) <= (0.5 if body else 0.95) * total:
            boiler.add(c)
    for b in out:
        b.boiler = sum(c in boiler for c in b.path)
        b.body = sum(c in body for c in b.path)


def blocks(page: str) -> list[Block]:
    """Text blocks of a page in order, with what surrounds them.

    Text inside scripts, styles, drawings and controls is no block.  A drawing
    closed in its own tag holds nothing; one left open ends at the next block
    tag, a control without an end tag at once.
    """
    out: list[Block] = []
    # open containers: (tag, number, how many body containers, itself included)
    stack: list[tuple[str, int, int]] = [("", 0, 0)]
    # containers marked by their tags, by their names, and as body
    tagged: set[int] = set()
    named: dict[int, tuple] = {}
    bodies: dict[int, tuple] = {}
    parts: list[str] = []
    links = depth = linked = number = 0
    dropping, never = "", set()
    at = 0

    def flush():
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split()) if parts else ""
        if text:
            top = stack[-1]
            out.append(Block(text, tuple(x[1] for x in stack), linked / max(1, sum(map(len, parts))), top[0]))
        parts.clear()
        linked = 0

    end = len(page)
    while at < end:
        m = _TAG.search(page, at)
        raw = page[at : m.start() if m else end]
        if raw and not depth:
            parts.append(raw)
            linked += len(raw) if links else 0
        if not m:
            break
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        closing = bool(m["end"] or m["end2"])
        if name in RAW and not closing and not (m["attrs"] or "").endswith("/"):
            if not depth or name in DROPPED:
                stop = re.compile(rf"</{name}\s*>", re.I).search(page, at)
                if name not in DROPPED and not depth:
                    flush()
                at = stop.end() if stop else end
            continue
        if name in DROPPED:
            if closing:
                depth = max(0, depth - 1)
            elif not (m["attrs"] or "").endswith("/") and (depth or closed(page, name, at, never)):
                depth, dropping = depth + 1, dropping if depth else name
            continue
        if depth and dropping == "svg" and name in BREAK_OUT and not closing:
            depth = 0
        if name in ("body", "html") or name == "article" and not closing:
            depth = 0  # whatever was left open before
        if depth:
            continue
        if name == "a":
            links = 0 if closing else 1
        if name in INLINE:
            continue
        flush()
        if name in VOID:
            continue
        links = 0
        if closing:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
            continue
        if name in ("p", "li", "dt", "dd", "tr", "td", "th") or name[0] == "h" and name[1:].isdigit():
            for i in range(len(stack) - 1, 0, -1):  # the end tags that may be left out
                if stack[i][0] in ("ul", "ol", "dl", "table", "div", "article", "section", "main", "body"):
                    break
                if stack[i][0] == name or stack[i][0] == "p":
                    del stack[i:]
                    break
        body = stack[-1][2]
        words: set[str] = set()
        if m["attrs"]:
            for x in _NAMES.findall(m["attrs"]):
                words.update(re.split(r"[^a-z0-9]+", "".join(x).lower()))
        number += 1
        path = (*(x[1] for x in stack), number)
        if name in BOILER_TAGS or name == "header" and not body:
            tagged.add(number)
        elif words & BOILER_WORDS and name not in WHOLE:
            named[number] = path
        elif name in BODY_TAGS or words & BODY_WORDS and name not in WHOLE:
            body, bodies[number] = body + 1, path
        stack.append((name, number, body))
    flush()
    _mark(out, tagged, named, bodies)
    return out


def content_cost(b: Block) -> float:
    """Log odds that a block is content: its pull to the source side."""
    words = b.text.count(" ") + 1
    z = -0.6 + 0.9 * min(words, 40) / 10
    z += 0.8 if b.text[-1] in ".!?\"”’»…:;" else 0.0
    z += 1.2 if b.tag in ("p", "blockquote", "pre", "h1", "h2", "h3") else -0.8 if b.tag in ("li", "td", "") else 0.0
    z += 4.0 * min(b.body, 1)
    z -= 4.0 * b.linked
    z -= 14.0 * min(b.boiler, 1)
    return z


def minimum_cut(pull: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay with the source.  ``pull`` is a node's capacity from the
    source (if positive) or to the sink; edges have one capacity both ways.

    Maximum flow by blocking flows: a breadth-first search from all nodes that
    still have supply gives levels, and paths that climb one level a step are
    filled until none is left; each edge that leads nowhere is left behind for
    the rest of the phase.  At the end the sink is out of reach.
    """
    n, tiny = len(pull), 1e-9
    supply = list(pull)
    out: list[list[int]] = [[] for _ in range(n)]  # arcs of a node; arc k and k ^ 1 are opposite
    to, room = [], []
    for a, b, c in edges:
        out[a].append(len(to))
        out[b].append(len(to) + 1)
        to += [b, a]
        room += [c, c]
    while True:
        level = [0 if x > tiny else -1 for x in supply]
        queue = [i for i in range(n) if not level[i]]
        reached = False
        for u in queue:
            for k in out[u]:
                v = to[k]
                if level[v] < 0 and room[k] > tiny:
                    level[v] = level[u] + 1
                    queue.append(v)
                    reached = reached or supply[v] < -tiny
        if not reached:
            return [x >= 0 for x in level]
        arc = [0] * n
        for source in [i for i in queue if supply[i] > tiny]:
            path: list[int] = []
            u = source
            while supply[source] > tiny:
                if supply[u] < -tiny:  # fill the path that was found, and go on from its tightest arc
                    flow = min([supply[source], -supply[u], *(room[k] for k in path)])
                    supply[source] -= flow
                    supply[u] += flow
                    cut = len(path)
                    for i in range(len(path) - 1, -1, -1):
                        room[path[i]] -= flow
                        room[path[i] ^ 1] += flow
                        if room[path[i]] <= tiny:
                            cut = i
                    if cut < len(path):
                        u = to[path[cut] ^ 1]
                        del path[cut:]
                    continue
                arcs = out[u]
                while arc[u] < len(arcs):
                    k = arcs[arc[u]]
                    if room[k] > tiny and level[to[k]] == level[u] + 1:
                        path.append(k)
                        u = to[k]
                        break
                    arc[u] += 1
                else:
                    if not path:
                        break
                    u = to[path.pop() ^ 1]
                    arc[u] += 1


def main_text(page: str | None, smooth: float = 0.8) -> str:
    """The blocks on the content side of the cut, joined by single spaces."""
    found = blocks(page or "")
    edges, last = [], {}
    for i, b in enumerate(found):
        if i:
            common = sum(x == y for x, y in zip(b.path, found[i - 1].path))
            edges.append((i - 1, i, smooth * common / max(len(b.path), len(found[i - 1].path))))
        parent = b.path[:-1]
        j = last.get(parent)
        if j is not None and j < i - 1:
            edges.append((j, i, smooth / 2))
        last[parent] = i
    keep = minimum_cut([content_cost(b) for b in found], edges)
    return " ".join(b.text for b, k in zip(found, keep) if k)


def extract(pages: DataFrame) -> DataFrame:
    """Main text of ``pages (page_id, url, html, ...)``: ``page_id``, ``url``,
    ``text`` (empty if there is none) and ``n_chars`` (its code points).

    One row per input row, repeated rows included; a null or empty html has the
    empty text; page_id and url pass through as they are, null or not.  Whole
    pages are read, however long.  An empty table gives an empty result.
    """
    def work(batches):
        for b in batches:
            raw = list(b["html"])
            for lo, hi in runs([len(x or "") for x in raw]):
                text = [main_text(x) for x in raw[lo:hi]]
                yield pd.DataFrame({"page_id": b["page_id"].iloc[lo:hi].to_numpy(), "url": b["url"].iloc[lo:hi].to_numpy(),
                                    "text": text, "n_chars": [len(t) for t in text]})

    narrow = in_small_batches(pages).select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string"))
    return narrow.mapInPandas(work, "page_id bigint, url string, text string, n_chars bigint")
