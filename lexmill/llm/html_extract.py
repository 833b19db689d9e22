"""Operator 8: main text of web pages by minimum-cut labelling.

A page becomes a row of text blocks with their elements. A linear classifier with fixed weights gives
each block the costs of either label: length, sentence marks, links, its element and what the elements
above it say of it. These costs are the capacities of its edges from the source and to the sink.
Neighbouring blocks, and blocks that look alike and follow each other in one parent element, are joined by smoothness edges,
heavier the fewer elements lie between them and if they look alike. Maximum flow over all blocks of a
page separates content from boilerplate: the minimum cut is the labelling of least cost. So a short
paragraph among long ones stays, and a sentence in a list of links goes.

Reading a page takes time in proportion to its length, whatever its markup is.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions.shipping import ship

# Element names by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
RAW = frozenset("script style title textarea noscript template iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr math mi mn mo ms mtext mrow mfrac msup msub msqrt mroot mover munder semantics annotation svg g text tspan path circle rect line".split())
#: What an element's name says of the blocks in it: above 0 speaks for content.
ELEMENT = {"nav": -6.0, "menu": -6.0, "footer": -6.0, "header": -5.0, "aside": -5.0, "form": -5.0, "button": -5.0, "select": -5.0, "dialog": -5.0, "fieldset": -5.0, "head": -8.0, "h1": 1.2, "h2": 0.5, "h3": 0.4, "p": 0.3, "blockquote": 0.3, "pre": 0.5, "figcaption": 0.3}
#: Words of classes, ids and roles for a place on the page; <main> and <article> inside such an element are free of it.
PLACE = frozenset("nav navbar navigation menu menus header masthead topbar footer foot bottombar sidebar sidebars side aside rail toolbar banner complementary contentinfo".split())
#: Words for a kind of boilerplate, whatever is inside.
KIND = frozenset("ad ads adbox adslot advert adverts advertisement advertisements advertising sponsor sponsored sponsors promo promos promoted promotion breadcrumb breadcrumbs related recommended recommendations widget widgets share sharing social cookie cookies consent gdpr notice notices alert alerts warning popup modal overlay newsletter subscribe subscription signup signin login form search pagination pager comment comments commentlist discussion disqus reply replies respond copyright legal dialog tags hidden".split())
FOR = frozenset("article content main post entry story text body articlebody".split())
#: In front of another word these say what the page has, not what the element is ("has-sidebar").
_STATE = frozenset("has with no without hide show is not".split())
_AGAINST, _FOR, _FOR_MOST = -5.0, 0.6, 1.5
#: Blocks inside and outside of <main> or <article> where the page has them, and anywhere where it has not.
_INSIDE, _OUTSIDE, _UNKNOWN = 1.2, -1.0, 1.2
_OPENING = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_VALUE = re.compile(r"""=\s*+(["'])|>""")
_NAMED = re.compile(r"""(?:^|\s)(class|id|role|hidden|itemprop)(?![\w-])\s*+(?:=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++)))?""", re.I)
_WORD = re.compile(r"[a-z]+")
_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*+>", re.I) for name in RAW}
#: An element that starts ends these on top of it.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Smoothness of blocks in one element, its decay with each element between them, and its share where they look different.
SMOOTH, DECAY, UNLIKE = 1.2, 0.5, 0.4
_UNIT = 64  # capacities are whole numbers of 1 / _UNIT


class Block:
    __slots__ = ("parent", "low", "depth", "look", "says", "name", "inside", "text", "linked")

    def __init__(self, parent: int, low: int, depth: int, look: tuple[str, str], says: float, name: str, inside: bool) -> None:
        self.parent, self.low, self.depth, self.look, self.says, self.name, self.inside = parent, low, depth, look, says, name, inside
        self.text: list[str] | str = []
        self.linked = 0


def hint(attributes: str) -> tuple[float, float, float]:
    """What an element's class, id and role say: (of its place, of its kind, for content). A word counts for each name alone: "content has-sidebar" is content."""
    place = kind = good = 0.0
    for name, *value in _NAMED.findall(attributes):
        if name.lower() == "hidden":
            kind = _AGAINST
        for token in "".join(value).lower().split():
            words = _WORD.findall(token)
            if len(words) > 1 and words[0] in _STATE:
                continue
            if not KIND.isdisjoint(words):
                kind = _AGAINST
            elif not PLACE.isdisjoint(words):
                place = _AGAINST
            elif not FOR.isdisjoint(words):
                good = _FOR
    return place, kind, good


class _Open:
    """An open element: what it and those above it say of the blocks in it."""

    __slots__ = ("name", "number", "look", "place", "kind", "good", "inside", "own")

    def __init__(self, name: str, number: int, look: tuple[str, str], above: _Open | None, attributes: str) -> None:
        place, kind, good = hint(attributes) if attributes else (0.0, 0.0, 0.0)
        self.name, self.number, self.look, self.own = name, number, look, 0.0
        up_place, up_kind, up_good, self.inside = (above.place, above.kind, above.good, above.inside) if above else (0.0, 0.0, 0.0, False)
        if name in ("main", "article"):
            up_place = place = 0.0
            self.inside = True
        elif name in ("html", "body"):
            place = kind = 0.0
        else:
            own = ELEMENT.get(name, 0.0)
            if own < 0 and not (name == "header" and self.inside):
                kind = min(kind, own)
            self.own = max(own, 0.0)
        if place or kind:
            good = up_good = 0.0  # what speaks for the whole says nothing of such a part
        self.place, self.kind, self.good = min(up_place, place), min(up_kind, kind), min(up_good + good, _FOR_MOST)

    def says(self) -> float:
        return max(self.place + self.kind, -8.0) + self.good + self.own


def tag_end(html: str, at: int) -> int:
    """The place of the > that ends a tag whose name ends at ``at``; -1 if none does. A quote counts behind an equals sign only, and only if it is closed."""
    while True:
        m = _VALUE.search(html, at)
        if m is None:
            return -1
        if m[1] is None:
            return m.start()
        close = html.find(m[1], m.end())
        at = close + 1 if close >= 0 else m.end()


def blocks(html: str) -> list[Block]:
    """The blocks that have text, in page order."""
    out: list[Block] = []
    open_: list[_Open] = []
    count: Counter[str] = Counter()  # open elements by name
    nested: Counter[str] = Counter()  # plain inline elements open in a marked one of that name
    number = links = at = low = 0
    unclosed: set[str] = set()  # quotes that have no partner any more
    block: Block | None = None
    n, last = len(html), html.rfind(">")

    def say(text: str) -> None:
        nonlocal block, low
        text = unescape(text) if "&" in text else text
        if block is None:
            if not text.strip():
                return
            top = open_[-1] if open_ else None
            block = Block(open_[-2].number if len(open_) > 1 else 0, low, len(open_), top.look if top else ("", ""), top.says() if top else 0.0, top.name if top else "", bool(top and top.inside))
            low = len(open_)
            out.append(block)
        block.text.append(text)
        if links:
            block.linked += len(text)

    def pop() -> str:
        nonlocal low
        name = open_.pop().name
        count[name] -= 1
        nested[name] = 0
        low = min(low, len(open_))
        return name

    def push(name: str, attributes: str) -> None:
        nonlocal number
        number += 1
        open_.append(_Open(name, number, (name, attributes.strip()), open_[-1] if open_ else None, attributes))
        count[name] += 1

    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            say(html[at:])
            break
        if lt > at:
            say(html[at:lt])
        m = _OPENING.match(html, lt)
        if m is None or lt > last:
            if html.startswith("<!--", lt):
                end = lt + 3 if html.startswith(("<!-->", "<!--->"), lt) else html.find("-->", lt + 4)
                if end < 0:
                    break  # a comment without an end
                at = html.find(">", end) + 1
            elif html.startswith(("<!", "<?", "</"), lt) and lt < last:
                at = html.find(">", lt) + 1
            else:
                say("<")
                at = lt + 1
            continue
        name, closes = m[2].lower(), m[1]
        end = tag_end(html, m.end()) if not closes and not unclosed else html.find(">", m.end())
        if end < 0:
            unclosed.add("quote")  # what follows is read without quotes
            end = html.find(">", m.end())
        attributes, at = html[m.end() : end], end + 1
        if name in RAW and not closes:
            if not attributes.endswith("/"):
                found = _ENDS[name].search(html, at)
                at = found.end() if found else n
            block = block if name in ("script", "style", "noscript", "template") else None
            continue
        if name == "a":
            links = max(0, links + (-1 if closes else 1))
        if name in INLINE:
            if name == "br":
                say(" ") if block else None
            elif not closes and name != "a" and attributes and min(hint(attributes)) < 0:
                block = None  # an inline element that is marked as boilerplate is a block of its own
                push(name, attributes)
            elif count[name]:
                if not closes:
                    nested[name] += name not in VOID
                elif nested[name]:
                    nested[name] -= 1
                else:
                    block = None
                    while pop() != name:
                        pass
            continue
        block, links = None, 0
        if closes:
            if count[name]:
                while pop() != name:
                    pass
            continue
        if open_ and open_[-1].name == "p":
            pop()
        while open_ and open_[-1].name in _CLOSES.get(name, ()):
            pop()
        if name in VOID:
            continue
        if name == "body":
            while open_ and open_[-1].name == "head":
                pop()
        push(name, attributes)
    kept: list[Block] = []
    low = n
    for b in out:
        b.text = " ".join("".join(b.text).split())
        low = min(low, b.low)
        if b.text:
            b.low, low = low, n
            kept.append(b)
    return kept


def margins(found: list[Block]) -> list[float]:
    """The classifier: log odds that a block is content."""
    known = any(b.inside for b in found)
    out = []
    for b in found:
        words = b.text.count(" ") + 1
        marks = sum(map(b.text.count, ".,;:!?"))
        own = min(max(0.8 * math.log1p(words) - 2.0 + 0.25 * min(marks, 4), -2.0), 2.5)
        linked = min(1.0, b.linked / len(b.text))
        sign = 2.5 if "©" in b.text[:3] else 0.0
        out.append(b.says + own - 3.0 * linked - sign + (_UNKNOWN if not known else _INSIDE if b.inside else _OUTSIDE))
    return out


def edges(found: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness edges: of neighbours on the page, and of each block with the next one that looks like it in the same parent element."""
    out = []
    last: dict[tuple[int, tuple[str, str]], int] = {}
    for j, b in enumerate(found):
        if j:
            a = found[j - 1]
            between = max(0, a.depth - b.low - 1) + max(0, b.depth - b.low - 1)
            out.append((j - 1, j, SMOOTH * DECAY**between * (1.0 if a.look == b.look else UNLIKE)))
        if (i := last.get((b.parent, b.look), j - 1)) < j - 1:
            out.append((i, j, SMOOTH))
        last[b.parent, b.look] = j
    return out


def labels(pull: list[float], links: list[tuple[int, int, float]]) -> list[bool]:
    """The labelling of least cost, true is content; of equally cheap ones that with the least content. Costs count in units of 1 / _UNIT."""
    n = len(pull)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[int] = []
    at: list[list[int]] = [[] for _ in range(n + 2)]
    reach = [1] * n  # more than all smoothness edges of a block: a terminal needs no more

    def edge(i: int, j: int, there: int, back: int) -> None:
        at[i].append(len(to)), to.append(j), room.append(there)
        at[j].append(len(to)), to.append(i), room.append(back)

    for i, j, w in links:
        if (c := round(w * _UNIT)) > 0:
            edge(i, j, c, c)
            reach[i] += c
            reach[j] += c
    for i, p in enumerate(pull):
        c = round(p * _UNIT)
        if c > 0:
            edge(source, i, min(c, reach[i]), 0)
        elif c < 0:
            edge(i, sink, min(-c, reach[i]), 0)
    while True:  # phases of shortest augmenting paths
        level = [-1] * (n + 2)
        level[source] = 0
        queue = [source]
        for u in queue:
            for e in at[u]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        tried = [0] * (n + 2)
        path: list[int] = []
        u = source
        while True:
            if u == sink:
                flow = min([room[e] for e in path])
                cut = next(k for k, e in enumerate(path) if room[e] == flow)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                u = to[path[cut] ^ 1]
                del path[cut:]
            while tried[u] < len(at[u]):
                e = at[u][tried[u]]
                if room[e] and level[to[e]] == level[u] + 1:
                    break
                tried[u] += 1
            else:
                if u == source:
                    break
                u = to[path.pop() ^ 1]
                tried[u] += 1
                continue
            path.append(e)
            u = to[e]


def main_text(html: str | None) -> str:
    """The text of the blocks labelled content, joined by a space. Null, empty or bare markup: an empty text."""
    found = blocks(html or "")
    if not found:
        return ""
    keep = labels(margins(found), edges(found))
    return " ".join([b.text for b, k in zip(found, keep, strict=True) if k])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars), one row per row.

    Null and empty pages have an empty text. Rows that repeat an id, or have none, each give a row of
    their own. An empty table gives no rows; other columns are ignored, whatever their names.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    ship(pages.sparkSession)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = [main_text(h.as_py()) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], names=["id", "url", "text", "n_chars"])

    out = rows.mapInArrow(each, f"id {rows.schema[0].dataType.simpleString()}, url {rows.schema[1].dataType.simpleString()}, text string, n_chars long")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")
