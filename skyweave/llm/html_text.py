"""Main text of web pages by tree scoring: paragraphs pass points for length and commas to their ancestors, discounted by link
density; the best container is kept, with what stands around it and isn't a list of links. An article or main element around it is kept whole.

A page is read once from front to back, and open elements are counted by name, so that its cost grows with its length whatever it
holds. Names of elements and classes say what can't be main text; a container that only its class marks is kept where the text in it
says otherwise. White space is what str.split takes for it, no-break spaces too.

Null or empty html, or a page without main text: the empty text. Unclosed and stray tags are mended as browsers do for
paragraphs, list items and table parts. Null page_id, repeated rows: each row gets its own result. Empty table: no rows. Other columns are
ignored.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of HTML: elements without an end tag, with raw text, that end a paragraph, and that close their like.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
#: Foreign elements, the HTML elements that end them where they are left open, and the elements inside them that may hold HTML.
FOREIGN = frozenset("svg math".split())
BREAKOUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var article aside footer header main nav section".split())
INTEGRATED = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table article section div body blockquote td th".split())
LISTS = frozenset("ul ol dl table".split())
#: Elements that other elements' end tags don't reach out of, and the elements whose end tags do.
CELLS = frozenset("td th table".split())
REACHING = frozenset("td th table tr tbody article main body html".split())
#: Elements that never hold main text.
DROPPED = frozenset("head script style noscript template iframe svg math canvas object embed nav footer aside form button select textarea input dialog menu audio video".split())
#: Words of class, id or role that mark an element as beside the main text: whole, before the first `-` or `_`, or after a word of PLACED.
BESIDE = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar aside menu nav navbar navigation breadcrumb breadcrumbs footer header masthead cookie cookies consent notice notices gdpr popup modal newsletter subscribe signup login comment comments disqus replies respond share sharing social related recommended widget toolbar pagination pager skip search hidden contentinfo complementary alert".split())
PLACED = frozenset("site global main top bottom left right primary secondary".split())
#: Words that say nothing before a `-` or `_`, and words of readers' texts, which no size overrules.
WHOLE = frozenset("header hidden skip search alert notice notices".split())
READERS = frozenset("comment comments disqus replies respond".split())
#: Elements of running text: what their class says isn't about a container.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
#: What a compound like `comment-list` has to name, inside an article, to stand for a container.
HOLDERS = frozenset("area banner bar block box buttons container count form icons item items left link links list menu module nav panel posts right section sidebar slot stories thread toolbar tools top unit widget wrap wrapper".split())
#: Elements that show that a container holds text of its own.
BUILT = frozenset("h1 h2 h3 h4 h5 h6 p pre blockquote li dd dt table figure".split())
#: Elements whose id names a place to link to, inside an article.
ANCHORED = frozenset("section p h1 h2 h3 h4 h5 h6 li dt figure table".split())
#: A container that only its class marks is kept from this share of the page's text on, below this link density.
LARGE, DENSE = 0.5, 0.25
#: Link density from which what stands beside the best container is a list of links, and share of the page's text from which bare text of the body counts.
LINKS, BARE = 0.5, 0.2
#: Points of a container by its name, and of a paragraph for itself, for each comma and for each 100 characters, three at most.
CONTAINER = {"article": 25.0, "main": 20.0, "section": 3.0, "div": 5.0, "blockquote": 3.0, "td": 3.0, "body": 0.0}
SCORED = frozenset("p pre td blockquote li dd h2 h3 figcaption".split())

_OPEN = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*)|(!--)|(!\[CDATA\[)|[!?])")
_QUOTED = re.compile(r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*+")
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\s*(?:!\s*important\s*)?(?:;|$)", re.I)
_PART = re.compile(r"[-_]+")
_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}


class Node:
    """An element; its content holds texts and elements in order. `marked`: it is beside the main text by its class alone."""

    __slots__ = ("content", "name", "parent", "beside", "marked", "built", "score", "text_chars", "link_chars", "commas")

    def __init__(self, name: str, parent: Node | None, beside: bool = False):
        self.name, self.parent, self.beside, self.marked = name, parent, beside, False
        self.content: list[str | Node] = []
        self.built, self.score = name in BUILT, 0.0
        self.text_chars = self.link_chars = self.commas = 0


def _marks(token: str, inside: bool) -> set[str]:
    """The words of BESIDE that a class, id or role stands for; inside an article a compound does only if it names a container."""
    if token in BESIDE:
        return {token}
    parts = _PART.split(token)
    if len(parts) < 2 or inside and HOLDERS.isdisjoint(parts[1:]):
        return set()
    if parts[0] in PLACED and len(parts) == 2:
        return {parts[1]} & BESIDE
    return {parts[0]} & (BESIDE - WHOLE)


def _place(name: str, attributes: str, inside: bool) -> tuple[bool, bool]:
    """Whether an element, inside an article or not, is beside the main text, and whether its class alone says so and its text may
    overrule that."""
    if name in DROPPED:
        return True, False
    if name == "header":
        return not inside, False
    if name in ("html", "body", "article", "main") or not attributes:
        return False, False
    words: set[str] = set()
    for key, a, b, c in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), a or b or c
        if key == "hidden" or key == "aria-hidden" and value.strip().lower() == "true" or key == "style" and _UNSEEN.search(value):
            return True, False
        if name not in INLINE and (key in ("class", "role") or key == "id" and not (inside and name in ANCHORED)):
            for token in value.lower().split():
                words |= _marks(token, inside)
    if inside:
        words.discard("header")
    return bool(words), bool(words) and words.isdisjoint(READERS)


class _Path:
    """The open elements, and where in the path those of each name stand."""

    def __init__(self, root: Node):
        self.nodes, self.at = [root], defaultdict(list)

    def last(self, names) -> int:
        """Place of the innermost of these elements, or -1."""
        return max((self.at[n][-1] for n in names if self.at.get(n)), default=-1)

    def push(self, node: Node) -> None:
        self.at[node.name].append(len(self.nodes))
        self.nodes.append(node)

    def cut(self, place: int) -> None:
        while len(self.nodes) > place:
            self.at[self.nodes.pop().name].pop()


def _tags(page: str):
    """(start, end, closing, name, attributes) of the tags, front to back; (start, end, False, "", text) of comments and the like, with
    the text of a CDATA section. A `<` that no `>` follows is text, as all after it. A quote that never ends doesn't count as one, nor any
    after it."""
    at, last, quotes = 0, page.rfind(">"), True
    while (m := _OPEN.search(page, at)) is not None and m.start() < last or m is not None and m[3]:
        start, close = m.start(), None
        if m[3] or m[4]:
            stop, mark = page.find(end := "-->" if m[3] else "]]>", m.end()), len("-->")
            if stop >= 0 or m[3]:
                at = stop + mark if stop >= 0 else len(page)
                yield start, at, False, "", page[m.end() : stop] if m[4] else ""
                continue
        if m[2] and quotes:
            close = _QUOTED.match(page, m.end()).end()
            if close >= len(page) or page[close] != ">":
                close, quotes = None, False
        if close is None:
            close = page.find(">", m.end())
            if close < 0:
                return
        at = close + 1
        yield start, at, bool(m[1]), (m[2] or "").lower(), page[m.end() : close] if m[2] else ""


def parse(page: str) -> Node:
    """The page's element tree."""
    root = Node("html", None)
    path, at, marked = _Path(root), 0, []
    for start, stop, closing, name, attributes in _tags(page):
        if start < at:  # inside an element of raw text
            continue
        if start > at:
            path.nodes[-1].content.append(page[at:start])
        at = stop
        if not name:
            if attributes:
                path.nodes[-1].content.append(html.escape(attributes))
            continue
        if closing:
            place = path.last((name,))
            if place > 0 and (name in REACHING or place >= path.last(CELLS)):
                path.cut(place)
            continue
        foreign = path.last(FOREIGN)
        if foreign > 0 and path.last(INTEGRATED) > foreign:
            foreign = -1
        if foreign > 0 and name in BREAKOUT:
            path.cut(foreign)
            foreign = -1
        if name == "html" or name == "body" and path.last(("body",)) > 0:
            continue
        if name in BLOCK and (place := path.last(("p",))) > path.last(SCOPES):
            path.cut(place)
        if name in CLOSES and (place := path.last(CLOSES[name])) > path.last(LISTS):
            path.cut(place)
        if name == "body" and path.last(("head",)) == 1:
            path.cut(1)
        beside, doubtful = _place(name, attributes, path.last(("article", "main")) > 0)
        node = Node(name, path.nodes[-1], beside)
        path.nodes[-1].content.append(node)
        if doubtful:
            node.marked = True
            marked.append(node)
        if foreign > 0 and attributes.rstrip().endswith("/"):
            continue
        if name in RAW:
            end = _END[name].search(page, at)
            at = page.find(">", end.end()) + 1 if end else 0
            at = at or len(page)
        elif name not in VOID and not attributes.rstrip().endswith("/"):
            path.push(node)
    path.nodes[-1].content.append(page[at:])
    if marked:
        _overrule(root)
    return root


def _overrule(root: Node) -> None:
    """Keeps those containers marked by class alone that hold most of the page's text, little of it in links."""
    order, stack, size = [], [root], {}
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [c for c in node.content if isinstance(c, Node) and (not c.beside or c.marked)]
    for node in reversed(order):
        text = link = 0
        for c in node.content:
            if isinstance(c, str):
                text += len(" ".join(c.split()))
            elif c in size:
                text, link = text + size[c][0], link + size[c][1]
        size[node] = text, text if node.name == "a" else link
    for node in order:
        text, link = size[node]
        if node.marked and text >= LARGE * size[root][0] and link < DENSE * text:
            node.beside = False


def _weigh(root: Node) -> list[Node]:
    """Sets sizes and scores; gives the elements that have points, in page order."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [c for c in reversed(node.content) if isinstance(c, Node) and not c.beside]
    for node in reversed(order):
        for c in node.content:
            if isinstance(c, str):
                text = " ".join(html.unescape(c).split())
                node.text_chars += len(text)
                node.commas += text.count(",")
            elif not c.beside:
                node.built = node.built or c.built
                node.text_chars += c.text_chars
                node.link_chars += c.link_chars
                node.commas += c.commas
        if node.name == "a":
            node.link_chars = node.text_chars
    for node in order:
        inner = node.name == "div" and node.text_chars and not any(isinstance(c, Node) and c.name in BLOCK for c in node.content)
        if node.name not in SCORED and not inner or not node.text_chars:
            continue
        points = (1 + node.commas + min(node.text_chars / 100, 3)) * (1 - node.link_chars / node.text_chars)
        above, level = node.parent, 0
        while above is not None and level < 5:
            above.score += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
            above, level = above.parent, level + 1
    for node in order:
        if node.score or node.name in ("article", "main") and node.text_chars:
            node.score = (node.score + CONTAINER.get(node.name, 0.0)) * (1 - node.link_chars / max(1, node.text_chars))
    return [n for n in order if n.score > 0]


def _blocks(node: Node, left: frozenset | set = frozenset()) -> list[str]:
    """The texts of the element's blocks in page order, without the elements left out; a string that is left out stands as (element, place)."""
    out: list[list[str]] = [[]]
    stack: list[str | Node | None] = [node]
    while stack:
        x = stack.pop()
        if x is None:
            out.append([])
        elif isinstance(x, str):
            out[-1].append(x)
        elif not x.beside and x not in left:
            if x.name == "br":
                out[-1].append(" ")
                continue
            if x.name in BLOCK:
                out.append([])
                stack.append(None)
            stack += reversed(x.content if x.name != "body" else [c for i, c in enumerate(x.content) if (x, i) not in left])
    return [text for parts in out if (text := " ".join(html.unescape("".join(parts)).split()))]


def _around(best: Node) -> tuple[Node, set]:
    """The element to show, and what of it is left out: from the best container up to the body all that stands beside it is kept but lists of links; above the
    best container's parent, and in the body, only what is built of paragraphs, headings, lists or tables, or scores like it."""
    left, node, near = set(), best, True
    while (above := node.parent) is not None and node.name != "body":
        top = above.name in ("body", "html")
        bare = [i for i, c in enumerate(above.content) if isinstance(c, str) or c.name in INLINE or c.name == "br"]
        size = sum(len(" ".join(c.split())) if isinstance(c, str) else c.text_chars for i in bare if not isinstance(c := above.content[i], Node) or not c.beside)
        if top and size < BARE * above.text_chars:
            left |= {(above, i) for i in bare}
        for c in above.content:
            if not isinstance(c, Node) or c is node or c.name in INLINE or not c.text_chars:
                continue
            like = c.built or (near and not top) or c.score >= max(10.0, 0.2 * best.score)
            if not like or c.link_chars >= LINKS * c.text_chars:
                left.add(c)
        node, near = above, False
    return node, left


def main_text(page: str) -> str:
    """The blocks of the best container and of what stands around it, joined by line breaks."""
    if not page:
        return ""
    scored = _weigh(root := parse(page))
    if not scored:
        return "\n".join(_blocks(root))
    best = max(scored, key=lambda n: n.score)
    above = best
    while above is not None and above.name not in ("article", "main"):
        above = above.parent
    best = above or best
    if best.name == "article" and best.parent is not None:
        kept = [c for c in best.parent.content if c is best or isinstance(c, Node) and c.name == "article" and not c.beside and c.score >= 0.2 * best.score]
        return "\n".join(b for n in kept for b in _blocks(n))
    shown, left = (best, set()) if best.name in ("main", "article", "body") else _around(best)
    return "\n".join(_blocks(shown, left))


def _texts(column: pa.Array) -> pa.Array:
    return pa.array([main_text(x.as_py() or "") for x in column], pa.string())


def text_of(page: Column) -> Column:
    return F.arrow_udf(_texts, "string")(page)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One row per page: its id and url, text, n_chars."""
    return pages.select(page_id, url, text_of(F.col(page)).alias("text")).withColumn("n_chars", F.char_length("text").cast("bigint"))
