"""Main text of web pages by scoring the element tree.

A page is parsed leniently into a tree. Every paragraph passes points for its length and its commas to its ancestors,
the parent all of them and each further one half as many, discounted by its link density. What roles, element names
and class names say (menus, notices, adverts, reader comments and the like) lowers the scores of an element and of
all in it. The best container is kept; where its siblings hold much text too, their parent is the container instead,
else those siblings are kept that score or read like it. Of what is kept, an element that its name accuses goes unless it
holds most of the container's points, is a title or, where the name may mean something else, bears sentences; then the
text is cut into blocks. A name accuses only if nothing in it is unknown here, so an ad-hoc paragraph is no advert.
Lists of links stay in an article; elsewhere they are menus. Nothing goes or stays by its length.

Every step is a walk over the tokens or the tree with a bounded number of looks at each, so the time is in proportion
to the page, however deep, broken or hostile its markup is.

Defined cases: null or empty html gives an empty text. Broken markup closes where the next block starts; a tag that
never ends is text. White space of any kind inside a block, line breaks included, becomes one space. Nothing is cut
from what is kept, however long. Repeated rows are treated row by row, null ids kept; other columns stay outside the
result, those called text or n_chars included. An empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from paperloom.llm.common import ready, release

#: Element names of the HTML standard by their role here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
DROP = frozenset("audio button canvas datalist embed head input map menu meter nav object option progress select svg video".split()) | RAW
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
ACCUSED = {"aside": 2, "dialog": 2, "fieldset": 1, "footer": 1, "form": 1, "header": 1}
ROLES = {
    "navigation": 2, "complementary": 2, "search": 2, "dialog": 2, "alertdialog": 2, "alert": 2, "menu": 2, "menubar": 2,
    "toolbar": 2, "status": 2, "banner": 1, "contentinfo": 1, "form": 1,
}
#: Parts of class and id names: what always marks what is not the article, what mostly does, what speaks for a part
#: of the article beside the latter, and what denies either.
STRONG = frozenset(
    "ad ads advert advertisement adverts advertising adsense sponsor sponsored promo promoted comment comments disqus "
    "cookie cookies consent gdpr popup modal overlay newsletter subscribe".split()
)
#: What marks such parts too, but may be a part of the article: it stays where it bears sentences.
UNSURE = frozenset("discussion login promotion replies reply respond responses signup subscription".split())
WEAK = frozenset(
    "aside alert banner breadcrumb breadcrumbs footer header masthead menu nav navbar navigation notice pager pagination recommended "
    "recommendations related share sharing sidebar skip social tagcloud tags toolbar topbar widget widgets".split()
)
SPEAKS = frozenset("article body column container content entry layout main page post story text wrap wrapper".split())
DENIES = frozenset("has no not with without".split())
#: What names are made of beside these words; with any other word in it a name says nothing.
FRAME = frozenset(
    "action actions area author avatar bar block bottom box btn button center close control controls count data date desktop fixed footer "
    "form frame google group header heading hidden holder icon id info inline inner item items label large left link links list meta mobile "
    "outer panel primary right row secondary section site slot small social sticky thread title top unit user view zone".split()
)
FACTOR = (1.0, 0.3, 0.1)  # of the score, by how much is held against an element
STAYS = (0.0, 0.5, 0.9)  # share of the container's points beyond which an accused element stays

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_STOP = re.compile(r"[>\"']")
_ATTR = re.compile(r"([a-zA-Z][\w:-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_COMMA = re.compile("[,،、，;；]")
_ENDS = re.compile(r"[.!?…。！？][\"'”’»)\]]*$")
SHORT = 25  # characters below which a paragraph's points fall with its length


class Node:
    __slots__ = ("attrs", "block", "commas", "factor", "guilt", "heads", "kids", "length", "links", "open", "own", "parent", "points", "prose", "score", "tag", "tail", "titled", "total", "unsure")

    def __init__(self, tag: str, parent: Node | None, attrs: str = ""):
        self.tag, self.parent, self.attrs = tag, parent, attrs
        self.kids: list[Node | str] = []
        #: The nearest block, itself included, and of a block which inline elements are open in it.
        self.block = self if tag in BLOCK or parent is None else parent.block
        self.open: dict[str, int] = {} if self.block is self else self.block.open


def _tag_end(page: str, at: int, gone: set[str]) -> int:
    """Where the tag that is open at a place ends (at its >), or -1. Only a quote after = holds a >."""
    while True:
        m = _STOP.search(page, at) if ">" not in gone else None
        if m is None:
            gone.add(">")
            return -1
        i, c = m.start(), m.group()
        if c == ">":
            return i
        at = i + 1
        if c not in gone and page[max(0, i - 8) : i].rstrip().endswith("="):
            close = page.find(c, at)
            if close < 0:
                gone.add(c)  # no such quote from here to the end
            else:
                at = close + 1


def parse(page: str) -> Node:
    """The tree of a page. An end tag that closes nothing open is passed over."""
    root = here = Node("#root", None)
    blocks: dict[str, int] = {}  # open block elements by name
    gone: set[str] = set()  # marks that don't come any more
    at, n = 0, len(page)

    def beyond(mark: str, start: int) -> int:
        i = -1 if mark in gone else page.find(mark, start)
        if i < 0:
            gone.add(mark)
            return n
        return i + len(mark)

    def leave(node: Node) -> None:
        """Close an element and all that is open in it."""
        nonlocal here
        while True:
            x = here
            counts = blocks if x.block is x else x.open
            counts[x.tag] -= 1
            here = x.parent
            if x is node:
                return

    while at < n:
        i = page.find("<", at)
        if i < 0:
            here.kids.append(page[at:])
            break
        if i > at:
            here.kids.append(page[at:i])
        if page.startswith("<!--", i):
            at = beyond("-->", i + 4)
            continue
        if page.startswith("<![CDATA[", i):
            at = beyond("]]>", i + 9)
            here.kids.append(page[i + 9 : at - 3 if page.endswith("]]>", i + 9, at) else at])
            continue
        if page[i + 1 : i + 2] in ("!", "?"):
            at = beyond(">", i)
            continue
        ends = page.startswith("</", i)
        name = _NAME.match(page, i + 1 + ends)
        if not name:
            here.kids.append("<")
            at = i + 1
            continue
        tag = name.group().lower()
        stop = page.find(">", name.end()) if ends and ">" not in gone else _tag_end(page, name.end(), gone) if not ends else -1
        if stop < 0:
            gone.add(">")
            here.kids.append(page[i:])
            break
        at = stop + 1
        if ends:
            counts = blocks if tag in BLOCK else here.open
            if counts.get(tag, 0) > 0:
                node = here
                while node.tag != tag:
                    node = node.parent
                leave(node)
            continue
        attrs = page[name.end() : stop]
        if tag in BLOCK:
            # Inline elements that a block interrupts end with it, as does an open paragraph or item of its kind.
            node = here.block
            if node.tag == "p" or tag in ("li", "dt", "dd", "tr", "td", "th", "option") and node.tag == tag:
                leave(node)
            elif tag == "p":
                while here is not node:
                    leave(here)
        node = Node(tag, here, attrs)
        here.kids.append(node)
        if tag in VOID or attrs.endswith(" /") or attrs == "/":
            continue
        if tag in RAW:
            mark = f"</{tag}"
            end = None if mark in gone else re.compile(rf"{mark}\b", re.I).search(page, at)
            if end is None:
                gone.add(mark)
            at = beyond(">", end.end()) if end else n  # raw text of any kind is never kept
            continue
        here = node
        counts = blocks if node.block is node else node.open
        counts[tag] = counts.get(tag, 0) + 1
    return root


def _accuses(word: str) -> int:
    """What a class or id says against its element: 0 nothing, 1 what it mostly is, 2 what it always is, 3 what it may be."""
    parts = {p.lower() for p in _PARTS.findall(word)}
    if parts & DENIES or parts - STRONG - UNSURE - WEAK - SPEAKS - FRAME:
        return 0
    return 2 if parts & STRONG else 3 if parts & UNSURE else 1 if parts & WEAK and not parts & SPEAKS else 0


def _guilt(node: Node) -> int:
    """What speaks against an element: 0 nothing, 1 its kind or a name that mostly does, 2 one that always does.

    A name that may do so makes it unsure, beside 1.
    """
    worst = ACCUSED.get(node.tag, 0)
    if not node.attrs or node.tag in ("html", "body", "article", "main"):
        return worst
    for name, a, b, c in _ATTR.findall(node.attrs):
        name, value = name.lower(), a or b or c
        if name == "hidden" or name == "style" and _HIDDEN.search(value) or name == "aria-hidden" and value.lower() == "true":
            return 2
        if name == "role":
            worst = max(worst, ROLES.get(value.lower(), 0))
        if name in ("class", "id"):
            for word in entities.unescape(value).split():
                said = _accuses(word)
                node.unsure = node.unsure or said == 3
                worst = max(worst, 1 if said == 3 else said)
    return worst


def _walk(root: Node) -> list[Node]:
    """All elements, parents before children, in page order."""
    out, stack = [], [root]
    while stack:
        x = stack.pop()
        out.append(x)
        stack += [k for k in reversed(x.kids) if isinstance(k, Node)]
    return out


def _measure(root: Node) -> list[Node]:
    """Drop what is no text, decode the rest, and give every element its lengths, points, score and factor."""
    stack = [root]
    while stack:
        x = stack.pop()
        x.kids = [entities.unescape(k) if isinstance(k, str) and "&" in k else k for k in x.kids if isinstance(k, str) or k.tag not in DROP]
        stack += [k for k in x.kids if isinstance(k, Node)]
    nodes = _walk(root)
    for x in nodes:
        x.unsure = False
        x.guilt = _guilt(x) if x.parent else 0
        x.factor = (x.parent.factor if x.parent else 1.0) * FACTOR[x.guilt] * (1.5 if x.tag == "article" else 1.25 if x.tag == "main" else 1.0)
        x.length = x.links = x.own = x.commas = x.heads = x.prose = 0
        x.tail = ""
        x.points = x.score = x.total = 0.0
        x.titled = x.tag in ("h1", "h2", "hgroup")
    linked: dict[int, int] = {}  # of a block's own text
    for x in reversed(nodes):
        own = 0
        for k in x.kids:
            if isinstance(k, str):
                own += len(" ".join(k.split())) + (k[-1:].isspace() and bool(k.strip()))
                x.commas += len(_COMMA.findall(k))
        for k in reversed(x.kids):
            if tail := k[-80:].rstrip()[-8:] or k.rstrip()[-8:] if isinstance(k, str) else k.tail:
                x.tail = tail
                break
        x.own += own
        x.length += own
        if x.tag in HEADINGS:
            x.heads = x.length
        elif x.block is x and _ENDS.search(x.tail) and linked.get(id(x), 0) < 0.25 * x.own:
            x.prose += x.own
        if x.tag == "a":
            x.links = x.length
            linked[id(x)] = x.own
        up = x.parent
        if x.block is x:
            if x.own and x.tag not in HEADINGS:
                x.points = (1 + x.commas + x.own / 100) * min(1.0, x.own / SHORT) * (1 - min(1.0, linked.get(id(x), 0) / x.own))
            x.total += x.points
            if any(isinstance(k, Node) and k.block is k for k in x.kids):
                x.score += x.points  # loose text beside blocks is the element's own
                x.points = 0.0
        elif up is not None:
            up.own += x.own
            up.commas += x.commas
            linked[id(up)] = linked.get(id(up), 0) + linked.get(id(x), 0)
        if up is not None:
            up.length += x.length
            up.heads += x.heads
            up.prose += x.prose
            up.links += x.links
            up.total += x.total
            up.score += (x.points + x.score / 2 if x.block is x else x.score) * FACTOR[x.guilt]
            up.titled = up.titled or x.titled
    return nodes


def _density(node: Node) -> float:
    return min(1.0, node.links / node.length) if node.length else 0.0


def _value(node: Node) -> float:
    return node.score * (1 - _density(node)) * node.factor


def _reads(node: Node) -> bool:
    """A paragraph that is a sentence."""
    return node.tag in ("p", "blockquote", "pre") and _density(node) < 0.25 and (node.length > 80 or bool(_ENDS.search(node.tail)))


def _bears(node: Node) -> bool:
    """An element whose text is mostly sentences."""
    return node.prose >= 0.5 * node.length and _density(node) < 0.25


def _menus(nodes: list[Node]) -> set[int]:
    """Lists and boxes of short links."""
    many: dict[int, int] = {}
    for x in reversed(nodes):
        count = many.get(id(x), 0) + (x.tag == "a")
        if x.parent is not None:
            many[id(x.parent)] = many.get(id(x.parent), 0) + count
        many[id(x)] = count
    kinds = ("ul", "dl", "div", "table", "section")
    return {id(x) for x in nodes if x.tag in kinds and many[id(x)] >= 2 and _density(x) >= 0.8 and x.length < 25 * many[id(x)]}


def _goes(node: Node, whole: Node) -> bool:
    """Whether an accused element leaves a container. Footers and asides stay only where there is nothing else."""
    if not node.guilt:
        return False
    if node.tag in ("footer", "aside"):
        return node.length < whole.length
    if node.total > STAYS[node.guilt] * whole.total or node.unsure and node.guilt == 1 and _bears(node):
        return False
    if node.guilt == 1 and node.tag != "form":
        return not (node.titled and _density(node) < 0.5 or node.tag != "header" and _reads(node))
    return True


def _blocks(nodes: list[Node | str | None], whole: Node, menus: set[int]) -> list[str]:
    """Texts of blocks in page order, white space made one space, empty ones left out."""
    out: list[str] = []
    buffer: list[str] = []

    def cut() -> None:
        if text := " ".join("".join(buffer).split()):
            out.append(text)
        buffer.clear()

    stack: list[Node | str | None] = list(reversed(nodes))
    while stack:
        x = stack.pop()
        if x is None:
            cut()
        elif isinstance(x, str):
            buffer.append(x)
        elif x.tag == "br":
            buffer.append(" ")
        elif id(x) in menus or _goes(x, whole):
            cut() if x.block is x else buffer.append(" ")
        elif x.block is x:
            cut()
            stack.append(None)
            stack += reversed(x.kids)
        else:
            stack += reversed(x.kids)
    cut()
    return out


def _container(nodes: list[Node]) -> Node:
    """The element with the best score, or the parent of several that hold text."""
    best = max((n for n in nodes if n.block is n), key=_value, default=nodes[0])
    if _value(best) <= 0:
        whole = [n for n in nodes if n.tag in ("article", "main")] or [n for n in nodes if n.tag == "body"]
        return whole[0] if len(whole) == 1 else nodes[0]
    while (up := best.parent) is not None and up.tag not in ("html", "#root"):
        # An article is a whole: only other articles beside it speak for what holds them.
        beside = [k for k in up.kids if isinstance(k, Node) and k is not best and (best.tag != "article" or k.tag == "article")]
        if sum(k.total * FACTOR[k.guilt] * (1 - _density(k)) for k in beside) < 0.25 * best.total:
            whole = up
            while whole is not None and whole.tag not in ("article", "main"):
                whole = whole.parent
            # Within an article the rest of it is no other text, unless the article is accused as a whole.
            if best.tag in ("article", "main") or whole is None or whole.total > 1.5 * best.total:
                return best
        best = up
    return best


def extract(page: str | None) -> str:
    """The main text of one page, blocks joined by line feeds."""
    if not page:
        return ""
    root = parse(page)
    nodes = _measure(root)
    best = _container(nodes)
    # An article's lists of links are its own.
    menus = set() if best.tag == "article" else _menus(nodes)
    menus.discard(id(best))
    if best.tag in ("article", "main", "body") or best.parent is None:
        return "\n".join(_blocks(best.kids, best, menus))
    kept: list[Node | str | None] = []
    for k in best.parent.kids:
        if k is best:
            kept += [None, *k.kids, None]
        elif isinstance(k, str):
            kept.append(k)
        elif k.length and not k.guilt:
            like = _value(k) >= 0.2 * _value(best)
            titles = 2 * k.heads >= k.length and _density(k) < 0.5
            inline = k.block is not k and _density(k) < 0.5
            if like or titles or inline or _reads(k):
                kept.append(k)
        elif k.guilt and k.titled and 2 * k.heads >= k.length and _density(k) < 0.3 and k.tag == "header":
            kept.append(k)
    return "\n".join(_blocks(kept, best, menus))


def extract_pages(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page id, url, text, n_chars of every page row; reads those three columns and shuffles nothing."""
    ready(pages.sparkSession)
    cols = pages.select(id_col, url_col, html_col)
    kinds = [f"`{c}` {cols.schema[c].dataType.simpleString()}" for c in (id_col, url_col)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = [extract(h if isinstance(h, str) else None) for h in pdf[html_col]]
            yield pd.DataFrame({id_col: pdf[id_col], url_col: pdf[url_col], "text": texts, "n_chars": [len(t) for t in texts]})
        release()

    return cols.mapInPandas(run, ", ".join([*kinds, "text string", "n_chars long"]))
