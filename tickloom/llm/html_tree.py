"""Main text of web pages by scoring the element tree.

Parts that never belong to the article (scripts, navigation, headers, footers,
sidebars, adverts, notices, form controls, reader comments) leave the tree first;
a form, and what only a class, id or role names, stays if it holds the article or
most of the page's text, and goes later if another container wins. Every
paragraph left earns points for its length and its commas, which it passes to
the elements around it, less to the farther ones. An element's points are
discounted by the share of its text that is in links. The best container is
kept, with those of its siblings that score well or are plain paragraphs.
"""

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_DROPPED = frozenset(
    "head title script style noscript template nav footer aside button select textarea input label legend option "
    "optgroup datalist output meter progress menu dialog iframe object embed svg canvas audio video map".split())
_HEADER = frozenset(("header",))
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split())
_PARAGRAPHS = frozenset("p pre td blockquote li dd figcaption".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What an opening tag ends, up to the nearest of the elements that hold it.
_ENDS = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table", "tbody", "thead", "tfoot")), "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select",)),
    "tbody": (("tbody", "thead", "tfoot", "tr", "td", "th"), ("table",)),
    "body": (("head",), ("html",)),
}
_ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main menu nav ol p pre section table ul".split())
#: Words in class, id or role that mark what is not the article.
_OUTSIDE = frozenset(
    "ad ads advert advertisement advertising adsense adslot banner sponsor sponsored promo promotion nav navbar "
    "navigation menu menubar breadcrumb breadcrumbs sidebar aside complementary footer contentinfo comment comments "
    "commentlist respond replies disqus discussion cookie cookies consent gdpr notice notices alert popup modal overlay "
    "dialog newsletter subscribe subscription signup login search share sharing social related recommended "
    "recommendations widget pagination pager toolbar tooltip skip hidden".split())
_OUTSIDE_HEADER = frozenset("header masthead topbar".split())
_COMMENTS = frozenset("comment comments commentlist respond replies disqus discussion".split())
_INSIDE = frozenset("article body content main post entry story text blog".split())
#: Words that go with those: a name of nothing but such words says what its element is,
#: while social-contract or related-work may be anything.
_BESIDE = frozenset(
    "area articles bar block body bottom box button buttons col column container content feed floating form group icon "
    "icons inline inner item items js left link links list main message module page panel pane post posts region right "
    "row section site slot sticky stories text thread title top unit wrap wrapper zone".split())
#: Marked by words alone, an element goes if so much of its text is in links, or if it is so short and no paragraph.
_LINKED, _SHORT = 0.5, 80
#: Lists of links within the article: so many links and such a share of the text.
_LIST_LINKS, _LIST_LINKED = 4, 0.75
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


class Element:
    """An element with its children, texts and elements in order."""

    __slots__ = ("tag", "words", "named", "parent", "children", "hidden", "chars", "commas", "linked", "points")

    def __init__(self, tag: str, attributes: dict[str, str | None], parent: "Element | None"):
        named = " ".join(attributes.get(key) or "" for key in ("class", "id", "role"))
        self.tag = tag
        self.words = frozenset(t.lower() for t in _TOKEN.findall(named)) if named.strip() else frozenset()
        # Whether one of its names says that it is not the article, and nothing else.
        self.named = bool(self.words & (_OUTSIDE | _OUTSIDE_HEADER)) and any(
            words & (_OUTSIDE | _OUTSIDE_HEADER) and all(w in _OUTSIDE | _OUTSIDE_HEADER | _BESIDE or w.isdigit() for w in words)
            for words in ({t.lower() for t in _TOKEN.findall(name)} for name in named.split()))
        self.hidden = "hidden" in attributes or attributes.get("aria-hidden") == "true" or bool(
            _HIDDEN.search(attributes.get("style") or ""))
        self.parent = parent
        self.children: list[Element | str] = []
        self.chars = self.commas = self.linked = 0
        self.points = 0.0


class _Builder(HTMLParser):
    """Builds the tree as a browser would, for the tags whose ends may be left out.

    How many elements of each tag are open is counted, so that an end without a
    beginning costs no walk to the root.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Element("html", {}, None)
        self.open: dict[str, int] = {}

    def parse_marked_section(self, i, report=1):
        """Whatever ``<![`` begins is a comment up to the next ``>``, as in browsers."""
        end = self.rawdata.find(">", i)
        return -1 if end < 0 else end + 1

    def parse_declaration(self, i):
        end = self.rawdata.find(">", i)
        return -1 if end < 0 else end + 1

    def handle_starttag(self, tag, attrs):
        if tag == "html":
            return
        if tag in _ENDS_PARAGRAPH:
            self._end(("p",), ("article", "section", "div", "td", "th", "li", "body", "button", "table"))
        if tag in _ENDS:
            self._end(*_ENDS[tag])
        node = Element(tag, dict(attrs), self.at)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node
            self.open[tag] = self.open.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if self.open.get(tag):
            node = self.at
            while node.tag != tag:
                node = node.parent
            self._leave(node)
        elif tag == "p":
            self.at.children.append(Element("p", {}, self.at))

    def handle_data(self, data):
        self.at.children.append(data)

    def _leave(self, node):
        """Go on behind ``node``; all that is open within it ends."""
        while True:
            left, self.at = self.at, self.at.parent
            self.open[left.tag] -= 1
            if left is node:
                return

    def _end(self, tags, holders):
        """Leave the outermost of ``tags`` that is open within the nearest of ``holders``."""
        if not any(self.open.get(tag) for tag in tags):
            return
        node, last = self.at, None
        while node is not self.root and node.tag not in holders:
            if node.tag in tags:
                last = node
            node = node.parent
        if last is not None:
            self._leave(last)


def parse(html: str) -> Element:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


def _below(root: Element) -> list[Element]:
    """All elements, each before its children."""
    found, stack = [], [root]
    while stack:
        node = stack.pop()
        found.append(node)
        stack.extend(reversed([c for c in node.children if not isinstance(c, str)]))
    return found


def _within(node: Element, tags: tuple[str, ...]) -> bool:
    while node is not None:
        if node.tag in tags:
            return True
        node = node.parent
    return False


def _replaced(root: Element, instead) -> None:
    """Put ``instead(element)`` in an element's place: what is given for it, or None to keep it and go on below it."""
    stack = [root]
    while stack:
        node = stack.pop()
        kept: list[Element | str] = []
        for child in node.children:
            given = None if isinstance(child, str) else instead(child)
            if given is not None:
                kept += given
                continue
            kept.append(child)
            if not isinstance(child, str):
                stack.append(child)
        node.children = kept
        for child in kept:
            if not isinstance(child, str):
                child.parent = node


def _headings(node: Element) -> list[Element | str]:
    """What stays of a header: its headings, inside an article."""
    if not _within(node, ("article", "main")):
        return [" "]
    return [c for c in _below(node) if c.tag in _HEADINGS and not c.words & _OUTSIDE] + [" "]


def _marked(node: Element) -> bool:
    """Whether the element may not be the article, by a word of its class, id or role, or as a form.

    A name of nothing but such words is taken at its word. Of others, as
    related-work or has-sidebar, an element has to be mostly links, or short and
    no paragraph. Needs ``_measured`` elements.
    """
    if node.tag in ("body", "article", "main"):
        return False
    if node.tag == "form" or node.named:
        return True
    if not node.words & (_OUTSIDE | _OUTSIDE_HEADER):
        return False
    return _density(node) >= _LINKED or node.chars < _SHORT and node.tag not in _PARAGRAPHS | _HEADINGS


def _is_core(node: Element) -> bool:
    """Whether the tag says that the element is the article; a reader's comment may be an <article> as well."""
    if node.tag != "article":
        return node.tag == "main"
    return not node.words & _OUTSIDE or bool(node.words & _INSIDE) and "comment" not in node.words


def _unmarked(root: Element, gone: set[int]) -> None:
    """Take the elements in ``gone`` out, by ``id``."""
    def instead(node: Element) -> list[Element | str] | None:
        if id(node) not in gone:
            return None
        return [" "] if node.words & _OUTSIDE or node.tag == "form" else _headings(node)

    if gone:
        _replaced(root, instead)


def _weight(node: Element) -> float:
    """Points of all text below that is not in links."""
    return node.commas + (node.chars - node.linked) / 100.0


def _most(node: Element, root: Element) -> bool:
    return 2.0 * _weight(node) > _weight(root)


def _stripped(root: Element) -> None:
    """Take out what is never part of the article; of headers inside an article the headings stay.

    A word in class, id or role is not enough, as wrappers are named has-sidebar
    or no-comments too. A marked element stays if it holds the only article or
    main, or several with a quarter of the page's text, or most of that text while
    no article or main lies beside it. Comments go first, however long they are, if there is other text and no article in them.
    """
    def instead(node: Element) -> list[Element | str] | None:
        if node.tag in ("body", "article", "main"):
            return None
        if node.tag in _DROPPED or node.hidden:
            return [" "]
        if node.tag in _HEADER:
            return [" "] if node.words & _OUTSIDE else _headings(node)
        return None

    _replaced(root, instead)
    nodes = _below(root)
    _measured(nodes)
    if not any(_marked(n) for n in nodes):
        return
    held = _cores_below(nodes)
    _unmarked(root, {
        id(n) for n in nodes
        if _marked(n) and n.words & _COMMENTS and not n.words & _INSIDE and not held[id(n)]
        and _weight(root) > _weight(n)})

    nodes = _below(root)
    _measured(nodes)
    held = _cores_below(nodes)
    # Articles by the marked element next around them.
    nearest = {id(root): id(root)}
    free: dict[int, int] = {}
    for node in nodes:
        if node is not root:
            nearest[id(node)] = id(node) if _marked(node) else nearest[id(node.parent)]
        if _is_core(node) and node.chars:
            free[nearest[id(node)]] = free.get(nearest[id(node)], 0) + 1
    gone = set()
    # An element, the articles around it, those around it or beside it, whether it is within an article.
    stack = [(root, 0, free.get(id(root), 0), False)]
    while stack:
        node, around, seen, inside = stack.pop()
        if _marked(node):
            holds = held[id(node)] and (held[id(root)] == 1 or 4.0 * _weight(node) >= _weight(root))
            if not (holds and not inside or _most(node, root) and seen == around):
                gone.add(id(node))
                continue
            seen += free.get(id(node), 0)
        around += _is_core(node) and node.chars > 0
        inside = inside or node.tag == "article"
        stack.extend((c, around, seen, inside) for c in node.children if not isinstance(c, str))
    _unmarked(root, gone)


def _cores_below(nodes: list[Element]) -> dict[int, int]:
    """How many articles with text every element holds, by ``id``; those within others are not counted."""
    held = {id(n): 0 for n in nodes}
    for node in reversed(nodes):
        if node.parent is not None:
            held[id(node.parent)] += 1 if _is_core(node) and node.chars else held[id(node)]
    return held


def _settled(root: Element, best: Element) -> None:
    """Take out the marked elements that stayed for their points and did not win."""
    winners = set()
    node = best
    while node is not None:
        winners.add(id(node))
        node = node.parent
    _unmarked(root, {
        id(n) for n in _below(root) if _marked(n) and id(n) not in winners and not _most(n, root)})


def _measured(nodes: list[Element]) -> None:
    """Characters, commas and characters in links below every element."""
    for node in reversed(nodes):
        node.chars = node.commas = node.linked = 0
        for child in node.children:
            if isinstance(child, str):
                node.chars += len(child.strip())
                node.commas += child.count(",") + child.count("،") + child.count("、") + child.count("，")
            else:
                node.chars += child.chars
                node.commas += child.commas
                node.linked += child.chars if child.tag == "a" else child.linked


def _density(node: Element) -> float:
    return node.linked / node.chars if node.chars else 0.0


def _is_paragraph(node: Element) -> bool:
    if node.tag in _PARAGRAPHS:
        return True
    return node.tag in ("div", "section", "article", "main", "body") and any(
        isinstance(c, str) and c.strip() for c in node.children)


def _scored(nodes: list[Element]) -> Element | None:
    """Points for all elements; the best container, the first of equals, none without any text."""
    holders: dict[int, Element] = {}
    for node in nodes:
        if not _is_paragraph(node) or not node.chars:
            continue
        earned = 1.0 + node.commas + min(node.chars / 100.0, 3.0)
        holder = node.parent if node.tag in _PARAGRAPHS else node
        distance = 0
        while holder is not None and distance < 5:
            holder.points += earned / (1, 2, 6, 9, 12)[distance]
            holders[id(holder)] = holder
            holder, distance = holder.parent, distance + 1
    best, most = None, -1.0
    for node in nodes:
        if id(node) in holders:
            node.points += {"article": 25.0, "main": 25.0, "div": 5.0, "section": 3.0}.get(node.tag, 0.0)
            node.points += 25.0 if node.words & _INSIDE else 0.0
            node.points *= 1.0 - _density(node)
            if node.points > most:
                best, most = node, node.points
    return best


def _kept(best: Element) -> list[Element]:
    """The best container, or the article around it, and the unmarked siblings that go with it."""
    node = best
    while node is not None:
        if node.tag in ("article", "main"):
            _without_link_lists(node)
            return [node]
        node = node.parent
    if best.parent is None:
        return [best]
    # Short blocks of about the same points belong together as well.
    least = max(min(10.0, 0.5 * best.points), 0.2 * best.points)
    found = []
    for child in best.parent.children:
        if isinstance(child, str):
            continue
        plain = child.tag in _PARAGRAPHS | _HEADINGS | {"ul", "ol", "dl", "table", "figure"}
        if child is best or not _marked(child) and child.points >= least or plain and child.chars and _density(child) < 0.25:
            found.append(child)
    return found


def _without_link_lists(core: Element) -> None:
    """Take out blocks below the article that are little more than a list of links."""
    links: dict[int, int] = {}
    for node in reversed(_below(core)):
        links[id(node)] = (node.tag == "a") + sum(links[id(c)] for c in node.children if not isinstance(c, str))

    def instead(node: Element) -> list[Element | str] | None:
        block = node.tag in ("div", "section", "ul", "ol", "dl", "table")
        return [" "] if block and links[id(node)] >= _LIST_LINKS and _density(node) >= _LIST_LINKED else None

    _replaced(core, instead)


def block_text(roots: list[Element]) -> str:
    """Blocks in page order, white space in and between them one space."""
    parts: list[str] = []
    stack: list[Element | str] = list(reversed(roots))
    while stack:
        node = stack.pop()
        if isinstance(node, str):
            parts.append(node)
        elif node.tag in _INLINE:
            stack.extend(reversed(node.children))
        else:
            parts.append(" ")
            stack.append(" ")
            stack.extend(reversed(node.children))
    return " ".join("".join(parts).split())


def main_text(html: str | None) -> str:
    """The article's text; empty for a null, empty or textless page.

    Of several containers with the same points the first is the article. No page
    is an error: what is not markup is text, ends without a beginning are passed
    over, and what is still open ends with the page.
    """
    if not html:
        return ""
    root = parse(html)
    _stripped(root)
    nodes = _below(root)
    _measured(nodes)
    best = _scored(nodes)
    if best is None:
        return block_text([root])
    _settled(root, best)
    return block_text(_kept(best))


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html) with ``text`` and ``n_chars`` for ``html``.

    Null, empty and textless pages have an empty text and 0 characters, malformed
    ones are read as ``main_text`` says. Rows come out one by one, repeated ones
    as often as they are there, whatever their other columns hold; columns named
    text or n_chars are replaced. An empty table gives no rows.
    """

    @F.pandas_udf("string")
    def text(html: pd.Series) -> pd.Series:
        return pd.Series([main_text(page) for page in html], dtype=object)

    kept = [c for c in pages.columns if c not in ("html", "text", "n_chars")]
    return pages.select(*kept, text("html").alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))
