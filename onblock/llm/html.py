"""Main text of web pages by composite text density.

Every block of a page gets its characters per tag, adjusted for links. The block whose child densities sum up highest is the core of the
article; the least density between it and the body is the threshold that other parts of the page on that path have to reach.
Parts that say what they are by element or role (navigation, forms ...) are taken out before anything is counted. Parts whose class or id
names them so (adverts, comments ...) are taken out too, unless they hold the core of the whole page.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from math import e, log

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from onblock.llm.tables import ship

# Element names by their role in HTML, and words by which pages name parts that are no article text.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
LEFT_OUT = set("script style noscript template head title svg math iframe object canvas audio video form button select textarea nav footer aside menu dialog".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
WHOLE = {"article", "main"}
NEVER_BY_NAME = {"html", "body", "article", "main"} | HEADINGS
ENDS_PARAGRAPH = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
ROLES = set("navigation banner contentinfo complementary search alert dialog alertdialog menu menubar toolbar form".split())
NAMES = set(
    "ad ads adv advert adverts advertisement adsense banner breadcrumb breadcrumbs byline comment comments consent cookie cookies discussion disqus footer gdpr header login "
    "masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup promo promoted promotion recommended related replies reply "
    "respond search share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget".split()
)

ship(__name__)


class Node:
    __slots__ = ("tag", "parent", "children", "left_out", "named", "text", "tags", "link_text", "link_tags", "density", "density_sum")

    def __init__(self, tag: str, parent: Node | None, left_out: bool = False):
        self.tag, self.parent, self.left_out, self.named = tag, parent, left_out, False
        self.children: list[Node | str] = []
        self.text = self.link_text = self.tags = self.link_tags = 0
        self.density = self.density_sum = 0.0


def _left_out(tag: str, attributes: dict[str, str | None], parent: Node) -> bool:
    if tag in LEFT_OUT or "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    if (attributes.get("role") or "").lower() in ROLES:
        return True
    if tag == "header":
        while parent is not None and parent.tag not in WHOLE:
            parent = parent.parent
        return parent is None
    return False


def _named(tag: str, attributes: dict[str, str | None]) -> bool:
    """Whether a class or the id is one of NAMES, or begins with one as its first part."""
    if tag in NEVER_BY_NAME and not (tag == "article" and "comment" in (attributes.get("class") or "")):
        return False
    tokens = f"{attributes.get('class') or ''} {attributes.get('id') or ''}".split()
    return any(re.match(r"[a-z]*", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", token).lower())[0] in NAMES for token in tokens)


class Page(HTMLParser):
    """A tree of elements and text; end tags may be missing or misplaced."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.root = Node("#page", None)
        self.at, self.nodes = self.root, [self.root]
        self.feed(html)
        self.close()

    def _close(self, tags: set[str], scope: set[str]) -> None:
        """Ends the innermost open element of these tags, unless one of the scope lies between."""
        node = self.at
        while node.parent is not None and node.tag not in scope:
            if node.tag in tags:
                self.at = node.parent
                return
            node = node.parent

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ENDS_PARAGRAPH:
            self._close({"p"}, {"button", "table", "td", "th", "article", "section", "div", "blockquote", "li"})
        if tag in HEADINGS and self.at.tag in HEADINGS:
            self.at = self.at.parent
        if tag in ENDED_BY:
            self._close(ENDED_BY[tag], SCOPES[tag])
        node = Node(tag, self.at, self.at.left_out or _left_out(tag, dict(attrs), self.at))
        node.named = not node.left_out and _named(tag, dict(attrs))
        self.at.children.append(node)
        self.nodes.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in ("p", "div", "a", "span", "b", "i"):
            self.at = self.at.parent

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID:
            return
        self._close({tag}, {"article", "td", "th"} - {tag} if tag in INLINE or tag == "p" else set())

    def handle_data(self, data: str) -> None:
        if not self.at.left_out:
            self.at.children.append(data)


def _measure(page: Page) -> Node:
    """Fills in the densities, children before parents, and returns the body or else the root."""
    for node in page.nodes:
        node.text = node.link_text = node.tags = node.link_tags = 0
        node.density = node.density_sum = 0.0
    for node in reversed(page.nodes):
        if node.left_out:
            continue
        for child in node.children:
            if isinstance(child, str):
                node.text += len("".join(child.split()))
            elif not child.left_out:
                node.text += child.text
                node.tags += child.tags + (child.tag not in INLINE and child.tag != "br")
                node.link_text += child.text if child.tag == "a" else child.link_text
                node.link_tags += child.link_tags + (child.tag == "a")
    body = next((n for n in page.nodes if n.tag == "body" and not n.left_out), page.root)
    share = body.link_text / max(body.text, 1)
    for node in reversed(page.nodes):
        if node.left_out or not node.text:
            continue
        text, tags, links = node.text, max(node.tags, 1), node.link_text
        base = log(text / max(text - links, 1) * links + share * text + e)
        node.density = text / tags * log(max(text / max(links, 1) * tags / max(node.link_tags, 1), 1.0)) / max(log(base), 1e-6)
        own = [c.density for c in node.children if isinstance(c, Node) and c.tag not in INLINE]
        node.density_sum = sum(own) if any(own) else node.density
    return body


def _core(page: Page) -> Node | None:
    """The block whose child densities sum up highest; the first of equal ones, so the outermost."""
    blocks = [n for n in page.nodes if n.text and not n.left_out and n.tag not in INLINE]
    return max(blocks, key=lambda n: n.density_sum, default=None)


def _selected(page: Page) -> set[int]:
    """Ids of the subtrees that make up the article."""
    body = _measure(page)
    core = _core(page)
    if core is not None and any(n.named for n in page.nodes):
        node = core
        while node is not None:
            node.named = False
            node = node.parent
        for n in page.nodes:  # parents before children
            n.left_out = n.left_out or n.named or (n.parent is not None and n.parent.left_out)
        body = _measure(page)
        core = _core(page)
    if core is None:
        return set()
    node: Node | None = core
    while node is not None:
        if node.tag in WHOLE:
            return {id(node)}
        node = node.parent
    path = [core]
    while path[-1] is not body and path[-1].parent is not None:
        path.append(path[-1].parent)
    threshold = min(n.density for n in path)
    chosen = {id(core)}
    for inner, outer in zip(path, path[1:], strict=False):
        for child in outer.children:
            if isinstance(child, Node) and child is not inner and not child.left_out and (child.density >= threshold or child.tag in HEADINGS):
                chosen.add(id(child))
    return chosen


def main_text(html: str) -> str:
    """The article's blocks, one to a line; empty where a page has no text outside the parts that are left out."""
    page = Page(html)
    chosen = _selected(page)
    blocks: list[str] = []
    line: list[str] = []

    def end_block() -> None:
        text = " ".join("".join(line).split())
        if text:
            blocks.append(text)
        line.clear()

    todo: list[tuple[Node | str | None, bool]] = [(page.root, id(page.root) in chosen)]
    while todo:
        node, inside = todo.pop()
        if node is None:
            end_block()
        elif isinstance(node, str):
            if inside:
                line.append(node)
        elif not node.left_out:
            if node.tag not in INLINE:
                end_block()
                todo.append((None, inside))
            todo += [(child, inside or (isinstance(child, Node) and id(child) in chosen)) for child in reversed(node.children)]
    end_block()
    return "\n".join(blocks)


@F.arrow_udf(T.StringType())
def _main_texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for pages in batches:
        yield pa.array([main_text(html) for html in pages.to_pylist()], pa.string())


def extract(html: Column) -> Column:
    """Main text of whole pages. Null and empty pages, and pages without text, give an empty text; broken markup is read as far as it goes.

    Character references are decoded, white space within a block becomes one space, blocks and lines that `<br>` ends are joined by a
    line feed. Every row is one call of its own, so repeated rows and other columns do not matter.
    """
    return _main_texts(F.coalesce(html, F.lit("")))
