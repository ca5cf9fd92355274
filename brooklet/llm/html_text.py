"""Main text of web pages by composite text density (Sun, Song and Liao, 2011).

Every node of a page's tree gets a density: its characters per tag, adjusted for links. The
densities of a node's children are summed; the subtree with the largest sum is the article's core,
and the least density on its path to the body is a threshold. An ``article`` or ``main`` around the
core bounds the text; without one, what stands around the core belongs to the text as well, except
lists of links that do not reach the threshold. Parts that are markup by nature (menus, forms,
notices, comments of readers ...) are cut out before, unless they hold most of the page.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brooklet.llm.common import small_batches
from brooklet.llm.words import valid_text

SPLIT = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"""|<([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*'|["'])*?)(/?)(?:>|\Z)""", re.DOTALL)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""", re.DOTALL)

# The element names of HTML by what they are.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes noscript template".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img br".split())
NEVER = set(
    "head script style noscript template iframe object embed svg math canvas audio video map button input select "
    "option textarea nav aside footer menu dialog title link meta".split())
#: Parts beside the article, unless they hold most of the page's text.
FORMS = {"form", "fieldset"}
CLOSED_BY = {
    "p": set("address article aside blockquote center details div dl dt dd fieldset figure figcaption footer form h1 h2 h3 h4 h5 h6 "
             "header hr li main nav ol p pre section table tbody td th tr ul body".split()),
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "thead", "tfoot"}, "td": {"td", "th", "tr", "tbody"},
    "th": {"td", "th", "tr", "tbody"}, "option": {"option", "optgroup"}, "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"},
    "head": {"body"},
}
PARTS = set("p blockquote pre h1 h2 h3 h4 h5 h6 li ul ol dl dt dd figure figcaption center".split())
#: An element of these stops the search for one to close.
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}

# Words that name a part beside the article. A token of class, id or role does so if it has one of
# them and no others but those that say where the part is or what it looks like.
BESIDE = set(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar aside rail widget related recommended recommendations "
    "footer masthead header topbar toolbar cookie cookies consent gdpr notice notification alert popup modal overlay dialog "
    "newsletter subscribe subscription signup login share sharing social comment comments commentlist disqus discussion reply replies "
    "respond search pagination pager copyright legal disclaimer hidden contentinfo complementary".split())
#: So many links may be a list of links.
LINKS = 3
WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
PLACES = set(
    "site global main primary secondary top bottom left right inner outer container wrapper wrap area box list section block bar "
    "item items link links button buttons icon icons form panel unit slot google gpt div widgets posts articles stories news products".split())
#: These may be the site's or the article's own: a title stands in a page's or article's header.
HEADERS = {"header", "masthead"}
OWNERS = set("page post entry article blog user users reader readers customer".split())
COMMENTS = set("comment comments commentlist disqus discussion reply replies respond".split())
SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "parent", "children", "beside", "named", "own", "articles", "bodies", "chars", "tags", "link_chars", "link_tags", "density", "sum", "peak")

    def __init__(self, tag: str, parent: Node | None, beside: bool = False, named: str = "") -> None:
        self.tag, self.parent, self.beside, self.named = tag, parent, beside, named
        self.children: list[Node | str] = []
        self.own = self.articles = self.bodies = self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.sum = self.peak = 0.0


def kind_of(token: str) -> str:
    """The kind of part that a token of class, id or role names: ``header``, ``comments``, ``other`` or none."""
    words = [w.lower() for w in WORDS.findall(token)]
    named = {w for w in words if w in BESIDE}
    rest = {w for w in words if w not in BESIDE and w not in PLACES and not w.isdigit()}
    if not named or rest and (named & HEADERS or not rest <= OWNERS):
        return ""
    return "header" if named & HEADERS else "comments" if named & COMMENTS else "other"


def names_beside(attributes: str) -> str:
    """The kind of part beside the article that class, id and role name; ``other`` if the element is hidden."""
    found = ""
    for name, value in ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name in ("class", "id", "role") and value:
            kinds = {kind_of(token) for token in unescape(value.strip("\"'")).split()}
            found = max(found, *kinds, key=("", "header", "other", "comments").index) if kinds else found
        elif name == "hidden" or name == "aria-hidden" and "true" in value.lower():
            found = found or "other"
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
            found = found or "other"
    return found


def parse(html: str) -> Node:
    """The tree of a page, open elements closed where HTML closes them."""
    root = here = Node("#root", None)
    at, end = 0, len(html)
    while at < end:
        found = SPLIT.search(html, at)
        if found is None:
            here.children.append(html[at:])
            break
        if found.start() > at:
            here.children.append(html[at:found.start()])
        at = found.end()
        closing, opening, attributes, empty = found.group(1, 2, 3, 4)
        if closing:
            tag, node = closing.lower(), here
            while node.parent is not None and node.tag != tag:
                if tag in INLINE and node.tag not in INLINE:
                    node = root
                    break
                node = node.parent
            if node.parent is not None:
                here = node.parent
        elif opening:
            tag = opening.lower()
            node = here if tag not in INLINE else root
            while node.parent is not None:
                if tag in CLOSED_BY.get(node.tag, ()):
                    here = node.parent
                    if node.tag != "p" and tag not in ("tr", "tbody", "thead", "tfoot"):
                        break
                elif node.tag in SCOPE.get(tag, ()) or node.tag not in INLINE and node.tag not in CLOSED_BY:
                    break
                node = node.parent
            named = names_beside(attributes) if attributes.strip() else ""
            if tag == "header" and not named:
                named = "header"
            if named == "header":  # Of the site, unless it is an article's.
                at_header = here
                while at_header is not None and at_header.tag not in ("article", "main"):
                    at_header = at_header.parent
                named = named if at_header is None else ""
            if tag in FORMS:
                named = named or "other"
            node = Node(tag, here, tag in NEVER, "" if tag in ("html", "body", "main") else named)
            here.children.append(node)
            if tag in RAW:
                close = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.IGNORECASE).search(html, at)
                at = close.end() if close else end
            elif tag not in VOID and not empty:
                here = node
    return root


def walk(root: Node) -> list[Node]:
    """Nodes, parents before children; parts beside the article are left out."""
    order = _visible(root)
    if any(n.named for n in order):
        set_aside(order)
        order = _visible(root)
    return order


def set_aside(order: list[Node]) -> None:
    """Which of the elements that are beside the article by their names or as forms are so indeed.

    None that holds the body, a ``main`` or all articles, and none that holds most of the page's
    characters with no article beside it; there density decides. Comments may be in ``article``
    elements of their own, and many: they stay only if they hold most characters and no article
    is outside them.
    """
    for node in reversed(order):
        node.articles = int(node.tag in ("article", "main") and node.named != "comments")
        node.bodies = int(node.tag in ("body", "main"))
        node.own = sum(len("".join(c.split())) for c in node.children if isinstance(c, str))
        for child in node.children:
            if isinstance(child, Node) and not child.beside:
                node.own += child.own
                node.articles += child.articles
                node.bodies += child.bodies
    around = {order[0]: 0}
    for node in order:
        if node.parent is not None:
            around[node] = around[node.parent] + (node.parent.tag in ("article", "main"))
        if node.named:
            outside = order[0].articles - node.articles
            most = 2 * node.own > order[0].own
            if node.named == "comments":
                stays = node.bodies or most and not outside
            else:
                stays = node.bodies or node.tag == "article" or node.articles and not outside or most and outside <= around[node]
            node.beside = not stays


def _visible(root: Node) -> list[Node]:
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [c for c in reversed(node.children) if isinstance(c, Node) and not c.beside]
    return order


def measure(order: list[Node]) -> None:
    """Composite text density of each node, and the sum of its children's.

    With c characters and t tags below a node, of which lc and lt are in links, and lb, cb those
    of the body, it is ``c / t * log(c / lc * t / lt)`` to the base ``ln(c / (c - lc) * lc + lb / cb * c
    + e)``. Zeros below a fraction line count as one, and so does the base's logarithm on a page
    without links, where the base is one everywhere.
    """
    for node in reversed(order):
        for child in node.children:
            if isinstance(child, str):
                node.chars += sum(map(len, (unescape(child) if "&" in child else child).split()))
            elif not child.beside:
                node.tags += child.tags + 1
                node.chars += child.chars
                node.link_chars += child.link_chars
                node.link_tags += child.link_tags
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.link_tags + 1
    body = body_of(order)
    share = body.link_chars / max(1, body.chars)
    for node in reversed(order):
        tags, links = max(1, node.tags), max(1, node.link_chars)
        if node.chars:
            base = math.log(node.chars / max(1, node.chars - node.link_chars) * node.link_chars + share * node.chars + math.e)
            ratio = node.chars / links * tags / max(1, node.link_tags)
            node.density = node.chars / tags * math.log(max(1.0, ratio)) / (math.log(base) if share else 1.0)
        below = [c for c in node.children if isinstance(c, Node) and not c.beside]
        node.sum = sum(c.density for c in below)
        node.peak = max([node.density, *(c.peak for c in below)])


def body_of(order: list[Node]) -> Node:
    return next((n for n in order if n.tag == "body"), order[0])


def article(order: list[Node]) -> tuple[Node, float]:
    """The subtree with the largest sum of densities, and the least density on its path to the body."""
    body = body_of(order)
    inside = order[order.index(body):] if body is not order[0] else order
    best = max(inside, key=lambda n: n.sum)
    threshold, node = best.density, best
    while node is not None and node is not body.parent:
        threshold, node = min(threshold, node.density), node.parent
    return best, threshold


def lists_links(nodes: list[Node | str]) -> bool:
    """Whether neighbours are a list of links: three or more, with most of the characters."""
    inside = [n for n in nodes if isinstance(n, Node) and not n.beside]
    links, chars = sum(n.link_chars for n in inside), sum(n.chars for n in inside)
    chars += sum(len("".join(n.split())) for n in nodes if isinstance(n, str))
    return sum(n.link_tags for n in inside) >= LINKS and 2 * links > chars


def drop_link_lists(found: Node, threshold: float) -> None:
    """Take lists of links from around ``found``, up to the root.

    What is beside its path stays, headings and thinner sections too, unless it is a list of links
    below the threshold, or a part there that is beside the article by its name. One that holds something denser is gone through in the same way.
    """
    path, at = {found}, found.parent
    while at is not None:
        path.add(at)
        at = at.parent
    stack = [n for n in path if n is not found]
    while stack:
        node = stack.pop()
        kept: list[Node | str] = []
        run: list[Node | str] = []  # Neighbours in one line of text are one part.
        for child in [*node.children, None]:
            if isinstance(child, str) or child is not None and child.tag in INLINE and child not in path:
                run.append(child)
                continue
            if not lists_links(run):
                kept += run
            run = []
            if child is None:
                break
            if child not in path and not child.beside and child.density < threshold:
                if child.peak >= threshold:
                    stack.append(child)
                elif child.named or lists_links([child]):
                    continue
            kept.append(child)
        node.children = kept


def whole(node: Node, threshold: float) -> Node:
    """The element whose text is the article's: an ``article`` or ``main`` around the subtree, or else
    the whole page without lists of links around what holds the subtree."""
    found, at = node, node
    while at is not None:
        if at.tag in ("article", "main"):
            return at
        root, at = at, at.parent
    while (found.tag in INLINE or found.tag in PARTS) and found.parent is not None:
        found = found.parent
    drop_link_lists(found, threshold)
    return root


def blocks(node: Node) -> Iterator[str]:
    """Text of a subtree, block by block."""
    words: list[str] = []

    def flush() -> Iterator[str]:
        text = SPACE.sub(" ", "".join(words)).strip()
        words.clear()
        if text:
            yield text

    stack: list[Node | str | tuple] = [node]
    while stack:
        item = stack.pop()
        if isinstance(item, tuple):
            yield from flush()
        elif isinstance(item, str):
            words.append(unescape(item))
        elif item.beside and item is not node:
            if item.tag not in INLINE:
                yield from flush()
        elif item.tag == "br":
            words.append(" ")
        else:
            if item.tag not in INLINE:
                yield from flush()
                stack.append((None,))
            stack += reversed(item.children)
    yield from flush()


def main_text(html: str) -> str:
    """The main text of a page; see ``extract``."""
    root = parse(html)
    order = walk(root)
    measure(order)
    return "\n".join(blocks(whole(*article(order))))


def extract(pages: DataFrame, id_column: str = "page_id", html_column: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """``page_id``, the columns ``keep``, ``text`` and ``n_chars`` (code points) for each page.

    The text is that of the ``article`` or ``main`` around the densest subtree, or of the page if there
    is none, without menus, headers and footers of the site, side bars, notices, adverts, forms,
    scripts, styles and comments of readers. Character references
    are decoded, white space within a block becomes one space, blocks are joined by newlines in
    page order. Nothing else is dropped. A null page counts as empty, and bytes that are no
    UTF-8 as U+FFFD; a page without text gives
    an empty text; rows that repeat are read each for itself; other columns play no part.

    No shuffle: one pass, a batch of pages at a time, one page's tree in memory.
    """
    small_batches(pages.sparkSession)
    kinds = dict(pages.dtypes)
    rest = [(f"_{i}", c) for i, c in enumerate((id_column, *keep))]
    rows = pages.select(*[F.col(f"`{c}`").alias(a) for a, c in rest], valid_text(F.col(f"`{html_column}`")).alias("html"))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [main_text(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(texts, pa.string())], names=[*batch.schema.names[:-1], "text"])

    schema = ", ".join([*(f"{a} {kinds[c]}" for a, c in rest), "text string"])
    found = rows.mapInArrow(run, schema)
    return found.select(
        F.col("_0").alias("page_id"), *[F.col(a).alias(c) for a, c in rest[1:]], "text", F.length("text").cast("long").alias("n_chars"))
