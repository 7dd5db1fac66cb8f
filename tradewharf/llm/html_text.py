"""Main text of web pages with removal of site templates.

A page is tokenised once into a light tree. Every page's block subtrees are hashed and counted per
host in Spark; those that recur on many different pages of the host are its template, and the pages
that hold them lose them. Inside an article only containers count as blocks, so a paragraph that
many articles share stays. Beside the counts, elements that say what they are (nav, footer, a
container of class "sidebar") are left out, and an article element is taken as the main text.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter, deque
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tradewharf.llm.base import Scratch

#: A subtree is template if it stands on at least this many different pages of its host, and on
#: twice the square root of all its pages: 28 of 200, 200 of 10,000.
MIN_PAGES = 10

_DROPPED = frozenset(
    "nav header footer aside form script style noscript template iframe object embed svg canvas button select textarea "
    "input label fieldset dialog menu head title meta link audio video map".split()
)
#: Their content is not markup; it ends at their end tag only.
_RAW = frozenset("script style textarea title noscript template iframe".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
_CONTAINERS = frozenset("div section ul ol dl table figure details center main".split())
#: Blocks that can be template where no article says what the page's own text is.
_BLOCKS = _CONTAINERS | frozenset("p pre blockquote h1 h2 h3 h4 h5 h6 address".split())
_ARTICLES = frozenset(["article", "main"])
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words of class names and ids that name furniture, those of reader comments apart.
_FURNITURE = frozenset(
    "ad ads advert adverts advertisement advertisements adsense banner promo promos promotion sponsor sponsored sidebar sidebars "
    "menu menus nav navbar navigation breadcrumb breadcrumbs header headers masthead footer footers notice notices cookie cookies "
    "consent gdpr popup modal overlay newsletter subscribe subscription share sharing social related recommended widget widgets "
    "toolbar search login signup skip pagination pager".split()
)
_COMMENTS = frozenset("comment comments commentlist disqus respond reply replies".split())
#: A name that begins like this tells about something else: has-sidebar, no-header.
_ABOUT = frozenset("has no not with without is wp".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog toolbar".split())
#: Elements that an open one of the same kind ends before they begin.
_CLOSES = {
    "p": frozenset(["p"]), "li": frozenset(["li", "p"]), "dt": frozenset(["dt", "dd", "p"]), "dd": frozenset(["dt", "dd", "p"]),
    "tr": frozenset(["tr", "td", "th", "p"]), "td": frozenset(["td", "th", "p"]), "th": frozenset(["td", "th", "p"]), "option": frozenset(["option"]),
}
#: Block elements end an open paragraph.
_ENDS_P = frozenset(
    "address article aside blockquote center div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section table ul".split()
)
#: A quotation mark counts after an equals sign only; one that is not closed belongs to the value.
_VALUE = r"(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+)"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    rf"|<([a-zA-Z][^\s/>]*)((?:[\s/]++|=|[^\s/>=]++(?:\s*+=\s*+{_VALUE})?+)*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s/>=]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]*+)))?+")
_NOT_SHOWN = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_SPACES = re.compile(r"\s+")


class Node:
    """``furniture`` is left out; ``marked`` would be, by its class or id, unless it holds the
    page's main text."""

    __slots__ = ("tag", "furniture", "marked", "children", "digest", "size")

    def __init__(self, tag: str, furniture: bool = False, marked: bool = False) -> None:
        self.tag, self.furniture, self.marked, self.children, self.digest, self.size = tag, furniture, marked, [], None, 0


def _named(value: str) -> tuple[bool, bool]:
    """(furniture, comments): whether a class or id list has a name of furniture or of comments.
    Names are taken whole and read word by word."""
    furniture = comments = False
    for name in value.split():
        words = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "-", name).lower().replace("_", "-").split("-")
        if words[0] not in _ABOUT and not {"with", "without"} & set(words):
            furniture |= not _FURNITURE.isdisjoint(words)
            comments |= not _COMMENTS.isdisjoint(words)
    return furniture, comments


def _judge(tag: str, attributes: str) -> tuple[bool, bool]:
    """(furniture, marked) of an element by its own tag."""
    dropped = tag in _DROPPED
    if dropped or not attributes.strip():
        return dropped, False
    marked = False
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and _NOT_SHOWN.search(value)):
            return True, False
        if name == "role" and value.lower() in _ROLES and tag not in _ARTICLES:
            return True, False
        if name in ("class", "id") and (tag in _CONTAINERS or tag == "article"):
            furniture, comments = _named(html.unescape(value))
            if comments and tag != "main":
                return True, False
            marked |= furniture and tag not in _ARTICLES
    return False, marked


def tree(source: str) -> Node:
    """A light tree: end tags close to their start tag, unclosed elements end with their parent,
    comments and declarations are left out, the end of a cut page closes everything."""
    root = Node("#")
    stack, at, end = [root], 0, len(source)
    opened: Counter[str] = Counter()
    open_questions = False

    def close(depth: int) -> None:
        opened.subtract(n.tag for n in stack[depth:])
        del stack[depth:]

    while at < end:
        m = _TOKEN.search(source, at)
        if m is None:
            stack[-1].children.append(source[at:])
            break
        if m.start() > at:
            stack[-1].children.append(source[at : m.start()])
        at = m.end()
        closing, opening = m[1], m[2]
        if closing:
            name = closing.lower()
            if opened[name] > 0:
                depth = len(stack) - 1
                while stack[depth].tag != name:
                    depth -= 1
                close(depth)
            elif name in ("p", "br"):
                stack[-1].children.append(Node("br"))
        elif opening:
            name = opening.lower()
            closes = _CLOSES.get(name, ())
            if name in _ENDS_P or closes:
                # Inline elements that were not closed end with their paragraph.
                depth = len(stack) - 1
                while depth and stack[depth].tag in _INLINE:
                    depth -= 1
                if depth and (stack[depth].tag in closes or (stack[depth].tag == "p" and name in _ENDS_P)):
                    close(depth)
                    while stack[-1].tag in closes and stack[-1].tag != "p" and name != "li":
                        close(len(stack) - 1)
            attributes = m[3] or ""
            open_questions = open_questions or name == "header"
            node = Node(name, *_judge(name, attributes))
            open_questions = open_questions or node.marked
            stack[-1].children.append(node)
            if name in _VOID or re.search(r"(?:^|[\s\"'])/\s*$", attributes):
                continue
            if name in _RAW:
                stop = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(source, at)
                at = stop.end() if stop else end
                continue
            stack.append(node)
            opened[name] += 1
    if open_questions:
        _settle(root)
    return root


def _settle(root: Node) -> None:
    """Decide what depends on what lies inside: a header of an article that holds a heading is part
    of it, and a container marked by its class stays if it holds the largest article, or most of
    the paragraphs of a page without one. Two passes over the tree, however deep it is."""
    order, stack = [], [(root, False)]
    while stack:
        node, inside = stack.pop()
        order.append((node, inside))
        inside = inside or node.tag in _ARTICLES
        stack.extend((c, inside) for c in node.children if isinstance(c, Node))
    headed: set[int] = set()
    paragraphs: dict[int, int] = {}
    for node, inside in reversed(order):  # what is inside comes before what holds it
        own = [c for c in node.children if not (isinstance(c, Node) and c.furniture)]
        node.size = sum(len(c.strip()) if isinstance(c, str) else c.size for c in own)
        below = [id(c) for c in own if isinstance(c, Node)]
        paragraphs[id(node)] = node.size if node.tag == "p" else sum(paragraphs[c] for c in below)
        if node.tag in _HEADINGS or not headed.isdisjoint(below):
            headed.add(id(node))
            if node.tag == "header" and inside:
                node.furniture = False
    hidden: set[int] = set()
    largest = None
    for node, _ in order:
        if node.furniture or id(node) in hidden:
            hidden.update(id(c) for c in node.children if isinstance(c, Node))
        elif node.tag in _ARTICLES and (largest is None or node.size > largest.size):
            largest = node
    holders = {id(largest)}
    for node, _ in reversed(order):
        if any(id(c) in holders for c in node.children if isinstance(c, Node)):
            holders.add(id(node))
    for node, _ in order:
        if node.marked:
            stays = id(node) in holders if largest is not None else 2 * paragraphs[id(node)] > paragraphs[id(root)]
            node.furniture = not stays


def _article(root: Node) -> list[Node]:
    """The outermost article or main elements outside furniture, else the whole page."""
    found, queue = [], deque([root])
    while queue:
        for child in queue.popleft().children:
            if isinstance(child, Node) and not child.furniture:
                (found if child.tag in _ARTICLES else queue).append(child)
    return found or [root]


def _blocks(nodes: list[Node], template: frozenset[bytes]) -> Iterator[str]:
    """Text of the blocks in page order, character references decoded."""
    line: list[str] = []

    def flush() -> Iterator[str]:
        text = _SPACES.sub(" ", "".join(line)).strip()
        line.clear()
        if text:
            yield text

    stack: list = [("leave", n) if n is None else ("visit", n) for n in reversed(nodes)]
    while stack:
        what, node = stack.pop()
        if what == "leave":
            yield from flush()
            continue
        if isinstance(node, str):
            line.append(html.unescape(node))
            continue
        if node.furniture or (template and node.tag in _BLOCKS and _hash(node) in template):
            yield from flush()
            continue
        if node.tag not in _INLINE:
            yield from flush()
            stack.append(("leave", None))
        stack.extend(("visit", c) for c in reversed(node.children))
    yield from flush()


def _hash(node: Node) -> bytes:
    """Hash of shape and text of a subtree, white space folded. It is made from the hashes of
    the children and kept, so a page costs as much as it is long, however deep it is."""
    stack = [node]
    while stack:
        x = stack[-1]
        if x.digest is None:
            open_ones = [c for c in x.children if isinstance(c, Node) and c.digest is None]
            if open_ones:
                stack.extend(open_ones)
                continue
            made = hashlib.blake2b(f"<{x.tag}>".encode("utf-8", "surrogatepass"), digest_size=8)
            for c in x.children:
                made.update(_SPACES.sub(" ", c).encode("utf-8", "surrogatepass") if isinstance(c, str) else b"<>" + c.digest)
            x.digest = made.digest()
        stack.pop()
    return node.digest


def block_hashes(root: Node) -> set[bytes]:
    """Hashes of the subtrees that could be template: those not left out already, in the text that
    would be taken. Inside an article these are containers, elsewhere all blocks."""
    tops = _article(root)
    kinds = _CONTAINERS if tops[0].tag in _ARTICLES else _BLOCKS
    out, stack = set(), list(tops)
    while stack:
        for child in stack.pop().children:
            if isinstance(child, Node) and not child.furniture:
                if child.tag in kinds:
                    out.add(_hash(child))
                stack.append(child)
    return out


def extract(source: str | None, template: frozenset[bytes] = frozenset()) -> str:
    if not source:
        return ""
    return "\n".join(_blocks(_article(tree(source)), template))


def host_of(url: Column) -> Column:
    """Lower-case host of a URL; pages without one share the empty host."""
    return F.lower(F.coalesce(F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def _hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, pages, hashes = [], [], []
        for host, page, source in zip(*(batch.column(c).to_pylist() for c in ("_tw_host", "_tw_page", "html"))):
            if not source:
                continue
            # The empty hash stands for the page itself and counts the host's pages.
            for h in (b"", *block_hashes(tree(source))):
                hosts.append(host)
                pages.append(page)
                hashes.append(h)
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(pages, pa.binary()), pa.array(hashes, pa.binary())], names=["host", "page", "hash"])


def _keyed(pages: DataFrame) -> DataFrame:
    return pages.withColumns({"_tw_host": host_of(F.col("url")), "_tw_page": F.unhex(F.md5(F.col("html").cast("binary")))})


def page_blocks(pages: DataFrame) -> DataFrame:
    """host, page, hash: each different block of each different page. Copies of a page count once."""
    return _keyed(pages).select("_tw_host", "_tw_page", "html").mapInArrow(_hash_batches, "host string, page binary, hash binary").distinct()


def templates(blocks: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """host, hash, n: the blocks on many different pages of each host. The share of pages that is
    many falls with the host's size, so a template of one part of a large host is found too."""
    counts = blocks.groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n"))
    own = counts.where("hash = X''").select(F.col("host").alias("_tw_h"), F.col("n").alias("pages"))
    often = counts.where(f"hash <> X'' and n >= {min_pages}")
    return often.join(own, often.host == own._tw_h).where("n >= 2 * sqrt(pages)").select("host", "hash", "n")


@F.pandas_udf(StringType())
def _extract(sources: pd.Series, hashes: pd.Series) -> pd.Series:
    return pd.Series([
        extract(s, frozenset(bytes(h) for h in t) if t is not None else frozenset()) for s, t in zip(sources, hashes)
    ], dtype=object)


def with_text(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """``pages`` plus ``text``, the main text, empty if there is none.

    A null html has no text, a null url belongs to the empty host. Repeated rows give the same
    text each. Blocks are written once. A page meets the templates it holds, not all of its host:
    the list beside a page is as long as its blocks at most, and most pages have none.
    """
    scratch = Scratch(pages.sparkSession, "html")
    blocks = scratch.cut(page_blocks(pages), "blocks")
    found = templates(blocks, min_pages).select(F.col("host").alias("_tw_h"), F.col("hash").alias("_tw_b"))
    held = blocks.join(found, (F.col("host") == F.col("_tw_h")) & (F.col("hash") == F.col("_tw_b")), "left_semi")
    held = scratch.cut(held.groupBy("host", "page").agg(F.collect_list("hash").alias("_tw_t")), "templates")
    held = held.withColumnsRenamed({"host": "_tw_h", "page": "_tw_p"})
    keyed = _keyed(pages)
    joined = keyed.join(held, (F.col("_tw_host") == F.col("_tw_h")) & (F.col("_tw_page") == F.col("_tw_p")), "left")
    return joined.withColumn("text", _extract("html", "_tw_t")).drop("_tw_host", "_tw_page", "_tw_h", "_tw_p", "_tw_t")


def report(pages: DataFrame) -> DataFrame:
    """One row per page with its main text."""
    out = with_text(pages.select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
