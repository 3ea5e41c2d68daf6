"""Main text of web pages, with site templates removed.

Pages are parsed into element trees. Every block subtree (its tags and its text) is hashed; the
distinct hashes of a page are counted per host in Spark, and a subtree that recurs on many pages of
its host is a template: it is deleted before the text is read. Many are ``min_pages``, or the square
root of the host's pages where that is more, so variants that rotate on a large host are templates
too. A piece of a list or table or a heading (``PIECES``), which pages can share by chance, needs
``min_share`` of the pages, or the host's pages to the power of 3/4 where that is less. Equal pages
of a host count once, so a page that is stored many times is no template of itself. Where a page marks its article (article, main), only containers inside it can be
templates, as a paragraph that many articles quote is still text; elsewhere any block can be.
Besides, menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader
comments are left out by element and by class, id or role words.

Counts are pre-aggregated per (host, hash), so a host with a third of all pages is spread; a page
gets back only its own hashes. Page texts are shuffled once, page hashes once more.

Defined cases: null or empty html has empty text; a null or odd url is a host of its own name
(empty). Repeated rows are pages of their own. Broken, unclosed or cut-off markup is closed at the
end. Extra columns pass through; one named like an output is replaced. An empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import cut, folded, kept_names, unfolded

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
DROPPED = frozenset("head nav footer aside form script style noscript template iframe object svg canvas button select textarea dialog menu "
                    "audio video map title".split())
#: Elements that only hold other blocks; inside an article, only these can be templates.
CONTAINERS = frozenset("div section aside ul ol dl table nav header footer form figure details".split())
BLOCKS = CONTAINERS | frozenset("address article blockquote body br caption center dd dt fieldset figcaption h1 h2 h3 h4 h5 h6 hr html legend li main "
                                "option p pre summary tbody td tfoot th thead tr".split())
#: Blocks that pages of a host can share by chance (a cell that says yes, a usual heading).
PIECES = frozenset("caption dd dt figcaption h1 h2 h3 h4 h5 h6 legend li option summary tbody td tfoot th thead tr".split())
#: Words of a class, id or role that mark what is not main text.
MARKS = frozenset("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer "
                  "menu menubar modal nav navbar navigation newsletter notice notices popup promo promotion related replies respond "
                  "share sharing sidebar sidebars skip social sponsor sponsored subscribe toolbar widget widgets complementary contentinfo "
                  "search advertorial adsbygoogle gdpr alert signup login toc pagination pager".split())
#: Words of a header, which is left out except inside an article (where it holds the title).
HEADERS = frozenset(("header", "masthead"))
#: Elements whose own classes do not count (a body with a sidebar is not a sidebar), and class prefixes that do not.
UNMARKED = frozenset("html body main h1 h2 h3 h4 h5 h6 b i em strong".split())
NEGATIONS = frozenset("has no not with without".split())
#: A start tag of the key closes an open element of the value.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Such an element is closed only within these.
SCOPES = frozenset("ul ol dl table body html article main section div aside select".split())
CLOSES_P = frozenset("address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main "
                     "menu nav ol p pre section table ul".split())
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(>|\Z)""", re.S)
#: One attribute: its whole name and its value, so that nothing inside a value or another name counts.
ATTRIBUTE = re.compile(r"""([^\s/>=]+)(?:\s*=\s*(?:"([^"]*)(?:"|\Z)|'([^']*)(?:'|\Z)|([^\s>]+)))?""")
SPLIT = re.compile(r"[^a-z0-9]+").split
HOST = re.compile(r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", re.I)


class Node:
    __slots__ = ("tag", "marked", "header", "parts", "digest")

    def __init__(self, tag: str, marked: bool = False, header: bool = False):
        self.tag, self.marked, self.header, self.parts, self.digest = tag, marked, header or tag == "header", [], 0


def _marks(tag: str, attributes: str) -> tuple[bool, bool]:
    """Whether the element's own attributes say that it is not main text, and that it is a header."""
    if not attributes or tag in UNMARKED:
        return False, False
    header = False
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (values[0] or values[1] or values[2]).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True, False
        if name in ("class", "id", "role"):
            for word in map(SPLIT, value.split()):
                if word[0] not in NEGATIONS and not MARKS.isdisjoint(word):
                    return True, False
                header |= not HEADERS.isdisjoint(word) and word[0] not in NEGATIONS
    return False, header


def parse(page: str) -> Node:
    """The element tree; text parts are decoded strings."""
    root = Node("")
    stack, at, n = [root], 0, len(page)

    def close_to(names: set | frozenset, scope: frozenset) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in names:
                del stack[depth:]
                return
            if stack[depth].tag in scope:
                return

    while at < n:
        mark = page.find("<", at)
        if mark < 0:
            mark = n
        token = TOKEN.match(page, mark) if mark < n else None
        if mark > at:
            stack[-1].parts.append(html.unescape(page[at:mark]))
        if mark == n:
            break
        if token is None:
            stack[-1].parts.append("<")
            at = mark + 1
            continue
        at = token.end()
        tag = (token[2] or token[5] or "").lower()
        if not tag or token[7] == "":  # a comment or declaration, or a tag that the page's end cuts off
            continue
        if token[1] or token[4]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
                if tag not in BLOCKS and stack[depth].tag in BLOCKS:
                    break  # a stray inline end tag closes no block
            continue
        if tag in CLOSES_P:
            close_to({"p"}, SCOPES)
        if tag in CLOSES:
            close_to(CLOSES[tag], SCOPES)
        attributes = token[3] or token[6] or ""
        node = Node(tag, *_marks(tag, attributes))
        stack[-1].parts.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(page, at)
            stop = end.start() if end else n
            if tag in ("title", "textarea"):
                node.parts.append(html.unescape(page[at:stop]))
            at = page.find(">", stop) + 1 or n if end else n
        elif tag not in VOID and not attributes.endswith("/"):
            stack.append(node)
    return root


def _walk(root: Node) -> Iterator[Node]:
    """All nodes, children before their parents (no recursion: trees can be deep)."""
    todo, order = [root], []
    while todo:
        node = todo.pop()
        order.append(node)
        todo.extend(p for p in node.parts if isinstance(p, Node))
    return reversed(order)


def hash_subtrees(root: Node) -> None:
    for node in _walk(root):
        h = hashlib.blake2b(node.tag.encode(), digest_size=8)
        for part in node.parts:
            if isinstance(part, Node):
                h.update(b"\x01" + part.digest.to_bytes(8, "little", signed=True))
            else:
                h.update(b"\x02" + " ".join(part.split()).encode("utf-8", "replace"))
        node.digest = int.from_bytes(h.digest(), "little", signed=True) & ~1 | (node.tag in PIECES)  # odd: a piece


def _left_out(node: Node, inside: bool) -> bool:
    return node.tag in DROPPED or node.marked or (node.header and not inside)


def main_roots(root: Node) -> list[Node]:
    """The outermost articles (else main elements) outside what is left out; else the whole page."""
    for wanted in ("article", "main"):
        found, todo = [], [root]
        while todo:
            node = todo.pop()
            if node.tag == wanted and not node.marked:
                found.append(node)
            elif not _left_out(node, False):
                todo.extend(p for p in reversed(node.parts) if isinstance(p, Node))
        if found:
            return found
    return [root]


def candidates(root: Node) -> list[int]:
    """Hashes of the subtrees that may be templates."""
    hash_subtrees(root)
    found, roots = set(), main_roots(root)
    allowed = BLOCKS if roots == [root] else CONTAINERS
    for top in roots:
        for node in _walk(top):
            if node is not top and node.tag in allowed and node.tag not in ("html", "body", "br", "hr") and node.parts:
                found.add(node.digest)
    return sorted(found)


def main_text(root: Node, templates: set[int]) -> str:
    """The text of the main elements without templates and what is left out."""
    roots = main_roots(root)
    inside, out = roots != [root], []
    allowed = CONTAINERS if inside else BLOCKS
    if templates:
        hash_subtrees(root)
    todo: list = list(reversed(roots))
    tops = set(map(id, roots))
    while todo:
        part = todo.pop()
        if isinstance(part, str):
            out.append(part)
        elif id(part) in tops or not (_left_out(part, inside) or part.tag == "article" and part.marked
                                      or templates and part.tag in allowed and part.digest in templates):
            edge = [" "] if part.tag in BLOCKS else []
            todo.extend([*edge, *reversed(part.parts), *edge])
    return " ".join("".join(out).split())


def host_of(url: str | None) -> str:
    found = HOST.match(url or "")
    return found[1].lower() if found else ""


def extract(pages: DataFrame, min_pages: int = 5, min_share: float = 0.3) -> DataFrame:
    """``pages`` without html, plus text and n_chars."""
    own = kept_names(pages, ("html", "text", "n_chars"))
    page = (F.xxhash64(F.coalesce("url", F.lit(""))), F.xxhash64(F.coalesce("html", F.lit(""))))

    def hashes(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = [(host_of(u), candidates(parse(h or ""))) for u, h in zip(part["url"].to_pylist(), part["html"].to_pylist())]
            yield pa.RecordBatch.from_arrays([part["_url"], part["_html"], pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.list_(pa.int64()))],
                                             names=["_url", "_html", "host", "hashes"])

    found = cut(pages.select("url", "html", page[0].alias("_url"), page[1].alias("_html"))
                .mapInArrow(hashes, "_url long, _html long, host string, hashes array<long>"))
    sizes = found.groupBy("host", "_html").agg(F.lit(1).alias("one")).groupBy("host").agg(F.count("one").alias("pages"))
    counted = (found.groupBy("host", "_html").agg(F.first("hashes").alias("hashes")).select("host", F.explode("hashes").alias("hash"))
               .groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n")))
    many = F.when(F.col("hash").bitwiseAND(1) == 0, F.sqrt("pages")).otherwise(F.least(min_share * F.col("pages"), F.pow("pages", F.lit(0.75))))
    template = cut(counted.where(F.col("n") >= min_pages).join(sizes, "host").where(F.col("n") >= many).select("host", "hash"))
    gone = cut(found.select("_url", "_html", "host", F.explode("hashes").alias("hash")).join(template, ["host", "hash"])
               .groupBy("_url", "_html").agg(F.collect_set("hash").alias("_gone")))
    rows = (pages.select(folded(pages, own).alias("own"), "html", page[0].alias("_url"), page[1].alias("_html"))
            .join(gone, ["_url", "_html"], "left").select("own", "html", "_gone"))

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = [main_text(parse(h or ""), set(g or ())) for h, g in zip(part["html"].to_pylist(), part["_gone"].to_pylist())]
            yield pa.RecordBatch.from_arrays([part["own"], pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                                             names=["own", "text", "n_chars"])

    out = rows.mapInArrow(read, f"own {dict(rows.dtypes)['own']}, text string, n_chars long")
    return out.select(*unfolded("own", own), "text", "n_chars")
