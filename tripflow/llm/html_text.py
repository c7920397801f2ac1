"""Main text of web pages: recurring element subtrees of a host are its template and are removed.

Every page is parsed into a tree. Each subtree has a hash of its tag, class, texts and children. Spark counts
with how many different rests of a page a subtree occurs on a host; those with many are the host's template. Copies of
a page have one rest and count once, so a repeated article is no template, on a host of any size. Each page then gets the list of its
own template subtrees, by a join on the page, and is extracted without them. What no two pages share, such as an advert with its own text, is
known by its element (``nav``, ``aside``, ``form``, ``script``, ...) or by its role, class or id: a whole class token, or one put
together of such names and words of place only (``site-footer``, but not ``has-sidebar`` or ``share-price``).

An ``article`` or ``main`` element, if there is one, holds the text, and is never part of the template itself, whatever its class; within it
paragraphs and headings stay even if other pages repeat them, while recurring lists, boxes and
tables go. Without such an element, the rest of the body is the text. Pages are read with a cursor that never goes
back, so that broken ones take time in proportion to their length too.

Blocks and line breaks are separated by a space, inline elements are not; character references are decoded. Defined results: a null or
empty page has the empty text; null URLs are a host of their own; rows that repeat a page id are extracted each from its own html, and equal rows
count once in the host's pages. Unclosed elements end with their parent; an unfinished tag at the end of a page is dropped. Other columns pass
through; ``text`` and ``n_chars`` are replaced.
"""

from __future__ import annotations

import bisect
import functools
import html as references
import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import common

TAG_NAME = re.compile(r"/?[a-zA-Z][^\s/<>]*")
#: Most tags: nothing in angle brackets within, all quotes closed. Looks no further than the next bracket.
PLAIN_TAG = re.compile(r"""<(/?[a-zA-Z][^\s/<>"']*+)((?:[^<>"']++|"[^"<>]*+"|'[^'<>]*+')*+)>""")
SPECIAL = re.compile(r"""[>"']""")
MARKS = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
NAME_PART = re.compile(r"[a-z]+|[^a-z0-9_\s-]")
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins",
    "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time",
    "tt", "u", "var", "wbr",
}
#: Elements that end an open element of the given names when they start.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "body": {"head"},
}
SCOPES = {"ul", "ol", "dl", "table", "article", "main", "body", "div", "section", "aside", "nav", "blockquote"}
MAIN = {"article", "main"}
NEVER_TEXT = RAW | {
    "head", "nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "svg", "canvas", "object", "audio", "video", "math",
}
NOT_TEXT_ROLES = {
    "navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar", "toolbar",
}
NOT_TEXT_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment",
    "comments", "consent", "cookie", "cookies", "disqus", "footer", "masthead", "menu", "modal", "nav", "navbar",
    "navigation", "newsletter", "notice", "pager", "pagination", "popup", "promo", "related", "share", "sharing", "sidebar",
    "signup", "social", "sponsor", "sponsored", "subscribe", "widget",
}
#: Words that say where something is, not what it is.
PLACES = {
    "area", "bar", "block", "bottom", "box", "center", "container", "global", "inner", "left", "links", "list", "main", "outer", "page",
    "right", "section", "site", "top", "wrap", "wrapper",
}
#: Elements that may be template inside the main element.
KEPT = {"p", "h1", "h2", "h3", "h4", "h5", "h6"}
BOXES = {"div", "section", "ul", "ol", "dl", "table", "figure", "header", "details", "center"}


ALL_BITS = (1 << 64) - 1
CELLS = 64


class Node:
    __slots__ = ("tag", "marks", "role", "parts", "parent", "holds_main", "in_main")

    def __init__(self, tag: str, marks: str, role: str, parent: Node | None) -> None:
        self.tag, self.marks, self.role, self.parent = tag, marks, role, parent
        self.parts: list[str | Node] = []
        self.holds_main = False
        self.in_main = parent is not None and (parent.in_main or parent.tag in MAIN or parent.role == "main")


class Reader:
    """Reads a page token by token with a cursor ``at``.

    A quoted ``>`` does not end a tag. A ``<`` that begins no whole tag is text, but an unfinished tag at the end of the page
    is nothing. Where a search for the end of a tag has failed is kept, and a later search that comes by fails at once.
    """

    def __init__(self, page: str) -> None:
        self.page, self.at = page, 0
        self.last = {c: page.rfind(c) for c in "<>\"'"}
        self.dead: set[int] = set()
        self.found = (0, -1)  # from where a special character was looked for, and where it is

    def _special(self, start: int) -> int:
        if not self.found[0] <= start <= self.found[1]:
            match = SPECIAL.search(self.page, start) if start <= max(self.last[c] for c in ">\"'") else None
            self.found = (start, match.start() if match else len(self.page))
        return self.found[1]

    def _tag_end(self, start: int) -> int:
        """Where the first ``>`` outside quotes is, or -1."""
        passed = []
        while start <= self.last[">"]:
            special = self._special(start)
            if special in self.dead or special == len(self.page):
                break
            passed.append(special)
            quote = self.page[special]
            if quote == ">":
                return special
            close = self.page.find(quote, special + 1) if special < self.last[quote] else -1
            if close < 0:
                break
            start = close + 1
        self.dead.update(passed)
        return -1

    def next(self) -> tuple[str, str, str] | None:
        """A start tag's name and attributes, an end tag's name after a slash, or ("", "", text); None at the end."""
        page = self.page
        while self.at < len(page):
            at = self.at
            if page[at] != "<":
                stop = page.find("<", at) if at <= self.last["<"] else -1
                self.at = len(page) if stop < 0 else stop
                return "", "", page[at : self.at]
            plain = PLAIN_TAG.match(page, at)
            if plain:
                self.at = plain.end()
                return plain[1].lower(), plain[2], ""
            if page.startswith("<!--", at):
                stop = page.find("-->", at)
                self.at = len(page) if stop < 0 else stop + 3
                continue
            name = TAG_NAME.match(page, at + 1)
            end = self._tag_end(name.end()) if name else -1
            if end >= 0:
                self.at = end + 1
                return name[0].lower(), page[name.end() : end], ""
            if page[at + 1 : at + 2] in ("!", "?", "/"):
                stop = page.find(">", at) if at <= self.last[">"] else -1
                self.at = len(page) if stop < 0 else stop + 1
                continue
            self.at = at + 1
            if name is None or at < max(self.last["<"], self.last[">"]):
                return "", "", "<"
            self.at = len(page)
        return None


def parse(page: str) -> Node:
    """The tree of a page; texts are raw, comments and the contents of scripts and the like left out."""
    root = Node("", "", "", None)
    stack, scopes = [root], [0]
    places: dict[str, list[int]] = {}  # where in the stack the open elements of a name are

    def cut(size: int) -> None:
        while len(stack) > size:
            gone = stack.pop()
            places[gone.tag].pop()
            if gone.tag in SCOPES:
                scopes.pop()

    reader = Reader(page)
    while token := reader.next():
        tag, attributes, text = token
        if not tag:
            stack[-1].parts.append(text)
            continue
        if tag[0] == "/":
            if places.get(tag[1:]):
                cut(places[tag[1:]][-1])
            continue
        closed = ENDS.get(tag)
        if closed or tag not in INLINE and tag not in VOID:
            # A block ends an open paragraph, an item the item before it, within the same list or box.
            wanted = (closed or set()) | (set() if tag in INLINE else {"p"})
            inside = [(found, bisect.bisect_right(found, scopes[-1])) for found in map(places.get, wanted) if found]
            outer = [found[k] for found, k in inside if k < len(found)]
            if outer:
                cut(min(outer))
        marks = role = ""
        if "=" in attributes:
            for key, value in MARKS.findall(attributes):
                value = value.strip("\"'").lower()
                if key.lower() == "role":
                    role = value
                else:
                    marks = f"{marks} {value}"
        child = Node(tag, marks, role, stack[-1])
        stack[-1].parts.append(child)
        if tag in MAIN or role == "main":
            for above in reversed(stack):
                if above.holds_main:
                    break
                above.holds_main = True
        if tag in RAW:
            end = re.compile(f"</{tag}[^>]*>?", re.I).search(page, reader.at)
            reader.at = end.end() if end else len(page)
        elif tag not in VOID and not attributes.endswith("/"):
            places.setdefault(tag, []).append(len(stack))
            stack.append(child)
            if tag in SCOPES:
                scopes.append(len(stack) - 1)
    return root


def removable(node: Node) -> bool:
    """Whether a subtree may be template at all."""
    if node.parent is None or node.holds_main or node.tag in MAIN or node.role == "main" or node.tag in ("html", "body"):
        return False
    return not node.in_main or node.tag in BOXES or not_text(node)


def not_text(node: Node) -> bool:
    """Whether element, role, class or id tell that the subtree is no part of the article."""
    if node.holds_main or node.tag in ("html", "body"):
        return False
    if node.tag in NEVER_TEXT or node.role in NOT_TEXT_ROLES or node.tag == "header" and not node.in_main:
        return True
    # The main element keeps its text whatever it is called, and so do paragraphs and headings in it.
    if not node.in_main and (node.tag in MAIN or node.role == "main") or node.in_main and node.tag in KEPT:
        return False
    return any(map(names_no_text, node.marks.split()))


@functools.lru_cache(4096)
def names_no_text(token: str) -> bool:
    """Whether a class or id says that an element is no text: all its words do, or tell a place only."""
    words = set(NAME_PART.findall(token))
    return not NOT_TEXT_NAMES.isdisjoint(words) and words <= NOT_TEXT_NAMES | PLACES


def subtree_hashes(root: Node) -> dict[int, int]:
    """Hashes, by the node's identity, of the subtrees that may be template and all below them."""
    order, todo = [], [(root, False)]
    while todo:
        node, inside = todo.pop()
        inside = inside or removable(node)
        if inside:
            order.append(node)
        todo += [(p, inside) for p in node.parts if type(p) is not str]
    hashes: dict[int, int] = {}
    for node in reversed(order):
        digest = xxhash.xxh3_64(f"{node.tag}|{node.marks}".encode("utf-8", "surrogatepass"))
        for part in node.parts:
            if type(part) is str:
                digest.update(" ".join(part.split()).encode("utf-8", "surrogatepass"))
            else:
                digest.update(hashes[id(part)].to_bytes(8, "little", signed=True))
        hashes[id(node)] = digest.intdigest() - (1 << 63)
    return hashes


def text_sums(root: Node) -> dict[int, int]:
    """By the node's identity, the sum of the hashes of the texts in a subtree, but for those of a page's head."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [p for p in node.parts if type(p) is not str and p.tag != "head"]
    sums: dict[int, int] = {}
    for node in reversed(order):
        total = 0
        for part in node.parts:
            if type(part) is not str:
                total += sums.get(id(part), 0)
            elif text := " ".join(part.split()):
                total += xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))
        sums[id(node)] = total & ALL_BITS
    return sums


def template_candidates(page: str) -> list[tuple[int, int]]:
    """Hashes of the page's subtrees that may be template, each once, with one of the texts of the rest of the page."""
    root = parse(page)
    hashes, sums = subtree_hashes(root), text_sums(root)
    whole = sums[id(root)]
    found, todo = {}, [root]
    while todo:
        node = todo.pop()
        if removable(node):
            rest = (whole - sums.get(id(node), 0)) & ALL_BITS
            found.setdefault(hashes[id(node)], rest - (1 << 63))
        todo += [p for p in node.parts if type(p) is not str]
    return sorted(found.items())


def main_text(page: str, template: set[int]) -> str:
    """Text of the page without the subtrees in ``template`` and those that are no text."""
    root = parse(page)
    hashes = subtree_hashes(root) if template else {}
    out: list[str] = []
    todo: list = [(root, not root.holds_main)]  # with whether texts here count
    while todo:
        item, counts = todo.pop()
        if type(item) is str:
            if counts:
                out.append(item)
            continue
        counts = counts or item.tag in MAIN or item.role == "main"
        if item.parent is not None and (
            not_text(item) or template and hashes.get(id(item)) in template and removable(item)
        ):
            todo.append((" ", counts))
            continue
        gap = item.tag not in INLINE
        if gap:
            todo.append((" ", counts))
        todo += [(part, counts) for part in reversed(item.parts)]
        if gap:
            todo.append((" ", counts))
    return " ".join(references.unescape("".join(out)).split())


def host() -> Column:
    found = F.regexp_extract(F.lower("url"), r"^[a-z][a-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1)
    return F.coalesce(found, F.lit(""))


def templates(pages: DataFrame, least_rests: int = 5) -> DataFrame:
    """``page_key`` and ``template``: the page's subtrees that recur on its host with ``least_rests`` different rests of a page.

    The count does not depend on how many pages the host has. The head is no part of a rest. Rests are told apart by 64
    cells, so that two in one cell count once: of five, in one case of seven; copies of a page are never counted twice.
    """

    def candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [template_candidates(h) for h in batch["html"]]
            yield pd.DataFrame(
                {
                    "page_key": batch["page_key"],
                    "host": batch["host"],
                    "subtree": [[s for s, _ in f] for f in found],
                    "rest": [[r for _, r in f] for f in found],
                }
            )

    keyed = pages.select(page_key(), host().alias("host"), "html").where("html IS NOT NULL")
    found = common.stored(
        keyed.mapInPandas(candidates, "page_key long, host string, subtree array<long>, rest array<long>")
        .withColumn("host", F.xxhash64("host")),
        "html-subtrees",
    )
    # Rests fall on 64 cells by their hash, and a subtree's cells are the bits of one number, which combines before the
    # shuffle: never more cells than rests, nearly as many while they are few.
    cell = F.expr(f"shiftleft(1L, CAST(pmod(rest, {CELLS}) AS INT))")
    many = (
        found.select("host", F.inline(F.arrays_zip("subtree", "rest")))
        .groupBy("host", "subtree")
        .agg(F.bit_or(cell).alias("cells"))
        .where(F.bit_count("cells") >= least_rests)
        .select("host", "subtree")
    )
    each = found.select("page_key", "host", F.explode("subtree").alias("subtree"))
    return (
        each.join(common.stored(many, "html-templates"), ["host", "subtree"])
        .groupBy("page_key")
        .agg(F.collect_set("subtree").alias("template"))
    )


def page_key() -> Column:
    return F.xxhash64("page_id", "url", "html").alias("page_key")


def extract(pages: DataFrame, least_rests: int = 5) -> DataFrame:
    """``pages`` with ``text`` and ``n_chars``."""
    kept = [c for c in pages.columns if c not in ("text", "n_chars")]
    own = common.stored(templates(pages, least_rests), "html-page-templates")

    @F.pandas_udf("string")
    def text(html: pd.Series, template: pd.Series) -> pd.Series:
        return pd.Series(
            [main_text(h or "", set() if t is None else set(t)) for h, t in zip(html, template, strict=True)], dtype=object
        )

    keyed = pages.withColumn("_key", page_key())
    joined = keyed.join(own, keyed["_key"] == own["page_key"], "left").withColumn("text", text("html", "template"))
    return joined.select(*kept, "text", F.char_length("text").cast("long").alias("n_chars"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = common.table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", "n_chars")
