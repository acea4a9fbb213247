"""Main text of web pages by removal of site templates.

Pages are cut into tags and texts, and subtrees of block elements hashed. Spark counts, for each host,
on how many distinct pages a subtree recurs; those that recur on `min_pages` or more, at any size of the
host, are the site's template and are deleted first. What counting can't know, as it is on few pages,
goes next: elements whose name, class, id or role says that they aren't the article. The blocks that
remain in the article element (or, without one, in the body) are the main text.

Pages are told apart by their whole remaining text, and copies count once. What a page has beside texts
that recur on the host is its own part; pages of which less than OWN is their own are near copies, and
count once for each set of recurring texts. For elements inside an article, the own part of the article
counts. Headings and paragraphs of an article (or of a page without one) are template only where they
stand on `prose_share` of the distinct pages of the host, half, and on pages most of which is their own:
a passage that some texts share is part of these texts. Null html is empty and gives an empty text; a null url is one host. Broken
markup is read as far as it goes: what isn't closed ends with its parent or the page. An element that
recurs often in one page counts once for it. Very long pages are read whole. Repeated rows give repeated
results; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .common import by_bytes, mixed, small_batches, small_or_shuffled, staged

# Names of HTML elements by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg".split())
NOT_ARTICLE = frozenset("nav header footer aside form button select dialog menu head".split()) | RAW
BLOCKS = frozenset("address article aside blockquote body br dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section table tbody td tfoot th thead tr ul summary caption".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th".split())
HEAD = frozenset("title meta link base script style noscript template".split())
#: Share of the texts of a page, or of their characters, that is its own, from which on it isn't a near copy.
OWN = 1 / 7
#: A new one of these ends an open one of the same group.
ENDS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("article section div ul ol table body main aside nav blockquote td dl".split())
NOT_MAIN = re.compile(
    r"(?:(?:site|page|top|main|global|left|right|bottom|blog|reader|user|google|inline)[-_])?"
    r"(?:ads?|adverts?|advert\w+|adsense|banner|sponsor\w*|promo\w*|nav|navbar|navigation|menu|breadcrumbs?|header|masthead|footer|sidebar|widget|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|subscri\w*|signup|login|shar(?:e|ing)|social|related|recommend\w*|comments?|commentlist|disqus|responses|replies|pagination|pager|toolbar|skip|copyright|legal|disclaimer)"
    r"(?:[-_][\w-]*)?",
    re.I,
)
NOT_MAIN_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
TAG = re.compile(r"<(?:!--.*?(?:-->|$)|![^>]*>?|\?[^>]*>?|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>)", re.S)
ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)


class Node:
    """An element: its name, whether its own marks exclude it, and its children (nodes and texts)."""

    __slots__ = ("name", "out", "parts", "digest", "inside")

    def __init__(self, name: str, out: bool, inside: bool):
        self.name, self.out, self.parts, self.digest, self.inside = name, out, [], b"", inside


def excluded(name: str, attributes: str, inside: bool) -> bool:
    """Whether an element is not the article by its name or marks; a header inside an article is its own."""
    if name in NOT_ARTICLE and not (inside and name == "header"):
        return True
    if "=" in attributes or "hidden" in attributes:
        for key, a, b, c in ATTRIBUTE.findall(attributes):
            key, value = key.lower(), a or b or c
            if key == "role" and value.lower() in NOT_MAIN_ROLES or key in ("class", "id") and name not in ("body", "html", "article", "main") and any(map(NOT_MAIN.fullmatch, value.split())):
                return True
            if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
                return True
    return False


def parsed(page: str) -> Node:
    """The element tree of a page; it takes any text."""
    root = Node("#root", False, False)
    open_, at = [root], 0
    find = TAG.search
    while m := find(page, at):
        if m.start() > at:
            open_[-1].parts.append(page[at : m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            for i in range(len(open_) - 1, 0, -1):
                if open_[i].name == name:
                    del open_[i:]
                    break
                if open_[i].name in ("article", "main", "body") and name in PROSE:
                    break
            continue
        if ends := ENDS.get(name):
            for i in range(len(open_) - 1, 0, -1):
                if open_[i].name in ends:
                    del open_[i:]
                    break
                if open_[i].name in SCOPE and not (name in ("td", "th", "tr") and open_[i].name in ("td", "th")):
                    break
        if name in ("article", "main", "body"):  # a menu or head before it that isn't closed ends here
            for i in range(1, len(open_)):
                if open_[i].name in ("head", "nav", "header"):
                    del open_[i:]
                    break
        elif len(open_) > 1 and open_[-1].name == "head" and name not in HEAD:
            open_.pop()
        node = Node(name, excluded(name, m[3], open_[-1].inside), open_[-1].inside or name in ("article", "main"))
        open_[-1].parts.append(node)
        if name in RAW and not m[3].endswith("/"):
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            node.parts.append(page[at : end.start() if end else len(page)])
            at = end.end() if end else len(page)
        elif name not in VOID and not m[3].endswith("/"):
            open_.append(node)
    if at < len(page):
        rest = page[at:]
        cut = re.search(r"<[/a-zA-Z!][^>]*$", rest)  # a tag that the page breaks off in
        open_[-1].parts.append(rest[: cut.start()] if cut else rest)
    return root


def digest(node: Node) -> bytes:
    """Hashes the subtree; without recursion, as broken pages nest deeply."""
    order, left = [], [node]
    while left:
        order.append(now := left.pop())
        left += [x for x in now.parts if isinstance(x, Node)]
    for now in reversed(order):
        h = blake2b(now.name.encode(), digest_size=8)
        for x in now.parts:
            h.update(x.digest if isinstance(x, Node) else b" ".join(x.encode("utf-8", "replace").split()) + b"\x00")
        now.digest = h.digest()
    return node.digest


def template_candidates(root: Node) -> Iterator[tuple[Node, int]]:
    """Subtrees that may be template, which are block elements, whatever their marks say: 1 outside an article, 2 inside, 3 for its prose.

    A page without an article is one; in what its marks exclude, everything is outside.
    """
    found, left, has_article = [], [(root, False)], False
    while left:
        top, out = left.pop()
        for x in top.parts:
            if isinstance(x, Node):
                has_article = has_article or x.name in ("article", "main")
                if x.name in BLOCKS and x.name not in ("html", "body", "article", "main"):
                    found.append((x, out or x.out))
                left.append((x, out or x.out))
    for x, out in found:
        yield x, 1 if out or has_article and not x.inside else 3 if x.name in PROSE else 2 if x.inside else 1


def pieces(top: Node, template: set[bytes], removed: list[int] | None = None) -> Iterator[tuple[str, bool]]:
    """The texts between block elements, white space made single, and whether each is inside an article.

    `removed` counts the elements left out as template and by their marks.
    """
    held, inside, left = [], False, [top]
    while left:
        now = left.pop()
        if isinstance(now, tuple):
            text, inside = now
            held.append(entities.unescape(text) if "&" in text else text)
            continue
        out = now is not None and (now.digest in template or now.out and now is not top)
        if out and removed is not None:
            removed[now.digest not in template] += 1
        if now is None or now.name in BLOCKS:
            if words := " ".join("".join(held).split()):
                yield words, inside
            held.clear()
        if now is not None and not out:
            if now.name in BLOCKS:
                left.append(None)
            left += [x if isinstance(x, Node) else (x, now.inside) for x in reversed(now.parts)]
    if words := " ".join("".join(held).split()):
        yield words, inside


def number(*parts: bytes) -> int:
    return int.from_bytes(blake2b(b"\x00".join(parts), digest_size=8).digest(), "big", signed=True)


def page_rows(root: Node) -> tuple[int, dict[tuple[int, int], int]]:
    """A hash of the whole remaining text, and (kind, hash): length of the page (kind 0), its subtrees (1 to 3) and its texts (4, inside an article 5)."""
    own = [(words.encode("utf-8", "replace"), inside) for words, inside in pieces(root, set())]
    found = {(0, 0): 0}
    found |= {(kind, int.from_bytes(x.digest, "big", signed=True)): 0 for x, kind in template_candidates(root)}
    found |= {(5 if inside else 4, number(words)): len(words) for words, inside in own}
    return number(*(words for words, _ in own)), found


def main_text(root: Node, template: set[bytes]) -> tuple[list[str], list[int]]:
    """The blocks of the main text, white space made single, and how many elements were left out as template and by their marks."""

    def roots() -> list[Node]:
        for wanted in ("article", "main"):
            found, left = [], [root]
            while left:
                now = left.pop()
                if now.name == wanted:
                    found.append(now)
                    continue
                left += [x for x in reversed(now.parts) if isinstance(x, Node) and not x.out and x.digest not in template]
            if found:
                return found
        return [root]

    removed, outside = [0, 0], [0, 0]
    tops = roots()
    blocks = [words for top in tops for words, _ in pieces(top, template, removed)]
    if tops != [root]:  # what stands outside the article falls away; it is counted all the same
        for _ in pieces(root, template, outside):
            pass
    return blocks, outside if tops != [root] else removed


def host_column() -> Column:
    """The host of `url` without port, user and letter case; none is the empty string."""
    return F.coalesce(F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1)), F.lit(""))


def site_templates(pages: DataFrame, min_pages: int = 5, prose_share: float = 0.5) -> DataFrame:
    """(host, subtree, n_pages) of the subtrees that recur on `min_pages` distinct pages of the host, at least, and for prose on that share of them."""
    names, kinds = ["host", "page", "kind", "key", "n"], [pa.string(), *[pa.int64()] * 4]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "html"):
            columns: list[list] = [[] for _ in names]
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                root = parsed(page or "")
                digest(root)
                mark, found = page_rows(root)
                for (kind, key), n in found.items():
                    for column, value in zip(columns, (host, mark, kind, key, n), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    each = pages.select(host_column().alias("host"), "html").mapInArrow(run, "host string, page long, kind long, key long, n long")
    each = staged(each.groupBy("host", "page", "kind", "key").agg(F.max("n").alias("n"))).withColumn("text", F.col("kind") > 3)
    often = staged(each.where("kind > 0").groupBy("host", "text", "key").agg(F.count_distinct("page").alias("n_pages")).where(F.col("n_pages") >= min_pages).select("host", "text", "key"))
    texts, subtrees = (small_or_shuffled(staged(often.where(x).select("host", "key"))) for x in ("text", "not text"))

    own, inside = F.col("often").isNull(), F.col("kind") == 5
    sums = {"own": own, "all": F.lit(True), "own_in": own & inside, "all_in": inside}
    counts = [F.count_if(c).alias(f"n_{x}") for x, c in sums.items()] + [F.sum(F.when(c, F.col("n")).otherwise(0)).alias(f"c_{x}") for x, c in sums.items()]
    rest = [F.xxhash64(F.array_sort(F.collect_set(F.when(c, F.col("key"))))).alias(x) for x, c in (("rest", ~own), ("rest_in", ~own & inside))]
    rows = each.where("text").join(texts.withColumn("often", F.lit(True)), ["host", "key"], "left")
    apart = {x: (F.col(f"n_own{x}") >= OWN * F.col(f"n_all{x}")) | (F.col(f"c_own{x}") >= OWN * F.col(f"c_all{x}")) for x in ("", "_in")}
    most = (2 * F.col("n_own_in") > F.col("n_all_in") - 1) | (2 * F.col("c_own_in") > F.col("c_all_in"))
    named = rows.groupBy("host", "page").agg(*counts, *rest)
    document = F.when(apart[""], F.col("page")).otherwise(F.col("rest"))
    named = staged(named.select("host", "page", document.alias("d1"), F.when(apart["_in"], F.col("page")).otherwise(F.col("rest_in")).alias("d2"), F.when(most, document).alias("d3")))

    of_host = staged(named.groupBy("host").agg(F.count_distinct("d1").alias("of")))
    held = each.where("kind between 1 and 3").join(subtrees, ["host", "key"]).join(named, ["host", "page"])
    counts = [F.count_distinct(F.when(F.col("kind") == k, F.col(f"d{k}"))).alias(f"n{k}") for k in (1, 2, 3)]
    counted = held.groupBy("host", "key").agg(*counts).join(small_or_shuffled(of_host), "host")
    enough = (F.col("n1") + F.col("n2") >= min_pages) | (F.col("n3") >= F.greatest(F.lit(min_pages), prose_share * F.col("of")))
    return counted.where(enough).select("host", F.col("key").alias("subtree"), (F.col("n1") + F.col("n2") + F.col("n3")).alias("n_pages"))


def subtree_keys(host: str, root: Node) -> tuple[list[bytes], np.ndarray]:
    """Digests of the subtrees that may be template, and numbers for them on this host."""
    found = list({x.digest for x, _ in template_candidates(root)})
    own = np.frombuffer(b"".join(found), ">i8").astype(np.int64).view(np.uint64)
    return found, mixed(own ^ mixed(np.array([number(host.encode("utf-8", "replace"))], np.int64).view(np.uint64)))


def templates_of_pages(pages: DataFrame, template: DataFrame) -> DataFrame:
    """(page, template): a hash of the html and the subtrees of the page itself that are template, for templates of any number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "html"):
            columns: list[list] = [[], [], []]
            for page, host, text in zip(*(batch.column(c).to_pylist() for c in ("page", "host", "html")), strict=True):
                root = parsed(text or "")
                digest(root)
                for x in {x.digest for x, _ in template_candidates(root)}:
                    for column, value in zip(columns, (page, host, int.from_bytes(x, "big", signed=True)), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.string(), pa.int64()), strict=True)], ["page", "host", "subtree"])

    each = pages.select("page", "host", "html").mapInArrow(run, "page long, host string, subtree long").distinct()
    return each.join(template, ["host", "subtree"]).groupBy("page", "host").agg(F.collect_set("subtree").alias("template"))


def extract(pages: DataFrame, min_pages: int = 5, prose_share: float = 0.5) -> DataFrame:
    """(page_id, url, blocks, n_template, n_marked) of every page: the blocks of the main text, and how many elements went as template and by their marks."""
    small_batches(pages.sparkSession)
    template = staged(site_templates(pages, min_pages, prose_share).select("host", "subtree"))
    rows = pages.select("page_id", "url", "html", host_column().alias("host"))
    few = template.count() <= common.BROADCAST_ROWS
    if few:  # a sorted array of numbers, 8 bytes each
        hashed = template.groupBy("host").agg(F.collect_list("subtree").alias("subtrees")).toPandas()
        numbers = [mixed(np.array(x, np.int64).view(np.uint64) ^ mixed(np.array([number(h.encode("utf-8", "replace"))], np.int64).view(np.uint64))) for h, x in zip(hashed["host"], hashed["subtrees"], strict=True)]
        held = pages.sparkSession.sparkContext.broadcast(np.sort(np.concatenate(numbers)) if numbers else np.zeros(0, np.uint64))
        rows = rows.withColumn("template", F.lit(None).cast("array<long>"))
    else:
        keyed = pages.select(F.xxhash64("html").alias("page"), host_column().alias("host"), "html")
        rows = rows.withColumn("page", F.xxhash64("html")).join(templates_of_pages(keyed, template), ["page", "host"], "left").select("page_id", "url", "html", "host", "template")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value if few else np.zeros(0, np.uint64)
        for batch in by_bytes(batches, "html"):
            out, counts = [], []
            for host, page, own in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "template")), strict=True):
                root = parsed(page or "")
                digest(root)
                found = {x.to_bytes(8, "big", signed=True) for x in own or ()}
                if len(known):
                    digests, keys = subtree_keys(host, root)
                    place = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                    found = {digests[i] for i in np.flatnonzero(known[place] == keys).tolist()}
                blocks, removed = main_text(root, found)
                out.append(blocks)
                counts.append(removed)
            numbers = [pa.array([c[i] for c in counts], pa.int64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(out, pa.list_(pa.string())), *numbers], ["page_id", "url", "blocks", "n_template", "n_marked"])

    return rows.mapInArrow(run, "page_id long, url string, blocks array<string>, n_template long, n_marked long")
