"""HTML extraction: the main text of pages, without a site's templates."""

from __future__ import annotations

import re
from hashlib import blake2b
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import extended, materialize, pieces
from .urls import host_of

#: Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
SILENT = frozenset("script style noscript template iframe object svg canvas math head title audio video map".split())
CHROME = frozenset("nav footer aside form menu button select textarea dialog input label fieldset".split())
#: Class, id and role values that mark what is not the article, as whole values or joined by - or _ from these words
#: alone (cookie-notice, site-footer, ad-slot-3).
MARKS = frozenset("ads adv advert advertisement adverts breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer masthead menu modal nav navbar navigation newsletter popup promo promoted sidebar sponsor sponsored subscribe toolbar topbar widget".split())
#: Words that an article's own parts may bear too: they mark as whole values, or beside a word above or one of these.
WEAK = frozenset("ad banner header notice related respond share sharing social".split())
_BESIDE = frozenset("area bar block bottom box button buttons container content form inner items left link links list main outer page panel right row section site slot top wrap wrapper".split())
_P_CLOSERS = BLOCK - {"body", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "li", "dt", "dd", "option", "optgroup", "legend", "summary", "figcaption"}
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_LIMITS = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "tbody", "thead", "tfoot"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
#: What may be a template within an article.
_CONTAINERS = frozenset("div section ul ol dl table figure form fieldset details".split())
_DIGITS = re.compile(r"\d+")
_HEADS = frozenset("banner header masthead".split())
_PARTS = re.compile(r"[-_]+|(?<=[a-z])(?=[0-9])")


class Element:
    """head: a header or one by its class; silent: never text of an article; marked: by class, id or role."""

    __slots__ = ("tag", "parts", "marked", "head", "gone")

    def __init__(self, tag: str, values: str = "", hidden: bool = False):
        words: set[str] = set()
        for value in values.split():
            if value.isalpha():
                words.add(value)
            else:
                own = [w for w in _PARTS.split(value) if w and not w.isdigit()]
                if all(w in MARKS or w in WEAK or w in _BESIDE for w in own):
                    words.update(own)
        words &= MARKS | WEAK
        self.tag, self.parts, self.gone = tag, [], False
        self.head = tag == "header" or bool(words & _HEADS)
        self.marked = hidden or bool(words - _HEADS)

    def dropped(self, inside: bool) -> bool:
        """An article's own header stays, as it holds its title."""
        return self.gone or self.marked or self.tag in SILENT or self.tag in CHROME or (self.head and not inside)


class _Tree(HTMLParser):
    """The element tree, with the end tags that HTML lets pages leave out."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Element("html")
        self.stack = [self.root]

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag in ("html", "body"):
            return
        if tag in _P_CLOSERS:
            self._close({"p"}, {"td", "th", "li", "div", "article", "section", "main", "aside", "blockquote", "button", "form", "table"} - {"p"})
        if tag in _SIBLINGS:
            self._close(_SIBLINGS[tag], _LIMITS[tag])
        values = " ".join(v for k, v in attrs if v and k in ("class", "id", "role")).lower()
        one = Element(tag, values, any(k in ("hidden", "aria-hidden") and v != "false" for k, v in attrs))
        self.stack[-1].parts.append(one)
        if tag not in VOID:
            self.stack.append(one)

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCK and tag not in ("html", "body"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                del self.stack[i:]
                return
            if self.stack[i].tag in ("table", "article") and tag not in BLOCK:
                return

    def handle_data(self, data: str) -> None:
        self.stack[-1].parts.append(data)

    def _close(self, tags: set[str], limits: set[str]) -> None:
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag in tags:
                del self.stack[i:]
                return
            if self.stack[i].tag in limits:
                return


def parse(html: str) -> Element:
    tree = _Tree()
    tree.feed(html)
    tree.close()
    return tree.root


def main_part(root: Element) -> Element:
    """The article or main elements that no other holds, in page order; the whole page if there is none."""
    found, todo = [], [iter(root.parts)]
    while todo:
        p = next(todo[-1], None)
        if p is None:
            todo.pop()
        elif isinstance(p, Element) and not (p.tag in SILENT or p.marked):
            if p.tag in ("main", "article"):
                found.append(p)
            else:
                todo.append(iter(p.parts))
    if len(found) < 2:
        return found[0] if found else root
    both = Element("main")
    both.parts = found
    return both


def blocks(part: Element, inside: bool) -> list[str]:
    """The text of each block in page order: white space is one space, ends are trimmed, empty blocks are left out."""
    done: list[str] = []
    now: list[str] = []

    def end() -> None:
        if text := " ".join("".join(now).split()):
            done.append(text)
        now.clear()

    todo, ends = [iter(part.parts)], [True]
    while todo:
        p = next(todo[-1], None)
        if p is None:
            todo.pop()
            if ends.pop():
                end()
        elif isinstance(p, str):
            now.append(p)
        elif p.tag == "br":
            now.append(" ")
        elif not p.dropped(inside):
            block = p.tag in BLOCK
            if block:
                end()
            todo.append(iter(p.parts))
            ends.append(block)
    return done


def subtrees(root: Element, part: Element) -> list[tuple[Element, int]]:
    """Block subtrees with text that may be templates, each with its hash: all outside the article; within it, containers alone."""
    order, within, todo = [], [], [(root, part is root)]
    while todo:
        e, inside = todo.pop()
        inside = inside or e is part or (part is not root and e.tag in ("main", "article"))
        order.append(e)
        within.append(inside)
        todo += [(p, inside) for p in e.parts if isinstance(p, Element) and p.tag not in SILENT]
    names: dict[int, bytes] = {}
    out = []
    for e, inside in zip(reversed(order), reversed(within), strict=True):
        h = blake2b(e.tag.encode(), digest_size=8)
        filled = False
        for p in e.parts:
            text = _DIGITS.sub("0", " ".join(p.split())).encode() if isinstance(p, str) else names.get(id(p), b"")
            filled |= bool(text)
            h.update(b"|" + text)
        names[id(e)] = h.digest() if filled else b""
        if filled and e is not root and e is not part and e.tag in BLOCK:
            if part is root or not inside:
                out.append((e, int.from_bytes(names[id(e)], "little", signed=True)))
            elif e.tag in _CONTAINERS:
                out.append((e, int.from_bytes(h.digest() + b"in", "little") % (1 << 63)))
    return out


def extract_text(
    pages: DataFrame, least_pages: int = 5, share: float = 0.02, share_within: float = 0.5, url: str = "url", html: str = "html"
) -> DataFrame:
    """All rows of pages with text (main text, blocks joined by a line feed) and n_chars (its code points).

    Two passes. The first hashes block subtrees, and Spark counts on how many pages of its host each stands. The
    second drops those that stand on at least least_pages pages and `share` of the host's (within an article: only
    containers such as div or ul, and share_within, so paragraphs that many articles share stay), and the elements
    that HTML or their class, id or role mark as menus, headers, footers, sidebars, notices, adverts, forms, scripts,
    styles or comments. It keeps the article or main element, or the whole page where there is none. A host has at
    most its subtrees a page / share templates. Pages of a host with equal contents count once. Null and empty pages give ''; pages without a URL are one host.
    Columns of pages with the added names are replaced.
    """
    own = [c for c in pages.columns if c not in ("text", "n_chars", "_host", "_html", "_trees")]
    x = pages.select(*own, F.xxhash64(host_of(F.col(url))).alias("_host"))

    def count(batches):
        for batch in pieces(batches):
            hosts, contents, trees = [], [], []
            for host, content, page in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                root = parse(page or "")
                mine = {h for e, h in subtrees(root, main_part(root))}
                hosts += [host] * len(mine)
                contents += [content] * len(mine)
                trees += mine
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (hosts, contents, trees)], ["host", "content", "tree"])

    # Pages of a host with equal contents are one: the copies that a crawl holds say nothing about a template.
    content = F.xxhash64(html).alias("content")
    trees = x.select("_host", content, F.col(html).alias("h")).mapInArrow(count, "host long, content long, tree long")
    found = trees.groupBy("host", "tree").agg(F.count_distinct("content").alias("n"))
    sizes = x.select(F.col("_host").alias("host"), content).groupBy("host").agg(F.count_distinct("content").alias("pages"))
    found = found.where(F.col("n") >= least_pages).join(sizes, "host").where(F.col("n") >= share * F.col("pages"))
    found = found.groupBy("host").agg(F.collect_list(F.struct("tree", (F.col("n") >= share_within * F.col("pages")).alias("most"))).alias("_trees"))
    found = materialize(found.withColumnRenamed("host", "_host"), "templates")
    joined = x.join(found, "_host", "left").select(*own, F.col(html).alias("_html"), "_trees")
    n = len(own)

    def extract(batches):
        for batch in pieces(batches):
            out = []
            for page, trees in zip(batch.column(n).to_pylist(), batch.column(n + 1).to_pylist(), strict=True):
                root = parse(page or "")
                part = main_part(root)
                inside = part is not root
                if trees:
                    known = {t["tree"]: t["most"] for t in trees}
                    for e, h in subtrees(root, part):
                        e.gone = known.get(h, False) if inside and e.tag in _CONTAINERS else h in known
                out.append("\n".join(blocks(part, inside)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(out, pa.string())], [*batch.schema.names[:n], "text"])

    schema = extended(pages.select(*own).schema, "text string")
    return joined.mapInArrow(extract, schema).withColumn("n_chars", F.length("text").cast("long"))
