"""Main text of web pages by wrapper induction.

Pages of one host share a template.  Every page is parsed into a tree of
blocks; runs of like siblings (paragraphs, list items) become one repeated
node.  Pages of a host whose containers have the same skeleton are one layout; the
tree of every page is aligned with the tree of its layout's reference page (the
smallest page_id) by simple tree matching, the largest top-down mapping that
keeps the order of siblings.  A node is known by its path in the reference, which
the layouts of a host share where they have it in common.  The texts are counted
per node over all pages of the host: a text that stands there in ``CONSTANT`` of
the different articles that have the node, plus ``MARGIN`` (so in all of 3 or 4,
and of at least ``LEAST_PAGES``), is template, what varies is a content slot.
Near copies are one article's evidence: pages with equal content texts, or with
two of their three longest texts in common (the only long one, if it is at least
half of the text).  Elements that name themselves as something else (menus,
headers, footers, sidebars, notices, adverts, forms, comments, scripts) are left
out by their tag or their class;
if a page marks its article, no blocks outside stay, and of those inside only
slots of the template go: nodes where no page of the host has another text.  A text that is
constant beside varying ones of its node, as a lead among paragraphs, stays there.
Every page is aligned, counted and judged, marked or not.

Pages are parsed once.  The parse leaves the page's content blocks and a small
skeleton; only skeletons are shuffled, and a page is joined with the numbers of
its blocks that are template.

Defined cases: null or empty html gives an empty text; a null url is a host of
its own; repeated rows are extracted each; broken markup (unclosed or crossed
elements, cut tags) is closed as browsers do.  Other columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate, combinations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, components

CONSTANT, LEAST_PAGES, MARGIN = 0.6, 3, 1.2
#: Characters from which a text is long enough to tell one article from another.
LONG = 50
#: Containers down to this depth, and outside these elements of running text, make the layout of a page.
LAYOUT_DEPTH = 6
FLOW = frozenset("p ul ol li dl dt dd table thead tbody tfoot tr td th blockquote figure pre head h1 h2 h3 h4 h5 h6".split())

# fixed values: elements of HTML by their role
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe noframes xmp template".split())
OTHER = frozenset("head nav footer aside form button select menu dialog svg canvas audio video object figure-nav "
                  "script style title textarea noscript iframe noframes template".split())
ARTICLE = frozenset(["article", "main"])
#: Words of class, id or role by which an element names itself as something other than the article.
NAMES = frozenset("nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer masthead banner ad ads "
                  "advert adverts advertisement advertising adsense sponsor sponsored promo promotion cookie cookies "
                  "consent gdpr notice newsletter subscribe signup popup modal overlay comment comments reply replies "
                  "respond disqus share sharing social related recommended widget toolbar pagination pager contentinfo "
                  "search complementary dialog alert".split())
CLOSED_BY = {"p": None, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"},
             "th": {"td", "th", "tr"}, "option": {"option", "optgroup"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "tbody", "thead", "tfoot"},
         "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}

TOKEN = re.compile(
    r"<!--(?:>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)", re.S)
ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
WORD = re.compile(r"[a-z]+")
HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


@dataclass
class Block:
    text: str
    skip: bool
    article: bool


@dataclass(eq=False)
class Node:
    """A block element; like neighbours are one node with the texts of all of them."""
    sig: str
    children: list["Node"] = field(default_factory=list)
    items: list[tuple[int, int, bool]] = field(default_factory=list)  # (block number, hash of text, left out anyway)
    order: int = 0


@dataclass
class _Open:
    tag: str
    node: Node
    skip: bool
    article: bool
    block: bool


def _names(attrs: str) -> tuple[frozenset, bool]:
    words, hidden = set(), False
    for name, a, b, c in ATTR.findall(attrs):
        name = name.lower()
        if name in ("class", "id", "role"):
            words.update(WORD.findall((a or b or c).lower()))
        elif name == "hidden" or name == "itemprop" and (a or b or c).lower() == "articlebody":
            hidden = hidden or name == "hidden"
            words.add("articlebody" if name == "itemprop" else "")
    return frozenset(words), hidden


def parse(page: str) -> tuple[Node, list[Block]]:
    """The block tree of a page, and its blocks of text in page order."""
    root = Node("#")
    stack = [_Open("#", root, False, False, True)]
    blocks: list[Block] = []
    parts: list[str] = []
    seen: dict[str, tuple[frozenset, bool]] = {}

    def flush() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                top = stack[-1]
                number = len(blocks)
                blocks.append(Block(text, top.skip, top.article))
                top.node.items.append((number, xxhash.xxh3_64_intdigest(text) - (1 << 63), top.skip))

    def say(text: str) -> None:
        if text:
            top = stack[-1]
            if not top.block and top.skip and not _block(stack).skip:
                return  # an inline element that is left out inside a block that stays
            parts.append(entities.unescape(text) if "&" in text else text)

    def pop_to(k: int) -> None:
        if any(o.block for o in stack[k:]):
            flush()
        del stack[k:]

    def start(tag: str, attrs: str) -> None:
        if tag == "br":
            parts.append(" ")
            return
        if tag in VOID:
            if tag == "hr":
                flush()
            return
        words, hidden = frozenset(), False
        if attrs.strip():
            words, hidden = seen[attrs] if attrs in seen else seen.setdefault(attrs, _names(attrs))
        top = stack[-1]
        inline = tag in INLINE
        if not inline:
            for k in range(len(stack) - 1, 0, -1):  # what this element closes
                o = stack[k]
                if o.tag == "p" or (tag in CLOSED_BY.get(o.tag, ()) if CLOSED_BY.get(o.tag) else False):
                    pop_to(k)
                    if o.tag != "p":
                        break
                elif o.tag in SCOPE.get(tag, ()) or (o.block and o.tag not in CLOSED_BY):
                    break
            else:
                pass
            flush()
            top = stack[-1]
        article = top.article or tag in ARTICLE or "articlebody" in words or (words == {"main"} and tag != "nav")
        header = (tag == "header" or "header" in words) and not article
        skip = top.skip or hidden or tag in OTHER or header or bool(words & NAMES and not (
            tag in ("html", "body") or tag in ARTICLE and not words & {"comment", "comments", "reply"}))
        if inline:
            stack.append(_Open(tag, top.node, skip, article, False))
            return
        sig = tag + ("." + ".".join(sorted(words)) if words else "")
        last = top.node.children[-1] if top.node.children else None
        node = last if last is not None and last.sig == sig else Node(sig)
        if node is not last:
            top.node.children.append(node)
        stack.append(_Open(tag, node, skip, article, True))

    def end(tag: str) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag == tag:
                pop_to(k)
                return
            if tag in INLINE and stack[k].block:
                return

    pos, size, low = 0, len(page), None
    while pos < size:
        m = TOKEN.search(page, pos)
        if m is None:
            say(page[pos:])
            break
        if m.start() > pos:
            say(page[pos:m.start()])
        pos = m.end()
        tag = m["tag"] or m["tag2"]
        if tag is None:
            continue
        tag = tag.lower()
        if m["end"] or m["end2"]:
            end(tag)
            continue
        attrs = m["attrs"] or m["attrs2"] or ""
        if tag in RAW and not attrs.endswith("/"):
            if low is None:
                low = page.lower() if len(page.lower()) == size else page
            close = low.find("</" + tag, pos)
            if tag not in ("script", "style", "title", "textarea", "noscript", "iframe", "noframes", "xmp", "template"):
                say(page[pos:close if close >= 0 else size])
            stop = page.find(">", close) if close >= 0 else -1
            pos = stop + 1 if stop >= 0 else size
            continue
        start(tag, attrs)
    flush()
    return root, blocks


def _block(stack: list[_Open]) -> _Open:
    return next(o for o in reversed(stack) if o.block)


def marks(blocks: list[Block]) -> bool:
    """Whether the page marks its article."""
    return any(b.article and not b.skip for b in blocks)


def candidates(blocks: list[Block]) -> list[tuple[int, str]]:
    """Numbers and texts of the blocks that stay: those of the article if the page marks one."""
    inside = marks(blocks)
    return [(i, b.text) for i, b in enumerate(blocks) if not b.skip and (b.article or not inside)]


def article_keys(texts: list[str]) -> list[int]:
    """Numbers of which near copies of one article have one in common."""
    texts = list(dict.fromkeys(texts))
    most = sorted((t for t in texts if len(t) >= LONG), key=lambda t: (-len(t), t))[:3]
    keys = [("whole", *texts), *(("pair", *sorted(p)) for p in combinations(most, 2))]
    if len(most) == 1 and 2 * len(most[0]) >= sum(map(len, texts)):
        keys.append(("only", most[0]))
    return [xxhash.xxh3_64_intdigest("\0".join(k).encode("utf-8", "surrogatepass")) - (1 << 63) for k in keys]


def content(page: str) -> str:
    """The main text of one page on its own, without a host's template."""
    return "\n".join(text for _, text in candidates(parse(page)[1]))


def flat(node: Node) -> list:
    """The rows (depth, sig, items) of a tree in document order."""
    out, todo = [], [(0, node)]
    while todo:
        depth, node = todo.pop()
        out.append((depth, node.sig, node.items))
        todo += [(depth + 1, c) for c in reversed(node.children)]
    return out


def skeleton(rows: list) -> int:
    """The layout of a flat tree: the paths of its containers, without the elements of running text."""
    path: list[str] = []
    found = set()
    for k, (depth, sig, _) in enumerate(rows):
        del path[depth:]
        path.append(sig)
        inside = k + 1 < len(rows) and rows[k + 1][0] > depth
        if inside and depth <= LAYOUT_DEPTH and not FLOW & {x.partition(".")[0] for x in path}:
            found.add(" ".join(path))
    return xxhash.xxh3_64_intdigest("\0".join(sorted(found)).encode("utf-8", "surrogatepass")) - (1 << 63)


def paths(rows: list) -> list[int]:
    """For every node of a flat tree a number of its path: the signatures, and the place among like siblings."""
    out: list[int] = []
    path: list[tuple[int, Counter]] = []
    for depth, sig, _ in rows:
        del path[depth:]
        above, siblings = path[-1] if path else (0, Counter())
        siblings[sig] += 1
        here = xxhash.xxh3_64_intdigest(f"{above} {siblings[sig]} {sig}".encode("utf-8", "surrogatepass")) - (1 << 63)
        out.append(here)
        path.append((here, Counter()))
    return out


def unflat(rows: list) -> Node:
    """The tree of rows (depth, sig, items) in document order."""
    path: list[Node] = []
    for order, (depth, sig, items) in enumerate(rows):
        node = Node(sig, [], items, order)
        del path[depth:]
        if path:
            path[-1].children.append(node)
        path.append(node)
    return path[0]


def shapes(root: Node, numbers: dict) -> dict[int, int]:
    """Node number -> number of its subtree's shape; ``numbers`` gives equal subtrees of both trees one number."""
    out, todo = {}, [(root, False)]
    while todo:
        node, known = todo.pop()
        if not known and node.children:
            todo.append((node, True))
            todo += [(c, False) for c in node.children]
        else:
            out[node.order] = numbers.setdefault((node.sig, *(out[c.order] for c in node.children)), len(numbers))
    return out


class Matching:
    """Simple tree matching: the largest top-down, order-keeping mapping of tree ``a`` onto ``b``.

    Equal subtrees match whole, and equal subtrees at the head of two sibling lists match each other
    (no mapping is larger), so only what follows them takes a table; a leaf takes none.
    """

    def __init__(self, a: Node, b: Node):
        numbers: dict = {}
        self.a, self.b, self.memo = a, b, {}
        self.of_a, self.of_b = shapes(a, numbers), shapes(b, numbers)
        self.sizes: dict[int, int] = {}
        todo = [(a, False)]
        while todo:
            node, known = todo.pop()
            if not known and node.children:
                todo.append((node, True))
                todo += [(c, False) for c in node.children]
            else:
                self.sizes[node.order] = 1 + sum(self.sizes[c.order] for c in node.children)
        self.size = 0 if a.sig != b.sig else self._solve()

    def _head(self, x: Node, y: Node) -> int:
        head = 0
        for c, d in zip(x.children, y.children):
            if self.of_a[c.order] != self.of_b[d.order]:
                break
            head += 1
        return head

    def _known(self, x: Node, y: Node) -> int | None:
        """The size of the matching of two nodes of one kind, where it needs no table or has one."""
        if self.of_a[x.order] == self.of_b[y.order]:
            return self.sizes[x.order]
        if not x.children or not y.children:
            return 1
        found = self.memo.get((x.order, y.order))
        return None if found is None else found[0]

    def _solve(self) -> int:
        todo = [(self.a, self.b, False)]
        while todo:
            x, y, ready = todo.pop()
            if self._known(x, y) is not None:
                continue
            head = self._head(x, y)
            xs, ys = x.children[head:], y.children[head:]
            if not ready:  # the children's pairs first
                todo.append((x, y, True))
                todo += [(c, d, False) for c in xs for d in ys if c.sig == d.sig and self._known(c, d) is None]
                continue
            best = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
            for i, c in enumerate(xs, 1):
                row, above = best[i], best[i - 1]
                for j, d in enumerate(ys, 1):
                    row[j] = max(above[j], row[j - 1], above[j - 1] + (self._known(c, d) if c.sig == d.sig else 0))
            whole = 1 + best[-1][-1] + sum(self.sizes[c.order] for c in x.children[:head])
            self.memo[x.order, y.order] = (whole, head, best)
        return self._known(self.a, self.b)

    def mapping(self) -> dict[int, int]:
        """Node numbers of ``a`` -> of ``b``."""
        out: dict[int, int] = {}
        todo = [(self.a, self.b)] if self.size else []
        while todo:
            x, y = todo.pop()
            out[x.order] = y.order
            if self.of_a[x.order] == self.of_b[y.order]:
                todo += zip(x.children, y.children)
                continue
            if not x.children or not y.children:
                continue
            _, head, best = self.memo[x.order, y.order]
            todo += zip(x.children[:head], y.children[:head])
            i, j = len(x.children) - head, len(y.children) - head
            while i and j:
                if best[i][j] == best[i - 1][j]:
                    i -= 1
                elif best[i][j] == best[i][j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    todo.append((x.children[head + i], y.children[head + j]))
        return out


def match(a: Node, b: Node, memo: dict) -> int:
    """The size of the matching of ``a`` and ``b``, which is left in ``memo`` for ``mapping``."""
    memo[a, b] = Matching(a, b)
    return memo[a, b].size


def mapping(a: Node, b: Node, memo: dict, out: dict[int, int]) -> None:
    """The pairs of node numbers (of ``a``: of ``b``) that the matching maps."""
    out.update(memo[a, b].mapping())


ROWS = "array<struct<depth: int, sig: string, items: array<struct<number: int, hash: long, skip: boolean>>>>"
_BLOCKS = pa.list_(pa.struct([("number", pa.int32()), ("text", pa.string())]))


def parsed(pages: DataFrame) -> DataFrame:
    """page_id, url, host, page (hash of the html), rows (flat block tree), blocks (numbers and texts that stay), marked, keys, layout."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, trees, texts, marked, keys, layouts = [], [], [], [], [], []
            for page in batch.column("html").to_pylist():
                root, blocks = parse(page or "")
                rows = flat(root)
                hashes.append(xxhash.xxh3_64_intdigest((page or "").encode("utf-8", "surrogatepass")) - (1 << 63))
                trees.append(rows)
                layouts.append(skeleton(rows))
                texts.append(candidates(blocks))
                marked.append(marks(blocks))
                keys.append(article_keys([t for _, t in texts[-1]]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), batch.column("host"), pa.array(hashes, pa.int64()),
                 _rows(trees), pa.array([[{"number": n, "text": t} for n, t in x] for x in texts], _BLOCKS),
                 pa.array(marked, pa.bool_()), pa.array(keys, pa.list_(pa.int64())), pa.array(layouts, pa.int64())],
                names=["page_id", "url", "host", "page", "rows", "blocks", "marked", "keys", "layout"])

    host = F.lower(F.coalesce(F.regexp_extract("url", HOST, 1), F.lit("")))
    return (pages.select(F.col("page_id").cast("long"), "url", host.alias("host"), "html")
            .mapInArrow(run, f"page_id long, url string, host string, page long, rows {ROWS}, "
                             "blocks array<struct<number: int, text: string>>, marked boolean, keys array<long>, "
                             "layout long"))


def _rows(trees: list[list]) -> pa.Array:
    """Flat trees as one Arrow array."""
    nodes = [n for rows in trees for n in rows]
    items = [i for _, _, its in nodes for i in its]
    column = lambda k, kind: pa.array([i[k] for i in items], kind)
    offsets = lambda parts: pa.array([0, *accumulate(map(len, parts))], pa.int32())
    inner = pa.ListArray.from_arrays(offsets([n[2] for n in nodes]), pa.StructArray.from_arrays(
        [column(0, pa.int32()), column(1, pa.int64()), column(2, pa.bool_())], names=["number", "hash", "skip"]))
    return pa.ListArray.from_arrays(offsets(trees), pa.StructArray.from_arrays(
        [pa.array([n[0] for n in nodes], pa.int32()), pa.array([n[1] for n in nodes], pa.string()), inner],
        names=["depth", "sig", "items"]))


def aligned(pages: DataFrame) -> DataFrame:
    """host, node (its path in the reference), hash, page, page_id, number, article, marked of every text whose node is matched."""
    def tree(rows: list) -> Node:
        return unflat([(r["depth"], r["sig"], [(i["number"], i["hash"], i["skip"]) for i in r["items"]]) for r in rows])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for host, page, page_id, article, marked, rows, ref in zip(*(batch.column(c).to_pylist() for c in (
                    "host", "page", "page_id", "article", "marked", "rows", "ref"))):
                a, b, memo, found = tree(rows), tree(ref), {}, {}
                nodes = paths([(r["depth"], r["sig"], None) for r in ref])
                if match(a, b, memo):
                    mapping(a, b, memo, found)
                for order, r in enumerate(rows):
                    if order in found:
                        out += [(host, nodes[found[order]], i["hash"], page, page_id, i["number"], article, marked)
                                for i in r["items"] if not i["skip"]]
            cols = list(zip(*out)) if out else [()] * 8
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=["host", "node", "hash", "page", "page_id", "number", "article", "marked"])

    return pages.select("host", "page", "page_id", "article", "marked", "rows", "ref").mapInArrow(
        run, "host string, node long, hash long, page long, page_id long, number int, article long, marked boolean")


def with_articles(trees: DataFrame, scratch: Scratch) -> DataFrame:
    """``trees`` with ``article``: one number for all near copies of an article on a host."""
    keyed = trees.select("host", "page", F.explode("keys").alias("key")).groupBy("host", "page", "key").agg(
        F.lit(1).alias("one"))
    leaders = keyed.groupBy("host", "key").agg(F.min("page").alias("leader"))
    me = F.xxhash64("host", "page")
    edges = keyed.join(leaders, ["host", "key"]).select(me.alias("a"), F.xxhash64("host", "leader").alias("b"))
    groups = components(scratch, edges)
    return trees.join(groups, me == F.col("node"), "left").withColumn(
        "article", F.coalesce("component", me)).drop("node", "component")


def template_blocks(trees: DataFrame, scratch: Scratch) -> DataFrame:
    """page_id, page, template (numbers of the blocks that belong to the host's template), where there are any."""
    trees = trees.where(F.size("rows") > 1).select("page_id", "host", "page", "rows", "marked", "keys", "layout")
    trees = scratch.keep(with_articles(trees, scratch).drop("keys"), "trees", "zstd")
    refs = scratch.keep(trees.groupBy("host", "layout").agg(F.min_by("rows", F.struct("page_id", "page")).alias("ref")),
                        "references")
    texts = scratch.keep(aligned(trees.join(refs, ["host", "layout"])), "texts")
    at = texts.groupBy("host", "node", "article").agg(F.lit(1).alias("one")).groupBy("host", "node").agg(
        F.count(F.lit(1)).alias("articles")).where(F.col("articles") >= LEAST_PAGES)
    counts = (texts.groupBy("host", "node", "hash", "article").agg(F.lit(1).alias("one"))
              .groupBy("host", "node", "hash").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_PAGES))
    constant = scratch.keep(
        counts.join(at, ["host", "node"]).where(F.col("n") >= F.least("articles", F.col("articles") * CONSTANT + MARGIN))
        .select("host", "node", "hash"), "template")
    # a node where no page has another text is a slot of the template, also inside an article
    key = ["host", "node"]
    stood = constant.select(*key).distinct()
    varying = (texts.join(stood, key, "left_semi").join(constant, [*key, "hash"], "left_anti")
               .groupBy(*key).agg(F.lit(True).alias("varies")))
    found = texts.join(constant, [*key, "hash"]).join(varying, key, "left")
    marked = (found.where(~F.col("marked") | F.col("varies").isNull())
              .groupBy(F.col("page_id").alias("m_id"), F.col("page").alias("m_page"))
              .agg(F.collect_set("number").alias("template")))
    out = scratch.keep(marked, "marked")
    scratch.drop(trees, refs, texts, constant)
    return out


def extract(pages: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages`` (page_id, url, html)."""
    scratch = scratch or Scratch(pages.sparkSession, "html-extract")
    trees = scratch.keep(parsed(pages), "parsed", "zstd")
    marked = template_blocks(trees, scratch)
    stay = F.filter("blocks", lambda b: F.col("template").isNull() | ~F.array_contains("template", b["number"]))
    joined = trees.join(marked, F.col("page_id").eqNullSafe(F.col("m_id")) & (F.col("page") == F.col("m_page")), "left")
    text = F.array_join(F.transform(stay, lambda b: b["text"]), "\n")
    return joined.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))
