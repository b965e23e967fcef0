"""Main text of web pages by site template removal.

Every page is parsed once into its element tree.  Each block-level subtree is hashed (tag and contents up the
tree, without attributes, so that links that vary don't matter), the hashes are counted per host over distinct
articles, and a subtree that occurs with ``min_pages`` articles of its host and with ``min_share`` of them is deleted
with all it holds, inside article and main elements too: an ordinary line recurs on a large host, a template on much of it.  Pages of equal main text are one article, and so are near copies: pages whose main
texts share seven tenths of their three-word strings, found by bands of a min-hash sketch and linked to groups.  So
a passage that recurs because its article was copied stays, and one that recurs in different articles goes.

What a single page tells goes without counting: scripts, styles and other unseen elements, elements whose tag,
role, class or id names a menu, header, footer, sidebar, notice, advert, form or comments, and, where a page has
an article (or else a main) element, everything outside it.  A compound class or id such as ``has-sidebar`` may also
describe a layout: where it stands around an article or main element that holds more text than is left without it, or
around all of a page, it doesn't name.  Text of one block has its white space folded; blocks
are joined in page order by an empty line.

Scale: subtrees are counted with a combine before the shuffle, so a template on every page of a hot host is one
row per task.  Hashes and sketches are written; the pages are parsed again for their texts, which are shuffled once,
to meet their deleted subtrees.  A near copy is compared with one page of each band, never with its whole group.

Defined cases: a null html is an empty page, a null url's host is the empty host; a page without text gets the
empty string; repeated rows count as one page and each get a row; further columns are ignored; an empty table
gives no rows.  Text that stands in an article outside any block element has no subtree of its own and stays.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealflow.llm.common import components, stage
from dealflow.operators.lookup import lookup

MIN_PAGES = 5
MIN_SHARE = 0.2
BANDS, BAND_ROWS = 8, 6
NEAR = 0.7

INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style noscript template iframe object svg canvas head title textarea select button option "
                   "audio video map datalist".split())
RAW = frozenset("script style textarea title iframe noscript".split())
BOILERPLATE = frozenset("nav footer aside form menu dialog".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
#: Words of class and id that name what is not the article.
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notification alert popup modal overlay newsletter subscribe subscription paywall sidebar rail menu nav navbar "
    "navigation breadcrumb breadcrumbs topbar masthead footer comment comments reply replies respond disqus share sharing "
    "social related recommended recommendations widget toolbar pagination pager login signup search skip hidden".split())
WHOLE = frozenset("html body article main".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer "
                     "form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul li".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
            "th": ("td", "th"), "option": ("option",)}

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
                   r"""|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
WORDS = re.compile(r"[a-z0-9]+")

Block = tuple[str, int, int, list[int]]       # text, rank of its region, LAYOUT, BOILER or 0, subtrees that hold it
LAYOUT, BOILER = 1, 2                         # named by a compound word around the article; named otherwise


class _Node:
    __slots__ = ("tag", "hash", "named", "region", "number", "unseen")

    def __init__(self, tag: str, parent: "_Node | None", named: int, number: int):
        self.tag, self.number, self.hash = tag, number, xxhash.xxh64(tag)
        self.named = max(named, parent.named if parent else 0)
        region = 2 if tag == "article" else 1 if tag == "main" else 0
        self.region = max(region, parent.region if parent else 0)


def _named(tag: str, attributes: str, region: int) -> int:
    if tag in BOILERPLATE or tag in UNSEEN or (tag == "header" and not region):
        return BOILER
    if not attributes or tag in WHOLE:
        return 0
    found = 0
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if (name == "hidden" and not value.startswith("until")) or (name == "role" and value in ROLES):
            return BOILER
        if name in ("class", "id"):
            for token in value.split():
                parts = WORDS.findall(token)
                if not NAMES.isdisjoint(parts):
                    found = max(found, BOILER if region == 2 or NAMES.issuperset(parts) else LAYOUT)
    return found


def parse(html: str) -> tuple[list[Block], list[int]]:
    """Blocks in page order, and the hashes of all subtrees that template removal may delete."""
    root = _Node("#page", None, 0, -1)
    stack, found = [root], []
    subtree: list[int | None] = []                           # by node number, filled when the node ends
    blocks: list[tuple] = []
    buffer: list[str] = []

    def flush() -> None:
        if buffer:
            text = " ".join(unescape("".join(buffer)).split())
            buffer.clear()
            if text:
                node = stack[-1]
                node.hash.update(b"\x01" + text.encode("utf-8", "surrogatepass"))
                owners = [n.number for n in stack[1:] if n.tag not in WHOLE]
                blocks.append((text, node.region, node.named, owners))

    def end() -> None:
        node = stack.pop()
        digest = node.hash.intdigest()
        stack[-1].hash.update(b"\x02" + node.hash.digest())
        subtree[node.number] = digest - (1 << 64) if digest >> 63 else digest
        if node.tag not in WHOLE:
            found.append(subtree[node.number])

    at, lower = 0, None
    while True:
        m = TOKEN.search(html, at)
        if m is None:
            buffer.append(html[at:])
            break
        if m.start() > at:
            buffer.append(html[at:m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag, attributes, closing = tag.lower(), m[3] or m[6] or "", m[1] or m[4]
        if closing:
            if tag in INLINE and not any(n.tag == tag for n in stack):
                continue
            if any(n.tag == tag for n in stack[1:]):
                flush()
                while stack[-1].tag != tag:
                    end()
                end()
            continue
        if tag in RAW:
            if lower is None:
                lower = html.lower()
                if len(lower) != len(html):                   # a letter whose lower case is longer
                    lower = html
            close = lower.find("</" + tag, at)
            at = len(html) if close < 0 else (html.find(">", close) + 1 or len(html))
            continue
        if tag in INLINE:
            if tag == "br":
                buffer.append(" ")
            if tag in VOID or not attributes or not _named(tag, attributes, stack[-1].region):
                continue
        flush()
        if tag in VOID:
            continue
        if tag in CLOSES_P and any(n.tag == "p" for n in stack):
            while stack[-1].tag != "p":
                end()
            end()
        while stack[-1].tag in SIBLINGS.get(tag, ()):
            end()
        named = _named(tag, attributes, stack[-1].region)
        stack.append(_Node(tag, stack[-1], named, len(subtree)))
        subtree.append(None)
    flush()
    while len(stack) > 1:
        end()
    return [(t, r, n, [subtree[i] for i in o]) for t, r, n, o in blocks], found


def _main(blocks: list[Block]) -> list[Block]:
    """Blocks of the innermost kind of region that has text: articles, else main, else the page."""
    def innermost(some: list[Block]) -> tuple[int, list[Block]]:
        best = max((b[1] for b in some), default=0)
        return best, [b for b in some if b[1] == best]

    rank, plain = innermost([b for b in blocks if not b[2]])
    inner, wrapped = innermost([b for b in blocks if b[2] == LAYOUT])
    longer = sum(len(b[0]) for b in wrapped) > sum(len(b[0]) for b in plain)
    return wrapped if not plain or (inner > rank and longer) else plain


_draw = np.random.default_rng(17)
MIX = _draw.integers(1, 1 << 63, 3, dtype=np.uint64) | np.uint64(1)
HASHES = _draw.integers(1, 1 << 63, BANDS * BAND_ROWS, dtype=np.uint64) | np.uint64(1)


def sketch(text: str) -> list[int]:
    """Min-hashes of a text's three-word strings (of a shorter text: of all its words); a text without words has none."""
    h = np.fromiter((xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in text.split()), np.uint64)
    if not len(h):
        return []
    if len(h) < 3:
        h = np.concatenate([h, h[-1:], h[-1:]])[:3]
    three = h[:-2] * MIX[0] + h[1:-1] * MIX[1] + h[2:] * MIX[2]
    three ^= three >> np.uint64(29)
    low = np.full(len(HASHES), (1 << 32) - 1, np.uint64)
    for a in range(0, len(three), 4096):
        low = np.minimum(low, ((three[a:a + 4096, None] * HASHES) >> np.uint64(32)).min(axis=0))
    return low.astype(np.uint32).view(np.int32).tolist()


def _pages(pages: DataFrame, url_col: str, html_col: str, id_col: str) -> DataFrame:
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url_col), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)),
                      F.lit(""))
    return pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                        F.xxhash64(id_col, url_col, html_col).alias("key"), host.alias("host"),
                        F.col(html_col).alias("html"))


def _mapped(rows: DataFrame, kept: list[str], new: list[tuple], of_page) -> DataFrame:
    """Columns ``kept`` of ``rows``, and the columns ``new`` (name, Spark type, Arrow type) that ``of_page(html)`` gives."""
    schema = T.StructType([rows.schema[c] for c in kept] + [T.StructField(n, t) for n, t, _ in new])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 1024):
                b = whole.slice(a, 1024)
                found = [of_page(html or "") for html in b.column(len(kept)).to_pylist()]
                cols = list(zip(*found)) or [()] * len(new)
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[:len(kept)], *(pa.array(c, kind) for c, (_, _, kind) in zip(cols, new))], names=schema.names)

    return rows.select(*kept, "html").mapInArrow(run, schema)


def parsed(pages: DataFrame, url_col: str = "url", html_col: str = "html", id_col: str = "page_id") -> DataFrame:
    """``(key, host, content, sketch, owners, subtrees)``: hash and sketch of the main region's text, the subtrees that
    hold its blocks, and all subtrees of the page."""
    def of_page(html: str) -> tuple:
        own, found = parse(html)
        main = _main(own)
        text = "\n".join(b[0] for b in main)
        content = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))
        return (content - (1 << 64) if content >> 63 else content, sketch(text),
                list({o for b in main for o in b[3]}), list(set(found)))

    longs, ints = (T.ArrayType(T.LongType()), pa.list_(pa.int64())), (T.ArrayType(T.IntegerType()), pa.list_(pa.int32()))
    return _mapped(_pages(pages, url_col, html_col, id_col), ["key", "host"],
                   [("content", T.LongType(), pa.int64()), ("sketch", *ints), ("owners", *longs), ("subtrees", *longs)], of_page)


def articles(trees: DataFrame) -> DataFrame:
    """``(node, root)``: main texts (host and content as one hash) that are near copies, and their group's smallest."""
    node = F.xxhash64("host", "content")
    each = stage(trees.where(F.size("sketch") > 0).groupBy(node.alias("node"), "host").agg(F.first("sketch").alias("sketch")),
                 "page-sketches")
    bands = F.array(*(F.xxhash64("host", F.lit(i), F.slice("sketch", 1 + i * BAND_ROWS, BAND_ROWS)) for i in range(BANDS)))
    banded = each.select("node", F.explode(bands).alias("band"))
    leaders = stage(banded.groupBy("band").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1")
                    .select("band", "leader"), "band-leaders")
    pairs = banded.join(leaders, "band").where("node <> leader").select("node", "leader").distinct()
    other = each.select(F.col("node").alias("leader"), F.col("sketch").alias("other"))
    same = F.size(F.filter(F.zip_with("sketch", "other", lambda a, b: a == b), lambda x: x))
    near = pairs.join(each.select("node", "sketch"), "node").join(other, "leader").where(same >= NEAR * BANDS * BAND_ROWS)
    return components(near.select(F.col("node").alias("u"), F.col("leader").alias("v")))


def templates(trees: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """``(host, subtree, n_pages, n_articles)`` of the subtrees with ``min_pages`` distinct articles of a host or more
    that are ``min_share`` of the host's articles or more."""
    pages = trees.select("host", "key", F.xxhash64("host", "content").alias("node"), "subtrees").dropDuplicates(["host", "key"])
    pages = pages.join(articles(trees), "node", "left").withColumn("article", F.coalesce("root", "node"))
    hosts = (pages.groupBy("host", "article").agg(F.count(F.lit(1)).alias("n")).groupBy(F.col("host").alias("whole"))
             .agg(F.count(F.lit(1)).alias("host_articles")))
    each = pages.select("host", "article", F.explode("subtrees").alias("subtree"))
    each = each.groupBy("host", "subtree", "article").agg(F.count(F.lit(1)).alias("n"))
    often = each.groupBy("host", "subtree").agg(F.sum("n").alias("n_pages"), F.count(F.lit(1)).alias("n_articles"))
    often = lookup(often.where(F.col("n_articles") >= min_pages), hosts, [(F.col("host"), "whole")], "subtree", salts=16)
    return often.where(F.col("n_articles") >= min_share * F.col("host_articles")).drop("host_articles")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every row of ``pages``."""
    trees = stage(parsed(pages, url_col, html_col, id_col), "page-trees")
    common = stage(templates(trees, min_pages, min_share).select("host", "subtree"), "page-templates")
    owners = trees.dropDuplicates(["key"]).select("key", "host", F.explode("owners").alias("subtree"))
    dead = owners.join(common, ["host", "subtree"], "left_semi").groupBy("key").agg(F.collect_set("subtree").alias("dead"))

    def of_page(html: str) -> tuple:
        return ([{"text": t, "owners": o} for t, _, _, o in _main(parse(html)[0])],)

    block = T.StructType([T.StructField("text", T.StringType()), T.StructField("owners", T.ArrayType(T.LongType()))])
    kind = pa.list_(pa.struct([("text", pa.string()), ("owners", pa.list_(pa.int64()))]))
    blocks = _mapped(_pages(pages, url_col, html_col, id_col), ["page_id", "url", "key"],
                     [("blocks", T.ArrayType(block), kind)], of_page)
    cleaned = blocks.join(stage(dead, "page-dead"), "key", "left").withColumn(
        "blocks", F.when(F.col("dead").isNull(), F.col("blocks")).otherwise(
            F.filter("blocks", lambda b: ~F.arrays_overlap(b["owners"], F.col("dead")))))
    text = F.array_join(F.col("blocks.text"), "\n\n")
    return cleaned.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))
