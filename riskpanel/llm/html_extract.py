"""Main text of web pages by site style trees.

Pages of a host are merged into one style tree: an element node is the path of
tags (with class and id) from the body, at most ``DEPTH`` levels deep, and holds
the sequences of child tags seen under it (presentation) and the hashes of its text
blocks (content). An inner node's own importance is the entropy of its child
sequences over the pages that have it, a leaf's is one minus the mean entropy
of its blocks: a block on every page says nothing, a block on one page all.
The composite importance mixes a node's own with its children's. Branches whose
importance is low are removed from each page of the host.

Some branches are noise by their presentation alone (``nav``, ``footer``, forms,
class names such as ``ad`` or ``sidebar``): their importance is 0 whatever they say.
If a page has an ``article`` or ``main``, its text is what stands in there, and
repetition alone (copies of the article on the host) removes nothing from it.

Defined results: a null or empty page has an empty text; a null or odd url is a
host of its own; repeated rows are extracted one by one but count as pages of their
own in the tree; an empty table gives an empty result; other columns play no
part, whatever their names.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskpanel.llm import texts

DEPTH = 8
LOW = 0.2  # composite importance under which a branch is noise
DAMPING = 0.9
LEAST_PAGES = 5  # a host's node is judged if that many pages have it
SMALL_TABLE = 200_000  # noise nodes that may be broadcast (16 bytes each)

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set("""address article aside blockquote body br caption center dd details dialog dir div dl
dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main
menu nav ol p pre section summary table tbody td tfoot th thead title tr ul""".split())
CLOSES_P = BLOCK - {"br", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "title", "html",
                    "body", "legend"}
#: An opening tag closes an open one of these, unless one of the bounds comes first.
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}),
            "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "option": ({"option"}, set()),
            "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
            "tbody": ({"tbody", "thead"}, {"table"}), "tfoot": ({"tbody", "thead"}, {"table"})}
P_BOUNDS = {"table", "td", "th", "caption", "button", "object", "html"}
MAIN = {"article", "main"}
NOISE_TAGS = {"nav", "footer", "aside", "form", "menu", "dialog"}
NOISE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert",
               "dialog", "menu", "menubar", "alertdialog"}
NOISE_NAMES = set("""ad ads advert adverts advertisement adsbygoogle sponsor sponsored promo banner
nav navbar navigation menu breadcrumb breadcrumbs masthead footer sidebar widget cookie cookies
consent notice gdpr popup modal newsletter subscribe share sharing social comment comments disqus
replies respond related pagination pager toolbar copyright disclaimer""".split())

#: In a name with one of these, the other pieces tell a state of the element.
STATES = {"has", "no", "not", "with", "without", "is", "enabled", "disabled"}

ATTRIBUTES = r"""(?:[^>"']|"[^"]*"|'[^']*')*+"""
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>script|style|textarea|title|noscript|template|svg|iframe|select|button|object)\b"
    rf"{ATTRIBUTES}>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*>"
    rf"|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*+)(?P<rest>{ATTRIBUTES})>"
    r"|<(?P<end2>/?)(?P<tag2>[A-Za-z][^\s/>]*+)(?P<rest2>[^>]*+)>", re.S | re.I)
ATTRIBUTE = re.compile(r"""([a-z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)"


class Node:
    __slots__ = ("tag", "path", "depth", "noise", "main", "children")

    def __init__(self, tag: str, path: int, depth: int, noise: bool, main: bool):
        self.tag, self.path, self.depth = tag, path, depth
        self.noise, self.main, self.children = noise, main, []


def _hash(text: str, seed: int = 0) -> int:
    return xxhash.xxh3_64_intdigest(text, seed & 0x7FFFFFFF) - (1 << 63)


def _hidden(rest: str, found: dict[str, str]) -> bool:
    """Whether there is an attribute of that name, with a value or bare."""
    if "hidden" not in rest.lower():
        return False
    bare = ATTRIBUTE.sub(" ", rest).lower().replace("/", " ").split()
    return "hidden" in bare or found.get("hidden", "until-found") != "until-found"


def _open(tag: str, rest: str, parent: Node) -> Node:
    found = {}
    if "=" in rest:
        for name, *values in ATTRIBUTE.findall(rest):
            found.setdefault(name.lower(), next(filter(None, values), "").lower())
    named = found.get("class", "") + " " + found.get("id", "")
    names = set()
    for token in named.split():  # "has-sidebar" says what is around an element
        pieces = re.split(r"[^a-z0-9]+", token)
        if not STATES.intersection(pieces):
            names.update(pieces)
    noise = (parent.noise or tag in NOISE_TAGS or bool(names & NOISE_NAMES)
             or found.get("role") in NOISE_ROLES or "display:none" in found.get("style", "").replace(" ", "")
             or _hidden(rest, found)
             or (not parent.main and (tag == "header" or "header" in names)))
    signature = f"{tag}.{named.strip()}"
    parent.children.append(signature)
    if parent.depth >= DEPTH:
        path = parent.path
    else:
        path = _hash(f"{parent.path}/{signature}")
    return Node(tag, path, parent.depth + 1, noise, parent.main or tag in MAIN
                or found.get("role") == "main")


def _tail_as_text(page: str) -> str:
    """The page with what looks like a tag behind the last end of one made plain, so that it
    is not tried as a tag again and again."""
    last = page.rfind(">") + 1
    tail, comment, rest = page[last:].partition("<!--")
    return page[:last] + tail.replace("<", "&lt;") + comment + rest if "<" in tail else page


def walked(page: str) -> tuple[list[tuple[str, list[Node]]], list[tuple[Node, Node]]]:
    """Text blocks with the open elements around them, and the elements with their parents."""
    root = Node("", 0, 0, False, False)
    stack, blocks, elements, pieces, at = [root], [], [], [], 0

    def flush():
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                blocks.append((text, list(stack)))

    def close(wanted: set[str], bounds: set[str]):
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in wanted:
                flush()
                del stack[i:]
                return
            if stack[i].tag in bounds:
                return

    page = _tail_as_text(page)
    for token in TOKEN.finditer(page):
        if token.start() > at:
            pieces.append(page[at:token.start()])
        at = token.end()
        tag = token["tag"] or token["tag2"]
        if tag is None:
            continue
        tag = tag.lower()
        if token["end"] or token["end2"]:
            if tag in BLOCK:
                if tag in ("p", "br"):
                    flush()
                close({tag}, set() if tag not in ("p", "li", "td") else
                      {"table"} if tag == "td" else P_BOUNDS)
            else:
                close_inline(stack, tag)
            continue
        rest = token["rest"] or token["rest2"] or ""
        if tag in BLOCK:
            flush()
        if tag in CLOSES_P:
            close({"p"}, P_BOUNDS)
        if tag in SIBLINGS:
            close(*SIBLINGS[tag])
        if tag in VOID or tag in ("html", "body", "head"):
            continue
        node = _open(tag, rest, stack[-1])
        elements.append((node, stack[-1]))
        if not rest.endswith("/"):
            stack.append(node)
    pieces.append(page[at:])
    flush()
    return blocks, elements


def close_inline(stack: list[Node], tag: str) -> None:
    """Closes an inline element unless a block was opened in it."""
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag == tag:
            del stack[i:]
            return
        if stack[i].tag in BLOCK:
            return


def _block_element(around: list[Node]) -> Node:
    """The element whose content a block is: the innermost that is not inline."""
    return next((n for n in reversed(around) if n.tag in BLOCK), around[0])


def _observed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, node, parent, depth, kind, feature, pages) of a part: kind 0 is the node
    itself, 1 a sequence of child tags, 2 a text block."""
    for rows, _, _ in texts.parts(batches, "html"):
        seen: Counter = Counter()
        for host, page in zip(rows.column("host").to_pylist(), rows.column("html").to_pylist()):
            if not page:
                continue
            blocks, elements = walked(page)
            own = set()
            for node, parent in elements:
                if node.depth <= DEPTH and node.tag in BLOCK and not node.noise:
                    place = host, node.path, parent.path, node.depth
                    own.add((*place, 0, 0))
                    own.add((*place, 1, _hash("|".join(node.children))))
            up = {node.path: (parent.path, node.depth) for node, parent in elements
                  if node.depth <= DEPTH}
            for text, around in blocks:
                node = _block_element(around)
                if node.path in up and not node.noise:
                    own.add((host, node.path, *up[node.path], 2, _hash(text)))
            seen.update(own)
        columns = list(zip(*seen)) if seen else [()] * 6
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(c, k) for c, k in zip(columns, kinds)),
             pa.array(seen.values(), pa.int64())],
            names=["host", "node", "parent", "depth", "kind", "feature", "pages"])


def style_tree(pages: DataFrame) -> DataFrame:
    """host, node, pages and importance of every node of the hosts' style trees."""
    texts.workers_find_package(pages.sparkSession)
    observed = (pages.select(_host(pages).alias("host"), "html")
                .mapInArrow(_observed, "host string, node bigint, parent bigint, depth int, "
                                       "kind int, feature bigint, pages bigint")
                .groupBy("host", "node", "parent", "depth", "kind", "feature")
                .agg(F.sum("pages").alias("pages")))
    is_kind = {k: F.col("kind") == k for k in (0, 1, 2)}
    n, log = F.col("pages"), F.log(F.col("pages"))
    nodes = texts.stored(observed.groupBy("host", "node", "parent", "depth").agg(
        F.sum(F.when(is_kind[0], n)).alias("m"),
        F.count_if(is_kind[1]).alias("styles"),
        # sum of -p log p with p = n / m, less the logarithm of m
        F.sum(F.when(is_kind[1], n * log)).alias("style_logs"),
        F.sum(F.when(is_kind[2], n * log)).alias("block_logs"),
        F.sum(F.when(is_kind[2], n)).alias("blocks")))
    m = F.coalesce("m", F.lit(1))
    base = F.log(m)
    presentation = F.when(m > 1, 1 - F.col("style_logs") / m / base).otherwise(1.0)
    content = F.when((m > 1) & (F.col("blocks") > 0),
                     1 - F.least(F.col("block_logs") / F.col("blocks") / base, F.lit(1.0))
                     ).otherwise(F.when(m > 1, F.lit(None)).otherwise(1.0))
    # a node with text of its own counts as a leaf for it
    nodes = nodes.select(
        "host", "node", "parent", "depth", m.alias("pages"),
        F.coalesce(content, presentation).alias("own"),
        F.when(F.col("blocks") > 0, 0.0).otherwise(
            F.pow(F.lit(DAMPING), F.col("styles"))).alias("weight"))
    below, out = None, None
    for depth in range(DEPTH, 0, -1):
        level = nodes.where(F.col("depth") == depth)
        if below is None:
            level = level.withColumn("importance", F.col("own"))
        else:
            inner = below.groupBy(F.col("host").alias("h"), F.col("parent").alias("p")).agg(
                F.avg("importance").alias("inner"))
            level = level.join(inner, level["host"].eqNullSafe(F.col("h"))
                               & (level["node"] == F.col("p")), "left").withColumn(
                "importance", (1 - F.col("weight")) * F.col("own")
                + F.col("weight") * F.coalesce("inner", "own")).drop("h", "p", "inner")
        below = level
        out = level if out is None else out.unionByName(level)
    return out.select("host", "node", "pages", "importance")


def _host(pages: DataFrame) -> F.Column:
    return F.lower(F.regexp_extract(F.coalesce(pages["url"], F.lit("")), HOST, 1))


def main_text(page: str | None, noise: set[int]) -> str:
    """The page's text without noise branches, one block a line."""
    if not page:
        return ""
    blocks, _ = walked(page)
    good = [(t, any(n.main for n in around)) for t, around in blocks if not around[-1].noise]
    if any(main for _, main in good):
        return "\n".join(t for t, main in good if main)
    return "\n".join(t for t, around in blocks if not around[-1].noise
                     and not any(n.path in noise for n in around[1:]))


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, _, _ in texts.parts(batches, "html"):
        out = [main_text(page, set(noise or ())) for page, noise in
               zip(rows.column("html").to_pylist(), rows.column("noise").to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [rows.column("page_id"), rows.column("url"), pa.array(out, pa.string()),
             pa.array([len(t) for t in out], pa.int64())],
            names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    texts.workers_find_package(pages.sparkSession)
    noise = texts.stored(
        style_tree(pages).where((F.col("importance") < LOW) & (F.col("pages") >= LEAST_PAGES))
        .groupBy(F.col("host").alias("noisy")).agg(F.collect_set("node").alias("noise")))
    small = (noise.agg(F.sum(F.size("noise"))).first()[0] or 0) <= SMALL_TABLE
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    return (pages.select("page_id", "url", "html", _host(pages).alias("host"))
            .join(F.broadcast(noise) if small else noise, F.col("host") == F.col("noisy"), "left")
            .select("page_id", "url", "html", "noise")
            .mapInArrow(_extracted, f"page_id {kinds['page_id']}, url {kinds['url']}, "
                                    "text string, n_chars bigint"))


def report_sql() -> str:
    """DuckDB SQL for ``extract`` on pages that all have one article without noise in it."""
    text = r"regexp_replace(b, '<[^>]*>', '', 'g')"
    for name, letter in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "''"), ("#x27", "''"),
                         ("nbsp", " "), ("middot", "·"), ("copy", "©"), ("amp", "&")):
        text = f"replace({text}, '&{name};', '{letter}')"
    return rf"""
WITH b AS (
  SELECT row_number() OVER () AS r, page_id, url, string_split_regex(regexp_extract(
    coalesce(html, ''), '(?s)<article[^>]*>(.*)</article>', 1),
    '</?(p|h[1-6]|br|div|ul|ol|li|table|tr|td|th|blockquote|pre|section)( [^>]*)?/?>') AS bs
  FROM pages),
t AS (
  SELECT r, page_id, url, array_to_string(list_filter(list_transform(bs,
    lambda b: trim(regexp_replace({text}, '\s+', ' ', 'g'))), lambda b: b <> ''), chr(10)) AS text
  FROM b)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM t
"""
