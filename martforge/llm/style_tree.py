"""Operator 10: main text of web pages by site style trees.

The DOMs of the pages of a host are merged into one tree.  An element node of
the tree is a path of tags (with classes) from the root; its styles are the
sequences of child tags seen at that path, and its content features the texts
that stand directly in it.  The importance of a node is the larger of

* presentation: the normalised entropy of its styles over the host's pages, and
* content: one minus the normalised entropy of its texts over the pages (a text
  that stands on every page says nothing, one of a single page says much),

and that of a branch the largest in it.  Branches of low importance are removed
from every page of the host.  What an element says of itself goes before the
statistics: elements, classes and ids of menus, advertisements, notices, forms or
comments have the importance 0, and the inside of an article or main element 1,
as copies of one article on many pages of a host are still articles.

Trees are gathered as counts with a map-side combine: rows are (host, node,
style) and (host, node, text) counts, so a host with a third of all pages is
spread over all tasks.  What goes back to the pages is the list of removed
branches of their host.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martforge.llm.common import importable, table, write_shared

#: Fixed values of HTML: elements without an end tag, elements whose content is
#: raw text, elements that break a line of text, and elements whose start ends
#: an open element of the given kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section "
    "summary table tbody td tfoot th thead tr ul caption option optgroup select".split()
)
ENDS = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
}
#: Elements whose start tag ends an open paragraph.
END_P = BLOCKS - frozenset(
    "body html caption tbody td tfoot th thead tr dd dt li legend option optgroup select".split()
) | {"li", "dd", "dt"}
#: Elements that bound the search for an open element to end.
SCOPE = frozenset("table td th caption html body ul ol dl button article section aside nav main div".split())

#: Elements that hold no article text, whatever a site's tree says.
NO_TEXT = frozenset(
    "head script style noscript template iframe object svg math canvas audio video nav footer aside form button "
    "select option textarea input label menu dialog title meta link".split()
)
#: Elements that hold the article.
ARTICLE = frozenset(("article", "main"))
#: Class and id words of what is no article text.
NO_TEXT_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|banners?|sponsor(?:ed)?|promos?|promotions?|"
    r"nav|navs|navigation|navbar|menus?|breadcrumbs?|sidebars?|side-?bar|footers?|headers?|masthead|site-?header|"
    r"cookies?|consent|gdpr|notices?|notifications?|alerts?|popups?|modals?|overlays?|newsletter|subscribe|signup|"
    r"comments?|replies|reply|disqus|respond|social|share|sharing|related|recommended|widgets?|toolbar|"
    r"pagination|pager|skip-?link|copyright|legal|login|search(?:box|form)?)(?=$|[\s_-])",
    re.IGNORECASE,
)

#: Pages of a host with a node below which its statistics judge nothing, weight
#: of presentation against content, and least importance.
MIN_PAGES = 12
DECAY = 0.9
MIN_IMPORTANCE = 0.2

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?>(?:[^>\"']+|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*))(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)


class Node:
    """An element of a page: where it stands in the style tree, and its role."""

    __slots__ = ("tag", "path", "drop", "keep", "children")

    def __init__(self, tag: str, parent: Node | None, attributes: str) -> None:
        self.tag, self.children = tag, []
        name = tag
        drop = tag in NO_TEXT or (tag == "header" and (parent is None or not parent.keep))
        if attributes and not attributes.isspace():
            found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
            words = " ".join(found.get(k, "") for k in ("class", "id", "role"))
            name = ".".join([tag, *found.get("class", "").split()])
            if tag not in ("html", "body", "article", "main"):
                drop = drop or bool(words.strip() and NO_TEXT_NAMES.search(words))
                drop = drop or "hidden" in found or found.get("aria-hidden", "").lower() == "true"
        self.drop = drop or (parent is not None and parent.drop)
        self.keep = not self.drop and (tag in ARTICLE or (parent is not None and parent.keep))
        self.path = f"{parent.path}/{name}" if parent else name
        if parent is not None:
            parent.children.append(name)


def walk(page: str) -> Iterator[tuple[str, Node, str]]:
    """Events of a page: ("start", node, ""), ("text", node, text), ("end", node, "").

    Any input gives a tree: end tags without a start are skipped, open elements
    end with their parent or with the page.
    """
    root = Node("", None, "")
    stack = [root]
    at, size = 0, len(page)
    yield "start", root, ""
    while at < size:
        m = _TAG.search(page, at)
        if m is None:
            yield "text", stack[-1], page[at:]
            break
        if m.start() > at:
            yield "text", stack[-1], page[at : m.start()]
        at = m.end()
        tag = m[2] and m[2].lower()
        if not tag:
            if m[0].startswith("<![CDATA["):
                yield "text", stack[-1], html.escape(m[0][9:].removesuffix("]]>"), quote=False)
            continue
        if m[1]:
            if any(n.tag == tag for n in stack[1:]):
                while True:
                    node = stack.pop()
                    yield "end", node, ""
                    if node.tag == tag:
                        break
            continue
        ended = ENDS.get(tag, ()) + (("p",) if tag in END_P else ())
        if ended:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in ended:
                    while len(stack) > k:
                        yield "end", stack.pop(), ""
                elif stack[k].tag in SCOPE:
                    break
        node = Node(tag, stack[-1], m[3])
        yield "start", node, ""
        if tag in VOID or m[3].endswith("/") and tag not in BLOCKS and tag not in RAW:
            yield "end", node, ""
        elif tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>|\Z", re.IGNORECASE).search(page, at)
            at = close.end()
            if tag not in NO_TEXT:
                yield "text", node, page[at : close.start()]
            yield "end", node, ""
        else:
            stack.append(node)
    while stack:
        yield "end", stack.pop(), ""


def main_blocks(page: str | None, removed: frozenset[str] | set[str] = frozenset()) -> list[str]:
    """Blocks of text of the page outside dropped and ``removed`` branches."""
    out: list[str] = []
    line: list[str] = []
    hidden: Node | None = None

    def end() -> None:
        if line:
            if text := " ".join(html.unescape("".join(line)).split()):
                out.append(text)
            line.clear()

    for kind, node, text in walk(page or ""):
        if kind == "text":
            if hidden is None:
                line.append(text)
        else:
            if node.tag in BLOCKS or not node.tag:
                if hidden is None:
                    end()
            elif node.tag == "br" and hidden is None:
                line.append(" ")
            if kind == "start" and hidden is None and (node.drop or node.path in removed):
                hidden = node
            elif kind == "end" and node is hidden:
                hidden = None
    end()
    return out


def page_tree(page: str | None) -> set[tuple[str, str, str]]:
    """What one page adds to the tree: (path, kind, feature).

    Kinds: "style" (the child tags of a node), "text" (a text in it), "article"
    and "dropped" (the top of a branch whose role is known; not looked into).
    """
    out: set[tuple[str, str, str]] = set()
    known: Node | None = None
    for kind, node, text in walk(page or ""):
        if kind == "start":
            if known is None and (node.drop or node.keep):
                known = node
                out.add((node.path, "dropped" if node.drop else "article", ""))
        elif kind == "end":
            if node is known:
                known = None
            elif known is None:
                out.add((node.path, "style", " ".join(node.children)))
        elif known is None and not text.isspace():
            out.add((node.path, "text", text.strip()))
    return out


def host_column(url: str = "url"):
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"://([^/?#]*)", 1)).otherwise("")
    return F.lower(F.coalesce(rest, F.lit("")))


def tree_counts(pages: DataFrame) -> DataFrame:
    """(host, path, kind, feature, n): pages of the host that have the feature
    (as a hash) at the path, from pages (host, html).  Tasks combine their own
    counts first."""
    importable(pages.sparkSession)
    names = ["host", "path", "kind", "feature", "n"]

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out() -> pa.RecordBatch:
            columns = [pa.array(c) for c in zip(*seen)]
            return pa.RecordBatch.from_arrays([*columns, pa.array(list(seen.values()), pa.int64())], names)

        for batch in batches:
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1)):
                for path, kind, feature in page_tree(page.as_py()):
                    seen[host, path, kind, zlib.crc32(feature.encode("utf-8", "surrogatepass"))] += 1
                if len(seen) > 200_000:
                    yield out()
                    seen.clear()
        if seen:
            yield out()

    counts = pages.select("host", "html").mapInArrow(gather, "host string, path string, kind string, feature long, n long")
    return counts.groupBy("host", "path", "kind", "feature").agg(F.sum("n").alias("n"))


def node_importance(counts: DataFrame) -> DataFrame:
    """(host, path, pages, importance) of the nodes of each host's tree.

    With n pages of m, a style has the share n / m; a text on n pages, spread
    evenly over them, has the entropy log(n) / log(m).
    """
    n, kind = F.col("n"), F.col("kind")
    node = counts.groupBy("host", "path").agg(
        F.sum(F.when(kind != "text", n)).alias("pages"),
        F.sum(F.when(kind == "style", n)).alias("styled"),
        F.sum(F.when(kind == "style", n * F.log(n.cast("double")))).alias("style_log"),
        F.avg(F.when(kind == "text", F.log(n.cast("double")))).alias("text_log"),
        F.max((kind == "article").cast("int")).alias("article"),
        F.max((kind == "dropped").cast("int")).alias("dropped"),
    )
    m = F.log(F.greatest(F.col("pages"), F.lit(2)).cast("double"))
    styles = (F.log(F.col("styled").cast("double")) - F.col("style_log") / F.col("styled")) / m
    presentation = F.greatest(F.coalesce(styles, F.lit(0.0)), F.lit(0.0))
    content = F.greatest(1 - F.coalesce(F.col("text_log"), m) / m, F.lit(0.0))
    importance = (
        F.when(F.col("article") == 1, 1.0)
        .when(F.col("dropped") == 1, 0.0)
        .otherwise(F.greatest(presentation * DECAY, content))
    )
    return node.select("host", "path", "pages", importance.alias("importance"), (F.col("dropped") == 1).alias("known"))


def removed_branches(pages: DataFrame) -> DataFrame:
    """(host, removed): paths of low-importance branches of each host's tree.

    The importance of a branch is the largest in it: a node hands its own to its
    ancestors, as many as it is deep.  Statistics judge a branch only if
    ``MIN_PAGES`` pages of the host have it; a role does so at once.
    """
    nodes = node_importance(tree_counts(pages))
    parts = "split(path, '/')"
    up = F.expr(f"transform(sequence(1, size({parts})), i -> array_join(slice({parts}, 1, i), '/'))")
    branch = (
        nodes.withColumn("known", F.when(F.col("known"), F.col("path")))
        .withColumn("path", F.explode(up))
        .groupBy("host", "path")
        .agg(
            F.max("importance").alias("importance"),
            F.max("pages").alias("pages"),
            F.max(F.col("known").eqNullSafe(F.col("path"))).alias("known"),
        )
    )
    low = (F.col("importance") < MIN_IMPORTANCE) & (F.col("known") | (F.col("pages") >= MIN_PAGES))
    return branch.where(low & (F.col("path") != "")).select("host", "path")


#: Rows of (host, path) up to which the lists are broadcast: a few MB.
BROADCAST_ROWS = 20_000


def extract_main_text(
    pages: DataFrame, url_column: str = "url", html_column: str = "html", text_column: str = "text"
) -> DataFrame:
    """``pages`` with the column ``text_column`` (replaced if there is one): the
    blocks of main text, joined by line feeds.

    A null html is empty and gives an empty text.  A null URL, or one without
    ``://``, belongs to the host "".  Repeated pages count as pages each.
    Character references are decoded; white space inside a block is one space.
    """
    spark = pages.sparkSession
    importable(spark)
    named = pages.withColumn("_host", host_column(url_column))
    removed = write_shared(
        removed_branches(named.select(F.col("_host").alias("host"), F.col(html_column).alias("html"))), "style-tree"
    )
    # One row per host; beyond the bound AQE splits the pages of a large host.
    lists = removed.groupBy("host").agg(F.collect_set("path").alias("_removed"))
    if removed.count() <= BROADCAST_ROWS:
        lists = F.broadcast(lists)
    joined = named.join(lists, F.col("_host") == F.col("host"), "left")
    keep = [c for c in pages.columns if c != text_column or c == html_column]
    plain = joined.select(*keep, "_removed")
    at = keep.index(html_column)
    final = [c for c in keep if c != text_column]
    schema = T.StructType([*[pages.schema[c] for c in final], T.StructField(text_column, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(len(keep)).to_pylist()
            texts = [
                "\n".join(main_blocks(page.as_py(), set(gone or ()))) for page, gone in zip(batch.column(at), lists)
            ]
            columns = [batch.column(keep.index(c)) for c in final]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], schema.names)

    return plain.mapInArrow(run, schema)


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every ``pages`` row."""
    out = extract_main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
