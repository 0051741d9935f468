"""Main text of web pages by removing site templates.

Every element subtree is hashed over its tags and text. Spark counts on how many pages of a
host each hash stands; subtrees that recur on many of them are template and are deleted, besides
the parts that their tag, role or name marks as menus, adverts, comments and the like.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from linkrisk.session import write_scratch

#: A subtree is template from so many pages of a host on that make up this share of the host's pages.
MIN_PAGES, MIN_SHARE = 5, 0.5
#: Whatever the share, a subtree of so many characters is template from so many different pages on, and inside articles from so many different articles on.
MIN_CHARS, MANY_PAGES, MANY_ARTICLES = 40, 10, 50

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody "
    "td tfoot th thead tr ul".split()
)
DROPPED = frozenset(
    "head title nav menu aside footer form script style noscript template iframe object embed applet svg math canvas audio video "
    "button select input textarea datalist dialog search map frameset noframes noembed xmp".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alertdialog alert toolbar".split())
#: Words in class and id names that mark a part wherever it stands, and those that do so outside an article only.
NAMES = frozenset(
    "nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars aside ad ads adv advert adverts advertisement advertising sponsor "
    "sponsored promo promotion cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription "
    "signup login comment comments commentlist disqus respond replies share sharing social related recommended pagination pager "
    "footer widget widgets toolbar skip paywall".split()
)
OUTSIDE = frozenset("header masthead banner topbar top bottom copyright legal".split())
#: A start tag of the key ends an open element of these names, up to the nearest of the stops.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
ENDS_P = BLOCK - {"body", "html", "option", "optgroup", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "legend"}

TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>",
    re.S,
)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


class Node:
    __slots__ = ("tag", "attrs", "parent", "content", "hash")

    def __init__(self, tag: str, attrs: str, parent: "Node | None") -> None:
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.content: list[Node | str] = []
        self.hash = 0


def parse(page: str) -> list[Node]:
    """The elements of a page in document order, the first a root around all; unclosed ones end with their parent."""
    root = Node("#root", "", None)
    nodes, here, at = [root], root, 0
    while True:
        found = TOKEN.search(page, at)
        if found is None:
            break
        if found.start() > at:
            here.content.append(html.unescape(page[at : found.start()]))
        at = found.end()
        if found["tag"] is None:
            if found[0].startswith("<![CDATA["):
                here.content.append(found[0][9:].removesuffix("]]>"))
            continue
        tag = found["tag"].lower()
        if found["end"]:
            up = here
            while up is not root and up.tag != tag:
                up = up.parent
            if up is not root:
                here = up.parent
            continue
        if tag in ENDS_P:
            up = here
            while up is not root and up.tag != "p" and up.tag not in BLOCK:
                up = up.parent
            if up.tag == "p":
                here = up.parent
        if tag in CLOSES:
            ended, stops = CLOSES[tag]
            up, last = here, None
            while up is not root and up.tag not in stops:
                last = up if up.tag in ended else last
                up = up.parent
            here = last.parent if last is not None else here
        node = Node(tag, found["attrs"], here)
        here.content.append(node)
        nodes.append(node)
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            node.content.append(page[at : close.start() if close else len(page)])
            at = close.end() if close else len(page)
        elif tag not in VOID and not found["attrs"].endswith("/"):
            here = node
        elif tag not in VOID and tag in BLOCK:
            here = node  # a slash does not close these
    if at < len(page):
        here.content.append(html.unescape(page[at:]))
    return nodes


def hash_subtrees(nodes: list[Node]) -> None:
    """A signed 64-bit hash of each subtree: tags and white-space free text, attributes left out."""
    for node in reversed(nodes):
        parts = [node.tag]
        for c in node.content:
            parts.append(f"<{c.hash}>" if isinstance(c, Node) else " ".join(c.split()))
        value = xxhash.xxh64_intdigest("\0".join(p for p in parts if p), 0)
        node.hash = value - (1 << 64) if value >> 63 else value


def _has_text(node: Node) -> bool:
    return any(not isinstance(c, Node) and c.strip() for c in node.content)


def _named(node: Node, inside: bool) -> bool:
    if node.tag in DROPPED:
        return True
    if node.tag == "header" and not inside:
        return True
    if not node.attrs:
        return False
    for name, *values in ATTRIBUTE.findall(node.attrs):
        value = next((v for v in values if v), "").lower()
        words = set(re.split(r"[^a-z0-9]+", value))
        if name.lower() == "role":
            if words & ROLES and not (inside and words <= {"banner"}):
                return True
        elif words & NAMES or (not inside and words & OUTSIDE):
            return True
    return False


def subtrees(nodes: list[Node]) -> dict[int, tuple[int, bool]]:
    """For each subtree hash of a hashed page the hash of what it stands in, and whether that is an article.

    This is the outermost article (the main element if there is no article), else the page. Texts under ``MIN_CHARS`` stand in 0.
    """
    length = {id(n): 0 for n in nodes}
    for node in reversed(nodes):
        length[id(node)] += sum(len(" ".join(c.split())) for c in node.content if not isinstance(c, Node))
        if node.parent is not None:
            length[id(node.parent)] += length[id(node)]
    any_article = any(n.tag == "article" and not _named(n, True) for n in nodes)
    around: dict[int, Node | None] = {id(nodes[0]): None}
    own: dict[int, tuple[int, bool]] = {}
    for node in nodes[1:]:
        within = around[id(node.parent)]
        around[id(node)] = within or (node if node.tag == "article" or (not any_article and _is_main(node)) else None)
        if node.tag not in RAW and node.tag not in VOID:
            long = length[id(node)] >= MIN_CHARS
            if node.hash not in own or within is not None:
                own[node.hash] = ((within or nodes[0]).hash if long else 0, within is not None)
    return own


def _is_main(node: Node) -> bool:
    return node.tag in ("article", "main") or bool(re.search(r"\brole\s*=\s*[\"']?(?:main|article)\b", node.attrs, re.I))


def extract(nodes: list[Node], template: frozenset[int]) -> str:
    """The main text: blocks joined by two line ends.

    All that is neither named nor template belongs to it, inside an article or main element and
    outside. What holds an article or main element is never deleted for its name or hash.
    """
    holds: set[int] = set()
    for node in nodes:
        if _is_main(node):
            up = node
            while up is not None and id(up) not in holds:
                holds.add(id(up))
                up = up.parent
    any_article = any(n.tag == "article" and not _named(n, True) for n in nodes)
    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = " ".join("".join(line).split())
        if text:
            blocks.append(text)
        line.clear()

    # (node, inside an article or main) or, to leave a block, None
    stack: list[tuple[Node | str | None, bool]] = [(nodes[0], False)]
    while stack:
        node, inside = stack.pop()
        if node is None:
            flush()
            continue
        if isinstance(node, str):
            line.append(node)
            continue
        main = node.tag == "article" or (not any_article and _is_main(node))
        keep = id(node) in holds and not (main and _named(node, True))
        if not keep and node.tag != "#root" and (_named(node, inside or main) or node.hash in template):
            continue
        if node.tag == "br":
            line.append(" ")
        block = node.tag in BLOCK
        if block:
            flush()
            stack.append((None, inside))
        inside = inside or main
        stack.extend((c, inside) for c in reversed(node.content))
    flush()
    return "\n\n".join(blocks)


HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def template_hashes(rows: DataFrame) -> DataFrame:
    """``host, hash`` of subtrees on at least ``MIN_PAGES`` pages and ``MIN_SHARE`` of the pages of a host, or in many different pages or articles of it.

    ``rows`` has each hash once a page with what ``subtrees`` says of it (``around, inside``), and hash 0 once for the page itself.
    Copies of a page or an article count once in the second rule, so an article that is served under many addresses stays.
    """
    counts = rows.groupBy("host", "hash").count().where(F.col("count") >= MIN_PAGES)
    counts = write_scratch(counts, "template-counts")
    pages = counts.where("hash = 0").select(F.col("host").alias("h"), F.col("count").alias("pages"))
    share = counts.where("hash <> 0").join(pages, F.col("host") == F.col("h")).where(F.col("count") >= MIN_SHARE * F.col("pages")).select("host", "hash")
    often = counts.where((F.col("hash") != 0) & (F.col("count") >= MANY_PAGES)).select("host", "hash")
    places = rows.where("around <> 0").join(often, ["host", "hash"], "left_semi").select("host", "hash", "inside", "around").distinct()
    many = places.groupBy("host", "hash").agg(F.count_if(~F.col("inside")).alias("pages"), F.count_if("inside").alias("articles"))
    many = many.where((F.col("pages") >= MANY_PAGES) | (F.col("articles") >= MANY_ARTICLES)).select("host", "hash")
    return share.union(many).distinct()


def main_text(pages: DataFrame, page: str = "html", url: str = "url", key: str = "page_id") -> DataFrame:
    """``key, url, text, n_chars`` of every page.

    A null page is empty and has empty text; pages without a host in the URL (or without a URL) form one
    host. Equal rows give equal rows. Pages move once, by a hash of
    the whole row, to meet the templates found on them; a page is a task of its own size,
    hosts are only counted. Other columns are not read.
    """
    host = F.lower(F.coalesce(F.regexp_extract(F.col(url), HOST, 1), F.lit("")))
    body = F.coalesce(F.col(page), F.lit(""))
    rows = pages.select(
        F.col(key).alias("key"), F.col(url).alias("url"), body.alias("page"), host.alias("host"),
        F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit("")), F.coalesce(F.col(url), F.lit("")), body).alias("row"),
    )

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hosts, found, around, inside = [], [], [], [], []
            for row, name, text in zip(*[c.to_pylist() for c in batch.columns]):
                nodes = parse(text)
                hash_subtrees(nodes)
                own = {0: (0, False)} | subtrees(nodes)
                ids.extend([row] * len(own))
                hosts.extend([name] * len(own))
                found.extend(own)
                around.extend(a for a, _ in own.values())
                inside.extend(i for _, i in own.values())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(hosts, pa.string()), pa.array(found, pa.int64()), pa.array(around, pa.int64()), pa.array(inside, pa.bool_())],
                names=["row", "host", "hash", "around", "inside"],
            )

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, template in zip(batch.column("page").to_pylist(), batch.column("template").to_pylist()):
                nodes = parse(text)
                hash_subtrees(nodes)
                out.append(extract(nodes, frozenset(template or ())))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("url"), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
                names=["key", "url", "text", "n_chars"],
            )

    seen = write_scratch(rows.select("row", "host", "page").mapInArrow(hashes, "row long, host string, hash long, around long, inside boolean"), "template-subtrees")
    template = write_scratch(template_hashes(seen).select(F.col("host").alias("h"), F.col("hash").alias("x")), "template-hashes")
    marked = seen.join(template, (F.col("host") == F.col("h")) & (F.col("hash") == F.col("x")))
    marked = write_scratch(marked.groupBy("row").agg(F.collect_set("hash").alias("template")).withColumnRenamed("row", "r"), "template-marked")
    kind = pages.schema[key].dataType.simpleString()
    found = rows.join(marked, F.col("row") == F.col("r"), "left").select("key", "url", "page", "template").mapInArrow(texts, f"key {kind}, url string, text string, n_chars long")
    return found.select(F.col("key").alias(key), F.col("url").alias(url), "text", "n_chars")
