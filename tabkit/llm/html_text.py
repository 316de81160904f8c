"""Main text of web pages by wrapper induction.

Pages are dealt by host: a range partitioning by (host, hash of the page)
keeps a small host in one task and spreads a large one over many, and each
task works through a host in groups of at most ``GROUP_PAGES`` pages.

In a group every page becomes a DOM tree in which runs of like siblings are
folded into one repeated node. The trees are aligned with a pivot page by
simple tree matching (the largest order-keeping matching of children, top
down). A text that stands in the same aligned node of at least
``TEMPLATE_SHARE`` of the group's different pages is template; what varies
is content. The content region is the semantic article (or main) element
with the most varying text, or else the smallest element that holds most of
it. Regions of menus, adverts, forms and the like, known by element, class,
id or role, never count. If the template would take more than
``COPY_SHARE`` of the region's text, the pages are copies of one article
and the text stays.

Character references are decoded, white space in a block becomes one space,
blocks are joined by a line feed. Null and empty html, or html without
text, gives the empty string. A page without a readable host is grouped
with others of that kind. Repeated rows give repeated results; an empty
table none; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F, types as T

GROUP_PAGES = 64
MIN_PAGES = 4
TEMPLATE_SHARE = 0.6
REGION_SHARE = 0.7
COPY_SHARE = 0.4
# Elements nested deeper become children of the deepest one (as browsers do).
MAX_DEPTH = 200

# HTML element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
RAW = frozenset("script style textarea title noscript iframe xmp template".split())
DROPPED = frozenset("head script style textarea title noscript iframe xmp template nav header footer aside form button select option input label dialog svg canvas audio video object menu".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}
ASIDE_WORDS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert sidebar sidenav widget menu nav navbar navigation breadcrumb breadcrumbs footer header masthead toolbar comment comments commentlist disqus replies respond share sharing social related recommended newsletter subscribe signup popup modal overlay paywall hidden".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
MAIN_WORDS = frozenset("article post content entry story main body text".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_ATTR = re.compile(r"""(class|id|role|hidden|aria-hidden|style|itemprop)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_WORDS = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "key", "aside", "main", "children")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.key, self.children = tag, tag, []
        self.aside, self.main = tag in DROPPED, 2 if tag in ("article", "main") else 0
        if attrs.strip(" /"):
            got = {k.lower(): (v or "").strip("\"'").lower() for k, v in _ATTR.findall(attrs)}
            names = f"{got.get('class', '')} {got.get('id', '')}"
            words = set(_WORDS.findall(names))
            self.key = f"{tag}.{got['class']}" if got.get("class") else tag
            self.aside |= bool(words & ASIDE_WORDS) and tag not in ("body", "html", "main") or got.get("role") in ASIDE_ROLES or "hidden" in got or got.get("aria-hidden") == "true" or "display:none" in got.get("style", "").replace(" ", "")
            if got.get("role") in ("main", "article") or got.get("itemprop") == "articlebody":
                self.main = 2
            elif words & MAIN_WORDS and not self.main and tag in ("div", "section", "td"):
                self.main = 1


def parse(source: str) -> Node:
    """The DOM tree; text nodes are strings."""
    root = Node("html")
    stack, at = [root], 0

    def close_to(tags: set[str], scope: set[str]) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                del stack[i:]
                return
            if stack[i].tag in scope:
                return

    while True:
        m = _TOKEN.search(source, at)
        if source[at:m.start() if m else None].strip():
            stack[-1].children.append(source[at:m.start() if m else None])
        if not m:
            return root
        at = m.end()
        end, tag, attrs = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if end:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            if tag in BLOCK:
                stack[-1].children.append(Node("br/"))
            continue
        if tag in BLOCK and tag not in ("td", "th", "li", "html", "body"):
            close_to({"p"}, {"table", "td", "th", "button", "body"})
        if tag in CLOSED_BY:
            close_to(CLOSED_BY[tag], SCOPE[tag])
        if tag in ("html", "body"):
            node = Node(tag, attrs)
            node.aside = False
            if tag == "body":
                stack[1:] = []
                stack[-1].children.append(node)
                stack.append(node)
            continue
        node = Node(tag, attrs)
        stack[-1].children.append(node)
        if tag in VOID:
            continue
        if tag in RAW:
            close = re.compile(f"</{re.escape(tag)}\\s*>", re.I).search(source, at)
            at = close.end() if close else len(source)
            continue
        if len(stack) < MAX_DEPTH:
            stack.append(node)


class Folded:
    """A node of the folded tree: like siblings in a row are one node."""
    __slots__ = ("key", "children", "texts", "size", "slot")

    def __init__(self, key: str):
        self.key, self.children, self.texts, self.size, self.slot = key, [], [], 1, -1


def fold(nodes: list[Node], key: str, where: dict) -> Folded:
    """Fold the like-keyed ``nodes``; ``where`` gets each node's folded one.
    Regions that never count stay out."""
    out = Folded(key)
    for n in nodes:
        where[id(n)] = out
        run: list[Node] = []
        for c in n.children:
            if isinstance(c, str):
                out.texts.append(hash(_SPACE.sub(" ", c).strip()))
            elif not c.aside and c.tag not in ("br", "br/", "img", "hr", "wbr"):
                if run and run[-1].key != c.key:
                    _join(out, run, where)
                    run = []
                run.append(c)
        if run:
            _join(out, run, where)
    out.size = 1 + sum(c.size for c in out.children)
    return out


def _join(parent: Folded, run: list[Node], where: dict) -> None:
    parent.children.append(fold(run, run[0].key, where))


def match(a: Folded, b: Folded) -> tuple[int, list]:
    """Simple tree matching: (matched nodes, pairs) of the best top-down,
    order-keeping matching of two trees with like roots."""
    if a.key != b.key:
        return 0, []
    rows, cols = a.children, b.children
    if [c.key for c in rows] == [c.key for c in cols]:
        parts = [match(x, y) for x, y in zip(rows, cols)]
        return 1 + sum(p[0] for p in parts), [(a, b)] + [q for p in parts for q in p[1]]
    best = [[0] * (len(cols) + 1) for _ in range(len(rows) + 1)]
    pair = {}
    for i, x in enumerate(rows):
        for j, y in enumerate(cols):
            w = 0
            if x.key == y.key:
                w, pairs = match(x, y)
                pair[i, j] = pairs
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + w)
    out, i, j = [(a, b)], len(rows), len(cols)
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            out += pair[i, j]
    return 1 + best[-1][-1], out


def _length(node: Node, skip) -> int:
    return sum((0 if skip(node, c) else len(c.strip())) if isinstance(c, str) else 0 if c.aside else _length(c, skip) for c in node.children)


def _region(root: Node, skip) -> Node | None:
    """The element that holds the article."""
    named: list[tuple[int, int, Node]] = []
    sizes: dict[int, int] = {}

    def walk(n: Node) -> int:
        size = 0
        for c in n.children:
            if isinstance(c, str):
                size += 0 if skip(n, c) else len(c.strip())
            elif not c.aside:
                size += walk(c)
        sizes[id(n)] = size
        if n.main and size:
            named.append((n.main, size, n))
        return size

    total = walk(root)
    if not total:
        return None
    for level in (2, 1):
        found = [(s, n) for m, s, n in named if m == level]
        if found:
            most = max(found, key=lambda x: x[0])
            if level == 2 or most[0] >= REGION_SHARE * total:
                articles = [(s, n) for s, n in found if n.tag == "article"]
                inner = max(articles, key=lambda x: x[0]) if articles else most
                return inner[1] if inner[0] >= REGION_SHARE * most[0] else most[1]
    node = root
    while True:
        inside = [c for c in node.children if not isinstance(c, str) and sizes.get(id(c), 0) >= REGION_SHARE * total and c.tag != "p"]
        if not inside:
            return node
        node = inside[0]


def _blocks(region: Node, skip) -> str:
    out: list[str] = []
    line: list[str] = []

    def end() -> None:
        text = _SPACE.sub(" ", html.unescape("".join(line))).strip()
        line.clear()
        if text:
            out.append(text)

    def walk(n: Node) -> None:
        for c in n.children:
            if isinstance(c, str):
                if not skip(n, c):
                    line.append(c)
            elif c.tag == "br":
                line.append(" ")
            elif c.tag == "br/":
                end()
            elif not c.aside:
                block = c.tag in BLOCK
                if block and c.tag not in ("td", "th"):
                    end()
                elif block:
                    line.append(" ")
                walk(c)
                if block and c.tag not in ("td", "th"):
                    end()
    walk(region)
    end()
    return "\n".join(out)


def extract_group(pages: list[str]) -> list[str]:
    """The main text of each page of one host."""
    trees = [parse(p) if p else None for p in pages]
    wheres: list[dict] = [{} for _ in trees]
    folded = [fold([t], "html", w) if t else None for t, w in zip(trees, wheres)]
    pivot = next((f for f in folded if f), None)
    template: set[tuple[int, int]] = set()
    if pivot is not None:
        slots: list[Folded] = []

        def number(n: Folded) -> None:
            n.slot = len(slots)
            slots.append(n)
            for c in n.children:
                number(c)

        number(pivot)
        seen: Counter = Counter()
        different = set()
        for f in folded:
            if f is None:
                continue
            pairs = match(pivot, f)[1]
            own = set()
            for p, q in pairs:
                q.slot = p.slot
                own.update((p.slot, t) for t in q.texts)
            if (print_ := frozenset(own)) not in different:
                different.add(print_)
                seen.update(own)
        if len(different) >= MIN_PAGES:
            template = {k for k, n in seen.items() if n >= TEMPLATE_SHARE * len(different)}
    out = []
    for tree, where in zip(trees, wheres):
        if tree is None:
            out.append("")
            continue

        def constant(n: Node, text: str) -> bool:
            f = where.get(id(n))
            return f is not None and (f.slot, hash(_SPACE.sub(" ", text).strip())) in template

        keep_all = lambda n, text: False
        skip = constant if template else keep_all
        region = _region(tree, skip) or _region(tree, keep_all)
        if region is None:
            out.append("")
            continue
        if template:
            whole = _length(region, keep_all)
            if whole - _length(region, constant) > COPY_SHARE * whole:
                region, skip = _region(tree, keep_all), keep_all
        out.append(_blocks(region, skip))
    return out


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col, url_col, text, n_chars`` of every row."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col).cast("string"), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host.alias("host"), F.xxhash64(id_col, url_col).alias("h"))
    schema = T.StructType([T.StructField("id", pages.schema[id_col].dataType), T.StructField("url", pages.schema[url_col].dataType), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held: list = []
        held_host = None

        def emit():
            rows = pa.Table.from_batches([pa.RecordBatch.from_arrays(list(b.columns[:3]), names=["id", "url", "html"]) for b in held]).combine_chunks()
            texts = extract_group(rows.column("html").to_pylist())
            one = lambda c: rows.column(c).chunk(0)
            return pa.RecordBatch.from_arrays([one("id"), one("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=schema.names)

        for batch in batches:
            hosts = batch.column(3).to_pylist()
            at = 0
            while at < len(hosts):
                have = sum(b.num_rows for b in held)
                if held and (hosts[at] != held_host or have >= GROUP_PAGES):
                    yield emit()
                    held, have = [], 0
                held_host, end = hosts[at], at
                while end < len(hosts) and hosts[end] == held_host and have + end - at < GROUP_PAGES:
                    end += 1
                held.append(batch.slice(at, end - at))
                at = end
        if held:
            yield emit()

    # a range partitioning needs a number; hosts sorted in it stay together
    n = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, "host", "h").sortWithinPartitions("host", "h")
    return dealt.mapInArrow(run, schema).select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")
