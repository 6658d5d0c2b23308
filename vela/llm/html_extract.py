"""Main text of web pages: site template removal over element subtrees.

Method.  A page becomes a tree of elements.  Each block element with text has a
subtree hash (tag, attributes, children and text below it).  Spark counts, per host,
the pages that hold each hash, and inside article elements the distinct articles; what
recurs is site template and is deleted wherever it occurs on that host:
- outside articles, on ``min_pages`` pages and ``share`` of the host's pages;
- inside, in ``min_pages`` distinct articles besides, and a paragraph, heading, list item or
  cell in distinct articles for that share, so copies of an article stay whole;
- a box (any other block) also on ``many`` pages (distinct articles) that are ``box_share`` of the host's.
What the page itself says is not article (navigation, footer,
aside, form, script, advert, notice, comment ... by tag, role, class or id) goes too.

Scale.  Blocks outside articles are counted per batch before the shuffle, articles go
once each with the list of their blocks.  At most (blocks per page / box_share) hashes of a
host can qualify, so the list a host sends back is bounded; the join
back to the pages is salted, since one host may hold a third of all pages.
"""
from __future__ import annotations

import hashlib
import html as entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "iframe", "noscript", "noembed", "noframes", "xmp"}
DROP = {"head", "script", "style", "textarea", "title", "iframe", "noscript", "noembed", "noframes", "template", "nav", "footer", "aside", "form", "button", "select", "option",
        "svg", "canvas", "object", "dialog", "menu", "audio", "video", "map", "math"}
PROSE = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "blockquote", "pre", "td", "th", "dt", "dd", "figcaption", "caption", "address"}
BLOCK = PROSE | DROP | {"html", "body", "main", "article", "section", "div", "header", "ul", "ol", "dl", "table", "thead", "tbody", "tfoot", "tr", "figure", "fieldset", "details", "summary", "hgroup", "center", "hr"}
CODE = {"pre", "code"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "form", "menu", "menubar", "toolbar"}
#: Words of a class or id that mark what is not article.
MARKS = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adsense", "adsbygoogle", "sponsor", "sponsored", "promo", "promotion", "banner", "nav", "navbar",
         "navigation", "menu", "submenu", "breadcrumb", "breadcrumbs", "header", "masthead", "topbar", "footer", "sidebar", "aside", "widget", "widgets", "cookie", "cookies", "consent", "gdpr",
         "notice", "notification", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "paywall", "share", "sharing", "social", "related", "recommended",
         "comment", "comments", "commentlist", "respond", "disqus", "pagination", "pager", "toolbar", "skip", "searchform", "toc"}
#: Comment, declaration or tag; the last group is empty if no > ends a declaration, or a tag outside quotes.  Possessive, so that nothing is tried twice.
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?P<over>>?)|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?P<end>>?)", re.S)
#: The same without the attributes, for pages with unpaired quotes.
_OPENING = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?P<over>>?)|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>)(?P<end>)", re.S)
_QUOTE = re.compile(r"[>\"']")
_ATTR = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPLIT = re.compile(r"[^a-z0-9]+")
#: Words that make a compound name with MARKS (share-buttons, related-posts); any other word makes it a name of content (related-work, share-price).
FILL = {"area", "article", "articles", "bar", "block", "body", "bottom", "box", "btn", "button", "buttons", "card", "cards", "container", "content", "entry", "footer", "form", "group", "header", "icon", "icons", "inline", "inner", "item", "items", "js", "label", "left", "link", "links", "list", "main", "message", "module", "outer", "page", "panel", "post", "posts", "right", "row", "section", "site", "slot", "stories", "story", "text", "title", "top", "unit", "wrap", "wrapper", "media"}
#: A start tag of the key ends an open element of the values, up to a container.
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
         "option": ({"option"}, {"select"}), "tbody": ({"thead", "tbody", "tr"}, {"table"}), "tfoot": ({"tbody", "tr"}, {"table"})}


class Node:
    __slots__ = ("tag", "attrs", "items", "hash", "chars")

    def __init__(self, tag: str, attrs: str):
        self.tag, self.attrs, self.items, self.hash, self.chars = tag, attrs, [], 0, 0

    def attributes(self) -> dict[str, str]:
        return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(self.attrs)}


def _tag_end(page: str, at: int, dead: set[int]) -> int:
    """Place of the first > outside quotes; without one, of the first >; -1 if there is none.

    ``dead`` holds the opening quotes that no such > follows, so a page is read once however many of its tags have unpaired quotes.
    """
    seen, here = [], at
    while (m := _QUOTE.search(page, here)) and m.start() not in dead:
        if m[0] == ">":
            return m.start()
        seen.append(m.start())
        here = page.find(m[0], m.end()) + 1
        if not here:
            break
    dead.update(seen)
    return page.find(">", at)


def parse(page: str) -> Node:
    """Element tree; items are texts (decoded) and child nodes.  Unclosed elements end with their parent; a tag that nothing closes is text."""
    root = Node("#", "")
    stack, at, n = [root], 0, len(page)
    token, dead = _TOKEN, set()
    while at < n:
        m = token.search(page, at)
        end, name = m.end() if m else -1, m and m["name"]
        if m and m["over"] == "":
            end = -1
        elif name and not m["end"]:
            token, end = _OPENING, _tag_end(page, m.end("name"), dead) + 1 or -1
        if end < 0:  # no more tags
            cut = page.find("<!--", at)
            stack[-1].items.append(entities.unescape(page[at:cut if cut >= 0 else n]))
            break
        if m.start() > at:
            stack[-1].items.append(entities.unescape(page[at:m.start()]))
        at = end
        if not name:
            continue
        tag, closing, attrs = name.lower(), m["close"], page[m.end("name"):end - 1]
        if closing:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            continue
        if tag in BLOCK and tag not in ("html", "body"):
            stops, until = _ENDS.get(tag, (set(), set()))
            for i in range(len(stack) - 1, 0, -1):
                open_tag = stack[i].tag
                if open_tag in stops or open_tag == "p":
                    del stack[i:]
                    break
                if open_tag in until or (open_tag in BLOCK and not stops):
                    break
        node = Node(tag, attrs)
        stack[-1].items.append(node)
        if tag in VOID or attrs.endswith("/") and tag in ("svg", "path"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            node.items.append(page[at:end.start() if end else n])
            at = end.end() if end else n
            continue
        stack.append(node)
    return root


def _digest(*parts) -> int:
    return int.from_bytes(hashlib.blake2b("\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def hash_subtrees(root: Node) -> list[Node]:
    """Sets hash and text length of every node, children first; returns the block nodes that have text."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(x for x in node.items if isinstance(x, Node))
    blocks = []
    for node in reversed(order):
        parts = []
        for x in node.items:
            if isinstance(x, Node):
                parts.append(x.hash)
                node.chars += x.chars
            elif words := " ".join(x.split()):
                parts.append(words)
                node.chars += len(words)
        node.hash = _digest(node.tag, node.attrs.strip(), *parts)
        if node.chars and node.tag in BLOCK and node.tag not in ("html", "body"):
            blocks.append(node)
    return blocks


def _marked(node: Node, a: dict[str, str], inside: bool, code: bool) -> bool:
    """Do class and id say that the element is not article?

    Inside articles and main elements a whole name must be of MARKS and FILL; elsewhere one word is enough.  Ids of
    headings, paragraphs, cells and inline elements are made from their text and not read; neither is anything in code.
    """
    if code:
        return False
    names = a.get("class", "").lower().split()
    if node.tag in BLOCK and node.tag not in PROSE:
        names += a.get("id", "").lower().split()
    for words in (set(_SPLIT.split(name)) - {""} for name in names):
        marks = words & MARKS
        if marks and not (inside and (marks == {"header"} or not words <= MARKS | FILL)):
            return True
    return False


def _not_article(node: Node, in_article: bool, inside: bool = False, code: bool = False) -> bool:
    if node.tag in DROP:
        return True
    if node.tag == "header":
        return not in_article
    if not node.attrs:
        return False
    a = node.attributes()
    if a.get("role", "").lower() in ROLES or "hidden" in a or a.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", a.get("style", ""), re.I):
        return True
    if node.tag in ("html", "body", "main", "article"):
        return False
    return _marked(node, a, in_article or inside, code)


def _is_main(node: Node) -> bool:
    return node.tag == "main" or bool(node.attrs) and node.attributes().get("role", "").lower() == "main"


def _find(root: Node, template: set[int]) -> tuple[list[Node], list[Node], int]:
    """All articles; the main elements and the articles beside them (else the root); characters of the latter outside articles and template."""
    articles, tops, mains, inner, outer = [], [], 0, 0, 0
    stack = [(root, False, False)]  # (node, in a main element, in a template subtree)
    while stack:
        node, in_main, gone = stack.pop()
        if node.tag == "article":
            articles.append(node)
            if not in_main:
                tops.append(node)
            continue
        if not in_main and _is_main(node):
            tops.append(node)
            mains, in_main = mains + 1, True
        for x in reversed(node.items):
            if isinstance(x, Node):
                if not _not_article(x, False, in_main):
                    stack.append((x, in_main, gone or x.hash in template and x.tag != "main"))
            elif not gone:
                n = len(" ".join(x.split()))
                outer += n
                inner += n * in_main
    return articles, tops if mains else [root], inner if mains else outer


def main_text(page: str, template: set[int], inner: set[int] | None = None) -> str:
    """The articles; main elements, or the page, if there are none or they hold less than a third of its text.

    ``template`` subtrees go outside articles, ``inner`` ones (else the same) inside.
    """
    inner = template if inner is None else inner
    root = parse(page)
    hash_subtrees(root)
    articles, tops, outside = _find(root, template)
    text = _render(articles, template, inner)
    return text if articles and outside <= 2 * len(text) else _render(tops, template, inner)


def _render(tops: list[Node], template: set[int], inner: set[int]) -> str:
    blocks: list[str] = []
    run: list[str] = []

    def close():
        text = " ".join("".join(run).split())
        if text:
            blocks.append(text)
        run.clear()

    stack: list = [(top, 0) for top in reversed(tops)]  # (node, index of the next item)
    in_article = in_main = in_code = 0  # open ones
    heads = 0  # open article headers: only headings count there
    open_headings = 0
    while stack:
        node, i = stack.pop()
        if not i:
            in_article += node.tag == "article"
            in_main += not in_article and _is_main(node)
            in_code += node.tag in CODE
            heads += node.tag == "header"
            open_headings += node.tag in HEADINGS
        if i == len(node.items):
            if node.tag in BLOCK:
                close()
            in_main -= not in_article and _is_main(node)
            in_article -= node.tag == "article"
            in_code -= node.tag in CODE
            heads -= node.tag == "header"
            open_headings -= node.tag in HEADINGS
            continue
        stack.append((node, i + 1))
        x = node.items[i]
        if isinstance(x, str):
            if not heads or open_headings:
                run.append(x)
            continue
        if x.tag == "br":
            run.append(" ")
        elif x.tag in VOID:
            if x.tag in BLOCK:
                close()
        elif not _not_article(x, in_article > 0, in_main > 0, in_code > 0) and not (x.hash in (inner if in_article else template) and x.tag not in ("main", "article")):
            if x.tag in BLOCK:
                close()
            stack.append((x, 0))
    close()
    return "\n\n".join(blocks)


def _blocks(root: Node) -> dict[int, tuple[bool, int | None]]:
    """hash -> (is it a box, hash of an article that holds it or None) of the blocks with text that are not dropped by their tag."""
    out: dict[int, tuple[bool, int | None]] = {}
    stack: list[tuple[Node, int | None]] = [(root, None)]
    while stack:
        node, holder = stack.pop()
        if holder is None and node.tag == "article":
            holder = node.hash
        for x in node.items:
            if isinstance(x, Node) and x.chars and x.tag not in DROP:
                stack.append((x, holder))
                if x.tag in BLOCK and x.tag not in ("html", "body", "main", "article") and (holder is not None or x.hash not in out):
                    out[x.hash] = (x.tag not in PROSE, holder)
    return out


def _count(batches):
    """Rows (site, holder, outer, box, hashes, n): each block outside articles is a holder of its own."""
    for batch in batches:
        seen: dict[tuple, list] = {}
        for site, page in zip(batch.column("site").to_pylist(), batch.column("html").to_pylist()):
            root = parse(page or "")
            hash_subtrees(root)
            groups: dict[tuple, list[int]] = {}
            for h, (box, holder) in _blocks(root).items():
                groups.setdefault((site, h if holder is None else holder, holder is None, box), []).append(h)
            for key, hashes in groups.items():
                held = seen.setdefault(key, [[], 0])
                held[:] = max(held[0], sorted(hashes)), held[1] + 1  # beside other articles a list can be shorter
        cols = list(zip(*seen)) or [()] * 4
        yield pa.record_batch([*(pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.bool_(), pa.bool_()))), pa.array([v[0] for v in seen.values()], pa.list_(pa.int64())), pa.array([v[1] for v in seen.values()], pa.int64())],
                              names=["site", "holder", "outer", "box", "hashes", "n"])


def _extract(batches):
    for batch in batches:
        texts = [main_text(page or "", set(t or ()), set(i or ())) for page, t, i in zip(*(batch.column(c).to_pylist() for c in ("html", "template", "inner")))]
        yield pa.record_batch([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def extract(pages: DataFrame, min_pages: int = 5, share: float = 0.5, salts: int = 32, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            many: int = 20, box_share: float = 0.1) -> DataFrame:
    """page id, url, text of every page row.

    A null or empty page, or one with nothing but template, has an empty text.  A null
    url counts as a host of its own (the empty one).  Repeated rows give a row each and count as
    pages each; extra columns are left out; an empty table gives an empty table.
    """
    host = F.coalesce(F.lower(F.regexp_extract(F.col(f"`{url_col}`"), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1)), F.lit(""))
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"), F.col(f"`{html_col}`").alias("html"), F.xxhash64(host).alias("site"))
    of_host = rows.groupBy("site").agg(F.count(F.lit(1)).alias("pages"))
    once = rows.select("site", "html").mapInArrow(_count, "site long, holder long, outer boolean, box boolean, hashes array<long>, n long") \
        .groupBy("site", "holder", "outer", "box").agg(F.max("hashes").alias("hashes"), F.sum("n").alias("n")).where(~F.col("outer") | (F.col("n") >= min_pages))
    counts = once.select("site", F.explode("hashes").alias("hash"), "outer", "box", "n").groupBy("site", "hash", "outer", "box").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("articles"))
    distinct = F.when(F.col("outer"), F.col("n")).otherwise(F.col("articles"))
    usual = F.when(F.col("box"), F.col("n")).otherwise(distinct) >= F.col("pages") * share
    often = counts.where(distinct >= min_pages).join(of_host, "site").where(usual | F.col("box") & (distinct >= many) & (distinct >= F.col("pages") * box_share))
    template = often.groupBy("site").agg(F.collect_list(F.when(F.col("outer"), F.col("hash"))).alias("template"), F.collect_list(F.when(~F.col("outer"), F.col("hash"))).alias("inner")) \
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)).cast("int"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return salted.join(template, ["site", "salt"], "left").select("page_id", "url", "html", "template", "inner") \
        .mapInArrow(_extract, f"page_id {kinds['page_id']}, url {kinds['url']}, text string").withColumnsRenamed({"page_id": id_col, "url": url_col})
