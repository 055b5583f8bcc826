"""Main text of web pages by site template removal.

Two passes over the pages.  ``subtrees``: every page is parsed, every element subtree gets a
hash of its tags and text, and Spark counts on how many different pages of a host each hash
stands (partial counts before the shuffle, so a host with a third of all pages is no hot
group).  ``extract``: every page is parsed again next to its host's recurring hashes, those
subtrees are deleted, and the remaining blocks become the text.

A subtree is template when it recurs on ``SHARE`` of its host's different pages and on
``LEAST_PAGES`` at least; pages with the same text outside menus, scripts and the like are one page.
Only blocks are counted, never inline elements, line breaks or rules.  Copies of an article on one
host are not a template: prose blocks (paragraphs, headings, lists items, quotes, tables) inside a declared
``article`` or ``main`` are never counted, nor is any block with half of the page's article text; other
blocks inside are counted over different articles, known by their longest string outside the block.

Besides templates, these go by their tag or by a word of their class, id or role: menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles, reader comments; by tag only if they
do not hold the page's text (``settle``), and an article's header keeps its headings.  A word does not
count behind a modifier (``has-sidebar``), nor on an element that holds a ``main``, a headline (``h1``) or
half of the page's article text, or of all its text; for adverts, pop-ups and comments a headline or
text counts only if it is nearly all of the page's (for comments, with a headline).  If
an ``article`` or ``main`` is left, only what lies in it is text, else the body is.

Edge cases: null and empty html give an empty text; broken markup (unclosed or crossed tags,
cut-off pages) is read as far as it goes; a null url counts as one host of its own; equal
pages give equal rows; a host with few pages loses nothing to the template count; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from functools import cache
from html.parser import HTMLParser
from zlib import crc32

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARE = 0.2
LEAST_PAGES = 5
SALTS = 64              # a host's pages are dealt over so many keys when they meet its templates

# fixed values: HTML element names
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED_TAGS = frozenset("head title script style noscript template svg iframe object canvas audio video "
                         "nav header footer aside form button select textarea input label dialog menu".split())
BLOCKS = frozenset("address article blockquote body caption center dd details div dl dt fieldset figcaption figure "
                   "h1 h2 h3 h4 h5 h6 hr html li main ol p pre section summary table tbody td tfoot th thead tr ul".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li ul ol dl dd dt table tbody thead tr td th "
                  "figcaption b i em strong a span br code sub sup u s small mark q cite abbr".split())
#: may be template outside of a declared article, and inside
COUNTED = BLOCKS - {"html", "body", "article", "main", "hr"}
COUNTED_INSIDE = COUNTED - PROSE
#: an opening tag closes these when they are open in the same container
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"},
}
CLOSES_P = BLOCKS - {"body", "html", "tbody", "td", "tfoot", "th", "thead", "tr", "caption", "li", "dd", "dt"} | {"li", "dd", "dt"}
#: of the dropped tags, those that may be wrapped round a page's text
WRAPPERS = frozenset("form aside header footer".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = frozenset("p blockquote pre".split())
#: in a sentence of these the words of a button or label belong to it
SENTENCES = frozenset("p li dd td th blockquote em strong b i q cite figcaption h1 h2 h3 h4 h5 h6".split())
SCOPES = frozenset("table td th ul ol dl article main section div body html blockquote".split())
#: words of a class, id or role that mark what is no main text
DROPPED_WORDS = frozenset("""
    ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion
    nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead topbar footer colophon
    sidebar aside complementary contentinfo widget related recommended
    notice notices cookie cookies consent gdpr alert popup modal newsletter subscribe subscription signup login
    comment comments respond reply replies disqus share sharing social toolbar pagination pager search form
    """.split())
#: a dropped word behind one of these says nothing of the element itself
MODIFIERS = frozenset("has no with without".split())
READERS = frozenset("comment comments respond reply replies disqus".split())
#: a headline or half of the text does not speak against these
STRONG = READERS | frozenset("""
    ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion cookie cookies consent gdpr
    popup modal newsletter subscribe subscription signup login share sharing social
    """.split())
_SPLIT = re.compile(r"[^a-z0-9]+")
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag, attrs=()):
        self.tag, self.attrs, self.children = tag, attrs, []


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html")
        self.open = [self.root]

    def _close(self, tags, scopes):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in tags:
                del self.open[i:]
                return
            if self.open[i].tag in scopes:
                return

    def handle_starttag(self, tag, attrs):
        if tag == "html":
            return
        if tag in CLOSES_P:
            self._close({"p"}, SCOPES)
        if tag in CLOSED_BY:
            self._close(CLOSED_BY[tag], {"table", "ul", "ol", "dl", "select"})
        node = Node(tag, attrs)
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)        # the slash of <div/> means nothing in HTML

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)


def parse(html: str) -> Node:
    b = _Builder()
    b.feed(html)
    b.close()
    settle(b.root)
    return b.root


def settle(root: Node) -> None:
    """Give elements that stand for something else than their tag says the tag of what they are.

    A form, sidebar, header or footer round a ``main``, round half of the page's article text, or (of a page without
    declared articles; forms and sidebars only) round half of its paragraphs is a plain block.  A header inside an article keeps
    its headings.  A button or label amid a sentence is inline.
    """
    order, stack = [], [(root, None, False)]
    while stack:
        node, parent, inside = stack.pop()
        order.append((node, parent, inside))
        inside = inside or node.tag in ("article", "main")
        stack.extend((c, node, inside) for c in node.children if not isinstance(c, str))
    facts: dict[int, tuple[bool, int, int, int]] = {}       # main, text in articles, in paragraphs, in all
    for node, _, _ in reversed(order):                      # children before parents
        main, article, prose, length = node.tag == "main", 0, 0, 0
        for c in node.children:
            if isinstance(c, str):
                length += len(c.strip())
            elif c.tag in WRAPPERS or not hidden(c):
                m, a, p, n = facts[id(c)]
                main, article, prose, length = main or m, article + a, prose + p, length + n
        if node.tag == "article" and READERS.isdisjoint(words_of(node)):
            article = length
        facts[id(node)] = main, article, length if node.tag in PARAGRAPHS else prose, length
    _, all_article, all_prose, _ = facts[id(root)]
    for node, parent, inside in order:
        if node.tag in WRAPPERS and not any(n == "hidden" for n, _ in node.attrs):
            main, article, prose, _ = facts[id(node)]
            if main or article and 2 * article >= all_article:
                node.tag = "div"
            elif node.tag in ("form", "aside") and not all_article and not facts[id(root)][0] and prose and 2 * prose >= all_prose:
                node.tag = "div"
            elif node.tag == "header" and inside:
                found, below = [], list(reversed(node.children))
                while below:
                    c = below.pop()
                    if isinstance(c, str) or hidden(c):
                        continue
                    if c.tag in HEADINGS:
                        found.append(c)
                    else:
                        below.extend(reversed(c.children))
                if found:
                    node.tag, node.attrs, node.children = "div", [], found
        elif node.tag in ("button", "label") and parent is not None and parent.tag in SENTENCES:
            if any(isinstance(c, str) and c.strip() for c in parent.children):
                node.tag = "span"


def words_of(node: Node) -> set[str]:
    """The dropped words of class, id and role, without those behind a modifier."""
    out = set()
    for name, value in node.attrs:
        if name in ("class", "id", "role") and value:
            for part in value.lower().split():
                before = ""
                for word in _SPLIT.split(part):
                    if word in DROPPED_WORDS and before not in MODIFIERS:
                        out.add(word)
                    before = word
    return out


def hidden(node: Node) -> bool:
    return node.tag in DROPPED_TAGS or any(n == "hidden" or n == "aria-hidden" and v == "true" for n, v in node.attrs)


def holds(root: Node) -> dict[int, tuple[bool, bool, int, int]]:
    """Of every element, in one pass: whether a main and an h1 are it or in it; length of text in its articles, and of all its text."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(c for c in node.children if not isinstance(c, str))
    out: dict[int, tuple[bool, bool, int, int]] = {}
    for node in reversed(order):                # children before parents
        main, headline, article, length = node.tag == "main", node.tag == "h1", 0, 0
        for c in node.children:
            if isinstance(c, str):
                length += len(c.strip())
            elif not hidden(c):
                m, h, a, n = out[id(c)]
                main, headline, article, length = main or m, headline or h, article + a, length + n
        if node.tag == "article" and READERS.isdisjoint(words_of(node)):
            article = length
        out[id(node)] = main, headline, article, length
    return out


def dropped(node: Node, page) -> bool:
    """By tag, or by a word of class, id or role.  A declared article, main or body is not dropped by class words,
    nor is what holds the page's text; ``page`` gives holds() of the page, and its root."""
    if hidden(node):
        return True
    if node.tag in ("body", "main"):
        return False
    words = words_of(node)
    if node.tag == "article":
        return not words.isdisjoint(("comment", "comments"))
    if not words:
        return False
    facts, root = page()
    main, headline, article, length = facts[id(node)]
    if main:
        return False
    if headline and words.isdisjoint(STRONG):
        return False
    _, _, all_article, all_length = facts[id(root)]
    if article and 2 * article >= all_article:
        return False
    if words.isdisjoint(STRONG):
        return not length or 2 * length < all_length
    return 10 * length < 9 * all_length or not length or not words.isdisjoint(READERS) and not headline


def hashes(root: Node) -> tuple[int, list[tuple[int, int, Node]]]:
    """Hash of the page's text, and (hash of tags and text, key, node) of each element that may be template, outermost first.

    The key is 0 outside of articles; inside it stands for the article.
    """
    order = []                                  # (node, in an article, not in a dropped tag)
    stack = [(root, False, True)]
    while stack:                                # no recursion: pages may nest deeply
        node, inside, seen = stack.pop()
        order.append((node, inside, seen))
        inside = inside or node.tag in ("article", "main")
        stack.extend((c, inside, seen and c.tag not in DROPPED_TAGS) for c in reversed(node.children) if not isinstance(c, str))
    value: dict[int, tuple[int, int, int]] = {}     # hash, elements, length of text in articles
    strings = []                                # (length, hash, place) of the articles' strings
    page, page_low = 0, 0
    for at in range(len(order) - 1, -1, -1):    # children before parents
        node, inside, seen = order[at]
        inside = inside or node.tag in ("article", "main")
        h = crc32(node.tag.encode())
        low = crc32(b"/", h)
        size, length = 1, 0
        for c in node.children:
            if isinstance(c, str):
                part = _SPACE.sub(" ", c).strip().encode("utf-8", "replace")
                if seen and part:
                    page, page_low = crc32(part, page), crc32(part, page_low ^ 0x5BD1E995)
                    if inside:
                        length += len(part)
                        strings.append((len(part), crc32(part), at))
            else:
                v, n, m = value[id(c)]
                part, size, length = b"<%d>" % v, size + n, length + m
            h, low = crc32(part, h), crc32(part, low ^ 0x5BD1E995)
        value[id(node)] = h << 31 ^ low, size, length
    total = value[id(root)][2]
    strings.sort(key=lambda x: -x[0])
    out = []
    for at, (node, inside, seen) in enumerate(order):
        if seen and node.tag in (COUNTED_INSIDE if inside else COUNTED):
            h, size, length = value[id(node)]
            if not length or 2 * length < total:
                key = next((x + 2 for _, x, i in strings if not at <= i < at + size), 1) if inside else 0
                out.append((h, key, node))
    return page << 31 ^ page_low, out


def text_of(root: Node, templates: frozenset[int] = frozenset()) -> str:
    """Blocks of the main text, one a line."""
    gone = {id(n) for h, _, n in hashes(root)[1] if h in templates} if templates else set()
    page = cache(lambda: (holds(root), root))
    verdict = cache(lambda x: dropped(x, page))

    def walk(top):
        """Yields nodes and strings in page order, None at the borders of blocks; skips what is no main text."""
        stack = [top]
        while stack:
            x = stack.pop()
            if x is None or isinstance(x, str):
                yield x
                continue
            if x is not top and (id(x) in gone or verdict(x)):
                if x.tag == "br":
                    yield " "
                continue
            yield x
            border = x.tag in BLOCKS
            if border:
                stack.append(None)
            stack.extend(reversed(x.children))
            if border:
                yield None
            if x.tag == "br":
                yield " "

    def lines(top):
        blocks, now = [], []
        for x in walk(top):
            if x is None:
                line = _SPACE.sub(" ", "".join(now)).strip()
                if line:
                    blocks.append(line)
                now = []
            elif isinstance(x, str):
                now.append(x)
        line = _SPACE.sub(" ", "".join(now)).strip()
        return blocks + [line] if line else blocks

    # the outermost declared articles (else mains) that are left
    for tag in ("article", "main"):
        tops, inner = [], set()
        for x in walk(root):
            if isinstance(x, Node) and x.tag == tag and id(x) not in inner:
                tops.append(x)
                stack = list(x.children)
                while stack:
                    c = stack.pop()
                    if not isinstance(c, str):
                        inner.add(id(c))
                        stack.extend(c.children)
        if tops:
            return "\n".join(b for t in tops for b in lines(t))
    return "\n".join(lines(root))


# --- Spark ----------------------------------------------------------------------------------

def host_of(url: str = "url") -> Column:
    """Host of a URL in lower case; empty for null or without one."""
    return F.lower(F.coalesce(F.regexp_extract(F.col(url), r"^[A-Za-z][\w+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1), F.lit("")))


def templates(pages: DataFrame, share: float = SHARE, least: int = LEAST_PAGES) -> DataFrame:
    """(host, hashes): the subtree hashes that recur across a host's pages.

    A page holds n subtrees and a template stands on ``share`` of the pages, so a host has at
    most n / share templates, n being its mean number of subtrees.
    """
    @F.pandas_udf("struct<page: long, outside: array<long>, inside: array<long>, keys: array<long>>")
    def subtrees(html: pd.Series) -> pd.DataFrame:
        out = []
        for x in html:
            page, found = hashes(parse(x)) if x else (0, [])
            inside = sorted({(h, key) for h, key, _ in found if key})
            out.append((page, sorted({h for h, key, _ in found if not key}), [h for h, _ in inside], [key for _, key in inside]))
        return pd.DataFrame(out, columns=["page", "outside", "inside", "keys"])

    rows = pages.select(host_of().alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    # rows with the same text are one page
    rows = (rows.select("host", subtrees("html").alias("s")).groupBy("host", "s.page")
                .agg(F.min(F.struct("s.outside", "s.inside", "s.keys")).alias("s")))

    def pair(h, key):
        return F.struct(h.alias("hash"), key.alias("key"))

    # one pass: hash 0 counts the host's pages, the others the pages with that subtree
    none = F.lit(0).cast("long")
    found = rows.select("host", F.inline(F.concat(
        F.array(pair(none, none)), F.transform("s.outside", lambda h: pair(h, none)),
        F.zip_with("s.inside", "s.keys", pair))))
    counts = (found.groupBy("host", "hash", "key").agg(F.count("*").alias("n"))
                   .groupBy("host", "hash").agg(F.sum(F.when(F.col("key") == 0, F.col("n")).otherwise(1)).alias("pages"))
                   .where((F.col("pages") >= least) | (F.col("hash") == 0)))
    # a host's subtrees that stand on ``least`` pages are counted against the host's pages
    total = counts.where("hash = 0").select("host", F.col("pages").alias("total"))
    return (counts.where("hash != 0").join(total, "host").where(F.col("pages") >= share * F.col("total"))
                  .groupBy("host").agg(F.collect_list("hash").alias("hashes")))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) per row of ``pages``."""
    known = templates(pages).select("host", "hashes", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    rows = (pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
                 .withColumn("host", host_of())
                 .withColumn("salt", F.pmod(F.xxhash64("html"), F.lit(SALTS)).cast("int")))

    def texts(batches):
        for b in batches:
            host, hit = b.column(3), b.column(4)
            sets: dict[str, frozenset[int]] = {}
            out = []
            for html, h, t in zip(b.column(2), host.to_pylist(), hit):
                if h not in sets:
                    sets[h] = frozenset(t.as_py() or ())
                out.append(text_of(parse(html.as_py()), sets[h]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string())],
                                             names=["page_id", "url", "text"])

    return (rows.join(known, ["host", "salt"], "left").select("page_id", "url", "html", "host", "hashes")
                .mapInArrow(texts, "page_id long, url string, text string"))


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) per row."""
    return extract(pages).withColumn("n_chars", F.length("text").cast("long"))
