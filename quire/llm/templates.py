"""Main text of web pages by site template removal.

Every page is parsed into elements. A subtree's hash covers its tags, classes and text. Spark counts,
for each host, in how many different contents a subtree occurs; subtrees that recur in many of the
host's (LEAST_PAGES, and LEAST_SHARE of them) are the site's template and are deleted. For a subtree of
an article, the content is the article; for others, the page. So copies of an article, or of a page,
count once, whatever stands around them.

Two things the count alone cannot tell are told by the markup. Elements that say what they are (nav,
footer, class="ad", role="navigation", ...) and hidden ones are deleted on a host's only page too. A form, a
role, and a class or id that says so by a whole word does not count for an article, for what holds one, or for
most of the page's text (whole pages are wrapped in forms); one that says so by the first or last part of
a word (comments-area, site-footer) counts only for what holds less than half of the text. The header of an article
is kept if it has a heading. And
paragraphs, headings and lists of the article are never template: within an article only boxes (div,
section, table, ...) can be, but not one that holds most of its text.

If a page has an article or main element, the text is taken from there; else from the body. There, the
innermost element that holds most of the text is treated as the article.

Defined results. Null and empty html give an empty text. Unclosed elements end with their parent; a
new block ends an open paragraph; end tags without a start are ignored; a ``<`` that starts no
tag is text; an unclosed comment or script runs to the end of the page. A page without a host
belongs to the host "". Repeated rows count once. An empty table gives an empty table. Pages are parsed one at a time, whole."""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import map_column, stored
from quire.llm.linkgraph import host_of

#: A subtree is template from so many contents of its host on, if they are this share of its contents.
LEAST_PAGES, LEAST_SHARE = 5, 0.2
#: An element holds most of the text from this share of its characters on.
MOST_SHARE = 0.7
#: A compound name counts for an element with less of the text than this.
LESS_SHARE = 0.5
#: Template hashes (8 bytes each) sent to the tasks at once; more are sent in parts, by host.
TEMPLATES_TO_SEND = 1_000_000

#: Elements that say that they are not main text, or hold none.
DROP_TAGS = frozenset(
    "nav header footer aside script style noscript template iframe object embed svg canvas button select "
    "option textarea input label dialog menu head title audio video map".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
DROP_NAMES = re.compile(
    r"(?:^|\s)(?:ads?|adverts?|advertisements?|advertising|adsense|banner|sponsor(?:ed)?|promo(?:tion)?|nav|navbar|navigation|menu"
    r"|breadcrumbs?|sidebar|side-bar|footer|masthead|site-header|page-header|cookies?|consent|gdpr|notice|popup|modal|newsletter|subscribe"
    r"|subscription|signup|sign-up|login|comments?|comment-list|disqus|replies|respond|social|share|sharing|related|recommended)(?:$|\s)", re.I)
#: Parts that say so at either end of a compound name, unless the rest says that it is a state or a category.
DROP_PARTS = frozenset("ad ads advert adverts advertisement banner sponsor sponsored promo nav navbar navigation menu breadcrumb breadcrumbs sidebar "
                       "footer masthead cookie cookies consent gdpr popup modal newsletter subscribe signup login comment comments disqus replies "
                       "respond social share sharing related recommended".split())
OTHER_FIRST = frozenset("has no not with without is layout category tag type status format post article entry".split())
OTHER_LAST = frozenset("open closed enabled disabled on off none".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MAINS = ("article", "main")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noframes noembed xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul br".split())
#: Blocks that end an open paragraph.
ENDS_P = BLOCKS - {"br", "html", "body"}
ENDS_SIBLING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
                "option": {"option"}, "thead": {"tr", "td", "th", "tbody"}, "tbody": {"tr", "td", "th", "thead", "tbody"}}
#: What encloses them: an unclosed element does not reach beyond.
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}} | dict.fromkeys(("tr", "td", "th", "thead", "tbody"), {"table"})
#: Within an article only these can be template.
BOXES = frozenset("div section table figure details center fieldset address aside".split())

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[!?/][^>]*>""", re.S)
HIDDEN = re.compile(r"""\shidden(?=[\s=/]|$)|\sstyle\s*=\s*["']?[^"'>]*display\s*:\s*none""", re.I)
QUOTED = re.compile(r"""=\s*(?:"[^"]*"|'[^']*')""")
ATTR = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)

CONTENTS = T.ArrayType(T.StructType([T.StructField("inside", T.BooleanType()), T.StructField("content", T.LongType()),
                                     T.StructField("hashes", T.ArrayType(T.LongType()))]))
_ARROW_CONTENTS = pa.list_(pa.struct([("inside", pa.bool_()), ("content", pa.int64()), ("hashes", pa.list_(pa.int64()))]))
RESULT = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])


def compound(name: str) -> bool:
    """Whether the first or last part of a name in several parts says that it names no main text."""
    parts = [x for x in re.split("[-_]+", name) if x]
    return (len(parts) > 1 and (parts[0] in DROP_PARTS or parts[-1] in DROP_PARTS)
            and parts[0] not in OTHER_FIRST and parts[-1] not in OTHER_LAST)


class Element:
    """``parts``: strings and elements in page order; ``named`` and ``hinted``: a whole name, or a part of one,
    says that it is no main text. Known once it is closed: ``hash``, ``filled`` (has
    text), ``chars`` (characters of text that is not in a dropped tag), ``holds`` (an article), ``headed`` (has a heading)."""

    __slots__ = ("tag", "names", "drop", "named", "hinted", "parts", "hash", "filled", "chars", "holds", "headed")

    def __init__(self, tag: str, attrs: str):
        self.tag, self.names, self.parts, self.hash, self.filled = tag, "", [], 0, False
        self.drop, self.named, self.hinted, self.chars, self.holds, self.headed = tag in DROP_TAGS, tag == "form", False, 0, False, tag in HEADINGS
        if attrs and ("hidden" in attrs or "none" in attrs):
            self.drop |= bool(HIDDEN.search(QUOTED.sub("=x", attrs)) or "none" in attrs and HIDDEN.search(attrs) and "display" in attrs)
        if attrs and "=" in attrs and (tag == "header" or not self.drop):
            for m in ATTR.finditer(attrs):
                value = m[2] or m[3] or m[4] or ""
                self.names += f" {value}"
                if m[1].lower() == "role":
                    self.named |= value.strip().lower() in DROP_ROLES
                else:
                    self.named |= bool(DROP_NAMES.search(value))
                    self.hinted |= ("-" in value or "_" in value) and any(map(compound, value.lower().split()))

    def close(self) -> None:
        h = xxhash.xxh64(f"{self.tag}|{self.names}".encode("utf-8", "replace"))
        for x in self.parts:
            if isinstance(x, Element):
                h.update(x.hash.to_bytes(8, "little"))
                self.filled |= x.filled
                self.headed |= x.headed
                if not x.drop:
                    self.chars += x.chars
                    self.holds |= x.holds or x.tag in MAINS and x.filled
            elif x := " ".join(x.split()):
                h.update(x.encode("utf-8", "replace"))
                self.filled = True
                self.chars += len(x) - x.count(" ")
        self.hash = h.intdigest()


def parse(html: str) -> Element:
    root = Element("html", "")
    stack = [root]
    named: list[Element] = []
    headers: list[Element] = []
    at = 0
    end = len(html)

    def text(a: int, b: int) -> None:
        if a < b:
            stack[-1].parts.append(unescape(html[a:b]))

    def pop(k: int) -> None:
        while len(stack) > k:
            stack.pop().close()

    def innermost(tags, scope=()) -> int:
        """Place of the innermost open element of ``tags``, 0 if there is none within the scope."""
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in tags:
                return k
            if stack[k].tag in scope:
                return 0
        return 0

    while at < end:
        m = TAG.search(html, at)
        if not m:
            break
        text(at, m.start())
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if k := innermost({tag}):
                pop(k)
            continue
        if tag in ENDS_P and (k := innermost({"p"}, ("table", "button"))):
            pop(k)
        while (ends := ENDS_SIBLING.get(tag)) and (k := innermost(ends, SCOPES.get(tag, ()))):
            pop(k)
        if tag in ("html", "body"):
            continue
        element = Element(tag, m[3])
        stack[-1].parts.append(element)
        if element.named or element.hinted:
            named.append(element)
        if tag == "header" and any(x.tag == "article" for x in stack):
            headers.append(element)
        if tag in VOID:
            element.close()
            continue
        if tag in RAW:
            closing = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            if tag == "xmp":
                element.parts.append(html[at:closing.start() if closing else end])
            element.close()
            at = closing.end() if closing else end
            continue
        stack.append(element)
    text(at, end)
    pop(0)
    for e in headers:
        e.drop = not e.headed
    for e in named:
        e.drop |= e.tag not in MAINS and not e.holds and not (most(e, root) if e.named else e.chars >= LESS_SHARE * root.chars)
    return root


def most(e: Element, whole: Element) -> bool:
    return e.chars > MOST_SHARE * whole.chars


def container(root: Element) -> Element | None:
    """What stands for the article on a page without one: the innermost element with most of the text."""
    e = root
    while inner := next((x for x in e.parts if isinstance(x, Element) and not x.drop and most(x, root)), None):
        e = inner
    return None if e is root else e


def can_recur(e: Element, whole: Element | None, root: Element) -> bool:
    """Whether an element may be template; ``whole`` is the article that it is in."""
    return e.tag in BLOCKS and e.tag not in ("html", *MAINS) and (whole is None or e.tag in BOXES) and not most(e, whole or root)


def elements(root: Element, skip, main: Element | None = None):
    """All elements below ``root`` that are not in a subtree for which ``skip`` holds, with the outermost
    article (or ``main``) that they are in. In page order; without recursion, so depth does not matter."""
    todo: list = [(root, None)]
    while todo:
        e, whole = todo.pop()
        if skip(e):
            continue
        yield e, whole
        whole = whole or (e if e.tag in MAINS or e is main else None)
        todo += [(x, whole) for x in reversed(e.parts) if isinstance(x, Element)]


def articles(root: Element) -> list[Element]:
    return [e for e, _ in elements(root, lambda e: e.drop) if e.tag in MAINS and e.filled]


def candidates(html: str) -> list[tuple[bool, int, set[int]]]:
    """(inside, content, hashes) of the page and of each of its articles: hashes of the subtrees that may
    be template, blocks with text, and of the content that they are in."""
    root = parse(html)
    found: dict = {None: set()}
    for e, whole in elements(root, lambda e: False, None if articles(root) else container(root)):
        hashes = found.setdefault(whole and whole.hash, set())
        if e.filled and can_recur(e, whole, root):
            hashes.add(e.hash)
    return [(k is not None, root.hash if k is None else k, x) for k, x in found.items()]


def main_text(html: str, template) -> str:
    """Text of a page without the subtrees whose hash is in ``template``."""
    root = parse(html)

    def goes(e: Element, whole: Element | None) -> bool:
        return e.drop or e.hash in template and can_recur(e, whole, root)

    found = articles(root)
    main = None if found else container(root)
    todo: list = [(root, None)]
    if found:
        # an article within an article or main is part of it
        inner = {id(y) for e in found for y, _ in elements(e, lambda x: False) if y is not e}
        todo = [(e, None) for e in reversed(found) if id(e) not in inner]
    out: list[str] = []
    while todo:
        x, whole = todo.pop()
        if not isinstance(x, Element):
            out.append(x)
        elif not goes(x, whole):
            if x.tag in BLOCKS:
                out.append(" ")
                todo.append((" ", whole))
            whole = whole or (x if x.tag in MAINS or x is main else None)
            todo += [(y, whole) for y in reversed(x.parts)]
    return " ".join("".join(out).split())


def templates(pages: DataFrame, html: str = "html") -> DataFrame:
    """(host, hash): the template of every host."""
    def signed(h: int) -> int:
        return h - (1 << 64) if h >> 63 else h

    def make():
        def f(column):
            return pa.array([[{"inside": inside, "content": signed(c), "hashes": [signed(h) for h in hashes]} for inside, c, hashes in candidates(x or "")]
                             for x in column.to_pylist()], _ARROW_CONTENTS)
        return f

    rows = map_column(pages.select("host", html), html, "contents", CONTENTS, make).select("host", F.explode("contents").alias("c")).select("host", "c.*")
    rows = rows.groupBy("host", "inside", "content").agg(F.first("hashes").alias("hashes"))
    # a row without a hash for every content, so that one pass counts the contents too
    counted = (rows.select("host", "inside", F.explode(F.concat(F.array(F.lit(None).cast("long")), "hashes")).alias("hash"))
               .groupBy("host", "inside", "hash").agg(F.count("*").alias("n")))
    counted = stored(counted.where(F.col("hash").isNull() | (F.col("n") >= LEAST_PAGES)))
    contents_of = counted.where("hash is null").select("host", "inside", F.col("n").alias("contents"))
    return (counted.where("hash is not null").join(contents_of, ["host", "inside"]).where(F.col("n") >= LEAST_SHARE * F.col("contents"))
            .select("host", "hash").distinct())


def extract(pages: DataFrame, out: str, at_once: int = TEMPLATES_TO_SEND) -> DataFrame:
    """Pages (with columns host and html) with ``out``: struct(text, n_chars); html is dropped. Pages
    are not shuffled: the template goes to them. If it is larger than ``at_once`` hashes, it goes
    in parts, each with the pages of its hosts."""
    found = stored(templates(pages))
    many = found.count()
    parts = max(1, -(-many // at_once))
    kept = [f for f in pages.schema.fields if f.name != "html"]
    results = []
    for k in range(parts):
        mine = (lambda c: F.pmod(F.xxhash64(c), F.lit(parts)) == k) if parts > 1 else (lambda c: F.lit(True))
        by_host: dict[str, set[int]] = {}
        for r in found.where(mine("host")).toLocalIterator():
            by_host.setdefault(r["host"], set()).add(r["hash"] % (1 << 64))
        sent = pages.sparkSession.sparkContext.broadcast(by_host)
        names = pages.columns

        def run(batches, sent=sent, names=names):
            for b in batches:
                hosts, htmls = (b.column(names.index(c)).to_pylist() for c in ("host", "html"))
                texts = [main_text(x or "", sent.value.get(h, ())) for h, x in zip(hosts, htmls)]
                new = pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["text", "n_chars"])
                yield pa.RecordBatch.from_arrays([b.column(i) for i, c in enumerate(names) if c != "html"] + [new],
                                                 names=[c for c in names if c != "html"] + [out])

        results.append(pages.where(mine("host")).mapInArrow(run, T.StructType([*kept, T.StructField(out, RESULT)])))
    whole = results[0]
    for r in results[1:]:
        whole = whole.unionByName(r)
    return whole


def query(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    rows = pages.select("page_id", "url", "html", host_of("url").alias("host"))
    return extract(rows, "main").select("page_id", "url", "main.text", "main.n_chars")
