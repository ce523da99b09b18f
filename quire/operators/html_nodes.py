"""HTML → node array, the one Python step.

Each page becomes ``nodes ARRAY<STRUCT<t, tag, attrs, text, parent, above>>`` in document order:
elements (``t`` false, their tag and the attributes selectors read) and text nodes (``t`` true,
the parent's tag and the raw text). ``parent`` is the 1-based position of the enclosing element
(0 at the top). ``above`` has one bit for each rule of ``selectors.ANCESTORS``: set on an
element (and on its text) if an element further up matches the rule. So a page's nodes take
memory in proportion to the page, however deep it nests. Every selector is a Catalyst
higher-order function over this array (``quire.functions.selectors``); nothing else runs in Python.

The step is narrow (``mapInArrow``, no shuffle), works on Arrow batches, and drops the HTML
column, so the large text never reaches a shuffle. A page that fails to parse keeps its row
with ``nodes`` NULL and the message in ``parse_error``.

Tree repair (stdlib ``html.parser`` only tokenizes): void elements never open; a new ``p``
or a block start closes an open ``p``; ``li``/``dt``/``dd``/``tr``/``td``/``th``/``option``
close their open siblings within their own list or table; an end tag closes up to its open
element and is ignored when none is open; script/style content is raw text; text that the
tokenizer delivers in pieces is one node (a comment between pieces splits it); an unknown
marked section is a comment; end of input closes everything.

JSON-LD scripts that JSON readers differ on (a repeated key, ``NaN``) are rewritten here: the last
value of a key counts, and such a number becomes its name as a string.
"""

from __future__ import annotations

import json
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quire.functions.selectors import ANCESTORS, KEPT_ATTRS

VOID = frozenset("area base br col embed hr img input keygen link meta param source track wbr".split())
P_CLOSERS = frozenset(
    "address article aside blockquote details dialog div dl fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
# a start tag closes these open elements, up to the container that bounds them
SIBLING_CLOSERS = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
LD_TYPE = "application/ld+json"

NODE_TYPE = T.StructType([
    T.StructField("t", T.BooleanType()),
    T.StructField("tag", T.StringType()),
    T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
    T.StructField("text", T.StringType()),
    T.StructField("parent", T.IntegerType()),
    T.StructField("above", T.LongType()),
])
NODES_TYPE = T.ArrayType(NODE_TYPE)

_ARROW_NODE = pa.struct([
    pa.field("t", pa.bool_()),
    pa.field("tag", pa.string()),
    pa.field("attrs", pa.map_(pa.string(), pa.string())),
    pa.field("text", pa.string()),
    pa.field("parent", pa.int32()),
    pa.field("above", pa.int64()),
])
_ARROW_NODES = pa.list_(_ARROW_NODE)

# nodes of a batch that are turned into Arrow at once
BATCH_NODES = 50_000


def _rule_bits(tag: str, attrs: dict[str, str], rules: list[tuple]) -> int:
    """One bit for each ancestor rule that the element matches."""
    bits = 0
    for i, (want_tag, key, value) in enumerate(rules):
        if want_tag is not None and tag != want_tag:
            continue
        if key == "class":
            ok = value in (attrs.get("class") or "").split()
        else:
            ok = key is None or attrs.get(key) == value
        bits |= ok << i
    return bits


def plain_json(text: str) -> str:
    """The script's JSON with one value for a key and without ``NaN``; as it is if that is so."""
    odd = False

    def pairs(items):
        nonlocal odd
        out = dict(items)
        odd |= len(out) < len(items)
        return out

    def constant(name):
        nonlocal odd
        odd = True
        return {"NaN": "nan", "Infinity": "inf", "-Infinity": "-inf"}[name]

    try:
        value = json.loads(text, object_pairs_hook=pairs, parse_constant=constant)
    except (ValueError, RecursionError):
        return text
    return json.dumps(value, ensure_ascii=False) if odd else text


class _TreeBuilder(HTMLParser):
    def __init__(self, rules: list[tuple], attrs: frozenset[str]):
        super().__init__(convert_charrefs=True)
        self.rules, self.kept_attrs = rules, attrs
        self.nodes: list[dict] = []
        # (tag, position, attributes, rules matched above, rules matched above or by itself)
        self.stack: list[tuple[str, int, dict, int, int]] = []
        self.text_node: dict | None = None

    def parse_marked_section(self, i, report=1):
        return self.parse_bogus_comment(i)

    def _pop_to(self, tag: str) -> None:
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                return

    def _close_siblings(self, closes, bounds) -> None:
        """Close the outermost open element that the new one ends, within its own container."""
        cut = None
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] in closes:
                cut = i
            elif self.stack[i][0] in bounds:
                break
        if cut is not None:
            del self.stack[cut:]

    def _open(self, tag: str, attrs, push: bool) -> None:
        self.text_node = None
        if tag in P_CLOSERS and any(s[0] == "p" for s in self.stack):
            self._pop_to("p")
        if tag in SIBLING_CLOSERS:
            self._close_siblings(*SIBLING_CLOSERS[tag])
        self._enter(tag, attrs, push and tag not in VOID)

    def _enter(self, tag: str, attrs, push: bool) -> None:
        kept: dict[str, str] = {}
        for k, v in attrs:
            if k in self.kept_attrs and k not in kept:
                kept[k] = "" if v is None else v
        parent, above = (self.stack[-1][1], self.stack[-1][4]) if self.stack else (0, 0)
        self.nodes.append({"t": False, "tag": tag, "attrs": list(kept.items()), "text": None, "parent": parent, "above": above})
        if push:
            self.stack.append((tag, len(self.nodes), kept, above, above | _rule_bits(tag, kept, self.rules)))

    def handle_starttag(self, tag, attrs):
        self._open(tag, attrs, True)

    def handle_startendtag(self, tag, attrs):
        # "<div/>" opens a div as in browsers; the tokenizer did not enter raw-text mode
        # for "<script/>", so that one stays closed
        self._open(tag, attrs, tag not in ("script", "style"))

    def handle_endtag(self, tag):
        self.text_node = None
        self._pop_to(tag)

    def handle_comment(self, data):
        self.text_node = None

    def handle_data(self, data):
        tag, parent, attrs, above, _ = self.stack[-1] if self.stack else (None, 0, {}, 0, 0)
        if tag == "style" or tag == "script" and attrs.get("type") != LD_TYPE:
            return
        if self.text_node is None:
            self.text_node = {"t": True, "tag": tag, "attrs": None, "text": [], "parent": parent, "above": above}
            self.nodes.append(self.text_node)
        self.text_node["text"].append(data)


def parse_nodes(html: str | None, rules: list[tuple] | None = None,
                attrs: frozenset[str] | None = None) -> tuple[list[dict] | None, str | None]:
    """One page → (nodes, error)."""
    if html is None:
        return [], None
    try:
        b = _TreeBuilder(list(ANCESTORS.values()) if rules is None else rules, KEPT_ATTRS if attrs is None else attrs)
        b.feed(html)
        b.close()
        for n in b.nodes:
            if n["t"]:
                n["text"] = "".join(n["text"])
                if n["tag"] == "script":
                    n["text"] = plain_json(n["text"])
        return b.nodes, None
    except Exception as e:  # a broken page keeps its row
        return None, str(e)[:200]


def _arrow_batches(batches, keep: list[str], rules: list[tuple], attrs: frozenset[str]):
    """Rows with their nodes; a batch whose pages hold many nodes is passed on in parts."""
    for batch in batches:
        columns = [batch.column(k) for k in keep]

        def part(start: int, nodes: list, errors: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [c.slice(start, len(nodes)) for c in columns] + [pa.array(nodes, type=_ARROW_NODES), pa.array(errors, type=pa.string())],
                names=keep + ["nodes", "parse_error"])

        start, held, nodes, errors = 0, 0, [], []
        for h in batch.column("html"):
            n, e = parse_nodes(h.as_py(), rules, attrs)
            nodes.append(n)
            errors.append(e)
            held += len(n or ())
            if held >= BATCH_NODES:
                yield part(start, nodes, errors)
                start, held, nodes, errors = start + len(nodes), 0, [], []
        yield part(start, nodes, errors)


def add_nodes(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Replace the HTML column by ``nodes`` and ``parse_error`` (narrow, no shuffle)."""
    keep = [c for c in pages.columns if c != html_col]
    src = pages.withColumnRenamed(html_col, "html") if html_col != "html" else pages
    schema = T.StructType([f for f in src.schema.fields if f.name != "html"]
                          + [T.StructField("nodes", NODES_TYPE), T.StructField("parse_error", T.StringType())])
    rules, attrs = list(ANCESTORS.values()), frozenset(KEPT_ATTRS)  # as registered here, on the driver
    return src.mapInArrow(lambda it: _arrow_batches(it, keep, rules, attrs), schema)
