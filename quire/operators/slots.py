"""P1/P3 in one pass: the selectors of a rule set as one automaton that runs while a page is parsed.

A slot is a named ``Selector``. The slots that a rule set reads are compiled into a ``Machine``. Its
state is the set of ancestor rules matched by the open elements; its input is an element's tag with the
attributes that some test looks at. A transition gives the state below the element and the
slots that its text, its attributes or itself belong to. Transitions are worked out when they
are first met and then looked up, so an element costs one look-up, however many selectors there
are, and a page's text is kept only where a slot reads it.

``add_slots`` replaces the HTML column by a struct ``slots`` (a string for a first value, an array for
a list, a boolean for a test; NULL where the row's rule set does not read the slot) and ``parse_error``. It is
narrow (``mapInArrow``, no shuffle). A page that fails to parse keeps its row with ``slots`` NULL; a
NULL page has empty slots. Tree repair, JSON-LD and text nodes are those of
``quire.operators.html_nodes``."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quire.functions.selectors import ANCESTORS, Selector
from quire.operators.html_nodes import LD_TYPE, _rule_bits, _TreeBuilder, plain_json

#: Transitions that a machine keeps; it starts anew beyond.
KEPT_TRANSITIONS = 100_000
#: Characters of slot values that are turned into Arrow at once.
BATCH_CHARS = 8_000_000


class Machine:
    """The automaton of some slots (name -> selector)."""

    def __init__(self, slots: dict[str, Selector], rules: dict[str, tuple]):
        self.names, self.selectors = list(slots), list(slots.values())
        self.rules = list(rules.values())
        self.bit = {name: 1 << k for k, name in enumerate(rules)}
        read = set().union(*[s.test.reads() for s in self.selectors], {key for _, key, _ in self.rules if key}, {"type"})
        self.read = sorted(read)
        self.taken = {s.name for s in self.selectors if s.kind == "attr"}
        self.attributes = frozenset(read | self.taken)
        self.transitions: dict[tuple, tuple] = {}

    def step(self, above: int, tag: str, attrs: dict[str, str]) -> tuple[int, tuple, tuple, tuple, bool]:
        """(state below, slots of its text, (slot, attribute) pairs, slots that ask whether it is there,
        whether its text is skipped) of an element in a state."""
        key = (above, tag, *[attrs.get(a) for a in self.read]) if attrs else (above, tag)
        found = self.transitions.get(key)
        if found is None:
            if len(self.transitions) >= KEPT_TRANSITIONS:
                self.transitions.clear()
            found = self.transitions[key] = self._worked_out(above, tag, {a: attrs[a] for a in self.read if a in attrs})
        return found

    def _worked_out(self, above: int, tag: str, attrs: dict[str, str]) -> tuple:
        text, values, there = [], [], []
        for k, s in enumerate(self.selectors):
            if s.test.holds(tag, attrs):
                if s.kind == "exists":
                    there.append(k)
                elif s.kind == "attr":
                    values.append((k, s.name))
                elif s.ancestor is None or above & self.bit[s.ancestor]:
                    text.append(k)
        skipped = tag == "style" or tag == "script" and attrs.get("type") != LD_TYPE
        return above | _rule_bits(tag, attrs, self.rules), tuple(text), tuple(values), tuple(there), skipped


class _Reader(_TreeBuilder):
    """One page; ``stack`` holds (tag, state below, slots of the text, whether text is skipped)."""

    def __init__(self, machine: Machine):
        super().__init__([], machine.attributes)
        self.machine = machine
        self.firsts = [s.only_first for s in machine.selectors]
        self.values: list = [False if s.kind == "exists" else None if s.only_first else [] for s in machine.selectors]
        self.pieces: list[str] = []

    @property
    def text_node(self):
        return None

    @text_node.setter
    def text_node(self, _):
        # the tree builder ends a text node so
        if getattr(self, "pieces", None):
            self._take_text()

    def _put(self, k: int, value: str) -> None:
        if not self.firsts[k]:
            self.values[k].append(value)
        elif self.values[k] is None:
            self.values[k] = value

    def _enter(self, tag: str, attrs, push: bool) -> None:
        kept: dict[str, str] = {}
        for name, v in attrs:
            if name in self.kept_attrs and name not in kept:
                kept[name] = "" if v is None else v
        below, text, values, there, skipped = self.machine.step(self.stack[-1][1] if self.stack else 0, tag, kept)
        for k in there:
            self.values[k] = True
        for k, name in values:
            if name in kept:
                self._put(k, kept[name])
        if push:
            self.stack.append((tag, below, text, skipped))

    def handle_data(self, data):
        if self.stack and self.stack[-1][2] and not self.stack[-1][3]:
            self.pieces.append(data)

    def _take_text(self) -> None:
        text = "".join(self.pieces)
        self.pieces = []
        tag, _, slots, _ = self.stack[-1]
        if tag == "script":
            text = plain_json(text)
        for k in slots:
            self._put(k, text)

    def close(self):
        super().close()
        self.text_node = None


def read_page(html: str | None, machine: Machine) -> tuple[list | None, str | None]:
    """One page -> (slot values, error)."""
    try:
        reader = _Reader(machine)
        if html is not None:
            reader.feed(html)
            reader.close()
        return reader.values, None
    except Exception as e:  # a broken page keeps its row
        return None, str(e)[:200]


def slot_type(s: Selector) -> T.DataType:
    return T.BooleanType() if s.kind == "exists" else T.StringType() if s.only_first else T.ArrayType(T.StringType())


def add_slots(pages: DataFrame, slots_of: dict[str, dict[str, Selector]], html_col: str = "html", set_col: str = "rule_set") -> DataFrame:
    """Replace the HTML column by ``slots`` and ``parse_error``. ``slots_of``: the slots of each rule set (a
    slot has the same type in all of them)."""
    kinds: dict[str, Selector] = {}
    for slots in slots_of.values():
        for name, s in slots.items():
            if slot_type(kinds.setdefault(name, s)) != slot_type(s):
                raise ValueError(f"the slot {name} has two types")
    keep = [c for c in pages.columns if c != html_col]
    at, of = pages.columns.index(html_col), pages.columns.index(set_col)
    struct = T.StructType([T.StructField(n, slot_type(s)) for n, s in kinds.items()])
    schema = T.StructType([*[pages.schema[c] for c in keep], T.StructField("slots", struct), T.StructField("parse_error", T.StringType())])
    types = [pa.bool_() if s.kind == "exists" else pa.string() if s.only_first else pa.list_(pa.string()) for s in kinds.values()]
    names, rules = list(kinds), dict(ANCESTORS)  # as registered here, on the driver

    def run(batches):
        machines = {r: Machine(slots, rules) for r, slots in slots_of.items()}
        places = {r: [names.index(n) for n in m.names] for r, m in machines.items()}
        for batch in batches:
            others = [c for k, c in enumerate(batch.columns) if k != at]

            def part(start: int, columns: list[list], errors: list) -> pa.RecordBatch:
                n = len(errors)
                found = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names,
                                                   mask=pa.array([e is not None for e in errors], pa.bool_()))
                return pa.RecordBatch.from_arrays([*[c.slice(start, n) for c in others], found, pa.array(errors, pa.string())], names=[*keep, "slots", "parse_error"])

            start, size, columns, errors = 0, 0, [[] for _ in names], []
            for html, rule_set in zip(batch.column(at), batch.column(of).to_pylist()):
                html = html.as_py()
                values, error = read_page(html, machines[rule_set])
                row = [None] * len(names)
                for k, v in zip(places[rule_set], values or ()):
                    row[k] = v
                for c, v in zip(columns, row):
                    c.append(v)
                errors.append(error)
                size += len(html or "")
                if size >= BATCH_CHARS:
                    yield part(start, columns, errors)
                    start, size, columns, errors = start + len(errors), 0, [[] for _ in names], []
            yield part(start, columns, errors)

    return pages.mapInArrow(run, schema)
