"""CSS/XPath-style selectors: data that is compiled into the page reader or into Columns.

A ``Test`` is a condition on an element, a ``Selector`` what to take from the matching ones. The
page reader (``quire.operators.slots``) runs all selectors of a rule set in one pass while it
parses. ``Selector.column()`` is the same over the ``nodes`` column of ``quire.operators.html_nodes``:
there a text node's ``tag`` is its parent's tag, and its ``above`` says which ancestor rules match
further up, so ``X p::text`` is "text nodes whose parent is a ``p`` that has an ``X`` ancestor".
``.get()`` is the first match in document order, ``.getall()`` the list. Missing attributes are NULL,
as in XPath.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire import constants as C

NODES = "nodes"
WS = re.compile(r"[ \t\n\r\f]+")

#: Ancestor rules by name, in the order of their bits; attributes that the HTML step keeps. Rule sets
#: that are registered add theirs.
ANCESTORS: dict[str, tuple] = dict(C.ANCESTOR_RULES)
KEPT_ATTRS: set[str] = set(
    "class id href content name property itemprop itemtype data-component data-testid "
    "data-page-type rel type datetime".split())


def add_ancestor(name: str, rule: tuple) -> None:
    """An ancestor rule (tag or None, attribute or None, value); 63 at most, a bit each."""
    if ANCESTORS.get(name, rule) != rule:
        raise ValueError(f"another ancestor rule has the name {name}")
    if name not in ANCESTORS and len(ANCESTORS) >= 63:
        raise ValueError("there are 63 ancestor rules already")
    ANCESTORS[name] = rule
    if rule[1]:
        KEPT_ATTRS.add(rule[1])


def _nodes() -> Column:
    return F.col(NODES)


def at(i: Column) -> Column:
    """Node at a 1-based position (NULL when out of range)."""
    return F.try_element_at(_nodes(), i)


def attr(n: Column, name: str) -> Column:
    return F.try_element_at(n["attrs"], F.lit(_known(name)))


def parent(n: Column) -> Column:
    return at(F.nullif(n["parent"], F.lit(0)))


def has_ancestor_of_parent(n: Column, rule: str) -> Column:
    """For a text node: does its parent element have an ancestor matching the ancestor rule?"""
    return n["above"].bitwiseAND(F.lit(1 << list(ANCESTORS).index(rule)).cast("long")) != 0


# ---- element tests ----------------------------------------------------------------


@dataclass(frozen=True)
class Test:
    """A condition on an element: ``tag``, ``class`` (a whole token of the class attribute), ``contains``
    or ``equals`` (an attribute's value), ``all`` or ``any`` of ``parts``."""
    kind: str
    name: str = ""
    value: str = ""
    parts: tuple[Test, ...] = ()

    def __call__(self, e: Column) -> Column:
        """Over a node; NULL counts as false where it is used."""
        if self.kind == "tag":
            return e["tag"] == self.value
        if self.kind == "class":
            return F.array_contains(F.split(F.coalesce(attr(e, "class"), F.lit("")), WS.pattern), self.value)
        if self.kind == "contains":
            return F.coalesce(attr(e, self.name).contains(self.value), F.lit(False))
        if self.kind == "equals":
            return F.coalesce(attr(e, self.name) == self.value, F.lit(False))
        out = self.parts[0](e)
        for p in self.parts[1:]:
            out = out & p(e) if self.kind == "all" else out | p(e)
        return out

    def reads(self) -> set[str]:
        """The attributes that the test looks at."""
        own = {"class"} if self.kind == "class" else {self.name} if self.kind in ("contains", "equals") else set()
        return own.union(*[p.reads() for p in self.parts])

    def holds(self, tag: str, attrs: dict[str, str]) -> bool:
        if self.kind == "tag":
            return tag == self.value
        if self.kind == "class":
            return self.value in WS.split(attrs.get("class") or "")
        if self.kind == "contains":
            return self.value in attrs.get(self.name, "") if self.name in attrs else False
        if self.kind == "equals":
            return attrs.get(self.name) == self.value
        return (all if self.kind == "all" else any)(p.holds(tag, attrs) for p in self.parts)


def _known(name: str) -> str:
    if name not in KEPT_ATTRS:
        raise ValueError(f"the HTML step does not keep the attribute {name}; list it in the rule set's attrs")
    return name


def tag_is(name: str) -> Test:
    return Test("tag", value=name)


def class_token(token: str) -> Test:
    """``.token``: the class attribute contains the whole token."""
    return Test("class", value=token)


def attr_contains(name: str, part: str) -> Test:
    """``[name*=part]``: substring test."""
    return Test("contains", _known(name), part)


def attr_equals(name: str, value: str) -> Test:
    return Test("equals", _known(name), value)


def both(*tests: Test) -> Test:
    return Test("all", parts=tests)


def either(*tests: Test) -> Test:
    return Test("any", parts=tests)


# ---- selectors --------------------------------------------------------------------


@dataclass(frozen=True)
class Selector:
    """What is taken from the elements that pass ``test``: the direct ``text`` nodes (with ``ancestor``, only
    of elements below one that matches this ancestor rule), the values of the attribute ``name``
    (``attr``), or whether there is one (``exists``). ``only_first``: the first value, not the list."""
    kind: str
    test: Test
    name: str = ""
    ancestor: str | None = None
    only_first: bool = False

    def __post_init__(self):
        if self.ancestor is not None and self.ancestor not in ANCESTORS:
            raise ValueError(f"no ancestor rule has the name {self.ancestor}")

    def column(self) -> Column:
        """The selector over the ``nodes`` column."""
        if self.kind == "exists":
            return F.exists(_nodes(), lambda n: ~n["t"] & F.coalesce(self.test(n), F.lit(False)))
        if self.kind == "text":
            found = F.transform(F.filter(_nodes(), self._is_text), lambda n: n["text"])
        else:
            elements = F.filter(_nodes(), lambda n: ~n["t"] & F.coalesce(self.test(n), F.lit(False)))
            found = F.transform(F.filter(elements, lambda e: attr(e, self.name).isNotNull()), lambda e: attr(e, self.name))
        return F.try_element_at(found, F.lit(1)) if self.only_first else found

    def _is_text(self, n: Column) -> Column:
        # a text node has its parent's tag, so a test of the tag alone needs no look-up
        of = n["tag"] == self.test.value if self.test.kind == "tag" else F.coalesce(self.test(parent(n)), F.lit(False))
        return n["t"] & of if self.ancestor is None else n["t"] & of & has_ancestor_of_parent(n, self.ancestor)


def texts(parent_test: Test, ancestor: str | None = None) -> Selector:
    """All direct text nodes of elements matching ``parent_test`` (optionally below an
    element of an ancestor rule), in document order."""
    return Selector("text", parent_test, ancestor=ancestor)


def tag_texts(tag: str, ancestor: str | None = None) -> Selector:
    """``h1::text``, ``p::text``."""
    return texts(tag_is(tag), ancestor)


def first(selector: Selector) -> Selector:
    return replace(selector, only_first=True)


def exists_element(test: Test) -> Selector:
    return Selector("exists", test)


def attr_values(test: Test, name: str) -> Selector:
    """``sel::attr(name)`` / ``sel/@name`` for every matching element that has the attribute."""
    return Selector("attr", test, _known(name))


def first_attr(test: Test, name: str) -> Selector:
    return first(attr_values(test, name))


def meta_content(key: str, value: str) -> Selector:
    """``//meta[@key='value']/@content``, first match."""
    return first_attr(both(tag_is("meta"), attr_equals(key, value)), "content")


def hrefs() -> Selector:
    """Every ``a/@href`` in document order."""
    return attr_values(tag_is("a"), "href")


def ld_scripts() -> Selector:
    """Texts of ``script[type="application/ld+json"]`` (the HTML step keeps no other script text)."""
    return tag_texts("script")
