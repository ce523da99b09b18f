"""The rule sets of the outlets, as registered data.

A rule set says which paragraphs are an article's text, which author and date fallbacks apply, when
a page is an article page, how an extraction is scored and which limits hold. The seven built-in
ones are registered below; ``register`` adds an outlet's own without a change to the package, and a
``Source`` of the registry names it. Fallback steps trigger on *raw absence* (an empty selector
result), not on failed cleaning.

``paragraphs`` and ``author`` give selectors, which the page reader runs; the other callables build
Columns over the slots of ``quire.operators.extract.add_slots`` (``h1``, ``og_type``, ``p_article``,
``p_site``, ``ldx`` ...). All run when a plan is built."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire import constants as C
from quire.functions import jsonld as J
from quire.functions import selectors as S
from quire.functions.text import bind, fox_promo_keep, nbc_promo_keep, normalize_paragraphs, normalize_ws

Build = Callable[[], Column]
Select = Callable[[], S.Selector]


def truthy(s: Column) -> Column:
    return F.coalesce(F.length(s) > 0, F.lit(False))


def nonempty(arr: Column) -> Column:
    return F.coalesce(F.size(arr) > 0, F.lit(False))


@dataclass(frozen=True, eq=False)
class RuleSet:
    """One outlet's rules. ``fields`` overrides the common fields (see ``common_fields``) by name;
    ``errors`` lists (test, message) with the tests no_paras, low, no_title and no_ld; ``urls``
    holds reject and accept patterns as in ``constants.SITE_URL_RULES``; ``ladder`` is as in
    ``constants.CONFIDENCE_LADDERS``. ``ancestors`` and ``attrs`` name the elements and attributes
    that its selectors read beyond the built-in ones."""
    name: str
    fields: Callable[[], dict[str, Column]]
    page_test: Build
    urls: tuple[list, list]
    ladder: tuple
    method: Build
    errors: tuple[tuple[str, str], ...] = ()
    paragraphs: Select | None = None     # slot p_site
    author: Select | None = None         # slot dom_author
    body_attr: str | None = None         # slot body_attr: this attribute of the body element
    ancestors: dict[str, tuple] = field(default_factory=dict)
    attrs: tuple[str, ...] = ()
    min_text: int = C.MIN_ARTICLE_TEXT_LENGTH
    summary_chars: int = C.SUMMARY_MAX_CHARS
    links_a_page: int = C.MAX_FOLLOW_PER_PAGE


RULE_SETS: dict[str, RuleSet] = {}


def register(rule_set: RuleSet) -> RuleSet:
    """Make a rule set known under its name (a later one of the same name takes its place)."""
    if rule_set.name == "generic":
        raise ValueError("the generic rule set is the one for hosts without an outlet")
    check_confidence(rule_set)
    for name, rule in rule_set.ancestors.items():
        S.add_ancestor(name, rule)
    S.KEPT_ATTRS.update(rule_set.attrs)
    RULE_SETS[rule_set.name] = rule_set
    return rule_set


def named(rule_sets=None) -> list[RuleSet]:
    """The site rule sets a plan needs: all that are registered, or those named."""
    if rule_sets is None:
        return list(RULE_SETS.values())
    unknown = set(rule_sets) - RULE_SETS.keys() - {"generic"}
    if unknown:
        raise ValueError(f"rule sets that are not registered: {sorted(unknown)}")
    return [r for r in RULE_SETS.values() if r.name in rule_sets]


def check_confidence(r: RuleSet) -> None:
    """every score a rule set can assign lies in [0, 1]; a bad ladder is not registered."""
    steps, fallback, cap = r.ladder
    for score in [s for _, _, s in steps] + [fallback] + ([cap] if cap is not None else []):
        if not 0.0 <= score <= 1.0:
            raise ValueError(f"Confidence must be between 0.0 and 1.0, got {score} (rule set {r.name})")


# ------------------------------------------------------------- parts that rule sets share


def first_ld(get) -> Column:
    """The first value that an article block of the page's JSON-LD has."""
    return J.first_present(F.col("ldx"), get)


def paragraphs_body(first: Column, second: Column) -> dict[str, Column]:
    """body and no_paras: the first non-empty selector list wins; blanks only give ""."""
    body = F.when(nonempty(first), normalize_paragraphs(first)).when(nonempty(second), normalize_paragraphs(second))
    return {"body": body, "no_paras": ~nonempty(first) & ~nonempty(second)}


def filtered_body(kept: Column, fallback: Column) -> dict[str, Column]:
    """Promo-filtered paragraphs if any survive, else the unfiltered list (evaluated once)."""
    return {
        "body": bind(kept, lambda k: F.when(nonempty(k), normalize_paragraphs(k)).when(nonempty(fallback), normalize_paragraphs(fallback))),
        "no_paras": bind(kept, lambda k: ~nonempty(k) & ~nonempty(fallback)),
    }


def clean(slot: str) -> Column:
    """The slot's text, normalized; NULL if it is empty or missing."""
    return F.when(truthy(F.col(slot)), normalize_ws(F.col(slot)))


def title_from_ld() -> Column:
    return F.coalesce(first_ld(lambda x: x["headline"]), normalize_ws(F.col("h1")))


def published_ld() -> Column:
    return first_ld(lambda x: F.when(x["pub"]["ts"].isNotNull() | x["pub"]["err"].isNotNull(), x["pub"]))


def meta_else_time() -> Column:
    return F.when(truthy(F.col("meta_pub")), F.col("meta_pub_ts")).otherwise(F.col("time_ts"))


def common_fields() -> dict[str, Column]:
    """What every rule set has unless its own fields say otherwise."""
    pub = published_ld()
    mod = first_ld(lambda x: F.when(x["mod"]["ts"].isNotNull() | x["mod"]["err"].isNotNull(), x["mod"]))
    return {
        "ld_any": nonempty(F.col("ld")), "ld_body": F.lit(False),
        "tags": first_ld(lambda x: F.when(nonempty(x["tags"]), x["tags"])),
        "section": first_ld(lambda x: x["section"]),
        "pub_err": pub["err"], "mod_err": mod["err"], "modified": mod["ts"],
    }


def og_article() -> Column:
    return F.coalesce(F.col("og_type") == "article", F.lit(False))


def og_or_element() -> Column:
    return og_article() | F.col("has_article")


def body_has(part: str) -> Build:
    return lambda: F.coalesce(F.col("body_attr").contains(part), F.lit(False))


def always(method: str) -> Build:
    return lambda: F.lit(method)


def by_ld(method: str) -> Build:
    """``method`` if the page has JSON-LD, else dom."""
    return lambda: F.when(~F.col("x_ld_any"), F.lit("dom")).otherwise(F.lit(method))


# ------------------------------------------------------------------ the built-in rule sets


def _ap() -> dict[str, Column]:
    ap = F.col("ldap")
    return {
        **paragraphs_body(F.col("p_site"), F.col("p_article")),
        "ld_any": ap.isNotNull(), "title": F.coalesce(ap["headline"], normalize_ws(F.col("h1"))),
        "author": F.coalesce(ap["author"], clean("meta_author")),
        "published": F.coalesce(ap["pub"]["ts"], F.col("meta_pub_ts")),
        "modified": ap["mod"]["ts"], "pub_err": ap["pub"]["err"], "mod_err": ap["mod"]["err"],
        "section": ap["section"], "tags": ap["tags"],
    }


def _bbc() -> dict[str, Column]:
    dom = F.when(truthy(F.col("meta_author")), clean("meta_author")).when(truthy(F.col("dom_author")), clean("dom_author"))
    none = F.lit(None).cast("string")
    return {
        **paragraphs_body(F.col("p_article"), F.col("p_site")),
        "title": F.coalesce(normalize_ws(F.col("h1")), normalize_ws(F.col("og_title"))),
        "author": F.coalesce(dom, first_ld(lambda x: x["author_simple"])),
        "published": F.when(truthy(F.col("time_dt")), F.col("time_ts")).otherwise(F.col("meta_pub_ts")),
        "modified": F.lit(None).cast("timestamp"), "mod_err": none, "pub_err": none,
    }


def _cbs() -> dict[str, Column]:
    from_ld = F.coalesce(F.exists("ldx", lambda x: x["has_body"]), F.lit(False))
    dom = paragraphs_body(F.col("p_site"), F.col("p_article"))
    return {
        "ld_body": from_ld, "title": title_from_ld(),
        "body": F.when(from_ld, first_ld(lambda x: F.when(x["has_body"], x["body"]))).otherwise(dom["body"]),
        "no_paras": ~from_ld & dom["no_paras"],
        "author": F.coalesce(first_ld(lambda x: x["author"]), clean("meta_author")),
        "published": F.coalesce(published_ld()["ts"], meta_else_time()),
    }


def _author_ld_dom_meta() -> Column:
    return F.coalesce(first_ld(lambda x: x["author"]),
                      F.when(truthy(F.col("dom_author")), clean("dom_author")).otherwise(clean("meta_author")))


def _cnn() -> dict[str, Column]:
    return {
        **paragraphs_body(F.col("p_article"), F.col("p_all")),
        "title": title_from_ld(), "author": _author_ld_dom_meta(),
        "published": F.coalesce(published_ld()["ts"], F.col("meta_pub_ts")),
    }


def _fox() -> dict[str, Column]:
    meta = F.when(truthy(F.col("meta_author")), clean("meta_author"))
    return {
        **filtered_body(fox_promo_keep(F.col("p_site")), F.col("p_article")),
        "title": normalize_ws(F.col("h1")),
        "author": F.coalesce(first_ld(lambda x: x["author_simple"]),
                             meta.otherwise(F.when(truthy(F.col("dom_author")), clean("dom_author")))),
        "published": F.coalesce(published_ld()["ts"], meta_else_time()),
        "tags": F.lit(None).cast("array<string>"),
    }


def _guardian() -> dict[str, Column]:
    return {
        **paragraphs_body(F.col("p_site"), F.col("p_article")),
        "title": title_from_ld(), "author": _author_ld_dom_meta(),
        "published": F.coalesce(published_ld()["ts"], F.col("time_ts")),
    }


def _nbc() -> dict[str, Column]:
    return {
        "body": filtered_body(nbc_promo_keep(F.col("p_article")), F.col("p_article"))["body"],
        "no_paras": ~nonempty(F.col("p_article")),
        "title": title_from_ld(),
        "author": F.coalesce(first_ld(lambda x: x["author"]), clean("meta_author")),
        "published": F.coalesce(published_ld()["ts"], F.col("meta_pub_ts")),
    }


_NO_PARAS, _LOW, _NO_TITLE = ("no_paras", C.ERR_NO_PARAGRAPHS), ("low", C.ERR_LOW_CONFIDENCE), ("no_title", C.ERR_NO_TITLE)


def _built_in(name: str, **rules) -> RuleSet:
    return register(RuleSet(name=name, urls=C.SITE_URL_RULES[name], ladder=C.CONFIDENCE_LADDERS[name], **rules))


_built_in(
    "ap", fields=_ap, page_test=lambda: og_article() | F.col("url").contains("/article/"),
    paragraphs=lambda: S.tag_texts("p", "ap_body"),
    method=lambda: F.when(F.col("x_ld_any") & truthy(F.col("x_body")), F.lit("hybrid")).otherwise(F.lit("dom")),
    errors=(_NO_PARAS, _LOW, ("no_title", C.ERR_AP_NO_TITLE)))
_built_in(
    "bbc", fields=_bbc, page_test=og_or_element, method=always("dom"), errors=(_NO_TITLE, _NO_PARAS, _LOW),
    paragraphs=lambda: S.tag_texts("p", "bbc_body"),
    author=lambda: S.first(S.texts(S.attr_contains("class", "byline"))))
_built_in(
    "cbs", fields=_cbs, page_test=og_or_element, errors=(_NO_PARAS, _LOW, ("no_ld", C.ERR_CBS_NO_LD)),
    paragraphs=lambda: S.tag_texts("p", "cbs_body"),
    method=lambda: F.when(~F.col("x_ld_any"), F.lit("dom")).when(F.col("x_ld_body"), F.lit("jsonld_full")).otherwise(F.lit("json-ld")))
_built_in(
    "cnn", fields=_cnn, page_test=body_has("article"), body_attr="data-page-type", method=by_ld("hybrid"),
    errors=(_NO_PARAS, _LOW, ("no_ld", C.ERR_CNN_NO_LD)),
    author=lambda: S.first(S.texts(S.attr_equals("data-testid", "byline"))))
_built_in(
    "fox", fields=_fox, page_test=body_has("fn article-single"), body_attr="class", method=always("dom"),
    errors=(_NO_TITLE, _NO_PARAS, _LOW), paragraphs=lambda: S.tag_texts("p", "fox_body"),
    author=lambda: S.first(S.texts(S.attr_contains("class", "author"))))
_built_in(
    "guardian", fields=_guardian, page_test=og_or_element, method=by_ld("json-ld"),
    errors=(_NO_PARAS, _LOW, ("no_ld", C.ERR_GUARDIAN_NO_LD)), paragraphs=lambda: S.tag_texts("p", "guardian_body"),
    author=lambda: S.first(S.texts(S.both(S.tag_is("a"), S.attr_equals("rel", "author")))))
_built_in(
    "nbc", fields=_nbc, page_test=og_or_element, method=always("hybrid"), errors=(_NO_PARAS, _LOW))

#: The built-in rule sets, by name.
SITE_SETS = list(RULE_SETS)
