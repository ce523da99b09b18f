"""Page classification and article extraction (F11-F20, P4-P24) as staged projections.

Input: routed pages with ``html`` and ``rule_set``. The job is narrow end to end (no shuffle): stage 1
reads the slots of a page's rule set while the page is parsed (``quire.operators.slots``), stage 2 the page verdict,
stage 3 the extracted fields, stage 4 score/method/errors, stage 5 the article row.

What differs between outlets is registered data (``quire.operators.rule_sets``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire import constants as C
from quire.functions import jsonld as J
from quire.functions import selectors as S
from quire.functions.dates import meta_datetime, meta_datetime_text, utc_string
from quire.functions.text import (content_gate, content_length, fingerprint, low_quality_to_null, normalize_paragraphs,
                                  normalize_ws, py_strip, add_summary, truncated_summary)
from quire.functions.urls import article_path_rule, url_rule
from quire.operators.slots import add_slots as read_slots
from quire.operators.rule_sets import SITE_SETS, RuleSet, common_fields, named, nonempty as _nonempty, truthy as _truthy  # noqa: F401

_MEMO: dict = {}


def _memo(key, build):
    """Reuse a built Column within one SparkContext: building the large extraction
    expressions costs seconds of Python-to-JVM calls, and they depend only on ``key``."""
    from pyspark import SparkContext
    sc = SparkContext._active_spark_context
    k = (sc.applicationId if sc is not None else None, key)
    if k not in _MEMO:
        _MEMO[k] = build()
    return _MEMO[k]


def _case(rules: list[RuleSet], build, default=None) -> Column:
    """``build(rule)`` of the row's rule set; rules for which it gives the same callable or value
    share a branch, those for which it gives None have none."""
    branches: dict = {}
    for r in rules:
        if (value := build(r)) is not None:
            branches.setdefault(id(value), (value, []))[1].append(r.name)
    expr = None
    for value, names in branches.values():
        cond = F.col("rule_set").isin(*names) if len(names) > 1 else F.col("rule_set") == names[0]
        value = value if isinstance(value, Column) else value()
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    if expr is None:
        return default if default is not None else F.lit(None)
    return expr if default is None else expr.otherwise(default)


def _limit(rules: list[RuleSet], name: str, default: int) -> Column | int:
    """A limit by the row's rule set; a plain number where all agree."""
    other = [r for r in rules if getattr(r, name) != default]
    return _case(other, lambda r: F.lit(getattr(r, name)), F.lit(default)) if other else default


# ----------------------------------------------------------------------- stage 1: slots


def common_slots() -> dict[str, S.Selector]:
    """What every rule set reads."""
    return {
        "ld_scripts": S.ld_scripts(),
        "h1": S.first(S.tag_texts("h1")),
        "og_type": S.meta_content("property", "og:type"),
        "og_title": S.meta_content("property", "og:title"),
        "meta_author": S.meta_content("name", "author"),
        "meta_pub": S.meta_content("property", "article:published_time"),
        "time_dt": S.first_attr(S.tag_is("time"), "datetime"),
        "has_article": S.exists_element(S.tag_is("article")),
        "p_article": S.tag_texts("p", "article"),
        "base_href": S.first_attr(S.tag_is("base"), "href"),
        "hrefs": S.hrefs(),
    }


def own_slots(rule: RuleSet | None) -> dict[str, S.Selector]:
    """What a rule set reads beyond that; None is the generic one."""
    if rule is None:
        boxes = [S.both(S.tag_is("div"), S.attr_contains("class", c)) for c in C.ARTICLE_BODY_CLASSES]
        return {"p_all": S.tag_texts("p"), "has_body_class": S.exists_element(S.either(*boxes, S.attr_contains("itemtype", "Article"))),
                "meta_article_author": S.meta_content("property", "article:author"), "meta_byl": S.meta_content("name", "byl")}
    out = {} if rule.name in SITE_SETS and rule.name != "cnn" else {"p_all": S.tag_texts("p")}
    for slot, build in (("p_site", rule.paragraphs), ("dom_author", rule.author)):
        if build is not None:
            out[slot] = build()
            if not isinstance(out[slot], S.Selector):
                raise ValueError(f"the rule set {rule.name} gives no Selector for its slot {slot}")
    if rule.body_attr:
        out["body_attr"] = S.first_attr(S.tag_is("body"), rule.body_attr)
    return out


#: Slots that only some rule sets have, with their types.
OWN_SLOTS = {"p_all": "array<string>", "p_site": "array<string>", "dom_author": "string", "body_attr": "string",
             "has_body_class": "boolean", "meta_article_author": "string", "meta_byl": "string"}


def add_slots(df: DataFrame, rule_sets=None) -> DataFrame:
    """The HTML column replaced by what the row's rule set reads from the page, and ``parse_error``. Requires
    ``html``, ``rule_set``, ``url``."""
    sets = {r.name: {**common_slots(), **own_slots(r)} for r in named(rule_sets)} | {"generic": {**common_slots(), **own_slots(None)}}
    kept = [c for c in df.columns if c != "html"]
    df = read_slots(df, sets)
    there = set().union(*sets.values())
    own = [F.col(f"slots.{c}") if c in there else F.lit(None).cast(t).alias(c) for c, t in OWN_SLOTS.items()]
    return df.select(*kept, "parse_error", *[f"slots.{c}" for c in common_slots()], *own,
                     _memo("ld", lambda: J.blocks(F.col("slots.ld_scripts"))).alias("ld"))


def add_ld_fields(df: DataFrame) -> DataFrame:
    """P4-P7 once per page: ``ldx`` = fields of the Article/NewsArticle blocks, ``ldap`` =
    fields of the first NewsArticle block; plus parsed meta/time dates (X7)."""
    types = ", ".join(f"'{t}'" for t in C.LD_ARTICLE_TYPES)
    kind = J.get_text("b", "@type")
    wanted = f"coalesce({J.type_text(kind)} = 'STRING' AND {J.string_text(kind)} IN ({types}), false)"
    ld_all = F.expr(f"CASE WHEN size(ld) > 0 THEN transform(filter(ld, b -> {wanted}), b -> {J.article_fields_text('b', meta_datetime_text)}) END")
    df = df.select(
        "*",
        ld_all.alias("ld_all"),
        F.when(_truthy(F.col("meta_pub")), meta_datetime(F.col("meta_pub"))).alias("meta_pub_ts"),
        F.when(_truthy(F.col("time_dt")), meta_datetime(F.col("time_dt"))).alias("time_ts"),
    )
    return df.select("*", F.col("ld_all").alias("ldx"),
                     F.try_element_at(F.filter(F.col("ld_all"), lambda x: x["type"] == "NewsArticle"), F.lit(1)).alias("ldap"))


# ----------------------------------------------------------------------- stage 2: page test


def add_url_flag(df: DataFrame, path_col: str = "url_path", rule_sets=None) -> DataFrame:
    """F3/F4-F10 by the row's rule set. Needs ``url`` and the lower-cased path in ``path_col``."""
    return df.withColumn("url_is_article", url_flag(F.col("url"), F.col(path_col), rule_sets))


def url_flag(u: Column, path: Column, rule_sets=None) -> Column:
    """F3-F10 of a URL and its lower-cased path by the row's rule set."""
    flag = _case(named(rule_sets), lambda r: url_rule(u, *r.urls), article_path_rule(path))
    return F.coalesce(flag, F.lit(False))


def follow_limit() -> Column | int:
    """How many accepted links of a page are followed, by the row's rule set."""
    return _limit(named(), "links_a_page", C.MAX_FOLLOW_PER_PAGE)


def add_page_flag(df: DataFrame, path_col: str = "url_path", rule_sets=None) -> DataFrame:
    """Is this an article page? Site tests first, then the generic test F12."""
    path = F.col(path_col)
    og_article = F.coalesce(F.col("og_type") == "article", F.lit(False))
    ld_article = F.exists(F.col("ld"), lambda b: J.type_is(b, C.LD_ARTICLE_TYPES))
    site = _case(named(rule_sets), lambda r: r.page_test, F.lit(False))
    feed_type = F.coalesce(F.lower(F.col("content_type")).rlike("xml|json"), F.lit(False))
    generic = (
        F.when(feed_type, False)
        .when(~F.col("url_is_article"), False)
        .when(ld_article | og_article | F.col("has_article") | F.coalesce(F.col("has_body_class"), F.lit(False)), True)
        .when(path.contains("/article/") | path.contains("/articles/"), True)
        .when(path.rlike(r"/[0-9]{4}/[0-9]{2}/[0-9]{2}/.+"), True)
        .otherwise(False)
    )
    # a page that cannot be parsed is an article page if its URL is one's: its failure row is kept
    return df.withColumn("is_article_page", F.when(F.col("parse_error").isNotNull(), F.col("url_is_article"))
                         .otherwise(site | generic))


# ----------------------------------------------------------------------- stage 3: fields


FIELDS = {"title": "string", "body": "string", "author": "string", "published": "timestamp",
          "modified": "timestamp", "section": "string", "tags": "array<string>", "no_paras": "boolean",
          "ld_any": "boolean", "ld_body": "boolean", "pub_err": "string", "mod_err": "string"}


def add_site_fields(df: DataFrame, rule_sets=None) -> DataFrame:
    """P5-P14 raw fields ``x_*`` for article pages of the site rule sets."""
    rules = named(rule_sets)
    fields = {r: _memo(("site_fields", r), lambda r=r: {**common_fields(), **r.fields()}) for r in rules}
    return df.select("*", *[_case(rules, lambda r: fields[r][k].cast(t)).cast(t).alias("x_" + k) for k, t in FIELDS.items()])


# ----------------------------------------------------------------------- stage 4: score


def _ladder(r: RuleSet) -> tuple[Column, Column]:
    """(confidence, low) for a rule set: first ladder step whose parts are present; the
    fallback score otherwise (low=True), then the cap."""
    c = F.col
    has = {"ld": c("x_ld_any"), "ldbody": c("x_ld_body"), "title": _truthy(c("x_title")),
           "author": _truthy(c("x_author")), "body": _truthy(c("x_body"))}
    steps, fallback, cap = r.ladder
    expr = None
    for needs, gt, score in steps:
        cond = F.lit(True)
        for n in needs:
            cond = cond & has[n]
        if gt is not None:
            cond = cond & (F.length(c("x_body")) > gt)
        expr = F.when(cond, F.lit(score)) if expr is None else expr.when(cond, F.lit(score))
    conf = expr.otherwise(F.lit(fallback))
    if cap is not None:
        conf = F.least(conf, F.lit(cap))
    return conf, expr.isNull()


def _errors(r: RuleSet, low: Column) -> Column:
    tests = {"no_paras": F.col("x_no_paras"), "low": low, "no_title": ~_truthy(F.col("x_title")), "no_ld": ~F.col("x_ld_any")}
    said = [F.when(tests[test], F.lit(message)) for test, message in r.errors]
    return F.filter(F.array(*said).cast("array<string>"), lambda e: e.isNotNull())


def add_site_score(df: DataFrame, rule_sets=None) -> DataFrame:
    """P16/P17 + method; the struct ``x`` is the extracted article (F27: score in [0, 1])."""
    rules = named(rule_sets)
    ladders = {r: _ladder(r) for r in rules}
    fail = F.coalesce(F.col("x_pub_err"), F.col("x_mod_err"))
    return df.select(
        "*",
        F.struct(
            F.col("x_title").alias("title"), F.col("x_body").alias("body"), F.col("x_author").alias("author"),
            F.col("x_published").alias("published_at"), F.col("x_modified").alias("modified_at"),
            F.col("x_section").alias("section"),
            F.coalesce(F.col("x_tags"), F.array().cast("array<string>")).alias("tags"),
            _case(rules, lambda r: r.method).cast("string").alias("extraction_method"),
            _case(rules, lambda r: ladders[r][0]).cast("double").alias("confidence"),
            _case(rules, lambda r: _errors(r, ladders[r][1])).cast("array<string>").alias("errors"),
            fail.alias("fail"),
        ).alias("x"))


# ----------------------------------------------------------------------- stage 5: rows

ARTICLE_COLUMNS = ["title", "author", "text", "summary", "url", "source", "published_at", "scraped_at",
                   "url_hash", "fingerprint", "author_source", "summary_max_chars", "summary_truncated",
                   "parse_ok", "parse_error", "extraction_method", "content_length_chars"]


def _verdict(title: Column, text: Column, n: Column, conf: Column, errors: Column, least: Column) -> tuple[Column, Column]:
    """(parse_ok, parse_error)."""
    short = F.format_string(C.VERDICT_TEXT_SHORT.replace("{n}", "%d").replace("{min}", "%d"), n,
                            least)
    err = (F.when(~_truthy(title), F.lit(C.VERDICT_NO_TITLE))
           .when(text.isNull() | (F.length(text) < least), short)
           .when(conf < C.LOW_CONFIDENCE, F.format_string(C.VERDICT_LOW_CONF.replace("{c}", "%.2f"), conf))
           .when(F.size(errors) > 0, F.array_join(F.slice(errors, 1, C.MAX_ERRORS_IN_VERDICT), "; ")))
    ok = ~_truthy(title) | text.isNull() | (F.length(text) < least) | (conf < C.LOW_CONFIDENCE)
    return ~ok, err


def _site_prepare(df: DataFrame, rules: list[RuleSet]) -> DataFrame:
    x = F.col("x")
    site = F.col("rule_set") != "generic"
    df = df.select("*", F.when(site, normalize_ws(x["title"])).alias("a_title"),
                   F.when(site, normalize_ws(x["body"])).alias("a_text"),
                   F.when(site, utc_string(x["published_at"])).alias("a_pub"),
                   F.when(site, x["body"]).alias("a_body"))
    return add_summary(df, "a_body", "a_summary", "a_trunc", _limit(rules, "summary_chars", C.SUMMARY_MAX_CHARS))


def _site_columns(rules: list[RuleSet]) -> dict[str, Column]:
    """Article columns for pages of a site rule set."""
    x, c = F.col("x"), F.col
    failed = c("parse_error").isNotNull() | x["fail"].isNotNull()
    fail_msg = F.concat(F.lit(C.EXTRACTOR_FAILED), F.substring(F.coalesce(c("parse_error"), x["fail"]), 1, 200))
    ok, err = _verdict(c("a_title"), c("a_text"), content_length(c("a_text")), x["confidence"], x["errors"],
                       F.lit(_limit(rules, "min_text", C.MIN_ARTICLE_TEXT_LENGTH)))
    null_s = F.lit(None).cast("string")
    return {
        "title": F.when(failed, null_s).otherwise(c("a_title")),
        "author": F.when(failed, null_s).otherwise(x["author"]),
        "text": F.when(failed, null_s).otherwise(c("a_text")),
        "summary": F.when(failed, null_s).otherwise(c("a_summary")),
        "published_at": F.when(failed, null_s).otherwise(c("a_pub")),
        "fingerprint": F.when(failed, fingerprint(null_s, null_s, null_s, c("source")))
        .otherwise(fingerprint(c("a_title"), c("a_text"), c("a_pub"), c("source"))),
        "author_source": F.when(failed | ~_truthy(x["author"]), F.lit(C.AUTHOR_MISSING)).otherwise(x["extraction_method"]),
        "summary_truncated": F.when(failed, F.lit(False)).otherwise(c("a_trunc")),
        "parse_ok": F.when(failed, F.lit(False)).otherwise(ok),
        "parse_error": F.when(failed, fail_msg).otherwise(err),
        "extraction_method": F.when(failed, F.lit(C.METHOD_FAILED)).otherwise(x["extraction_method"]),
        "content_length_chars": F.when(failed, F.lit(0)).otherwise(content_length(c("a_text"))),
    }


def _generic_prepare(df: DataFrame) -> DataFrame:
    c = F.col
    gen = c("rule_set") == "generic"
    h1_ok = _truthy(py_strip(c("h1")))
    df = df.select("*",
                   F.when(gen, F.when(h1_ok, c("h1")).otherwise(c("og_title"))).alias("g_title_raw"),
                   F.when(gen, F.when(_nonempty(c("p_article")), normalize_paragraphs(c("p_article")))
                          .otherwise(normalize_paragraphs(F.coalesce(c("p_all"), F.array().cast("array<string>")))))
                   .alias("g_text_raw"),
                   F.when(gen, utc_string(F.when(_truthy(c("meta_pub")), c("meta_pub_ts"))
                                          .otherwise(c("time_ts")))).alias("g_pub"))
    df = df.select("*", content_gate(c("g_title_raw"), c("g_text_raw")).alias("g_gate"),
                   normalize_ws(c("g_title_raw")).alias("g_title"),
                   low_quality_to_null(normalize_ws(c("g_text_raw"))).alias("g_text"),
                   F.when(gen, J.first_present(J.top_objects(F.col("ld_scripts")), _generic_ld_author)).alias("g_ld_author"))
    # A summary that came with the page counts if it is long enough, and is not cut to sentences
    given = F.when(gen, py_strip(c("feed_summary"))) if "feed_summary" in df.columns else F.lit(None).cast("string")
    given = F.when(F.length(given) >= C.SUMMARY_FALLBACK_MIN, normalize_ws(given))
    df = df.withColumn("g_sum_src", py_strip(c("g_text_raw"))).withColumn("g_given", given)
    df = add_summary(df, "g_sum_src", "g_text_summary", "g_text_trunc")
    cut, long = truncated_summary(c("g_given")), F.length(c("g_given")) > C.SUMMARY_MAX_CHARS
    return df.select("*", F.coalesce(cut, c("g_text_summary")).alias("g_summary"),
                     F.coalesce(long, c("g_text_trunc")).alias("g_trunc"))


def _generic_ld_author(b: Column) -> Column:
    """JSON-LD step of the generic author chain: taken as written (not cleaned)."""
    def name_of(e: Column) -> Column:
        return F.when(J.vtype(e) == "STRING", J.as_string(e)) \
            .when(J.is_object(e) & J.truthy(J.get(e, "name")), J.as_string(J.get(e, "name")))
    return J.let(J.get(b, "author"), lambda a: F.when(J.truthy(a), (
        F.when(J.vtype(a) == "STRING", J.as_string(a))
        .when(J.vtype(a) == "OBJECT", F.when(J.truthy(J.get(a, "name")), J.as_string(J.get(a, "name"))))
        .when(J.vtype(a) == "ARRAY", F.nullif(F.array_join(F.filter(F.transform(
            F.try_variant_get(a, "$", "array<variant>"), name_of), lambda v: v.isNotNull()), ", "), F.lit(""))))))


def _generic_columns() -> dict[str, Column]:
    """Article columns for pages of the generic rule set.

    Content slots (our rule, standing in for a third-party article parser): title = first
    ``h1`` text, else ``og:title``; text = ``article p`` paragraphs, else all ``p``;
    published = ``article:published_time`` meta, else first ``time/@datetime``."""
    c = F.col
    strip_ok = lambda s: F.when(_truthy(py_strip(s)), py_strip(s))
    byl = strip_ok(c("meta_byl"))
    byl = F.when(F.lower(byl).startswith("by "), F.substring(byl, 4, 1 << 30)).otherwise(byl)
    pair = lambda a, s: F.struct(a.alias("a"), F.lit(s).alias("s"))
    chain = F.coalesce(
        F.when(_truthy(py_strip(c("feed_author"))), pair(py_strip(c("feed_author")), C.AUTHOR_FEED)),
        F.when(strip_ok(c("meta_author")).isNotNull(), pair(strip_ok(c("meta_author")), C.AUTHOR_META)),
        F.when(strip_ok(c("meta_article_author")).isNotNull(), pair(strip_ok(c("meta_article_author")), C.AUTHOR_META)),
        F.when(byl.isNotNull(), pair(byl, C.AUTHOR_META)),
        F.when(c("g_ld_author").isNotNull(), pair(c("g_ld_author"), C.AUTHOR_META)),
        pair(F.lit(None).cast("string"), C.AUTHOR_MISSING),
    )
    failed = c("parse_error").isNotNull()
    bad = failed | ~c("g_gate")
    null_s = F.lit(None).cast("string")
    return {
        "title": F.when(failed, null_s).otherwise(c("g_title")),
        "author": F.when(bad, null_s).otherwise(chain["a"]),
        "text": F.when(bad, null_s).otherwise(c("g_text")),
        "summary": F.when(bad, null_s).otherwise(c("g_summary")),
        "published_at": F.when(failed, null_s).otherwise(c("g_pub")),
        "fingerprint": F.when(failed, fingerprint(null_s, null_s, null_s, c("source")))
        .when(~c("g_gate"), fingerprint(c("g_title"), null_s, c("g_pub"), c("source")))
        .otherwise(fingerprint(c("g_title"), c("g_text"), c("g_pub"), c("source"))),
        "author_source": F.when(bad, F.lit(C.AUTHOR_MISSING)).otherwise(chain["s"]),
        "summary_truncated": F.when(bad, F.lit(False)).otherwise(c("g_trunc")),
        "parse_ok": F.when(bad, F.lit(False)).otherwise(F.lit(True)),
        "parse_error": F.when(failed, F.concat(F.lit(C.PARSE_FAILED), F.substring(c("parse_error"), 1, 200)))
        .when(~c("g_gate"), F.lit(C.GENERIC_GATE_FAILED)),
        "extraction_method": F.lit(C.METHOD_GENERIC),
        "content_length_chars": F.when(bad, F.lit(0)).otherwise(content_length(c("g_text"))),
    }


def article_rows(df: DataFrame, run_ts: str, extra: tuple[str, ...] = ("source_name", "page_id", "rule_set"),
                 rule_sets=None) -> DataFrame:
    """ARTICLES rows for classified article pages: one projection, the row's rule set picks
    the site mapping (P18) or the generic one (P21). ``rule_sets`` limits the plan to the rule
    sets the registry uses (all by default)."""
    df = add_site_fields(add_ld_fields(df), rule_sets)
    rules = named(rule_sets)
    df = _generic_prepare(_site_prepare(add_site_score(df, rule_sets), rules))
    site, gen = _site_columns(rules), _generic_columns()
    is_gen = F.col("rule_set") == "generic"
    fixed = {"url": F.col("url"), "source": F.col("source"), "scraped_at": F.lit(run_ts),
             "url_hash": F.col("url_hash"), "summary_max_chars": F.lit(_limit(rules, "summary_chars", C.SUMMARY_MAX_CHARS))}
    cols = []
    for name in ARTICLE_COLUMNS:
        col = fixed[name] if name in fixed else F.when(is_gen, gen[name]).otherwise(site[name])
        cols.append(col.alias(name))
    return df.select(*cols, *[c for c in extra if c in df.columns])


def extracted_rows(df: DataFrame, extra: tuple[str, ...] = (), rule_sets=None) -> DataFrame:
    """EXTRACTED: what a site rule set read from each classified article page, before it is mapped to
    an article row: section, tags, confidence and errors are kept here."""
    df = add_site_score(add_site_fields(add_ld_fields(df.where(F.col("rule_set") != "generic")), rule_sets), rule_sets)
    x = F.col("x")
    as_is = ("title", "body", "author", "section", "tags", "extraction_method", "confidence", "errors", "fail")
    return df.select(*extra, "url", "url_hash", *[x[c].alias(c) for c in as_is],
                     utc_string(x["published_at"]).alias("published_at"), utc_string(x["modified_at"]).alias("modified_at"))
