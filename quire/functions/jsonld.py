"""JSON-LD: block table and typed field access on VARIANT values.

A block is a JSON object from a ``ld+json`` script; a script holding an array contributes
its object members; unparsable text is skipped; ``@graph`` is not descended. Field values
are tested by type the way the extraction rules need (string / object / array / other).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire import constants as C
from quire.functions.text import WS_CHARS, normalize_ws, normalize_ws_text


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times in ``body`` (keeps plans small)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def vtype(v: Column) -> Column:
    """Top-level variant type name: STRING, OBJECT, ARRAY, BIGINT, DOUBLE, BOOLEAN, NULL ..."""
    return F.regexp_extract(F.schema_of_variant(v), r"^([A-Z_]+)", 1)


def is_object(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>").isNotNull()


def get(v: Column, key: str) -> Column:
    """``block.get(key)`` as a variant (NULL when absent)."""
    return F.try_variant_get(v, f'$["{key}"]', "variant")


def as_string(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def blocks(scripts: Column) -> Column:
    """ARRAY<VARIANT> of the JSON-LD objects, in document order."""
    parsed = F.transform(scripts, lambda s: F.try_parse_json(s))
    per_script = F.transform(parsed, lambda v: F.when(
        is_object(v), F.array(v)).otherwise(
        F.coalesce(F.filter(F.try_variant_get(v, "$", "array<variant>"), is_object),
                   F.array().cast("array<variant>"))))
    return F.flatten(per_script)


def top_objects(scripts: Column) -> Column:
    """Scripts whose JSON is an object (arrays are not opened), in document order."""
    return F.filter(F.transform(scripts, lambda s: F.try_parse_json(s)), is_object)


def type_is(block: Column, types) -> Column:
    """``block.get("@type") in types`` — only a plain string can match."""
    t = get(block, "@type")
    return F.coalesce((vtype(t) == "STRING") & as_string(t).isin(*types), F.lit(False))


def article_blocks(bs: Column, types=tuple(C.LD_ARTICLE_TYPES)) -> Column:
    return F.filter(bs, lambda b: type_is(b, types))


def truthy(v: Column) -> Column:
    """Python truth of a JSON value: non-empty string/array/object, non-zero number, true."""
    return let(v, lambda x: let(vtype(x), lambda t: F.coalesce(
        F.when(t == "STRING", F.length(as_string(x)) > 0)
        .when(t == "ARRAY", F.size(F.try_variant_get(x, "$", "array<variant>")) > 0)
        .when(t == "OBJECT", F.size(F.try_variant_get(x, "$", "map<string,variant>")) > 0)
        .when(t == "BOOLEAN", F.try_variant_get(x, "$", "boolean"))
        .when(t == "NULL", F.lit(False))
        .otherwise(F.try_variant_get(x, "$", "double") != 0), F.lit(False))))


def first_present(bs: Column, f) -> Column:
    """First non-NULL ``f(block)`` over the blocks (the ``if not field:`` merge)."""
    return F.try_element_at(F.filter(F.transform(bs, f), lambda x: x.isNotNull()), F.lit(1))


PY_TYPE = {"BIGINT": "int", "INT": "int", "SMALLINT": "int", "TINYINT": "int", "DECIMAL": "float",
           "DOUBLE": "float", "FLOAT": "float", "BOOLEAN": "bool", "ARRAY": "list", "OBJECT": "dict"}


# ------------------------------------------------ the same as text, for whole blocks at once
#
# A block's fields are some hundred function calls. As text they are parsed at once; put together
# from Columns they take seconds.


def type_text(v: str) -> str:
    return f"regexp_extract(schema_of_variant({v}), '^([A-Z_]+)', 1)"


def get_text(v: str, key: str) -> str:
    return f"try_variant_get({v}, '$[\"{key}\"]', 'variant')"


def string_text(v: str) -> str:
    return f"try_variant_get({v}, '$', 'string')"


def array_text(v: str) -> str:
    return f"try_variant_get({v}, '$', 'array<variant>')"


def let_in(value: str, name: str, body: str) -> str:
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def truthy_text(v: str) -> str:
    return let_in(v, "x", let_in(type_text("x"), "t", (
        f"coalesce(CASE t WHEN 'STRING' THEN length({string_text('x')}) > 0 WHEN 'ARRAY' THEN size({array_text('x')}) > 0"
        " WHEN 'OBJECT' THEN size(try_variant_get(x, '$', 'map<string,variant>')) > 0"
        " WHEN 'BOOLEAN' THEN try_variant_get(x, '$', 'boolean') WHEN 'NULL' THEN false"
        " ELSE try_variant_get(x, '$', 'double') != 0 END, false)")))


def clean_text(v: str) -> str:
    joined = f"array_join(transform(filter({array_text('c')}, e -> {truthy_text('e')}), e -> {string_text('e')}), ', ')"
    return let_in(v, "c", f"CASE WHEN {type_text('c')} = 'ARRAY' THEN {normalize_ws_text(joined)}"
                          f" WHEN {truthy_text('c')} THEN {normalize_ws_text(string_text('c'))} END")


def author_text(block: str, allow_list: bool = True) -> str:
    name = get_text("e", "name")
    named = (f"CASE WHEN {type_text('e')} = 'STRING' THEN {string_text('e')} WHEN try_variant_get(e, '$', 'map<string,variant>') IS NOT NULL"
             f" AND {truthy_text(name)} THEN {string_text(name)} END")
    names = f"filter(transform({array_text('a')}, e -> {named}), n -> n IS NOT NULL)"
    joined = "array_join(names, ', ')"
    listed = let_in(names, "names", f"CASE WHEN size(names) > 0 THEN {normalize_ws_text(joined)} END")
    lists = f" WHEN 'ARRAY' THEN {listed}" if allow_list else ""
    return let_in(get_text(block, "author"), "a", (
        f"CASE WHEN {truthy_text('a')} THEN CASE {type_text('a')} WHEN 'STRING' THEN {normalize_ws_text(string_text('a'))}"
        f" WHEN 'OBJECT' THEN {clean_text(get_text('a', 'name'))}{lists} END END"))


def keywords_text(block: str) -> str:
    strip = lambda v: f"btrim({v}, '{WS_CHARS}')"
    split_up = f"filter(transform(split({string_text('k')}, ','), p -> {strip('p')}), p -> p != '')"
    return let_in(get_text(block, "keywords"), "k", (
        f"CASE WHEN NOT {truthy_text('k')} THEN CAST(NULL AS array<string>) WHEN {type_text('k')} = 'STRING' THEN {split_up}"
        f" WHEN {type_text('k')} = 'ARRAY' THEN transform(filter({array_text('k')}, e -> {truthy_text('e')}), e -> {strip(string_text('e'))}) END"))


def date_text(block: str, key: str, parsed) -> str:
    """(ts, err) of a date field: what ``parsed`` makes of its stripped text, or why it cannot be one."""
    names = "map(" + ", ".join(f"'{k}', '{t}'" for k, t in PY_TYPE.items()) + ")"
    wrong = f"format_string(\"'%s' object has no attribute 'strip'\", coalesce(try_element_at({names}, {type_text('v')}), 'object'))"
    text = f"btrim({string_text('v')}, '{WS_CHARS}')"
    is_text = f"{type_text('v')} = 'STRING'"
    return let_in(get_text(block, key), "v", (
        f"CASE WHEN {truthy_text('v')} THEN named_struct('ts', CASE WHEN {is_text} THEN {let_in(text, 's', parsed('s'))} END,"
        f" 'err', CASE WHEN NOT ({is_text}) THEN {wrong} END) END"))


def article_fields_text(b: str, parsed_date) -> str:
    """Every field that rule sets read from one block, as text."""
    kind = get_text(b, "@type")
    parts = {
        "type": f"CASE WHEN {type_text(kind)} = 'STRING' THEN {string_text(kind)} END", "headline": clean_text(get_text(b, "headline")),
        "author": author_text(b), "author_simple": author_text(b, False), "section": clean_text(get_text(b, "articleSection")),
        "tags": keywords_text(b), "has_body": truthy_text(get_text(b, "articleBody")), "body": clean_text(get_text(b, "articleBody")),
        "pub": date_text(b, "datePublished", parsed_date), "mod": date_text(b, "dateModified", parsed_date),
    }
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in parts.items()) + ")"
