"""DuckDB SQL for the registered queries (the correctness oracle).

Each string is an independent re-statement of a query in DuckDB SQL over the driver's
views (pages, documents, events, labels). Shared pieces (whitespace class, URL split,
canonical URL, URL rules) are spelled once here as SQL text builders. RE2 has no
look-around, so the sentence split marks boundaries with a private-use character first and
bad percent escapes are left alone by ``url_decode`` (as Python's decoder does).
"""

from __future__ import annotations

from quire import constants as C
from quire.functions.urls import USES_NETLOC, USES_PARAMS, USES_RELATIVE, deny_regex, site_url_regexes
from quire.operators.extract import SITE_SETS
from quire.plans.catalog import DATE_SHAPES, URL_SHAPES
from quire.sources.registry import test_registry

RUN_TS = "2026-01-01T00:00:00Z"
WS = (r"[\t\n\x0B\f\r\x1C-\x20\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
MARK = "\ue000"  # private-use character: never in the text
URL_RE = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def norm(e: str) -> str:
    return f"nullif(trim(regexp_replace({e}, {q(WS + '+')}, ' ', 'g'), ' '), '')"


def strip(e: str) -> str:
    return f"regexp_replace({e}, {q('^' + WS + '+|' + WS + '+$')}, '', 'g')"


def summary_exprs(e: str) -> tuple[str, str]:
    marked = f"regexp_replace({e}, {q('([.!?])' + WS + '+')}, {q(chr(92) + '1' + MARK)}, 'g')"
    first5 = f"array_to_string(list_slice(string_split({marked}, {q(MARK)}), 1, {C.SUMMARY_SENTENCES}), ' ')"
    n = f"(CASE WHEN length({e}) > 0 THEN {norm(first5)} END)"
    cut = (f"regexp_replace(regexp_replace(substring({n}, 1, {C.SUMMARY_MAX_CHARS}), ' [^ ]*$', ''), "
           f"'[.,!?;:]+$', '') || '...'")
    return (f"(CASE WHEN length({n}) > {C.SUMMARY_MAX_CHARS} THEN {cut} ELSE {n} END)",
            f"coalesce(length({n}) > {C.SUMMARY_MAX_CHARS}, false)")


def fingerprint(title: str, text: str, pub: str, source: str) -> str:
    return (f"sha256(CASE WHEN length({text}) > 0 THEN coalesce({title}, '') || '|' || substring({text}, 1, "
            f"{C.FINGERPRINT_TEXT_CHARS}) ELSE coalesce({title}, '') || '|' || coalesce({pub}, '') || '|' || "
            f"coalesce({source}, '') END)")


def nav_junk(stripped: str) -> str:
    lines = f"string_split({stripped}, chr(10))"
    short = f"len(list_filter({lines}, lambda l: length({strip('l')}) < {C.NAV_JUNK_SHORT_LINE}))"
    return f"(len({lines}) > {C.NAV_JUNK_MIN_LINES} AND {short} / len({lines}) > {C.NAV_JUNK_SHARE})"


def gate(title: str, text: str) -> str:
    st = strip(f"coalesce({text}, '')")
    return (f"(coalesce(length({strip(title)}) > 0, false) AND length({st}) >= {C.MIN_ARTICLE_TEXT_LENGTH} "
            f"AND NOT coalesce({nav_junk(st)}, false))")


def paragraphs(lst: str) -> str:
    return f"array_to_string(list_filter(list_transform({lst}, lambda p: {strip('p')}), lambda p: p <> ''), chr(10) || chr(10))"


def fox_keep(lst: str) -> str:
    return (f"list_filter(list_transform({lst}, lambda p: {strip('p')}), lambda p: p <> '' AND NOT "
            f"starts_with(upper(p), {q(C.FOX_PROMO_PREFIX)}) AND length(p) >= {C.FOX_MIN_PARAGRAPH} AND NOT "
            f"(upper(p) = p AND lower(p) <> p AND length(p) < {C.FOX_CAPS_MAX}))")


def nbc_keep(lst: str) -> str:
    return (f"list_filter(list_transform({lst}, lambda p: {strip('p')}), lambda p: p <> '' AND "
            f"length(p) >= {C.NBC_MIN_PARAGRAPH} AND NOT regexp_matches(lower(p), {q('|'.join(C.NBC_PROMO_PHRASES))}))")


# ------------------------------------------------------------------ URL pieces


def split_cte(src: str, url: str, p: str, keep: str = "*", default_scheme: str | None = None) -> str:
    """SELECT adding {p}scheme/netloc/path/params/query/fragment for ``url``."""
    s = f"regexp_replace(regexp_replace({url}, '^[\\x00-\\x20]+', ''), '[\\t\\r\\n]', '', 'g')"
    sch = f"lower(regexp_extract({s}, {q(URL_RE)}, 1))"
    if default_scheme:
        sch = f"(CASE WHEN {sch} = '' THEN {default_scheme} ELSE {sch} END)"
    fp = f"regexp_extract({s}, {q(URL_RE)}, 3)"
    inner = (f"SELECT {keep}, {sch} AS {p}scheme, regexp_extract({s}, {q(URL_RE)}, 2) AS {p}netloc, {fp} AS {p}fp, "
             f"regexp_extract({s}, {q(URL_RE)}, 4) AS {p}query, regexp_extract({s}, {q(URL_RE)}, 5) AS {p}fragment "
             f"FROM {src}")
    split = f"({p}scheme IN {in_list(USES_PARAMS)} AND contains({p}fp, ';'))"
    return (f"SELECT *, CASE WHEN {split} THEN regexp_extract({p}fp, '^(.*?)(?:;([^/]*))?$', 1) ELSE {p}fp END AS {p}path, "
            f"CASE WHEN {split} THEN regexp_extract({p}fp, '^(.*?)(?:;([^/]*))?$', 2) ELSE '' END AS {p}params "
            f"FROM ({inner})")


def unsplit(scheme: str, netloc: str, pp: str, query: str, fragment: str) -> str:
    lead = (f"CASE WHEN {netloc} <> '' THEN '//' || {netloc} || (CASE WHEN {pp} = '' OR starts_with({pp}, '/') "
            f"THEN '' ELSE '/' END) WHEN starts_with({pp}, '//') THEN '//' WHEN {scheme} <> '' AND {scheme} IN "
            f"{in_list(USES_NETLOC)} AND ({pp} = '' OR starts_with({pp}, '/')) THEN '//' ELSE '' END")
    return (f"((CASE WHEN {scheme} <> '' THEN {scheme} || ':' ELSE '' END) || ({lead}) || {pp} || "
            f"(CASE WHEN {query} <> '' THEN '?' || {query} ELSE '' END) || "
            f"(CASE WHEN {fragment} <> '' THEN '#' || {fragment} ELSE '' END))")


def with_params(path: str, params: str) -> str:
    return f"({path} || CASE WHEN {params} <> '' THEN ';' || {params} ELSE '' END)"


def _dec(x: str) -> str:
    return f"url_decode(replace({x}, '+', ' '))"


def _enc(x: str) -> str:
    return f"replace(url_encode({x}), '%20', '+')"


def canonical_cte(src: str, url: str, out: str, p: str = "c_") -> str:
    """SELECT adding ``out`` = canonical URL of ``url`` (parts columns prefixed ``p``)."""
    keys = in_list([k.lower() for k in C.TRACKING_PARAMS])
    s1 = split_cte(src, url, p)
    kv = (f"list_filter(list_transform(list_filter(string_split({p}query, '&'), lambda x: instr(x, '=') > 0 AND "
          f"instr(x, '=') < length(x)), lambda x: {{'k': {_dec('split_part(x, ' + q('=') + ', 1)')}, "
          f"'v': {_dec('substr(x, instr(x, ' + q('=') + ') + 1)')}}}), lambda x: lower(x.k) NOT IN {keys})")
    s2 = f"SELECT *, {kv} AS {p}kv FROM ({s1})"
    s3 = f"SELECT *, list_transform({p}kv, lambda x: x.k) AS {p}keys FROM ({s2})"
    ordered = (f"list_sort(list_transform({p}kv, lambda x, i: {{'g': list_position({p}keys, x.k), 'i': i, "
               f"'k': x.k, 'v': x.v}}))")
    cq = f"array_to_string(list_transform({ordered}, lambda x: {_enc('x.k')} || '=' || {_enc('x.v')}), '&')"
    path = f"(CASE WHEN {p}path = '/' THEN '/' ELSE regexp_replace({p}path, '/+$', '') END)"
    bad = (f"((contains({p}netloc, '[') AND NOT contains({p}netloc, ']')) OR "
           f"(contains({p}netloc, ']') AND NOT contains({p}netloc, '[')))")
    canon = unsplit(f"{p}scheme", f"lower({p}netloc)", with_params(path, f"{p}params"), cq, "''")
    return (f"SELECT *, CASE WHEN {url} IS NULL THEN NULL WHEN {bad} THEN {url} ELSE {canon} END AS {out} "
            f"FROM ({s3})")


def host_expr(netloc: str) -> str:
    hi = f"regexp_extract({netloc}, '([^@]*)$', 1)"
    return (f"lower(CASE WHEN contains({hi}, '[') THEN regexp_extract({hi}, '\\[([^\\]]*)', 1) "
            f"ELSE split_part({hi}, ':', 1) END)")


def f3_expr(lp: str) -> str:
    return (f"(CASE WHEN regexp_matches({lp}, {q(deny_regex())}) THEN false "
            f"WHEN contains({lp}, '/article/') OR contains({lp}, '/articles/') THEN true "
            f"WHEN regexp_matches({lp}, '/[0-9]{{4}}/[0-9]{{2}}/[0-9]{{2}}/') THEN true "
            f"WHEN regexp_matches({lp}, '-[0-9]{{6,}}$') OR regexp_matches({lp}, '-[0-9]{{6,}}\\.html?$') THEN true "
            f"WHEN regexp_matches({lp}, '/([a-z0-9]+-){{4,}}[a-z0-9]+/?$') THEN true "
            f"WHEN regexp_matches({lp}, '^/news/.+') AND length({lp}) > 10 THEN true "
            f"WHEN length(regexp_replace({lp}, '/+$', '')) < 15 THEN false ELSE true END)")


def site_expr(url: str, rs: str) -> str:
    reject, accept = site_url_regexes(rs)
    rej = " OR ".join(f"regexp_matches({url}, {q(r)})" for r in reject) or "false"
    acc = " OR ".join(f"regexp_matches({url}, {q(a)})" for a in accept) or "false"
    return f"(NOT ({rej}) AND ({acc}))"


def url_rule(url: str, lp: str, rs_col: str) -> str:
    branches = " ".join(f"WHEN {rs_col} = {q(rs)} THEN {site_expr(url, rs)}" for rs in SITE_SETS)
    return f"(CASE {branches} ELSE {f3_expr(lp)} END)"


def valid_expr(u: str) -> str:
    return (f"((starts_with({u}, 'http://') OR starts_with({u}, 'https://')) AND NOT "
            f"regexp_matches(lower({u}), {q('|'.join(C.FEED_PATTERNS))}))")


def route_expr(host: str, field: str) -> str:
    """Registered source field of a host: longest matching allowed domain wins."""
    pairs = []
    for s in test_registry():
        for d in s.allowed_domains:
            pairs.append((d, s))
    pairs.sort(key=lambda x: -len(x[0]))
    val = {"source_name": lambda s: q(s.source_name), "source": lambda s: q(s.domain),
           "rule_set": lambda s: q(s.rule_set),
           "allowed": lambda s: "[" + ", ".join(q(a) for a in s.allowed_domains) + "]"}[field]
    whens = " ".join(f"WHEN {host} = {q(d)} OR ends_with({host}, {q('.' + d)}) THEN {val(s)}" for d, s in pairs)
    default = {"source_name": host, "source": host, "rule_set": "'generic'", "allowed": f"[{host}]"}[field]
    return f"(CASE {whens} ELSE {default} END)"


def resolve_cte(src: str, base: str, href: str, out: str) -> str:
    """SELECT adding ``out`` = ``href`` resolved against ``base`` (urljoin rules)."""
    s = split_cte(src, base, "b_")
    s = split_cte(f"({s})", href, "r_", default_scheme="b_scheme")
    rel = "list_concat(CASE WHEN string_split(b_path, '/')[-1] <> '' THEN string_split(b_path, '/')[1:-2] " \
          "ELSE string_split(b_path, '/') END, string_split(r_path, '/'))"
    segs = (f"CASE WHEN starts_with(r_path, '/') THEN string_split(r_path, '/') ELSE "
            f"list_filter({rel}, lambda x, i: i = 1 OR i = len({rel}) OR x <> '') END")
    s = f"SELECT *, {segs} AS r_segs FROM ({s})"
    fold = ("list_reduce(r_segs, lambda acc, x: CASE WHEN x = '..' THEN acc[1:len(acc)-1] WHEN x = '.' THEN acc "
            "ELSE list_append(acc, x) END, []::VARCHAR[])")
    fold = f"(CASE WHEN r_segs[-1] IN ('.', '..') THEN list_append({fold}, '') ELSE {fold} END)"
    s = (f"SELECT *, array_to_string({fold}, '/') AS r_jp, CASE WHEN r_scheme IN {in_list(USES_NETLOC)} "
         f"THEN b_netloc ELSE r_netloc END AS r_net FROM ({s})")
    merged = unsplit("r_scheme", "r_net", with_params("(CASE WHEN r_jp = '' THEN '/' ELSE r_jp END)", "r_params"),
                     "r_query", "r_fragment")
    inherit = unsplit("r_scheme", "r_net", with_params("b_path", "b_params"),
                      "(CASE WHEN r_query = '' THEN b_query ELSE r_query END)", "r_fragment")
    own = unsplit("r_scheme", "r_netloc", with_params("r_path", "r_params"), "r_query", "r_fragment")
    same = f"(r_scheme = b_scheme AND r_scheme IN {in_list(USES_RELATIVE)})"
    return (f"SELECT *, CASE WHEN {base} IS NULL OR {base} = '' THEN {href} WHEN {href} IS NULL OR {href} = '' "
            f"THEN {base} WHEN NOT {same} THEN {href} WHEN r_scheme IN {in_list(USES_NETLOC)} AND r_netloc <> '' "
            f"THEN {own} WHEN r_path = '' AND r_params = '' THEN {inherit} ELSE {merged} END AS {out} FROM ({s})")


def _cols(*names: str) -> str:
    return ", ".join(names)


# ------------------------------------------------------------------ pages

PAGE_HREFS = ("SELECT page_id, url, unnest(h) AS href, generate_subscripts(h, 1) - 1 AS pos FROM "
              "(SELECT page_id, url, list_transform(regexp_extract_all(html, '<a\\s[^>]*href=\"([^\"]*)\"', 1), "
              "lambda x: replace(replace(replace(replace(x, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&')) "
              "AS h FROM pages)")


def routed_pages() -> str:
    s = split_cte("pages", "url", "p_", keep="page_id, url, html")
    return (f"SELECT *, {host_expr('p_netloc')} AS host, lower(p_path) AS url_path FROM ({s})")


def classified_pages() -> str:
    r = routed_pages()
    og = "regexp_matches(html, '<meta[^>]*property=\"og:type\"[^>]*content=\"article\"')"
    art = "regexp_matches(html, '(?i)<article[\\s/>]')"
    ld = "regexp_matches(html, '\"@type\"\\s*:\\s*\"(NewsArticle|Article)\"')"
    body_cls = ("regexp_matches(html, '<div[^>]*class=\"[^\"]*(article-body|article-content|story-body|post-content)')"
                " OR regexp_matches(html, 'itemtype=\"[^\"]*Article')")
    site = (f"CASE WHEN rule_set = 'ap' THEN {og} OR contains(url, '/article/') "
            f"WHEN rule_set IN ('bbc', 'cbs', 'guardian', 'nbc') THEN {og} OR {art} ELSE false END")
    generic = (f"CASE WHEN NOT {url_rule('url', 'url_path', 'rule_set')} THEN false WHEN {ld} OR {og} OR {art} "
               f"OR {body_cls} THEN true WHEN contains(url_path, '/article/') OR contains(url_path, '/articles/') "
               f"THEN true WHEN regexp_matches(url_path, '/[0-9]{{4}}/[0-9]{{2}}/[0-9]{{2}}/.+') THEN true ELSE false END")
    return (f"SELECT *, ({site}) OR ({generic}) AS is_article_page FROM (SELECT *, "
            f"{route_expr('host', 'source_name')} AS source_name, {route_expr('host', 'rule_set')} AS rule_set, "
            f"{route_expr('host', 'allowed')} AS allowed_domains FROM ({r}))")


def followed_sql() -> str:
    disc = (f"SELECT h.page_id, h.url, h.href, h.pos, c.source_name, c.rule_set, c.allowed_domains FROM "
            f"({PAGE_HREFS}) h JOIN ({classified_pages()}) c USING (page_id) WHERE NOT c.is_article_page")
    res = resolve_cte(f"({disc})", "url", "href", "link_url")
    lk = split_cte(f"({res})", "link_url", "l_", keep="page_id, pos, link_url, source_name, rule_set, allowed_domains")
    lk = f"SELECT *, {host_expr('l_netloc')} AS link_host, lower(l_path) AS link_path FROM ({lk})"
    acc = (f"{valid_expr('link_url')} AND len(list_filter(allowed_domains, lambda d: link_host = d OR "
           f"ends_with(link_host, '.' || d))) > 0 AND {url_rule('link_url', 'link_path', 'rule_set')}")
    ranked = (f"SELECT page_id, pos, link_url, source_name, {acc} AS accepted, sum(CAST({acc} AS INTEGER)) OVER "
              f"(PARTITION BY page_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS follow_rank "
              f"FROM ({lk})")
    return f"SELECT page_id, pos, link_url, source_name, follow_rank FROM ({ranked}) WHERE accepted AND follow_rank <= {C.MAX_FOLLOW_PER_PAGE}"


def frontier_sql() -> str:
    keyed = canonical_cte(f"({followed_sql()})", "link_url", "canon", "k_")
    keyed = f"SELECT page_id, pos, link_url, source_name, sha256(canon) AS url_hash FROM ({keyed})"
    dedup = ("SELECT url_hash, arg_min(link_url, (page_id, pos)) AS url, arg_min(source_name, (page_id, pos)) AS "
             f"source_name, count(*) AS n_links, count(DISTINCT page_id) AS n_pages FROM ({keyed}) GROUP BY url_hash")
    visited = canonical_cte("pages", "url", "canon", "v_")
    visited = f"SELECT DISTINCT sha256(canon) AS url_hash FROM ({visited})"
    return f"SELECT d.* FROM ({dedup}) d ANTI JOIN ({visited}) v USING (url_hash)"


# the site made from the events, written out: which links count, which pages are what
SITE = "https://walk.example.org"
SITE_PAGES = (f"SELECT DISTINCT event_id // 130 AS page_id, '{SITE}' || (CASE WHEN event_id // 130 % 10 = 1 THEN '/tag/page-' "
              f"ELSE '/news/page-number-' END) || (event_id // 130) AS url FROM events")
SITE_FOLLOWED = (f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS follow_rank FROM (SELECT "
                 f"event_id // 130 AS page_id, row_number() OVER (PARTITION BY event_id // 130 ORDER BY event_id) - 1 AS pos, "
                 f"event_id, '{SITE}/news/page-number-' || (3 * (event_id // 130) + event_id % 4) AS link_url FROM events) "
                 f"WHERE event_id % 10 <> 0 AND page_id % 10 NOT IN (3, 8)) WHERE follow_rank <= 100")


def pages_with_copies() -> str:
    both = ("SELECT page_id, url, 0 AS copy FROM pages UNION ALL SELECT page_id, url || (CASE WHEN contains(url, '?') "
            "THEN '&' ELSE '?' END) || 'utm_source=copy', 1 FROM pages")
    return f"SELECT page_id, url, copy, sha256(canon) AS url_hash FROM ({canonical_cte(f'({both})', 'url', 'canon')})"


# ------------------------------------------------------------------ documents


def doc_generic() -> str:
    url = "'https://' || source || '.example/doc/' || CAST(doc_id AS VARCHAR)"
    base = f"SELECT doc_id, source, text, {url} AS url FROM documents"
    keyed = f"SELECT doc_id, source, text, url, sha256(canon) AS url_hash FROM ({canonical_cte(f'({base})', 'url', 'canon')})"
    s1 = (f"SELECT *, {gate('split_part(text, chr(10), 1)', 'text')} AS g, {norm('split_part(text, chr(10), 1)')} AS "
          f"n_title, (CASE WHEN length({norm('text')}) >= {C.LOW_QUALITY_TEXT_LENGTH} THEN {norm('text')} END) AS n_text, "
          f"{strip('text')} AS sum_src FROM ({keyed})")
    summ, trunc = summary_exprs("sum_src")
    return (f"SELECT n_title AS title, NULL::VARCHAR AS author, CASE WHEN g THEN n_text END AS text, "
            f"CASE WHEN g THEN {summ} END AS summary, url, source, NULL::VARCHAR AS published_at, "
            f"{q(RUN_TS)} AS scraped_at, url_hash, CASE WHEN g THEN {fingerprint('n_title', 'n_text', 'NULL', 'source')} "
            f"ELSE {fingerprint('n_title', 'NULL', 'NULL', 'source')} END AS fingerprint, {q(C.AUTHOR_MISSING)} AS author_source, "
            f"{C.SUMMARY_MAX_CHARS} AS summary_max_chars, CASE WHEN g THEN {trunc} ELSE false END AS summary_truncated, "
            f"g AS parse_ok, CASE WHEN NOT g THEN {q(C.GENERIC_GATE_FAILED)} END AS parse_error, "
            f"{q(C.METHOD_GENERIC)} AS extraction_method, CAST(CASE WHEN g THEN coalesce(length(n_text), 0) ELSE 0 END AS INTEGER) "
            f"AS content_length_chars, doc_id FROM ({s1})")


# what a rule set reads of the pages that page_sites.dated_pages makes, written out: the date by doc_id modulo 6
# (LD, meta, time, meta that is no date beside a time), whether its bylines count, whether an unmarked page is an article
_LD, _META, _TIME = "2026-01-01T21:34:05Z", "2026-01-04T01:02:03Z", "2026-01-05T00:00:00Z"
DATES_READ = {
    "ap": ((_LD, _META, None, None), False, False), "bbc": ((None, _META, _TIME, _TIME), True, True),
    "cbs": ((_LD, _META, _TIME, None), False, False), "cnn": ((_LD, _META, None, None), True, False),
    "fox": ((_LD, _META, _TIME, None), True, False), "guardian": ((_LD, None, _TIME, _TIME), True, False),
    "nbc": ((_LD, _META, None, None), False, True),
}


def page_dates(rs: str) -> str:
    dates, byline, unmarked = DATES_READ[rs]
    pub = "CASE doc_id % 6 " + " ".join(f"WHEN {k} THEN {q(v)}" for k, v in enumerate(dates) if v) + " END"
    mod = "CASE WHEN doc_id % 6 = 0 THEN '2026-01-03T00:00:00Z' END" if dates[0] else "NULL::VARCHAR"
    who = "CASE WHEN doc_id % 4 = 1 THEN 'Ann Example' END" if byline else "NULL::VARCHAR"
    return (f"SELECT doc_id, {pub} AS published_at, {mod} AS modified_at, {who} AS author FROM documents"
            + ("" if unmarked else " WHERE doc_id % 6 <> 5"))


def page_generic() -> str:
    """Article rows of the pages that page_sites.generic_pages makes, from the documents."""
    url = "'https://' || source || '.example/articles/story-' || CAST(doc_id AS VARCHAR)"
    base = (f"SELECT doc_id, source, doc_id % 12 AS k, {url} AS url, string_split(text, chr(10)) AS lines FROM documents "
            f"WHERE doc_id % 12 NOT IN (0, 1)")
    keyed = f"SELECT *, sha256(canon) AS url_hash FROM ({canonical_cte(f'({base})', 'url', 'canon')})"
    s1 = f"SELECT *, lines[1] AS title_raw, {paragraphs('lines[2:]')} AS text_raw FROM ({keyed})"
    given = "'A summary that came with the page, long enough to be kept as it is.'"
    pub = ("CASE WHEN doc_id % 2 = 0 THEN '2026-02-03T02:05:06Z' WHEN doc_id % 3 = 0 THEN NULL ELSE '2026-02-03T00:00:00Z' END")
    s2 = (f"SELECT *, {gate('title_raw', 'text_raw')} AS g, {norm('title_raw')} AS n_title, (CASE WHEN length({norm('text_raw')}) >= "
          f"{C.LOW_QUALITY_TEXT_LENGTH} THEN {norm('text_raw')} END) AS n_text, {strip('text_raw')} AS sum_src, CAST({pub} AS VARCHAR) AS pub FROM ({s1})")
    summ, trunc = summary_exprs("sum_src")
    who = ("CASE WHEN k BETWEEN 3 AND 7 THEN 'Ann ' || source WHEN k = 8 THEN 'Ann ' || source || ', Bob' END")
    whence = f"CASE WHEN k = 3 THEN {q(C.AUTHOR_FEED)} WHEN k BETWEEN 4 AND 8 THEN {q(C.AUTHOR_META)} ELSE {q(C.AUTHOR_MISSING)} END"
    return (f"SELECT n_title AS title, CASE WHEN g THEN {who} END AS author, CASE WHEN g THEN n_text END AS text, "
            f"CASE WHEN g THEN (CASE WHEN k = 9 THEN {given} ELSE {summ} END) END AS summary, url, source, pub AS published_at, {q(RUN_TS)} AS scraped_at, "
            f"url_hash, CASE WHEN g THEN {fingerprint('n_title', 'n_text', 'pub', 'source')} ELSE {fingerprint('n_title', 'NULL', 'pub', 'source')} END "
            f"AS fingerprint, CASE WHEN g THEN {whence} ELSE {q(C.AUTHOR_MISSING)} END AS author_source, {C.SUMMARY_MAX_CHARS} AS summary_max_chars, "
            f"CASE WHEN g AND k <> 9 THEN {trunc} ELSE false END AS summary_truncated, g AS parse_ok, "
            f"CASE WHEN NOT g THEN {q(C.GENERIC_GATE_FAILED)} END AS parse_error, {q(C.METHOD_GENERIC)} AS extraction_method, "
            f"CAST(CASE WHEN g THEN coalesce(length(n_text), 0) ELSE 0 END AS INTEGER) AS content_length_chars, doc_id FROM ({s2})")


def _ladder_sql(rs: str, ld: str = "false", author: str = "false") -> tuple[str, str]:
    has = {"ld": ld, "ldbody": "false", "title": "coalesce(length(x_title) > 0, false)",
           "author": author, "body": "coalesce(length(x_body) > 0, false)"}
    steps, fallback, cap = C.CONFIDENCE_LADDERS[rs]
    whens, conds = [], []
    for needs, gt, score in steps:
        cond = " AND ".join([has[n] for n in needs] + ([f"length(x_body) > {gt}"] if gt is not None else []))
        whens.append(f"WHEN {cond} THEN {score}")
        conds.append(f"({cond})")
    conf = f"CAST(CASE {' '.join(whens)} ELSE {fallback} END AS DOUBLE)"
    if cap is not None:
        conf = f"least({conf}, {cap})"
    low = f"NOT ({' OR '.join(conds)})"
    return conf, low


def page_texts(rule_set: str) -> str:
    """doc_id (the page's), source, url, url_hash, title_raw and paras of the stored article pages of a rule set. Their HTML is
    regular: one h1, and each paragraph begins with its text, or has no text of its own."""
    plain = "html"
    for name, c in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "''"), ("#x27", "''"), ("nbsp", "\u00a0"), ("amp", "&")):
        plain = f"replace({plain}, '&{name};', '{c}')"
    plain = plain.replace("replace(html,", "replace(x,")
    texts = lambda rx: f"list_transform(regexp_extract_all(html, '{rx}', 1), lambda x: {plain})"
    source = f"coalesce({route_expr('host', 'source')}, host)"
    base = (f"SELECT page_id AS doc_id, rule_set, coalesce(source_name, host) AS source_name, {source} AS source, url, {texts('<h1>([^<]+)')}[1] AS title_raw, "
            f"list_filter({texts('<p>([^<]*)')}, lambda x: x <> '') AS paras FROM ({classified_pages()}) WHERE is_article_page AND rule_set = '{rule_set}'")
    return f"SELECT *, sha256(canon) AS url_hash FROM ({canonical_cte(f'({base})', 'url', 'canon')})"


def page_articles() -> str:
    """The article rows of the stored pages under the test registry (BBC, Guardian and generic rules)."""
    parts = [f"SELECT * EXCLUDE (doc_id), doc_id AS page_id, '{rs}' AS rule_set FROM ({doc_site(rs, rows=page_texts(rs))})" for rs in ("bbc", "guardian")]
    parts.append(f"SELECT * EXCLUDE (doc_id), doc_id AS page_id, 'generic' AS rule_set FROM ({generic_rows(page_texts('generic'))})")
    names = " UNION ALL BY NAME ".join(f"SELECT doc_id AS page_id, source_name FROM ({page_texts(rs)})" for rs in ("bbc", "guardian", "generic"))
    return f"SELECT a.*, n.source_name FROM ({' UNION ALL BY NAME '.join(parts)}) a JOIN ({names}) n USING (page_id)"


def generic_rows(pages: str) -> str:
    """Article rows of the generic rules for pages without author, date or summary."""
    s1 = f"SELECT *, {paragraphs('paras')} AS text_raw FROM ({pages})"
    s2 = (f"SELECT *, {gate('title_raw', 'text_raw')} AS g, {norm('title_raw')} AS n_title, (CASE WHEN length({norm('text_raw')}) >= "
          f"{C.LOW_QUALITY_TEXT_LENGTH} THEN {norm('text_raw')} END) AS n_text, {strip('text_raw')} AS sum_src FROM ({s1})")
    summ, trunc = summary_exprs("sum_src")
    return (f"SELECT n_title AS title, NULL::VARCHAR AS author, CASE WHEN g THEN n_text END AS text, CASE WHEN g THEN {summ} END AS summary, url, source, "
            f"NULL::VARCHAR AS published_at, {q(RUN_TS)} AS scraped_at, url_hash, CASE WHEN g THEN {fingerprint('n_title', 'n_text', 'NULL', 'source')} "
            f"ELSE {fingerprint('n_title', 'NULL', 'NULL', 'source')} END AS fingerprint, {q(C.AUTHOR_MISSING)} AS author_source, "
            f"{C.SUMMARY_MAX_CHARS} AS summary_max_chars, CASE WHEN g THEN {trunc} ELSE false END AS summary_truncated, g AS parse_ok, "
            f"CASE WHEN NOT g THEN {q(C.GENERIC_GATE_FAILED)} END AS parse_error, {q(C.METHOD_GENERIC)} AS extraction_method, "
            f"CAST(CASE WHEN g THEN coalesce(length(n_text), 0) ELSE 0 END AS INTEGER) AS content_length_chars, doc_id FROM ({s2})")


def doc_site(rs: str, page: bool = False, extracted: bool = False, rows: str | None = None) -> str:
    """Article rows of a site rule set (``extracted``: EXTRACTED rows). ``page``: of the pages that page_sites makes, where an empty
    line is no paragraph, and an author and a JSON-LD block come by doc_id modulo 3. ``rows``: of ``page_texts``."""
    ld, author = ("doc_id % 3 = 2", "doc_id % 3 > 0 AND length(source) > 0") if page else ("false", "false")
    url = "'https://' || source || '.example/doc/' || CAST(doc_id AS VARCHAR)"
    base = (f"SELECT doc_id, source, text, {url} AS url, string_split(text, chr(10)) AS lines FROM documents")
    keyed = f"SELECT *, sha256(canon) AS url_hash FROM ({canonical_cte(f'({base})', 'url', 'canon')})"
    paras = "list_filter(lines[2:], lambda l: l <> '')" if page else "lines[2:]"
    s1 = rows or f"SELECT *, lines[1] AS title_raw, {paras} AS paras FROM ({keyed})"
    if rs in ("fox", "nbc"):
        kept = fox_keep("paras") if rs == "fox" else nbc_keep("paras")
        body = f"CASE WHEN len({kept}) > 0 THEN {paragraphs(kept)} WHEN len(paras) > 0 THEN {paragraphs('paras')} END"
    else:
        body = f"CASE WHEN len(paras) > 0 THEN {paragraphs('paras')} END"
    s2 = f"SELECT *, {norm('title_raw')} AS x_title, {body} AS x_body, len(paras) = 0 AS no_paras FROM ({s1})"
    conf, low = _ladder_sql(rs, ld, author)
    no_title = "NOT coalesce(length(x_title) > 0, false)"
    errs = {
        "ap": [("no_paras", C.ERR_NO_PARAGRAPHS), (low, C.ERR_LOW_CONFIDENCE), (no_title, C.ERR_AP_NO_TITLE)],
        "bbc": [(no_title, C.ERR_NO_TITLE), ("no_paras", C.ERR_NO_PARAGRAPHS), (low, C.ERR_LOW_CONFIDENCE)],
        "cbs": [("no_paras", C.ERR_NO_PARAGRAPHS), (low, C.ERR_LOW_CONFIDENCE), (f"NOT ({ld})", C.ERR_CBS_NO_LD)],
        "cnn": [("no_paras", C.ERR_NO_PARAGRAPHS), (low, C.ERR_LOW_CONFIDENCE), (f"NOT ({ld})", C.ERR_CNN_NO_LD)],
        "fox": [(no_title, C.ERR_NO_TITLE), ("no_paras", C.ERR_NO_PARAGRAPHS), (low, C.ERR_LOW_CONFIDENCE)],
        "guardian": [("no_paras", C.ERR_NO_PARAGRAPHS), (low, C.ERR_LOW_CONFIDENCE), (f"NOT ({ld})", C.ERR_GUARDIAN_NO_LD)],
        "nbc": [("no_paras", C.ERR_NO_PARAGRAPHS), (low, C.ERR_LOW_CONFIDENCE)],
    }[rs]
    errors = "list_filter([" + ", ".join(f"CASE WHEN {c} THEN {q(m)} END" for c, m in errs) + "], lambda e: e IS NOT NULL)"
    with_ld = {"ap": "CASE WHEN length(x_body) > 0 THEN 'hybrid' ELSE 'dom' END", "cbs": "'json-ld'", "cnn": "'hybrid'", "guardian": "'json-ld'"}
    method = f"CASE WHEN {ld} THEN {with_ld.get(rs, repr('dom'))} ELSE 'dom' END" if rs != "nbc" else "'hybrid'"
    s3 = (f"SELECT *, {conf} AS confidence, {errors} AS errors, {norm('x_body')} AS a_text, "
          f"{summary_exprs('x_body')[0]} AS a_summary, {summary_exprs('x_body')[1]} AS a_trunc FROM ({s2})")
    n = "coalesce(length(a_text), 0)"
    short = f"'Text too short or missing: ' || CAST({n} AS VARCHAR) || ' < {C.MIN_ARTICLE_TEXT_LENGTH}'"
    err = (f"CASE WHEN NOT coalesce(length(x_title) > 0, false) THEN {q(C.VERDICT_NO_TITLE)} "
           f"WHEN a_text IS NULL OR length(a_text) < {C.MIN_ARTICLE_TEXT_LENGTH} THEN {short} "
           f"WHEN confidence < {C.LOW_CONFIDENCE} THEN 'Low extraction confidence: ' || printf('%.2f', confidence) "
           f"WHEN len(errors) > 0 THEN array_to_string(errors[1:{C.MAX_ERRORS_IN_VERDICT}], '; ') END")
    ok = (f"NOT (NOT coalesce(length(x_title) > 0, false) OR a_text IS NULL OR length(a_text) < "
          f"{C.MIN_ARTICLE_TEXT_LENGTH} OR confidence < {C.LOW_CONFIDENCE})")
    who = f"CASE WHEN {author} THEN source END"
    whence = f"CASE WHEN {author} THEN {method} ELSE {q(C.AUTHOR_MISSING)} END"
    if extracted:
        named = "doc_id % 3 = 2 AND length(source) > 0"
        return (f"SELECT doc_id, url, url_hash, x_title AS title, x_body AS body, CAST({who} AS VARCHAR) AS author, "
                f"CASE WHEN {named} THEN source END AS section, CASE WHEN {named} THEN [source, 'page'] ELSE [] END AS tags, "
                f"{method} AS extraction_method, confidence, errors, NULL::VARCHAR AS fail, NULL::VARCHAR AS published_at, "
                f"NULL::VARCHAR AS modified_at FROM ({s3})")
    return (f"SELECT x_title AS title, CAST({who} AS VARCHAR) AS author, a_text AS text, a_summary AS summary, url, source, "
            f"NULL::VARCHAR AS published_at, {q(RUN_TS)} AS scraped_at, url_hash, "
            f"{fingerprint('x_title', 'a_text', 'NULL', 'source')} AS fingerprint, {whence} AS author_source, "
            f"{C.SUMMARY_MAX_CHARS} AS summary_max_chars, a_trunc AS summary_truncated, {ok} AS parse_ok, "
            f"{err} AS parse_error, {method} AS extraction_method, CAST({n} AS INTEGER) AS content_length_chars, "
            f"doc_id{'' if page or rows else ', confidence'} FROM ({s3})")


def quality_sql(src: str, by: str | None) -> str:
    has = lambda c: f"count_if(coalesce(length({c}) > 0, false))"
    pct = lambda c: f"round(CASE WHEN count(*) > 0 THEN {c} * 100.0 / count(*) ELSE 0.0 END, 1)"
    parts = {"parse_ok": "count_if(parse_ok)", "parse_fail": "count_if(NOT parse_ok)", "has_title": has("title"),
             "has_author": has("author"), "has_text": has("text"), "has_date": has("published_at")}
    cols = [f"count(*) AS n"] + [f"{v} AS {k}" for k, v in parts.items()]
    cols.append("round(avg(coalesce(length(text), 0)), 1) AS avg_text_chars")
    cols += [f"{pct(v)} AS pct_{k}" for k, v in parts.items()]
    sel = (by + ", " if by else "") + ", ".join(cols)
    return f"SELECT {sel} FROM ({src})" + (f" GROUP BY {by}" if by else "")


def event_urls() -> str:
    shapes = "[" + ", ".join(q(s) for s in URL_SHAPES) + "]"
    shape = f"{shapes}[CAST(event_id % {len(URL_SHAPES)} + 1 AS INTEGER)]"
    url = (f"replace(replace(replace({shape}, '{{t}}', event_type), '{{id}}', CAST(event_id AS VARCHAR)), '{{dd}}', "
           f"lpad(CAST(event_id % 28 + 1 AS VARCHAR), 2, '0'))")
    return f"SELECT event_id, {url} AS url FROM events"


SPARK_TO_STRFTIME = {
    "yyyy-MM-dd'T'HH:mm:ss'Z'": "%Y-%m-%dT%H:%M:%SZ", "yyyy-MM-dd'T'HH:mm:ss+05:30": "%Y-%m-%dT%H:%M:%S+05:30",
    "yyyy-MM-dd'T'HH:mm:ss-0800": "%Y-%m-%dT%H:%M:%S-0800", "yyyy-MM-dd HH:mm:ss": "%Y-%m-%d %H:%M:%S",
    "yyyy-MM-dd": "%Y-%m-%d", "MMMM d, yyyy": "%B %-d, %Y", "MMM d, yyyy": "%b %-d, %Y", "d MMMM yyyy": "%-d %B %Y",
    "dd MMM yyyy": "%d %b %Y", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'": "%Y-%m-%dT%H:%M:%S.%gZ",
    "yyyy-MM-dd'T'HH:mm": "%Y-%m-%dT%H:%M", "yyyy": "%Y", "yyyy-MM": "%Y-%m", "HH:mm": "%H:%M", "yyyyMMdd": "%Y%m%d",
}


def event_dates() -> str:
    whens = " ".join(f"WHEN event_id % {len(DATE_SHAPES)} = {i} THEN strftime(ts, {q(SPARK_TO_STRFTIME[f])})"
                     for i, f in enumerate(DATE_SHAPES))
    return f"SELECT event_id, CASE {whens} END AS raw FROM events"


def parse_sql(raw: str, formats_naive: list[str], formats_tz: list[str], zulu: list[str]) -> str:
    parts = [f"CAST(try_strptime({raw}, {q(f)}) AS TIMESTAMP)" for f in formats_naive]
    parts += [f"timezone('UTC', try_strptime({raw}, {q(f)}))" for f in formats_tz]
    parts += [f"CAST(try_strptime({raw}, {q(f)}) AS TIMESTAMP)" for f in zulu]
    return f"strftime(coalesce({', '.join(parts)}), '%Y-%m-%dT%H:%M:%SZ')"


X5_SQL = parse_sql("trim(raw)",
                   ["%Y-%m-%dT%H:%M:%S", "%Y-%m-%d %H:%M:%S", "%Y-%m-%d", "%B %d, %Y", "%b %d, %Y", "%d %B %Y",
                    "%d %b %Y", "%Y-%m-%dT%H:%M", "%Y%m%d", "%Y-%m-%dT%H:%M:%S.%f"],
                   ["%Y-%m-%dT%H:%M:%S%z", "%Y-%m-%d %H:%M:%S%z"],
                   ["%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%dT%H:%M:%S.%fZ"])
X7_SQL = parse_sql("trim(raw)",
                   ["%Y-%m-%dT%H:%M:%S", "%Y-%m-%dT%H:%M:%S.%f", "%Y-%m-%d", "%Y-%m-%dT%H:%M", "%Y%m%d",
                    "%Y-%m-%d %H:%M:%S"],
                   ["%Y-%m-%dT%H:%M:%S%z", "%Y-%m-%dT%H:%M:%S.%f%z"],
                   ["%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%dT%H:%M:%S.%fZ"])


#: Pages with comments emptied, and scripts and styles without their content.
MARKUP = (r"SELECT page_id, coalesce(html, '') AS html, regexp_replace(regexp_replace(coalesce(html, ''), '(?is)<!--.*?-->', '<!---->', 'g'), "
          r"'(?is)(<(script|style)\b[^>]*>).*?</(?:script|style)\s*>', '\1</\2>', 'g') AS m FROM pages")


def build() -> dict[str, str]:
    G = doc_generic()
    d_lines = "string_split(text, chr(10))"
    sqls = {
        "page_scan": "SELECT page_id, url, CAST(length(html) AS INTEGER) AS html_chars FROM pages",
        "url_keys": (f"SELECT page_id, canon AS canonical_url, sha256(canon) AS url_hash, {host_expr('c_netloc')} AS host "
                     f"FROM ({canonical_cte('pages', 'url', 'canon')})"),
        "url_flags": (f"SELECT page_id, {valid_expr('url')} AS valid_url, coalesce({f3_expr('lower(p_path)')}, false) "
                      f"AND url IS NOT NULL AS article_url FROM ({split_cte('pages', 'url', 'p_')})"),
        "host_routing": (f"SELECT page_id, host, {route_expr('host', 'source_name')} AS source_name, "
                         f"{route_expr('host', 'rule_set')} AS rule_set FROM ({routed_pages()})"),
        "page_links": f"SELECT page_id, pos, href, link_url FROM ({resolve_cte(f'({PAGE_HREFS})', 'url', 'href', 'link_url')})",
        "page_classification": f"SELECT page_id, rule_set, is_article_page FROM ({classified_pages()})",
        "followed_links": f"SELECT page_id, pos, link_url, follow_rank FROM ({followed_sql()})",
        "frontier": f"SELECT url_hash, url, source_name, n_links, n_pages FROM ({frontier_sql()})",
        "url_dedup": (f"SELECT url_hash, arg_min(page_id, (copy, page_id)) AS page_id, arg_min(url, (copy, page_id)) AS url, "
                      f"min(copy) AS copy FROM ({pages_with_copies()}) GROUP BY url_hash"),
        "url_dup_groups": (f"SELECT url_hash, count(*) AS n_rows, min(url) AS first_url FROM ({pages_with_copies()}) "
                           f"GROUP BY url_hash HAVING count(*) > 1"),
        "doc_normalize": (f"SELECT doc_id, {norm('text')} AS norm_text, CAST(coalesce(length({norm('text')}), 0) AS INTEGER) "
                          f"AS content_length_chars FROM documents"),
        "doc_summary": (f"SELECT doc_id, {summary_exprs('text')[0]} AS summary, {summary_exprs('text')[1]} AS "
                        f"summary_truncated FROM documents"),
        "doc_fingerprint": (f"SELECT doc_id, t AS title, {fingerprint('t', 'n', 'NULL', 'source')} AS fingerprint FROM "
                            f"(SELECT doc_id, source, {norm('split_part(text, chr(10), 1)')} AS t, {norm('text')} AS n FROM documents)"),
        "doc_gate": (f"SELECT doc_id, CAST(len(string_split(st, chr(10))) AS INTEGER) AS n_lines, "
                     f"CAST(len(list_filter(string_split(st, chr(10)), lambda l: length({strip('l')}) < 30)) AS INTEGER) "
                     f"AS n_short_lines, {nav_junk('st')} AS nav_junk, {gate('split_part(text, chr(10), 1)', 'text')} "
                     f"AS passes_gate FROM (SELECT doc_id, text, {strip('text')} AS st FROM documents)"),
        "doc_paragraphs": (f"SELECT doc_id, CAST(len(list_filter(list_transform({d_lines}, lambda p: {strip('p')}), "
                           f"lambda p: p <> '')) AS INTEGER) AS n_paragraphs, {paragraphs(d_lines)} AS body FROM documents"),
        "doc_promo_fox": (f"SELECT doc_id, CAST(len({fox_keep(d_lines)}) AS INTEGER) AS n_kept, "
                          f"array_to_string({fox_keep(d_lines)}, chr(10) || chr(10)) AS body FROM documents"),
        "doc_promo_nbc": (f"SELECT doc_id, CAST(len({nbc_keep(d_lines)}) AS INTEGER) AS n_kept, "
                          f"array_to_string({nbc_keep(d_lines)}, chr(10) || chr(10)) AS body FROM documents"),
        "doc_articles": G,
        **{f"doc_site_{rs}": doc_site(rs) for rs in SITE_SETS},
        "content_dedup": (f"SELECT fingerprint, arg_min(url, (scraped_at, url)) AS url, arg_min(doc_id, (scraped_at, url)) "
                          f"AS doc_id FROM ({G}) GROUP BY fingerprint"),
        "dup_groups": (f"SELECT fingerprint, count(*) AS n_rows, min(url) AS first_url FROM ({G}) GROUP BY fingerprint "
                       f"HAVING count(*) > 1"),
        "quality_report": quality_sql(G, None),
        "quality_by_source": quality_sql(G, "source"),
        "method_report": (f"SELECT extraction_method, n, round(CASE WHEN sum(n) OVER () > 0 THEN n * 100.0 / sum(n) OVER () "
                          f"ELSE 0.0 END, 1) AS pct FROM (SELECT coalesce(nullif(extraction_method, ''), 'unknown') AS "
                          f"extraction_method, count(*) AS n FROM (SELECT extraction_method FROM ({G}) UNION ALL SELECT "
                          f"extraction_method FROM ({doc_site('nbc')}) UNION ALL SELECT extraction_method FROM "
                          f"({doc_site('fox')})) GROUP BY 1)"),
        "failure_by_source": (f"SELECT source, count(*) AS n, count_if(NOT parse_ok) AS n_failed, "
                              f"round(avg(CAST(NOT parse_ok AS DOUBLE)), 4) AS failure_rate, "
                              f"count_if(parse_error IS NOT NULL) AS n_with_error FROM ({G}) GROUP BY source"),
        "error_counts": (f"SELECT source, parse_error, count(*) AS n FROM ({doc_site('cnn')}) WHERE parse_error IS NOT NULL "
                         f"GROUP BY source, parse_error"),
        "site_links": f"SELECT page_id, pos, link_url, follow_rank FROM ({SITE_FOLLOWED})",
        "site_frontier": (f"SELECT sha256(link_url) AS url_hash, link_url AS url, 'walk' AS source_name, count(*) AS n_links, "
                          f"count(DISTINCT page_id) AS n_pages FROM ({SITE_FOLLOWED}) WHERE link_url NOT IN "
                          f"(SELECT url FROM ({SITE_PAGES})) GROUP BY link_url"),
        "site_walk": (f"WITH RECURSIVE l AS MATERIALIZED (SELECT DISTINCT f.page_id AS a, p.page_id AS b FROM ({SITE_FOLLOWED}) f "
                      f"JOIN ({SITE_PAGES}) p ON p.url = f.link_url), r(page_id, depth) AS (SELECT page_id, 0 FROM ({SITE_PAGES}) "
                      f"WHERE url = '{SITE}/news/page-number-0' UNION SELECT l.b, r.depth + 1 FROM r JOIN l ON l.a = r.page_id "
                      f"WHERE r.depth < 50) SELECT page_id, CAST(min(depth) AS INTEGER) AS depth FROM r GROUP BY page_id"),
        "run_counters": (f"SELECT (SELECT count(DISTINCT u) FROM (SELECT link_url AS u FROM ({SITE_FOLLOWED}) UNION ALL SELECT "
                         f"'{SITE}/news/page-number-0')) AS requests, count(*) AS responses, count_if(page_id % 10 IN (3, 8)) "
                         f"AS items, count_if(page_id % 10 = 8) AS items_failed, 0::BIGINT AS errors, "
                         f"{q(RUN_TS)} AS first_scraped_at, {q(RUN_TS)} AS last_scraped_at FROM ({SITE_PAGES})"),
        "quality_sample": (f"SELECT url, title, parse_ok, content_length_chars FROM ({G}) ORDER BY scraped_at, url "
                           f"LIMIT {C.QUALITY_SAMPLE}"),
        "gate_vs_labels": (f"SELECT l.quality, a.parse_ok, count(*) AS n FROM ({G}) a JOIN labels l USING (doc_id) "
                           f"GROUP BY l.quality, a.parse_ok"),
        "insert_if_absent": (f"SELECT b.url, b.extraction_method, b.parse_ok, b.fingerprint FROM (SELECT url, "
                             f"arg_min(extraction_method, (extraction_method, fingerprint)) AS extraction_method, "
                             f"arg_min(parse_ok, (extraction_method, fingerprint)) AS parse_ok, min_by(fingerprint, "
                             f"(extraction_method, fingerprint)) AS fingerprint FROM (SELECT url, extraction_method, "
                             f"parse_ok, fingerprint FROM ({G}) UNION ALL SELECT url, extraction_method, parse_ok, "
                             f"fingerprint FROM ({doc_site('nbc')})) GROUP BY url) b ANTI JOIN (SELECT DISTINCT url FROM "
                             f"({G}) WHERE parse_ok) t USING (url)"),
        "kafka_payload": (f"SELECT to_json({{'title': title, 'author': author, 'text': text, 'summary': summary, "
                          f"'url': url, 'source': source, 'published_at': published_at, 'scraped_at': scraped_at, "
                          f"'url_hash': url_hash, 'fingerprint': fingerprint, 'author_source': author_source, "
                          f"'summary_max_chars': summary_max_chars, 'summary_truncated': summary_truncated, "
                          f"'parse_ok': parse_ok, 'parse_error': parse_error, 'extraction_method': extraction_method, "
                          f"'content_length_chars': content_length_chars}}) AS value FROM ({G})"),
        "site_url_rules": (f"SELECT event_id, url, " + ", ".join(f"{site_expr('url', rs)} AS {rs}" for rs in SITE_SETS)
                           + f", coalesce({f3_expr('lower(p_path)')}, false) AS generic FROM "
                           f"({split_cte(f'({event_urls()})', 'url', 'p_')})"),
        # elements are start tags, texts what stands between two tags
        "html_nodes": (f"SELECT page_id, n_text + n_elements AS n_nodes, n_text, n_elements, CAST(NULL AS VARCHAR) AS parse_error "
                       f"FROM (SELECT page_id, CAST(len(regexp_extract_all(m, '>[^<]+')) AS INTEGER) AS n_text, "
                       f"CAST(len(regexp_extract_all(m, '<[a-zA-Z]')) AS INTEGER) AS n_elements FROM ({MARKUP}))"),
        "page_extracted": doc_site("ap", page=True, extracted=True),
        **{f"page_site_{rs}": doc_site(rs, page=True) for rs in SITE_SETS},
        "parse_dates": f"SELECT event_id, raw, {X5_SQL} AS iso_utc FROM ({event_dates()})",
        "meta_dates": f"SELECT event_id, raw, {X7_SQL} AS iso_utc FROM ({event_dates()})",
    }
    sqls["page_articles"] = page_articles()
    sqls["page_quality"] = quality_sql(page_articles(), "source")
    scripts = "CAST(len(regexp_extract_all(html, '(?i)<script[^>]*application/ld.json')) AS INTEGER)"
    sqls["jsonld_blocks"] = f"SELECT page_id, {scripts} AS n_scripts, {scripts} AS n_blocks FROM pages"
    sqls["page_jsonld"] = ("SELECT doc_id AS page_id, CAST(doc_id % 6 = 0 AS INTEGER) AS n_scripts, CAST(CASE WHEN doc_id % 6 = 0 THEN 2 ELSE 0 END AS INTEGER) "
                           "AS n_blocks FROM documents")
    sqls["page_generic"] = page_generic()
    sqls |= {f"page_dates_{rs}": page_dates(rs) for rs in SITE_SETS}
    # another way to the same rows
    for name, same in (("insert_keyed", "insert_if_absent"), ("frontier_indexed", "frontier"), ("site_frontier_indexed", "site_frontier"),
                       ("run_observed", "run_counters")):
        sqls[name] = sqls[same]
    both = f"SELECT * EXCLUDE (doc_id) FROM ({G}) UNION ALL BY NAME SELECT * EXCLUDE (doc_id, confidence) FROM ({doc_site('nbc')})"
    dims = "source, extraction_method"
    sqls["quality_rollup"] = (quality_sql(both, dims).replace("SELECT " + dims, f"SELECT {dims}, CAST(GROUPING({dims}) AS BIGINT) AS level")
                              .replace(f"GROUP BY {dims}", f"GROUP BY ROLLUP ({dims})"))
    return sqls


ORACLE_SQL = build()
