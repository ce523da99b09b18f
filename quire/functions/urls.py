"""URL columns: split, canonical form and hash, host, link resolution, URL rules.

Everything here is a Catalyst expression (regex + higher-order array functions), so it runs
inside the JVM next to the scan; no Python per row. Semantics follow the RFC 3986 style
splitting of Python's ``urllib.parse`` (the behaviour the article keys rely on).

The functions are DataFrame → DataFrame steps that stage intermediate parts as columns: a
part used several times is computed once (Catalyst does not collapse a projection when that
would duplicate a costly expression), and expression trees stay small.
"""

from __future__ import annotations

import itertools
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire import constants as C

# scheme ":" ["//" netloc] path ["?" query] ["#" fragment]
_URL_RE = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
# path ";" params, where params start at the first ";" after the last "/"
_PARAMS_RE = r"(?s)^(.*?)(?:;([^/]*))?$"

USES_PARAMS = ["", "ftp", "hdl", "prospero", "http", "imap", "https", "shttp", "rtsp", "rtsps",
               "rtspu", "sip", "sips", "mms", "sftp", "tel"]
USES_NETLOC = ["", "ftp", "http", "gopher", "nntp", "telnet", "imap", "wais", "file", "mms", "https",
               "shttp", "snews", "prospero", "rtsp", "rtsps", "rtspu", "rsync", "svn", "svn+ssh", "sftp",
               "nfs", "git", "git+ssh", "ws", "wss", "itms-services"]
USES_RELATIVE = ["", "ftp", "http", "gopher", "nntp", "imap", "wais", "file", "https", "shttp", "mms",
                 "prospero", "rtsp", "rtsps", "rtspu", "sftp", "svn", "svn+ssh", "ws", "wss"]

_ids = itertools.count()


def _tmp(name: str) -> str:
    return f"__{name}_{next(_ids)}"


def _in(c: Column, values) -> Column:
    return c.isin(*[F.lit(v) for v in values])


# ------------------------------------------------------------------ parts


PARTS = ("scheme", "netloc", "path", "params", "query", "fragment")


def _cleaned(u: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(u, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")


def _raw_parts(s: Column, default_scheme: Column | None) -> dict[str, Column]:
    """Parts of a cleaned URL; ``fp`` is the path with its params."""
    scheme = F.lower(F.regexp_extract(s, _URL_RE, 1))
    if default_scheme is not None:
        scheme = F.when(scheme == "", default_scheme).otherwise(scheme)
    return {"scheme": scheme, "netloc": F.regexp_extract(s, _URL_RE, 2), "fp": F.regexp_extract(s, _URL_RE, 3),
            "query": F.regexp_extract(s, _URL_RE, 4), "fragment": F.regexp_extract(s, _URL_RE, 5)}


def _path_params(scheme: Column, fp: Column) -> dict[str, Column]:
    split = _in(scheme, USES_PARAMS) & fp.contains(";")
    return {"path": F.when(split, F.regexp_extract(fp, _PARAMS_RE, 1)).otherwise(fp),
            "params": F.when(split, F.regexp_extract(fp, _PARAMS_RE, 2)).otherwise(F.lit(""))}


def add_url_parts(df: DataFrame, src: str, prefix: str, default_scheme: str | None = None) -> DataFrame:
    """Adds ``{prefix}scheme/netloc/path/params/query/fragment`` for the URL in ``src``.

    Leading control/space characters are dropped and tab/CR/LF removed first; ``params`` is the
    part after the first ``;`` of the last path segment. ``default_scheme`` names a column
    used when the URL has no scheme (as for a relative link).
    """
    s, fp = _tmp("s"), _tmp("fp")
    df = df.withColumn(s, _cleaned(F.col(src)))
    raw = _raw_parts(F.col(s), F.col(default_scheme) if default_scheme is not None else None)
    df = df.select("*", *[c.alias(fp if n == "fp" else prefix + n) for n, c in raw.items()])
    df = df.select("*", *[c.alias(prefix + n) for n, c in _path_params(F.col(prefix + "scheme"), F.col(fp)).items()])
    return df.drop(s, fp)


class Elements:
    """The structs of an array column, widened stage by stage without exploding them: each ``add``
    is one ``transform``, whose fields the next stage reads as often as it likes."""

    def __init__(self, df: DataFrame, array: str, fields: list[str]):
        self.df, self.array, self.fields = df, array, fields

    def add(self, make) -> Elements:
        """New fields from ``make(element)``, a dict of columns; fields of the same name are replaced."""
        new: list[str] = []

        def one(x):
            made = make(x)
            new[:] = made
            return F.struct(*[x[k].alias(k) for k in self.fields if k not in made], *[c.alias(k) for k, c in made.items()])

        df = self.df.withColumn(self.array, F.transform(F.col(self.array), one))
        return Elements(df, self.array, [k for k in self.fields if k not in new] + new)

    def keep(self, *fields: str) -> Elements:
        df = self.df.withColumn(self.array, F.transform(F.col(self.array), lambda x: F.struct(*[x[k].alias(k) for k in fields])))
        return Elements(df, self.array, list(fields))

    def add_url_parts(self, src: str, prefix: str, default_scheme: Column | None = None) -> Elements:
        named = lambda parts: {prefix + n: c for n, c in parts.items()}
        return (self.add(lambda x: {prefix + "s": _cleaned(x[src])})
                .add(lambda x: named(_raw_parts(x[prefix + "s"], default_scheme)))
                .add(lambda x: named(_path_params(x[prefix + "scheme"], x[prefix + "fp"]))))

    def add_resolved_url(self, base: str, base_prefix: str, href: str, out: str) -> Elements:
        """P2 for each element's ``href`` against the row's ``base``, whose parts are columns."""
        b = lambda n: F.col(base_prefix + n)
        return (self.add_url_parts(href, "r_", b("scheme"))
                .add(lambda x: {"segs": _segments(b, lambda n: x["r_" + n])})
                .add(lambda x: {"jp": _joined(x["segs"]), "net": _authority(b, lambda n: x["r_" + n])})
                .add(lambda x: {out: _resolved(F.col(base), x[href], b, lambda n: x["r_" + n], x["jp"], x["net"])}))

    def add_url_hash(self, src: str, out: str) -> Elements:
        """X2 of each element's URL."""
        part = lambda x: lambda n: x["c_" + n]
        return (self.add_url_parts(src, "c_")
                .add(lambda x: dict(zip(("cq", "pp", "net"), _canonical_parts(part(x), True))))
                .add(lambda x: {out: F.sha2(_canonical(x[src], part(x), x["cq"], x["pp"], x["net"]), 256)}))


def unsplit(scheme: Column, netloc: Column, path_params: Column, query: Column, fragment: Column) -> Column:
    """Reassemble parts as ``urlunsplit`` does; ``path_params`` is path plus ``;params``.

    Each input should be a plain column reference (it is used more than once).
    """
    pp = path_params
    lead = (
        F.when(netloc != "", F.concat(F.lit("//"), netloc,
                                      F.when((pp == "") | pp.startswith("/"), F.lit("")).otherwise(F.lit("/"))))
        .when(pp.startswith("//"), F.lit("//"))
        .when((scheme != "") & _in(scheme, USES_NETLOC) & ((pp == "") | pp.startswith("/")), F.lit("//"))
        .otherwise(F.lit(""))
    )
    return F.concat(
        F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(F.lit("")),
        lead, pp,
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")),
        F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(F.lit("")),
    )


def with_params(path: Column, params: Column) -> Column:
    return F.concat(path, F.when(params != "", F.concat(F.lit(";"), params)).otherwise(F.lit("")))


# ------------------------------------------------------------------ query


def query_decode(x: Column) -> Column:
    """``+`` → space and ``%xx`` decoded; a ``%`` not followed by two hex digits stays literal."""
    return F.try_url_decode(F.regexp_replace(x, r"%(?![0-9A-Fa-f]{2})", "%25"))


def query_encode(x: Column) -> Column:
    """Form encoding with ``~`` kept and ``*`` escaped (space → ``+``)."""
    return F.replace(F.replace(F.url_encode(x), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def tracking_keys(fix_case: bool = True) -> list[str]:
    """Keys removed from the query. ``fix_case`` lower-cases the list too, so ``trkInfo``
    matches; with ``False`` the list is compared as written and ``trkInfo`` never matches."""
    return [k.lower() for k in C.TRACKING_PARAMS] if fix_case else list(C.TRACKING_PARAMS)


def clean_query(query: Column, fix_case: bool = True) -> Column:
    """Drop valueless pairs and tracking keys; group repeated keys at their first position;
    re-encode. Pairs need ``=`` and a non-empty raw value."""
    keys = tracking_keys(fix_case)
    pairs = F.filter(F.split(query, "&"), lambda p: (F.instr(p, "=") > 0) & (F.instr(p, "=") < F.length(p)))
    decoded = F.transform(pairs, lambda p: F.struct(
        query_decode(F.substring_index(p, "=", 1)).alias("k"),
        query_decode(F.regexp_extract(p, r"(?s)^[^=]*=(.*)$", 1)).alias("v")))
    kept = F.filter(decoded, lambda kv: ~_in(F.lower(kv["k"]), keys))
    key_list = F.transform(kept, lambda kv: kv["k"])
    ordered = F.array_sort(F.transform(kept, lambda kv, i: F.struct(
        F.array_position(key_list, kv["k"]).alias("g"), i.alias("i"), kv["k"].alias("k"), kv["v"].alias("v"))))
    return F.array_join(F.transform(ordered, lambda kv: F.concat(query_encode(kv["k"]), F.lit("="),
                                                                  query_encode(kv["v"]))), "&")


# ------------------------------------------------------------------ X1 / X2 / X10


def _canonical_parts(c, fix_case: bool) -> tuple[Column, Column, Column]:
    """(query, path with params, authority) of the canonical URL; ``c(name)`` is a part."""
    path = F.when(c("path") == "/", F.lit("/")).otherwise(F.regexp_replace(c("path"), "/+$", ""))
    return clean_query(c("query"), fix_case), with_params(path, c("params")), F.lower(c("netloc"))


def _canonical(u: Column, c, cq: Column, pp: Column, net: Column) -> Column:
    bad = (c("netloc").contains("[") & ~c("netloc").contains("]")) | (c("netloc").contains("]") & ~c("netloc").contains("["))
    return F.when(u.isNull(), F.lit(None)).when(bad, u).otherwise(unsplit(c("scheme"), net, pp, cq, F.lit("")))


def add_canonical_url(df: DataFrame, src: str = "url", out: str = "canonical_url",
                      fix_case: bool = True) -> DataFrame:
    """Canonical URL — fragment dropped, scheme and authority lower-cased, trailing
    slashes of the path stripped (except a bare "/"), query cleaned. Malformed brackets in
    the authority leave the raw URL."""
    p = _tmp("p")
    df = add_url_parts(df, src, p)
    c = lambda n: F.col(p + n)
    names = [_tmp("cq"), _tmp("pp"), _tmp("net")]
    df = df.select("*", *[x.alias(n) for x, n in zip(_canonical_parts(c, fix_case), names)])
    df = df.withColumn(out, _canonical(F.col(src), c, *[F.col(n) for n in names]))
    return df.drop(*[p + n for n in PARTS], *names)


def add_url_hash(df: DataFrame, src: str = "url", out: str = "url_hash", fix_case: bool = True,
                 keep_canonical: str | None = None) -> DataFrame:
    """SHA-256 hex of the canonical URL."""
    canon = keep_canonical or _tmp("canon")
    df = add_canonical_url(df, src, canon, fix_case)
    df = df.withColumn(out, F.sha2(F.col(canon), 256))
    return df if keep_canonical else df.drop(canon)


def host_of(netloc: Column) -> Column:
    """Lower-case host of a netloc (no user info, no port, IPv6 brackets removed)."""
    hostinfo = F.regexp_extract(netloc, r"(?s)([^@]*)$", 1)
    return F.lower(F.when(hostinfo.contains("["), F.regexp_extract(hostinfo, r"(?s)\[([^\]]*)", 1))
                   .otherwise(F.substring_index(hostinfo, ":", 1)))


def add_host(df: DataFrame, src: str = "url", out: str = "host") -> DataFrame:
    p = _tmp("p")
    df = add_url_parts(df, src, p)
    df = df.withColumn(out, host_of(F.col(p + "netloc")))
    return df.drop(*[p + n for n in ("scheme", "netloc", "path", "params", "query", "fragment")])


def host_suffixes(h: Column) -> Column:
    """All dot-suffixes of a host: a.b.c → [a.b.c, b.c, c] (for the domain equi-join)."""
    labels = F.split(h, r"\.")
    n = F.size(labels)
    return F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
                       lambda i: F.array_join(F.slice(labels, i, n - i + 1), "."))


# ------------------------------------------------------------------ P2


def _segments(bc, rc) -> Column:
    """Path segments of a reference put behind the base's folder; ``bc`` and ``rc`` give parts."""
    base_parts = F.split(bc("path"), "/")
    base_dir = F.when(F.element_at(base_parts, -1) != "", F.slice(base_parts, 1, F.size(base_parts) - 1)) \
        .otherwise(base_parts)
    rel = F.concat(base_dir, F.split(rc("path"), "/"))
    return F.when(rc("path").startswith("/"), F.split(rc("path"), "/")).otherwise(
        F.filter(rel, lambda s, i: (i == 0) | (i == F.size(rel) - 1) | (s != "")))


def _joined(segs: Column) -> Column:
    """The path of the segments, dot segments folded."""
    folded = F.aggregate(
        segs, F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.when(F.size(acc) > 0, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc))
        .when(s == ".", acc).otherwise(F.concat(acc, F.array(s))))
    folded = F.when(_in(F.element_at(segs, -1), [".", ".."]), F.concat(folded, F.array(F.lit("")))).otherwise(folded)
    return F.array_join(folded, "/")


def _authority(bc, rc) -> Column:
    return F.when(_in(rc("scheme"), USES_NETLOC), bc("netloc")).otherwise(rc("netloc"))


def _resolved(base: Column, href: Column, bc, rc, jp: Column, net: Column) -> Column:
    merged = unsplit(rc("scheme"), net, with_params(F.when(jp == "", F.lit("/")).otherwise(jp), rc("params")),
                     rc("query"), rc("fragment"))
    inherit = unsplit(rc("scheme"), net, with_params(bc("path"), bc("params")),
                      F.when(rc("query") == "", bc("query")).otherwise(rc("query")), rc("fragment"))
    own = unsplit(rc("scheme"), rc("netloc"), with_params(rc("path"), rc("params")), rc("query"), rc("fragment"))
    same = (rc("scheme") == bc("scheme")) & _in(rc("scheme"), USES_RELATIVE)
    return (F.when(base.isNull() | (base == ""), href)
            .when(href.isNull() | (href == ""), base)
            .when(~same, href)
            .when(_in(rc("scheme"), USES_NETLOC) & (rc("netloc") != ""), own)
            .when((rc("path") == "") & (rc("params") == ""), inherit)
            .otherwise(merged))


def add_resolved_url(df: DataFrame, base: str, href: str, out: str) -> DataFrame:
    """Absolute URL of ``href`` against ``base`` (``urljoin`` rules, dot segments folded)."""
    b, r = _tmp("b"), _tmp("r")
    df = add_url_parts(df, base, b)
    df = add_url_parts(df, href, r, default_scheme=b + "scheme")
    bc = lambda n: F.col(b + n)
    rc = lambda n: F.col(r + n)
    segs, jp, net = _tmp("segs"), _tmp("jp"), _tmp("net")
    df = df.withColumn(segs, _segments(bc, rc))
    df = df.select("*", _joined(F.col(segs)).alias(jp), _authority(bc, rc).alias(net))
    df = df.withColumn(out, _resolved(F.col(base), F.col(href), bc, rc, F.col(jp), F.col(net)))
    return df.drop(*[b + n for n in PARTS], *[r + n for n in PARTS], segs, jp, net)


# ------------------------------------------------------------------ URL predicates


def is_valid_url(u: Column) -> Column:
    """http(s) scheme (case-sensitive) and no feed/sitemap word anywhere in the URL."""
    return (u.startswith("http://") | u.startswith("https://")) & ~F.lower(u).rlike("|".join(C.FEED_PATTERNS))


def deny_regex() -> str:
    """The section deny list as one anchored, case-insensitive alternation."""
    return "(?i)^(?:" + "|".join(p[1:] for p in C.SECTION_DENY_PATTERNS) + ")"


def article_path_rule(path: Column) -> Column:
    """F3 on an already lower-cased path (pass a column reference: it is used several times)."""
    return (
        F.when(path.rlike(deny_regex()), False)
        .when(path.contains("/article/") | path.contains("/articles/"), True)
        .when(path.rlike(r"/[0-9]{4}/[0-9]{2}/[0-9]{2}/"), True)
        .when(path.rlike(r"-[0-9]{6,}$") | path.rlike(r"-[0-9]{6,}\.html?$"), True)
        .when(path.rlike(r"/([a-z0-9]+-){4,}[a-z0-9]+/?$"), True)
        .when(path.rlike(r"^/news/.+") & (F.length(path) > 10), True)
        .when(F.length(F.regexp_replace(path, "/+$", "")) < 15, False)
        .otherwise(True)
    )


def _pattern(kind: str, regex: str, ci: bool) -> str:
    regex = regex.replace(r"\d", "[0-9]")
    return ("(?i)" if ci else "") + ("^(?:" + regex + ")" if kind == "match" else regex)


def site_url_regexes(rule_set: str) -> tuple[list[str], list[str]]:
    reject, accept = C.SITE_URL_RULES[rule_set]
    return [_pattern(*p) for p in reject], [_pattern(*p) for p in accept]


def url_rule(u: Column, reject: list, accept: list) -> Column:
    """A site's reject list, then its accept list, on the whole URL."""
    hit = lambda patterns: reduce(or_, [u.rlike(_pattern(*p)) for p in patterns], F.lit(False))
    return ~hit(reject) & hit(accept)


def site_url_rule(u: Column, rule_set: str) -> Column:
    """The URL rule of a built-in rule set."""
    return url_rule(u, *C.SITE_URL_RULES[rule_set])


def add_article_url_flag(df: DataFrame, src: str, out: str, rule_set: str | Column = "generic") -> DataFrame:
    """URL-only article test, by a fixed rule set or by a rule-set column."""
    p = _tmp("p")
    df = add_url_parts(df, src, p)
    lp = _tmp("lp")
    df = df.withColumn(lp, F.lower(F.col(p + "path")))
    generic = article_path_rule(F.col(lp))
    u = F.col(src)
    if isinstance(rule_set, str):
        flag = generic if rule_set == "generic" else site_url_rule(u, rule_set)
    else:
        flag = F.when(F.lit(False), F.lit(None))
        for rs in C.SITE_URL_RULES:
            flag = flag.when(rule_set == rs, site_url_rule(u, rs))
        flag = flag.otherwise(generic)
    df = df.withColumn(out, F.when(u.isNull(), F.lit(False)).otherwise(flag))
    return df.drop(*[p + n for n in ("scheme", "netloc", "path", "params", "query", "fragment")], lp)
