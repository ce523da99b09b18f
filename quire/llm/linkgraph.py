"""URL filters by rules and by propagation over the host link graph.

A rule names a host and a path; it fits the host and all its subdomains where the path starts with
the rule's; the longest fitting rule wins. Urls without a rule are judged by their host: hosts
with allowed urls are trusted seeds, hosts with blocked urls are distrusted seeds. Trust is the
personalised PageRank of the trusted seeds along links. Distrust goes against links, from the distrusted
seeds: a host has, damped, the distrust of the hosts that it links to, by the share of its own links. That
is what the host's own personalised PageRank leaves at the seeds, and it does not depend on
how many others link there. A host is blocked if its distrust reaches THRESHOLD and exceeds its trust.

Links are the absolute ``http(s)://`` or ``//`` targets of href attributes in the whole page.
A link of a page counts once; an edge weighs its share of its host's links to other hosts.

All of it is DataFrame operations. Edges are counted in the map tasks before they are shuffled,
and each round of the walk is two aggregates and a join over host edges.

Defined results. A url that is null or has no ``://`` has an empty host and path, no rule, and is
allowed, as is any host without links to or from a seed. A page without html has no links. Repeated
rows are judged alike and their links count again. Ties between equally long rules go to the
one that sorts first. An empty table gives an empty table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import stored

RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
ALLOW, BLOCK = "allow", "block"
DAMPING, ROUNDS = 0.85, 20
#: Blocked: a distrust of half a wholly blocked seed's, and more than the trust. (A host whose links all
#: go to blocked hosts has DAMPING.)
THRESHOLD = 0.5
#: Host tables of up to so many rows go to all tasks.
HOSTS_TO_SEND = 50_000


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: str) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: str) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=None) -> tuple[Column, Column]:
    """(rule as text, its verdict) of the longest fitting rule; null where none fits."""
    order = sorted(rules or RULES, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    name, verdict = None, None
    for said, h, p in order:
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = (F.when if name is None else name.when)(fits, F.lit(h + p))
        verdict = (F.when if verdict is None else verdict.when)(fits, F.lit(said))
    return name, verdict


def judged(pages: DataFrame, rules=None) -> DataFrame:
    """page_id, host, path, rule, verdict by rule (null without one)."""
    p = pages.select("page_id", host_of("url").alias("host"), path_of("url").alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return p.select("*", rule.alias("rule"), verdict.alias("ruled"))


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, share): links between different hosts; a host's shares sum to 1."""
    link = r"""(?i)<[^<>]*?\shref\s*=\s*["']?(?:https?:)?//([^/?#"'\s<>]+)"""
    targets = F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(link), 1), lower_ascii))
    rows = (pages.where(F.coalesce(F.contains("html", F.lit("//")), F.lit(False)))
            .select(host_of("url").alias("src"), F.explode(targets).alias("dst")).where("src <> '' and src <> dst"))
    counted = rows.groupBy("src", "dst").agg(F.count("*").alias("n"))
    out = counted.groupBy("src").agg(F.sum("n").alias("all"))
    return counted.join(out, "src").select("src", "dst", (F.col("n") / F.col("all")).alias("share"))


def walk(edges: DataFrame, seeds: DataFrame, forward: bool) -> DataFrame:
    """(host, p): the seeds' weights ``start`` and what reaches a host from them, each step times
    DAMPING. Along links it is personalised PageRank in units of a seed's own part; against links it
    is what a walk from the host leaves at the seeds. Without edges nothing moves."""
    a, b = ("src", "dst") if forward else ("dst", "src")
    edges = stored(edges.select(F.col(a).alias("a"), F.col(b).alias("host"), "share"))
    p = seeds.select("host", F.col("start").alias("p"))
    if not edges.take(1):
        return p
    for _ in range(ROUNDS):
        moved = edges.join(p.withColumnRenamed("host", "a"), "a").select("host", (F.col("p") * F.col("share") * DAMPING).alias("p"))
        own = seeds.select("host", F.col("start").alias("p"))
        p = stored(own.unionByName(moved).groupBy("host").agg(F.sum("p").alias("p")))
    return p


def host_verdicts(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """(host, trust, distrust, said). Hosts are those of pages or links. A host's weight as a seed is
    the share of its pages that are allowed, or blocked, by rule."""
    share = lambda v: F.avg((F.coalesce(F.col("ruled"), F.lit("")) == v).cast("double"))
    paged = rows.where("host <> ''").groupBy("host").agg(share(ALLOW).alias("good"), share(BLOCK).alias("bad"))
    linked = edges.select(F.col("src").alias("host")).union(edges.select(F.col("dst").alias("host"))).distinct()
    # a linked host without pages is a seed if a rule holds for all of its urls
    _, root = rule_of(F.col("host"), F.lit("/"))
    linked = linked.join(paged, "host", "left_anti").select(
        "host", F.coalesce((root == ALLOW).cast("double"), F.lit(0.0)).alias("good"), F.coalesce((root == BLOCK).cast("double"), F.lit(0.0)).alias("bad"))
    hosts = stored(paged.unionByName(linked))

    def seeded(column: str) -> DataFrame:
        return hosts.where(F.col(column) > 0).select("host", F.col(column).alias("start"))

    good = walk(edges, seeded("good"), True).withColumnRenamed("p", "trust")
    bad = walk(edges, seeded("bad"), False).withColumnRenamed("p", "distrust")
    out = hosts.select("host").join(good, "host", "left").join(bad, "host", "left").na.fill(0.0)
    said = F.when((F.col("distrust") >= THRESHOLD) & (F.col("distrust") > F.col("trust")), BLOCK).otherwise(ALLOW)
    return out.withColumn("said", said)


def query(pages: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict of every page; trust and distrust of its host."""
    rows = stored(judged(pages))
    hosts = stored(host_verdicts(rows, stored(host_edges(pages))))
    if hosts.count() <= HOSTS_TO_SEND:
        hosts = F.broadcast(hosts)
    out = rows.join(hosts, "host", "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("ruled", "said", F.lit(ALLOW)).alias("verdict"))


#: Pages of linked hosts, one for each row of ``events``, in SQL that Spark and DuckDB read alike: hosts g*.com,
#: which the rules allow, bad*.net, whose pages they block, and s0 to s59.org, of which the first twenty link to bad
#: hosts only, the next twenty on every second page, the others among themselves.
EVENT_HOST = ("CASE WHEN event_id % 10 = 0 THEN concat('bad', CAST(event_id % 3 AS STRING), '.net') WHEN event_id % 10 = 1 "
              "THEN concat('g', CAST(event_id % 4 AS STRING), '.com') ELSE concat('s', CAST(event_id % 60 AS STRING), '.org') END")
EVENT_LINK = ("CASE WHEN event_id % 10 < 2 THEN concat('s', CAST(event_id % 7 * 9 AS STRING), '.org') WHEN event_id % 60 < 20 OR event_id % 60 < 40 "
              "AND CAST(floor(event_id / 60.0) AS BIGINT) % 2 = 0 THEN concat('bad', CAST(event_id % 3 AS STRING), '.net') "
              "ELSE concat('S', CAST(event_id * 7 % 60 AS STRING), '.org') END")
EVENT_PAGES = (f"SELECT event_id AS page_id, concat('https://', {EVENT_HOST}, CASE WHEN event_id % 10 = 0 THEN '/es/' ELSE '/p/' END, CAST(event_id AS STRING)) AS url, "
               f"concat('<p>see <a class=x href=\"http://', {EVENT_LINK}, '/es/1\">this</a> and <a href=\"/own\">that</a></p>') AS html FROM events")


def linked_events(events: DataFrame) -> DataFrame:
    """The verdicts of the pages of EVENT_PAGES."""
    host, link = F.expr(EVENT_HOST), F.expr(EVENT_LINK)
    url = F.concat(F.lit("https://"), host, F.when(F.col("event_id") % 10 == 0, "/es/").otherwise("/p/"), F.col("event_id").cast("string"))
    html = F.concat(F.lit('<p>see <a class=x href="http://'), link, F.lit('/es/1">this</a> and <a href="/own">that</a></p>'))
    return query(events.select(F.col("event_id").alias("page_id"), url.alias("url"), html.alias("html")))


def _oracle(pages: str = "pages") -> str:
    """The same in SQL; each round of the walk is a table of its own."""
    order = sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))

    def case(host: str, path: str, value) -> str:
        fits = [f"WHEN ({host} = '{r[1]}' OR ends_with({host}, '.{r[1]}')) AND starts_with({path}, '{r[2]}') THEN '{value(r)}'" for r in order]
        return "CASE " + " ".join(fits) + " END"

    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    link = r"""(?i)<[^<>]*?\shref\s*=\s*["'']?(?:https?:)?//([^/?#"''\s<>]+)"""
    walks = ""
    for name, column, a, b, edges in (("t", "good", "src", "dst", "e"), ("u", "bad", "dst", "src", "e")):
        walks += f"{name}0 AS MATERIALIZED (SELECT host, {column} AS p FROM h WHERE {column} > 0),\n"
        for k in range(1, ROUNDS + 1):
            walks += (f"{name}{k} AS MATERIALIZED (SELECT host, sum(p) AS p FROM (SELECT * FROM {name}0 UNION ALL "
                      f"SELECT {b}, p * share * {DAMPING} FROM {edges} JOIN {name}{k - 1} w ON w.host = {edges}.{a}) GROUP BY host),\n")
    return f"""
WITH p AS MATERIALIZED (SELECT page_id, html, {lower.format("coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), '')")} AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM {pages}),
r AS MATERIALIZED (SELECT *, {case("host", "path", lambda r: r[1] + r[2])} AS rule, {case("host", "path", lambda r: r[0])} AS ruled FROM p),
c AS (SELECT host AS src, dst, count(*) AS n FROM (
    SELECT host, unnest(list_distinct(list_transform(regexp_extract_all(html, '{link}', 1), lambda x: {lower.format("x")}))) AS dst FROM p)
  WHERE host <> '' AND host <> dst GROUP BY ALL),
e AS MATERIALIZED (SELECT src, dst, n / sum(n) OVER (PARTITION BY src) AS share FROM c),
h0 AS (SELECT host, avg(CASE WHEN ruled = 'allow' THEN 1 ELSE 0 END) AS good, avg(CASE WHEN ruled = 'block' THEN 1 ELSE 0 END) AS bad
  FROM r WHERE host <> '' GROUP BY host),
h1 AS (SELECT host, {case("host", "'/'", lambda r: r[0])} AS ruled FROM (SELECT src AS host FROM e UNION SELECT dst FROM e)),
h AS MATERIALIZED (SELECT * FROM h0 UNION ALL SELECT host, CASE WHEN ruled = 'allow' THEN 1 ELSE 0 END, CASE WHEN ruled = 'block' THEN 1 ELSE 0 END
  FROM h1 WHERE host NOT IN (SELECT host FROM h0)),
{walks}v AS (SELECT h.host, CASE WHEN coalesce(u{ROUNDS}.p, 0) >= {THRESHOLD} AND coalesce(u{ROUNDS}.p, 0) > coalesce(t{ROUNDS}.p, 0)
    THEN 'block' ELSE 'allow' END AS said FROM h LEFT JOIN t{ROUNDS} USING (host) LEFT JOIN u{ROUNDS} USING (host))
SELECT r.page_id, r.host, r.path, r.rule, coalesce(r.ruled, v.said, 'allow') AS verdict FROM r LEFT JOIN v USING (host)
"""


ORACLE_SQL = _oracle()
LINKED_SQL = _oracle(f"({EVENT_PAGES})")
