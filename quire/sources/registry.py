"""The source registry, seeds, source selection and page routing.

The registry is a handful of rows (one per outlet). Routing a page or link to its source is a
host-suffix lookup: the host's dot-suffixes are probed against a literal map built from the
registry, longest suffix first. That is the equi-join of J1 without a join operator: no
shuffle, no nested-loop join. A registry of more than ``EMBED_DOMAINS`` domains is joined with the
distinct hosts instead.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire import constants as C
from quire.functions.urls import host_suffixes

EMBED_DOMAINS = 1_000  # up to so many domains are embedded in the plan; more are joined

SOURCE_SCHEMA = T.StructType([
    T.StructField("source_name", T.StringType(), False),
    T.StructField("domain", T.StringType(), False),
    T.StructField("allowed_domains", T.ArrayType(T.StringType()), False),
    T.StructField("start_urls", T.ArrayType(T.StringType()), False),
    T.StructField("rule_set", T.StringType(), False),
])


@dataclass(frozen=True)
class Source:
    source_name: str
    domain: str
    allowed_domains: tuple[str, ...]
    start_urls: tuple[str, ...] = field(default_factory=tuple)
    rule_set: str = "generic"


def default_registry() -> list[Source]:
    """The seven registered outlets."""
    return [Source(n, d, tuple(a), tuple(s), r) for n, d, a, s, r in C.SOURCES]


def test_registry() -> list[Source]:
    """Registry for the driver's test tables, whose hosts live under example.{com,net,org}:
    .org pages take the BBC rules, .com pages the Guardian rules, .net pages the generic rules."""
    return [
        Source("example-org", "example.org", ("example.org",), ("https://example.org/",), "bbc"),
        Source("example-com", "example.com", ("example.com",), ("https://example.com/",), "guardian"),
        Source("example-net", "example.net", ("example.net",), ("https://example.net/",), "generic"),
    ]


def sources_df(spark: SparkSession, registry: list[Source] | None = None) -> DataFrame:
    """The registry as a DataFrame."""
    reg = registry if registry is not None else default_registry()
    rows = [(s.source_name, s.domain, list(s.allowed_domains), list(s.start_urls), s.rule_set) for s in reg]
    return spark.createDataFrame(rows, SOURCE_SCHEMA)


def select_sources(registry: list[Source], name: str | None) -> list[Source]:
    """One source by name, or all sorted by name; an unknown name lists the known ones."""
    if name is None:
        return sorted(registry, key=lambda s: s.source_name)
    hit = [s for s in registry if s.source_name == name]
    if not hit:
        known = ", ".join(sorted(s.source_name for s in registry))
        raise ValueError(f"Unknown source '{name}'. Known sources: {known}")
    return hit


def seeds_df(spark: SparkSession, registry: list[Source], override: str | None = None) -> DataFrame:
    """S3: seed URLs per source; a comma list overrides them (trimmed, blanks dropped, an
    all-blank list is ignored)."""
    df = sources_df(spark, registry)
    urls = F.col("start_urls")
    if override is not None:
        listed = F.filter(F.transform(F.split(F.lit(override), ","), lambda u: F.trim(u)), lambda u: u != "")
        urls = F.when(F.size(listed) > 0, listed).otherwise(urls)
    return df.select("source_name", "domain", "rule_set", F.posexplode(urls).alias("seed_pos", "url"))


def registry_from_df(df: DataFrame) -> list[Source]:
    """A registry table (one row per outlet) as a list."""
    return [Source(r.source_name, r.domain, tuple(r.allowed_domains), tuple(r.start_urls), r.rule_set)
            for r in df.collect()]


def _domain_map(registry: list[Source]) -> Column:
    """domain → struct(source_name, source, rule_set, allowed_domains); first source wins a domain."""
    seen: dict[str, Source] = {}
    for s in registry:
        for d in s.allowed_domains:
            seen.setdefault(d.lower(), s)
    if not seen:
        return F.create_map().cast("map<string,struct<source_name:string,source:string,rule_set:string,"
                                   "allowed_domains:array<string>>>")
    kv = []
    for d, s in seen.items():
        kv += [F.lit(d), F.struct(F.lit(s.source_name).alias("source_name"), F.lit(s.domain).alias("source"),
                                  F.lit(s.rule_set).alias("rule_set"),
                                  F.array(*[F.lit(a) for a in s.allowed_domains]).alias("allowed_domains"))]
    return F.create_map(*kv)


def route(host: Column, registry: list[Source]) -> Column:
    """The registered source of a host (longest matching domain), NULL if none."""
    m = _domain_map(registry)
    return F.try_element_at(F.filter(F.transform(host_suffixes(host), lambda s: F.try_element_at(m, s)),
                                     lambda x: x.isNotNull()), F.lit(1))


def route_by_join(df: DataFrame, registry: list[Source]) -> DataFrame:
    """J1/J2 for large registries: ``df`` with ``_src``. The distinct hosts' suffixes meet the domains
    in an equi-join; a host keeps its longest one. Rows join their host, which is unique there."""
    rows = [(d.lower(), k, s.source_name, s.domain, s.rule_set, list(s.allowed_domains)) for k, s in enumerate(registry) for d in s.allowed_domains]
    domains = df.sparkSession.createDataFrame(
        rows, "suffix string, k int, source_name string, source string, rule_set string, allowed_domains array<string>")
    src = F.struct("source_name", "source", "rule_set", "allowed_domains")
    domains = domains.groupBy("suffix").agg(F.min_by(src, "k").alias("_src"))
    hosts = df.select(F.col("host").alias("_host")).where("host is not null").distinct()
    hosts = hosts.select("_host", F.posexplode(host_suffixes(F.col("_host"))).alias("_pos", "suffix")).join(domains, "suffix")
    hosts = hosts.groupBy("_host").agg(F.min_by("_src", "_pos").alias("_src"))
    return df.join(hosts, df["host"] == hosts["_host"], "left").drop("_host")


def same_domain(host: Column, allowed_domains: Column) -> Column:
    """host equals an allowed domain or ends with "." + one of them."""
    return F.coalesce(F.arrays_overlap(host_suffixes(host), allowed_domains), F.lit(False))
