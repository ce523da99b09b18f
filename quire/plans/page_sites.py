"""Pages of the site rule sets, made from every row of ``documents``, through the whole page path.

The first line is the ``h1``, every other line a ``p`` in the element where the rule set looks for
its text. By ``doc_id`` modulo 3 a page has no author, a meta author, or a JSON-LD block (with a
repeated key, of which the last counts) that names headline, author, section and keywords.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators.extract import ARTICLE_COLUMNS, article_rows, extracted_rows
from quire.plans.articles import classify_pages, route_pages
from quire.plans.documents import doc_pages
from quire.sources import tables
from quire.sources.registry import Source

# where each rule set finds its paragraphs (FIXED VALUES of the test input)
CONTAINERS = {
    "ap": ('<div class="x RichTextStoryBody">', "</div>"), "bbc": ("<article>", "</article>"),
    "cbs": ('<section class="content__body">', "</section>"), "cnn": ("<article>", "</article>"),
    "fox": ('<article><div class="article-body">', "</div></article>"), "guardian": ('<div itemprop="articleBody">', "</div>"),
    "nbc": ("<article>", "</article>"),
}


def _escaped(c):
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def site_pages(spark: SparkSession, sf_dir: str, rule_set: str) -> DataFrame:
    """PAGES made from documents, routed to ``rule_set``."""
    d = doc_pages(spark, sf_dir)
    lines = F.split(F.col("text"), "\n")
    title = F.element_at(lines, 1)
    paras = F.transform(F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))), lambda p: F.concat(F.lit("<p>"), _escaped(p), F.lit("</p>")))
    block = F.to_json(F.struct(F.lit("NewsArticle").alias("@type"), title.alias("headline"), F.struct(F.col("source").alias("name")).alias("author"),
                               F.col("source").alias("articleSection"), F.concat("source", F.lit(", page")).alias("keywords")))
    block = F.concat(F.lit('<script type="application/ld+json">{"headline":"an earlier one",'),
                     F.replace(F.substring(block, 2, 1 << 30), F.lit("</"), F.lit("<\\/")), F.lit("</script>"))
    kind = F.col("doc_id") % 3
    head = F.when(kind == 1, F.concat(F.lit('<meta name="author" content="'), F.col("source"), F.lit('">'))).when(kind == 2, block).otherwise(F.lit(""))
    before, after = CONTAINERS[rule_set]
    html = F.concat(F.lit('<!DOCTYPE html><html><head><meta property="og:type" content="article">'), head,
                    F.lit('</head><body class="fn article-single" data-page-type="article"><h1>'), _escaped(title), F.lit("</h1>" + before),
                    F.array_join(paras, ""), F.lit(after + "</body></html>"))
    none = F.lit(None).cast("string")
    pages = d.select(F.col("doc_id").alias("page_id"), "url", html.alias("html"), none.alias("content_type"), none.alias("feed_author"),
                     none.alias("feed_summary"), F.lit(None).cast("timestamp").alias("fetched_at"), F.col("source").alias("doc_source"))
    return route_pages(pages, [Source("example", "example", ("example",), (), rule_set)])


# a byline where each rule set looks for one (FIXED VALUES of the test input)
BYLINES = {"bbc": '<div class="x byline y">{}</div>', "cnn": '<span data-testid="byline">{}</span>', "fox": '<div class="author-byline">{}</div>',
           "guardian": '<a rel="author" href="/p">{}</a>', "ap": '<p class="byline">{}</p>', "cbs": '<span class="author">{}</span>', "nbc": '<span class="byline">{}</span>'}


def dated_pages(spark: SparkSession, sf_dir: str, rule_set: str) -> DataFrame:
    """PAGES whose dates stand in JSON-LD, a meta element or a time element, by doc_id modulo 6: 0 JSON-LD (published and
    modified, with zones), 1 meta, 2 time, 3 a meta that is no date and a time, 4 none, 5 none on a page that does not
    say that it is an article. Every fourth page has a byline."""
    d = doc_pages(spark, sf_dir)
    kind = F.col("doc_id") % 6
    block = ('<script type="application/ld+json">[{"@type": "Person"}, {"@type": "NewsArticle", "datePublished": "2026-01-02T03:04:05+05:30",'
             ' "dateModified": " 2026-01-03T00:00:00Z "}]</script>')
    meta = '<meta property="article:published_time" content="{}">'
    head = F.when(kind == 0, block).when(kind == 1, meta.format("2026-01-04T01:02:03.5Z")).when(kind == 3, meta.format("soon")).otherwise("")
    time = F.when(kind.isin(2, 3), '<time datetime="2026-01-05">x</time>').otherwise("")
    byline = F.when(F.col("doc_id") % 4 == 1, BYLINES[rule_set].format(" Ann  Example ")).otherwise("")
    says = F.when(kind == 5, "</head><body>").otherwise('<meta property="og:type" content="article"></head><body class="fn article-single" data-page-type="article">')
    before, after = CONTAINERS[rule_set]
    html = F.concat(F.lit("<html><head>"), head, says, F.lit("<h1>Title</h1>"), time, byline, F.lit(before + "<p>Text.</p>" + after + "</body></html>"))
    none = F.lit(None).cast("string")
    pages = d.select(F.col("doc_id").alias("page_id"), "url", html.alias("html"), none.alias("content_type"), none.alias("feed_author"),
                     none.alias("feed_summary"), F.lit(None).cast("timestamp").alias("fetched_at"))
    return route_pages(pages, [Source("example", "example", ("example",), (), rule_set)])


def page_dates(spark: SparkSession, sf_dir: str, rule_set: str) -> DataFrame:
    """published_at, modified_at and author of the pages above that are article pages."""
    pages = classify_pages(dated_pages(spark, sf_dir, rule_set), (rule_set, "generic")).where(F.col("is_article_page"))
    rows = extracted_rows(pages, ("page_id",), (rule_set,))
    return rows.select(F.col("page_id").alias("doc_id"), "published_at", "modified_at", "author")


def generic_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PAGES of the generic rule set, one for each document. By doc_id modulo 12: 0 is a feed, 1 has the URL of a
    tag page, 2 no article element; then an author from the feed (3), a meta author (4), article:author (5),
    byl (6), JSON-LD with a name (7) or a list (8), or nobody; a summary that came with the page (9, short in 10). Published: a
    meta date with a zone (even ids), or a time element with a bad date (multiples of 3) or a good one."""
    d = tables.documents(spark, sf_dir).select("doc_id", "source", "text")
    kind, lines = F.col("doc_id") % 12, F.split(F.col("text"), "\n")
    title = F.element_at(lines, 1)
    paras = F.transform(F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))), lambda p: F.concat(F.lit("<p>"), _escaped(p), F.lit("</p>")))
    person = F.concat(F.lit("Ann "), F.col("source"))
    meta = lambda key, name, value: F.concat(F.lit(f'<meta {key}="{name}" content="'), value, F.lit('">'))
    script = lambda author: F.concat(F.lit('<script type="application/ld+json">'), F.to_json(F.struct(F.lit("WebPage").alias("@type"), author.alias("author"))), F.lit("</script>"))
    head = (F.when(kind == 4, meta("name", "author", F.concat(F.lit("  "), person, F.lit(" ")))).when(kind == 5, meta("property", "article:author", person))
            .when(kind == 6, meta("name", "byl", F.concat(F.lit("By "), person))).when(kind == 7, script(F.struct(person.alias("name"))))
            .when(kind == 8, script(F.array(F.struct(person.alias("name")), F.struct(F.lit("Bob").alias("name"))))).otherwise(F.lit("")))
    when = (F.when(F.col("doc_id") % 2 == 0, meta("property", "article:published_time", F.lit("2026-02-03T04:05:06+0200")))
            .when(F.col("doc_id") % 3 == 0, F.lit('<time datetime="2026-02-30">then</time>')).otherwise(F.lit('<time datetime="2026-02-03">then</time>')))
    box = F.when(kind == 2, "div").otherwise("article")
    html = F.concat(F.lit("<!DOCTYPE html><html><head>"), head, F.lit("</head><body><h1>"), _escaped(title), F.lit("</h1>"), when,
                    F.lit("<"), box, F.lit(">"), F.array_join(paras, ""), F.lit("</"), box, F.lit("></body></html>"))
    url = F.concat(F.lit("https://"), F.col("source"), F.when(kind == 1, F.lit(".example/tag/story-")).otherwise(F.lit(".example/articles/story-")), F.col("doc_id").cast("string"))
    none = F.lit(None).cast("string")
    summary = F.when(kind == 9, F.lit("  A summary  that came with the page, long enough to be kept as it is.")).when(kind == 10, F.lit("too short"))
    pages = d.select(F.col("doc_id").alias("page_id"), url.alias("url"), html.alias("html"), F.when(kind == 0, F.lit("application/RSS+xml")).otherwise(none).alias("content_type"),
                     F.when(kind == 3, F.concat(F.lit(" "), person, F.lit("\n"))).alias("feed_author"), summary.alias("feed_summary"),
                     F.lit(None).cast("timestamp").alias("fetched_at"), F.col("source").alias("doc_source"))
    return route_pages(pages, [])


def generic_page_articles(spark: SparkSession, sf_dir: str, run_ts: str) -> DataFrame:
    """The article rows of these pages; feeds and tag pages have none."""
    pages = classify_pages(generic_pages(spark, sf_dir).withColumn("source", F.col("doc_source")), ("generic",))
    rows = article_rows(pages.where("is_article_page"), run_ts, extra=("page_id",), rule_sets=("generic",))
    return rows.select(*ARTICLE_COLUMNS, F.col("page_id").alias("doc_id"))


def _article_pages(spark: SparkSession, sf_dir: str, rule_set: str) -> DataFrame:
    routed = site_pages(spark, sf_dir, rule_set).withColumn("source", F.col("doc_source"))
    return classify_pages(routed, (rule_set, "generic")).where(F.col("is_article_page"))


def site_page_articles(spark: SparkSession, sf_dir: str, rule_set: str, run_ts: str) -> DataFrame:
    """The article rows of these pages."""
    pages = _article_pages(spark, sf_dir, rule_set)
    rows = article_rows(pages, run_ts, extra=("page_id",), rule_sets=(rule_set, "generic"))
    return rows.select(*ARTICLE_COLUMNS, F.col("page_id").alias("doc_id"))


def site_page_extracted(spark: SparkSession, sf_dir: str, rule_set: str) -> DataFrame:
    """The EXTRACTED rows of these pages."""
    rows = extracted_rows(_article_pages(spark, sf_dir, rule_set), ("page_id",), (rule_set,))
    return rows.withColumnRenamed("page_id", "doc_id")
