"""An outlet with rules of its own, registered without a change to the package."""
import pytest
from pyspark.sql import functions as F

from quire.functions import selectors as S
from quire.operators import frontier as FR
from quire.operators import rule_sets as R
from quire.operators.extract import article_rows, extracted_rows
from quire.plans.articles import classify_pages, route_pages, rule_sets_of
from quire.sources.registry import Source

PAGES = [
    ("https://daily.example/story/one", '<body data-kind="story"><h1>One  title</h1><p>teaser</p>'
     '<div data-role="main"><p>First part of it.</p><p>Second part.</p></div><span data-kind="by">Ann Example</span></body>'),
    ("https://daily.example/story/empty", '<body data-kind="story"><h1>Empty</h1></body>'),
    ("https://daily.example/front", '<body data-kind="front">' + "".join(f'<a href="/story/{i}">x</a>' for i in range(5)) + "</body>"),
    ("https://other.example/story/one", '<body data-kind="story"><h1>Elsewhere</h1></body>'),
]


@pytest.fixture
def outlet():
    kept, above = set(S.KEPT_ATTRS), dict(S.ANCESTORS)
    rules = R.RuleSet(
        name="daily", urls=([("search", "/video/", True)], [("search", "/story/", False)]),
        fields=lambda: {**R.paragraphs_body(F.col("p_site"), F.col("p_article")), "title": R.clean("h1"),
                        "author": R.clean("dom_author"), "published": F.col("time_ts")},
        page_test=R.body_has("story"), body_attr="data-kind", method=R.always("dom"),
        errors=(("no_paras", "no text"),), ladder=([(("body", "title"), None, 0.9)], 0.4, None),
        paragraphs=lambda: S.tag_texts("p", "daily_main"),
        author=lambda: S.first(S.texts(S.both(S.tag_is("span"), S.attr_equals("data-kind", "by")))),
        ancestors={"daily_main": (None, "data-role", "main")}, attrs=("data-kind",), min_text=20, summary_chars=22, links_a_page=3)
    yield R.register(rules)
    del R.RULE_SETS["daily"]
    for now, before in ((S.KEPT_ATTRS, kept), (S.ANCESTORS, above)):
        now.clear()
        now.update(before)


def classified(spark):
    rows = [(i, u, h, None, None, None, None) for i, (u, h) in enumerate(PAGES)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, content_type string, "
                                     "feed_author string, feed_summary string, fetched_at timestamp")
    registry = [Source("the-daily", "daily.example", ("daily.example",), (), "daily")]
    names = rule_sets_of(registry)
    return classify_pages(route_pages(df, registry), names), names


def test_own_outlet(spark, outlet):
    pages, names = classified(spark)
    rows = {r.url: r for r in article_rows(pages.where("is_article_page"), "2026-01-01T00:00:00Z", rule_sets=names).collect()}
    one, empty = rows[PAGES[0][0]], rows[PAGES[1][0]]
    assert (one.title, one.author, one.text) == ("One title", "Ann Example", "First part of it. Second part.")
    assert one.parse_ok and one.summary_max_chars == 22 and one.summary == "First part of it..." and one.summary_truncated
    assert not empty.parse_ok and empty.parse_error == "Text too short or missing: 0 < 20"
    assert PAGES[2][0] not in rows
    found = {r.url: r for r in extracted_rows(pages.where("is_article_page"), rule_sets=names).collect()}
    assert found[PAGES[0][0]].confidence == 0.9 and found[PAGES[1][0]].errors == ["no text"]
    links = FR.followed_links(FR.resolve_links(FR.page_hrefs(pages))).collect()
    assert sorted(r.link_url for r in links) == [f"https://daily.example/story/{i}" for i in range(3)]


def test_limits_of_the_built_in_sets(spark):
    assert {r.min_text for r in R.named()} == {250} and R.named(("generic",)) == []
    assert [r.name for r in R.named()] == R.SITE_SETS


def test_mistakes_are_refused(outlet):
    with pytest.raises(ValueError, match="not registered"):
        R.named(("nowhere",))
    with pytest.raises(ValueError, match="does not keep"):
        S.attr(F.col("n"), "data-unheard-of")
    with pytest.raises(ValueError, match="another ancestor rule"):
        S.add_ancestor("daily_main", ("div", None, None))
