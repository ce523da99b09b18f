"""The page reader's slots against the same selectors over the node array."""
import random

import pytest
from pyspark.sql import functions as F

from quire.functions import selectors as S
from quire.operators import slots as R
from quire.operators.extract import common_slots, own_slots
from quire.operators.html_nodes import add_nodes
from quire.operators.rule_sets import named
from quire.sources import tables

PIECES = ["<p>", "</p>", "<div class='article-body x'>", "<div class='RichTextStoryBody'>", "<section class=content__body>", "</div>", "</section>",
          "<article>", "</article>", "<h1>", "</h1>", "some text", " more ", "<!-- note -->", "<b>bold</b>", "<a href='/one' rel=author>", "</a>", "<a>",
          "<meta property='og:type' content='article'>", "<meta name=author content='A &amp; B'>", "<meta name=author>", "<time datetime='2026-01-02'>",
          "<script type='application/ld+json'>{\"@type\": \"Article\", \"a\": 1, \"a\": NaN}</script>", "<script>var p='<p>'</script>", "<style>p{}</style>",
          "<br/>", "<ul><li>item<li>next</ul>", "<div data-component='text-block'>", "<div itemprop=articleBody itemtype='x/Article'>", "<span class='byline top'>by me",
          "</span>", "<body class='fn article-single' data-page-type='article'>", "<base href='/b/'>", "&nbsp;", "<![weird]>", "<table><tr><td>c<td>d</table>", "</none>"]


def made_pages(n=150, seed=4):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randrange(0, 40))) for _ in range(n)] + ["", None, "<p>" * 3000 + "deep"]


def every_slot():
    out = {r.name: {**common_slots(), **own_slots(r)} for r in named()}
    return out | {"generic": {**common_slots(), **own_slots(None)}}


def test_one_pass_equals_the_selectors_over_nodes(spark):
    sets = every_slot()
    names = list(sets)
    stored = tables.pages(spark, "/root/testdata/sf0.001").select("html")
    rows = [(h,) for h in made_pages()]
    pages = spark.createDataFrame(rows, "html string").union(stored).withColumn("id", F.monotonically_increasing_id())
    pages = pages.select(
        "*", F.explode(F.array(*[F.lit(n) for n in names])).alias("rule_set"))
    read = {(r["id"], r["rule_set"]): r for r in R.add_slots(pages, sets).collect()}
    nodes = add_nodes(pages.where("rule_set = 'generic'").drop("rule_set"))
    for name, slots in sets.items():
        want = nodes.select("id", "parse_error", *[s.column().alias(k) for k, s in slots.items()]).collect()
        for w in want:
            got = read[w["id"], name]
            assert got["parse_error"] == w["parse_error"]
            assert {k: got["slots"][k] for k in slots} == {k: w[k] for k in slots}, name
            assert all(got["slots"][k] is None for k in got["slots"].asDict() if k not in slots)


def test_transitions_are_kept_and_bounded(monkeypatch):
    sets = every_slot()
    machine = R.Machine(sets["ap"], dict(S.ANCESTORS))
    pages = made_pages(50)
    whole = [R.read_page(h, machine) for h in pages]
    assert 0 < len(machine.transitions) < 1000
    monkeypatch.setattr(R, "KEPT_TRANSITIONS", 3)
    small = R.Machine(sets["ap"], dict(S.ANCESTORS))
    assert [R.read_page(h, small) for h in pages] == whole and len(small.transitions) <= 3


def test_broken_pages_and_batches(spark, monkeypatch):
    monkeypatch.setattr(R, "BATCH_CHARS", 10)
    slots = {"x": {"h1": S.first(S.tag_texts("h1")), "links": S.hrefs(), "any": S.exists_element(S.tag_is("h1"))}}
    rows = [(k, "x", h) for k, h in enumerate(["<h1>one</h1><a href=1><a href=2>", "", None, "<h1></h1>", "<a href>"])]
    df = R.add_slots(spark.createDataFrame(rows, "id int, rule_set string, html string"), slots)
    assert [tuple(r.slots) for r in df.orderBy("id").collect()] == [("one", ["1", "2"], True), (None, [], False), (None, [], False), (None, [], True), (None, [""], False)]
    machine = R.Machine(slots["x"], {})
    monkeypatch.setattr(machine, "step", lambda *a: 1 / 0)
    assert R.read_page("<h1>", machine) == (None, "division by zero")
    with pytest.raises(ValueError, match="two types"):
        R.add_slots(df.drop("slots", "parse_error").withColumn("html", F.lit("")), {"x": {"a": S.hrefs()}, "y": {"a": S.first(S.hrefs())}})
