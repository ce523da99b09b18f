"""The operators on embeddings and pages, and the pipeline."""

import random

import numpy as np
import pytest

from quire.llm import embeddings, linkgraph, templates

NAN = float("nan")


def got(df):
    return [r.asDict(recursive=True) for r in df.collect()]


# 2 embeddings --------------------------------------------------------------------------------------


def brute(rows):
    ok = [x is not None and label is not None and len(x) and all(c is not None and np.isfinite(c) for c in x) and any(x) for _, x, label in rows]
    n, root = [0] * len(rows), list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, (_, x, a) in enumerate(rows):
        for j, (_, y, b) in enumerate(rows[:i]):
            if ok[i] and ok[j] and a == b and len(x) == len(y):
                u, v = np.array(x, np.float32).astype(float), np.array(y, np.float32).astype(float)
                if u @ v / np.linalg.norm(u) / np.linalg.norm(v) >= 0.98:
                    n[i] += 1
                    n[j] += 1
                    p, q = find(i), find(j)
                    root[max(p, q)] = min(p, q)
    groups = {}
    for k, (vec, _, _) in enumerate(rows):
        groups.setdefault(find(k), []).append(vec)
    least = {g: min((v for v in ids if v is not None), default=None) for g, ids in groups.items()}
    return sorted((vec if vec is not None else -1, n[k], least[find(k)] if least[find(k)] is not None else -1, vec is not None and vec == least[find(k)])
                  for k, (vec, _, _) in enumerate(rows))


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    rows, k = [], 0
    for label in (0, 1, None):
        for _ in range(12):
            centre = rng.standard_normal(32)
            for _ in range(rng.integers(1, 9)):
                rows.append((k, (centre + 0.08 * rng.standard_normal(32)).astype(np.float32).tolist(), label))
                k += 1
    crowd = rng.standard_normal(32)
    for _ in range(60):  # one large group, and copies
        rows.append((k, (crowd + 0.05 * rng.standard_normal(32)).astype(np.float32).tolist(), 0))
        k += 1
    rows += [(k + i, rows[0][1], 0) for i in range(5)] + [(0, rows[0][1], 0)]
    rows += [(900, None, 0), (901, [0.0] * 32, 0), (902, [NAN] + [1.0] * 31, 0), (903, [float("inf")] * 32, 0), (904, [], 0),
             (905, [None] + [1.0] * 31, 0), (906, [1.0, 2.0], 0), (907, [1.0, 2.0], 0), (None, [1.0, 2.0], 0), (None, [3.0, 1.0], 5)]
    return rows


@pytest.mark.parametrize("block", [1024, 16])
def test_embeddings_against_brute_force(llm, vectors, block, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    df = llm.createDataFrame(vectors, "vec_id long, embedding array<float>, label int")
    found = sorted((r["vec_id"] if r["vec_id"] is not None else -1, r["n_links"], r["component_id"] if r["component_id"] is not None else -1, r["kept"])
                   for r in embeddings.near_duplicates(df).collect())
    assert found == brute(vectors)
    assert embeddings.near_duplicates(df.where("vec_id = 12345")).count() == 0


def test_recall(sf):
    x = np.array([r["embedding"] for r in sf("embeddings").collect()], dtype=float)
    slots = embeddings.slots_of(x)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    a, b = np.nonzero(np.triu(unit @ unit.T >= 0.98, 1))
    met = (slots[a] == slots[b]).any(axis=1)
    assert met.mean() >= 0.999 if len(a) else True


# 6 templates ---------------------------------------------------------------------------------------


def page(body, head="<title>t</title>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


CASES = [
    ("<article><h1>A &amp; B</h1><p><b>one<br><p>two  <i>th</i>ree &copy;</article><footer>no</footer>", "A & B one two three ©"),
    ("<nav>no</nav><div class=\"ad\">no</div><article>x<form>no</form><div class='comments'>no</div><aside>no</aside> y</article>", "x y"),
    ("<div role=navigation>no</div><p>text 5 < 6 & <b>a</b><3</p><script>if (a < b) '</p>'</script><style>p{}</style>", "text 5 < 6 & a<3"),
    ("<main><article>one</article><section>two</section></main>", "one two"),
    ("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table>", "a b c d e"),
    ("<p>a<!-- no <p> no -->b</p><!-- open", "ab"),
    ("</div></p>x<div id=\"reader-comments comments\">no</div><textarea>no</textarea>", "x"),
    ("", ""), (None, ""),
]


@pytest.mark.parametrize("body,want", CASES)
def test_main_text(body, want):
    assert templates.main_text("" if body is None else page(body), ()) == want


def test_deep_and_long_pages():
    assert templates.main_text("<div>" * 5000 + "x" + "</div>" * 5000, ()) == "x"
    assert templates.main_text("<p>" + "<font>a " * 5000, ()).count("a") == 5000
    assert len(templates.main_text("<p>" + "word " * 100_000, ()).split()) == 100_000
    assert templates.main_text("<" * 5000 + "a", ()) == "<" * 5000 + "a"


def test_recurring_subtrees_go(llm):
    rows = []
    for k in range(20):
        rows.append((k, f"http://Site.example/{k}", page(f"<div class='x1'>Same words everywhere</div><div><p>Own text {k}</p></div><div><b>Same</b> line</div>")))
        rows.append((100 + k, f"http://news.example/{k}", page(f"<article><p>The same article</p><div class='y'>Follow us</div><p>{k}</p></article>")))
    rows += [(200, "http://one.example/", page("<div class='x1'>Same words everywhere</div>")), (201, None, None), (202, "nothing", "plain text"), (202, "nothing", "plain text")]
    df = llm.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in templates.query(df).collect()}
    for k in range(20):
        assert found[k] == f"Own text {k}" and found[100 + k] == f"The same article {k}"
    assert found[200] == "Same words everywhere" and found[201] == "" and found[202] == "plain text"
    parts = templates.extract(df.withColumn("host", linkgraph.host_of("url")), "m", at_once=1).select("page_id", "m.text")
    assert sorted((r["page_id"], r["text"]) for r in parts.collect()) == sorted((r["page_id"], r["text"]) for r in templates.query(df).collect())
    assert templates.query(df.where("page_id = 999")).count() == 0


def test_copies_of_an_article_keep_its_text(llm):
    body = "".join(f"<p>Sentence {j} of the one article that everybody copies.</p>" for j in range(8))
    parts = "".join(f'<div class="part"><h2>Part {j}</h2><p>What is said in part {j}.</p></div>' for j in range(4))
    rows = []
    for k in range(20):
        around = f"<div class='menu-of-all'>Home News</div><p>Page {k}</p>"
        rows.append((k, f"http://a.example/{k}", page(f'{around}<article><div class="article-body">{body}</div><div class="y">Follow us</div><p>By {k}</p></article>')))
        rows.append((100 + k, f"http://b.example/{k}", page(f"{around}<article>{parts}</article>")))
        rows.append((200 + k, f"http://c.example/{k}", page(f'<div>{around}<div class="content">{body}</div></div>')))
        rows.append((300 + k, f"http://d.example/{k}", page(f"<div>{parts}</div>")))
    df = llm.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in templates.query(df).collect()}
    text, several = templates.main_text(page(body), ()), templates.main_text(page(parts), ())
    for k in range(20):
        assert found[k] == f"{text} By {k}" and found[100 + k] == several
        assert found[200 + k] == f"Page {k} {text}" and found[300 + k] == several


PROSE = "<p>" + "A sentence of the main text. " * 12 + "</p>"


@pytest.mark.parametrize("html", [
    f'<form id="aspnetForm"><div>{PROSE}</div></form>', f"<form><article>{PROSE}</article></form>", f'<div role="form">{PROSE}</div>',
    *[f'<article>{PROSE}<div class="{n}"><p>Not this</p></div></article>' for n in (
        "comments-area", "comment-section", "user-comments", "cookie-banner", "ad-container", "ad-slot", "newsletter-signup", "share-buttons",
        "related-posts", "sidebar-left", "site-footer", "x Site_Footer")],
    f"<article>{PROSE}<p hidden>Not this</p><p style='color:red; display: none'>nor this</p></article>", f"<article>{PROSE}<form><p>Mail</p><input></form></article>",
    f"<article>{PROSE}<header><span>by line</span></header></article>"])
def test_what_wraps_the_text_stays_and_small_named_boxes_go(html):
    assert templates.main_text(page(html), ()) == templates.main_text(page(PROSE), ()) != ""


def test_an_articles_heading_mathematics_and_states_stay():
    text = templates.main_text(page(PROSE), ())
    assert templates.main_text(page(f"<header><h1>Site</h1></header><article><header><h1>Title</h1></header>{PROSE}</article>"), ()) == f"Title {text}"
    assert templates.main_text(page(f"<article>{PROSE}<p>so <math>x</math></p></article>"), ()) == f"{text} so x"
    assert templates.main_text(page(f'<article>{PROSE}<div class="has-sidebar"><p>a</p></div><div class="comments-open"><p>b</p></div></article>'), ()) == f"{text} a b"
    assert templates.main_text(page(f'<article>{PROSE}<p title="hidden none">kept</p></article>'), ()) == f"{text} kept"


@pytest.mark.parametrize("names", ["content has-sidebar", "layout-no-sidebar", "article-body with-related", "post comments-open",
                                   "post type-post category-social hentry", "social"])
def test_names_do_not_delete_the_main_text(names):
    assert templates.main_text(page(f'<article class="{names}"><p>The text</p></article>'), ()) == "The text"
    assert templates.main_text(page(f'<div id="x" class="{names}"><main><p>The text</p></main></div><p>more</p>'), ()) == "The text"
    assert templates.main_text(page(f'<p>a</p><div class="{names}"><p>Most of the text</p><div class="big social">no</div></div>'), ()) == "a Most of the text"


def test_pages_of_the_table(sf):
    rows = got(templates.query(sf("pages")))
    assert len(rows) == sf("pages").count() and all(r["n_chars"] == len(r["text"]) > 0 for r in rows)


# 7 link graph --------------------------------------------------------------------------------------


def test_hosts_paths_and_rules(llm):
    urls = {"http://A.Example.COM/en/x?y#z": ("a.example.com", "/en/x", "example.com/en/", "block"),
            "https://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
            "http://shop.com": ("shop.com", "", None, "allow"), "http://shop.com/": ("shop.com", "/", "com/", "allow"),
            "//x.net/es/": ("", "", None, "allow"), "ftp://x.net/es/1": ("x.net", "/es/1", "net/es/", "block"),
            "http://com/": ("com", "/", "com/", "allow"), "http://xcom/": ("xcom", "/", None, "allow"),
            "http://h.org?u=http://x.net/es/": ("h.org", "", None, "allow"), None: ("", "", None, "allow"), "": ("", "", None, "allow")}
    df = llm.createDataFrame([(k, u, None) for k, u in enumerate(urls)], "page_id long, url string, html string")
    found = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in linkgraph.query(df).collect()}
    assert found == dict(enumerate(urls.values()))
    assert linkgraph.query(df.where("page_id = 99")).count() == 0


def test_distrust_flows_against_links(llm):
    link = lambda *hosts: "".join(f'<a href="http://{h}/p">x</a>' for h in hosts)
    pages = [(1, "http://bad.net/es/1", link("bad.net")), (2, "http://farm.org/", link("bad.net")), (3, "http://fine.org/", link("good.com", "farm.org")),
             (4, "http://good.com/", link("fine.org")), (5, "http://alone.org/", None), (6, "http://second.org/x", link("farm.org"))]
    df = llm.createDataFrame(pages, "page_id long, url string, html string")
    found = {r["page_id"]: r["verdict"] for r in linkgraph.query(df).collect()}
    assert found == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow", 6: "block"}
    edges = linkgraph.host_edges(df).collect()
    out = {}
    for e in edges:
        out[e["src"]] = out.get(e["src"], 0) + e["share"]
    assert out == {k: pytest.approx(1.0) for k in out} and ("bad.net", "bad.net") not in {(e["src"], e["dst"]) for e in edges}


@pytest.mark.parametrize("n", [2, 20, 200])
def test_hosts_that_link_to_a_blocked_host_are_blocked_however_many(llm, n):
    link = lambda h: f'<a href="https://{h}/p">x</a>'
    pages = [(0, "http://bad.net/es/1", None)] + [(k, f"http://farm{k}.org/", link("bad.net")) for k in range(1, n + 1)]
    # one that links there with a third of its links, one that a trusted host backs
    pages += [(1000, "http://mixed.org/", link("bad.net") + link("a.org") + link("b.org")), (1001, "http://backed.org/", link("bad.net")),
              (1002, "http://good.com/", link("backed.org"))]
    found = {r["page_id"]: r["verdict"] for r in linkgraph.query(llm.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert found == {k: "block" for k in range(n + 1)} | {1000: "allow", 1001: "allow", 1002: "allow"}


def test_walk_against_power_series(llm):
    rng = random.Random(6)
    hosts = [f"h{k}" for k in range(12)]
    share = {}
    for h in hosts:
        to = rng.sample([x for x in hosts if x != h], 3)
        share |= {(h, t): 1 / 3 for t in to}
    edges = llm.createDataFrame([(a, b, s) for (a, b), s in share.items()], "src string, dst string, share double")
    seeds = llm.createDataFrame([("h0", 1.0), ("h5", 0.5)], "host string, start double")
    for forward in (True, False):
        m = np.zeros((12, 12))
        for (a, b), s in share.items():
            if forward:
                m[hosts.index(b), hosts.index(a)] = s
            else:
                m[hosts.index(a), hosts.index(b)] = s
        start = np.array([1.0 if h == "h0" else 0.5 if h == "h5" else 0.0 for h in hosts])
        want = start.copy()
        for _ in range(linkgraph.ROUNDS):
            want = start + linkgraph.DAMPING * m @ want
        found = {r["host"]: r["p"] for r in linkgraph.walk(edges, seeds, forward).collect()}
        assert all(abs(found.get(h, 0.0) - want[k]) < 1e-9 for k, h in enumerate(hosts))


# pipeline ------------------------------------------------------------------------------------------


def test_pipeline_against_its_operators(llm, sf, tmp_path):
    import corpus_pipeline

    from quire.llm import decontam, langid, mixing, pii, simhash

    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "SimHash near-dedup", "benchmark decontamination", "PII", "mixing"]
    docs = sf("documents")
    rows = {r["doc_id"]: r for r in docs.collect()}
    kept = {r["doc_id"] for r in langid.query(docs).collect() if r["lang_pred"] != "und" and r["score"] >= langid.MIN_SCORE}
    step = docs.where(docs["doc_id"].isin(list(kept)))
    kept = {r["doc_id"] for r in simhash.query(step).collect() if r["doc_id"] == r["component_id"]}
    step = docs.where(docs["doc_id"].isin(list(kept)))
    kept = {r["doc_id"] for r in decontam.query(step, sf("benchmark")).collect() if not r["contaminated"]}
    step = docs.where(docs["doc_id"].isin(list(kept)))
    texts = {r["doc_id"]: r["text"] for r in pii.query(step).collect()}
    mixed = {r["doc_id"]: r["taken"] for r in mixing.query(step).collect()}
    found = corpus_pipeline.run(llm, "/root/testdata/sf0.001").collect()
    assert {r["doc_id"]: r["text"] for r in found} == texts and len(found) == len(texts)
    # pseudonyms keep the number of words
    assert {r["doc_id"]: r["taken"] for r in found} == mixed
    assert 0 < len(found) < len(rows) and all(r["lang"] == rows[r["doc_id"]]["lang"] for r in found)


def test_oracle_sql_is_text_for_registered_queries():
    from quire.llm import queries
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)
    assert all(isinstance(sql, str) for sql in queries.ORACLE_SQL.values())
