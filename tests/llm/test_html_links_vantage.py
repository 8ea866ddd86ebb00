import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import types as T

from matchlore.llm import html, links, vantage

FRAME = "<header>Site</header><nav><a href=/>One</a></nav>{}<aside>Buy <b>this</b></aside><footer>&copy; all</footer>"
LONG = " ".join(["word"] * 40)
PAGES = {
    "<article><h1>A&amp;B</h1><p>x <b>y</b>z&nbsp;w\n  v</p><script>no()</script><p>" + LONG + "</p><p>end</p></article>": "A&B x yz w v " + LONG + " end",
    "<article><p>one<br>two<p>three <i>open<p>four" + "</article>": "one two three open four",
    "<article><p>kept</p><div class='comments'><p>" + LONG + "</p></div><form>Name <input name=q></form><style>p{}</style><!-- <p>c</p> --></article>": "kept",
    "<main><div id=cookie-notice>" + LONG + "</div><p>" + LONG + "</p><div class='ad banner'>" + LONG + "</div></main>": LONG,
    "<article><p>1 < 2 &lt;b&gt; &#233;&#x41;</p><p title='a>b' class=\"c\">q</p></article>": "1 < 2 <b> éA q",
}


@pytest.fixture(scope="module")
def tree(spark):
    return html.trained(spark)


def test_tree_knows_its_table(tree):
    assert all(html.is_main(tree, row) == (label > 0.5) for label, row in html.labelled())


@pytest.mark.parametrize("page", PAGES)
def test_pages(tree, page):
    whole = "<!DOCTYPE html><html><head><title>T</title><script>var t='</p>'</script></head><body>" + FRAME.format(page) + "</body></html>"
    assert html.main_text(whole, tree) == PAGES[page]
    assert html.main_text(FRAME.format(page), tree) == PAGES[page]


@pytest.mark.parametrize("page", [None, "", " ", "<", "<p", "<!--", "<p class='x", "</p></div>", "<head>", "<script>"])
def test_broken_pages(tree, page):
    assert html.main_text(page, tree) in ("", "<")


def test_divisions_without_names(tree):
    links_ = "".join("<div><a href=/>Go there</a></div>" for _ in range(4))
    assert html.main_text(f"<body>{links_}<div>{LONG}</div><div>{LONG}</div>{links_}</body>", tree) == f"{LONG} {LONG}"


def test_extracted(spark):
    frame = spark.createDataFrame(
        [(1, "u", FRAME.format("<article><p>" + LONG + " é</p></article>"), "x"), (1, "u", None, "x"), (None, None, "", "x")],
        "page_id bigint, url string, html string, text string",
    )
    found = [tuple(r) for r in html.extracted(frame).collect()]
    assert found == [(1, "u", LONG + " é", len(LONG) + 2), (1, "u", "", 0), (None, None, "", 0)]
    assert html.extracted(frame.limit(0)).count() == 0


def test_pages_of_the_tables(spark, data):
    found = html.extracted(spark.read.parquet(f"{data}/pages.parquet")).collect()
    assert all(r["n_chars"] == len(r["text"]) and "<" not in r["text"] for r in found)


URLS = [
    ("http://A.Net/x?q#f", "a.net", "/x", "net/", "block"), ("https://www.example.net/en/1", "www.example.net", "/en/1", "example.net/en/", "allow"),
    ("http://example.com/de/", "example.com", "/de/", "example.com/de/", "block"), ("http://example.com/den", "example.com", "/den", None, None),
    ("ftp://x.org/fr/a://b", "x.org", "/fr/a://b", "org/fr/", "allow"), ("http://net?a/b", "net", "", None, None), ("nothing", "", "", None, None),
    (None, "", "", None, None), ("http://mynet/", "mynet", "/", None, None), ("http://a.net", "a.net", "", None, None), ("x://", "", "", None, None),
]


def test_rules(spark):
    frame = spark.createDataFrame([(i, u[0]) for i, u in enumerate(URLS)], "page_id bigint, url string")
    found = links.matched(frame).orderBy("page_id").select("_host", "_path", "_rule", "_verdict").collect()
    assert [tuple(r) for r in found] == [u[1:] for u in URLS]


def ranked(seeds, edges, damping=0.85, rounds=20):
    out = defaultdict(float)
    for (s, _), w in edges.items():
        out[s] += w
    mass, scores = sum(seeds.values()), dict(seeds)
    for _ in range(rounds):
        fresh = defaultdict(float)
        for (s, t), w in edges.items():
            if s in scores:
                fresh[t] += damping * scores[s] * w / out[s]
        back = mass - sum(fresh.values())
        for h, part in seeds.items():
            fresh[h] += back * part / mass
        scores = fresh
    return scores


def test_spread_against_brute_force(spark):
    drawn = random.Random(5)
    edges = {(f"h{drawn.randrange(12)}", f"h{drawn.randrange(12)}"): float(drawn.randint(1, 5)) for _ in range(30)}
    edges = {k: w for k, w in edges.items() if k[0] != k[1]}
    seeds = {"h1": 1.0, "h2": 0.25, "lost": 0.5}
    found = links.spread(
        spark.createDataFrame(list(seeds.items()), "host string, score double"),
        spark.createDataFrame([(*k, w) for k, w in edges.items()], "source string, target string, weight double"), settled=1e-6,
    )
    got = {r["host"]: r["score"] for r in found.collect()}
    part = sum(seeds.values()) / sum(got.values())
    assert {h: s * part for h, s in got.items()} == pytest.approx(ranked(seeds, edges, rounds=400), abs=1e-5)


def test_verdicts_follow_links(spark):
    link = '<a class=x href="{}">l</a>'
    pages = [
        (1, "http://bad.net/1", None), (2, "http://farm.test/1", link.format("http://bad.net/1") * 3), (3, "http://clean.test/1", "<p>"),
        (4, "http://good.example.net/en/1", link.format("http://friend.test/")), (5, "http://friend.test/1", link.format("http://bad.net/2")),
        (6, None, link.format("http://bad.net/")), (1, "http://bad.net/1", None),
    ]
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string").selectExpr("*", "'x' as host", "'y' as rule")
    found = {r["page_id"]: r["verdict"] for r in links.judged(frame, least=0.05).collect()}
    assert found == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow", 6: "allow"}
    assert links.judged(frame).count() == 7
    assert links.judged(frame.limit(0)).count() == 0


def exact(rows, count, every):
    """Every usable pair."""
    usable = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = []
    for q, v in usable:
        if q % every:
            continue
        near = []
        for i, w in usable:
            if i != q and len(w) == len(v):
                near.append((-float(vantage.cosine(np.array([v]), np.array([w]))[0]), i))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(set(near))[:count])]
    return sorted(out)


VECTORS = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("rank", T.StringType()), T.StructField("score", T.StringType()),
])


@pytest.mark.parametrize(("shard", "block"), [(8192, 1024), (40, 3)])
def test_factor_one_is_exact(spark, shard, block):
    drawn = np.random.default_rng(2)
    rows = [(i, drawn.normal(size=6).astype(np.float32).tolist()) for i in range(300)]
    rows += [(300 + i, rows[10][1]) for i in range(30)] + [(400, rows[20][1]), (400, rows[20][1])]
    rows += [(450, None), (500, []), (550, [0.0] * 6), (600, [float("nan")] * 6), (650, [1.0, None]), (700, [1.0, 2.0]), (702, [2.0, 1.0]), (None, [1.0] * 6)]
    frame = spark.createDataFrame([(*r, "a", "b") for r in rows], VECTORS)
    found = vantage.nearest(frame, factor=1.0, shard=shard, block=block).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found) == exact(rows, 5, 50)
    assert vantage.nearest(frame.limit(0)).count() == 0


def test_recall(spark, data):
    frame = spark.read.parquet(f"{data}/embeddings.parquet")
    rows = lambda factor: {(r["query_id"], r["vec_id"]) for r in vantage.nearest(frame, factor=factor).collect()}
    whole = rows(1.0)
    assert len(whole & rows(0.9)) >= 0.95 * len(whole)


@pytest.mark.parametrize("factor", [1.0, 0.9])
def test_many_vectors_of_one_direction(spark, factor):
    """Scaled copies, far more than are asked for: exact scores and ids decide between them."""
    drawn = np.random.default_rng(3)
    base = drawn.normal(size=8)
    rows = [(i, drawn.normal(size=8).astype(np.float32).tolist()) for i in range(70)]
    rows += [(70 + i, (base * (i + 1) / 7).astype(np.float32).tolist()) for i in range(300)]
    frame = spark.createDataFrame([(*r, "a", "b") for r in rows], VECTORS)
    found = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in vantage.nearest(frame, factor=factor).collect())
    expected = exact(rows, 5, 50)
    copies = {q for q in range(100, 370, 50)}
    assert [f for f in found if factor == 1.0 or f[0] in copies] == [e for e in expected if factor == 1.0 or e[0] in copies]
