"""Verdicts that links give with the thresholds of the query."""

import random
from collections import Counter, defaultdict

import pytest

from matchlore.llm import links

LINK = '<a href="{}">l</a>'


def verdicts(spark, pages):
    rows = [(i, u, h) for i, (u, h) in enumerate(pages)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    return [r["verdict"] for r in links.judged(frame).orderBy("page_id").collect()]


MOSTLY = [("http://example.com/de/", None)] * 4 + [("http://example.com/x", None)]
CASES = {
    "one linker": ([("http://bad.net/", None), ("http://farm.test/", LINK.format("http://bad.net/"))], ["block", "block"]),
    "ten linkers": (
        [(f"http://b{i}.net/", None) for i in range(10)]
        + [(f"http://farm{i}.test/", "".join(LINK.format(f"http://b{j}.net/") for j in range(10))) for i in range(10)],
        ["block"] * 20,
    ),
    "mostly blocked": (MOSTLY, ["block"] * 5),
    "mostly blocked and linked": ([*MOSTLY, ("http://farm.test/", LINK.format("http://example.com/"))], ["block"] * 6),
    "few blocked": ([MOSTLY[0], *[MOSTLY[-1]] * 3, ("http://farm.test/", LINK.format("http://example.com/"))], ["block"] + ["allow"] * 4),
}


@pytest.mark.parametrize("case", CASES)
def test_verdicts_with_the_thresholds_of_the_query(spark, case):
    pages, expected = CASES[case]
    assert verdicts(spark, pages) == expected


def linkers(n, bad=1):
    """``n`` hosts that link to nothing but ``bad`` blocked ones."""
    return [(f"http://b{i}.net/", None) for i in range(bad)] + [
        (f"http://farm{i}.test/", "".join(LINK.format(f"http://b{j}.net/") for j in range(bad))) for i in range(n)
    ]


@pytest.mark.parametrize("n", [1, 2, 3, 10])
def test_more_linkers_do_not_dilute(spark, n):
    assert verdicts(spark, linkers(n)) == ["block"] * (n + 1)


def test_one_bad_link_among_many(spark):
    news = "".join(LINK.format(f"http://site{i}.test/") for i in range(50)) + LINK.format("http://b0.net/")
    assert verdicts(spark, [("http://b0.net/", None), ("http://news.test/", news)]) == ["block", "allow"]


def test_links_are_read_from_tags(spark):
    bad = "http://bad.net/x"
    counted = [
        f'<a href="{bad}">x</a>', f"<A CLASS=a title='1 > 0' HREF={bad}>x</a>", '<a href="//bad.net/x">x</a>', '<a href=" http://BAD.net ">x</a>',
        f'<!-- x --><a\nhref="{bad}">x</a>', f'<script>1</script><a rel=nofollow href="{bad}">x</a>',
    ]
    ignored = [
        f"<!-- {counted[0]} -->", f"<script>{counted[0]}</script>", f"<style>{counted[0]}</style>", f'<a href="/go?u={bad}">x</a>',
        f'<a title="href={bad}" href="/y">x</a>', f'<a data-href="{bad}">x</a>', f"&lt;a href={bad}&gt;", f"<!-- {counted[0]}", None, "<a href>//</a>",
    ]
    pages = [(f"http://h{i}.test/", h) for i, h in enumerate(counted + ignored)]
    frame = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(pages)], "page_id bigint, url string, html string")
    edges = {r["source"] for r in links.host_edges(links.matched(frame)).collect() if r["target"] == "bad.net"}
    assert edges == {f"h{i}.test" for i in range(len(counted))}
    long = spark.createDataFrame([(1, "http://a.test/", "<a b='" + "x" * 10**6 + "' " + "c=d " * 10**5 + f"href='{bad}'>" + "<" * 10**5)], "page_id bigint, url string, html string")
    assert [r["target"] for r in links.host_edges(links.matched(long)).collect()] == ["bad.net"]


def scores(pages, damping=0.85):
    """Trust and distrust of every host by 600 plain rounds."""
    count, allowed, blocked, out = Counter(), Counter(), Counter(), defaultdict(Counter)
    for url, verdict, targets in pages:
        host = url.split("/")[2]
        count[host] += 1
        allowed[host] += verdict == "allow"
        blocked[host] += verdict == "block"
        for t in targets:
            if t != host:
                out[host][t] += 1
    hosts = set(count) | {t for o in out.values() for t in o}
    own = {h: blocked[h] / count[h] if count[h] else 0.0 for h in hosts}
    seeds = {h: allowed[h] / count[h] for h in hosts if allowed[h]}
    distrust, mass = dict(own), sum(seeds.values())
    trust, back = dict(seeds), mass
    for _ in range(600):
        mean = {h: sum(w * distrust[t] for t, w in out[h].items()) / sum(out[h].values()) if out[h] else 0.0 for h in hosts}
        distrust = {h: own[h] + (1 - own[h]) * damping * mean[h] for h in hosts}
        fresh = Counter()
        for h, o in out.items():
            for t, w in o.items():
                fresh[t] += damping * trust.get(h, 0.0) * w / sum(o.values())
        back = mass - sum(fresh.values())
        trust = Counter(fresh)
        for h, part in seeds.items():
            trust[h] += back * part / mass
    return {h: (trust.get(h, 0.0) * mass / back if mass else 0.0, distrust[h]) for h in hosts}


def test_whole_query_against_brute_force(spark):
    drawn = random.Random(9)
    names = [f"h{i}.test" for i in range(10)] + ["a.net", "example.com", "www.example.net", "x.org"]
    pages = [(f"http://c{i}.test/", [f"c{i + 1}.test"] if i < 29 else ["a.net"]) for i in range(30)]
    for _ in range(60):
        path = drawn.choice(["/", "/de/1", "/en/", "/fr/", "/x"])
        pages.append((f"http://{drawn.choice(names)}{path}", drawn.choices(names, k=drawn.choice([0, 0, 1, 3]))))
    html = ["".join(LINK.format(f"//{t}/") for t in targets) for _, targets in pages]
    frame = spark.createDataFrame([(i, u, h) for i, ((u, _), h) in enumerate(zip(pages, html))], "page_id bigint, url string, html string")
    rules = {r["page_id"]: r["_verdict"] for r in links.matched(frame).collect()}
    expected = scores([(u, rules[i], targets) for i, (u, targets) in enumerate(pages)])
    found = {r["page_id"]: r for r in links.judged(frame).collect()}
    assert len(found) == len(pages)
    for i, (url, _) in enumerate(pages):
        trust, distrust = expected[url.split("/")[2]]
        assert found[i]["trust"] == pytest.approx(trust, abs=1e-4) and found[i]["distrust"] == pytest.approx(distrust, abs=1e-4)
        judged = "block" if distrust > trust + 1e-4 and distrust > 0.5 else "allow"
        assert found[i]["verdict"] == (rules[i] or judged)
    assert expected["c0.test"][1] == pytest.approx(0.85**30)
