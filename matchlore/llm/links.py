"""URL filters: rules for hosts and paths, and trust that spreads over links between hosts.

Rules decide the pages they fit. For all others the host is judged. Trust flows from hosts with allowed pages along
links (personalised PageRank, in units of what a trusted host keeps for itself). Distrust flows from hosts with
blocked pages against the links: a host has the part of its own pages that is blocked and, for the rest, the
damped mean of the distrust of the hosts it links to. That is the chance that a walk from the host ends on a blocked page; it does not
depend on how many others link to the same blocked host, and one bad link among many good ones counts as one among many.
A host is blocked where its distrust is above ``ratio`` times its trust and above ``least``.

Hosts and weighted host edges come from one pass over urls and pages; links are counted per pair of hosts before
anything is joined, so a host with a third of all pages is one row per host it links to. Each round is
one join and one sum over edges; rounds go on until the scores are settled, which damping brings about.

Defined results: a null url, or one without ``://``, has empty host and path, fits no rule and belongs
to the host with the empty name, which takes no part in the graph and is allowed; null html has no links; hosts
that no seed reaches are allowed; repeated rows each count.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlore.llm.shared import stored


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


#: The rules of the query.
RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


#: More than settled scores may still be off.
_OPEN = 1e-4


def _lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _after_scheme(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is none."""
    return _lower(F.regexp_extract(_after_scheme(url), r"(?s)^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def matched(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``pages`` with host, path, and the longest rule that fits with its verdict (else null)."""
    placed = pages.withColumns({"_host": host_of(F.col("url")), "_path": path_of(F.col("url"))})
    ordered = sorted(rules, key=lambda r: (-len(r.name), r.name))
    pick = lambda value: reduce(
        lambda chain, r: F.when(r.fits(F.col("_host"), F.col("_path")), F.lit(value(r))).otherwise(chain),
        reversed(ordered), F.lit(None).cast("string"),
    )
    return placed.withColumns({"_rule": pick(lambda r: r.name), "_verdict": pick(lambda r: r.verdict)})


#: What is no markup, tags of links, and their attributes with values. Possessive, so long pages need no stack.
_UNREAD = r"(?is)<!--.*?(?:-->|\z)|<(script|style|template|noscript)\b.*?(?:</\1\s*+>|\z)"
_LINK = r"(?i)<a\s((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
_NAME = r"([^\s\"'<>/=]++)\s*+(?:=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s\"'>]++))?+"


def hrefs(html: Column) -> Column:
    """The href values of all ``a`` elements outside comments and scripts, as an array."""
    read = F.regexp_replace(F.coalesce(html, F.lit("")), _UNREAD, " ")
    # pages without a link of their own to another host need no further look
    tags = F.when(read.contains("//"), F.regexp_extract_all(read, F.lit(_LINK), F.lit(1))).otherwise(F.array().cast("array<string>"))

    def href(tag: Column) -> Column:
        names = F.regexp_extract_all(tag, F.lit(_NAME), F.lit(1))
        values = F.regexp_extract_all(tag, F.lit(_NAME), F.lit(2))
        pairs = F.filter(F.arrays_zip(names.alias("n"), values.alias("v")), lambda p: F.lower(p["n"]) == "href")
        return F.trim(F.regexp_replace(F.get(pairs, F.lit(0))["v"], r"^[\"']|[\"']$", ""), F.lit(" \t\r\n\f"))

    return F.transform(tags, href)


def target_of(href: Column) -> Column:
    """The host a link names: behind ``//`` at the start or right behind the scheme; empty for links inside a host."""
    return _lower(F.regexp_extract(F.coalesce(href, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*+:)?//([^/?#]*)", 1))


def host_edges(pages: DataFrame) -> DataFrame:
    """(source, target, weight) between different hosts, from the links of pages (``_host``, html)."""
    found = pages.where("_host <> ''").select(F.col("_host").alias("source"), F.explode_outer(hrefs(F.col("html"))).alias("link"))
    named = found.select("source", target_of(F.col("link")).alias("target"))
    return named.where("target <> '' and source <> target").groupBy("source", "target").agg(
        F.count("*").cast("double").alias("weight")
    )


def _shares(edges: DataFrame) -> DataFrame:
    """(source, target, share): the part of a host's links that each of its edges has."""
    total = edges.groupBy(F.col("source").alias("s")).agg(F.sum("weight").alias("total"))
    joined = edges.join(total, edges["source"] == total["s"])
    return stored(joined.select("source", "target", (F.col("weight") / F.col("total")).alias("share")), "edge-shares")


def _settled(seeds: DataFrame, shares: DataFrame, giver: str, taker: str, damping: float, absorbing: bool, settled: float,
             at_once: int) -> DataFrame:
    """(host, score): ``seeds`` plus ``damping`` times what hosts take over the shares from ``giver`` to ``taker``.

    With ``absorbing`` a host takes only for the part that is not a seed. Scores rise from the seeds, each round by at
    most the damped part of the last, and are settled when none moves by more than ``settled`` in ``at_once``
    rounds; these are planned together and stored once.
    """
    scores = seeds.select("host", "score")
    if not seeds.limit(1).count() or not shares.limit(1).count():
        return scores
    moved = float("inf")
    while moved > settled:
        after = scores
        for _ in range(at_once):
            known = after.select(F.col("host").alias(giver), F.col("score").alias("_score"))
            given = shares.join(known, giver).select(
                F.col(taker).alias("host"), F.lit(0.0).alias("own"), (damping * F.col("share") * F.col("_score")).alias("taken")
            )
            parts = given.union(seeds.select("host", F.col("score").alias("own"), F.lit(0.0).alias("taken")))
            own, taken = F.sum("own"), F.sum("taken")
            after = parts.groupBy("host").agg((own + (1 - own) * taken if absorbing else own + taken).alias("score"))
        after = stored(after, "host-scores")
        old = scores.select("host", F.col("score").alias("old"))
        moved = after.join(old, "host", "left").agg(F.max(F.abs(F.col("score") - F.coalesce("old", F.lit(0.0))))).first()[0]
        scores = after
    return scores


def spread(seeds: DataFrame, edges: DataFrame, damping: float = 0.85, settled: float = 1e-5, at_once: int = 8) -> DataFrame:
    """Personalised PageRank (host, score) of ``seeds`` (host, score) over ``edges`` (source, target, weight).

    Scores are in units of what a seed of score 1 keeps of its own: divided by their sum they are the chances
    of a walk that starts again at the seeds with the rest of ``damping`` and wherever a host has no links.
    """
    return _settled(seeds, _shares(edges), "source", "target", damping, False, settled, at_once)


def suspicion(seeds: DataFrame, edges: DataFrame, damping: float = 0.85, settled: float = 1e-5, at_once: int = 8) -> DataFrame:
    """(host, score): the chance that a walk along links ends on a blocked page.

    ``seeds`` (host, score) have the blocked part of each host's pages. A host keeps that part and takes, for the
    rest, ``damping`` times the mean over its links.
    """
    return _settled(seeds, _shares(edges), "target", "source", damping, True, settled, at_once)


def _seeds(hosts: DataFrame, verdict: str) -> DataFrame:
    """Hosts with any page of a verdict, with their part of such pages."""
    return hosts.where(F.col(verdict) > 0).select("host", (F.col(verdict) / F.col("pages")).alias("score"))


def host_scores(placed: DataFrame) -> DataFrame:
    """(host, trust, distrust) of every host that a seed reaches. ``placed`` comes from :func:`matched`."""
    hosts = stored(
        placed.where("_host <> ''").groupBy(F.col("_host").alias("host")).agg(
            F.count("*").alias("pages"),
            F.count_if(F.col("_verdict") == "allow").alias("allowed"),
            F.count_if(F.col("_verdict") == "block").alias("blocked"),
        ),
        "hosts",
    )
    edges = stored(host_edges(placed), "host-edges")
    trust = spread(_seeds(hosts, "allowed"), edges).withColumnRenamed("score", "trust")
    distrust = suspicion(_seeds(hosts, "blocked"), edges).withColumnRenamed("score", "distrust")
    return trust.join(distrust, "host", "full").select(
        "host", F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust")
    )


def judged(pages: DataFrame, ratio: float = 1.0, least: float = 0.5, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """page_id, host, path, rule and verdict of every page, with trust and distrust of its host.

    Scores that agree up to what settling leaves open count as equal, which allows.
    """
    placed = matched(pages.select("page_id", "url", "html"), rules)
    scores = stored(host_scores(placed), "host-verdicts").withColumnRenamed("host", "_scored")
    joined = placed.drop("html").join(scores, F.col("_host") == F.col("_scored"), "left")
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    blocked = (distrust > ratio * trust + _OPEN) & (distrust > least)
    verdict = F.coalesce(F.col("_verdict"), F.when(blocked, F.lit("block")).otherwise(F.lit("allow")))
    return joined.select(
        "page_id", F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule").alias("rule"),
        verdict.alias("verdict"), trust.alias("trust"), distrust.alias("distrust"),
    )
