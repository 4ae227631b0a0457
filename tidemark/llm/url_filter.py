"""URL filters: host and path rules, and for what no rule judges, trust and distrust of hosts.

Rules name a host with all its subdomains and a path prefix; the longest that fits wins.
Hosts are also judged by the links between them: trust flows along links from hosts in good
standing (a personalised PageRank from the trusted seeds), distrust flows against links
from blocked hosts (a PageRank on the reversed graph), so a host that links to blocked hosts
is distrusted.  A host is blocked if its distrust reaches a threshold and exceeds its trust.
Scores are shares of a seed: 1 is the weight of an average seed.

Seeds.  Blocked seeds are hosts that a blocking rule covers whole (path ``/``); trusted seeds
are hosts where an allowing rule fits some page.  A rule for part of a host never makes a
blocked seed.

Links are counted per pair of hosts, in each task first, so a page full of links or a host
with a third of all pages costs a few rows.  Each round of propagation is one join of edges
with scores, written to the shared folder.

Null urls and urls without ``://`` have empty host and path, fit no rule and are allowed.
Null pages have no links.  Repeated pages count their links again.  Without links (or
seeds) every page without a rule is allowed.  An empty table gives no rows.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import packed, unpacked
from tidemark.scratch import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Absolute links of a page: the host after ``href=``, a scheme if given, and ``//``.
LINK = r"(?i)\bhref\s*=\s*[\"']?\s*(?:https?:)?//([^/?#\"'\s>]+)"
NEW = ("host", "path", "rule", "verdict")


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def best_rule(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """(name, verdict) of the longest rule that fits, else nulls; of equal rules the first."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name), reverse=True)[::-1]:
        name = F.when(fits(rule, host, path), F.lit(rule.name)).otherwise(name)
        verdict = F.when(fits(rule, host, path), F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def host_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(src, dst, links) between different hosts."""
    found = pages.select(host_of(F.col(url)).alias("src"), F.explode(
        F.regexp_extract_all(F.col(html), F.lit(LINK), F.lit(1))).alias("dst"))
    found = found.select("src", F.translate("dst", UPPER, LOWER).alias("dst"))
    return found.where("src <> dst AND src <> ''").groupBy("src", "dst").agg(F.count("*").alias("links"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, rounds: int | None = None,
              tolerance: float = 1e-4) -> DataFrame:
    """(host, score): personalised PageRank along ``edges`` (src, dst, links) from ``seeds`` (host).

    Each seed starts and restarts with 1 (the usual ranks over ``1 - damping``), so scores are
    in units of one seed.  What reaches a host without links out ends there.

    Rounds go on until no score can be further than ``tolerance`` from its limit: if all scores
    together moved by ``m``, all later rounds move them by ``m * damping / (1 - damping)`` at most.
    Damping brings that about in 67 rounds for one seed and 110 for a thousand; ten rounds past
    what it needs at most, it raises.  ``rounds`` asks for so many at most, whatever the tolerance.
    """
    if not 0 < damping < 1:
        raise ValueError("damping lies between 0 and 1")
    rest = damping / (1 - damping)
    out = edges.groupBy("src").agg(F.sum("links").alias("all"))
    shares = stage(edges.join(out, "src").select("src", "dst", (F.col("links") / F.col("all")).alias("share")), "link-shares")
    start = seeds.select("host", F.lit(1.0).alias("score"))
    scores = stage(start, "host-scores")
    n = max(1, scores.count())
    needed = max(1, math.ceil(math.log(tolerance / rest / n) / math.log(damping))) + 10
    for _ in range(needed if rounds is None else rounds):
        flow = (shares.join(scores, shares["src"] == scores["host"])
                .groupBy(F.col("dst").alias("host")).agg(F.sum(F.col("score") * F.col("share") * damping).alias("score")))
        after = stage(flow.unionByName(start).groupBy("host").agg(F.sum("score").alias("score")), "host-scores")
        moved = (after.alias("a").join(scores.alias("b"), "host", "full")
                 .agg(F.sum(F.abs(F.coalesce("a.score", F.lit(0.0)) - F.coalesce("b.score", F.lit(0.0))))).first()[0])
        scores = after
        if (moved or 0) * rest < tolerance:
            return scores
    if rounds is None:
        raise RuntimeError(f"scores still move by {moved} after {needed} rounds")
    return scores


def judge(pages: DataFrame, rules: list[Rule], url: str = "url", html: str = "html", threshold: float = 0.05,
          trusted: DataFrame | None = None, **rank) -> DataFrame:
    """The pages with ``host``, ``path``, ``rule`` and ``verdict`` (``allow`` or ``block``).

    ``trusted`` adds seeds (host).  Runs jobs on the graph of hosts.  Input columns named like
    the new ones give way.
    """
    rows = packed(pages, host=host_of(F.col(url)), path=path_of(F.col(url)))
    name, verdict = best_rule(rules, F.col("host"), F.col("path"))
    rows = rows.withColumn("rule", name).withColumn("ruled", verdict)
    blocked = distrusted(pages, rules, url, html, threshold, trusted, **rank)
    rows = rows.join(blocked.select(F.col("host").alias("distrusted")), F.col("host") == F.col("distrusted"), "left")
    method = F.when(F.col("distrusted").isNotNull(), "block").otherwise("allow")
    return unpacked(rows, "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), new=NEW)


def distrusted(pages: DataFrame, rules: list[Rule], url: str = "url", html: str = "html", threshold: float = 0.05,
               trusted: DataFrame | None = None, **rank) -> DataFrame:
    """(host, trust, distrust) of the hosts to block."""
    edges = stage(host_links(pages, url, html), "host-links")
    hosts = pages.select(host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path")).where("host <> ''")
    whole = [r for r in rules if r.verdict == "block" and r.path == "/"]
    name, verdict = best_rule(rules, F.col("host"), F.col("path"))
    good = hosts.where(verdict == "allow").select("host").distinct()
    if trusted is not None:
        good = good.unionByName(trusted.select("host")).distinct()
    known = hosts.select("host").unionByName(edges.select(F.col("dst").alias("host"))).distinct()
    _, blocks = best_rule(whole, F.col("host"), F.lit("/"))
    bad = known.where(blocks == "block")
    backwards = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "links")
    distrust = propagate(backwards, bad, **rank).withColumnRenamed("score", "distrust").where(F.col("distrust") >= threshold)
    trust = propagate(edges, good, **rank).withColumnRenamed("score", "trust")
    both = distrust.join(trust, "host", "left").withColumn("trust", F.coalesce("trust", F.lit(0.0)))
    return stage(both.where("distrust > trust"), "distrusted-hosts")
