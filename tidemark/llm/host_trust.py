"""URL filters: rule lookup, and link-graph propagation for urls that no rule judges.

Rules are (verdict, host + path) pairs. A rule fits its host and all subdomains where the url's path
starts with the rule's; the longest rule wins. A url without a rule takes the verdict of its host:
personalised PageRank spreads trust from hosts with allowed pages along links, and distrust from hosts
with blocked pages against them (who links to blocked hosts is distrusted). Seeds come from the rules,
weighted by the share of the host's pages that they judge. Only distrust that arrives over links counts,
so a rule on one folder of a host never blocks its other folders. Trust and distrust are in units of one
seed host's mass, so a host's verdict depends on what is linked with it and not on how many other hosts
the table has.

Defined results: null urls and urls without `://` have an empty host and path, no rule and verdict
allow; repeated pages are judged each; null html has no links; an empty table gives an empty result.
Everything runs as DataFrame operations; per-host tables are joined, never collected.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Work, ascii_lower, cut, small

RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
#: Absolute and protocol-relative targets of anchors.
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]+)"""


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null or where `://` is missing."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    rest = F.coalesce(rest, F.lit(""))
    host = ascii_lower(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path


def match_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, or null; rules of one length go by code point."""
    rule = verdict = F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        top, _, folder = text.partition("/")
        fits = ((host == top) | host.endswith("." + top)) & path.startswith("/" + folder)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """Links between hosts: src, dst, weight (number of links); links within a host are left out."""
    src, _ = split_url(F.col("url"))
    links = F.regexp_extract_all(F.col("html"), F.lit(LINK), 1)
    to = F.explode(links).alias("to")
    target = F.when(F.col("to").startswith("//"), F.concat(F.lit("x:"), F.col("to"))).otherwise(F.col("to"))
    dst, _ = split_url(target)
    return (
        pages.where(F.instr(F.col("html"), "//") > 0)
        .select(src.alias("src"), to)
        .select("src", dst.alias("dst"))
        .where((F.col("src") != "") & (F.col("dst") != "") & (F.col("src") != F.col("dst")))
        .groupBy("src", "dst")
        .agg(F.count("*").cast("double").alias("weight"))
    )


def personalised_pagerank(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, rounds: int | None = None, tolerance: float = 1e-6) -> DataFrame:
    """Rank of each host that the seeds reach: host, seed (its restart mass), rank.

    edges: src, dst, weight; seeds: host, seed. Mass of hosts without outgoing links leaves the walk;
    goes on until a step moves less than `tolerance` (n hosts of seed 1 take log(tolerance / n) /
    log(damping) steps at most), or for `rounds` steps where given. Each step is one join and one
    aggregation with map-side sums.
    """
    with Work(edges.sparkSession, "rank") as work:
        total = edges.groupBy("src").agg(F.sum("weight").alias("total"))
        steps = work.keep(edges.join(total, "src").select("src", "dst", (F.col("weight") / F.col("total")).alias("share")))
        rank = work.keep(seeds.select("host", "seed", (F.col("seed") * (1 - damping)).alias("rank")))
        moved, n = work.sized(rank.select("host", F.col("rank").alias("step")))
        for _ in count() if rounds is None else range(rounds):
            # a hub's edges stay where they are while the hosts that pass mass on are few enough to broadcast
            passed = small(moved, n).join(steps, moved["host"] == steps["src"])
            before = moved
            moved, n = work.sized(passed.groupBy(F.col("dst").alias("host")).agg((F.sum(F.col("step") * F.col("share")) * damping).alias("step")))
            work.drop(before)
            mass = moved.agg(F.sum("step")).first()[0] or 0.0
            if mass <= 0:
                break
            both = rank.unionByName(moved.select("host", F.lit(0.0).alias("seed"), F.col("step").alias("rank")))
            before, rank = rank, work.sized(both.groupBy("host").agg(F.sum("seed").alias("seed"), F.sum("rank").alias("rank")))[0]
            work.drop(before)
            if mass < tolerance:
                break
        return cut(rank)


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, damping: float = 0.85) -> DataFrame:
    """Verdict of each page: page_id, host, path, rule, verdict, trust, distrust.

    A page without a rule is blocked where its host's distrust over links is above its trust; else allowed.
    """
    host, path = split_url(F.col("url"))
    rule, ruled = match_rule(F.col("host"), F.col("path"), rules)
    urls = pages.select("page_id", host.alias("host"), path.alias("path")).select("page_id", "host", "path", rule.alias("rule"), ruled.alias("ruled"))
    edges = cut(host_edges(pages.select("url", "html")))
    if edges.isEmpty():
        return urls.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.lit("allow")).alias("verdict"), F.lit(0.0).alias("trust"), F.lit(0.0).alias("distrust"))
    hosts = cut(
        urls.where(F.col("host") != "")
        .groupBy("host")
        .agg((F.count_if(F.col("ruled") == "allow") / F.count("*")).alias("allow"), (F.count_if(F.col("ruled") == "block") / F.count("*")).alias("block"))
    )

    def spread(kind: str, links: DataFrame) -> DataFrame:
        return personalised_pagerank(links, hosts.where(F.col(kind) > 0).select("host", F.col(kind).alias("seed")), damping)

    trust = spread("allow", edges).select("host", F.col("rank").alias("trust"))
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    distrust = spread("block", back).select("host", (F.col("rank") - (1 - damping) * F.col("seed")).alias("distrust"))
    scores = hosts.select("host").join(trust, "host", "left").join(distrust, "host", "left")
    scores = scores.select("host", F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
    bad = F.col("distrust") > F.col("trust")
    judged = urls.join(scores, "host", "left").na.fill(0.0, ["trust", "distrust"])
    verdict = F.coalesce("ruled", F.when(bad, F.lit("block")).otherwise(F.lit("allow")))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "trust", "distrust")
