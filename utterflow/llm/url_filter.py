"""URL filters: rules by host and path, and trust that spreads over links between hosts.

Pages that a rule fits have its verdict. The rules also make seeds: every host is trusted by the
share of its pages that are allowed and distrusted by the share that are blocked. Trust runs
along links by personalised PageRank from the trusted seeds; distrust runs against the links, to
those who link to blocked hosts. A host whose distrust exceeds ``threshold`` times its trust is
blocked where no rule fits.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from utterflow.llm.tables import Stored

DAMPING = 0.85
TOLERANCE = 1e-6
# What still moves after k rounds is at most DAMPING^k: this many rounds reach the tolerance, so
# the tolerance is what stops the iteration.
ITERATIONS = math.ceil(math.log(TOLERANCE) / math.log(DAMPING))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``host/path``: fits the host and its subdomains where the path begins alike."""

    rule: str
    verdict: str

    def fits(self, host: Column, path: Column) -> Column:
        own_host, slash, rest = self.rule.partition("/")
        same = (host == own_host) | host.endswith(f".{own_host}")
        return same & path.startswith(slash + rest)


# Fixed values.
RULES = (
    Rule("net/", "block"),
    Rule("example.net/en/", "allow"),
    Rule("example.com/de/", "block"),
    Rule("org/fr/", "allow"),
)


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def with_rules(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``(page_id, host, path, rule, rule_verdict)``: the longest rule that fits, or nulls."""
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    longest_first = sorted(rules, key=lambda r: -len(r.rule))
    rule = verdict = F.lit(None).cast("string")
    for r in reversed(longest_first):
        fits = r.fits(F.col("host"), F.col("path"))
        rule = F.when(fits, F.lit(r.rule)).otherwise(rule)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return rows.select("*", rule.alias("rule"), verdict.alias("rule_verdict"))


def host_links(pages: DataFrame) -> DataFrame:
    """``(src, dst, n)``: absolute links in pages between different hosts, counted by pair."""
    found = F.regexp_extract_all(
        F.coalesce("html", F.lit("")),
        F.lit(r"(?i)\bhref\s*=\s*[\"']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^\"'\s>]+)"),
        1,
    )
    to = F.transform(
        found, lambda u: F.when(u.startswith("//"), F.concat(F.lit("http:"), u)).otherwise(u)
    )
    links = pages.select(host_of(F.col("url")).alias("src"), F.explode(F.array_distinct(to)).alias("u"))
    return (
        links.select("src", host_of(F.col("u")).alias("dst"))
        .where("src <> '' AND dst <> '' AND src <> dst")
        .groupBy("src", "dst")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def spread(
    links: DataFrame,
    seeds: DataFrame,
    iterations: int = ITERATIONS,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """Personalised PageRank ``(host, rank)``.

    ``links`` are ``(src, dst, n)``, ``seeds`` ``(host, weight)``. What hosts without links hold
    goes back to the seeds. Stops when the ranks change by less than ``tolerance`` in all. Hosts
    that nothing reaches are not in the result. The scalars of a step (sums over all hosts) are all
    that the driver sees.
    """
    total = seeds.agg(F.sum("weight")).first()[0] or 0.0
    start = Stored(
        seeds.where("weight > 0").select("host", (F.col("weight") / (total or 1.0)).alias("seed")),
        "seeds",
    ).table
    ranks = Stored(start.withColumnRenamed("seed", "rank"), "ranks")
    out = links.groupBy("src").agg(F.sum("n").alias("all"))
    edges = Stored(
        links.join(out, "src").select("src", "dst", (F.col("n") / F.col("all")).alias("share")),
        "edges",
    ).table
    if not total or edges.isEmpty():
        return ranks.table
    for _ in range(iterations):
        flow = (
            edges.join(ranks.table.withColumnRenamed("host", "src"), "src")
            .groupBy(F.col("dst").alias("host"))
            .agg(F.sum(F.col("rank") * F.col("share") * DAMPING).alias("rank"))
        )
        arrived = Stored(flow, "flow")
        # What does not flow on, by damping or for want of links, starts again at the seeds.
        back = 1.0 - (arrived.table.agg(F.sum("rank")).first()[0] or 0.0)
        again = start.select("host", (F.col("seed") * back).alias("rank"))
        following = Stored(
            arrived.table.unionByName(again).groupBy("host").agg(F.sum("rank").alias("rank")), "ranks"
        )
        before = ranks.table.select("host", (-F.col("rank")).alias("rank"))
        change = (
            following.table.unionByName(before).groupBy("host").agg(F.sum("rank").alias("d"))
            .agg(F.sum(F.abs("d"))).first()[0]
        )
        ranks.drop()
        arrived.drop()
        ranks = following
        if change < tolerance:
            break
    return ranks.table


def host_verdicts(links: DataFrame, judged: DataFrame, threshold: float = 1.0) -> DataFrame:
    """``(host, trust, distrust, verdict)`` for hosts that trust or distrust reaches.

    ``judged`` are pages with ``host`` and ``rule_verdict``.
    """
    counts = judged.where("host <> ''").groupBy("host").agg(
        F.avg(F.when(F.col("rule_verdict") == "allow", 1.0).otherwise(0.0)).alias("allowed"),
        F.avg(F.when(F.col("rule_verdict") == "block", 1.0).otherwise(0.0)).alias("blocked"),
    )
    counts = Stored(counts, "hosts").table
    trusted = counts.select("host", F.col("allowed").alias("weight"))
    blocked = counts.select("host", F.col("blocked").alias("weight"))
    against = links.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    trust = spread(links, trusted).select("host", F.col("rank").alias("trust"))
    distrust = spread(against, blocked).select("host", F.col("rank").alias("distrust"))
    both = trust.join(distrust, "host", "full").fillna(0.0, ["trust", "distrust"])
    bad = F.col("distrust") > threshold * F.col("trust")
    return both.withColumn("verdict", F.when(bad, "block").otherwise("allow"))


def judged_urls(
    pages: DataFrame, rules: tuple[Rule, ...] = RULES, threshold: float = 1.0
) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` for every row of ``pages``.

    Pages that no rule fits have their host's verdict; hosts that nothing reaches are allowed, and
    so are pages without a host. Null urls and pages count as empty.
    """
    links = Stored(host_links(pages), "links").table
    rows = with_rules(pages, rules)
    bad = host_verdicts(links, rows, threshold).where("verdict = 'block'")
    found = rows.join(bad.select("host", F.lit("block").alias("spread")), "host", "left")
    verdict = F.coalesce("rule_verdict", "spread", F.lit("allow"))
    return found.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
