"""URL filter: rule lists first, then trust and distrust propagated over host links.

Hosts without a rule are judged by the link graph: personalised PageRank from the hosts that
the rules allow follows the links, distrust from the hosts that they block runs against them, and
a host that has gathered more distrust than trust is blocked. Steps are made until no rank changes
by more than ``TOLERANCE`` of itself, so that every host that a seed leads to is reached, and close
verdicts are those of the PageRank. Built-in functions only.

Defined cases: a null URL, or one without ``://``, has an empty host and path, fits no rule and is
allowed; null or very long pages have no links, or all that stand in them; of two rules that are equally
long (ties) the one that is listed later holds, and a host with as much trust as distrust is allowed;
repeated rows and null ids are judged row by row; an empty table gives an empty result; only the named columns are read, so further columns may have any name.
"""

from __future__ import annotations

import itertools
import string
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orebelt.session import stage

HREF = r"""(?i)\bhref\s*=\s*["']?\s*((?:https?:)?//[^"'\s>]*)"""
DAMPING = 0.85
ITERATIONS = 10  # steps where their number is given, as in the SQL
# A step that changes no rank by more than this share of it is the last. Ranks of a kind add up to 1
# at most, so their summed change is below it, too, and no host is reached anew.
TOLERANCE = 1e-6
# A host is blocked when this share of what it has gathered is distrust, and more.
DISTRUST_SHARE = 0.5


class Rule(NamedTuple):
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def _lower(column: Column) -> Column:
    return F.translate(column, string.ascii_uppercase, string.ascii_lowercase)


def _rest(url: Column) -> Column:
    start = F.instr(url, "://")
    return F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise("")


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return F.coalesce(_lower(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def fits(rule: Rule, host: Column, path: Column) -> Column:
    """A rule fits its host and every subdomain, where the path starts with the rule's."""
    inside = (host == rule.host) | host.endswith("." + rule.host)
    return inside & path.startswith(rule.path) if rule.path else inside


def longest_rule(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """Text of the longest rule that fits, else null. The list is a parameter, not a table."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):  # the outermost test is the longest
        found = F.when(fits(rule, host, path), rule.text).otherwise(found)
    return found


def rule_verdict(rules: Sequence[Rule], rule: Column) -> Column:
    verdict = F.lit(None).cast("string")
    for each in rules:
        verdict = F.when(rule == each.text, each.verdict).otherwise(verdict)
    return verdict


def host_links(pages: DataFrame, url: str, html: str) -> DataFrame:
    """Distinct ``(src, dst)`` links between different hosts, from absolute ``href`` values."""
    target = F.explode(F.regexp_extract_all(F.col(html), F.lit(HREF), 1))
    links = pages.select(url_host(F.col(url)).alias("src"), target.alias("href"))
    dst = url_host(F.concat(F.lit("x:"), F.regexp_extract("href", r"(//.*)", 1)))
    return (
        links.select("src", dst.alias("dst"))
        .filter((F.col("src") != "") & (F.col("dst") != "") & (F.col("src") != F.col("dst")))
        .distinct()
    )


def propagate(
    links: DataFrame,
    seeds: DataFrame,
    *,
    damping: float = DAMPING,
    iterations: int | None = ITERATIONS,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """``(kind, host, rank)`` after ``iterations`` steps; hosts that nothing reaches are left out.

    Without ``iterations``, after the first step that changes no rank by more than ``tolerance``
    of it; later steps change none by more either.

    ``seeds`` has ``(kind, host, seed)`` with kind ``trust`` or ``distrust`` and the seeds of each
    kind adding up to 1. Trust is handed out evenly along the links of a host, distrust evenly to
    the hosts that link to it. Every step is written to the shared folder, so a lost executor
    costs one step; what the driver sees of it is whether a rank has changed.
    """
    outward = links.select(F.lit("trust").alias("kind"), "src", "dst")
    inward = links.select(
        F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst")
    )
    ways = outward.unionByName(inward)
    share = ways.groupBy("kind", "src").agg((1.0 / F.count("*")).alias("share"))
    ways = stage(ways.join(share, ["kind", "src"]), "host-ways")
    start = stage(seeds.select("kind", "host", F.col("seed").alias("rank")), "host-seeds")
    jump = start.withColumn("rank", F.col("rank") * (1 - damping))
    rank = start
    for _ in itertools.count() if iterations is None else range(iterations):
        handed = (
            rank.withColumnRenamed("host", "src")
            .join(ways, ["kind", "src"])
            .select("kind", F.col("dst").alias("host"), (F.col("rank") * F.col("share") * damping).alias("rank"))
        )
        new = handed.unionByName(jump).withColumn("old", F.lit(0.0))
        old = rank.select("kind", "host", F.lit(0.0).alias("rank"), F.col("rank").alias("old"))
        summed = new.unionByName(old).groupBy("kind", "host").agg(F.sum("rank").alias("rank"), F.sum("old").alias("old"))
        step = stage(summed, "host-rank")
        rank = step.select("kind", "host", "rank")
        if iterations is None:
            moved = F.abs(F.col("rank") - F.col("old")) > tolerance * F.col("rank")
            if not step.agg(F.max(moved)).first()[0]:
                break
    return rank


def blocked_hosts(rank: DataFrame, share: float = DISTRUST_SHARE) -> DataFrame:
    """Hosts whose distrust is more than ``share`` of what they have gathered."""
    of = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("rank")).otherwise(0.0))
    sums = rank.groupBy("host").agg(of("trust").alias("trust"), of("distrust").alias("distrust"))
    return sums.filter(F.col("distrust") > share * (F.col("trust") + F.col("distrust"))).select(
        "host", F.lit("block").alias("ranked")
    )


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    *,
    id: str = "page_id",
    url: str = "url",
    html: str = "html",
    damping: float = DAMPING,
    iterations: int | None = None,
    share: float = DISTRUST_SHARE,
) -> DataFrame:
    """``(id, host, path, rule, verdict)`` per row: the longest rule's verdict, else the graph's.

    Seeds are the hosts with pages under an allow or a block rule, weighted by those pages.
    Hosts that neither trust nor distrust reaches are allowed.
    """
    host, path = url_host(F.col(url)), url_path(F.col(url))
    parts = pages.select(F.col(id).alias("_id"), host.alias("host"), path.alias("path"))
    ruled = parts.withColumn("rule", longest_rule(rules, F.col("host"), F.col("path")))
    ruled = ruled.withColumn("verdict", rule_verdict(rules, F.col("rule")))

    kind = F.when(F.col("verdict") == "allow", "trust").otherwise("distrust")
    counts = (
        ruled.filter(F.col("verdict").isNotNull())
        .groupBy(kind.alias("kind"), "host")
        .agg(F.count("*").alias("pages"))
    )
    totals = counts.groupBy("kind").agg(F.sum("pages").alias("total"))
    seeds = counts.join(totals, "kind").select("kind", "host", (F.col("pages") / F.col("total")).alias("seed"))

    rank = propagate(host_links(pages, url, html), seeds, damping=damping, iterations=iterations)
    # The page side may hold a host with a third of all rows: an inner or left join lets adaptive
    # execution split it.
    return ruled.join(blocked_hosts(rank, share), "host", "left").select(
        F.col("_id").alias(id),
        "host",
        "path",
        "rule",
        F.coalesce("verdict", "ranked", F.lit("allow")).alias("verdict"),
    )
