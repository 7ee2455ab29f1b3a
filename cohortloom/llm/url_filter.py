"""URL verdicts: allow and block rules, and trust propagated over the graph of hosts."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.workspace import Workspace

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Host of an absolute or protocol-relative link. Relative links stay on their host.
_LINK_HOST = r"""(?i)\b(?:href|src)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'>\s]+)"""

#: What is still to arrive when propagation ends, as a part of the score from which a host is blocked.
_PRECISION = 1e-3
#: Rounds whose tables are kept before they are summed into one.
_ROUNDS_KEPT = 16

#: (verdict, rule); a rule is a host and the start of a path.
Rules = Sequence[tuple[str, str]]


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _rule_table(pages: DataFrame, rules: Rules) -> DataFrame:
    rows = [(rule.partition("/")[0].lower(), "/" + rule.partition("/")[2], rule, verdict) for verdict, rule in rules]
    return pages.sparkSession.createDataFrame(
        rows, "rule_host string, rule_path string, rule string, rule_verdict string"
    )


def _host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """Per host the rules of it and of the domains above it, as an array, the longest first."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))
    fit = hosts.select("host", F.explode(F.array_distinct(suffixes)).alias("rule_host")).join(rules, "rule_host")
    size = F.length("rule_host") + F.length("rule_path")
    return fit.groupBy("host").agg(
        F.reverse(F.sort_array(F.collect_set(F.struct(size.alias("size"), "rule_path", "rule", "rule_verdict")))).alias("rules")
    )


def link_edges(pages: DataFrame, host: Column, html_col: str = "html") -> DataFrame:
    """``src, dst, links``: pages of host ``src`` that link to another host ``dst``."""
    targets = F.array_distinct(
        F.transform(
            F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")), F.lit(_LINK_HOST), F.lit(1)),
            lower_ascii,
        )
    )
    return (
        pages.select(host.alias("src"), F.explode(targets).alias("dst"))
        .filter((F.col("src") != "") & (F.col("src") != F.col("dst")))
        .groupBy("src", "dst")
        .agg(F.count("*").alias("links"))
    )


def propagate(
    work: Workspace, edges: DataFrame, seeds: DataFrame, damping: float = 0.85, rounds: int | None = None, tolerance: float = 1e-6
) -> DataFrame:
    """Personalised PageRank: ``host, score``, scores adding up to 1 at most.

    ``edges`` are ``src, dst, links``; ``seeds`` are ``host, mass`` with masses
    adding up to 1. What hosts without outgoing links hold returns to the seeds,
    which scales all scores alike, so they are the sum of what arrives in each
    round, over its total. Each round joins what arrived in the last one with the
    edges on the source host and sums per target, with partial sums before the
    shuffle; it is written, so that a lost executor costs one round.

    Rounds end when less than ``tolerance`` in total is still to arrive. Each
    passes on ``damping`` of the last at most, so the rounds that suffice are known
    beforehand; not to get there in them, or in ``rounds`` if given, is an error.
    A ``tolerance`` of 0 asks for just ``rounds`` rounds of the power iteration.
    """
    start = seeds.select("host", F.col("mass").alias("score"))
    if edges.isEmpty() or seeds.isEmpty():
        return start
    if rounds is None:
        rounds = _most_rounds(damping, tolerance)
    out = edges.groupBy("src").agg(F.sum("links").alias("all_links"))
    shares = work.cut(
        edges.join(out, "src").select(F.col("src").alias("host"), "dst", (F.col("links") / F.col("all_links")).alias("share"))
    )
    arrived, masses = [start], [1.0]
    last = start
    for _ in range(rounds):
        last = work.cut(
            last.join(shares, "host")
            .groupBy(F.col("dst").alias("host"))
            .agg((damping * F.sum(F.col("score") * F.col("share"))).alias("score"))
        )
        arrived.append(last)
        masses.append(last.agg(F.sum("score")).first()[0] or 0.0)
        if masses[-1] * damping < tolerance * (1 - damping):
            return _summed(arrived, [1 / sum(masses)] * len(arrived))
        if tolerance > 0 and len(arrived) > _ROUNDS_KEPT:
            # The last round is still needed; the sum of those before takes their place.
            done = arrived[:-1]
            arrived = [work.cut(_summed(done, [1.0] * len(done))), last]
            for part in done:
                if part is not start:
                    work.forget(part)
    if tolerance > 0:
        raise RuntimeError(f"after {rounds} rounds {masses[-1]} still moves, too much for a tolerance of {tolerance}")
    back = [1.0]
    for k in range(1, len(masses)):
        back.append(1.0 - sum(b * m for b, m in zip(back, masses[k:0:-1])))
    return _summed(arrived, back[::-1])


def _summed(parts: list[DataFrame], weights: list[float]) -> DataFrame:
    rows = [part.select("host", (F.lit(w) * F.col("score")).alias("score")) for part, w in zip(parts, weights)]
    return reduce(DataFrame.unionByName, rows).groupBy("host").agg(F.sum("score").alias("score"))


def _most_rounds(damping: float, tolerance: float) -> int:
    """Rounds after which less than ``tolerance`` is still to arrive on any graph, and one more for rounding."""
    if not (0 < damping < 1 and tolerance > 0):
        raise ValueError("without a number of rounds, damping must lie between 0 and 1 and tolerance above 0")
    return max(1, math.ceil(math.log(tolerance * (1 - damping) / damping) / math.log(damping))) + 1


def _seeds(hosts: DataFrame, share: str) -> DataFrame:
    """Each host's part of the seed mass, by the share of its pages with such a rule."""
    total = hosts.agg(F.sum(share)).first()[0] or 0
    if not total:
        return hosts.limit(0).select("host", F.lit(0.0).alias("mass"))
    return hosts.filter(F.col(share) > 0).select("host", (F.col(share) / F.lit(float(total))).alias("mass"))


def judge_urls(
    work: Workspace,
    pages: DataFrame,
    rules: Rules,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    threshold: float = 0.25,
    damping: float = 0.85,
    rounds: int | None = None,
) -> DataFrame:
    """``id_col, host, path, rule, verdict`` for every page.

    A rule ``host/start`` fits its host and all subdomains if the path begins
    with ``/start``; of those that fit the longest decides. Pages without a rule
    are judged by their host: trust starts at the hosts with allowed pages and
    follows links, distrust starts at the hosts with blocked pages and goes
    against the links, from a page to those that link to it. A host is blocked
    if its distrust exceeds its trust and is at least ``threshold`` times the
    mean over all hosts; any other, also one no link reaches, is allowed.
    Propagation ends when all that is still to arrive is under a thousandth of
    that threshold, which must be above 0, however long the paths; ``rounds``, if
    given, is a limit whose passing is an error.

    A null url has an empty host and path, fits no rule and is allowed; null
    html has no links. Repeated rows are judged alike, each gives a row. No
    pages give none. A hot host is one row of the tables of hosts; joins of pages
    with them are ordinary ones, which Spark broadcasts when small and whose hot
    keys adaptive execution splits.
    """
    url = F.col(url_col)
    parts = pages.select(F.col(id_col), url_host(url).alias("host"), url_path(url).alias("path"))
    hosts = parts.groupBy("host").agg(F.count("*").alias("pages"))
    host_rules = work.cut(_host_rules(hosts.filter("host != ''"), _rule_table(pages, rules)))
    best = F.get(F.filter("rules", lambda r: F.startswith(F.col("path"), r["rule_path"])), F.lit(0))
    ruled = parts.join(host_rules, "host", "left").select(
        F.col(id_col), "host", "path", best["rule"].alias("rule"), best["rule_verdict"].alias("rule_verdict")
    )
    shares = work.cut(
        ruled.groupBy("host").agg(
            F.avg(F.when(F.col("rule_verdict") == "allow", 1.0).otherwise(0.0)).alias("allowed"),
            F.avg(F.when(F.col("rule_verdict") == "block", 1.0).otherwise(0.0)).alias("blocked"),
        )
    )
    shares = shares.filter("host != ''")
    edges = work.cut(link_edges(pages, url_host(url), html_col))
    reverse = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "links")
    mean = 1.0 / max(1, shares.count())
    tolerance = _PRECISION * threshold * mean
    trust = propagate(work, edges, _seeds(shares, "allowed"), damping, rounds, tolerance)
    distrust = propagate(work, reverse, _seeds(shares, "blocked"), damping, rounds, tolerance)
    blocked = (
        distrust.withColumnRenamed("score", "distrust")
        .join(trust.withColumnRenamed("score", "trust"), "host", "left")
        .filter(
            (F.col("distrust") > F.coalesce("trust", F.lit(0.0))) & (F.col("distrust") >= threshold * mean)
        )
        .select("host", F.lit(True).alias("bad_host"))
    )
    verdict = F.coalesce("rule_verdict", F.when(F.col("bad_host"), "block").otherwise("allow"))
    return work.result(
        ruled.join(blocked, "host", "left").select(F.col(id_col), "host", "path", "rule", verdict.alias("verdict"))
    )
