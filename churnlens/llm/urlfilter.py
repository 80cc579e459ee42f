"""URL verdicts: longest matching rule first, else trust and distrust propagated over host links.

Personalised PageRank runs twice over the weighted host graph: trust starts at the hosts of pages
that an allow rule fits and follows the links, distrust starts at the hosts of blocked pages and
follows them backwards (who links to a blocked host is suspect). Seeds weigh as many as their host's
pages so judged. Ranks are carried to their fixed point. A host is blocked when its distrust is above
zero and at least ``block_ratio`` times its trust, within a small relative tolerance, so that the order
of sums can't turn a verdict and a rank counts however small the fan-in of hubs makes it.

Null or unparsable urls have an empty host and path, fit no rule, take no part in the graph and are
allowed; null html has no links; repeated page_ids are judged row by row. Links to the page's own
host, and links that name no host, say nothing of other hosts and are left out. An empty table gives
an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import replaced, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)\bhref\s*=\s*["']?([^"'\s>]+)"""

Rule = tuple[str, str]  # ("org/", "allow"): host, then the start of the path


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fits(rule: str, host: Column, path: Column) -> Column:
    rule_host, slash, rest = rule.partition("/")
    return (((host == rule_host) | host.endswith("." + rule_host))
            & path.startswith(slash + rest))


def _first_fit(rules: Sequence[Rule], host: Column, path: Column, pick: int) -> Column:
    """The longest rule's text (pick 0) or verdict (pick 1); null where none fits."""
    ordered = sorted(rules, key=lambda r: -len(r[0]))
    out = F.lit(None).cast("string")
    for rule in reversed(ordered):
        out = F.when(fits(rule[0], host, path), F.lit(rule[pick])).otherwise(out)
    return out


def with_rule(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """page_id, host, path, rule, rule_verdict of every page."""
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    host, path = F.col("host"), F.col("path")
    return parts.select("page_id", "host", "path", _first_fit(rules, host, path, 0).alias("rule"),
                        _first_fit(rules, host, path, 1).alias("rule_verdict"))


def host_edges(pages: DataFrame) -> DataFrame:
    """src, dst, weight: links between different hosts, counted before the shuffle."""
    links = pages.select(host_of(F.col("url")).alias("src"),
                         F.explode(F.regexp_extract_all(F.col("html"), F.lit(LINK), F.lit(1))).alias("link"))
    # a link that starts with // keeps the page's scheme
    full = F.when(F.col("link").startswith("//"), F.concat(F.lit("x:"), F.col("link"))).otherwise(F.col("link"))
    named = links.filter(F.col("link").rlike(r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//"))
    ends = named.select("src", host_of(full).alias("dst"))
    return (ends.filter((F.col("src") != "") & (F.col("dst") != "") & (F.col("src") != F.col("dst")))
            .groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight")))


def seeds_of(ruled: DataFrame) -> DataFrame:
    """kind, host, seed: pages of a host that a rule allows (trust) or blocks (distrust)."""
    judged = ruled.filter(F.col("rule_verdict").isNotNull() & (F.col("host") != ""))
    kind = F.when(F.col("rule_verdict") == "allow", F.lit("trust")).otherwise(F.lit("distrust"))
    return judged.groupBy(kind.alias("kind"), "host").agg(F.count("*").cast("double").alias("seed"))


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = 0.85, tolerance: float = 1e-7,
              max_rounds: int = 2000) -> DataFrame:
    """kind, host, rank: the fixed point of rank = (1-d) seed + d sum(rank_in * share), by rounds that
    start at the seeds and end when no host's rank grows by more than ``tolerance`` of itself, a host just
    reached counting as one that did. A host without links passes nothing on. Each round reads and
    writes plain tables, so the links of a hub are split over tasks; the table it replaces is removed."""
    both = (edges.select(F.lit("trust").alias("kind"), "src", "dst", "weight")
            .unionByName(edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"),
                                      F.col("src").alias("dst"), "weight")))
    both = written(both, "host-links")
    out = written(both.groupBy("kind", "src").agg(F.sum("weight").alias("all")), "host-link-sums")
    steps = written(both.join(out, ["kind", "src"])
                    .select("kind", F.col("src").alias("host"), "dst", (F.col("weight") / F.col("all")).alias("share")),
                    "host-steps")
    start = seeds.select("kind", "host", (F.col("seed") * (1 - damping)).alias("rank"))
    if steps.isEmpty():  # nothing to follow: the start is the fixed point
        return start
    none = F.lit(0.0)
    state, folder = start, None
    for _ in range(max_rounds):
        flow = state.join(steps, ["kind", "host"]).select(
            "kind", F.col("dst").alias("host"), (F.col("rank") * F.col("share") * damping).alias("rank"))
        parts = start.unionByName(flow).withColumn("before", none).unionByName(
            state.select("kind", "host", none.alias("rank"), F.col("rank").alias("before")))
        now, folder = replaced(parts.groupBy("kind", "host").agg(F.sum("rank").alias("rank"), F.sum("before").alias("before")),
                               "host-rank", folder)
        state = now.select("kind", "host", "rank")
        grown = now.agg(F.max((F.col("rank") - F.col("before")) / F.col("rank"))).first()[0]
        if grown is None or grown <= tolerance:
            return state
    raise RuntimeError(f"ranks did not settle in {max_rounds} rounds")


def host_verdicts(ranks: DataFrame, block_ratio: float = 2.0, tolerance: float = 1e-6) -> DataFrame:
    """host, trust, distrust, blocked: distrust, however small, is compared with ``block_ratio`` times the
    trust, less a relative ``tolerance`` for what the rounds and the order of sums leave open."""
    def rank(kind: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("rank"))), F.lit(0.0))
    both = ranks.groupBy("host").agg(rank("trust").alias("trust"), rank("distrust").alias("distrust"))
    return both.withColumn("blocked", (F.col("distrust") > 0)
                           & (F.col("distrust") >= block_ratio * (1 - tolerance) * F.col("trust")))


def judge_urls(pages: DataFrame, rules: Sequence[Rule], damping: float = 0.85, block_ratio: float = 2.0) -> DataFrame:
    """page_id, host, path, rule, verdict, and the host's trust and distrust, of every page."""
    ruled = written(with_rule(pages, rules), "ruled-pages")
    seeds = written(seeds_of(ruled), "host-seeds")
    hosts = written(host_verdicts(propagate(seeds, host_edges(pages), damping), block_ratio),
                    "host-verdicts")
    # both sides are plain written tables: a hot host's pages are split by the skew join
    judged = ruled.join(hosts, "host", "left")
    method = F.when(F.coalesce(F.col("blocked"), F.lit(False)), F.lit("block")).otherwise(F.lit("allow"))
    return judged.select("page_id", "host", "path", "rule",
                         F.coalesce(F.col("rule_verdict"), method).alias("verdict"),
                         F.coalesce(F.col("trust"), F.lit(0.0)).alias("trust"),
                         F.coalesce(F.col("distrust"), F.lit(0.0)).alias("distrust"))
