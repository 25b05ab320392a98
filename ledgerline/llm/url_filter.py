"""URL filter: rules first, and where none fits, what the link graph says of
the host.

*Rules.* A rule has a host, a path and a verdict. It fits a url whose host is the
rule's or one of its subdomains and whose path starts with the rule's; of
several the longest wins.

*Link graph.* Nodes are hosts. A page's host has an edge to each other host that its
html links to (absolute and protocol-relative ``href`` and ``src``), and a host has an
edge to its parent domain where that is itself the host of a page. Two personalised
PageRanks run over the distinct edges:

* trust starts at hosts with pages that a rule allows and follows the edges;
* distrust starts at hosts with pages that a rule blocks and follows the edges
  backwards, to those who link there.

A seed's share is its part of the allowed (blocked) pages. Each step passes
``DAMPING`` percent of a host's score on, in equal parts, and gives the rest to the
seeds; what a host without edges would pass on is lost. A host is blocked when
its distrust is more than ``BLOCK_PERCENT`` percent of trust and distrust together;
a host that neither reaches is allowed.

Scores are 64-bit integers (``MASS`` in all, divisions round down), so a result does
not depend on the order in which a cluster adds. Steps go on until nothing
changes, at most ``STEPS``.

Shape of the job: one scan of the pages; edges, seeds and scores are tables by host,
summed map-side before every shuffle, so a host with a third of all pages or links is
one row a task. A step joins scores to edges by host; a host with very many edges is split by
the skew join. Every ``WRITE_EVERY`` steps the scores are written to the shared
folder, which cuts the lineage and survives a lost executor. Nothing is collected.

Defined cases: a null url, or one without ``://``, has an empty host and path, fits
no rule, is no node and is allowed; null html links nowhere; repeated rows count
as pages each and stay rows each; a null page_id is kept; other columns
are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.storage import materialise

MASS = 10 ** 15
DAMPING = 85
STEPS = 20
WRITE_EVERY = 4
BLOCK_PERCENT = 50

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HOST = "(?s)^.*?://([^/?#]*)"
PATH = "(?s)^.*?://[^/?#]*([^?#]*)"
# host of an absolute or protocol-relative link in an attribute
LINK = "(?:[hH][rR][eE][fF]|[sS][rR][cC])[ \\t\\r\\n]*=[ \\t\\r\\n]*[\"']?(?:[hH][tT][tT][pP][sS]?:)?//([^/?#\"'<> \\t\\r\\n]+)"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"),
         Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))


def _lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def _fits(rule: Rule) -> Column:
    host, path = F.col("host"), F.col("path")
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def judged(pages: DataFrame, rules: tuple[Rule, ...] = RULES, *carried: Column) -> DataFrame:
    """host, path, the longest rule that fits, its verdict and the hosts that
    the page links to, beside the ``carried`` columns."""
    url = F.coalesce(F.col("url"), F.lit(""))
    parts = pages.select(*carried, _lower(F.regexp_extract(url, HOST, 1)).alias("host"),
                         F.regexp_extract(url, PATH, 1).alias("path"),
                         F.regexp_extract_all(F.coalesce(F.col("html"), F.lit("")), F.lit(LINK), 1).alias("links"))
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        name = F.when(_fits(rule), rule.name).otherwise(name)
        verdict = F.when(_fits(rule), rule.verdict).otherwise(verdict)
    return parts.withColumns({"rule": name, "verdict": verdict})


def host_edges(pages: DataFrame) -> DataFrame:
    """Distinct (src, dst) between hosts, from a table that :func:`judged` gave."""
    hosts = pages.filter(F.col("host") != "").select("host").distinct()
    links = (pages.filter(F.col("host") != "").select(F.col("host").alias("src"), F.explode("links").alias("dst"))
             .select("src", _lower(F.col("dst")).alias("dst")))
    parents = (hosts.select(F.col("host").alias("src"), F.regexp_extract("host", "^[^.]*\\.(.+)$", 1).alias("dst"))
               .join(hosts.select(F.col("host").alias("dst")), "dst", "left_semi").select("src", "dst"))
    return links.unionByName(parents).filter("src <> dst AND dst <> ''").distinct()


def seeds(pages: DataFrame) -> DataFrame:
    """(kind, host, score): each seed's share of ``MASS``. Trust has kind
    ``allow``, distrust kind ``block``."""
    by_host = (pages.filter((F.col("host") != "") & F.col("verdict").isNotNull())
               .groupBy(F.col("verdict").alias("kind"), "host").agg(F.count(F.lit(1)).alias("n")))
    total = by_host.groupBy("kind").agg(F.sum("n").alias("total"))
    share = F.expr(f"cast(cast({MASS} as decimal(20,0)) * n div total as bigint)")
    return by_host.join(F.broadcast(total), "kind").select("kind", "host", share.alias("score"))


def propagate(edges: DataFrame, start: DataFrame, steps: int = STEPS) -> DataFrame:
    """(kind, host, score) after ``steps`` steps from the seeds ``start``, or as
    soon as the scores stay the same."""
    both_ways = edges.select(F.lit("allow").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to")).unionByName(
        edges.select(F.lit("block").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to")))
    degree = both_ways.groupBy("kind", "host").agg(F.count(F.lit(1)).alias("degree"))
    start = materialise(start, "url-seeds")
    ways = materialise(both_ways.join(degree, ["kind", "host"]), "url-ways")
    rest = start.select("kind", "host", F.expr(f"{100 - DAMPING} * score div 100").alias("score"))

    def step(scores: DataFrame) -> DataFrame:
        passed = (ways.join(scores, ["kind", "host"])
                  .select("kind", F.col("to").alias("host"), F.expr(f"{DAMPING} * score div (100 * degree)").alias("score")))
        return passed.unionByName(rest).groupBy("kind", "host").agg(F.sum("score").alias("score")).filter("score > 0")

    scores = start
    for done in range(0, steps, WRITE_EVERY):
        before = scores
        for _ in range(min(WRITE_EVERY, steps - done)):
            scores = step(scores)
        scores = materialise(scores, "url-scores")
        if scores.exceptAll(before).isEmpty() and before.exceptAll(scores).isEmpty():
            break
    return scores


def host_verdicts(scores: DataFrame, percent: int = BLOCK_PERCENT) -> DataFrame:
    """(host, trust, distrust, by_graph) of every host that a score reached."""
    def of(kind: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0))
    both = scores.groupBy("host").agg(of("allow").alias("trust"), of("block").alias("distrust"))
    bad = 100 * F.col("distrust") > percent * (F.col("trust") + F.col("distrust"))
    return both.select("host", "trust", "distrust", F.when(bad, "block").otherwise("allow").alias("by_graph"))


def _verdicts(found: DataFrame) -> DataFrame:
    """``found`` with the host's scores and, where no rule fits, its verdict."""
    by_host = host_verdicts(propagate(host_edges(found), seeds(found)))
    return (found.join(by_host, "host", "left")
            .withColumns({"verdict": F.coalesce("verdict", "by_graph", F.lit("allow")),
                          "trust": F.coalesce("trust", F.lit(0)), "distrust": F.coalesce("distrust", F.lit(0))}))


def filter_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, and the
    host's trust and distrust (0 where none reached it)."""
    found = materialise(judged(pages, rules, F.col("page_id")), "url-pages")
    return _verdicts(found).select("page_id", "host", "path", "rule", "verdict", "trust", "distrust")


def drop_blocked(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``pages`` without the rows whose url is blocked, columns as they were."""
    whole = F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("whole")
    found = materialise(judged(pages, rules, whole), "url-pages")
    return _verdicts(found).filter(F.col("verdict") == "allow").select("whole.*")
