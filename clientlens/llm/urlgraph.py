"""Operator 2: URL filtering by rules and link-graph propagation.

Rules decide the pages they fit. For the rest, trust and distrust spread over
the graph of hosts: personalised PageRank from the hosts of allowed pages along
the links, and from the hosts of blocked pages against them (a host that links
to blocked ones is suspect). A host is blocked when its distrust exceeds
``threshold`` times its trust.

Edges: links from a page to another host, and (an option: ``domain_links``, 0 to
leave them out) a host and its parent domain (``blog.example.org`` and
``example.org``; no parent of a single label), both ways. Links are counted per pair of hosts before anything is
shuffled by host, so popular hosts cost one row per task; ranks, seeds and
edges are joined as tables (no host list reaches the driver), and each few
rounds the ranks are written to the shared folder. Only DataFrame functions.

Edge cases: a null address or one without ``://`` has an empty host and path,
fits no rule and is allowed; a null page has no links; without seeds every
host is allowed; repeated rows are judged alike; an empty table gives no rows;
columns other than the three named ones are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from clientlens.llm import common
from clientlens.llm.decontam import LOWER, UPPER

DAMPING, ROUNDS_A_TABLE, THRESHOLD = 0.85, 8, 1.0
RESIDUAL = 1e-4              # a host passes on what arrives until it is at most this part of the host's own rank
RELATIVE = 1e-2              # a host is blocked if its distrust is larger by more than this part
DOMAIN_LINKS = 1             # links that a host and its parent domain count as, each way (0: none)
ALLOW, BLOCK = "allow", "block"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"(?i)(?:href|src)\s*=\s*[\"']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#\"'\s<>]+)"


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str


# The rules of the registered query.
RULES = [
    Rule("org", "/", ALLOW),
    Rule("example.org", "/es/", BLOCK),
    Rule("example.org", "/en/1", BLOCK),
    Rule("com", "/fr/", ALLOW),
    Rule("com", "/de/", BLOCK),
]


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """(rule, verdict) of the longest fitting rule, null if none fits. The
    rules are part of the plan: meant for some hundred at most."""
    fits = [F.when(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
                   F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict")))
            for r in sorted(rules, key=lambda r: -len(r.host + r.path))]
    return F.coalesce(*fits, F.lit(None).cast("struct<rule:string,verdict:string>"))


def host_edges(pages: DataFrame, html_col: str, domain_links: int = DOMAIN_LINKS) -> DataFrame:
    """(source, target, links) of ``pages`` with a ``host`` column. Links without a
    host of their own stay on the page's host and are no edges."""
    found = F.explode(F.regexp_extract_all(F.col(html_col), F.lit(LINK), F.lit(1)))
    links = (pages.select(F.col("host").alias("source"), found.alias("target"))
             .withColumn("target", F.translate("target", UPPER, LOWER)))
    links = links.filter("source != '' and source != target").groupBy("source", "target").agg(F.count("*").alias("links"))
    if not domain_links:
        return links
    hosts = pages.select("host").unionByName(links.select(F.col("target").alias("host"))).distinct()
    parent = F.regexp_extract("host", r"^[^.]+\.([^.]+\..+)$", 1)
    up = hosts.select(F.col("host").alias("source"), parent.alias("target")).filter("target != ''")
    family = up.unionByName(up.select(F.col("target").alias("source"), F.col("source").alias("target"))).distinct()
    return (links.unionByName(family.withColumn("links", F.lit(domain_links).cast("long")))
            .groupBy("source", "target").agg(F.sum("links").alias("links")))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, residual: float = RESIDUAL) -> DataFrame:
    """(host, trust, distrust) of every host that either reaches. ``seeds``:
    (host, trust, distrust), each summing to 1 or 0. Mass that flows into a host
    without links leaves the graph.

    Delta propagation: what arrives at a host adds to its rank and waits there
    (``wait_t``, ``wait_d``); in each round the hosts where more waits than
    ``residual`` times their own rank pass it on, the others keep it until more
    has come. The walk ends when no host has anything to pass on. So accuracy is
    relative to each host's own rank, however small that is and however far the
    host is from a seed; a host that is reached for the first time always passes on."""
    out = edges.groupBy("source").agg(F.sum("links").alias("all_out"))
    into = edges.groupBy("target").agg(F.sum("links").alias("all_in"))
    none, no = F.lit(0.0), F.lit(False).alias("stays")
    # a way of every host leads to itself and carries what it keeps, so that a round
    # is one join and one sum, and reads the last one's ranks once
    hosts = (edges.select(F.col("source").alias("host")).unionByName(edges.select(F.col("target").alias("host")))
             .unionByName(seeds.select("host")).distinct())
    ways = common.written(
        edges.join(out, "source").select(F.col("source").alias("host"), F.col("target").alias("to"),
                                         (F.col("links") / F.col("all_out")).alias("t"), none.alias("d"), no)
        .unionByName(edges.join(into, "target").select(F.col("target").alias("host"), F.col("source").alias("to"),
                                                       none.alias("t"), (F.col("links") / F.col("all_in")).alias("d"), no))
        .unionByName(hosts.select("host", F.col("host").alias("to"), none.alias("t"), none.alias("d"), F.lit(True).alias("stays"))),
        "ways")
    t, d = (F.col(c) * (1 - damping) for c in ("trust", "distrust"))
    ranks = common.written(seeds.select("host", t.alias("trust"), d.alias("distrust"), t.alias("wait_t"), d.alias("wait_d")), "ranks")
    much = lambda wait, rank: F.col(wait) > residual * F.col(rank)
    while True:
        for _ in range(ROUNDS_A_TABLE):
            moved = []
            for rank, wait, share in (("trust", "wait_t", "t"), ("distrust", "wait_d", "d")):
                go = F.when(much(wait, rank), F.col(wait)).otherwise(0.0)
                sent = F.col(share) * go * damping
                moved += [F.when(F.col("stays"), F.col(rank)).otherwise(sent).alias(rank),
                          F.when(F.col("stays"), F.col(wait) - go).otherwise(sent).alias(wait)]
            ranks = (ranks.join(ways, "host").select(F.col("to").alias("host"), "stays", *moved)
                     .filter("stays or trust > 0 or distrust > 0").groupBy("host")
                     .agg(*[F.sum(c).alias(c) for c in ("trust", "distrust", "wait_t", "wait_d")]))
        seen = Observation()
        ranks = common.written(ranks.observe(seen, F.count_if(much("wait_t", "trust") | much("wait_d", "distrust")).alias("live")), "ranks")
        if not seen.get["live"]:
            return ranks.select("host", "trust", "distrust")


def judge(pages: DataFrame, rules: list[Rule] | None = None, id_col: str = "page_id", url_col: str = "url",
          html_col: str = "html", threshold: float = THRESHOLD, domain_links: int = DOMAIN_LINKS) -> DataFrame:
    """Per page: its id, ``host``, ``path``, ``rule``, ``verdict`` and the
    host's ``trust`` and ``distrust`` (0 where neither reaches)."""
    common.prepare(pages.sparkSession)
    url = F.col(url_col)
    rows = pages.select(F.col(id_col), host_of(url).alias("host"), path_of(url).alias("path"), F.col(html_col).alias("html"))
    ruled = rows.withColumn("fit", rule_of(F.col("host"), F.col("path"), RULES if rules is None else rules))
    counts = (ruled.filter("fit is not null").groupBy("host")
              .agg(F.sum((F.col("fit.verdict") == ALLOW).cast("double")).alias("a"),
                   F.sum((F.col("fit.verdict") == BLOCK).cast("double")).alias("b")))
    total = counts.agg(F.sum("a").alias("all_a"), F.sum("b").alias("all_b"))
    share = lambda x, t: F.coalesce(F.try_divide(F.col(x), F.col(t)), F.lit(0.0))
    seeds = (counts.withColumn("k", F.lit(1)).join(total.withColumn("k", F.lit(1)), "k")      # total is a single row
             .select("host", share("a", "all_a").alias("trust"), share("b", "all_b").alias("distrust")))
    ranks = propagate(common.written(host_edges(rows, "html", domain_links), "edges"), seeds)
    found = ruled.select(id_col, "host", "path", "fit").join(ranks, "host", "left")
    trust, distrust = (F.coalesce(F.col(c), F.lit(0.0)) for c in ("trust", "distrust"))
    # by a relative margin: ranks get smaller as the input grows
    spread = F.when(distrust > trust * threshold * (1 + RELATIVE), F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return found.select(id_col, "host", "path", F.col("fit.rule").alias("rule"),
                        F.coalesce(F.col("fit.verdict"), spread).alias("verdict"), trust.alias("trust"), distrust.alias("distrust"))


def keep_allowed(pages: DataFrame, id_col: str = "page_id", **options) -> DataFrame:
    """The rows of ``pages`` whose page is allowed (joined by id: of repeated
    ids all rows are kept or none; rows without an id go)."""
    allowed = judge(pages, id_col=id_col, **options).groupBy(id_col).agg(F.min(F.col("verdict") == ALLOW).alias("ok"))
    return pages.join(allowed.filter("ok").select(id_col), id_col, "left_semi")
