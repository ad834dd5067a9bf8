"""URL filtering: rules, and trust and distrust that spread along links between hosts.

Rules decide the pages they fit.  For the rest, pages a rule allows make their
host a trusted seed and pages a rule blocks make it a blocked seed, each by its
share of the host's pages.  Trust follows the links of a seed; distrust follows
them backwards, to the hosts that link to it (Gyöngyi et al., VLDB 2004; spam
mass, VLDB 2006).  Both are personalised PageRanks; divided by the plain
PageRank of the same direction they are shares of a host's rank that come from
seeds, comparable between hosts of any size.  Of a host's own rank, the part of its
unruled pages says nothing about it: for verdicts that part counts as the mean of
the host's links, not as free of distrust, so that a host whose links all lead to
distrusted hosts is distrusted whatever their numbers of links.  A host is blocked
when its share of distrust, taken so, reaches ``threshold`` and exceeds its share
of trust.

DataFrame functions only.  Pages are counted per host before anything is
shuffled, a link between two hosts counts once, and every round is one join and
one sum over host edges, written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.operators.lookup import lookup
from corpusloom.staging import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Absolute links; possessive, so linear in the page.
LINK = r"""(?i)href\s*+=\s*+["']?+\s*+(?:https?:)?//([^/?#"'\s<>]++)"""
ROUNDS, DAMPING = 12, 0.85
THRESHOLD = 0.5
#: Fixed part of a host row when it is broadcast.
HOST_ROW = 64


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty for null and for urls without it."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def url_host(url: Column) -> Column:
    """From after ``://`` to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """From the end of the host to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _fits(rule: tuple[str, str, str]) -> Column:
    host, path, _ = rule
    return ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)


def with_rules(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` and ``ruled``: the verdict of the longest rule that fits."""
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))
    first = [F.when(_fits(r), F.struct(F.lit(r[0] + r[1]).alias("rule"), F.lit(r[2]).alias("ruled"))) for r in ordered]
    parts = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    none = F.lit(None).cast("struct<rule:string,ruled:string>")
    return parts.withColumn("_rule", F.coalesce(*first, none)).select("page_id", "host", "path", "_rule.rule", "_rule.ruled")


def host_links(pages: DataFrame) -> DataFrame:
    """Distinct ``src, dst``: hosts whose pages link to other hosts by absolute links."""
    found = pages.select(
        url_host(F.col("url")).alias("src"), F.explode(F.regexp_extract_all(F.col("html"), F.lit(LINK), F.lit(1))).alias("dst"))
    named = found.select("src", F.translate("dst", UPPER, LOWER).alias("dst"))
    return named.where("src <> '' and src <> dst").distinct()


def _arcs(links: DataFrame) -> DataFrame:
    """``from, to, forward, backward``: the share of a node's rank that an edge carries, by direction."""
    out = links.groupBy("src").agg((F.lit(1.0) / F.count("*")).alias("w"))
    into = links.groupBy("dst").agg((F.lit(1.0) / F.count("*")).alias("w"))
    zero = F.lit(0.0)
    ahead = links.join(out, "src").select(F.col("src").alias("from"), F.col("dst").alias("to"), F.col("w").alias("forward"), zero.alias("backward"))
    back = links.join(into, "dst").select(F.col("dst").alias("from"), F.col("src").alias("to"), zero.alias("forward"), F.col("w").alias("backward"))
    return ahead.unionByName(back)


def host_scores(seeds: DataFrame, links: DataFrame, rounds: int = ROUNDS, damping: float = DAMPING) -> DataFrame:
    """``host, trust, distrust, distrusted``: shares of a host's rank that come from trusted and from blocked seeds.

    ``distrusted`` is the share of distrust when the part of a host's own rank
    that no seed weight covers counts as the mean of its links.  It is never
    less than ``distrust``; a host without weights has the mean of its links,
    a host without links its weight.

    ``seeds``: ``host, good, bad`` with weights from 0 to 1, one row a host.
    ``links``: ``src, dst``.  Hosts that are only linked to have no seed weight.
    """
    linked = links.select(F.explode(F.array("src", "dst")).alias("host")).distinct()
    nodes = linked.join(seeds, "host", "full").select(
        "host", F.coalesce("good", F.lit(0.0)).alias("good"), F.coalesce("bad", F.lit(0.0)).alias("bad"))
    nodes = stage(nodes, "hosts")
    start = nodes.select("host", F.col("good").alias("t"), F.lit(1.0).alias("p"), F.col("bad").alias("d"), F.lit(1.0).alias("r"),
                         F.col("bad").alias("u"))
    arcs = stage(_arcs(links), "arcs")
    ranks = start
    if not arcs.isEmpty():  # without links every rank is its seed
        base = 1 - damping
        for _ in range(rounds):
            moved = arcs.join(ranks, F.col("from") == F.col("host")).groupBy("to").agg(
                F.sum(F.col("t") * F.col("forward")).alias("mt"), F.sum(F.col("p") * F.col("forward")).alias("mp"),
                F.sum(F.col("d") * F.col("backward")).alias("md"), F.sum(F.col("r") * F.col("backward")).alias("mr"),
                F.sum(F.col("u") * F.col("backward")).alias("mu"))
            new = nodes.join(moved, F.col("host") == F.col("to"), "left")
            of_links = F.when(F.col("mr") > 0, F.col("mu") / F.col("mr")).otherwise(0.0)
            unruled = F.greatest(1 - F.col("good") - F.col("bad"), F.lit(0.0))
            ranks = stage(new.select("host", *(
                (F.lit(base) * seed + F.lit(damping) * F.coalesce(F.col(sent), F.lit(0.0))).alias(name)
                for name, seed, sent in (("t", F.col("good"), "mt"), ("p", F.lit(1.0), "mp"),
                                         ("d", F.col("bad"), "md"), ("r", F.lit(1.0), "mr"),
                                         ("u", F.col("bad") + unruled * of_links, "mu")))), "ranks")
    # Rounded, so that the order of sums cannot turn a verdict.
    return ranks.select("host", *(F.round(F.col(share) / F.col(rank), 9).alias(name) for share, rank, name in (
        ("t", "p", "trust"), ("d", "r", "distrust"), ("u", "r", "distrusted"))))


def url_verdicts(
    pages: DataFrame, rules: list[tuple[str, str, str]], threshold: float = THRESHOLD, rounds: int = ROUNDS,
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages`` (``page_id, url, html``).

    ``rules`` are ``(host, path, 'allow' or 'block')``; a rule fits its host and
    all subdomains when the path starts with its path, and the longest that
    fits decides.  Other pages are blocked when their host is.  Null urls and
    urls without ``://`` have an empty host and path, take no part in the graph
    and are allowed.  Null pages of html have no links.  Repeated rows are
    judged each.  Other columns are not read.
    """
    ruled = with_rules(pages, rules)
    share = {name: F.avg((F.col("ruled").eqNullSafe(F.lit(verdict))).cast("double")) for name, verdict in (("good", "allow"), ("bad", "block"))}
    seeds = ruled.where("host <> ''").groupBy("host").agg(*(v.alias(k) for k, v in share.items()))
    links = stage(host_links(pages), "host-links")
    scores = host_scores(seeds, links, rounds)
    blocked = stage(scores.where((F.col("distrusted") >= threshold) & (F.col("distrusted") > F.col("trust"))).select(
        "host", F.lit("block").alias("by_host")), "blocked-hosts")
    judged = lookup(ruled, blocked, ["host"], HOST_ROW)
    return judged.select("page_id", "host", "path", "rule", F.coalesce("ruled", "by_host", F.lit("allow")).alias("verdict"))
