"""URL filtering: rules first, then trust and distrust spread over the graph of hosts. DataFrame operations only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreage.llm.exact_dedup import UPPER
from acreage.llm.scratch import stage

LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""
#: Second-level names under which, before a two-letter country, anyone can have a site: co.uk is no site, bbc.co.uk is one.
OPEN_NAMES = ("ac", "co", "com", "edu", "gen", "go", "gob", "gov", "ltd", "mil", "ne", "net", "nom", "or", "org", "plc", "sch")
#: A host's links are dealt out in blocks of so many.
FANOUT = 10_000
#: Rounds between two looks at whether ranks have settled.
ROUNDS = 5


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return F.coalesce(F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end; empty without ://."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule (verdict, host/path) that fits, as a struct (rule, verdict), or null. rules is a short list of settings."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def node_of(host: Column) -> Column:
    """The name that stands for a host in the graph: without user, port and a dot at the end."""
    bare = F.regexp_replace(host, r"^[^@]*@", "")
    return F.regexp_replace(F.regexp_replace(bare, r":\d*$", ""), r"\.$", "")


def names_above(node: Column) -> Column:
    """The host and the names above it down to its site, nearest first. Addresses and sites have only themselves.

    A site has two labels, or three where the second-level name is open to anyone (see OPEN_NAMES).
    """
    labels = F.split(node, r"\.")
    n = F.size(labels)
    country = (F.length(F.element_at(labels, -1)) == 2) & F.get(labels, n - 2).isin(*OPEN_NAMES)
    site = F.when(country, 3).otherwise(2)
    address = node.rlike(r"^\d+(\.\d+){3}$") | node.startswith("[")
    up = F.transform(F.sequence(F.lit(1), n - site + 1), lambda k: F.array_join(F.slice(labels, k, n), "."))
    return F.when(address | (n <= site), F.array(node)).otherwise(up)


def host_edges(judged: DataFrame, html_col: str) -> DataFrame:
    """(src, dst, weight): hyperlinks between hosts, and the steps between a host and the next name up to its site.

    Edges are summed before the exchange, so a host with a third of all pages sends one row from each task for each of
    the hosts that it links to. Links without a scheme count, those within a host don't.
    """
    links = judged.select(
        F.col("node").alias("src"), F.explode(F.regexp_extract_all(html_col, F.lit(LINK), F.lit(1))).alias("dst")
    )
    links = links.select(
        "src", node_of(F.translate("dst", UPPER, UPPER.lower())).alias("dst")
    ).where("src <> '' and dst <> '' and src <> dst").groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))
    hosts = judged.where("node <> ''").select("node").union(links.select("src")).union(links.select("dst")).distinct().select(
        names_above(F.col("node")).alias("up")
    )
    steps = hosts.where(F.size("up") > 1).select(
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.size("up") - 2),
                lambda k: F.struct(F.get("up", k).alias("lower"), F.get("up", k + 1).alias("upper"))
            )
        ).alias("s")
    ).select("s.*").distinct()
    tree = steps.select(F.col("lower").alias("src"), F.col("upper").alias("dst")).union(
        steps.select(F.col("upper").alias("src"), F.col("lower").alias("dst"))
    ).withColumn("weight", F.lit(1.0))
    return links.union(tree).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def shares_of(rank: DataFrame) -> DataFrame:
    """(host, distrust): distrust's share in the ranks (kind, host, rank) of a host, where those of each kind sum to one."""
    totals = rank.groupBy("kind").agg(F.sum("rank").alias("total"))
    of = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("rank") / F.col("total")).otherwise(0.0))
    both = rank.join(F.broadcast(totals), "kind").groupBy("host").agg(of("allow").alias("trust"), of("block").alias("against"))
    return both.select("host", F.round(F.try_divide("against", F.col("trust") + F.col("against")), 9).alias("distrust"))


def spread(edges: DataFrame, seeds: DataFrame, damping: float, tolerance: float) -> DataFrame:
    """Personalised PageRank for each kind, settled and up to a factor: (kind, host, rank).

    edges (kind, src, dst, weight); seeds (kind, host, seed) sum to one for each kind. What a host without outgoing edges
    holds goes back to the seeds: that only scales all ranks of a kind, so it is left out here and shares_of scales them.
    Each round is one join on the host and one aggregation with map-side combining; the links of a host with very many
    are dealt out in blocks, each of which gets the host's rank. Every ROUNDS rounds the ranks are written to the shared
    folder; rounds go on until no host is new and no host's distrust has moved by more than tolerance since. As what is
    not settled shrinks by damping in each round, this ends whatever the graph.
    """
    out = edges.groupBy("kind", "src").agg(
        F.sum("weight").alias("out"), F.ceil(F.count("*") / FANOUT).cast("int").alias("blocks")
    )
    share = edges.join(out, ["kind", "src"]).select(
        "kind", "src", F.pmod(F.xxhash64("dst"), F.col("blocks")).cast("int").alias("block"), "dst",
        (damping * F.col("weight") / F.col("out")).alias("share")
    )
    share = stage(share, "share")
    hubs = stage(out.where("blocks > 1").select("kind", "src", "blocks"), "hubs")
    some = not hubs.isEmpty()
    seed = seeds.select("kind", "host", ((1.0 - damping) * F.col("seed")).alias("rank"))
    rank = before = stage(seed, "rank")
    while True:
        for _ in range(ROUNDS):
            sent = rank.withColumnRenamed("host", "src")
            if some:
                sent = sent.join(hubs, ["kind", "src"], "left").select(
                    "kind", "src", "rank", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)).alias("block")
                )
            else:
                sent = sent.withColumn("block", F.lit(0))
            # Merged, not broadcast: the driver holds nothing of a round, whatever the number of rounds.
            moved = sent.hint("merge").join(share, ["kind", "src", "block"]).select(
                "kind", F.col("dst").alias("host"), (F.col("rank") * F.col("share")).alias("rank")
            )
            rank = moved.union(seed).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        rank = stage(rank, "rank")
        both = shares_of(rank).join(shares_of(before).withColumnRenamed("distrust", "earlier").hint("merge"), "host", "left")
        if both.where(F.col("earlier").isNull() | (F.abs(F.col("distrust") - F.col("earlier")) > tolerance)).isEmpty():
            return rank
        before = rank


def filter_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str]], id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    *, damping: float = 0.85, tolerance: float = 1e-4, threshold: float = 0.5, default: str = "allow",
) -> DataFrame:
    """One row for each row of pages: (id, host, path, rule, verdict, distrust).

    The longest fitting rule decides; of rules that are alike in text the last one given. For other pages the host does:
    hosts are seeded with trust by their pages under allow rules and with distrust by their pages under block rules, trust
    follows the edges between hosts, distrust goes against them, and a host whose share distrust / (trust + distrust)
    exceeds threshold is blocked. User, port and a dot at the end don't tell hosts apart there. Hosts that neither reaches,
    and pages without a host (null url, no ://), get default. Null html has no links. Without seeds of either kind all
    hosts get default. Repeated rows give repeated results; an empty table gives none; other columns are ignored.
    """
    judged = pages.select(
        F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"),
        F.col(html_col).alias("html")
    )
    judged = judged.withColumns({"node": node_of(F.col("host")), "hit": rule_for(F.col("host"), F.col("path"), rules)})
    edges = stage(host_edges(judged, "html"), "edges")
    seen = judged.where("node <> '' and hit is not null").groupBy(
        F.col("hit.verdict").alias("kind"), F.col("node").alias("host")
    ).agg(F.count("*").cast("double").alias("n"))
    totals = seen.groupBy("kind").agg(F.sum("n").alias("total"))
    seeds = stage(seen.join(totals, "kind").select("kind", "host", (F.col("n") / F.col("total")).alias("seed")), "seeds")
    against = edges.select(F.lit("block").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    rank = spread(edges.select(F.lit("allow").alias("kind"), "src", "dst", "weight").union(against), seeds, damping, tolerance)
    out = judged.drop("html").join(shares_of(rank).withColumnRenamed("host", "node"), "node", "left")
    verdict = F.coalesce(
        "hit.verdict", F.when(F.col("distrust") > threshold, "block").when(F.col("distrust") <= threshold, "allow"),
        F.lit(default)
    )
    return out.select(
        F.col("id").alias(id_col), "host", "path", F.col("hit.rule").alias("rule"), verdict.alias("verdict"), "distrust"
    )
