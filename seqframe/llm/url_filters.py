"""URL filters: rules by longest match, and a verdict from the link graph where no rule fits.

The link graph has an edge from a page's host to each other host that the page links to, and edges both ways between
a host and the domain above it, which share an owner; links and owners have shares of their own of what a host passes
on. Trust is a personalised PageRank that starts from hosts that rules allow; distrust runs over the reversed
edges from hosts that rules block, as who links to a blocked host is suspect. Both run as one join and aggregate
a round over host edges, until what still moves is below a tolerance. A host is blocked when its distrust is above a
threshold and above its trust.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqframe.operators.shaping import computed_once
from seqframe.session import broadcast_if_small, written

#: Share of a score that moves on along edges, and the part of all scores that may change when rounds end.
DAMPING, TOLERANCE = 0.85, 1e-3
#: Rounds between two written tables, where the change is looked at.
ROUNDS = 6
#: What a host passes on along its links and to owners' hosts, where it has both.
LINKS, OWNERS = 0.8, 0.2
#: Distrust, as a multiple of an even share among all hosts, from which a host is blocked.
THRESHOLD = 0.5
ALLOW, BLOCK = "allow", "block"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or without ``://``."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def links_of(html: Column) -> Column:
    """Hosts of the absolute links in a page's ``href`` attributes."""
    urls = F.regexp_extract_all(html, F.lit(r"""(?i)\bhref\s*=\s*["']?\s*((?:https?:)?//[^"'\s>]+)"""), F.lit(1))
    return F.transform(urls, lambda u: host_of(F.when(u.startswith("//"), F.concat(F.lit("http:"), u)).otherwise(u)))


def _parents(host: Column) -> Column:
    """A host and all domains above it."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict) of the distinct (host, path) that a rule fits; of several the longest, the first by code point among equals."""
    above = urls.filter("host != ''").select("host", "path", F.explode(_parents(F.col("host"))).alias("rule_host"))
    fits = above.join(broadcast_if_small(rules), "rule_host").filter(F.col("path").startswith(F.col("rule_path")))
    best = fits.groupBy("host", "path").agg(F.max(F.struct(F.length("rule").alias("n"), "rule", "verdict")).alias("b"))
    return best.select("host", "path", "b.rule", "b.verdict")


def owner_edges(hosts: DataFrame) -> DataFrame:
    """(src, dst): each host and the domain above it, both ways, up to the last domain of two names."""
    above = hosts.select(_parents(F.col("host")).alias("up")).filter(F.size("up") > 2)
    steps = above.select(F.explode(F.transform(F.sequence(F.lit(0), F.size("up") - 3), lambda i: F.struct(F.get("up", i).alias("src"), F.get("up", i + 1).alias("dst")))).alias("e"))
    steps = steps.select("e.src", "e.dst").filter("src != '' and dst != ''").distinct()
    return steps.union(steps.select(F.col("dst").alias("src"), F.col("src").alias("dst")))


def shares(edges: DataFrame) -> DataFrame:
    """(src, dst, share) from (src, dst, n, kind): of what src passes on, the part that goes to dst; all parts add up to 1."""
    per = edges.groupBy("src", "kind").agg(F.sum("n").alias("total"))
    weight = F.when(F.col("kind") == "link", LINKS).otherwise(OWNERS)
    every = per.groupBy(F.col("src").alias("s_")).agg(F.sum(weight).alias("weights"))
    unit = per.join(every, F.col("src") == F.col("s_")).select(F.col("src").alias("s_"), F.col("kind").alias("k_"), (weight / F.col("weights") / F.col("total")).alias("unit"))
    joined = edges.join(unit, (F.col("src") == F.col("s_")) & (F.col("kind") == F.col("k_")))
    return joined.groupBy("src", "dst").agg(F.sum(F.col("n") * F.col("unit")).alias("share"))


def propagated(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """(graph, host, score) of personalised PageRanks side by side (action).

    edges: (graph, src, dst, share); seeds: (graph, host), which share one unit evenly in each graph. Rounds go on until the
    scores of all hosts together change by less than ``tolerance`` in a round.
    """
    counts = seeds.groupBy(F.col("graph").alias("g_")).agg(F.count("*").alias("n"))
    start = seeds.join(F.broadcast(counts), F.col("graph") == F.col("g_")).select("graph", "host", (1.0 / F.col("n")).alias("score"))  # a row per graph
    start = written(start)
    scores = start
    while True:
        for _ in range(ROUNDS):
            old = scores
            moved = scores.alias("s").join(edges.alias("e"), (F.col("s.graph") == F.col("e.graph")) & (F.col("s.host") == F.col("e.src")))
            moved = moved.select("s.graph", F.col("e.dst").alias("host"), (damping * F.col("s.score") * F.col("e.share")).alias("score"))
            scores = moved.unionByName(start.withColumn("score", (1 - damping) * F.col("score"))).groupBy("graph", "host").agg(F.sum("score").alias("score"))
        # The last round's change comes with its scores, in one table.
        both = scores.withColumn("new", F.lit(1)).unionByName(old.withColumn("new", F.lit(0)))
        both = both.groupBy("graph", "host").agg(F.sum(F.col("score") * F.col("new")).alias("score"), F.sum(F.col("score") * (1 - F.col("new"))).alias("before"))
        both = written(both)
        change = both.groupBy("graph").agg(F.sum(F.abs(F.col("score") - F.col("before"))).alias("c")).agg(F.max("c")).first()[0] or 0.0
        scores = both.filter("score > 0").drop("before")
        if change < tolerance:
            return scores


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]] | DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", threshold: float = THRESHOLD, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per input row: ``id_col``, host, path, rule, verdict, trust, distrust (action).

    rules: (host, path, verdict), as a list or a DataFrame of these columns. A rule fits its host and all below
    it if the url's path starts with the rule's; the longest wins. Other urls have rule null and the link
    graph's verdict; without a host, or on a host that no score reaches, that is allow. A host seeds trust
    or distrust if some url of it fits a rule. Null urls and pages are without host and links.
    """
    spark = pages.sparkSession
    if isinstance(rules, list):
        rules = spark.createDataFrame(rules, "host string, path string, verdict string")
    rules = rules.select(F.lower("host").alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"), F.concat(F.lower("host"), F.coalesce("path", F.lit(""))).alias("rule"), F.col("verdict").alias("verdict")).filter("rule_host is not null").distinct()
    named = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    judged = written(matched(named.select("host", "path").distinct(), rules))

    linked = computed_once(pages, [host_of(F.col(url_col)).alias("src")], to=F.array_distinct(links_of(F.col(html_col))))
    edges = linked.filter("src != ''").select("src", F.explode("to").alias("dst")).filter("dst != '' and dst != src")
    links = written(edges.groupBy("src", "dst").agg(F.count("*").alias("n"), F.lit("link").alias("kind")))
    hosts = named.select("host").filter("host != ''").union(links.select("dst")).distinct()
    owners = owner_edges(hosts)
    edges = links.unionByName(owners.select("src", "dst", F.lit(1).cast("long").alias("n"), F.lit("owner").alias("kind")))
    edges = written(edges)
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n", "kind")
    graphs = [shares(g).withColumn("graph", F.lit(v)) for g, v in ((edges, ALLOW), (back, BLOCK))]
    seeds = judged.filter(F.col("verdict").isin(ALLOW, BLOCK)).select(F.col("verdict").alias("graph"), "host").distinct()
    scores = propagated(written(graphs[0].unionByName(graphs[1])), seeds, damping, tolerance)
    hosts = hosts.union(owners.select("src")).distinct().count()
    score = lambda v: F.max(F.when(F.col("graph") == v, F.col("score")))
    by_host = scores.groupBy("host").agg(score(ALLOW).alias("trust"), score(BLOCK).alias("distrust"))
    by_host = by_host.select(F.col("host").alias("h_"), *((F.coalesce(c, F.lit(0.0)) * hosts).alias(c) for c in ("trust", "distrust")))
    by_host = written(by_host)

    rows = named.join(judged.select(F.col("host").alias("rh"), F.col("path").alias("rp"), "rule", F.col("verdict").alias("ruled")), (F.col("host") == F.col("rh")) & (F.col("path") == F.col("rp")), "left")
    rows = rows.join(by_host, F.col("host") == F.col("h_"), "left")
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    method = F.when((distrust >= threshold) & (distrust > trust), BLOCK).otherwise(ALLOW)
    return rows.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), trust.alias("trust"), distrust.alias("distrust"))
