"""URL filters with link-graph propagation, in DataFrame operations only.

Rules name a host and a path prefix; a rule fits its host and all subdomains,
and the longest one wins.  Pages without a rule are judged by their host:
trust starts at hosts with allowed pages and flows along links (personalised
PageRank); ``trust * allowed pages / pages of the host`` says how many allowed
pages stand behind each page of a host, and a host's own share counts in full.
Distrust flows against the links, from a host to those that link to it: it is
the share of random walks from the host's pages, going on over a link with
``DAMPING``, that come to a blocked page.  Each linker takes it by its own links,
so the verdict of a host does not depend on how many others link to the same
place.  A host is blocked if its distrust is at least ``threshold`` and more
than its trust.

(A personalised PageRank on the reversed links, from blocked seeds, was tried for
distrust: what reaches a linker is divided by the number of linkers, so a farm
of more than about seven hosts that link to one blocked place escaped it.)

Scale: pages are reduced to host edges with counts before any iteration; a
hot host is one row of the host table.  Every round joins the edge
table with the scores and sums by host; every fifth round is written to the
shared folder and compared with the one before, until the scores stand still.  Rules are a short
configured list and become one expression.

Defined cases: a null url or one without ``://`` has empty host and path, fits no
rule, is no node of the graph and is allowed; null html has no links; links within a
host are no edges; repeated pages count each; an empty table gives an empty
result; only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabflow.llm.common import discard, require, stored

# Fixed values: (verdict, host, path prefix).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
DAMPING, CHECK_EVERY, TOLERANCE, THRESHOLD = 0.85, 5, 1e-7, 0.5
#: No graph needs so many: what is still on its way after n rounds is below DAMPING ** n.
MOST_ROUNDS = 400
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)(?:href|src)\s*=\s*["']?\s*(?:https?:)?//([^/?#\s"'<>]+)"""


def host_and_path(url: str):
    """Host and path columns of a url."""
    host = F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host, path, rules=RULES):
    """(rule, verdict) columns: those of the longest rule that fits, else null."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r))
    fits = [((host == h) | host.endswith("." + h)) & path.startswith(p) for _, h, p in ordered]
    pick = lambda values: F.coalesce(*[F.when(f, F.lit(v)) for f, v in zip(fits, values)])
    return pick([h + p for _, h, p in ordered]), pick([v for v, _, _ in ordered])


def host_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """src, dst and number of links between different hosts."""
    host, _ = host_and_path(url)
    links = F.explode(F.regexp_extract_all(F.col(html), F.lit(LINK), F.lit(1)))
    return (pages.select(host.alias("src"), links.alias("link")).select("src", F.translate("link", UPPER, LOWER).alias("dst"))
            .where("src <> '' and src <> dst").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("links")))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE, rounds: int = MOST_ROUNDS) -> DataFrame:
    """Personalised PageRank for several seed sets at once, iterated until the
    scores move by less than ``tolerance`` in all; RuntimeError after ``rounds``.

    ``edges``: kind, src, dst, links; ``seeds``: kind, host, seed (sums to 1
    per kind).  What a host without outgoing links holds returns to the
    seeds.  Returns kind, host, score.
    """
    out = edges.groupBy("kind", "src").agg(F.sum("links").alias("all"))
    weights = stored(edges.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("links") / F.col("all")).alias("w")))
    hosts = (seeds.select("kind", "host").unionByName(edges.select("kind", F.col("src").alias("host")))
             .unionByName(edges.select("kind", F.col("dst").alias("host"))).distinct())
    ends = out.select("kind", F.col("src").alias("host"), F.lit(False).alias("end"))
    nodes = stored(hosts.join(seeds, ["kind", "host"], "left").join(ends, ["kind", "host"], "left")
                   .select("kind", "host", F.coalesce("seed", F.lit(0.0)).alias("seed"), F.coalesce("end", F.lit(True)).alias("end")))
    now, written, moved = nodes.withColumn("score", F.col("seed")), None, None
    for r in range(1, rounds + 1):
        flow = (now.select("kind", F.col("host").alias("src"), "score").join(weights, ["kind", "src"])
                .groupBy("kind", F.col("dst").alias("host")).agg(F.sum(F.col("score") * F.col("w")).alias("inflow")))
        lost = now.groupBy("kind").agg(F.sum(F.when(F.col("end"), F.col("score")).otherwise(0.0)).alias("lost"))
        new = F.lit(1 - damping) * F.col("seed") + F.lit(damping) * (F.coalesce("inflow", F.lit(0.0)) + F.col("lost") * F.col("seed"))
        now = (now.withColumnRenamed("score", "before").join(flow, ["kind", "host"], "left").join(F.broadcast(lost), "kind")  # lost: one row per kind
               .select("kind", "host", "seed", "end", "before", new.alias("score")))
        if r % CHECK_EVERY == 0:
            last, now = written, stored(now)
            moved = now.agg(F.sum(F.abs(F.col("score") - F.col("before")))).first()[0] or 0.0
            written, now = now, now.drop("before")
            if last is not None:
                discard(last)
            if moved < tolerance:
                return now.select("kind", "host", "score")
        else:
            now = now.drop("before")
    raise RuntimeError(f"scores still move by {moved} after {rounds} rounds")


def reach(links: DataFrame, own: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE, rounds: int = MOST_ROUNDS) -> DataFrame:
    """Share of random walks from each host that come to a marked page, iterated
    until no score moves by ``tolerance``; RuntimeError after ``rounds``.

    ``links``: src, dst, links; ``own``: host and its share of marked pages.  A
    walk that is not on a marked page goes on over a link of the host with
    probability ``damping``; a host outside ``own`` has no pages to come to.
    Returns host, score.
    """
    out = links.groupBy("src").agg(F.sum("links").alias("all"))
    weights = stored(links.join(out, "src").select("src", "dst", (F.col("links") / F.col("all")).alias("w")))
    now, written, moved = own.select("host", "own", F.col("own").cast("double").alias("score")), None, None
    for r in range(1, rounds + 1):
        flow = (weights.join(now.select(F.col("host").alias("dst"), "score"), "dst")
                .groupBy(F.col("src").alias("host")).agg(F.sum(F.col("score") * F.col("w")).alias("flow")))
        new = F.col("own") + (1 - F.col("own")) * F.lit(damping) * F.coalesce("flow", F.lit(0.0))
        now = now.withColumnRenamed("score", "before").join(flow, "host", "left").select("host", "own", "before", new.alias("score"))
        if r % CHECK_EVERY == 0:
            last, now = written, stored(now)
            moved = now.agg(F.max(F.abs(F.col("score") - F.col("before")))).first()[0] or 0.0
            written, now = now, now.drop("before")
            if last is not None:
                discard(last)
            if moved < tolerance:
                return now.select("host", "score")
        else:
            now = now.drop("before")
    raise RuntimeError(f"scores still move by {moved} after {rounds} rounds")


def filter_urls(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", rules=RULES,
                threshold: float = THRESHOLD) -> DataFrame:
    """page_id, host, path, rule, verdict, and the host's distrust and trust."""
    require(pages, page_id=page_id, url=url, html=html)
    host, path = host_and_path(url)
    split = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = stored(split.withColumns({"rule": rule, "by_rule": verdict}))
    hosts = stored(judged.where("host <> ''").groupBy("host").agg(
        F.count(F.lit(1)).alias("pages"), F.count(F.when(F.col("by_rule") == "allow", 1)).alias("allowed"),
        F.count(F.when(F.col("by_rule") == "block", 1)).alias("blocked")))
    links = stored(host_edges(pages, url, html))
    allowed = hosts.agg(F.sum("allowed")).first()[0] or 0
    seeds = hosts.where("allowed > 0").select(F.lit("trust").alias("kind"), "host", (F.col("allowed") / F.lit(max(allowed, 1))).alias("seed"))
    # Scores are compared after a factor of all allowed pages.
    trust = propagate(links.select(F.lit("trust").alias("kind"), "src", "dst", "links"), seeds, tolerance=min(TOLERANCE, 1e-3 / max(allowed, 1))).select("host", F.col("score").alias("trust"))
    distrust = reach(links, hosts.select("host", (F.col("blocked") / F.col("pages")).alias("own"))).select("host", F.col("score").alias("distrust"))
    rate = F.greatest(F.coalesce("trust", F.lit(0.0)) * F.lit(float(allowed)), F.col("allowed").cast("double")) / F.col("pages")
    ruled = stored(hosts.join(trust, "host", "left").join(distrust, "host", "left").select("host", rate.alias("trust"), "distrust"))
    bad = (F.col("distrust") >= threshold) & (F.col("distrust") > F.col("trust"))
    return (judged.join(ruled, "host", "left")
            .select("page_id", "host", "path", "rule", F.coalesce("by_rule", F.when(bad, F.lit("block")), F.lit("allow")).alias("verdict"),
                    F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust")))
