"""URL filter by link-graph propagation of trust and distrust.

Rules judge the urls they fit; for all others the host decides.  Links between
hosts are counted from the pages.  Both walks start at seeds with the share
1 - damping and both scores are shares from 0 to 1.  Trust starts at hosts in
proportion to the share of their pages that a rule allows (of the links to them,
where a host has no page in the table) and flows along links (personalised
PageRank: a host hands its rank on in proportion to its links); a host's trust is
the part of its whole rank, with every host a seed, that comes from trusted seeds.
Distrust starts in proportion to the share that a rule blocks and flows against the
links (a host takes over the mean distrust of what it links to) and never falls below
the share of a host's own pages that is blocked.  A host is blocked
if its distrust reaches the threshold, which full trust raises by half and no
number of links to it raises further.

Everything is DataFrame operations: links are aggregated to host pairs before
any join, so a host with a third of all pages is one node with at most as many
edges as there are hosts, and each step is one join and one aggregate over the
edges, cut by a stored table.

Defined cases: a null url or one without ``://`` has empty host and path, fits
no rule and is allowed; hosts without links keep what their own pages earned; hosts that differ in the port only are one
node of the graph; links in comments, scripts, styles, templates and text fields are none;
links to the own host are ignored; null html has no links; repeated pages are
judged each; an empty table gives an empty result.  Only id, url and html are
read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloop.llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)<a\b[^>]*?\shref\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+[^?#"'\s>]*)"""
#: What is no markup of the page: comments, and what scripts, styles and text fields hold.
UNSEEN = r"""(?is)<!--.*?(?:-->|$)|<(script|style|textarea|template)\b.*?(?:</\1\s*>|$)"""

#: (verdict, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def lower_host(host: Column) -> Column:
    return F.translate(host, UPPER, LOWER)


def host_of(url: Column) -> Column:
    return F.coalesce(lower_host(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_columns(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        rule, verdict = F.when(fits, F.lit(name + start)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def node_name(host: Column) -> Column:
    """A host as the graph knows it: without its port and what stands before an @."""
    return F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":\d*$", "")


def host_links(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = (), html_col: str = "html") -> DataFrame:
    """(src, dst, w, allowed, blocked): w links from pages of src to dst, and how many of their targets the rules
    allow and block; ``pages`` has a column host."""
    seen = F.regexp_replace(F.coalesce(F.col(html_col), F.lit("")), UNSEEN, " ")
    found = F.explode(F.regexp_extract_all(seen, F.lit(LINK), F.lit(1)))
    links = pages.where("host != ''").select(node_name(F.col("host")).alias("src"), found.alias("to"))
    name = node_name(lower_host(F.regexp_extract("to", r"^[^/]*", 0)))
    links = links.select("src", name.alias("dst"), F.regexp_extract("to", r"/.*$", 0).alias("path")).where("src != dst and dst != ''")
    _, verdict = rule_columns(F.col("dst"), F.col("path"), rules)
    return (links.select("src", "dst", verdict.alias("ruled")).groupBy("src", "dst").agg(
        F.count(F.lit(1)).alias("w"), F.count(F.when(F.col("ruled") == "allow", 1)).alias("allowed"),
        F.count(F.when(F.col("ruled") == "block", 1)).alias("blocked")))


def host_edges(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(src, dst, w): w links from pages of src to dst; ``pages`` has a column host."""
    return host_links(pages, (), html_col).select("src", "dst", "w")


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = 0.85, steps: int = 200, tolerance: float = 1e-4) -> DataFrame:
    """(host, trust, distrust) of every host in ``seeds`` (host, allowed, blocked) or ``edges``.

    Ends when no score moves by more than ``tolerance`` (some 60 steps where links form
    rings), and raises an error if that takes more than ``steps`` steps.
    """
    out_of = edges.groupBy("src").agg(F.sum("w").alias("all"))
    shares = stored(edges.join(out_of, "src").select("src", "dst", (F.col("w") / F.col("all")).alias("share")), "host-edges")
    named = reduce(DataFrame.unionByName, [
        seeds.select("host", "allowed", "blocked"),
        *(shares.select(F.col(c).alias("host"), F.lit(0.0).alias("allowed"), F.lit(0.0).alias("blocked")) for c in ("src", "dst"))])
    base = stored(named.groupBy("host").agg(F.max("allowed").alias("allowed"), F.max("blocked").alias("blocked")), "host-seeds")
    start = lambda what: F.col(what) * (1 - damping)
    base = stored(base.select("host", "blocked", start("allowed").alias("t"), F.lit(1.0 - damping).alias("r"), start("blocked").alias("d")), "host-starts")
    now = base.select("host", "t", "r", F.col("blocked").alias("d"))
    moved, done = None, shares.isEmpty()
    for _ in range(0 if done else steps):
        given = (shares.join(now.select(F.col("host").alias("src"), "t", "r"), "src").groupBy(F.col("dst").alias("host"))
                 .agg(F.sum(F.col("share") * F.col("t")).alias("dt"), F.sum(F.col("share") * F.col("r")).alias("dr")))
        taken = (shares.join(now.select(F.col("host").alias("dst"), "d"), "dst")
                 .groupBy(F.col("src").alias("host")).agg(F.sum(F.col("share") * F.col("d")).alias("dd")))
        more = lambda c: (F.col(c) + damping * F.coalesce(f"d{c}", F.lit(0.0))).alias(c)
        step = (base.join(given, "host", "left").join(taken, "host", "left")
                .join(now.select("host", F.col("t").alias("t0"), F.col("r").alias("r0"), F.col("d").alias("d0")), "host")
                .select("host", more("t"), more("r"), F.greatest("blocked", more("d")).alias("d"), "t0", "r0", "d0"))
        step = stored(step, "host-scores")
        # Ranks move in proportion to themselves.
        moved = step.agg(F.max(F.greatest(F.abs(F.col("r") - F.col("r0")) / F.col("r"), F.abs(F.col("t") - F.col("t0")) / F.col("r"),
                                          F.abs(F.col("d") - F.col("d0"))))).first()[0]
        now, done = step.select("host", "t", "r", "d"), (moved or 0.0) <= tolerance
        if done:
            break
    if not done:
        raise RuntimeError(f"trust still moves by {moved} after {steps} steps")
    return now.select("host", (F.col("t") / F.col("r")).alias("trust"), F.col("d").alias("distrust"))


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, threshold: float = 0.5, damping: float = 0.85,
               steps: int = 200, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: host, path, the rule that fits or null, the verdict, and the host's trust and distrust."""
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    seen = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"), F.col(html_col).alias("html"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    ruled = seen.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled"))
    share = lambda what: F.avg(F.when(F.col("ruled") == what, 1.0).otherwise(0.0))
    own = ruled.where("host != ''").groupBy(node_name(F.col("host")).alias("host")).agg(share("allow").alias("allowed"), share("block").alias("blocked"))
    links = stored(host_links(seen, rules), "host-links")
    # A host without pages in the table is judged by the urls that links to it name.
    named = links.groupBy(F.col("dst").alias("host")).agg(
        (F.sum("allowed") / F.sum("w")).alias("allowed"), (F.sum("blocked") / F.sum("w")).alias("blocked"))
    seeds = own.unionByName(named.join(own.select("host"), "host", "left_anti"))
    scores = propagate(seeds, links.select("src", "dst", "w"), damping, steps)
    bad = F.coalesce(F.col("distrust") >= threshold * (1 + F.col("trust") / 2), F.lit(False))
    return ruled.join(scores.withColumnRenamed("host", "node"), node_name(F.col("host")) == F.col("node"), "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", F.when(bad, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"), "trust", "distrust")
