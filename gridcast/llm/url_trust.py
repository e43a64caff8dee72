"""URL filters by link-graph propagation.

Rules judge the urls they fit. For all others the host decides: trust spreads from trusted
hosts along links (personalised PageRank), distrust from blocked hosts against the links, to
hosts that link to them. A host whose distrust reaches a threshold and exceeds its trust is
blocked.

A host is a seed by the shares of its pages that rules allow and block. A host without a page
of its own is one by the shares of the links to it, whose host and path the rules judge as well.
Links within a host say nothing about it and are left out.

Everything is DataFrame functions. Hosts with a third of all pages or links are aggregated
before any shuffle; joins choose their plan by measured size.

Defined cases: a null url or one without ``://`` has an empty host and path, is in no graph
and is allowed; null html has no links; rows with equal page_id are separate rows; an empty
table gives an empty result; columns other than page_id, url and html are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.operators.sizing import attach, measure
from gridcast.params import LIMITS, Limits

Rule = tuple[str, str, str]
LINK = r"""(?i)\bhref\s*=\s*["']?\s*([^"'\s>]+)"""


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, ascii_uppercase, ascii_lowercase)


def url_host(url: Column) -> Column:
    return _ascii_lower(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def link_host(link: Column, own: Column) -> Column:
    """The host a link points to; null if to no web page."""
    other = F.when(link.rlike("(?i)^https?://"), url_host(link)).when(
        link.startswith("//"), url_host(F.concat(F.lit("x:"), link))
    )
    return F.when(other.isNotNull(), other).when(~link.rlike("(?i)^[a-z][a-z0-9+.-]*:"), own)


def link_path(link: Column) -> Column:
    """The path of a link with a host."""
    return url_path(F.when(link.startswith("//"), F.concat(F.lit("x:"), link)).otherwise(link))


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as a struct of verdict and rule; null if none does."""
    found = F.lit(None)
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule_host + rule_path).alias("rule"))).otherwise(found)
    return found


def host_edges(pages: DataFrame, rules: Sequence[Rule] = ()) -> DataFrame:
    """(src, dst, links, allowed, blocked) between different hosts: links, and those that a rule allows or blocks."""
    own = url_host(F.col("url"))
    verdict = F.col("_fit.verdict") if rules else F.lit(None).cast("string")
    fit = fitting_rule(F.col("dst"), link_path(F.col("link")), rules)
    return (
        pages.select(own.alias("src"), F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("link"))
        .select("src", "link", link_host(F.col("link"), F.col("src")).alias("dst"))
        .filter("src <> '' and dst <> '' and src <> dst")
        .select("src", "dst", fit.alias("_fit"))
        .groupBy("src", "dst").agg(
            F.count(F.lit(1)).alias("links"),
            F.count(F.when(verdict == "allow", 1)).alias("allowed"),
            F.count(F.when(verdict == "block", 1)).alias("blocked"),
        )
    )


def propagate(
    edges: DataFrame, seeds: DataFrame, damping: float = 0.85, within: float = 0.0005, limits: Limits = LIMITS
) -> DataFrame:
    """(kind, host, score): what arrives from ``seeds`` (kind, host, mass) along ``edges`` (kind, src, dst, links).

    A host passes on ``damping`` of what it gets, shared among its edges by their links. Each kind
    goes on by itself until what is under way, all of it, could raise no host's score by more than
    ``within``: in the worst case all of it meets on one host at every further step. The number of
    steps grows with the logarithm of the seeds.
    """
    out = edges.groupBy("kind", "src").agg(F.sum("links").alias("all_links"), F.count(F.lit(1)).alias("n_edges"))
    out = attach(edges, out, ["kind", "src"], "inner", limits, rows=None)
    edge = measure(out.withColumn("share", F.col("links") / F.col("all_links")).select("kind", "src", "dst", "share", "n_edges"), "edges")
    way = measure(seeds.filter("mass > 0").select("kind", F.col("host").alias("src"), "mass"), "seeds")
    reached = [way.df]

    def going() -> list[str]:
        left = way.df.groupBy("kind").agg(F.sum("mass").alias("mass")).filter(F.lit(damping) * F.col("mass") > within)
        # At most one row per kind.
        return [r.kind for r in left.collect()]

    while edge.rows and (kinds := going()):
        moved = (
            attach(edge.df, way.df.filter(F.col("kind").isin(kinds)), ["kind", "src"], "inner", limits, at_most=way.bytes)
            .groupBy("kind", F.col("dst").alias("src"))
            .agg((F.lit(damping) * F.sum(F.col("share") * F.col("mass"))).alias("mass"))
        )
        way = measure(moved, "under-way")
        reached.append(way.df)
    return (
        reduce(DataFrame.unionByName, reached).groupBy("kind", F.col("src").alias("host"))
        .agg(((1 - damping) * F.sum("mass")).alias("score"))
    )


def url_verdicts(
    pages: DataFrame,
    rules: Sequence[Rule],
    threshold: float = 0.05,
    damping: float = 0.85,
    limits: Limits = LIMITS,
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, and the host's trust and distrust.

    ``threshold``: distrust from which a host is blocked; a seed alone has 1 - damping. Scores are
    right within a hundredth of it.
    """
    host, path = url_host(F.col("url")), url_path(F.col("url"))
    judged = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn(
        "_fit", fitting_rule(F.col("host"), F.col("path"), rules)
    )
    hosts = judged.groupBy("host").agg(
        F.count(F.lit(1)).alias("n_pages"),
        F.avg((F.coalesce(F.col("_fit.verdict"), F.lit("")) == "allow").cast("double")).alias("allowed"),
        F.avg((F.coalesce(F.col("_fit.verdict"), F.lit("")) == "block").cast("double")).alias("blocked"),
    )
    hosts = measure(hosts, "hosts")
    links = measure(host_edges(pages, rules), "links").df
    # Hosts without a page of their own are judged by the links to them.
    linked = links.groupBy(F.col("dst").alias("host")).agg(*[
        (F.sum(c) / F.sum("links")).alias(c) for c in ("allowed", "blocked")
    ]).filter("allowed > 0 or blocked > 0")
    known = hosts.df.select("host", F.lit(True).alias("known"))
    unseen = attach(linked, known, ["host"], "left", limits, at_most=hosts.bytes).filter("known is null").drop("known")
    seeds = (
        hosts.df.filter("host <> ''").select("host", "allowed", "blocked").unionByName(unseen)
        .select("host", F.explode(F.array(
            F.struct(F.lit("trust").alias("kind"), F.col("allowed").alias("mass")),
            F.struct(F.lit("distrust").alias("kind"), F.col("blocked").alias("mass")),
        )).alias("s"))
        .select("host", "s.*")
    )
    both = links.select(F.lit("trust").alias("kind"), "src", "dst", "links").unionByName(
        links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "links")
    )
    scores = propagate(both, seeds, damping, threshold / 100, limits).groupBy("host").agg(
        F.coalesce(F.sum(F.when(F.col("kind") == "trust", F.col("score"))), F.lit(0.0)).alias("trust"),
        F.coalesce(F.sum(F.when(F.col("kind") == "distrust", F.col("score"))), F.lit(0.0)).alias("distrust"),
    )
    scored = attach(hosts.df.select("host", "n_pages"), scores, ["host"], "left", limits).fillna(0.0, ["trust", "distrust"])
    by_host = F.when((F.col("distrust") >= threshold) & (F.col("distrust") > F.col("trust")), "block").otherwise("allow")
    return attach(judged, scored, ["host"], "left", limits, rows="n_pages").select(
        "page_id", "host", "path", F.col("_fit.rule").alias("rule"),
        F.coalesce(F.col("_fit.verdict"), by_host).alias("verdict"), "trust", "distrust",
    )
