"""URL filter lists, and trust spread over the links between hosts where no rule speaks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.llm.common import stored

RULES = "rule_host string, rule_path string, rule_verdict string"
WHITE = r" \t\n\f\r"
# The host of an absolute (or scheme-less) link of an anchor.
LINK = (
    rf"(?i)<a[{WHITE}](?:[^<>]*?[{WHITE}])?href[{WHITE}]*=[{WHITE}]*[\"']?[{WHITE}]*"
    rf"(?:https?:)?//([^/?#\"'<>\\{WHITE}]+)"
)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, ascii_uppercase, ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What follows the first ``://``, to ``/``, ``?`` or ``#``, A-Z in lower case, and what follows that,
    to ``?`` or ``#``. Both are empty for a null URL and for one without ``://``."""
    rest = F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://((?s:.*))$", 1), F.lit(""))
    host = lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0))
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules given as ``(verdict, host, path)``."""
    return spark.createDataFrame([(host, path, verdict) for verdict, host, path in rules], RULES)


def rules_of_hosts(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """Each host that rules fit, with those rules, the longest first: ``host, rules``.

    A host meets rules by an equal join on those of its suffixes that have no more labels than
    the longest rule has. The array of a host is bounded by the rule list, whatever the pages.
    Equally long rules go by their text, and ``block`` goes before ``allow`` where a rule has both.
    """
    known = rules.dropna().distinct()
    labels = known.agg(F.max(F.size(F.split("rule_host", r"\.")))).first()[0] or 0
    parts = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size(parts), F.lit(max(labels, 1)))),
        lambda n: F.array_join(F.slice(parts, -n, n), "."),
    )
    text = F.concat("rule_host", "rule_path")
    entry = F.struct(
        (-F.length(text)).alias("order"),
        text.alias("rule"),
        (F.col("rule_verdict") != "block").alias("allows"),
        "rule_path",
        "rule_verdict",
    )
    return (
        hosts.filter("host <> ''")
        .select("host", F.explode(suffixes).alias("rule_host"))
        .join(known, "rule_host")
        .groupBy("host")
        .agg(F.sort_array(F.collect_list(entry)).alias("rules"))
    )


def judge(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """``rows`` with ``host`` and ``path``, and the longest rule that fits: ``rule``, ``rule_verdict``, or nulls.

    The hosts' rules are written first. Spark then joins them by a measured size, or splits the rows of a
    host that has very many, which it cannot where the other side is an aggregate.
    """
    found = stored(rules_of_hosts(rows.select("host").distinct(), rules), "host-rules")
    best = F.get(F.filter("rules", lambda r: F.startswith(F.col("path"), r["rule_path"])), F.lit(0))
    return (
        rows.join(found, "host", "left")
        .withColumn("best", best)
        .select(*rows.columns, F.col("best.rule").alias("rule"), F.col("best.rule_verdict").alias("rule_verdict"))
    )


def host_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Each pair of different hosts of which one links to the other: ``source, target``.

    Anchors with an absolute link count; a relative one stays on its host.
    """
    targets = F.array_distinct(F.regexp_extract_all(F.col(html), F.lit(LINK), F.lit(1)))
    return (
        pages.select(host_and_path(F.col(url))[0].alias("source"), F.explode(targets).alias("target"))
        .select("source", lower_ascii(F.col("target")).alias("target"))
        .filter("source <> '' AND target <> '' AND source <> target")
        .distinct()
    )


def spread(
    links: DataFrame, seeds: DataFrame, *, damping: float = 0.85, rounds: int = 30, least: float = 1e-6
) -> DataFrame:
    """Trust along the links and distrust against them: ``host, trust, distrust``.

    Both are personalised PageRank, but not divided by the sum of the seeds, so that the two
    compare. A walk starts at the seeds (``host, trust, distrust`` in ``seeds``, the latter two
    from 0 to 1) and goes on with probability ``damping``: to each host that its host links to
    alike, or for distrust to each that links to its host. A walk without a way on ends. A score
    is the number of times that walks come by. What the walks of one length carry is a join on
    the hosts' links, added up before the shuffle; Spark's skew join splits the links of a host
    that has very many. Steps end after ``rounds``, or when no more than the share ``least`` of the
    seeds still walks.
    """
    ends = {"trust": ("source", "target"), "distrust": ("target", "source")}

    def moves(kind: str) -> DataFrame:
        start, end = ends[kind]
        ways = links.groupBy(start).agg((damping / F.count("*")).alias("share"))
        return links.join(ways, start).select(
            F.lit(kind).alias("kind"), F.col(start).alias("host"), F.col(end).alias("to"), "share"
        )

    ways = stored(moves("trust").unionByName(moves("distrust")), "host-links")
    at_seeds = F.expr("stack(2, 'trust', trust, 'distrust', distrust) AS (kind, mass)")
    walks = [stored(seeds.select("host", at_seeds).filter("mass > 0"), "host-walks")]
    start = walks[0].agg(F.sum("mass")).first()[0] or 0.0
    for _ in range(rounds):
        step = walks[-1].join(ways, ["kind", "host"]).groupBy("kind", F.col("to").alias("host"))
        step = stored(step.agg(F.sum(F.col("mass") * F.col("share")).alias("mass")), "host-walks")
        going = step.agg(F.sum("mass")).first()[0] or 0.0
        if going <= least * start:
            break
        walks.append(step)
    # Sums differ in their last digits with the order of rows; verdicts must not.
    sums = {k: F.sum(F.when(F.col("kind") == k, F.col("mass")).otherwise(0.0)) for k in ends}
    return (
        reduce(DataFrame.unionByName, (w.select("kind", "host", "mass") for w in walks))
        .groupBy("host")
        .agg(*(F.round(total, 9).alias(k) for k, total in sums.items()))
    )


def filter_urls(
    pages: DataFrame,
    rules: DataFrame,
    *,
    ident: str = "page_id",
    url: str = "url",
    html: str = "html",
    threshold: float = 1.0,
    damping: float = 0.85,
    rounds: int = 30,
) -> DataFrame:
    """Each page's ``host, path, rule, verdict``, and its host's ``trust, distrust``.

    A rule fits its host and all subdomains, where the path starts with the rule's; the longest
    decides. Pages that no rule fits take their host's verdict: blocked, if its distrust is more than
    ``threshold`` times its trust, as both reach it over the links (``spread``). The seeds are the
    shares of a host's pages that rules allow and block; a host that is only linked to counts as
    one page at its root. Hosts that neither reaches are allowed.

    Null URLs and those without ``://`` have no host and are allowed by the method; null or empty
    HTML has no links. Rows that repeat are each judged; their host's shares count them all. An
    empty table gives an empty result, without rules all pages are allowed. Other columns of
    ``pages``, of whatever name, are not read.
    """
    host, path = host_and_path(F.col(url))
    rows = pages.select(F.col(ident).alias("page_id"), host.alias("host"), path.alias("path"))
    judged = stored(judge(rows, rules), "judged-pages")
    links = stored(host_links(pages, url, html), "host-pairs")
    seen = judged.select("host").distinct()
    linked = links.select(F.col("target").alias("host")).distinct().join(seen, "host", "left_anti")
    unseen = judge(linked.withColumn("path", F.lit("/")), rules)
    share = {"trust": "allow", "distrust": "block"}
    seeds = (
        judged.filter("host <> ''")
        .select("host", "rule_verdict")
        .unionByName(unseen.select("host", "rule_verdict"))
        .groupBy("host")
        .agg(*(F.avg(F.coalesce(F.col("rule_verdict") == v, F.lit(False)).cast("int")).alias(k) for k, v in share.items()))
    )
    scores = stored(spread(links, seeds, damping=damping, rounds=rounds), "host-scores")
    by_host = F.when(F.col("distrust") > threshold * F.col("trust"), "block").otherwise("allow")
    return (
        judged.join(scores, "host", "left")
        .withColumns({k: F.coalesce(F.col(k), F.lit(0.0)) for k in share})
        .select(
            "page_id",
            "host",
            "path",
            "rule",
            F.coalesce("rule_verdict", by_host).alias("verdict"),
            F.round("trust", 6).alias("trust"),
            F.round("distrust", 6).alias("distrust"),
        )
    )
