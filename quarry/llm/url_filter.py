"""URL filtering by rules and by trust that flows over links between hosts.

Rules name a host and a path prefix and fit the host and all its subdomains;
the longest rule that fits decides. Pages that no rule fits are judged by their
host: personalised PageRank spreads trust from the hosts of allowed pages along
links, and distrust from the hosts of blocked pages against the links (who
links to a bad host is suspect). A host is blocked when distrust makes up more
than ``threshold`` of the two. A host that neither reaches is allowed.

The ranks are summed over paths of growing length until no host's rank grows by
more than ``tolerance`` of itself, so every host that mass reaches has a rank,
however many links away; ``rounds`` is a safety limit that raises.

Built-in functions only. Links are reduced to distinct host pairs right after
they are parsed, so each round moves one row per host pair; ranks are written
to the shared folder after each round. A host with very many links or pages is
a hot join key, which adaptive execution splits; sums combine map-side.

Defined results: a null url, or one without ``://``, has an empty host and path
and is allowed; null html has no links; all links of a very long page count; of rules
of equal length the last in the list decides; repeated rows are judged alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import LOWER, UPPER, drop_stages, stage

LINK = r"""(?is)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]+)"""
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_host(url):
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 1), UPPER, LOWER)


def url_path(url):
    return F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 2)


def matching_rule(host, path, rules: list[tuple[str, str]]):
    """The longest rule ``(verdict, "host/path")`` that fits, else null. The
    rules are a parameter of the job and become one expression."""
    found = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: len(r[1])):
        name, _, prefix = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit("/" + prefix))
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def host_links(pages: DataFrame) -> DataFrame:
    """Distinct links between two hosts, ``src`` and ``dst``."""
    link = F.explode(F.array_distinct(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1))))
    target = F.when(F.startswith("link", F.lit("//")), F.concat(F.lit("http:"), F.col("link"))).otherwise(F.col("link"))
    return (
        pages.select(url_host(F.col("url")).alias("src"), link.alias("link"))
        .select("src", url_host(target).alias("dst"))
        .where("src <> '' and dst <> '' and src <> dst")
        .distinct()
    )


def personalised_rank(
    links: DataFrame, seeds: DataFrame, damping: float, rounds: int, tolerance: float
) -> DataFrame:
    """``host, rank`` for the hosts that the seeds' mass reaches.

    ``seeds``: ``host, share`` with shares that sum to one (or no row). Mass of
    hosts without outgoing links returns to the seeds: the ranks are those of
    mass that is lost there, scaled to a sum of one. Stops once no host's rank
    grows by more than ``tolerance`` of itself, which a host that is newly
    reached always does; raises if that takes more than ``rounds``.
    """
    spark = links.sparkSession
    degree = links.groupBy("src").agg(F.count(F.lit(1)).alias("degree"))
    steps, kept = stage(links.join(degree, "src").select("src", "dst", (1 / F.col("degree")).alias("part")), "links")
    start = seeds.select("host", F.col("share").alias("rank"), F.lit(0.0).alias("old"))
    rank, path = stage(start, "rank")
    for _ in range(rounds):
        flow = (
            rank.join(steps, rank["host"] == steps["src"])
            .groupBy("dst")
            .agg((damping * F.sum(F.col("rank") * F.col("part"))).alias("rank"))
            .select(F.col("dst").alias("host"), "rank", F.lit(0.0).alias("old"))
        )
        old = rank.select("host", F.lit(0.0).alias("rank"), F.col("rank").alias("old"))
        summed = flow.union(start).union(old).groupBy("host").agg(F.sum("rank").alias("rank"), F.sum("old").alias("old"))
        new, new_path = stage(summed, "rank")
        growing = new.where(F.abs(F.col("rank") - F.col("old")) > tolerance * F.col("rank"))
        settled = growing.isEmpty()
        drop_stages(spark, [path])
        rank, path = new, new_path
        if settled:
            break
    else:
        raise RuntimeError(f"ranks of hosts not settled after {rounds} rounds")
    drop_stages(spark, [kept])
    total = rank.agg(F.sum("rank").alias("t")).first()["t"]
    return rank.select("host", (F.col("rank") / F.lit(float(total or 1))).alias("rank"))


def filter_urls(
    pages: DataFrame,
    rules: list[tuple[str, str]],
    damping: float = 0.85,
    rounds: int = 2000,
    tolerance: float = 1e-6,
    threshold: float = 0.5,
) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict`` and the host's
    ``trust`` and ``distrust``."""
    url = F.col("url")
    judged = pages.select("page_id", url_host(url).alias("host"), url_path(url).alias("path")).withColumn(
        "rule", matching_rule(F.col("host"), F.col("path"), rules)
    )
    verdicts = F.lit(None).cast("string")
    for verdict, rule in rules:
        verdicts = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(verdicts)
    judged, _ = stage(judged.withColumn("by_rule", verdicts), "urls")
    links, _ = stage(host_links(pages), "host-links")

    counted = (
        judged.where("host <> '' and by_rule is not null")
        .groupBy("host")
        .agg(
            F.count(F.when(F.col("by_rule") == "allow", 1)).alias("good"),
            F.count(F.when(F.col("by_rule") == "block", 1)).alias("bad"),
        )
    )
    seeds, _ = stage(counted, "seeds")
    full = seeds.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).first()

    def spread(column: str, along: DataFrame, name: str) -> DataFrame:
        total = full[column] or 0
        share = F.col(column) / F.lit(float(total or 1))
        start = seeds.where(F.col(column) > 0).select("host", share.alias("share"))
        return personalised_rank(along, start, damping, rounds, tolerance).select("host", F.col("rank").alias(name))

    trust = spread("good", links, "trust")
    distrust = spread("bad", links.select(F.col("dst").alias("src"), F.col("src").alias("dst")), "distrust")
    hosts = trust.join(distrust, "host", "full").fillna(0.0, ["trust", "distrust"])
    suspect = F.col("distrust") > threshold * (F.col("trust") + F.col("distrust"))
    return (
        judged.join(hosts, "host", "left")
        .fillna(0.0, ["trust", "distrust"])
        .select(
            "page_id",
            "host",
            "path",
            "rule",
            F.coalesce("by_rule", F.when(suspect, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
            "trust",
            "distrust",
        )
    )
