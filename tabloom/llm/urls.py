"""URL rules, and verdicts from the graph of links between hosts, in DataFrame operations only."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.plans.storage import checkpointed

HREF = r"""(?i)\bhref\s*=\s*["']?([^"'\s>]+)"""


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule (host, path, verdict) that fits the host or a parent domain and starts the path."""
    name = verdict = F.lit(None).cast("string")
    for domain, prefix, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(prefix)
        name = F.when(fits, domain + prefix).otherwise(name)
        verdict = F.when(fits, says).otherwise(verdict)
    return name, verdict


def spread_trust(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, rounds: int = 30, tolerance: float = 1e-9) -> DataFrame:
    """Personalised PageRank for each ``kind``: edges (kind, src, dst, n), seeds (kind, host, weight).

    Weights of a kind are scaled to a sum of 1. A host without links keeps no mass to pass on.
    Rounds end when no rank moves by more than the tolerance. Returns (kind, host, rank).
    """
    total = seeds.groupBy("kind").agg(F.sum("weight").alias("total"))
    base = checkpointed(seeds.join(total, "kind").select("kind", "host", (F.col("weight") / F.col("total") * (1 - damping)).alias("base")))
    out = edges.groupBy("kind", "src").agg(F.sum("n").alias("out"))
    edges = checkpointed(edges.join(out, ["kind", "src"]).select("kind", F.col("src").alias("host"), "dst", (F.col("n") / F.col("out") * damping).alias("part")))
    ranks = base.withColumnRenamed("base", "rank")
    for done in range(1, rounds + 1):
        passed = edges.join(ranks, ["kind", "host"]).select("kind", F.col("dst").alias("host"), (F.col("rank") * F.col("part")).alias("rank"))
        new = passed.unionByName(base.withColumnRenamed("base", "rank")).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        if done % 3 and done < rounds:
            ranks = new
            continue
        new = checkpointed(new)
        moved = new.alias("a").join(ranks.alias("b"), ["kind", "host"], "left").agg(
            F.max(F.abs(F.col("a.rank") - F.coalesce("b.rank", F.lit(0.0)))).alias("most")
        ).first()["most"]
        ranks = new
        if (moved or 0.0) <= tolerance:
            break
    return ranks


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], key: str = "page_id", url: str = "url", html: str = "html", margin: float = 1.0) -> DataFrame:
    """For every page: ``key``, ``host``, ``path``, ``rule``, ``verdict``, ``trust``, ``distrust``.

    Pages that a rule allows make their host a trusted seed, those that a rule blocks a blocked seed,
    by their number. Trust follows the links between hosts, distrust runs against them. A page
    without a rule is blocked when its host's distrust is above ``margin`` times its trust.

    Null urls and those without ``://`` have empty host and path, no rule, and are allowed. Null html
    has no links. Repeated rows are judged alike; an empty table gives none. Other columns are not read.
    """
    host, path = host_path(F.col(url))
    name, says = rule_of(F.col("host"), F.col("path"), rules)
    rows = pages.select(F.col(key).alias("key"), host.alias("host"), path.alias("path"), F.col(html).alias("html"))
    rows = rows.select("key", "host", "path", name.alias("rule"), says.alias("says"), "html")
    judged = rows.drop("html")
    seeds = judged.filter("rule IS NOT NULL AND host <> ''").groupBy(F.col("says").alias("kind"), "host").agg(F.count(F.lit(1)).alias("weight"))
    # Links inside a host say nothing about it, so relative ones are never taken out.
    link = rows.select(F.col("host").alias("src"), F.explode(F.regexp_extract_all("html", F.lit(HREF), F.lit(1))).alias("href"))
    target = host_path(F.when(F.col("href").startswith("//"), F.concat(F.lit("http:"), F.col("href"))).otherwise(F.col("href")))[0]
    links = link.filter("contains(href, '//')").select("src", target.alias("dst")).filter("src <> '' AND dst <> '' AND src <> dst")
    links = links.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))
    both = F.explode(F.array(
        F.struct(F.lit("allow").alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b")),
        F.struct(F.lit("block").alias("kind"), F.col("dst").alias("a"), F.col("src").alias("b")),
    )).alias("e")
    edges = links.select(both, "n").select("e.kind", F.col("e.a").alias("src"), F.col("e.b").alias("dst"), "n")
    ranks = spread_trust(edges, seeds)
    scores = ranks.groupBy(F.col("host").alias("of_host")).agg(
        F.coalesce(F.sum(F.when(F.col("kind") == "allow", F.col("rank"))), F.lit(0.0)).alias("trust"),
        F.coalesce(F.sum(F.when(F.col("kind") == "block", F.col("rank"))), F.lit(0.0)).alias("distrust"),
    )
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    by_graph = F.when(distrust > margin * trust, "block").otherwise("allow")
    return judged.join(scores, F.col("host") == F.col("of_host"), "left").select(
        F.col("key").alias(key), "host", "path", "rule", F.coalesce("says", by_graph).alias("verdict"),
        trust.alias("trust"), distrust.alias("distrust"),
    )
