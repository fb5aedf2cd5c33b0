"""URL filters by link-graph propagation, in SQL functions only.

Rules name hosts and path prefixes; the longest that fits a url decides. Urls without a rule are
judged by their host: trust spreads from hosts with allowed urls along links (personalised PageRank),
distrust from hosts with blocked urls against the links (the same on the reversed graph). A host
whose distrust exceeds its trust by ``MARGIN`` times the mean of all hosts is blocked.

The graph: a page links to the hosts of its absolute references; a relative reference stays on its
host. The hosts that share a parent domain refer to it and it to them, as subdomains do on their
home pages, so that sites without outside links are tied together too. A seed's weight is the share of
its urls that the rules decide, so a few odd pages do not condemn a host. Only hosts and weighted
edges between them enter the iteration, a join and a sum per step; a host with a third of all links
is one row of a sum. Scores are decimals with 18 places of a billionth, so their sums do not depend
on the order and no edge's part is lost on a large graph; only the scores given out are whole billionths.

Defined cases: a null url or one without ``://`` has an empty host and path, fits no rule and is
allowed; a host never linked has no score and is allowed; repeated pages are judged each for itself;
an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from askloom.llm.common import staged


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = [
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
]
STEPS = 8
STAY = 0.85
MARGIN = 1.5
UNIT = 1_000_000_000
SCORE = "decimal(38,18)"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), URL, 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(found, upper, lower)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), URL, 2)


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """A struct of the longest rule that fits, or null."""
    out = F.lit(None)
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))
        out = F.when(fits, found).otherwise(out)
    return out


def host_edges(pages: DataFrame, html: str = "html") -> DataFrame:
    """``src, dst, n`` between different hosts, from pages with ``host``."""
    refs = F.regexp_extract_all(
        F.coalesce(html, F.lit("")), F.lit("(?i)href\\s*=\\s*[\"']?\\s*([a-z][a-z0-9+.-]*://[^\"'\\s>]+)"), F.lit(1)
    )
    links = pages.select("host", F.explode(refs).alias("ref")).select(
        F.col("host").alias("src"), host_of(F.col("ref")).alias("dst")
    )
    seen = links.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))
    hosts = pages.select("host").where("host <> ''").distinct()
    parent = F.regexp_extract("host", r"^[^.]+\.([^.]+\..+)$", 1)
    family = hosts.select("host", parent.alias("up")).where("up <> ''")
    tied = family.select(F.col("host").alias("src"), F.col("up").alias("dst"), F.lit(1).cast("long").alias("n"))
    back = tied.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    return (
        seen.unionByName(tied).unionByName(back).where("src <> '' AND dst <> '' AND src <> dst")
        .groupBy("src", "dst").agg(F.sum("n").alias("n"))
    )


def propagate(edges: DataFrame, seeds: DataFrame, *, steps: int = STEPS, stay: float = STAY) -> DataFrame:
    """Personalised PageRank ``host, score`` in billionths; ``seeds`` has ``host, weight`` (weights add to about UNIT)."""
    total = edges.groupBy("src").agg(F.sum("n").alias("out"))
    shares = staged(edges.join(total, "src").select("src", "dst", "n", "out"), "shares")
    part = lambda c, by: (F.col(c).cast("double") * by).cast(SCORE).alias("score")
    rank = seeds.select("host", F.col("weight").cast(SCORE).alias("score"))
    home = seeds.select("host", part("weight", 1 - stay))
    for step in range(steps):
        moved = rank.join(shares, rank["host"] == shares["src"]).select(
            F.col("dst").alias("host"), part("score", stay * F.col("n") / F.col("out"))
        )
        rank = moved.unionByName(home).groupBy("host").agg(F.sum("score").cast(SCORE).alias("score"))
        if step % 4 == 3:
            rank = staged(rank, "rank")
    return rank


def seeds_of(pages: DataFrame, verdict: str) -> DataFrame:
    """Hosts by the share of their urls that a rule gives this verdict; the weights add up to about UNIT."""
    ruled = F.count(F.when(F.col("rule.verdict") == verdict, True))
    hosts = staged(
        pages.where("host <> ''").groupBy("host").agg(
            (ruled / F.count(F.lit(1))).cast(SCORE).alias("share")
        ).where("share > 0"),
        "seeds",
    )
    total = float(hosts.agg(F.sum("share")).first()[0] or 1)
    return hosts.select("host", (F.col("share").cast("double") / total * UNIT).cast(SCORE).alias("weight"))


def judge_urls(
    pages: DataFrame, *, rules: list[Rule] = RULES, steps: int = STEPS, stay: float = STAY,
    margin: float = MARGIN, id_col: str = "page_id", url: str = "url", html: str = "html",
) -> DataFrame:
    """``page_id, host, path, rule, verdict, trust, distrust`` for every row."""
    parsed = pages.select(
        id_col, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"), F.col(html).alias("html")
    )
    edges = staged(host_edges(parsed), "edges")
    ruled = staged(
        parsed.select(id_col, "host", "path", rule_of(F.col("host"), F.col("path"), rules).alias("rule")), "ruled"
    )
    backward = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    trust = propagate(edges, seeds_of(ruled, "allow"), steps=steps, stay=stay)
    distrust = propagate(backward, seeds_of(ruled, "block"), steps=steps, stay=stay)
    scores = staged(
        trust.withColumnRenamed("score", "trust")
        .join(distrust.withColumnRenamed("score", "distrust"), "host", "full")
        .select("host", *(F.coalesce(c, F.lit(0).cast(SCORE)).alias(c) for c in ("trust", "distrust"))),
        "scores",
    )
    judged = ruled.join(scores, "host", "left")
    hosts = max(ruled.where("host <> ''").select("host").distinct().count(), 1)
    bad = F.col("distrust") > F.col("trust") + F.lit(margin * UNIT / hosts).cast(SCORE)
    method = F.when(bad, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        id_col, "host", "path", F.col("rule.name").alias("rule"),
        F.coalesce("rule.verdict", method).alias("verdict"),
        *(F.coalesce(F.floor(c).cast("long"), F.lit(0)).cast("long").alias(c) for c in ("trust", "distrust")),
    )
