"""URL filter: rules by host and path, and trust that spreads along links where no rule fits.

Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased. Path: from there up
to ``?``, ``#`` or the end. A rule names a host and the beginning of a path; it fits its host and all subdomains,
and the longest rule that fits decides.

Where none fits, the host decides. Hosts are linked by the absolute links in their pages (one edge for each pair of
hosts, weighted by the number of pages). A host most of whose pages the rules allow is a trusted seed, one most of
whose pages they block a blocked seed. Trust is a personalised PageRank from the trusted seeds along the links;
distrust is one from the blocked seeds against them, so that who links to blocked hosts is distrusted. A host is
blocked if its distrust exceeds its trust by ``margin`` of both. Each host's links are summed before anything is
shuffled by host, every step is written to the shared folder, and nothing about hosts is collected.

Defined results: a null URL and one without ``://`` have an empty host and path; they fit no rule, and as nothing
speaks against an empty host, they are allowed. So is a host that neither trust nor distrust reaches. Pages without
HTML have no links. Links to the host itself do not count. Rows are judged one by one; result columns replace
input columns of the same name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.llm.arrays import without
from recordloom.session import new_work_dir, written

#: Share of the seeds' mass that ranks may still move by when they are taken as settled: 57 links reach so far.
TOLERANCE = 1e-4
RESULT = ("host", "path", "rule", "verdict")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINK = r"""(?i)<(?:a|area|link|iframe|form)\b[^>]*?\b(?:href|src|action)\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^\s"'<>]+)"""


@dataclass(frozen=True)
class Rule:
    """Allow or block a host with its subdomains, where the path begins with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """Host of a URL, empty if there is none."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """Path of a URL, empty if there is none."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else null."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        name, verdict = F.when(fits, rule.name).otherwise(name), F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def host_links(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """source, target, weight: for each pair of hosts, the pages of one that link to the other."""
    found = F.array_distinct(F.transform(F.regexp_extract_all(F.col(html_column), F.lit(_LINK), 1), lambda u: host_of(F.concat(F.lit("x:"), F.regexp_replace(u, r"^[A-Za-z][A-Za-z0-9+.-]*:", "")))))
    links = pages.select(F.col("host").alias("source"), F.explode(found).alias("target"))
    links = links.where("source != target AND source != '' AND target != ''")
    return links.groupBy("source", "target").agg(F.count(F.lit(1)).alias("weight"))


def page_rank(edges: DataFrame, seeds: DataFrame, *, follow: float, tolerance: float = TOLERANCE, steps: int | None = None) -> DataFrame:
    """Personalised PageRank: host, rank. ``edges``: source, target, share (shares of a source sum to 1);
    ``seeds``: host, seed (the mass each keeps giving). Mass that reaches a host without links is lost.

    Ends when a step changes the ranks by no more than ``tolerance`` of the seeds' mass, summed over all hosts, or
    after ``steps`` if given.
    """
    spark = edges.sparkSession
    rank = seeds.select("host", F.col("seed").alias("rank"))
    mass = seeds.agg(F.sum("seed").alias("mass")).first().mass or 0.0
    home = seeds.select("host", (F.col("seed") * (1 - follow)).alias("rank"), F.lit(0.0).alias("before"))
    done = 0
    while mass and (steps is None or done < steps):
        moved = edges.join(rank, edges["source"] == rank["host"]).select(F.col("target").alias("host"), (F.col("share") * F.col("rank") * follow).alias("rank"), F.lit(0.0).alias("before"))
        gone = rank.select("host", F.lit(0.0).alias("rank"), F.col("rank").alias("before"))
        new = moved.union(home).union(gone).groupBy("host").agg(F.sum("rank").alias("rank"), F.sum("before").alias("before"))
        new = written(new, new_work_dir(spark, "rank"))
        rank = new.where("rank > 0").select("host", "rank")
        done += 1
        if (new.agg(F.sum(F.abs(F.col("rank") - F.col("before"))).alias("change")).first().change or 0.0) <= tolerance * mass:
            break
    return rank


def _shares(links: DataFrame, source: str, target: str) -> DataFrame:
    total = links.groupBy(source).agg(F.sum("weight").alias("total"))
    return links.join(total, source).select(F.col(source).alias("source"), F.col(target).alias("target"), (F.col("weight") / F.col("total")).alias("share"))


def host_verdicts(
    judged: DataFrame, *, html_column: str = "html", follow: float = 0.85, margin: float = 0.5, tolerance: float = TOLERANCE
) -> DataFrame:
    """host, trust, distrust, host_verdict of every host; ``judged`` has host, rule_verdict and the HTML."""
    spark = judged.sparkSession
    links = written(host_links(judged, html_column), new_work_dir(spark, "links"))
    share = lambda v: F.avg((F.coalesce("rule_verdict", F.lit("")) == v).cast("double"))
    hosts = judged.groupBy("host").agg(share("allow").alias("allowed"), share("block").alias("blocked"))
    hosts = written(hosts, new_work_dir(spark, "hosts"))
    count = max(1, hosts.count())
    ranks = {}
    for name, column, ends in (("trust", "allowed", ("source", "target")), ("distrust", "blocked", ("target", "source"))):
        # each seed starts with one share of as many as there are hosts, so that trust and distrust compare
        seeds = hosts.where((F.col(column) > 0.5) & (F.col("host") != "")).select("host", F.lit(1 / count).alias("seed"))
        edges = written(_shares(links, *ends), new_work_dir(spark, "edges"))
        ranks[name] = page_rank(edges, seeds, follow=follow, tolerance=tolerance).select("host", F.col("rank").alias(name))
    both = hosts.select("host").join(ranks["trust"], "host", "left").join(ranks["distrust"], "host", "left").na.fill(0.0, ["trust", "distrust"])
    bad = F.col("distrust") - F.col("trust") > margin * (F.col("distrust") + F.col("trust"))
    return both.withColumn("host_verdict", F.when(bad & (F.col("distrust") > 0), "block").otherwise("allow"))


def judge(
    pages: DataFrame, rules: list[Rule], *, url_column: str = "url", html_column: str = "html", keep: list[str] | None = None, **options
) -> DataFrame:
    """Add host, path, rule (null if none fits) and verdict (allow or block) to every page."""
    pages = without(pages, [*RESULT, "rule_verdict", "host_verdict"])
    names = [c for c in pages.columns if keep is None or c in keep]
    url = F.col(f"`{url_column}`")
    name, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    located = pages.withColumns({"host": host_of(url), "path": path_of(url)})
    ruled = located.withColumns({"rule": name, "rule_verdict": verdict})
    hosts = host_verdicts(ruled.select("host", "rule_verdict", F.col(f"`{html_column}`").alias("html")), **options)
    joined = ruled.select(*names, "host", "path", "rule", "rule_verdict").join(hosts.select("host", "host_verdict"), "host", "left")
    return joined.select(*[F.col(f"`{c}`") for c in names], "host", "path", "rule", F.coalesce("rule_verdict", "host_verdict").alias("verdict"))
