"""URL filters from path templates with labelled purity.

Per host, paths form a tree of segments. Segments that vary are generalised to wildcards: first by shape
(numbers, hexadecimal ids, file names with digits), then where a branch has more different children than a real
directory would: those whose labelled share does not differ from their siblings' become one wildcard. Children of
smaller branches stand in order of their labelled shares, and neighbours that a two-sided test of two proportions
can't tell apart are merged into one branch. All levels of all hosts are judged in one pass, so any depth will do.

A path's template is its segments as renamed. Its purity is the blocked share of its labelled urls, smoothed towards
that of the same paths on other hosts, where each labelled host has one vote, and that towards the whole table's;
templates above the limit are rejected. Explicit rules come before templates. All of it is DataFrame functions, on
the tree's summed nodes rather than on urls.

Labels: urls that a rule decides are labelled by it; those of hosts named by a seed word, if any are given, are
labelled blocked. A template needs `least` labelled urls, or labelled hosts for its paths, to be rejected.

Defined cases: a null url, or one without ://, has an empty host and path, no rule, and is allowed. Repeated
rows count as often as they stand. Of rules that fit, the longest wins, of equally long ones the last by name. Paths
of any length keep all their segments. Columns of other names, host and path included, are ignored. Empty tables
give empty results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.llm.common import stage_table


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: Rules as (host, start of path, verdict).
RULES = (UrlRule("net", "/", "block"), UrlRule("example.net", "/en/", "allow"), UrlRule("example.com", "/de/", "block"), UrlRule("org", "/fr/", "allow"))

FANOUT = 50  # children of a branch beyond which they are one wildcard
ALIKE = 1.96  # z below which two branches' labelled shares count as the same
PRIOR = 2.0  # urls, or hosts, that the smoothing weighs
PURITY = 0.8
LEAST = 5  # labelled urls, or hosts


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(rest, upper, lower)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple[UrlRule, ...] = RULES) -> tuple[Column, Column]:
    """(name, verdict) of the longest rule that fits; nulls if none does."""
    name = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        name, verdict = F.when(fits, F.lit(r.name)).otherwise(name), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


def shapes(path: Column) -> Column:
    """Segments of a path with those that vary by shape as wildcards."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    return F.transform(
        parts,
        lambda s: F.when(s.rlike(r"^[0-9]+$"), "{n}").when(s.rlike(r"^[0-9a-fA-F-]{8,}$") & s.rlike("[0-9]"), "{id}").when(s.rlike(r"[0-9]"), F.regexp_replace(s, "[0-9]+", "{n}")).otherwise(s),
    )


def _differ(b1: Column, n1: Column, b2: Column, n2: Column, alike: float) -> Column:
    """Whether two labelled shares differ: a pooled test of two proportions. Nothing differs from no labels."""
    pool = F.try_divide(b1 + b2, n1 + n2)
    error = F.sqrt(pool * (1 - pool) * (F.try_divide(F.lit(1.0), n1) + F.try_divide(F.lit(1.0), n2)))
    return F.coalesce(F.abs(F.try_divide(b1, n1) - F.try_divide(b2, n2)) > alike * error, F.lit(False))


def templates(labelled: DataFrame, *, fanout: int = FANOUT, alike: float = ALIKE) -> DataFrame:
    """From host, shape (segments, each pair once), n, good, bad: the same with the template of each."""
    node = ["host", "node"]
    place = F.posexplode("shape").alias("i", "segment")
    # A node is named by a digest of the segments that lead to it.
    rows = labelled.select("host", "shape", "good", "bad", place)
    rows = rows.withColumn("node", F.md5(F.array_join(F.slice("shape", 1, F.col("i")), "/")))
    branch = rows.groupBy(*node, "segment").agg(F.sum("good").alias("g"), F.sum("bad").alias("b"))
    branch = stage_table(branch.withColumn("n", F.col("g") + F.col("b")), "branches")
    whole = branch.groupBy(*node).agg(F.count(F.lit(1)).alias("kids"), F.sum("n").alias("na"), F.sum("b").alias("ba"))
    branch = branch.join(whole, node)
    wide = branch.filter(F.col("kids") > fanout)
    alone = _differ(F.col("b"), F.col("n"), F.col("ba") - F.col("b"), F.col("na") - F.col("n"), alike)
    wide = wide.select(*node, "segment", F.when(alone, F.col("segment")).otherwise("{*}").alias("to"))
    # At most `fanout` children of a node are ordered, whatever its urls are.
    order = Window.partitionBy(*node).orderBy(F.col("b") / F.col("n"), "segment")
    cut = _differ(F.col("b"), F.col("n"), F.lag("b").over(order), F.lag("n").over(order), alike)
    small = branch.filter((F.col("kids") <= fanout) & (F.col("n") > 0)).withColumn("cut", cut.cast("int"))
    small = small.withColumn("part", F.sum("cut").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    parts = Window.partitionBy(*node, "part")
    members = F.array_sort(F.collect_list("segment").over(parts))
    merged = F.when(F.size(members) > 1, F.concat(F.lit("{"), F.array_join(members, "|"), F.lit("}"))).otherwise(F.col("segment"))
    renamed = wide.unionByName(small.select(*node, "segment", merged.alias("to")))
    named = rows.join(renamed, [*node, "segment"], "left").select("host", "shape", F.struct("i", F.coalesce("to", "segment").alias("s")).alias("p"))
    named = named.groupBy("host", "shape").agg(F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["s"]), "/").alias("template"))
    return labelled.join(named, ["host", "shape"], "left").withColumn("template", F.coalesce("template", F.lit("")))


def purity(tree: DataFrame, *, prior: float = PRIOR, limit: float = PURITY, least: int = LEAST) -> DataFrame:
    """host, template, good, bad, purity, rejected: each template's share of blocked urls among the labelled, smoothed."""
    labelled = F.col("good") + F.col("bad")
    good, bad = tree.agg(F.sum("good"), F.sum("bad")).first()
    base = (bad or 0) / ((good or 0) + (bad or 0) or 1)
    votes = tree.filter(labelled > 0).groupBy("shape").agg(F.count(F.lit(1)).alias("hosts"), F.sum(F.col("bad") / labelled).alias("votes"))
    hosts = F.coalesce("hosts", F.lit(0))
    elsewhere = (F.coalesce("votes", F.lit(0.0)) + prior * base) / (hosts + prior)
    rows = tree.join(votes, "shape", "left").select("host", "template", "n", "good", "bad", hosts.alias("hosts"), (F.col("n") * elsewhere).alias("w"))
    by_template = rows.groupBy("host", "template").agg(
        F.sum("good").alias("good"), F.sum("bad").alias("bad"), (F.sum("w") / F.sum("n")).alias("prior"), F.max("hosts").alias("hosts")
    )
    smoothed = (F.col("bad") + prior * F.col("prior")) / (labelled + prior)
    known = (labelled >= least) | (F.col("hosts") >= least)
    return by_template.select("host", "template", "good", "bad", smoothed.alias("purity"), ((smoothed >= limit) & known).alias("rejected"))


def judge(
    urls: DataFrame, *, id_col: str = "page_id", url_col: str = "url", rules: tuple[UrlRule, ...] = RULES, seeds: tuple[str, ...] = (),
    fanout: int = FANOUT, alike: float = ALIKE, prior: float = PRIOR, limit: float = PURITY, least: int = LEAST,
) -> DataFrame:
    """id, host, path, rule, verdict, template, purity of every row. seeds: words in host names that label urls blocked."""
    name, decided = rule_of(F.col("host"), F.col("path"), rules)
    rows = urls.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    rows = rows.withColumns({"rule": name, "decided": decided, "shape": shapes(F.col("path"))})
    named = F.rlike(F.col("host"), F.lit(rf"(^|[.-])({'|'.join(seeds)})($|[.-])")) if seeds else F.lit(False)
    label = F.coalesce("decided", F.when(named, F.lit("block")))
    counts = rows.filter("host <> ''").groupBy("host", "shape").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(label == "allow").alias("good"), F.count_if(label == "block").alias("bad")
    )
    tree = stage_table(templates(stage_table(counts, "shapes"), fanout=fanout, alike=alike), "templates")
    scores = purity(tree, prior=prior, limit=limit, least=least).select("host", "template", "purity", "rejected")
    judged = tree.join(scores, ["host", "template"]).select("host", "shape", "template", "purity", "rejected")
    verdict = F.coalesce("decided", F.when(F.col("rejected"), F.lit("block")).otherwise(F.lit("allow")))
    return rows.join(judged, ["host", "shape"], "left").select(id_col, "host", "path", "rule", verdict.alias("verdict"), "template", "purity")
