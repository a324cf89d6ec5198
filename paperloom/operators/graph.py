"""Citation edges: linking, existence, degrees and bounded traversal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.functions.identifiers import bare_id, blank_to_null, is_uuid, node_key, uuid_hex
from paperloom.operators.identity import matches_in_turn, node_keys
from paperloom.operators.staging import staged

KEYS = ["source_id", "target_id", "relationship"]


def new_edges(candidates: DataFrame, existing: DataFrame) -> DataFrame:
    """Candidate edges that are not there yet, each once, without edges from a node to itself."""
    fresh = candidates.filter("source_id <> target_id").select(*KEYS).distinct()
    return fresh.join(existing.select(*KEYS), KEYS, "left_anti")


def node_names(nodes: DataFrame) -> DataFrame:
    """name, node: every name that a node goes by (id, uuid with or without dashes, slug), and the one it is indexed by."""
    key = node_key(F.col("id"), F.col("uuid"), F.col("slug"))
    every = F.array(blank_to_null(F.col("id")), uuid_hex(F.col("uuid")), blank_to_null(F.col("slug")))
    names = nodes.select(key.alias("node"), F.explode(F.array_distinct(every)).alias("name")).filter("name is not null and name <> ''")
    return names.groupBy("name").agg(F.min("node").alias("node"))


def by_node(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """edges whose ends are the names that nodes are indexed by, whichever of their names they came with; names of no node
    stay. An edge from a node to itself shows as one only then."""
    names = node_names(nodes)
    one = lambda c: F.when(is_uuid(F.col(c)), uuid_hex(F.col(c))).otherwise(F.col(c))
    out = edges.withColumns({"__s": one("source_id"), "__t": one("target_id")})
    for end, column in (("__s", "source_id"), ("__t", "target_id")):
        known = names.select(F.col("name").alias(end), F.col("node").alias("__node"))
        out = out.join(known, end, "left").withColumn(column, F.coalesce("__node", column)).drop("__node", end)
    return out.select(*edges.columns)


def existing_edges(candidates: DataFrame, existing: DataFrame) -> DataFrame:
    return candidates.select(*KEYS).distinct().join(existing.select(*KEYS), KEYS, "left_semi")


def link_counts(items: DataFrame, targets: DataFrame) -> DataFrame:
    """source_id, linked, skipped: items (source_id, key) against targets (key, target_id); misses and self skip."""
    found = items.join(targets, "key", "left")
    ok = F.col("target_id").isNotNull() & (F.col("target_id") != F.col("source_id"))
    return found.groupBy("source_id").agg(F.count_if(ok).alias("linked"), F.count_if(~ok).alias("skipped"))


def link_reverse(pending: DataFrame, created: DataFrame) -> DataFrame:
    """target_id, n_sources: distinct citers that wait for a newly created node; itself is left out."""
    hits = pending.join(created, "key").filter("source_id <> target_id")
    return hits.select("source_id", "target_id").distinct().groupBy("target_id").agg(F.count(F.lit(1)).alias("n_sources"))


def forward_links(items: DataFrame, index: DataFrame, existing: DataFrame, *, relationship: str = "references") -> tuple[DataFrame, DataFrame]:
    """(edges that are new; source_id, linked, skipped) of cited items against a key index.

    items: source_id, pos and the columns s2_id, doi, pmid, title of one cited work each; index: kind, prio, key, node_id
    of identity.key_index. The key asked first wins. An item without a match, or that is the source itself, is skipped;
    one whose edge is there already counts as linked.
    """
    rows = items.withColumn("__item", F.struct("source_id", "pos"))
    found = matches_in_turn(rows, index, "__item", node_keys())
    matched = staged(found.select("__item.source_id", F.col("match_id").cast("string").alias("target_id")), "matched")
    ok = F.col("target_id").isNotNull() & (F.col("target_id") != F.col("source_id").cast("string"))
    counts = matched.groupBy("source_id").agg(F.count_if(ok).alias("linked"), F.count_if(~ok).alias("skipped"))
    made = matched.filter(ok).select("source_id", "target_id", F.lit(relationship).alias("relationship"))
    return new_edges(made, existing), counts


def reverse_links(pending: DataFrame, created: DataFrame, existing: DataFrame, *, relationship: str = "references") -> tuple[DataFrame, DataFrame]:
    """(edges that are new; target_id, created) from those that cite an identifier to the new node that has it.

    pending: source_id, doi; created: node_id, doi. Only identifiers match; a node that waits for itself is left out, and
    a pair that waits twice, or is linked already, counts as often as it waits.
    """
    key = lambda df: df.withColumn("key", bare_id(F.col("doi"))).filter("key is not null")
    hits = key(pending).select("source_id", "key").join(key(created).select(F.col("node_id").alias("target_id"), "key"), "key").filter("source_id <> target_id")
    counts = hits.groupBy("target_id").agg(F.count(F.lit(1)).alias("created"))
    return new_edges(hits.select("source_id", "target_id", F.lit(relationship).alias("relationship")), existing), counts


def first_edges(edges: DataFrame, order: str) -> DataFrame:
    """One edge for each key (source, target, relationship): the first in an order, by partial aggregates."""
    rest = [c for c in edges.columns if c not in KEYS]
    return edges.groupBy(*KEYS).agg(F.min_by(F.struct(*rest), order).alias("__r")).select(*KEYS, "__r.*")


def edge_counts(edges: DataFrame, id_col: str) -> DataFrame:
    """n_ids, n_keys: different edge ids, and different edges."""
    ids = edges.select(id_col).distinct().agg(F.count(F.lit(1)).alias("n_ids"))
    return ids.join(edges.select(*KEYS).distinct().agg(F.count(F.lit(1)).alias("n_keys")), F.lit(True))


def phantom_counts(phantoms: DataFrame) -> DataFrame:
    """target_id, n of phantom edges, the most first."""
    return phantoms.groupBy("target_id").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "target_id")


def by_key(edges: DataFrame) -> DataFrame:
    return edges.orderBy(*KEYS)


def incident(edges: DataFrame) -> DataFrame:
    """node, source_id, target_id: every edge at its source and at its target, an edge to itself once."""
    ends = F.when(F.col("source_id") != F.col("target_id"), F.array("source_id", "target_id")).otherwise(F.array("source_id"))
    return edges.select(F.explode(ends).alias("node"), "source_id", "target_id")


def degrees(edges: DataFrame) -> DataFrame:
    """node, n_out, n_in over distinct edges, summed before the shuffle."""
    e = edges.select("source_id", "target_id").distinct()
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    ends = e.select(F.col("source_id").alias("node"), one.alias("o"), none.alias("i")).unionByName(e.select(F.col("target_id").alias("node"), none.alias("o"), one.alias("i")))
    return ends.groupBy("node").agg(F.sum("o").alias("n_out"), F.sum("i").alias("n_in"))


def phantom_edges(claimed: DataFrame, genuine: list[DataFrame]) -> DataFrame:
    """Claimed (source_id, target_id) pairs that no kind of evidence supports.

    The kinds are alternatives; as one exploded equi-join key they stay hash joins where an OR would not.
    """
    known = genuine[0]
    for g in genuine[1:]:
        known = known.unionByName(g)
    return claimed.select("source_id", "target_id").distinct().join(known.select("source_id", "target_id"), ["source_id", "target_id"], "left_anti")


#: Hops up to which a walk scans the edges as they are; for more, their steps are written once, each in its place.
SCANS = 3
#: Nodes of a frontier, counted, that go to the edges instead of being dealt out with them.
FEW = 100_000


def _steps(edges: DataFrame, direction: str, relationship: str | None, depth: int) -> DataFrame:
    """a, b of every step; of a long walk each once, written so that hops read it as it is."""
    if relationship is not None:
        edges = edges.filter(F.col("relationship") == relationship)
    out = edges.select(F.col("source_id").alias("a"), F.col("target_id").alias("b"))
    back = edges.select(F.col("target_id").alias("a"), F.col("source_id").alias("b"))
    steps = {"out": out, "in": back, "both": out.unionByName(back)}[direction]
    return steps if depth <= SCANS else staged(steps.distinct(), "steps")


def _near(frontier: DataFrame) -> DataFrame:
    return F.broadcast(frontier) if frontier.count() <= FEW else frontier


#: Fixed value: the relationship that holds nodes in their parents.
PARENT = "parent"


def k_hop(edges: DataFrame, seed: str, depth: int, direction: str = "both", *, mode: str = "edges", relationship: str | None = None) -> DataFrame:
    """node, hop of what is within `depth` steps of the seed.

    In mode "hierarchy" only parent edges are walked ("out" to parents, "in" to children). Each hop is a join with the
    frontier and an anti-join with what was visited, written to the shared folder, so the plan doesn't grow with the
    depth; an empty frontier ends the walk.
    """
    if mode not in ("edges", "hierarchy"):
        raise ValueError(f"unknown mode: {mode}")
    steps = _steps(edges, direction, PARENT if mode == "hierarchy" else relationship, depth)
    seen = frontier = edges.sparkSession.createDataFrame([(seed, 0)], "node string, hop int")
    for hop in range(1, depth + 1):
        reached = steps.join(_near(frontier.select("node")), F.col("node") == F.col("a")).select(F.col("b").alias("node")).distinct()
        frontier = staged(reached.join(seen.select("node"), "node", "left_anti").withColumn("hop", F.lit(hop)))
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier)
    return seen


def shortest_path(edges: DataFrame, start: str, goal: str, depth: int, *, direction: str = "both", relationship: str | None = None) -> DataFrame:
    """One row (start, goal, hops, path) of the shortest path, or none within `depth`.

    Each reached node keeps its smallest predecessor, so the path is the same in every run.
    """
    steps = _steps(edges, direction, relationship, depth)
    seen = frontier = edges.sparkSession.createDataFrame([(start, [start])], "node string, path array<string>")
    for hop in range(depth + 1):
        hit = seen.filter(F.col("node") == goal)
        if not hit.isEmpty() or hop == depth or frontier.isEmpty():
            return hit.select(F.lit(start).alias("start"), F.lit(goal).alias("goal"), (F.size("path") - 1).cast("long").alias("hops"), "path")
        moved = steps.join(_near(frontier), F.col("node") == F.col("a")).groupBy("b").agg(F.min("path").alias("path"))
        moved = moved.select(F.col("b").alias("node"), F.concat("path", F.array("b")).alias("path"))
        frontier = staged(moved.join(seen.select("node"), "node", "left_anti"))
        seen = seen.unionByName(frontier)
    return seen.limit(0)
