"""Merkle dataset manifest: a digest of every row, one root of all, and a proof for each row.

Rows of a group (a source) are leaves of a tree of their own, in the order of their ids; the groups' roots are the leaves
of one more tree. Every three nodes that follow each other, or the fewer that a level ends with, have one parent, until
one node is left.

The trees are built by partial parents. A task holds, for each parent it has heard of, the digests of its children by
their place; how many there have to be follows from the tree's size alone. As soon as the last one arrives the parent is
an event itself, for its own parent. What a task can't complete, its frontier, is dealt out by the ancestor STEP levels
up, where the same code completes it. As leaves lie in ranges, a task's frontier is a few nodes at either end of its
range, whatever the size of a group. STEP levels are one round, so a group of 10^12 rows takes four.

Proofs come back the other way: each round's nodes, dealt out by the ancestor they were folded into, take its proof and
put the siblings on the way to it before. A proof is a list of (left, right) digests, level by level, as folded() reads it.

Defined cases: a null field is "-"; null ids come first, and rows that share an id are in the order of their digests. A
null group is a group of its own, before all others. A row that repeats is a leaf each time; equal rows are alike, so
whichever gets a place is the same result. A group of one row is its own root; so is a single group. Texts are hashed whole,
where they are read, and never shuffled. Columns beside the fields are left out unless they are asked for. Empty tables
give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import ready, stage_table
from paperloom.operators.staging import numbered

ARITY = 3
STEP = 7  # levels of a round: 2,187 leaves fold into one node
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Of the groups: up to here they go to the rows, else both are dealt out by group.
BROADCAST_BYTES = 32 << 20
NODE = "tree long, n long, level int, at long, digest string"
PROOF = "array<struct<left:string,right:string>>"


def leaf(fields: list[Column]) -> Column:
    """Digest of a row: each field is its length in bytes, a colon and itself, or "-" where it is null."""
    texts = [c.cast("string") for c in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def folded(digest: Column, proof: Column) -> Column:
    """The root that a digest and a proof lead to."""
    return F.aggregate(proof, digest, lambda up, p: F.sha2(F.concat(p["left"], up, p["right"]), 256))


def siblings(proof: Column) -> Column:
    """All digests of a proof, from left to right, as one text."""
    return F.array_join(F.transform(proof, lambda p: F.concat(p["left"], p["right"])), "")


def parent(digests: list[str]) -> str:
    return sha256("".join(digests).encode()).hexdigest()


def width(n: int, level: int) -> int:
    """Nodes of a level in a tree of n leaves."""
    return -(-n // ARITY**level)


def _ascend(top: int):
    """Nodes (tree, n, level, at, digest) folded up to level top, or to the tree's root; then what is left over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partial: dict[tuple[int, int, int], tuple[int, dict[int, str]]] = {}
        names = ["tree", "n", "level", "at", "digest"]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string())

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [()] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            done = []
            for tree, n, level, at, digest in zip(*[batch.column(c).to_pylist() for c in names], strict=True):
                while True:
                    size = width(n, level)
                    if level == top or size == 1:
                        done.append((tree, n, level, at, digest))
                        break
                    up = at // ARITY
                    key = (tree, level + 1, up)
                    _, children = partial.setdefault(key, (n, {}))
                    children[at - ARITY * up] = digest
                    if len(children) < min(ARITY, size - ARITY * up):
                        break
                    del partial[key]
                    level, at, digest = level + 1, up, parent([children[i] for i in range(len(children))])
            yield batch_of(done)
        left = [(tree, n, level - 1, ARITY * up + i, d) for (tree, level, up), (n, children) in partial.items() for i, d in children.items()]
        for i in range(0, len(left), 10_000):
            yield batch_of(left[i : i + 10_000])

    return run


def _block(level: Column, at: Column, top: int) -> Column:
    """Place, at level top, of the ancestor of a node."""
    return F.call_function("div", at, F.pow(F.lit(float(ARITY)), F.lit(top) - level).cast("long"))


def _rounds(leaves: DataFrame) -> list[DataFrame]:
    """Nodes of every STEP-th level from the leaves on, each with roots reached on the way; the last has roots only."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    out, top = [leaves], 0
    while width(most, top) > 1:
        top += STEP
        nodes = out[-1].select("tree", "n", "level", "at", "digest")
        frontier = nodes.mapInArrow(_ascend(top), NODE)
        dealt = frontier.repartition("tree", _block(F.col("level"), F.col("at"), top))
        out.append(stage_table(dealt.mapInArrow(_ascend(top), NODE), "nodes"))
    return out


#: What _descend adds to the columns that it keeps.
MADE = ("tree", "n", "level", "at", "digest", "block", "top")


def _descend(nodes: pa.Table, ancestors: pa.Table) -> pa.Table:
    """Nodes below one ancestor, all of one level, with their proofs: the siblings up to it, then its own proof."""
    nodes = nodes.sort_by("at")
    count = nodes.num_rows
    row = nodes["digest"].to_pylist()
    steps: list[list[tuple[str, str]]] = []
    if count:
        n, level, top = (nodes[c][0].as_py() for c in ("n", "level", "top"))
        # The first node's place is a multiple of three at every level below the ancestor.
        while level < top and width(n, level) > 1:
            pairs, above = [], []
            for i in range(0, len(row), ARITY):
                run = row[i : i + ARITY]
                pairs += [("".join(run[:j]), "".join(run[j + 1 :])) for j in range(len(run))]
                above.append(parent(run))
            steps.append(pairs)
            row, level = above, level + 1
    suffix = [(p["left"], p["right"]) for p in ancestors["proof"][0].as_py()] if count else []
    subroot = ancestors["subroot"][0].as_py() if count else None
    flat, ends = [], [0]
    for i in range(count):
        flat += [pairs[i // ARITY**k] for k, pairs in enumerate(steps)]
        flat += suffix
        ends.append(len(flat))
    left, right = (pa.array([p[side] for p in flat], pa.string()) for side in (0, 1))
    proofs = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([left, right], names=["left", "right"]))
    keep = [c for c in nodes.column_names if c not in MADE]
    columns = [nodes["tree"], nodes["at"], nodes["digest"], pa.array([subroot] * count, pa.string()), proofs, *[nodes[c] for c in keep]]
    return pa.table(columns, names=["tree", "at", "digest", "subroot", "proof", *keep])


def _proofs(rounds: list[DataFrame], roots: DataFrame) -> DataFrame:
    """tree, at, digest, subroot, proof and the other columns of the first round's rows. roots: tree, subroot, proof."""
    known = roots.select("tree", F.lit(0).cast("long").alias("block"), "subroot", "proof")
    keep = [f for f in rounds[0].schema if f.name not in MADE]
    if len(rounds) == 1:  # every node is a root
        return rounds[0].join(roots, "tree").select("tree", "at", "digest", "subroot", "proof", *[f.name for f in keep])
    for k in range(len(rounds) - 2, -1, -1):
        # Of a round's table, roots reached in an earlier round are nobody's children.
        nodes = rounds[k].filter(F.col("level") == STEP * k)
        nodes = nodes.withColumns({"block": _block(F.col("level"), F.col("at"), STEP * (k + 1)), "top": F.lit(STEP * (k + 1))})
        schema = f"tree long, at long, digest string, subroot string, proof {PROOF}" + "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in ([] if k else keep))
        below = nodes.groupBy("tree", "block").cogroup(known.groupBy("tree", "block")).applyInArrow(_descend, schema)
        if not k:
            return below
        here = stage_table(below, "proofs").select("tree", F.col("at").alias("block"), "subroot", "proof")
        # A tree whose root was reached before has no nodes here, and its one ancestor is still its root.
        known = here.unionByName(known.join(here.select("tree").distinct(), "tree", "left_anti"))
    raise AssertionError


def manifest(
    docs: DataFrame, *, id_col: str = "doc_id", group_col: str = "source", fields: tuple[str, ...] = FIELDS, keep: dict[str, Column] | None = None,
) -> DataFrame:
    """id, group, leaf, subroot, root, proof of every row, and what `keep` names, computed from the rows as they are read."""
    ready(docs.sparkSession)
    kept = [c.alias(name) for name, c in (keep or {}).items()]
    digests = docs.select(
        F.col(id_col).alias("id"), F.col(group_col).alias("grp"), leaf([F.col(c) for c in fields]).alias("digest"), F.struct(F.lit(0).alias("_"), *kept).alias("kept")
    )
    # Equal rows are dealt out too: a number of their own comes last in the order.
    rows = numbered(stage_table(digests, "leaves").withColumn("copy", F.monotonically_increasing_id()), "grp", "id", "digest", "copy")
    groups = numbered(rows.groupBy("grp").agg(F.min("idx").alias("start"), F.count(F.lit(1)).alias("n")), "grp").withColumnRenamed("idx", "tree")
    groups = groups.withColumnRenamed("grp", "of")
    few = (groups.agg(F.sum(F.coalesce(F.octet_length(F.col("of").cast("string")), F.lit(0)) + 64)).first()[0] or 0) <= BROADCAST_BYTES
    at = (F.col("idx") - F.col("start")).alias("at")
    leaves = rows.join(F.broadcast(groups) if few else groups, F.col("grp").eqNullSafe(F.col("of"))).select("tree", "n", F.lit(0).alias("level"), at, "digest", "id", "grp", "kept")
    if not few:
        leaves = stage_table(leaves.repartitionByRange("tree", "at").sortWithinPartitions("tree", "at"), "leaves")
    rounds = _rounds(leaves)
    trees = groups.agg(F.count(F.lit(1))).first()[0]
    tops = _rounds(rounds[-1].select(F.lit(0).cast("long").alias("tree"), F.lit(trees).cast("long").alias("n"), F.lit(0).alias("level"), F.col("tree").alias("at"), "digest"))
    root = tops[-1].select("digest").first()
    root = root[0] if root else None
    of_root = tops[-1].select("tree", F.col("digest").alias("subroot"), F.array().cast(PROOF).alias("proof"))
    subroots = _proofs(tops, of_root).select(F.col("at").alias("tree"), F.col("digest").alias("subroot"), "proof")
    out = _proofs(rounds, stage_table(subroots, "subroots"))
    return out.select(
        F.col("id").alias(id_col), F.col("grp").alias(group_col), F.col("digest").alias("leaf"), "subroot", F.lit(root).cast("string").alias("root"), "proof",
        *[F.col(f"kept.{name}").alias(name) for name in keep or {}],
    )
