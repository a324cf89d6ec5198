"""Exact top-k inner products by norm-bucketed retrieval.

Candidates are range-partitioned by length, so a chunk holds vectors of like length, and a chunk is cut into
buckets of falling length. Every query first meets the longest chunk, which gives it a threshold: its k-th best
score so far. It then goes only to chunks whose longest vector could reach that threshold, and a chunk only to
blocks of queries that it can matter to. For each query and bucket the local cosine threshold, that is the score
threshold over the product of the lengths, picks how the bucket is pruned: over 1, the bucket is skipped; high, the
coordinates with the largest query entries must lie in the interval which that cosine allows; low, a prefix of the
bucket by length stays. What is left is verified by its inner product, and a final window keeps the k best of the
chunks' bests.

Defined cases: a vector that is null, or has a null or non-finite component, takes no part. Vectors meet only
vectors of their own dimension. Rows that repeat an id are candidates each, and a query id that repeats takes
the best pairs of all its rows; a row meets none of its own id. Ties go to the smaller id; rows of one id and score
are alike. With fewer than k candidates all are returned. Scores are exact 64-bit integers; a score beyond their range
is held at its end. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.llm.common import ready, stage_table
from paperloom.operators.staging import numbered

BUCKET = 1024  # vectors of a bucket: its matrix stays in a core's cache
CHUNK_ROWS = 8192  # candidates of a task, at least
CHUNKS = 50_000  # at most, so that what is known of each chunk stays small; larger tables have larger chunks
QUERY_ROWS = 4096  # queries of a task
COSINE = 0.6  # from this local threshold on, coordinates prune better than length
FOCUS = 5  # coordinates that are tested
SLACK = 1e-9  # of the bounds, for their rounding


def quantize(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of each component as long; null for a vector that takes no part."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(vector.isNotNull() & whole, F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")))


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim) if len(column) else np.zeros((0, dim), np.int64)


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact products of integer rows: by floats where those are exact, else by Python's integers."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, q.shape[1])
    if top < 2**53:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    exact = q.astype(object) @ c.astype(object).T
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def best_of(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int, least: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """(query row, candidate id, score) of the k best candidates of each query; candidates with its own id don't count,
    nor do scores below a query's `least`."""
    norm = lambda x: np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
    qn, cn = norm(q), norm(c)
    order = np.argsort(-cn, kind="stable")
    cid, c, cn = cid[order], c[order], cn[order]
    theta = np.full(len(q), -np.inf) if least is None else least.astype(np.float64)  # the k-th best so far
    top = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    focus = np.argsort(-np.abs(q), axis=1, kind="stable")[:, :FOCUS]
    for b in range(0, len(c), BUCKET):
        ids, vs, ns = cid[b : b + BUCKET], c[b : b + BUCKET], cn[b : b + BUCKET]
        reach = qn * ns[0]
        with np.errstate(divide="ignore", invalid="ignore"):
            cosine = np.where(reach > 0, theta / reach, np.where(theta > 0, np.inf, -np.inf))
        live = cosine <= 1 + SLACK
        by_coordinate = live & (cosine >= COSINE)
        by_length = np.flatnonzero(live & ~by_coordinate)
        rows, cols, scores = [], [], []
        if len(by_length):
            # Lengths fall: for each query the bucket's prefix that can reach its threshold; verified up to the longest one.
            with np.errstate(divide="ignore", invalid="ignore"):
                least = np.where(qn[by_length] > 0, theta[by_length] / qn[by_length], -np.inf)
            prefix = np.searchsorted(-ns, -(least * (1 - SLACK)) + SLACK, side="right")
            n = int(prefix.max(initial=0))
            s = _products(q[by_length], vs[:n])
            r, j = np.nonzero(s >= theta[by_length, None])
            rows, cols, scores = [by_length[r]], [j], [s[r, j]]
        if by_coordinate.any():
            unit = vs / np.maximum(ns, 1e-300)[:, None]
            for i in np.flatnonzero(by_coordinate):
                cut = min(1.0, cosine[i]) - SLACK
                stay = np.ones(len(vs), bool)
                for f in focus[i]:
                    # With cos >= t, a unit vector's coordinate lies within x*t ± sqrt((1-x²)(1-t²)) of the query's x, or beyond on its side.
                    x = q[i, f] / qn[i]
                    wide = np.sqrt(max(0.0, 1 - x * x) * max(0.0, 1 - cut * cut)) + SLACK
                    low, high = x * cut - wide, x * cut + wide
                    if x > 0 and x >= cut:
                        high = np.inf
                    if x < 0 and -x >= cut:
                        low = -np.inf
                    stay &= (unit[:, f] >= low) & (unit[:, f] <= high)
                j = np.flatnonzero(stay)
                s = _products(q[i : i + 1], vs[j])[0]
                good = s >= theta[i]
                rows.append(np.full(int(good.sum()), i))
                cols.append(j[good])
                scores.append(s[good])
        if not rows:
            continue
        row, col, score = np.concatenate(rows), np.concatenate(cols), np.concatenate(scores)
        other = ids[col] != qid[row]
        merged = [np.concatenate(x) for x in zip(top, (row[other], ids[col[other]], score[other]), strict=True)]
        o = np.lexsort((merged[1], -merged[2], merged[0]))
        r = merged[0][o]
        rank = np.arange(len(r)) - np.searchsorted(r, r, side="left")
        last = o[rank == k - 1]
        theta[merged[0][last]] = np.maximum(theta[merged[0][last]], merged[2][last])
        top = tuple(x[o[rank < k]] for x in merged)
    return top


def top_k(
    vectors: DataFrame, *, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
    chunk_rows: int = CHUNK_ROWS, query_rows: int = QUERY_ROWS, scale: int = 64,
) -> DataFrame:
    """The k best candidates of each row whose id is divisible by `every`: query_id, rank, vec_id, score.

    Rows of a task: one chunk of candidates and one block of queries. Blocks are made of queries with like needs, so
    that a chunk which a query can't use seldom travels to it. No row meets a task that another pair of chunk and block
    makes.
    """
    spark = vectors.sparkSession
    ready(spark)
    v = quantize(F.col(vector_col), scale)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).filter("id is not null and v is not null")
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    rows = stage_table(rows.select("id", "v", length.alias("len"), F.size("v").alias("dim"), F.monotonically_increasing_id().alias("row")), "vectors")
    many = rows.count()
    size, blocks = max(chunk_rows, many // CHUNKS), max(1, -(-(many // every + 1) // query_rows))
    # The id breaks ties, so that vectors of one length still spread over chunks.
    ranged = numbered(rows.select("id", "v", "dim", "len"), "dim", F.desc("len"), "id")
    ranged = stage_table(ranged.withColumn("chunk", F.floor(F.col("idx") / size).cast("int")).drop("idx"), "chunks")
    reach = ranged.groupBy("dim", "chunk").agg(F.max("len").alias("top"))
    # One array a dimension: the chunks by number, which is by falling length.
    known = stage_table(reach.groupBy("dim").agg(F.array_sort(F.collect_list(F.struct("chunk", "top"))).alias("chunks")), "reach")
    first = F.get("chunks", F.lit(0))["chunk"]
    asked = rows.filter(F.pmod("id", F.lit(every)) == 0)

    def meet(q: pa.Table, c: pa.Table) -> pa.Table:
        r, ids, s = (np.zeros(0, np.int64),) * 3
        if len(q) and len(c):
            dim = q["dim"][0].as_py()
            qid, least = q["id"].to_numpy(), q["least"].to_numpy()
            r, ids, s = best_of(qid, _matrix(q["v"], dim), c["id"].to_numpy(), _matrix(c["v"], dim), k, least)
        got = (q["id"].to_numpy()[r], q["row"].to_numpy()[r], ids, s) if len(r) else (r, r, ids, s)
        return pa.table({n: pa.array(x, pa.int64()) for n, x in zip(("query_id", "row", "vec_id", "score"), got, strict=True)})

    def found(queries: DataFrame) -> DataFrame:
        """Bests of queries (id, row, v, dim, least, chunk, block), by chunk."""
        pairs = queries.groupBy("dim", "chunk").agg(F.collect_set("block").alias("blocks"))
        right = ranged.select("id", "v", "dim", "chunk").join(pairs, ["dim", "chunk"]).withColumn("block", F.explode("blocks")).drop("blocks")
        left = queries.groupBy("dim", "chunk", "block")
        return left.cogroup(right.groupBy("dim", "chunk", "block")).applyInArrow(meet, "query_id long, row long, vec_id long, score long")

    any_block = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    start = asked.join(known, "dim").select("id", "row", "v", "dim", F.lit(float("-inf")).alias("least"), first.alias("chunk"), any_block.alias("block"))
    begun = stage_table(found(start), "begun")
    least = begun.groupBy("row").agg(F.min("score").cast("double").alias("least"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= k).drop("n")
    need = F.coalesce("least", F.lit(float("-inf")))
    # |q| * |c| has to reach the threshold; a vector of length 0 reaches 0 with any.
    able = lambda c: F.col("len") * c["top"] * (1 + SLACK) + SLACK >= need
    on = F.transform(F.filter("chunks", lambda c: (c["chunk"] > first) & able(c)), lambda c: c["chunk"])
    rest = asked.join(known, "dim").join(least, "row", "left").select("id", "row", "v", "dim", need.alias("least"), on.alias("on"))
    rest = numbered(rest.filter(F.size("on") > 0), F.size("on"), "row")
    rest = stage_table(rest.withColumn("block", F.floor(F.col("idx") / query_rows).cast("int")).drop("idx"), "asked")
    more = found(rest.withColumn("chunk", F.explode("on")).drop("on"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    both = begun.unionByName(more).select("query_id", "vec_id", "score")
    return both.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def brute_force(pdf: pd.DataFrame, k: int = 20, every: int = 20, scale: int = 64) -> list[tuple[int, int, int, int]]:
    """The same by comparing every pair, for tests."""
    rows: list[tuple[int, list[int]]] = []
    for i, v in zip(pdf["vec_id"], pdf["embedding"], strict=True):
        if v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        rows.append((int(i), [int(np.floor(scale * float(x))) for x in v]))
    out = []
    for i in {i for i, _ in rows if i % every == 0}:
        asked = [q for j, q in rows if j == i]
        scored = sorted((-sum(a * b for a, b in zip(q, c, strict=True)), j) for q in asked for j, c in rows if j != i and len(c) == len(q))
        out += [(i, r, j, -s) for r, (s, j) in enumerate(scored[:k], 1)]
    return out
