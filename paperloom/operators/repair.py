"""Repair analytics: contaminated tags, cross-wired citations, decisions and their plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.text import bidir_similarity, token_overlap

#: A title's overlap with its citation below which they may not belong together, and the similarity
#: of two titles below which they are different works.
MAX_OVERLAP, MAX_SIMILARITY = 0.40, 0.45


def foreign_tags(tags: Column, prefix: str, own: Column) -> Column:
    """Tags of an identity namespace that are not the node's own, where its own is known."""
    mine = F.filter(tags, lambda t: t.startswith(prefix) & (t != F.concat(F.lit(prefix), own)))
    return F.when(own.isNotNull(), mine).otherwise(F.array().cast("array<string>"))


def is_ambiguous(tags: Column, prefix: str, own: Column) -> Column:
    """Own value unknown, and more than one distinct tag of the namespace."""
    return own.isNull() & (F.size(F.array_distinct(F.filter(tags, lambda t: t.startswith(prefix)))) > 1)


def is_candidate(title: Column, citation: Column) -> Column:
    return F.coalesce(token_overlap(title, citation) < MAX_OVERLAP, F.lit(False))


def decision(stored: Column, resolved: Column) -> Column:
    """MANUAL without a resolved title, REMOVE if the titles differ, else KEEP."""
    differ = F.coalesce(bidir_similarity(stored, resolved) < MAX_SIMILARITY, F.lit(False))
    return F.when(resolved.isNull(), "MANUAL").when(differ, "REMOVE").otherwise("KEEP")


def apply_plan(edges: DataFrame, nodes: DataFrame, bad: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges without those at bad nodes, nodes with the bad ones marked deleted). bad: node ids."""
    ids = bad.select(F.col("id").alias("__bad")).distinct()
    kept = edges.join(ids, F.col("source_id") == F.col("__bad"), "left_anti").join(ids, F.col("target_id") == F.col("__bad"), "left_anti")
    marked = nodes.join(ids, F.col("id") == F.col("__bad"), "left")
    return kept, marked.withColumn("status", F.when(F.col("__bad").isNotNull(), "deleted").otherwise(F.col("status"))).drop("__bad")
