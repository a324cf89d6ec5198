"""Evidence that a citation edge means the node it points to: what a node owns against what its citers list."""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.identifiers import bare_id
from paperloom.functions.text import norm_title
from paperloom.operators.graph import KEYS
from paperloom.operators.identity import LEAST_TITLE, exploded
from paperloom.operators.monitor import alive
from paperloom.operators.staging import staged

#: The tags that name a node, by the kind of identifier, and the edges that citations become.
IDENTITY_TAGS = {"s2_id": "s2id:", "pmid": "pmid:"}
REFERENCES = "references"
#: A bit for each kind of key that an item can name a node by.
BITS = {"s2_id": 1, "doi": 2, "pmid": 4, "title": 8}
#: Of the ids of contaminated nodes, or of edges to them, 64 bytes each: up to here they go to the edges, or the lists.
BROADCAST_BYTES = 32 << 20

_NONE = "array<string>"


def _starts(prefix: str, tag: Column) -> Column:
    return tag.startswith(prefix)


def _long_title(c: Column) -> Column:
    title = norm_title(c)
    return F.when(F.length(title) >= LEAST_TITLE, title)


def own_keys(nodes: DataFrame) -> DataFrame:
    """id, kind, key of all that is a node's own: both ids, every identifier of its record and address, its title."""
    r = F.col("metadata.reference")
    dois = F.concat(F.array(r["doi"], r["uri"], F.col("uri")), F.coalesce(r["alt_dois"], F.array().cast(_NONE)))
    keys = [
        ("s2_id", F.nullif(r["s2_id"], F.lit(""))), ("doi", F.transform(dois, bare_id)),
        ("pmid", F.nullif(r["pmid"], F.lit(""))), ("title", _long_title(F.col("title"))),
    ]
    return exploded(nodes, "id", keys).select("id", "kind", "key").distinct()


def cited_keys(nodes: DataFrame) -> DataFrame:
    """id, kind, key of all that a node's citation list names, each once."""
    return _cited(nodes.select("id", "metadata.reference.outbound_citations.items")).distinct()


def _cited(lists: DataFrame) -> DataFrame:
    """id, kind, key of all that lists (id, items) name, as often as they do."""
    i = F.col("i")
    keys = [("s2_id", F.nullif(i["s2_id"], F.lit(""))), ("doi", bare_id(i["doi"])), ("pmid", F.nullif(i["pmid"], F.lit(""))), ("title", _long_title(i["title"]))]
    return exploded(lists.select("id", F.explode("items").alias("i")), "id", keys).select("id", "kind", "key")


def _bit(kind: Column) -> Column:
    bit = F.lit(0)
    for k, b in BITS.items():
        bit = F.when(kind == k, b).otherwise(bit)
    return bit


def identity_tags(nodes: DataFrame) -> DataFrame:
    """id, foreign, kept, ambiguous of nodes whose identity tags are not all their own.

    Where a node knows its own id of a kind, other tags of the kind are foreign. Where it doesn't, several different tags
    are ambiguous: nothing tells which one is its own, so they stay for a person.
    """
    tags = F.coalesce(F.col("tags"), F.array().cast(_NONE))
    reference = F.col("metadata.reference")
    own = {kind: F.nullif(reference[kind], F.lit("")) for kind in IDENTITY_TAGS}
    foreign, ambiguous = F.lit(False), []
    for kind, prefix in IDENTITY_TAGS.items():
        of_kind = F.array_sort(F.array_distinct(F.filter(tags, partial(_starts, prefix))))
        ambiguous.append(F.when(own[kind].isNull() & (F.size(of_kind) > 1), of_kind).otherwise(F.array().cast(_NONE)))

    def is_foreign(t: Column) -> Column:
        hit = foreign
        for kind, prefix in IDENTITY_TAGS.items():
            hit = hit | F.coalesce(t.startswith(prefix) & (t != F.concat(F.lit(prefix), own[kind])), F.lit(False))
        return hit

    out = nodes.select("id", F.filter(tags, is_foreign).alias("foreign"), F.filter(tags, lambda t: ~is_foreign(t)).alias("kept"), F.concat(*ambiguous).alias("ambiguous"))
    return out.filter((F.size("foreign") > 0) | (F.size("ambiguous") > 0))


def edge_evidence(nodes: DataFrame, edges: DataFrame, targets: DataFrame) -> DataFrame:
    """source_id, target_id, kinds of the citation edges into targets (id): the kinds of keys by which the source's list
    names the target, none for a phantom.

    The four tests are alternatives. What a list names by a key of one target only is found by that key, and is an edge's
    evidence if there is such an edge. Keys of several targets, which an edge can't be told by, go along with the edges and
    meet the lists on (source, kind, key). So an edge carries few keys or none, and no key multiplies rows.
    """
    ids = staged(targets.select(F.col("id").alias("target_id")).distinct(), "targets")
    least = F.broadcast if ids.count() * 64 <= BROADCAST_BYTES else (lambda df: df)
    r = F.col("metadata.reference")
    fields = F.struct(F.struct(*[r[c].alias(c) for c in ("doi", "uri", "alt_dois", "s2_id", "pmid")]).alias("reference"))
    held = nodes.select("id", "uri", "title", fields.alias("metadata")).join(least(ids), F.col("id") == F.col("target_id"), "left_semi")
    own = staged(own_keys(held).select(F.col("id").alias("target_id"), _bit(F.col("kind")).alias("bit"), "key"), "own")
    owners = staged(own.groupBy("bit", "key").agg(F.count(F.lit(1)).alias("n"), F.min("target_id").alias("target_id")), "owners")
    several = owners.filter("n > 1").select("bit", "key")
    also = own.join(several, ["bit", "key"]).groupBy("target_id").agg(F.collect_list(F.struct("bit", "key")).alias("also"))
    cites = edges.filter(F.col("relationship") == REFERENCES).select("source_id", "target_id")
    asks = ids.join(also, "target_id", "left")
    asks = F.broadcast(asks) if own.count() * 64 <= BROADCAST_BYTES else asks
    inbound = staged(cites.join(asks, "target_id").select("source_id", "target_id", "also"), "inbound")

    sources = inbound.select(F.col("source_id").alias("id"))
    few = inbound.count() * 64 <= BROADCAST_BYTES
    citing = nodes.select("id", "metadata.reference.outbound_citations.items")
    cited = _cited(citing.join(F.broadcast(sources.distinct()), "id", "left_semi") if few else citing)
    cited = cited.select(F.col("id").alias("source_id"), _bit(F.col("kind")).alias("bit"), "key")
    one = F.col("n") == 1
    named = cited.join(owners, ["bit", "key"]).select("source_id", "bit", F.when(one, F.col("target_id")).alias("target_id"), F.when(~one, F.col("key")).alias("key"))
    named = staged(named, "named")
    asked = inbound.select("source_id", "target_id", F.explode("also").alias("k")).select("source_id", "target_id", "k.bit", "k.key")
    shared = staged(asked.join(named.filter("key is not null").drop("target_id"), ["source_id", "bit", "key"], "left_semi").select("source_id", "target_id", "bit"), "shared")
    edge = inbound.select("source_id", "target_id", F.lit(0).alias("bit"), F.lit(True).alias("edge"))
    hits = named.filter("target_id is not null").select("source_id", "target_id", "bit").unionByName(shared).withColumn("edge", F.lit(False))
    found = edge.unionByName(hits).groupBy("source_id", "target_id").agg(F.bit_or("bit").alias("bits"), F.max("edge").alias("edge")).filter("edge")
    kinds = F.filter(F.array(*[F.when(F.col("bits").bitwiseAND(F.lit(b)) > 0, F.lit(kind)) for kind, b in BITS.items()]), lambda k: k.isNotNull())
    return found.select("source_id", "target_id", kinds.alias("kinds"))


@dataclass(frozen=True)
class Plan:
    """What a decontamination would change; nothing is changed by making it."""

    contaminated: DataFrame  # id, foreign, kept
    ambiguous: DataFrame  # id, tags: for a person
    evidence: DataFrame  # source_id, target_id, kinds of every citation of a contaminated node
    phantom: DataFrame  # source_id, target_id

    def counts(self) -> DataFrame:
        """contaminated, ambiguous, phantom, genuine: one row."""
        one = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
        edges = self.evidence.agg(F.count_if(F.size("kinds") == 0).alias("phantom"), F.count_if(F.size("kinds") > 0).alias("genuine"))
        return one(self.contaminated, "contaminated").join(one(self.ambiguous, "ambiguous"), F.lit(True)).join(edges, F.lit(True))


def plan(nodes: DataFrame, edges: DataFrame) -> Plan:
    """Foreign identity tags of alive nodes, and the citations that only such a tag explains."""
    living = nodes.filter(alive(F.col("status")))
    marked = staged(identity_tags(living), "identity")
    contaminated = marked.filter(F.size("foreign") > 0).select("id", "foreign", "kept")
    evidence = staged(edge_evidence(living, edges, contaminated), "evidence")
    ambiguous = marked.filter(F.size("ambiguous") > 0).select("id", F.col("ambiguous").alias("tags"))
    return Plan(contaminated, ambiguous, evidence, evidence.filter(F.size("kinds") == 0).select("source_id", "target_id"))


def apply(nodes: DataFrame, edges: DataFrame, made: Plan) -> tuple[DataFrame, DataFrame]:
    """(nodes with their own identity tags only, edges without phantoms). A second plan over the result is empty."""
    kept = made.contaminated.select(F.col("id"), F.col("kept").alias("__kept"))
    mended = nodes.join(kept, "id", "left").withColumn("tags", F.coalesce("__kept", "tags")).select(*nodes.columns)
    gone = made.phantom.withColumn("relationship", F.lit(REFERENCES))
    return mended, edges.join(gone, KEYS, "left_anti").select(*edges.columns)
