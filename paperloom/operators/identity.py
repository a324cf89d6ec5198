"""Key index, prioritised multi-key match, and deduplication within a batch."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from paperloom.functions.identifiers import bare_id, blank_to_null, node_key
from paperloom.functions.text import norm_title
from paperloom.operators.staging import staged
from paperloom.session import workers

#: Kinds of keys in the order they are asked, and the least length of a title that counts.
KINDS = ("s2_id", "doi", "pmid", "title")
LEAST_TITLE = 10


def exploded(rows: DataFrame, id_col: str, keys: list[tuple[str, Column]]) -> DataFrame:
    """id, kind, prio, key of every key that is not null, in one pass over the rows. A column of lists is several keys of
    its kind; a kind that comes again keeps the place of its first."""
    shapes = rows.select(*[key.alias(f"k{n}") for n, (_, key) in enumerate(keys)]).schema
    place = {kind: p for p, kind in enumerate(dict.fromkeys(kind for kind, _ in keys))}
    one = lambda kind, key: F.struct(F.lit(kind).alias("kind"), F.lit(place[kind]).alias("prio"), key.alias("key"))
    lists = [
        F.transform(F.coalesce(key, F.array().cast(field.dataType)), partial(one, kind)) if isinstance(field.dataType, ArrayType) else F.array(one(kind, key))
        for field, (kind, key) in zip(shapes, keys, strict=True)
    ]
    found = F.explode(F.filter(F.concat(*lists), lambda s: s["key"].isNotNull()))
    return rows.select(F.col(id_col).alias("id"), found.alias("k")).select("id", "k.kind", "k.prio", "k.key")


def key_index(rows: DataFrame, id_col: str, keys: list[tuple[str, Column]], *, order: str | None = None) -> DataFrame:
    """kind, prio, key and the first node that carries it, in an order of the rows (else by id); summed before the shuffle."""
    if order is None:
        return exploded(rows, id_col, keys).groupBy("kind", "prio", "key").agg(F.min("id").alias("node_id"))
    both = rows.withColumn("__of", F.struct(F.col(order).alias("at"), F.col(id_col).alias("id")))
    return exploded(both, "__of", keys).groupBy("kind", "prio", "key").agg(F.min("id")["id"].alias("node_id"))


def stored_keys() -> list[tuple[str, Column]]:
    """Keys of nodes as they are stored: ids from identity tags, every identifier of address and record, any title."""
    r, tags = F.col("metadata.reference"), F.coalesce(F.col("tags"), F.array().cast("array<string>"))
    tagged = lambda p: F.transform(F.filter(tags, lambda t: t.startswith(p)), lambda t: blank_to_null(F.substring(t, len(p) + 1, 1 << 20)))
    dois = F.concat(F.array(F.col("uri"), r["uri"], r["doi"]), F.coalesce(r["alt_dois"], F.array().cast("array<string>")))
    return [
        ("s2_id", tagged("s2id:")), ("doi", F.transform(dois, bare_id)), ("pmid", tagged("pmid:")),
        ("title", F.nullif(norm_title(F.col("title")), F.lit(""))),
    ]


def node_index(nodes: DataFrame, order: str | None = None) -> DataFrame:
    """kind, prio, key, node_id of stored nodes; of several nodes with a key the first in the scan's order has it."""
    named = nodes.withColumn("__id", node_key(F.col("id"), F.col("uuid"), F.col("slug"))).filter("__id is not null")
    return key_index(named, "__id", stored_keys(), order=order)


def node_key_rows(nodes: DataFrame) -> DataFrame:
    """id, kind, prio, key of every key of stored nodes: what first_of() makes node_index() of, to be kept node by node."""
    return exploded(nodes.withColumn("__id", node_key(F.col("id"), F.col("uuid"), F.col("slug"))).filter("__id is not null"), "__id", stored_keys())


def first_of(keys: DataFrame) -> DataFrame:
    """node_index(), in the order of ids, of the nodes' keys."""
    return keys.groupBy("kind", "prio", "key").agg(F.min("id").alias("node_id"))


def priority_match(incoming: DataFrame, index: DataFrame, id_col: str, keys: list[tuple[str, Column]]) -> DataFrame:
    """id, match_id, reason of every incoming row that some key finds; the key asked first wins.

    One equi-join on (kind, key) and one grouping by row, however many keys there are.
    """
    return _reasons(_hits(incoming, index, id_col, keys).groupBy("id").agg(F.min("b").alias("b")), id_col)


def _hits(incoming: DataFrame, index: DataFrame, id_col: str, keys: list[tuple[str, Column]]) -> DataFrame:
    """id, b of every node that a key of a row finds."""
    found = exploded(incoming, id_col, keys).join(index.select("kind", "key", "node_id"), ["kind", "key"])
    return found.select("id", F.struct("prio", "node_id", "kind").alias("b"))


def _reasons(best: DataFrame, id_col: str) -> DataFrame:
    return best.select(F.col("id").alias(id_col), F.col("b.node_id").alias("match_id"), F.col("b.kind").alias("reason"))


def matches_in_turn(incoming: DataFrame, index: DataFrame, id_col: str, keys: list[tuple[str, Column]], *, needs: tuple[str, ...] = ("title",)) -> DataFrame:
    """What priority_match() gives, and a row of nulls for each id that no key finds, where the last key is asked for last:
    it is made for those rows only that no other found.

    For a key that costs more than a lookup, as a title that Python workers normalise; `needs` are the columns it is made
    of. They go along to the grouping by row, so that rows are never joined with what was found. The index is asked twice,
    so it is written once.
    """
    index = staged(index.select("kind", "key", "node_id"), "index")
    hits = _hits(incoming, index, id_col, keys[:-1])
    none = F.lit(None).cast(hits.schema["b"].dataType).alias("b")
    every = incoming.select(F.col(id_col).alias("id"), none, F.struct(*needs).alias("r"))
    every = every.unionByName(hits.withColumn("r", F.lit(None).cast(every.schema["r"].dataType)))
    found = every.groupBy("id").agg(F.min("b").alias("b"), F.collect_set("r").alias("r"))
    found = staged(found.select("id", "b", F.when(F.col("b").isNull(), F.col("r")).alias("r")), "found")
    left = found.filter("b is null").select("id", F.explode("r").alias("r")).select("id", "r.*")
    late = left.select("id", none).unionByName(_hits(left, index, "id", keys[-1:])).groupBy("id").agg(F.min("b").alias("b"))
    return _reasons(found.filter("b is not null").select("id", "b").unionByName(late), id_col)


def match_in_turn(incoming: DataFrame, index: DataFrame, id_col: str, keys: list[tuple[str, Column]]) -> DataFrame:
    """The rows of matches_in_turn() that some key found."""
    return matches_in_turn(incoming, index, id_col, keys).filter("reason is not null")


def node_keys() -> list[tuple[str, Column]]:
    """Keys of resolved records; titles after normalising, long ones only."""
    title = norm_title(F.col("title"))
    return [
        ("s2_id", F.nullif(F.col("s2_id"), F.lit(""))), ("doi", bare_id(F.col("doi"))),
        ("pmid", F.nullif(F.col("pmid"), F.lit(""))), ("title", F.when(F.length(title) >= LEAST_TITLE, title)),
    ]


#: Waiting records, with their keys, that one task may settle by itself.
LAST = 200_000


def _fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Records (id, keys asked, keys held, creators) in the order of id, settled one after the other."""
    holders: dict[str, int] = {}
    for pdf in batches:
        kinds = []
        for i, keys, held, before in zip(pdf["id"], pdf["keys"], pdf["held"], pdf["creator"], strict=True):
            merged = before is not None and before == before and before < i or any(k in holders for k in keys)
            if not merged:
                holders.update(dict.fromkeys(held, i))
            kinds.append("merged" if merged else "creator")
        yield pd.DataFrame({"id": pdf["id"], "kind": kinds})


def in_order(rows: DataFrame, id_col: str, keys: list[tuple[str, Column]], *, also: list[tuple[str, Column]] | None = None, known: DataFrame | None = None) -> DataFrame:
    """id, rep_id, created: records taken in order of id; one that meets an earlier creator's key is merged into it.

    Creators register their keys, and those of `also`, by which others find them but they themselves ask for nobody.
    Merged records register nothing, so this is no connected component. Records in `known` (column id) have a node already
    and create none. Rounds settle all records that no unsettled one can change, and write their state to the shared
    folder; a chain of records settles a link a round, so as soon as the waiting ones fit into one task, by count, that
    task settles them in order.
    """
    return _settled(rows, id_col, keys, also, known).select(F.col("id").alias(id_col), F.coalesce("rep", "id").alias("rep_id"), "created")


def _settled(rows: DataFrame, id_col: str, keys: list[tuple[str, Column]], also: list[tuple[str, Column]] | None, known: DataFrame | None) -> DataFrame:
    """id, created, rep and prio (the earlier creator that a record meets, and by which kind of key; null if none)."""
    workers(rows.sparkSession)
    asked = exploded(rows, id_col, keys).withColumn("asks", F.lit(True))
    if also:
        place = {kind: p for p, kind in enumerate(dict.fromkeys(kind for kind, _ in keys))}
        assert all(kind in place for kind, _ in also), "what is registered has to be of a kind that is asked for"
        more = exploded(rows, id_col, also).withColumn("asks", F.lit(False))
        for kind, p in place.items():
            more = more.withColumn("prio", F.when(F.col("kind") == kind, p).otherwise(F.col("prio")))
        asked = asked.unionByName(more)
    keyed = staged(asked.groupBy("id", "prio", F.concat_ws("\u0001", "kind", "key").alias("key")).agg(F.max("asks").alias("asks")))
    begin = rows.select(F.col(id_col).alias("id")).distinct().withColumn("kind", F.lit("waiting"))
    if known is not None:
        there = known.select(F.col("id").alias("__id")).distinct()
        begin = begin.join(there, F.col("id") == F.col("__id"), "left").select("id", F.when(F.col("__id").isNull(), "waiting").otherwise("merged").alias("kind"))
    state = staged(begin)
    while True:
        # A record is merged once any earlier creator holds one of its keys, and a creator once no earlier record that
        # could still become one does. Merged records hold nobody up.
        marked = keyed.join(state, "id")
        first = lambda kind: F.min(F.when(F.col("kind") == kind, F.col("id")))
        heads = marked.groupBy("key").agg(first("creator").alias("creator"), first("waiting").alias("head"))
        seen = marked.filter("kind = 'waiting' and asks").join(heads, "key").groupBy("id").agg(F.min("creator").alias("creator"), F.min("head").alias("head"))
        after = state.join(seen, "id", "left")
        kind = F.when(F.col("kind") != "waiting", F.col("kind")).when(F.col("creator") < F.col("id"), "merged").when(F.coalesce("head", "id") >= F.col("id"), "creator")
        state = staged(after.select("id", F.coalesce(kind, F.lit("waiting")).alias("kind")))
        left = keyed.join(state.filter("kind = 'waiting'").select("id"), "id")
        many = left.count()
        if not many:
            break
        if many <= LAST:
            holders = keyed.join(state.filter("kind = 'creator'").select("id"), "id").groupBy("key").agg(F.min("id").alias("creator"))
            waiting = left.join(holders, "key", "left").groupBy("id").agg(
                F.collect_list(F.when(F.col("asks"), F.col("key"))).alias("keys"), F.collect_list("key").alias("held"), F.min(F.when(F.col("asks"), F.col("creator"))).alias("creator")
            )
            settled = waiting.coalesce(1).sortWithinPartitions("id").mapInPandas(_fold, f"id {waiting.schema['id'].dataType.simpleString()}, kind string")
            state = staged(state.filter("kind <> 'waiting'").unionByName(settled))
            break
    creators = keyed.join(state.filter("kind = 'creator'").select("id"), "id").groupBy("key").agg(F.min("id").alias("creator"))
    hits = keyed.filter("asks").join(state.filter("kind = 'merged'").select("id"), "id").join(creators, "key").filter("creator < id")
    found = hits.groupBy("id").agg(F.min(F.struct("prio", "creator")).alias("b"))
    return state.join(found, "id", "left").select("id", (F.col("kind") == "creator").alias("created"), F.col("b.creator").alias("rep"), F.col("b.prio").alias("prio"))


def placed(rows: DataFrame, id_col: str, keys: list[tuple[str, Column]], index: DataFrame, *, also: list[tuple[str, Column]] | None = None) -> DataFrame:
    """id, node_id, rep_id, created, reason: each record's stored node, or the earlier record of its own batch.

    Records are taken in order of id against an index of stored nodes (kind, key, node_id) to which creators add their
    keys. Of all that a record's keys find, the kind asked first wins, and of one kind the stored node. node_id is null for
    those that meet a record of the batch, whose id rep_id is; a creator's is its own.
    """
    kinds = list(dict.fromkeys(kind for kind, _ in keys))
    hits = exploded(rows, id_col, keys).join(index.select("kind", "key", "node_id"), ["kind", "key"])
    stored = staged(hits.groupBy("id").agg(F.min(F.struct("prio", "node_id")).alias("h")).select("id", F.col("h.prio").alias("p"), "h.node_id"), "hits")
    out = _settled(rows, id_col, keys, also, stored).join(stored, "id", "left")
    own = F.col("rep").isNotNull() & (F.col("p").isNull() | (F.col("prio") < F.col("p")))
    prio = F.when(own, F.col("prio")).otherwise(F.col("p"))
    reason = F.lit(None).cast("string")
    for p, kind in enumerate(kinds):
        reason = F.when(prio == p, kind).otherwise(reason)
    rep = F.when(own, F.col("rep")).when(F.col("created"), F.col("id"))
    return out.select(F.col("id").alias(id_col), F.when(~own, F.col("node_id")).alias("node_id"), rep.alias("rep_id"), "created", reason.alias("reason"))
