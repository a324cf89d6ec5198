"""A batch from raw items to a new state of the store, and the backfill of stored nodes through it.

Phases run one after the other, and each writes what it made, so a run that died goes on after the last whole phase. An
item that fails keeps its error, leaves the phases that build on what failed, and holds nobody up.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions import tags as T
from paperloom.functions.identifiers import bare_id, blank_to_null, node_key, to_uri, uuid_dashed
from paperloom.functions.text import citation_string
from paperloom.operators import records as R
from paperloom.operators.catalog import BATCH, chosen_citations, outbound
from paperloom.operators.enrich import Catalogs, resolve
from paperloom.operators.graph import KEYS, new_edges
from paperloom.operators.identity import first_of, match_in_turn, node_key_rows, node_keys, placed
from paperloom.operators.monitor import alive
from paperloom.operators.staging import dealt, numbered, staged
from paperloom.schemas import CITATION_ITEM
from paperloom.sources.files import latest, publish

#: The edges that citations become, a stored record's schema, and what notes say of a node.
REFERENCES, SCHEMA = "references", "reference-v1"
CREATED_NOTE, MERGED_NOTE, ORIGIN_NOTE = "Created via ingestion pipeline; source: ", "Dedup match on ", "; merged metadata; source: "
#: Columns of a stored record that an incoming one fills where they are missing.
RECORD = ("doi", "pmid", "s2_id", "year", "venue", "authors", "alt_dois")
#: Rows, counted before they are broadcast, of a few hundred bytes each.
FEW = 100_000

_LIST = "array<string>"


@dataclass(frozen=True)
class Store:
    """Nodes and edges as schemas.NODE and schemas.EDGE have them."""

    nodes: DataFrame
    edges: DataFrame


@dataclass(frozen=True)
class Result:
    """The store after a batch (a new state, nothing is overwritten), an outcome for each item, notes, new edges."""

    store: Store
    outcomes: DataFrame  # idx, node_id, created, reason, source, linked, skipped, stored, reverse, has_citations, status, errors
    notes: DataFrame  # node_id, content
    edges: DataFrame


class Run:
    """Phases of a run: each is made once and written; with a folder, what an earlier run has written is read again."""

    def __init__(self, spark, root: str | None) -> None:
        self.spark, self.root = spark, root

    def phase(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if self.root is None:
            return staged(make(), name)
        where = f"{self.root.rstrip('/')}/{name}"
        try:
            return latest(self.spark, where)
        except AnalysisException:  # never written, or not to its end
            publish(make(), where)
            return latest(self.spark, where)


def isolated(rows: DataFrame, step: Callable[[DataFrame], DataFrame], fault: Column | None = None) -> DataFrame:
    """rows after a step that only those without errors take; a column `error` that the step adds joins their errors.

    fault: what else goes wrong with a row, as a sink or a client reports it; null if nothing does.
    """
    clean = F.size("errors") == 0
    done = step(rows.filter(clean))
    if "error" not in done.columns:
        done = done.withColumn("error", F.lit(None).cast("string"))
    if fault is not None:
        done = done.withColumn("error", F.coalesce("error", fault))
    done = done.withColumn("errors", F.when(F.col("error").isNotNull(), F.array("error")).otherwise(F.col("errors"))).drop("error")
    return done.unionByName(rows.filter(~clean), allowMissingColumns=True)


def made_id(batch: str, idx: Column) -> Column:
    """Id of the node that an item of a batch creates: the same if the batch is run again."""
    return uuid_dashed(F.md5(F.concat_ws("\u0001", F.lit(batch), idx.cast("string"))))


def _items(items: DataFrame) -> DataFrame:
    """Raw items parsed, with the errors of those that are no items or have nothing to be found by."""
    rows = R.parse(R.normalized_items(items))
    errors = F.when(F.col("item_error").isNotNull(), F.array("item_error")).otherwise(F.col("errors"))
    return rows.withColumn("errors", errors).drop("item_error")


def _by_id(df: DataFrame, few: bool) -> DataFrame:
    return F.broadcast(df) if few else df


def _key() -> Column:
    return node_key(F.col("id"), F.col("uuid"), F.col("slug"))


def _others(nodes: DataFrame, touched: DataFrame, few: bool) -> DataFrame:
    """The nodes that touched (node_id) doesn't name."""
    return nodes.join(_by_id(touched, few), _key() == F.col("node_id"), "left_anti")


def _upserted(nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """The nodes that the resolved rows (idx, node_id, created and the record) name, after these were merged in, in order of
    idx; all others stay as they are.

    Of a record's columns the first value stands, the stored one before all; the citation line is the last row's; tags are
    derived from the last row's identity and the topics of the last row that brought any.
    """
    here = lambda c: F.when(~T.is_missing(F.col(c), array=R.is_array(rows, c)), F.col("idx"))
    topics = ("fields", "types", "mesh", "keywords", "mesh_major", "mesh_qualifiers")
    topical = F.lit(False)
    for c in topics:
        topical = topical | (F.size(c) > 0)
    line = citation_string(F.col("authors"), F.col("year"), F.col("title"), F.col("venue"))
    rows = rows.withColumn("__line", line)
    new = rows.groupBy("node_id").agg(
        *[F.min_by(c, here(c)).alias(f"__{c}") for c in RECORD], F.max_by("__line", "idx").alias("__citation"),
        F.min_by(F.struct("title", "abstract", "doi"), "idx").alias("__first"), F.max_by(F.struct("s2_id", "pmid", "year"), "idx").alias("__last"),
        F.max_by(F.struct(*topics), F.when(topical, F.col("idx"))).alias("__topics"),
    )
    new = staged(new, "merged")
    few = new.count() <= FEW
    both = nodes.withColumn("__key", _key()).join(_by_id(new, few), F.col("__key") == F.col("node_id"))
    kind = nodes.schema["metadata"].dataType["reference"].dataType
    blank = nodes.sparkSession.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in nodes.schema])
    made = new.join(rows.filter("created").select("node_id"), "node_id", "left_semi").join(F.broadcast(blank), F.lit(True))
    r, none = F.col("metadata.reference"), F.array().cast(_LIST)

    def merged(df: DataFrame, *, fresh: bool) -> DataFrame:
        first = F.col("__first")
        values = {c: T.merge_missing(r[c], F.col(f"__{c}"), array=c in ("authors", "alt_dois")) for c in RECORD}
        if fresh:
            values |= {"schema": F.lit(SCHEMA), "uri": to_uri(first["doi"])}
        reference = F.struct(*[values.get(f.name, r[f.name]).cast(f.dataType).alias(f.name) for f in kind])
        topic = T.Topics(*[F.coalesce(F.col(f"__topics.{c}"), none) for c in topics])
        last = F.col("__last")
        fresh_tags = T.derive_tags(F.col("tags"), last["s2_id"], last["pmid"], last["year"], topic, own_s2_id=values["s2_id"], own_pmid=values["pmid"])
        columns = {"metadata": F.struct(reference.alias("reference")), "tags": fresh_tags, "citation": F.col("__citation")}
        if fresh:
            columns |= {"id": F.col("node_id"), "title": first["title"], "abstract": first["abstract"], "uri": to_uri(first["doi"]), "type": F.lit("reference")}
        return df.select(*[columns[c].alias(c) if c in columns else F.col(c) for c in nodes.columns])

    return merged(both, fresh=False).unionByName(merged(made, fresh=True))


def _stored_items(nodes: DataFrame) -> DataFrame:
    return nodes.select(_key().alias("node_id"), F.col("metadata.reference.outbound_citations.items").alias("held"))


def _links(rows: DataFrame, index: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(idx, linked, skipped of rows (idx, node_id, items); edges that are new)."""
    cited = rows.select("idx", "node_id", F.posexplode("items").alias("pos", "i")).select(F.struct("idx", "pos", "node_id").alias("__item"), "i.*")
    found = cited.select("__item").join(match_in_turn(cited, index, "__item", node_keys()), "__item", "left")
    found = staged(found.select("__item.idx", F.col("__item.node_id").alias("source_id"), F.col("match_id").alias("target_id")), "links")
    ok = F.col("target_id").isNotNull() & (F.col("target_id") != F.col("source_id"))
    counts = found.groupBy("idx").agg(F.count_if(ok).alias("linked"), F.count_if(~ok).alias("skipped"))
    return counts, new_edges(found.filter(ok).withColumn("relationship", F.lit(REFERENCES)), edges)


def _reverse(rows: DataFrame, nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(idx, reverse of rows (idx, node_id, doi); edges that are new) from nodes whose stored lists wait for the identifier."""
    waits = _stored_items(nodes).select(F.col("node_id").alias("source_id"), F.explode("held").alias("i")).select("source_id", bare_id(F.col("i.doi")).alias("key"))
    made = rows.select("idx", F.col("node_id").alias("target_id"), bare_id(F.col("doi")).alias("key"))
    hits = staged(waits.filter("key is not null").join(_by_id(made, made.count() <= FEW), "key").filter("source_id <> target_id"), "reverse")
    return hits.groupBy("idx").agg(F.count(F.lit(1)).alias("reverse")), new_edges(hits.withColumn("relationship", F.lit(REFERENCES)), edges)


def ingest(
    items: DataFrame, catalogs: Catalogs, references: DataFrame, store: Store, *, batch: str, day: str, root: str | None = None, faults: dict[str, Column] | None = None,
) -> Result:
    """Take a batch in: items (idx, item as JSON: an identifier or a record) against catalogs and the store.

    references: doi, at, payload, the catalog's answers about what a paper cites. batch names the run (created ids follow
    from it), day is written to notes and lists. faults: for the phases resolve, upsert, store and link a column that tells
    what went wrong with an item there.
    """
    faults = faults or {}
    run = Run(items.sparkSession, root)
    return _taken(_resolved(items, catalogs, run, faults), references, store, _keys(store.nodes), batch=batch, day=day, run=run, faults=faults)[0]


def _alive(nodes: DataFrame) -> DataFrame:
    return nodes.filter(alive(F.col("status")))


def _keys(nodes: DataFrame) -> DataFrame:
    return staged(node_key_rows(_alive(nodes)), "keys")


def _resolved(items: DataFrame, catalogs: Catalogs, run: Run, faults: dict[str, Column]) -> DataFrame:
    """Raw items parsed and resolved; nothing here looks at the store."""
    # Asking the first catalog reads the items twice; they are parsed once, on all cores.
    parsed = staged(_items(dealt(items.select("idx", "item"))).select("idx", "doi", "pmid", "title", "abstract", "year", "venue", "authors", "keywords", "errors").withColumn("asked_doi", F.col("doi")), "parsed")
    return run.phase("resolved", lambda: isolated(parsed, lambda df: resolve(df, catalogs).withColumnRenamed("resolve_error", "error"), faults.get("resolve")))


def _taken(resolved: DataFrame, references: DataFrame, store: Store, keys: DataFrame, *, batch: str, day: str, run: Run, faults: dict[str, Column]) -> tuple[Result, DataFrame]:
    """(ingest() of resolved items, the keys of the nodes after), by keys of the store's alive nodes as node_key_rows() makes
    them; those of nodes that the batch doesn't touch are not made again."""
    none = F.array().cast(_LIST)

    def match() -> DataFrame:
        clean = resolved.filter(F.size("errors") == 0)
        alternatives = [("doi", F.transform(F.coalesce("alt_dois", none), bare_id))]
        return placed(clean, "idx", node_keys(), first_of(keys), also=alternatives)

    matched = run.phase("matched", match)
    named = matched.select("idx", F.coalesce("node_id", made_id(batch, F.col("rep_id"))).alias("node_id"), "created", "reason")
    placed_rows = isolated(resolved, lambda df: df.join(named, "idx"), faults.get("upsert"))
    rows = run.phase("placed", lambda: placed_rows)
    upserted = rows.filter((F.size("errors") == 0) & F.col("node_id").isNotNull())
    touched = staged(upserted.select("node_id").distinct(), "touched")
    few = touched.count() <= FEW
    changed = run.phase("changed", lambda: _upserted(store.nodes, upserted))
    others = _others(store.nodes, touched, few)
    there = _alive(others.unionByName(changed))
    kept_keys = keys.join(_by_id(touched, few), keys["id"] == F.col("node_id"), "left_anti")
    keys = staged(kept_keys.unionByName(node_key_rows(_alive(changed))), "keys")

    def fetch(df: DataFrame) -> DataFrame:
        doi = F.coalesce(F.col("doi"), F.col("asked_doi"))
        answers = references.groupBy(F.col("doi").alias("__doi")).agg(F.max_by("payload", "at").alias("payload"))
        asked = df.withColumn("__key", F.coalesce(bare_id(doi), F.concat(F.lit("\u0000"), F.col("idx").cast("string"))))
        got = asked.join(answers, F.col("__key") == F.col("__doi"), "left")
        # No answer is an empty one, as for a paper that lists nothing.
        fetched = outbound(F.coalesce("payload", F.lit("{}")), doi)
        chosen = chosen_citations(F.col("cited").cast(f"array<{CITATION_ITEM}>"), fetched)
        return got.withColumn("__c", chosen).withColumns({"from": F.col("__c.source"), "items": F.col("__c.items")}).drop("__c", "__key", "__doi", "payload")

    kept = run.phase("fetched", lambda: isolated(rows.filter(F.col("node_id").isNotNull() & (F.size("errors") == 0)), fetch, faults.get("store")))
    stored = kept.filter(F.size("errors") == 0)
    counts, forward = _links(stored.select("idx", "node_id", "items"), first_of(keys), store.edges)
    waited, backward = _reverse(upserted.select("idx", "node_id", F.coalesce("doi", "asked_doi").alias("doi")), there, store.edges)
    fresh = forward.unionByName(backward).distinct()
    edge_id = uuid_dashed(F.md5(F.concat_ws("\u0001", *KEYS)))
    new = run.phase("edges", lambda: fresh.select(edge_id.alias("id"), *KEYS))

    before = _stored_items(store.nodes).join(_by_id(stored.select("node_id").distinct(), few), "node_id", "left_semi")
    linked = isolated(kept.join(counts, "idx", "left").join(before, "node_id", "left"), lambda df: df, faults.get("link"))
    ended = run.phase("linked", lambda: linked.join(waited, "idx", "left"))
    # An item whose later phases failed is in the store all the same, and says so there.
    status = ended.groupBy("node_id").agg(F.max_by(T.final_status(F.col("errors")), "idx").alias("__status"))
    lists = stored.groupBy("node_id").agg(
        F.max_by(F.struct("from", "items"), F.when(F.size("items") > 0, F.col("idx"))).alias("__full"), F.max_by(F.struct("from", "items"), "idx").alias("__any")
    )
    final = run.phase("final", lambda: others.unionByName(_finished(changed, status.join(lists, "node_id", "left"), day)))
    n = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    count = F.when(F.size("items") > 0, F.size("items")).otherwise(F.size(F.coalesce("held", F.array().cast(f"array<{CITATION_ITEM}>")))).cast("long")
    part = ended.select("idx", n("linked"), n("skipped"), n("reverse"), F.coalesce(count, F.lit(0).cast("long")).alias("stored"), F.col("items").isNotNull().alias("has_citations"), F.col("errors").alias("__later"))
    every = rows.select("idx", "node_id", "created", "reason", "source", F.col("errors").alias("__early")).join(part, "idx", "left")
    errors = F.coalesce(F.when(F.size("__early") > 0, F.col("__early")), F.col("__later"), F.col("__early"))
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("linked", "skipped", "stored", "reverse")]
    placed_node = F.when(F.size("__early") == 0, F.col("node_id"))
    outcomes = run.phase("outcomes", lambda: every.select(
        "idx", placed_node.alias("node_id"), F.when(F.size("__early") == 0, F.col("created")).alias("created"), "reason", "source", *zero,
        F.coalesce("has_citations", F.lit(False)).alias("has_citations"), T.final_status(errors).alias("status"), errors.alias("errors"),
    ))
    return Result(Store(final, store.edges.select("id", *KEYS).unionByName(new)), outcomes, _notes(outcomes, day), new), keys


def _finished(nodes: DataFrame, ends: DataFrame, day: str) -> DataFrame:
    """nodes with their final status and citation lists; an empty list never replaces one with items."""
    ends = staged(ends.withColumnRenamed("node_id", "__id"), "ends")
    few = ends.count() <= FEW
    both = nodes.withColumn("__key", _key()).join(_by_id(ends, few), F.col("__key") == F.col("__id"), "left")
    kind = nodes.schema["metadata"].dataType["reference"].dataType
    r = F.col("metadata.reference")
    held = r["outbound_citations"]
    chosen = F.coalesce("__full", "__any")
    fresh = F.struct(chosen["from"].alias("source"), F.lit(day).alias("retrieved_at"), chosen["items"].alias("items")).cast(kind["outbound_citations"].dataType)
    keeps = F.col("__full").isNull() & (F.size(F.coalesce(held["items"], F.array().cast(f"array<{CITATION_ITEM}>"))) > 0)
    lists = F.when(F.col("__any").isNull() | keeps, held).otherwise(fresh)
    reference = F.struct(*[lists.alias(f.name) if f.name == "outbound_citations" else r[f.name].alias(f.name) for f in kind])
    touched = F.col("__id").isNotNull()
    columns = {"metadata": F.when(touched, F.struct(reference.alias("reference"))).otherwise(F.col("metadata")), "tags": F.when(touched, T.set_status(F.col("tags"), F.col("__status"))).otherwise(F.col("tags"))}
    return both.select(*[columns[c].alias(c) if c in columns else F.col(c) for c in nodes.columns])


def _notes(outcomes: DataFrame, day: str) -> DataFrame:
    """Dated notes: what was created or merged, and of failed items that have a node why."""
    at = F.lit(f"[{day}] ")
    kept = outcomes.filter("node_id is not null")
    made = F.when(F.col("created"), F.concat(at, F.lit(CREATED_NOTE), "source")).otherwise(F.concat(at, F.lit(MERGED_NOTE), F.coalesce("reason", F.lit("")), F.lit(ORIGIN_NOTE), "source"))
    failed = kept.filter(F.size("errors") > 0).select("node_id", T.failure_note(F.lit(day), F.col("errors")).alias("content"))
    return kept.select("node_id", made.alias("content")).unionByName(failed)


def backfill(
    store: Store, catalogs: Catalogs, references: DataFrame, *, batch: str, day: str, statuses: tuple[str, ...] = ("queued", "scaffolded", "failed"), only_missing: bool = False,
    chunk_size: int = FEW, root: str | None = None,
) -> tuple[DataFrame, Store]:
    """(ten counters, the store after): stored nodes with one of the statuses, through ingest() again.

    A node is fed as its identifier, or as a record where it has none; one without identifier and long title is skipped, and
    with only_missing one that has topical tags. All are resolved at once, since no catalog looks at the store. Chunks then
    follow each other, so a later one sees what an earlier one made; each writes the store anew, so let it be large.
    """
    living = store.nodes.filter(alive(F.col("status")))
    found = R.candidates([living.filter(T.has_status(F.col("tags"), s)) for s in statuses], ["id", "uuid", "slug"])
    reference = F.col("metadata.reference")
    found = found.withColumn("__doi", R.doi_precedence(F.col("uri"), reference["doi"], F.col("tags")))
    tagged = F.lit(only_missing) & F.coalesce(T.is_topical(F.col("tags")), F.lit(False))
    record = F.struct(*[c for c in R.raw_from_node()])
    item = F.when(F.col("__doi").isNotNull(), F.to_json(F.struct(F.col("__doi").alias("d")))).otherwise(F.to_json(record))
    # An identifier alone is a JSON string.
    item = F.when(F.col("__doi").isNotNull(), F.regexp_replace(F.regexp_replace(item, r'^\{"d":', ""), r"\}$", "")).otherwise(item)
    usable = F.col("__doi").isNotNull() | blank_to_null(reference["pmid"]).isNotNull() | (F.length(blank_to_null(F.col("title"))) >= R.LEAST_TITLE)
    todo = staged(found.select("place", "id", item.alias("item"), tagged.alias("tagged"), F.coalesce(usable, F.lit(False)).alias("usable")), "candidates")
    n = todo.agg(
        F.count(F.lit(1)).alias("candidates"), F.count_if(F.col("tagged")).alias("tagged"), F.count_if(~F.col("tagged") & ~F.col("usable")).alias("unusable")
    ).first()
    queue = todo.filter("usable and not tagged")
    left = n.candidates - n.tagged - n.unusable
    if left and chunk_size <= 0:
        raise ValueError("chunk size must be positive")
    if not left:
        return _counters(todo.sparkSession, None, n, left), store
    rows = staged(numbered(queue, "place", "id").select("idx", "item"), "queue")
    resolved, keys = _resolved(rows, catalogs, Run(todo.sparkSession, root), {}), _keys(store.nodes)
    outcomes: DataFrame | None = None
    for k in range(-(-left // chunk_size)):
        chunk = resolved.filter((F.col("idx") >= k * chunk_size) & (F.col("idx") < (k + 1) * chunk_size))
        done, keys = _taken(chunk, references, store, keys, batch=f"{batch}-{k}", day=day, run=Run(todo.sparkSession, f"{root}/{k}" if root else None), faults={})
        store = replace(store, nodes=done.store.nodes, edges=done.store.edges)
        outcomes = done.outcomes if outcomes is None else outcomes.unionByName(done.outcomes)
    return _counters(todo.sparkSession, outcomes, n, left), store


def _counters(spark, outcomes: DataFrame | None, n, left: int) -> DataFrame:
    fixed = {"candidates": n.candidates, "resolvable": left, "skipped_no_doi": n.unusable, "skipped_already_tagged": n.tagged}
    fixed_columns = [F.lit(v).cast("long").alias(k) for k, v in fixed.items()]
    names = ("processed", "edges_linked", "citations_stored", "failed", "needs_review", "errors")
    if outcomes is None:
        return spark.range(1).select(*fixed_columns, *[F.lit(0).cast("long").alias(c) for c in names])
    ok = F.size("errors") == 0
    total = lambda c: F.coalesce(F.sum(F.when(ok, F.col(c))), F.lit(0)).cast("long")
    return outcomes.agg(
        F.count_if(ok).alias("processed"), total("linked").alias("edges_linked"), total("stored").alias("citations_stored"), F.count_if(F.col("status") == "failed").alias("failed"),
        F.count_if(F.col("status") == "needs-review").alias("needs_review"), F.coalesce(F.sum(F.size("errors")), F.lit(0)).cast("long").alias("errors"),
    ).select(*fixed_columns, *names)
