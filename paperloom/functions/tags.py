"""Tag algebra, status and merging as Column functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperloom.functions.identifiers import bare_id, blank_to_null, strip
from paperloom.functions.text import pub_type_slug, slugify

#: Statuses; renamed type tags; namespaces that a new derivation replaces always, and only if it
#: brings topics of its own; namespaces that make a node topical; markers of failures that need a person.
STATUSES = ("queued", "scaffolded", "digesting", "digested", "partial", "needs-review", "failed")
CANONICAL = {
    "journalarticle": "journal-article", "clinicaltrial": "clinical-trial", "metaanalysis": "meta-analysis",
    "casereport": "case-report", "lettersandcomments": "letters-and-comments",
}
ALWAYS = ("pipeline:", "s2id:", "pmid:", "year:")
TOPICAL = ("mesh:", "mesh-major:", "mesh-q:", "kw:", "field:", "type:")
TOPICAL_SKIP = ("mesh:", "field:", "type:")
PERMANENT = ("could not resolve a title", "provide a doi", "404", "not found", "invalid doi", "malformed", "no doi", "locator")
FOREIGN = (
    "pmid:38621210", "kw:okr", "kw:optic-nerve", "kw:optokinetic-response", "kw:regeneration", "kw:vision",
    "mesh-major:nystagmus-optokinetic", "mesh:nystagmus-optokinetic", "mesh:printing-three-dimensional", "mesh-q:physiology",
)
VERDICTS = {"confirmed": "verified", "uncertain": "needs-review", "rejected": "drop"}


def ordered_union(kept: Column, added: Column) -> Column:
    """kept, then the trimmed non-blank new members, each at its first place."""
    new = F.filter(F.transform(F.filter(added, lambda x: x.isNotNull()), strip), lambda x: x != "")
    return F.array_distinct(F.concat(kept, new))


def starts_with_any(tag: Column, prefixes: tuple[str, ...]) -> Column:
    hit = F.lit(False)
    for p in prefixes:
        hit = hit | tag.startswith(p)
    return hit


def canonical_type_tag(tag: Column) -> Column:
    out = tag
    for old, new in CANONICAL.items():
        out = F.when(tag == f"type:{old}", F.lit(f"type:{new}")).otherwise(out)
    return out


def canonicalize(tags: Column) -> Column:
    return F.array_distinct(F.transform(tags, canonical_type_tag))


def has_stale_type(tags: Column) -> Column:
    return F.arrays_overlap(tags, F.array(*[F.lit(f"type:{old}") for old in CANONICAL]))


@dataclass(frozen=True)
class Topics:
    """Array columns of a resolved record."""

    fields: Column
    types: Column
    mesh: Column
    keywords: Column
    major: Column
    qualifiers: Column

    def all(self) -> tuple[Column, ...]:
        return self.fields, self.types, self.mesh, self.keywords, self.major, self.qualifiers


def derive_tags(
    existing: Column, s2_id: Column, pmid: Column, year: Column, topics: Topics, *, own_s2_id: Column | None = None, own_pmid: Column | None = None,
) -> Column:
    """Tags of a node after a record was merged into it: what stays, then identity and topics of the record.

    Where the record has no identifier, the node's own one keeps its tag.
    """
    s2_id = s2_id if own_s2_id is None else F.coalesce(F.nullif(s2_id, F.lit("")), blank_to_null(own_s2_id))
    pmid = pmid if own_pmid is None else F.coalesce(F.nullif(pmid, F.lit("")), blank_to_null(own_pmid))
    none = F.array().cast("array<string>")
    topical = F.lit(False)
    for c in topics.all():
        topical = topical | (F.size(F.coalesce(c, none)) > 0)
    stays = F.filter(
        F.transform(F.coalesce(existing, none), canonical_type_tag),
        lambda t: ~starts_with_any(t, ALWAYS) & ~(topical & starts_with_any(t, TOPICAL)),
    )
    one = lambda prefix, c: F.when(F.coalesce(c, F.lit("")) != "", F.array(F.concat(F.lit(prefix), c))).otherwise(none)
    many = lambda prefix, c, slug: F.transform(F.filter(F.transform(F.coalesce(c, none), slug), lambda x: x.isNotNull()), lambda x: F.concat(F.lit(prefix), x))
    fresh = F.concat(
        F.array(F.lit("pipeline:scaffolded")), one("s2id:", s2_id), one("pmid:", pmid), one("year:", year),
        many("field:", topics.fields, slugify), many("type:", topics.types, pub_type_slug), many("mesh:", topics.mesh, slugify),
        many("kw:", topics.keywords, slugify), many("mesh-major:", topics.major, slugify), many("mesh-q:", topics.qualifiers, slugify),
    )
    return ordered_union(F.array_distinct(stays), fresh)


def set_status(tags: Column, status: str | Column) -> Column:
    """tags with the one pipeline status last. A literal that is no status is refused."""
    if isinstance(status, str):
        if status not in STATUSES:
            raise ValueError(f"unknown status: {status}")
        status = F.lit(status)
    none = F.array().cast("array<string>")
    return F.concat(F.filter(F.coalesce(tags, none), lambda t: ~t.startswith("pipeline:")), F.array(F.concat(F.lit("pipeline:"), status)))


def first_status(tags: Column) -> Column:
    return F.get(F.filter(tags, lambda t: t.startswith("pipeline:")), F.lit(0))


def has_status(tags: Column, status: str) -> Column:
    """Membership in a list of tags, or in one comma-joined string of them."""
    return F.coalesce(F.array_contains(tags, f"pipeline:{status}"), F.lit(False))


def tag_list(joined: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(joined, F.lit("")), ","), strip), lambda x: x != "")


def tag_changes(before: Column, after: Column) -> tuple[Column, Column]:
    """(removed, added), each tag once."""
    none = F.array().cast("array<string>")
    old, new = F.coalesce(before, none), F.coalesce(after, none)
    return F.array_except(old, new), F.array_except(new, old)


def is_topical(tags: Column) -> Column:
    return F.exists(tags, lambda t: starts_with_any(t, TOPICAL_SKIP))


def strip_foreign(tags: Column, foreign: tuple[str, ...] = FOREIGN) -> Column:
    return F.filter(tags, lambda t: ~t.isin(*foreign))


def classify_failure(errors: Column) -> Column:
    """needs-review if any error is of a lasting kind, else failed."""
    lasting = F.exists(errors, lambda e: F.lower(e).rlike("|".join(PERMANENT)))
    return F.when(F.coalesce(lasting, F.lit(False)), "needs-review").otherwise("failed")


def final_status(errors: Column) -> Column:
    return F.when(F.size(F.coalesce(errors, F.array().cast("array<string>"))) == 0, "digested").otherwise(classify_failure(errors))


def failure_note(day: Column, errors: Column) -> Column:
    return F.concat(F.lit("["), day, F.lit("] backfill "), classify_failure(errors), F.lit(": "), F.get(errors, F.lit(0)))


def is_missing(c: Column, *, array: bool = False) -> Column:
    return c.isNull() | (F.size(c) == 0 if array else c.cast("string") == "")


def merge_missing(existing: Column, incoming: Column, *, array: bool = False) -> Column:
    """incoming where existing is missing (null, empty string or empty list) and incoming is not."""
    return F.when(is_missing(existing, array=array) & ~is_missing(incoming, array=array), incoming).otherwise(existing)


def canonical_promote(doi: Column, alternatives: Column, candidate: Column) -> tuple[Column, Column]:
    """(identifier, alternatives) after a catalog named another canonical identifier."""
    new, old = bare_id(candidate), bare_id(doi)
    none = F.array().cast("array<string>")
    moved = new.isNotNull() & (F.coalesce(old, F.lit("")) != new)
    return F.when(moved, new).otherwise(doi), F.when(moved & old.isNotNull(), ordered_union(F.coalesce(alternatives, none), F.array(old))).otherwise(F.coalesce(alternatives, none))
