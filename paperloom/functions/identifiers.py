"""Identifiers, years and blanks as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Prefixes that identifiers come with, and the address they are stored under.
ID_PREFIX = r"(?i)^(doi:|https://doi\.org/|http://dx\.doi\.org/)"
RIS_PREFIX, RIS_ADDRESS, RIS_TAIL = r"(?i)^doi:\s*", r"(?i)^https?://(dx\.)?doi\.org/", r"[\s.;,]+$"
ADDRESS = "https://doi.org/"
UUID = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"


def strip(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def bare_id(c: Column) -> Column:
    """Lower-cased identifier without one known prefix; null for blanks."""
    return blank_to_null(F.lower(F.regexp_replace(strip(c), ID_PREFIX, "")))


def id_uri(c: Column) -> Column:
    """Address of an identifier, its case kept; blanks stay empty."""
    bare = strip(F.regexp_replace(strip(c), ID_PREFIX, ""))
    return F.when(strip(c) == "", F.lit("")).otherwise(F.concat(F.lit(ADDRESS), bare))


def to_uri(c: Column) -> Column:
    return F.concat(F.lit(ADDRESS), c)


def ris_id(c: Column) -> Column:
    """Identifier as bibliography files write it: both prefixes and trailing punctuation go; blanks become empty."""
    bare = F.regexp_replace(F.regexp_replace(strip(F.coalesce(c, F.lit(""))), RIS_PREFIX, ""), RIS_ADDRESS, "")
    return F.lower(F.regexp_replace(bare, RIS_TAIL, ""))


def extract_id(candidates: list[Column]) -> Column:
    """The first candidate that is an identifier, or else holds one."""
    found = []
    for c in candidates:
        n = ris_id(c)
        inner = F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), r"(10\.\S+)", 1), F.lit(""))
        found.append(F.when(n.startswith("10."), n).otherwise(F.when(inner.isNotNull(), ris_id(inner))))
    return F.coalesce(*found, F.lit(""))


def first_nonblank(cols: list[Column]) -> Column:
    return F.coalesce(*[blank_to_null(c) for c in cols])


def extract_year(cols: list[Column]) -> Column:
    return F.coalesce(*[F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), r"((?:19|20)[0-9]{2})", 1), F.lit("")) for c in cols])


def coerce_year(c: Column) -> Column:
    """An all-digit string as int; null for anything else."""
    return F.when(c.rlike("^[0-9]+$"), c.try_cast("int"))


def four_digits(c: Column) -> Column:
    return F.when(c.cast("string").rlike("^[0-9]{4}$"), c.cast("string"))


def year_waterfall(parts: list[Column]) -> Column:
    """The first of the dates' first parts that is a year of four digits."""
    return F.coalesce(*[F.when(~four_digits(c).startswith("0"), four_digits(c)) for c in parts])


def is_uuid(c: Column) -> Column:
    return F.coalesce(c.rlike(UUID), F.lit(False))


def uuid_hex(c: Column) -> Column:
    return F.lower(F.replace(c, F.lit("-"), F.lit("")))


def uuid_dashed(c: Column) -> Column:
    h = uuid_hex(c)
    return F.when(F.length(h) == 32, F.concat_ws("-", *[F.substring(h, s, n) for s, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])).otherwise(c)


def node_key(id_: Column, uuid: Column, slug: Column) -> Column:
    """The name a node is indexed by."""
    return F.coalesce(blank_to_null(id_), blank_to_null(uuid), blank_to_null(slug))


def node_slug(slug: Column, id_: Column, uuid: Column) -> Column:
    """The name a node is shown by."""
    return F.coalesce(blank_to_null(slug), blank_to_null(id_), blank_to_null(uuid))
