"""Bibliography files (RIS): records of texts and files, projection, deduplication and export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions.identifiers import extract_id, extract_year, first_nonblank, strip

#: The format's line shapes and its tags by field.
FIELD, END = r"^([A-Z0-9]{2})  - (.*)$", "ER  -"
TRIMMED = r"^[A-Z0-9]{2}  -( |$)"
TITLE, ABSTRACT, VENUE, AUTHORS, KEYWORDS = ("TI", "T1"), ("AB", "N2"), ("JO", "JF", "T2", "JA"), ("AU", "A1"), ("KW",)
IDS, YEARS = ("DO", "M3", "UR", "N1"), ("PY", "Y1", "DA")


#: White space at the ends of lines and values.
SPACE = " \t\x0b\f\r"


def fields(body: Column) -> Column:
    """(tag, value) of the fields in one record's text, in order.

    Blank lines, and lines that are neither a field nor begin with white space, are passed over. What begins with white
    space goes on with the field above, whatever lines were passed over between; before the first field it is lost.
    """
    trim = lambda x: F.btrim(x, F.lit(SPACE))
    lines = F.filter(F.split(F.regexp_replace(body, "\r\n?", "\n"), "\n"), lambda x: trim(x) != "")
    used = F.filter(lines, lambda x: x.rlike(FIELD) | x.rlike(r"^\s"))
    # A field begins a line of its own, all else is joined to it.
    parts = F.transform(used, lambda x: F.when(x.rlike(FIELD), F.concat(F.lit("\n"), F.rtrim(x, F.lit(SPACE)))).otherwise(F.concat(F.lit(" "), trim(x))))
    whole = F.filter(F.split(F.array_join(parts, ""), "\n"), lambda x: x.rlike(TRIMMED))
    return F.transform(whole, lambda x: F.struct(F.substring(x, 1, 2).alias("tag"), trim(F.substring(x, 6, 1 << 30)).alias("value")))


def record_texts(texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """key, rec, body of every record in whole texts."""
    body = F.concat(F.lit("\n"), F.regexp_replace(text, "\r\n?", "\n"))
    return texts.select(key, F.posexplode(F.split(body, rf"\n{END}[^\n]*")).alias("rec", "body"))


def records(rows: DataFrame, keys: list[str], body: str = "body") -> DataFrame:
    """One row per record that has a title, from its text; repeated tags keep their order. Nothing is shuffled."""
    rows = rows.select(*keys, fields(F.col(body)).alias("f"))

    def under(name: str) -> Column:
        return F.filter("f", lambda x: (x["tag"] == name) & (x["value"] != ""))

    def first(*names: str) -> Column:
        return first_nonblank([F.get(under(n), F.lit(0))["value"] for n in names])

    def every(*names: str) -> Column:
        return F.transform(F.filter("f", lambda x: x["tag"].isin(*names) & (x["value"] != "")), lambda x: x["value"])

    return rows.select(
        *keys, first(*TITLE).alias("title"), first(*ABSTRACT).alias("abstract"), extract_id([first(k) for k in IDS]).alias("doi"),
        extract_year([first(k) for k in YEARS]).alias("year"), first(*VENUE).alias("venue"), first("UR").alias("url"),
        every(*AUTHORS).alias("authors"), every(*KEYWORDS).alias("keywords"),
    ).filter(F.col("title").isNotNull())


def project(rows: DataFrame) -> DataFrame:
    """Records as raw items: empty fields null, the address dropped."""
    none = lambda c: F.nullif(F.col(c), F.lit(""))
    lists = lambda c: F.when(F.size(c) > 0, F.col(c))
    return rows.drop("url").withColumns({c: none(c) for c in ("doi", "abstract", "year", "venue")} | {c: lists(c) for c in ("authors", "keywords")})


def keep_first(rows: DataFrame, order: str, doi: str = "doi", title: str = "title") -> DataFrame:
    """The first record of each identifier, or of each lower-cased title where there is none; by partial aggregates."""
    key = F.coalesce(F.nullif(F.col(doi), F.lit("")), F.lower(strip(F.col(title))))
    return rows.groupBy(key.alias("__key")).agg(F.min_by(F.struct("*"), order).alias("__r")).select("__r.*")


def export(title: Column, authors: Column, year: Column, doi: Column) -> Column:
    """A record as text."""
    line = lambda tag, c: F.when(c.isNotNull(), F.concat(F.lit(f"{tag}  - "), c))
    names = F.array_join(F.transform(authors, lambda a: F.concat(F.lit("AU  - "), a)), "\n")
    return F.concat_ws("\n", F.lit("TY  - JOUR"), line("TI", title), F.nullif(names, F.lit("")), line("PY", year), line("DO", doi), F.lit("ER  - "))


def read(spark: SparkSession, path: str) -> DataFrame:
    """Records of a file, or of all *.ris files below a folder, with their file and a number that rises within it.

    A record's end separates rows, so large files are split between tasks and no file is held as a whole. Bytes that
    are no UTF-8 become U+FFFD.
    """
    found = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[rR][iI][sS]").option("lineSep", f"\n{END}")
    text = F.concat(F.lit("\n"), F.regexp_replace(F.make_valid_utf8("value"), rf"^{END}", ""))
    return records(found.text(path).select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("rec"), text.alias("body")), ["file", "rec"])
