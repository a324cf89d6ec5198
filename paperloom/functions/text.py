"""Titles, slugs, token measures, citations and markup as Column functions."""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.functions.identifiers import blank_to_null, strip

#: Words that say nothing about a title, and the least length of one that does.
STOPWORDS = ("the", "and", "of", "in", "for", "a", "an", "to", "on", "with", "from", "via")
LEAST_TOKEN = 3
LEAST_TOKENS = 5
MATCHED = 85.0


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is worked out once for each row, however often the body names it.

    A parsed text whose fields are read inside of lambdas would be parsed again by each of them.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


@F.pandas_udf(T.StringType())
def norm_title(titles: pd.Series) -> pd.Series:
    """Lower-cased ASCII parts of a title, accents folded, trailing stops gone, white space single; null is empty."""

    def one(t: str | None) -> str:
        folded = unicodedata.normalize("NFKD", (t or "").lower().strip()).encode("ascii", "ignore").decode()
        return " ".join(folded.rstrip(".").split())

    return titles.map(one, na_action=None).astype("object")


def slugify(c: Column) -> Column:
    dashed = F.regexp_replace(F.lower(strip(c)), "[^0-9a-z]+", "-")
    return F.nullif(F.regexp_replace(dashed, "^-+|-+$", ""), F.lit(""))


def pub_type_slug(c: Column) -> Column:
    """Slug of a name whose words may be joined in camel case."""
    return slugify(F.regexp_replace(c, "(?<=[a-z0-9])(?=[A-Z])", " "))


@F.pandas_udf(T.StringType())
def unescape(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


def sig_tokens(c: Column, *, entities: bool = True) -> Column:
    """Tokens of a title that tell it from others; repeated ones stay."""
    text = unescape(c) if entities else c
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.filter(parts, lambda t: (F.length(t) >= LEAST_TOKEN) & ~t.isin(*STOPWORDS))


def token_overlap(title: Column, other: Column) -> Column:
    """Share of the title's tokens found in the other; null for short titles or nothing to compare with."""
    found = F.size(F.filter(title, lambda t: F.array_contains(other, t)))
    return F.when((F.size(title) >= LEAST_TOKENS) & (F.size(other) > 0), found / F.size(title))


def bidir_similarity(a: Column, b: Column) -> Column:
    """The larger of the shares that the common tokens are of either set; null if one is empty."""
    x, y = F.array_distinct(a), F.array_distinct(b)
    both = F.size(F.array_intersect(x, y))
    return F.when((F.size(x) > 0) & (F.size(y) > 0), F.greatest(both / F.size(x), both / F.size(y)))


def _lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, a row of bits at a time."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full, row = (1 << len(a)) - 1, (1 << len(a)) - 1
    for c in b:
        hit = row & places.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def sorted_ratio(a: str, b: str) -> float:
    """Similarity in percent of two titles whose words are sorted: 200 * common subsequence / lengths."""
    x, y = " ".join(sorted(a.split())), " ".join(sorted(b.split()))
    return 100.0 if not x and not y else 200.0 * _lcs(x, y) / (len(x) + len(y))


@F.pandas_udf(T.DoubleType())
def token_sort_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else sorted_ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


def citation_string(authors: Column, year: Column, title: Column, venue: Column) -> Column:
    """Authors (year). title venue, without what is missing."""
    names = F.nullif(F.array_join(authors, "; "), F.lit(""))
    y = F.nullif(year, F.lit(""))
    head = (
        F.when(names.isNotNull() & y.isNotNull(), F.concat(names, F.lit(" ("), y, F.lit(").")))
        .when(y.isNotNull(), F.concat(F.lit("("), y, F.lit(").")))
        .when(names.isNotNull(), F.concat(names, F.lit(".")))
    )
    return F.concat_ws(" ", head, F.nullif(title, F.lit("")), F.nullif(venue, F.lit("")))


def split_list(c: Column) -> Column:
    """Trimmed non-empty parts of a list with semicolons."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ";"), strip), lambda x: x != "")


def markup_text(c: Column) -> Column:
    """All text of a piece of markup, white space single; null if there is none."""
    return blank_to_null(F.regexp_replace(F.regexp_replace(c, "<[^>]*>", " "), r"\s+", " "))


def xml_text(xml: Column, path: str) -> Column:
    """Nested text of the first element at an XPath, white space single; null if there is none."""
    return blank_to_null(F.regexp_replace(F.xpath_string(xml, F.lit(path)), r"\s+", " "))


def xml_year(xml: Column, date: str = "//PubDate") -> Column:
    """The date's year, else the first four characters of its free form, if they are digits."""
    year = F.coalesce(xml_text(xml, f"{date}/Year"), F.substring(xml_text(xml, f"{date}/MedlineDate"), 1, 4))
    return F.when(year.rlike("^[0-9]{4}$"), year)


def xml_topics(xml: Column) -> tuple[Column, Column, Column]:
    """(major headings, qualifiers, publication types), each once, in order."""
    clean = lambda a: F.array_distinct(F.filter(F.transform(a, strip), lambda x: x != ""))
    major = F.xpath(xml, F.lit("//MeshHeading[*/@MajorTopicYN='Y']/DescriptorName/text()"))
    return clean(major), clean(F.xpath(xml, F.lit("//QualifierName/text()"))), clean(F.xpath(xml, F.lit("//PublicationType/text()")))




_INSIDE = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
_ATTRIBUTES = rf"(?:\s{_INSIDE})?"
#: References that XML knows by itself; any other makes a text no XML.
_UNKNOWN_REFERENCE = r"&(?!(?:lt|gt|amp|quot|apos|#[0-9]{1,7}|#x[0-9a-fA-F]{1,6});)"


def xml_is_whole(xml: Column) -> Column:
    """Whether a text is well-formed XML; null is not."""
    bad = F.from_xml(xml, "_bad string", {"columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE"})["_bad"]
    return F.coalesce(bad.isNull() & ~xml.rlike(_UNKNOWN_REFERENCE) & (strip(xml) != ""), F.lit(False))


def xml_elements(xml: Column, name: str) -> Column:
    """Whole elements of a name, tags included, in order; comments and the marks of character data have to be out.

    Elements of that name lie not within each other, as in article records.
    """
    return F.regexp_extract_all(xml, F.lit(rf"(?s)<{name}{_ATTRIBUTES}(?<!/)>.*?</{name}\s*>"), F.lit(0))


def xml_bare(xml: Column) -> Column:
    """A text of XML without comments, processing instructions and the marks around character data."""
    return F.regexp_replace(F.regexp_replace(xml, r"(?s)<!--.*?-->|<\?.*?\?>", ""), r"(?s)<!\[CDATA\[(.*?)\]\]>", "$1")


def xml_content(element: Column) -> Column:
    """All text in an element, references decoded, white space single; null if there is none. Only for well-formed ones."""
    decoded = lambda text: F.when(F.contains(text, F.lit("&")), F.xpath_string(F.concat(F.lit("<r>"), text, F.lit("</r>")), F.lit("/r"))).otherwise(text)
    plain = let(F.regexp_replace(element, f"(?s)<{_INSIDE}>", ""), lambda t: F.regexp_replace(decoded(t), r"(?U)\s+", " "))
    return let(plain, blank_to_null)


def xml_marked(element: Column, attribute: str, value: str) -> Column:
    """Whether an element's own tag has an attribute with a value, in any case."""
    return element.rlike(rf"""(?si)^<[\w:.-]+(?:\s+[\w:.-]+\s*=\s*(?:"[^"]*"|'[^']*'))*?\s+{attribute}\s*=\s*["']{value}["']""")
