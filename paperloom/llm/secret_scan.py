"""Secret scans over an incremental ledger of blobs.

Every version of every text is addressed by its content (SHA-256). The ledger holds one row for each blob and
rule version that was scanned, with the spans found. A scan takes the blobs whose pair with the rules' version
the ledger lacks, scans each once however many paths hold it, appends them, and joins the findings back to all
paths. The rules' version is a digest of the patterns, so changed rules never meet old findings. All of it is
DataFrame functions.

Places: the text is split by a rule's pattern; a match starts where the pieces and matches before it end. Both
functions walk leftmost and without overlap, lengths are in code points, and the ends are running sums over a
blob's matches, which stand as rows until then: work is in proportion to the text, and no pattern repeats a group
(Java's matcher recurses there) or can run far from many starts.

Defined cases: a null text is the empty blob, which has no findings. A null id stays null. Repeated rows each
get their blob's findings. A path's older versions are rows of the same path, scanned as blobs of their own.
Texts are scanned whole, however long. Other columns are ignored, those called blob, found or text included.
Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from paperloom.llm.common import stage_table


@dataclass(frozen=True)
class Rule:
    """kind; pattern; which group must have `least` characters for a match to count."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The base rules, then further formats of well-known credentials, each a pattern of its own.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
MORE = (
    Rule("pem", r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----"),
    Rule("github", r"gh[opusr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ(?:hbGciOi|0eXAiOi|raWQiOi)[A-Za-z0-9_-]{1,400}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
SPAN = "struct<start:int,rule:int,end:int,kind:string>"
SPANS = f"array<{SPAN}>"


@dataclass(frozen=True)
class RuleSet:
    rules: tuple[Rule, ...] = BASE + MORE

    @property
    def version(self) -> str:
        """A digest of all that decides what a rule finds."""
        said = repr([(r.kind, r.pattern, r.group, r.least) for r in self.rules])
        return hashlib.sha256(said.encode()).hexdigest()[:16]


def address(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _steps(text: Column, at: int, rule: Rule) -> Column:
    """Of one rule's matches in order: what stands between a match and the one before, its size, and what is judged."""
    whole = F.regexp_extract_all(text, F.lit(f"({rule.pattern})"), F.lit(1))
    judged = whole if not rule.group else F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    # Of the pieces between matches, the last stands after all of them and meets a null.
    both = F.arrays_zip(F.split(text, rule.pattern, -1).alias("g"), whole.alias("m"), judged.alias("j"))
    step = F.transform(
        both,
        lambda x, i: F.struct(
            F.lit(at).alias("rule"), i.alias("place"), F.length(x["g"]).alias("gap"), F.length(x["m"]).alias("size"), F.length(x["j"]).alias("judged")
        ),
    )
    return F.when(F.rlike(text, F.lit(rule.pattern)), F.filter(step, lambda x: x["size"].isNotNull()))


def find_spans(blobs: DataFrame, rules: RuleSet, *, blob_col: str = "blob", text_col: str = "text") -> DataFrame:
    """blob, found (all spans by start and then by the rules' order) of every row; blobs are different.

    Where the rows are dealt out by blob, the running sums and the lists need no further exchange.
    """
    text = F.col(text_col)
    none = F.array().cast("array<struct<rule:int,place:int,gap:int,size:int,judged:int>>")
    steps = F.concat(*[F.coalesce(_steps(text, i, r), none) for i, r in enumerate(rules.rules)])
    rows = blobs.select(F.col(blob_col).alias("blob"), F.explode_outer(steps).alias("s")).select("blob", "s.*")
    end = F.sum(F.col("gap") + F.col("size")).over(Window.partitionBy("blob", "rule").orderBy("place").rowsBetween(Window.unboundedPreceding, 0))
    one = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("rule") + 1)
    rows = rows.withColumns({"end": end.cast("int"), "least": one(r.least for r in rules.rules), "kind": one(r.kind for r in rules.rules)})
    span = F.struct((F.col("end") - F.col("size")).alias("start"), "rule", "end", "kind")
    return rows.groupBy("blob").agg(F.array_sort(F.collect_list(F.when(F.col("judged") >= F.col("least"), span))).alias("found"))


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], f"blob string, version string, found {SPANS}")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger in a folder; an empty one where nothing was written yet."""
    try:
        return spark.read.schema(empty_ledger(spark).schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_ledger(spark)


def scan_unseen(texts: DataFrame, ledger: DataFrame | None, rules: RuleSet, *, text_col: str = "text") -> DataFrame:
    """Ledger rows for the blobs whose pair with the rules' version is not in the ledger yet."""
    blobs = texts.select(address(F.col(text_col)).alias("blob"), F.coalesce(text_col, F.lit("")).alias("text"))
    blobs = blobs.groupBy("blob").agg(F.first("text").alias("text"))
    if ledger is not None:
        seen = ledger.filter(F.col("version") == rules.version).select("blob")
        blobs = blobs.join(seen, "blob", "left_anti")
    return find_spans(blobs, rules).select("blob", F.lit(rules.version).alias("version"), F.col("found").cast(SPANS).alias("found"))


def scan(
    texts: DataFrame, ledger: DataFrame | str | None = None, rules: RuleSet | None = None, *, path_col: str = "doc_id", text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """(path, blob and spans of every row of texts; the ledger with the rows of this scan).

    A ledger given as a folder is read there and grows there by this scan's rows; a scan that is repeated after a
    failure finds what was written and scans the rest. Else the new rows are written to the shared folder before the
    join back, so that both sides of that join are plain exchanges which Spark can split where many paths share a
    blob; blobs without a finding stay out of it.
    """
    rules, spark = rules or RuleSet(), texts.sparkSession
    if isinstance(ledger, str):
        scan_unseen(texts, read_ledger(spark, ledger), rules, text_col=text_col).write.mode("append").parquet(ledger)
        grown = read_ledger(spark, ledger)
    else:
        fresh = stage_table(scan_unseen(texts, ledger, rules, text_col=text_col), "ledger")
        grown = fresh if ledger is None else ledger.unionByName(fresh)
    found = grown.filter((F.col("version") == rules.version) & (F.size("found") > 0)).select("blob", "found")
    paths = texts.select(F.col(path_col), address(F.col(text_col)).alias("blob"))
    joined = paths.join(found, "blob", "left")
    return joined.select(path_col, "blob", F.coalesce("found", F.array().cast(SPANS)).alias("found")), grown


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame, rules: RuleSet | None = None, path_col: str = "doc_id") -> DataFrame:
    """Counts of the base rules' spans, the hash of their list, and the list of all spans."""
    base = F.filter("found", lambda s: s["rule"] < len(BASE))
    count = lambda i: F.size(F.filter("found", lambda s: s["rule"] == i)).cast("long")
    return found.select(
        path_col, *[count(i).alias(f"n_{r.kind}") for i, r in enumerate(BASE)],
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"),
    )
