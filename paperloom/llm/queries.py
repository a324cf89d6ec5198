"""The queries opN_<name> and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import decontaminate, html_text, infill, line_dedup, manifest, ngram_join, pieces, quality, secret_scan, shard, topk, toxicity, url_filter
from paperloom.llm.common import table


#: The public vocabulary that the queries and the pipeline encode with.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.verdicts(found)


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = pieces.round_trip(table(spark, sf_dir, "documents"), MODEL, keep=["doc_id"])
    n_ids = F.when(F.col("ids").isNotNull(), F.size("ids")).otherwise(0).cast("long").alias("n_ids")
    return coded.select("doc_id", "ids", n_ids, "decoded_chars", "decoded_sha256", "round_trip")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = secret_scan.scan(table(spark, sf_dir, "documents"))
    return secret_scan.digest(found)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(toxicity.sample(docs, table(spark, sf_dir, "labels")))
    scored = toxicity.score_texts(docs, model)
    return scored.select("doc_id", F.coalesce(toxicity.fold(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), "score", "predicted")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.strip_lines(table(spark, sf_dir, "documents")).select("doc_id", "source", "text", "n_lines", "n_dropped")


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.classes(table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = shard.assign(table(spark, sf_dir, "documents"))
    return dealt.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = [F.replace("text", F.lit("\n"), F.lit("")) if c == "text" else F.col(c) for c in manifest.FIELDS]
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    found = manifest.manifest(docs, keep={"tampered": F.when(even, manifest.leaf(tampered))})
    back = manifest.folded(F.coalesce("tampered", "leaf"), F.col("proof"))
    out = found.select("doc_id", "leaf", "subroot", "root", F.sha2(manifest.siblings(F.col("proof")), 256).alias("proof_sha256"), back.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(*quality.sample(docs, table(spark, sf_dir, "labels")))
    held_out = F.coalesce(quality.fold(F.col("doc_id")) == 0, F.lit(False))
    return quality.score_texts(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = infill.transform(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    back = infill.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", F.col("n_tokens").alias("n"), "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (
        op1_decontamination, op2_top_k, op3_html_text, op4_sentencepiece, op5_secrets,
        op6_toxicity, op7_line_dedup, op8_ngram_join, op9_sharding, op10_url_filter,
        op11_merkle_manifest, op12_quality, op13_fill_in_middle,
    )
    return {f.__name__: f for f in ops}
