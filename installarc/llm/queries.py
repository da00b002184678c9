"""Registered queries of this subpackage, as ``(spark, table directory) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from installarc.llm import chat, decontamination, katz, language, lines, merkle, mixing, neardup, neighbours, repair, reputation, sharding, warc
from installarc.llm.oracles import ORACLES as ORACLES
from installarc.llm.common import WORD, crc_remainder
from installarc.sources.tables import Staging


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    words = F.regexp_count(F.col("text"), F.lit(WORD))
    counted = docs.select("doc_id", "source", F.coalesce(words, F.lit(0)).alias("words"))
    mixed = mixing.mix(counted, F.col("words"), (5.0, 2.0, 1.0), 1.5, 2.0)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op2_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = chat.perspectives(table(spark, sf_dir, "conversations"))
    spans = F.transform("spans", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string")))
    return shown.withColumn("spans", F.array_join(spans, ","))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontamination.contamination(docs, items)
    return found.select(
        F.col("doc").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op4_identify_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", crc_remainder(F.col("doc_id"), 4) == 2)
    model = language.train(docs.filter(~F.col("held_out")))
    return language.predict(docs.select("doc_id", "text", "held_out"), model).drop("text")


def op5_score_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_remainder(F.col("doc_id"), 7) == 2
    found = katz.katz_scores(table(spark, sf_dir, "documents"), ~held_out)
    return found.select(
        F.col("doc").alias("doc_id"),
        (~F.col("learns")).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


RULES = (
    reputation.Rule("allow", "com", "/"),
    reputation.Rule("block", "example.com", "/en/"),
    reputation.Rule("allow", "www.example.com", "/en/"),
    reputation.Rule("block", "net", "/es/"),
    reputation.Rule("block", "net", "/fr/"),
)


def op6_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes: the labels whose doc_id is the page's id; bad is low quality or toxic."""
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), bad.cast("int").alias("bad"))
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return reputation.judge(pages, outcomes, RULES).select("page_id", "host", "path", "rule", "verdict", "basis")


def op7_dedup_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_removed", F.array_join("removed", ",").alias("removed"), "clean_text")


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)
    return found.select(F.col("doc").alias("doc_id"), "n_shingles", "component_id", "kept")


def op9_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    placed = sharding.shard(rows, 24, spare="text_crc32")
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", F.col("slot").cast("long").alias("slot"), "grown_shard")


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.search(vectors, F.col("vec_id") % 50 == 0)


def op11_warc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to archives, and what their records say when read back."""
    pages, path = table(spark, sf_dir, "pages"), Staging(spark).folder()
    warc.write(pages, path)
    kind = pages.schema["page_id"].dataType
    return warc.resolved(warc.read(spark, path).records).select(
        F.col("page_id").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof, and whether its text of a later reading, which lost line feeds, still leads to the root."""
    lost = F.when(crc_remainder(F.col("doc_id"), 2) == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    rows = merkle.manifest(table(spark, sf_dir, "documents"), found={"text": lost})
    back = merkle.folded(F.col("path"), F.col("found_leaf"))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", merkle.digest(merkle.proof(F.col("path"))).alias("proof_sha256"), back.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def damaged(turns: DataFrame) -> DataFrame:
    """``conversations`` with some rows dropped, emptied, cut, repeated or given to the user, by the hash of their place."""
    spaced = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    fate = F.crc32(F.concat(spaced[0], F.lit(":"), spaced[1]).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", spaced[2].alias("role"), spaced[3].alias("text"), fate.alias("fate")).filter("fate <> 0")
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("fate") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def op13_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    found = repair.repair(damaged(turns))
    asked = turns.select("conv_id").distinct().withColumn("key", repair.conversation_key(F.col("conv_id")))
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return (
        asked.join(found.report.drop("conv_id"), "key", "left")
        .join(repair.joined_hashes(found.edits), "key", "left")
        .select(
            "conv_id",
            *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
        )
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_mix_sources, op2_chat_perspectives, op3_decontaminate, op4_identify_language, op5_score_language_model, op6_host_reputation, op7_dedup_lines, op8_near_duplicates, op9_shard, op10_nearest, op11_warc_records, op12_merkle_manifest, op13_repair_conversations)
}
