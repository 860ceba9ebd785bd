"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from engrama.llm import alignment, ann, chat, decontam, html_text, lang_id, line_dedup, near_dup, packing, quality, records, toxicity, trie
from engrama.llm.oracles import ORACLES  # noqa: F401  read with QUERIES
from engrama.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = f"{chat.END}{chat.START}assistant ok"
    own = spark.range(1).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.explode(F.array(
            F.struct(F.lit(0).cast("bigint").alias("turn"), F.lit("user").alias("role"), F.lit(said).alias("text")),
            F.struct(F.lit(1).cast("bigint").alias("turn"), F.lit("assistant").alias("role"), F.lit(said).alias("text")),
        )).alias("t"),
    ).select("conv_id", "t.*")
    return chat.read_back(chat.examples(talks.unionByName(own)))


def op2_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_read(spark, sf_dir, "documents"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_read(spark, sf_dir, "pages"))


def op4_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.token_records(_read(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "text", "line_dedup.n_lines", "line_dedup.n_removed")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _read(spark, sf_dir, "embeddings")
    return ann.search(vectors.where("vec_id % 20 = 0"), vectors)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.identify(_read(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_read(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(_read(spark, sf_dir, "documents"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words", "base_failed", "kept",
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(_read(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (
        op1_chat_format, op2_near_dup, op3_html_text, op4_token_records, op5_line_dedup, op6_toxicity, op7_ann,
        op8_decontamination, op9_language_id, op10_packing, op11_alignment, op12_quality_rules, op13_prefix_trie,
    )
}
