"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.llm import (
    bpe,
    chat,
    decontaminate,
    html_text,
    mixing,
    near_duplicates,
    neighbours,
    repair,
    runs,
    substring,
    suffix_array,
    token_ids,
    toxicity,
)
from salescope.llm.oracle_sql import ORACLE
from salescope.sources.scratch import new_path

BYTE_BPE, WORD_BPE = "byte_bpe_multi_50k.tiktoken", "word_bpe_49k.json"
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def passages(spark: SparkSession, folder: str) -> DataFrame:
    found = substring.deduplicate(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def byte_strings(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = suffix_array.deduplicate(docs, keep="none", whole_characters=False)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def near_copies(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.find(table(spark, folder, "documents"), words=4)


def chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    roles = F.posexplode(F.array(F.lit("user"), F.lit("assistant"))).alias("turn", "role")
    extra = spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"), roles)
    extra = extra.select("conv_id", F.col("turn").cast("long"), "role", F.lit(CONTROL_TEXT).alias("text"))
    return chat.digests(chat.expand(rows.unionByName(extra)))


def token_id_files(spark: SparkSession, folder: str) -> DataFrame:
    files = new_path(spark, "token_ids")
    token_ids.write_ids(table(spark, folder, "documents"), public_tokenizers.path(WORD_BPE), files)
    return token_ids.read_digests(spark, files)


def toxicity_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        toxicity.is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.REJECTED).cast("int").alias("predicted"),
    )


def benchmark_passages(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def page_texts(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages"))


def byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return bpe.round_trip(docs, public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN)


def nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.top_k(table(spark, folder, "embeddings"), F.col("id") % 50 == 0, 5)


def periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return runs.digests(runs.find(runs.looped_tail(table(spark, folder, "documents"))))


def source_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).drop("source")


def conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return repair.digests(repair.damaged(rows), rows)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_substring_dedup": passages,
        "op2_chat_formatting": chat_formatting,
        "op3_suffix_array_dedup": byte_strings,
        "op4_token_id_files": token_id_files,
        "op5_toxicity": toxicity_scores,
        "op6_benchmark_passages": benchmark_passages,
        "op7_near_duplicates": near_copies,
        "op8_page_texts": page_texts,
        "op9_byte_bpe": byte_bpe,
        "op10_nearest_vectors": nearest_vectors,
        "op11_periodic_runs": periodic_runs,
        "op12_source_mixture": source_mixture,
        "op13_conversation_repair": conversation_repair,
    }


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
