"""The corpus pipeline: from raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns the documents that go on; what it returns is written and read again as
the next one's ``docs``. Rows that hold NULL or empty text pass all filters; the tables ``labels`` and ``benchmark`` may be
empty. See the operators for what each does in detail.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.llm import bpe, decontaminate, near_duplicates, suffix_array, toxicity
from salescope.llm.queries import BYTE_BPE, table
from salescope.sources.scratch import materialize


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the toxicity classifier rejects."""
    return toxicity.remove(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates on shingles of five words."""
    return near_duplicates.remove(docs, words=5)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the copies of strings of 200 bytes after the first; ``n_chars`` follows the text."""
    return suffix_array.remove(docs).withColumn("n_chars", F.length("text").cast("long"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a passage of the benchmark."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of the bytes they decode to."""
    return bpe.round_trip(docs, public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("toxicity", clean),
    ("near_duplicates", distinct),
    ("suffix_array", unrepeated),
    ("decontamination", decontaminated),
    ("byte_bpe", encoded),
]
# SQL cannot express the classifier, the pattern of the tokenizer or its merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
