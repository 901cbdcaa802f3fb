"""Training text from raw documents, in five stages.

Each stage works on all that the one before kept, is written as Parquet and read again. ``run`` applies
them to the ``documents`` table of a folder.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from framesift.llm import compression_quality, jaccard_join, line_dedup, mixing, pieces  # noqa: E402
from framesift.llm.common import first_free, has_words, table  # noqa: E402
from framesift.session import materialise  # noqa: E402

PIECES = "/opt/tokenizers/piece_bpe_32k.model"
NEAR_GRAM = 5
NEAR_PERCENT = 80


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose quality score is below the threshold."""
    model = compression_quality.fit(docs, table(spark, sf_dir, "labels"))
    kept = compression_quality.score_column(model, F.col("text")) >= compression_quality.THRESHOLD
    return docs.filter(kept)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated lines out of the texts. A document that loses its last word goes; one that had
    none stays as it was."""
    deduped = line_dedup.dedup_lines(docs)
    changed = (F.col("n_repeated") + F.col("n_near")) > 0
    kept = deduped.filter(~changed | has_words(F.col("text")))
    return kept.withColumn("n_chars", F.when(changed, F.char_length("text").cast("bigint")).otherwise(F.col("n_chars"))).select(*docs.columns)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of smallest id of each group of near duplicates, once: texts whose five-word
    shingles have a Jaccard similarity of 0.8 or more. Repeated rows stay once; different texts under
    one id all stay if that id does. Rows without an id are linked with nothing and all stay."""
    groups = jaccard_join.near_groups(docs, gram=NEAR_GRAM, percent=NEAR_PERCENT)
    first = groups.filter(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    again = first_free(docs.columns, "_again")
    place = F.row_number().over(Window.partitionBy("doc_id", F.xxhash64("text")).orderBy(F.lit(1)))
    kept = docs.join(first, "doc_id", "left_semi").withColumn(again, place).filter(F.col(again) == 1).select(*docs.columns)
    return kept.union(docs.filter(F.col("doc_id").isNull()))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Gives each document out as often as the mix wants it."""
    return mixing.mix(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes every text."""
    return pieces.encode(docs.select("doc_id", "lang", "source", "text"), PIECES).drop("text")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup_stage),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("mix_sources", mix_sources),
    ("sentencepiece", sentencepiece),
]

# Compressed sizes, edit joins and subword pieces are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
