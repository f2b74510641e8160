"""From raw documents to token ids: five stages, each on all that the one before kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, all but the last one with the columns of ``documents``.
``run`` writes each stage to the shared folder and reads it again.

Defined cases: a document whose text is null or has no letter is in no learned
language and goes, and so do all if no row has a label to learn from; a text
that loses all its lines stays as an empty one; a document with no word is no
copy of anything and holds no benchmark item; of rows that share doc_id and
text one stays; null ids are kept, and of near copies without any id one stays;
of a group's documents the one with the smallest doc_id stays; very long texts
are worked on whole; other columns are carried to the last stage, whatever
their names; an empty table gives an empty result. ``documents`` must have its
columns doc_id, text, lang and n_chars.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qaforge.llm import decontaminate, jaccard_join, language_id, line_dedup, sentencepiece_nbest
from qaforge.llm.common import table
from qaforge.session import materialize


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents in a learned language."""
    return language_id.keep_known(docs, language_id.fit(docs))


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut repeated multi-line chunks; n_chars follows the text."""
    return line_dedup.dedup_lines(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies."""
    return jaccard_join.keep_one(docs)


def remove_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item."""
    return decontaminate.remove_leaking(docs, table(spark, sf_dir, "benchmark"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the best segmentation, scores of the n best, and whether decoding gives the text back."""
    return sentencepiece_nbest.encode(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", remove_repeated_lines),
    ("jaccard_join", keep_one_of_near_copies),
    ("decontaminate", remove_benchmark_leaks),
    ("sentencepiece", encode_pieces),
]

#: Language ID and the encoding cannot be expressed in SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialize(docs, f"pipeline-{name}")
    return docs
