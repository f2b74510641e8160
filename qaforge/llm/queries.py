"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from . import (chat_format, decontaminate, embedding_whitening, html_text, importance_resample, jaccard_join, language_id,
               line_dedup, maxscore, sentencepiece_nbest, substring_automata, suffix_dedup, url_filter)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.fit(docs))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.dedup_lines(docs, counts=True)
    return out.select("doc_id", F.sha2("text", 256).alias("kept_sha256"), "n_lines", "n_removed", "n_chunks_removed")


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), url_filter.rules_frame(spark))


def op5_sentencepiece_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the number of pieces, a digest of the best path's ids, and scores and sizes of the n best."""
    out = sentencepiece_nbest.encode(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_pieces", F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
                      "scores", "sizes", "round_trip")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.search_table(table(spark, sf_dir, "embeddings"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = chat_format.format_chats(table(spark, sf_dir, "conversations"))
    return out.select("conv_id", "turn", "source_role", "piece", "role", "action",
                      F.sha2("rendered", 256).alias("rendered_sha256"), F.length("rendered").alias("n_chars"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.dedup_substrings(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", (F.col("n_removed") > 0).alias("has_repeat"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_documents(table(spark, sf_dir, "documents"))


def op11_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_substring_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_automata.dedup_runs(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256", (F.col("n_removed") > 0).alias("has_repeat"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_line_dedup": op2_line_dedup,
    "op3_html_text": op3_html_text,
    "op4_url_filter": op4_url_filter,
    "op5_sentencepiece_nbest": op5_sentencepiece_nbest,
    "op6_decontaminate": op6_decontaminate,
    "op7_maxscore": op7_maxscore,
    "op8_chat_format": op8_chat_format,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_importance_resample": op11_importance_resample,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_substring_automata": op13_substring_automata,
}
ORACLE: dict[str, str] = {
    "op2_line_dedup": line_dedup.ORACLE,
    "op4_url_filter": url_filter.ORACLE,
    "op6_decontaminate": decontaminate.ORACLE,
    "op7_maxscore": maxscore.ORACLE,
    "op8_chat_format": chat_format.ORACLE,
    "op9_suffix_dedup": suffix_dedup.ORACLE,
    "op10_jaccard_join": jaccard_join.ORACLE,
    "op11_importance_resample": importance_resample.ORACLE,
    "op13_substring_automata": substring_automata.ORACLE,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
