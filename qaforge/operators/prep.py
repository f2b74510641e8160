"""Corpus and label preparation.

Word splitting packs whole sentences greedily into pieces of at most
``split_length`` words. The packing is sequential within a document, so it
runs as one ``aggregate`` over the document's sentence word counts; the
accumulator only grows when a new piece starts, so a long document costs
O(sentences + pieces^2), not O(sentences^2).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize_answer

# Split defaults and the sentence / line cleanup patterns.
SPLIT_LENGTH = 300
SENTENCE_END = r"([.!?])\s+"
SENTENCE_SEP = "\u0001"
LINE_EDGE_SPACE = r"[ \t\r\f]*\n[ \t\r\f]*"
MANY_NEWLINES = r"\n{3,}"


def clean_for_index(passages: DataFrame) -> DataFrame:
    """Rows for a search index (C1): ``passage_id, document_text`` normalized."""
    return passages.select("passage_id", normalize_answer(F.col("text")).alias("document_text"))


def clean_document(text: Column) -> Column:
    """Strip every line, drop leading/trailing whitespace, >= 3 newlines -> 2."""
    stripped = F.regexp_replace(F.coalesce(text, F.lit("")), LINE_EDGE_SPACE, "\n")
    trimmed = F.regexp_replace(stripped, r"^\s+|\s+$", "")
    return F.regexp_replace(trimmed, MANY_NEWLINES, "\n\n")


def sentences(text: Column) -> Column:
    return F.split(F.regexp_replace(text, SENTENCE_END, "$1" + SENTENCE_SEP), SENTENCE_SEP)


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, r"\s+"), lambda t: t != F.lit("")))


def split_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                split_length: int = SPLIT_LENGTH) -> DataFrame:
    """Pieces of at most ``split_length`` words on sentence boundaries (C2);
    a longer sentence stays whole; no overlap. Output: ``<id>, split_idx,
    n_words, content`` (empty pieces dropped)."""
    sents = sentences(clean_document(F.col(text_col)))
    with_wc = docs.select(F.col(id_col), sents.alias("s")) \
        .withColumn("wc", F.transform("s", lambda x: word_count(x)))
    n = F.size("wc")
    init = F.struct(F.lit(0).alias("cur"), F.lit(0).alias("i"), F.array(F.lit(0)).alias("starts"))

    def step(acc, w):
        # the word counts are the aggregate's input, evaluated once per row;
        # the accumulator array grows only when a piece starts
        new_piece = (acc["cur"] > 0) & (acc["cur"] + w > split_length)
        return F.when(new_piece, F.struct(w.alias("cur"), (acc["i"] + 1).alias("i"),
                                          F.array_append(acc["starts"], acc["i"]).alias("starts"))) \
            .otherwise(F.struct((acc["cur"] + w).alias("cur"), (acc["i"] + 1).alias("i"),
                                acc["starts"].alias("starts")))

    starts = F.aggregate(F.col("wc"), init, step)["starts"]
    packed = with_wc.withColumn("starts", starts)

    # pieces are cut inside the row, so that no copy of the whole document is exploded
    def piece(b, i):
        length = F.coalesce(F.try_element_at("starts", i + 2), n) - b
        return F.struct(F.aggregate(F.slice("wc", b + 1, length), F.lit(0), lambda a, x: a + x).alias("n_words"),
                        F.array_join(F.slice("s", b + 1, length), " ").alias("content"))

    out = packed.select(id_col, F.posexplode(F.transform("starts", piece)).alias("split_idx", "piece"))
    return out.select(id_col, F.col("split_idx").cast("int"), "piece.n_words", "piece.content").where(F.col("content") != "")


def label_rows(examples: DataFrame) -> DataFrame:
    """One label per gold answer, or one no-answer label (C4)."""
    return examples.select(
        "id", F.col("question").alias("query"), "document_id",
        F.explode_outer("answers.text").alias("answer")) \
        .select("id", "query", "document_id",
                F.coalesce(F.col("answer"), F.lit("")).alias("answer"),
                F.col("answer").isNull().alias("no_answer"),
                F.lit(True).alias("is_correct_answer"), F.lit(True).alias("is_correct_document"),
                F.lit("gold-label").alias("origin"))


def aggregate_labels(labels: DataFrame) -> DataFrame:
    """Drop negative and no-answer labels (P11), then one row per question
    text with its distinct answers and documents (A14)."""
    kept = labels.where(~F.col("no_answer") & F.col("is_correct_answer") & F.col("is_correct_document"))
    return kept.groupBy("query").agg(
        F.count(F.lit(1)).alias("n_labels"),
        F.array_sort(F.collect_set("answer")).alias("answers"),
        F.array_sort(F.collect_set("document_id")).alias("document_ids"))


def squad_records(examples: DataFrame) -> DataFrame:
    """SQuAD-shaped records, first answer only (S7). A row without answers
    gets an empty answer list and ``is_impossible = true`` (Q12)."""
    first_text = F.try_element_at("answers.text", F.lit(1))
    first_start = F.try_element_at("answers.answer_start", F.lit(1))
    answers = F.when(first_text.isNull(), F.array().cast("array<struct<text:string,answer_start:int>>")) \
        .otherwise(F.array(F.struct(first_text.alias("text"), first_start.alias("answer_start"))))
    qa = F.struct(F.col("question").alias("question"), F.col("id").alias("id"), answers.alias("answers"),
                  first_text.isNull().alias("is_impossible"))
    para = F.struct(F.array(qa).alias("qas"), F.col("context").alias("context"))
    return examples.select("id", F.struct(F.col("title").alias("title"),
                                          F.array(para).alias("paragraphs")).alias("record"))


def difficulty_pairs(preds: DataFrame, gold: DataFrame) -> DataFrame:
    """Prediction / first-gold pairs joined on id (C5, J5), with raw string
    equality (P8): empty or missing strings never count as equal (Q9)."""
    g = gold.select(F.col("id").alias("target_id"),
                    F.try_element_at("answers.text", F.lit(1)).alias("target_label"))
    p = preds.select(F.col("id").alias("pred_id"), F.col("prediction_text").alias("pred_label"))
    pairs = p.join(g, F.col("pred_id") == F.col("target_id"))
    em = ((F.col("pred_label") == F.col("target_label")) & (F.col("pred_label") != "")
          & F.col("target_label").isNotNull())
    return pairs.withColumn("em", F.coalesce(em, F.lit(False)).cast("int"))


def curriculum_split(examples: DataFrame, pairs: DataFrame) -> DataFrame:
    """Examples split into easy (correct) and hard (wrong) by id (C6, P9):
    ``left_semi`` joins instead of list scans. Adds ``difficulty``."""
    easy = examples.join(pairs.where("em = 1").select(F.col("pred_id").alias("id")), "id", "left_semi")
    hard = examples.join(pairs.where("em = 0").select(F.col("pred_id").alias("id")), "id", "left_semi")
    return easy.withColumn("difficulty", F.lit("easy")).unionByName(
        hard.withColumn("difficulty", F.lit("hard")))
