"""Retrieved-set assembly and gold checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_MAX_ROWS, bounded_broadcast, rounded


def with_text(ranked: DataFrame, passages: DataFrame,
              max_broadcast_rows: int = BROADCAST_MAX_ROWS, bound_rows: int | None = None) -> DataFrame:
    """Ranked ids joined to passage text (J1). The ranked side is k rows per
    query; it is broadcast when its size bound allows, so the passages are
    read in place and only the k hit texts per query travel. ``bound_rows``
    (questions x k) avoids counting -- and so re-running -- the ranking."""
    if bound_rows is not None:
        small = F.broadcast(ranked) if bound_rows <= max_broadcast_rows else ranked
    else:
        small = bounded_broadcast(ranked, max_broadcast_rows)
    return small.join(passages.select("passage_id", "text"), "passage_id")


def assemble(ranked_text: DataFrame, questions: DataFrame, qid_col: str = "qid",
             gold_col: str | None = None) -> DataFrame:
    """One row per question (R13): ``context_id`` / ``scores`` in rank order,
    ``context`` = texts joined by one space (A7, A8). With a gold column,
    adds ``contained`` (P6), ``answer_index`` (P7: the 0-based position of the
    retrieved passage that equals the gold text, else -1),
    ``containing_index`` (of the first one that contains it) and
    ``top1_equal``."""
    packed = F.array_sort(F.collect_list(F.struct("rank", "passage_id", "score", "text")))
    per_q = ranked_text.groupBy("qid").agg(packed.alias("hits"))
    out = (questions.withColumnRenamed(qid_col, "qid").join(per_q, "qid", "left")
           .withColumn("hits", F.coalesce(F.col("hits"), F.array().cast(per_q.schema["hits"].dataType)))
           .withColumn("context_id", F.transform("hits", lambda h: h["passage_id"]))
           .withColumn("scores", F.transform("hits", lambda h: h["score"]))
           .withColumn("context", F.array_join(F.transform("hits", lambda h: h["text"]), " ")))
    if gold_col:
        gold = F.col(gold_col)
        first = F.array_position(F.transform("hits", lambda h: h["text"].contains(gold)), True)
        equal = F.array_position(F.transform("hits", lambda h: h["text"] == gold), True)
        out = (out.withColumn("contained", F.col("context").contains(gold))
               .withColumn("answer_index", (equal - 1).cast("int"))
               .withColumn("containing_index", (first - 1).cast("int"))
               .withColumn("top1_equal", equal == 1))
    return out.drop("hits")


def gold_scaled_score(assembled: DataFrame, index_col: str = "containing_index") -> DataFrame:
    """Min-max scaled score of the gold passage per hit query (A10 rows)."""
    lo, hi = F.array_min("scores"), F.array_max("scores")
    at = F.try_element_at("scores", F.col(index_col) + 1)
    return (assembled.where(F.col(index_col) >= 0)
            .select("qid", rounded(F.when(hi == lo, F.lit(0.0))
                                   .otherwise((at - lo) / (hi - lo))).alias("gold_scaled")))


def hit_rate(assembled: DataFrame) -> DataFrame:
    """Share of questions whose gold is inside the joined context, share whose
    first passage equals the gold (A9), and the mean scaled gold score over
    hits (A10; null when there is no hit)."""
    scaled = gold_scaled_score(assembled)
    per_q = assembled.select("qid", "contained", "top1_equal").join(scaled, "qid", "left")
    return per_q.agg(
        F.count(F.lit(1)).alias("n_questions"),
        F.sum(F.col("contained").cast("int")).alias("hits"),
        rounded(F.avg(F.col("contained").cast("double"))).alias("hit_rate"),
        rounded(F.avg(F.col("top1_equal").cast("double"))).alias("top1_equal_rate"),
        rounded(F.avg("gold_scaled")).alias("gold_score_mean"))
