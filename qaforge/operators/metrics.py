"""Answer scoring: EM / character F1 / SQuAD word F1, report.

A metric is a ``(Column, Column) -> Column`` function (F2); the best score
over several gold answers is ``array_max(transform(golds, g -> metric))``
inside the row, so no explode and no shuffle per gold.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as TX
from .common import rounded

Metric = Callable[[Column, Column], Column]


def best_over_golds(metric: Metric, pred: Column, golds: Column) -> Column:
    """Best metric over the gold answers (A11); 0 when there is no gold (Q13)."""
    return F.coalesce(F.array_max(F.transform(golds, lambda g: metric(pred, g).cast("double"))),
                      F.lit(0.0))


def per_question(gold: DataFrame, preds: DataFrame, id_col: str = "id",
                 golds_col: str = "answers.text", pred_col: str = "prediction_text",
                 em: Metric = TX.exact_match, f1: Metric = TX.char_f1) -> DataFrame:
    """One row per gold question (E8): ``id, prediction_text, em, f1, answered``.
    A question missing from the predictions scores 0 and has answered=false."""
    p = preds.select(F.col(id_col).alias("_pid"), F.col(pred_col).alias("prediction_text"))
    j = gold.select(F.col(id_col).alias("id"), F.col(golds_col).alias("golds")) \
        .join(p, F.col("id") == F.col("_pid"), "left")
    pred = F.col("prediction_text")
    answered = F.col("_pid").isNotNull()
    return j.select(
        "id", "prediction_text",
        F.when(answered, best_over_golds(em, pred, F.col("golds"))).otherwise(0.0).alias("em"),
        F.when(answered, best_over_golds(f1, pred, F.col("golds"))).otherwise(0.0).alias("f1"),
        answered.alias("answered"))


def unanswered(gold: DataFrame, preds: DataFrame, id_col: str = "id") -> DataFrame:
    """Gold questions without a prediction (J4), reported as rows."""
    return gold.select(id_col).join(preds.select(id_col), id_col, "left_anti")


def report(scores: DataFrame) -> DataFrame:
    """Corpus EM / F1 over all gold questions (A12) and the JSON report with
    percent strings (E4)."""
    agg = scores.agg(F.count(F.lit(1)).alias("n_questions"),
                     F.avg("em").alias("em"), F.avg("f1").alias("f1"))

    def entry(col: str, rank: bool) -> Column:
        return F.struct(F.format_string("%.2f%%", F.col(col) * 100).alias("value"),
                        F.lit(rank).alias("rank"), F.lit(True).alias("decs"))

    return agg.select(
        "n_questions", rounded(F.col("em")).alias("em"), rounded(F.col("f1")).alias("f1"),
        F.to_json(F.struct(entry("em", True).alias("EM"), entry("f1", False).alias("F1"))).alias("report"))


def squad_scores(gold: DataFrame, preds: DataFrame, id_col: str = "id") -> DataFrame:
    """SQuAD exact match and word F1 on a 0-100 scale (E5)."""
    per = per_question(gold, preds, id_col, em=TX.squad_em, f1=TX.squad_f1)
    return per.agg(rounded(F.avg("em") * 100).alias("exact_match"),
                   rounded(F.avg("f1") * 100).alias("f1"))


def reader_topk_metrics(answers: DataFrame, gold: DataFrame, id_col: str = "id",
                        k: int | None = None) -> DataFrame:
    """Reader EM / F1 of the top-k answers per question (E7): the best over
    the first k answers and all golds. A gold question without an answer
    scores 0."""
    a = answers if k is None else answers.where(F.col("rank") <= k)
    per = (a.join(gold.select(F.col(id_col), F.col("answers.text").alias("golds")), id_col)
           .select(id_col, best_over_golds(TX.exact_match, F.col("text"), F.col("golds")).alias("em"),
                   best_over_golds(TX.char_f1, F.col("text"), F.col("golds")).alias("f1"))
           .groupBy(id_col).agg(F.max("em").alias("em"), F.max("f1").alias("f1")))
    every = gold.select(id_col).join(per, id_col, "left").na.fill(0.0, ["em", "f1"])
    return every.agg(F.count(F.lit(1)).alias("n_questions"),
                     rounded(F.avg("em")).alias("em"), rounded(F.avg("f1")).alias("f1"))
