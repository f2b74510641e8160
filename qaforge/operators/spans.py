"""Answer-span decoding from start/end scores.

Per window, inside the row (no explode until the pairs are filtered):
top-n start and end positions by (score desc, position asc); every valid
(start, end) pair -- both offsets present, end >= start, at most
``max_answer_len`` tokens -- becomes a candidate. Then per example:
candidates ranked by (score desc, window, start rank, end rank), which is
the order a stable sort over the window-by-window candidate list gives;
``n_best`` kept (WindowGroupLimit); answer text cut from the context by
character offsets; the "empty" fallback; softmax over the kept list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import top_n

# Decoding defaults.
N_BEST = 20
MAX_ANSWER_LEN = 30
NULL_THRESHOLD = 0.0
FALLBACK_TEXT = "empty"
NULL_WINDOW = 1 << 30  # sorts the null candidate after every real one on ties


def _top_positions(logits: Column, n: int) -> Column:
    keyed = F.transform(logits, lambda x, i: F.struct((-x).alias("k"), i.alias("idx")))
    return F.transform(F.slice(F.array_sort(keyed), 1, n), lambda s: s["idx"])


def window_candidates(features: DataFrame, n_best: int = N_BEST,
                      max_answer_len: int = MAX_ANSWER_LEN, id_col: str = "example_id",
                      best_of: int | None = None) -> DataFrame:
    """``example_id, window, si, ei, s_off, e_off, start_logit, end_logit, score``.

    ``best_of`` keeps that many of a row's candidates (score descending, then si, ei), chosen before rows are
    made of them. With a column ``token_is_max_context`` (map of position to boolean), a
    start is only taken where another window does not show more context."""
    starts = _top_positions(F.col("start_logits"), n_best)
    ends = _top_positions(F.col("end_logits"), n_best)
    off = F.col("offsets")

    def pairs(s, si, ends):
        valid = F.filter(F.transform(ends, lambda e, ei: F.struct(e.alias("e"), ei.alias("ei"))),
                         lambda c: F.get(off, s).isNotNull() & F.get(off, c["e"]).isNotNull()
                         & (c["e"] >= s) & (c["e"] - s + 1 <= max_answer_len))
        return F.transform(valid, lambda c: F.struct(
            si.alias("si"), c["ei"].alias("ei"),
            F.get(off, s)["s"].alias("s_off"), F.get(off, c["e"])["e"].alias("e_off"),
            F.get(F.col("start_logits"), s).alias("start_logit"),
            F.get(F.col("end_logits"), c["e"]).alias("end_logit")))

    if "token_is_max_context" in features.columns:
        best = F.col("token_is_max_context")
        starts = F.transform(starts, lambda s: F.when(best.isNull() | F.coalesce(F.try_element_at(best, s), F.lit(False)), s))
    # a rejected start keeps its rank and has no pairs
    # an array of one element names the ends, so that they are sorted once and not once a start
    cands = F.flatten(F.transform(F.array(ends), lambda es: F.flatten(F.transform(
        starts, lambda s, si: F.coalesce(pairs(s, si, es), F.array()) if "token_is_max_context" in features.columns else pairs(s, si, es)))))
    if best_of is not None:
        # descending, as in a window's order: nulls last, NaN first
        keyed = F.transform(cands, lambda c: F.struct((c["start_logit"] + c["end_logit"]).alias("k"), (-c["si"]).alias("a"),
                                                      (-c["ei"]).alias("b"), c.alias("c")))
        cands = F.transform(F.slice(F.sort_array(keyed, asc=False), 1, best_of), lambda x: x["c"])
    return (features.select(id_col, "window", F.explode(cands).alias("c"))
            .select(id_col, "window", "c.*")
            .withColumn("score", F.col("start_logit") + F.col("end_logit")))


def null_candidates(features: DataFrame, id_col: str = "example_id") -> DataFrame:
    """Per example the window with the smallest CLS score (first on ties)."""
    best = F.min(F.struct((F.get("start_logits", 0) + F.get("end_logits", 0)).alias("score"),
                          F.col("window").alias("w"),
                          F.get("start_logits", 0).alias("start_logit"),
                          F.get("end_logits", 0).alias("end_logit")))
    return (features.groupBy(id_col).agg(best.alias("n"))
            .select(id_col, F.lit(NULL_WINDOW).alias("window"), F.lit(0).alias("si"),
                    F.lit(0).alias("ei"), F.lit(0).alias("s_off"), F.lit(0).alias("e_off"),
                    "n.start_logit", "n.end_logit", F.col("n.score").alias("score")))


def nbest(features: DataFrame, examples: DataFrame, n_best: int = N_BEST,
          max_answer_len: int = MAX_ANSWER_LEN, with_null: bool = False,
          id_col: str = "example_id") -> DataFrame:
    """The n-best list per example.

    Output: ``example_id, rank int, text, start_logit, end_logit, score,
    probability, is_null``. With ``with_null`` the minimum null candidate
    competes, and is appended after the n-best if it was cut (D6).
    The kept candidates are written once. With ``with_null`` ``features`` is
    read twice: pass a stored table (see ``session.materialize``) then.
    """
    cands = window_candidates(features, n_best, max_answer_len, id_col)
    order = [F.col("score").desc(), F.col("window").asc(), F.col("si").asc(), F.col("ei").asc()]
    if with_null:
        nulls = null_candidates(features, id_col)
        cands = cands.unionByName(nulls)
    # read by several steps below; a few short rows an example, written once
    kept = materialize(top_n(cands, id_col, order, n_best, "rank"), "nbest-kept").withColumn("is_null", F.col("window") == NULL_WINDOW)
    if with_null:
        has_null = kept.where("is_null").select(id_col)
        cut = (nulls.join(has_null, id_col, "left_anti")
               .withColumn("rank", F.lit(n_best + 1)).withColumn("is_null", F.lit(True)))
        kept = kept.unionByName(cut)
    texts = examples.select(id_col, "context")
    with_text = kept.join(texts, id_col).withColumn(
        "text", F.when(F.col("is_null"), F.lit(""))
        .otherwise(F.substring(F.col("context"), F.col("s_off") + 1, F.col("e_off") - F.col("s_off"))))
    # No candidate, or a single empty one -> "empty" (score 0) goes first
    stats = with_text.groupBy(id_col).agg(F.count(F.lit(1)).alias("n"),
                                          F.max(F.length("text")).alias("maxlen"))
    needs = (examples.select(id_col).join(stats, id_col, "left")
             .where(F.col("n").isNull() | ((F.col("n") == 1) & (F.col("maxlen") == 0))))
    fallback = needs.select(id_col, F.lit(0).alias("rank"), F.lit(FALLBACK_TEXT).alias("text"),
                            F.lit(0.0).alias("start_logit"), F.lit(0.0).alias("end_logit"),
                            F.lit(0.0).alias("score"), F.lit(False).alias("is_null"))
    rows = with_text.select(id_col, "rank", "text", "start_logit", "end_logit", "score",
                            "is_null").unionByName(fallback)
    w = Window.partitionBy(id_col)
    shifted = F.exp(F.col("score") - F.max("score").over(w))
    ordered = Window.partitionBy(id_col).orderBy("rank")
    return rows.select(
        id_col, F.row_number().over(ordered).cast("int").alias("rank"), "text",
        "start_logit", "end_logit", "score", "is_null",
        (shifted / F.sum(shifted).over(w)).alias("probability"))


def best_answers(nb: DataFrame, id_col: str = "example_id") -> DataFrame:
    """Top answer per example (D9 without null answers)."""
    return nb.where(F.col("rank") == 1).select(id_col, F.col("text").alias("prediction_text"))


def null_odds(nb: DataFrame, threshold: float = NULL_THRESHOLD,
              id_col: str = "example_id") -> DataFrame:
    """With null answers allowed (D9): the best non-empty candidate against
    the null score; ``prediction_text`` is "" when the difference exceeds
    the threshold or when every candidate is empty."""
    first_non_empty = F.min_by(F.struct("start_logit", "end_logit", "text"),
                               F.when(F.col("text") != "", F.col("rank")))
    null_score = F.max(F.when(F.col("is_null"), F.col("score")))
    per = nb.groupBy(id_col).agg(first_non_empty.alias("b"), null_score.alias("null_score"))
    diff = F.col("null_score") - F.col("b.start_logit") - F.col("b.end_logit")
    return per.select(id_col, diff.alias("score_diff"),
                      F.when(F.col("b.text").isNull() | (diff > threshold), F.lit(""))
                      .otherwise(F.col("b.text")).alias("prediction_text"))


def nbest_records(nb: DataFrame, id_col: str = "example_id") -> DataFrame:
    """N-best as one typed array per example."""
    return nb.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct(
        "rank", "text", "start_logit", "end_logit", "probability"))).alias("nbest"))


__all__ = ["nbest", "best_answers", "null_odds", "nbest_records", "window_candidates", "null_candidates"]
