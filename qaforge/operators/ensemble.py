"""Min-max scaling per (query, retriever) and the max-merge ensemble."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import rounded, top_n

# Fixed value: the ensemble's retrievers, in the order their lists are
# concatenated (this order breaks score ties).
ENSEMBLE_METHODS = ("tfidf", "bm25", "bm25_plus")


def minmax_scaled(ranked: DataFrame, group=("qid", "retriever")) -> DataFrame:
    """Adds ``scaled = (score - min) / (max - min)`` per group; a constant
    group scales to 0.0. Rows of one group are k rows, so the window is small."""
    w = Window.partitionBy(*group)
    lo, hi = F.min("score").over(w), F.max("score").over(w)
    return ranked.withColumn(
        "scaled", rounded(F.when(hi == lo, F.lit(0.0)).otherwise((F.col("score") - lo) / (hi - lo))))


def max_merge(lists: dict[str, DataFrame], k: int, strict: bool = False) -> DataFrame:
    """Concatenate per-retriever top-k lists, scale each, keep every passage
    once with its best scaled score, re-rank, keep k.

    Ties follow the concatenation order (retriever order, then rank), as a
    stable sort over the concatenated lists would. Output: ``qid, rank,
    passage_id, score`` where score is the kept scaled score. A query with
    fewer than k distinct passages keeps what it has (see ``short_queries``),
    or is an error with ``strict`` (T6).
    """
    parts = []
    for i, (name, df) in enumerate(lists.items()):
        parts.append(df.select("qid", "rank", "passage_id", "score",
                               F.lit(name).alias("retriever"), F.lit(i).alias("r_idx")))
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    scaled = minmax_scaled(union)
    best = (scaled.groupBy("qid", "passage_id")
            .agg(F.max(F.struct(F.col("scaled"), (-F.col("r_idx")).alias("r"), (-F.col("rank")).alias("n"))).alias("b"))
            .select("qid", "passage_id", F.col("b.scaled").alias("score"), "b.r", "b.n"))
    ranked = top_n(best, "qid", [F.col("score").desc(), F.col("r").desc(), F.col("n").desc()], k)
    out = ranked.select(F.col("qid").cast("long"), F.col("rank").cast("int"),
                        F.col("passage_id").cast("long"), F.col("score").cast("double"))
    if strict:
        short = short_queries(out, k).limit(1).collect()
        if short:
            raise ValueError(f"question {short[0]['qid']} has {short[0]['n']} distinct passages, fewer than {k}")
    return out


def short_queries(ranked: DataFrame, k: int) -> DataFrame:
    """Queries with fewer than k distinct passages (T6), reported as rows."""
    return (ranked.groupBy("qid").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") < k))
