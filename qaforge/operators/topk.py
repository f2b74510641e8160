"""Exhaustive top-k per query over sparse scores.

Scores exist only for (query, passage) pairs sharing a term. Every other
passage of a query has the same "base" score (0 for Okapi/TF-IDF, a
per-query constant for BM25+/BM25L). The reference ranks all passages, so a
query with fewer than k matches is filled with base-score passages, lowest
id first. Order contract: rounded score descending, passage_id ascending.

Fill without a cross join: the k best matches of each query are written
once; only queries with fewer than k scores above their base are filled, from
the first ``2k`` passage ids (a bounded TakeOrderedAndProject, read to the
driver as a literal array) minus the ids among their k best. When no matched
score can fall below the base that is enough: at most k of the 2k ids are
among the best, and a match outside them scores the base, like its fill. When
scores can fall below the base (Okapi with a negative idf floor), a query
with m matches, fewer than k of them above the base, is filled from the
first k + m ids: passages are numbered in id order by a range sort, joined
on that number, and the query's own matches are removed by an anti-join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import top_n


def _fill_rows(top: DataFrame, base: DataFrame, passage_ids: DataFrame, k: int) -> DataFrame | None:
    """Base-score rows for the queries with fewer than k scores above their base; None if there is no such query.

    ``top`` holds each query's k best matches, which is enough: a match that
    is not among them and has the base score is the same row as its fill.
    """
    above = top.join(base, "qid").where(F.col("score") > F.col("base")).groupBy("qid").agg(F.count(F.lit(1)).alias("above"))
    need = base.join(above, "qid", "left").where(F.coalesce(F.col("above"), F.lit(0)) < k).select("qid", "base")
    if need.limit(1).count() == 0:
        return None
    empty = F.array().cast("array<long>")
    head_ids = [r[0] for r in passage_ids.orderBy("passage_id").limit(2 * k).collect()]
    head = F.array(*[F.lit(int(i)).cast("long") for i in head_ids]) if head_ids else empty
    seen = top.groupBy("qid").agg(F.collect_list("passage_id").alias("seen"))  # at most k ids
    free = F.filter(head, lambda p: ~F.array_contains(F.coalesce(F.col("seen"), empty), p))
    return need.join(seen, "qid", "left").select("qid", F.explode(F.slice(free, 1, k)).alias("passage_id"), F.col("base").alias("score"))


def numbered_ids(passage_ids: DataFrame) -> DataFrame:
    """``passage_id, no``: the passages numbered from 1 in id order, by a range sort."""
    spark = passage_ids.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(passage_ids.select("passage_id").repartitionByRange(n, "passage_id")
                         .withColumn("part", F.spark_partition_id()), "numbered-ids")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = (placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
               .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip")))
    own = F.row_number().over(Window.partitionBy("part").orderBy("passage_id"))
    return placed.withColumn("own", own).join(F.broadcast(offsets), "part").select(
        "passage_id", (F.col("own") + F.col("skip")).alias("no"))


def _fill_from_numbered(matched: DataFrame, base: DataFrame, passage_ids: DataFrame, k: int, n_passages: int) -> DataFrame:
    counts = (matched.join(base, "qid").groupBy("qid")
              .agg(F.count(F.lit(1)).alias("m"), F.count_if(F.col("score") > F.col("base")).alias("above")))
    need = (base.join(counts, "qid", "left").na.fill(0, ["m", "above"]).where(F.col("above") < k)
            .select("qid", "base", F.explode(F.sequence(F.lit(1).cast("long"), F.least(
                F.col("m") + k, F.lit(n_passages).cast("long")))).alias("no")))
    free = (need.join(numbered_ids(passage_ids), "no")
            .join(matched.select("qid", "passage_id"), ["qid", "passage_id"], "left_anti"))
    return top_n(free, "qid", [F.col("passage_id").asc()], k).select("qid", "passage_id", F.col("base").alias("score"))


def filled_topk(best: DataFrame, base: DataFrame, passage_ids: DataFrame, k: int) -> DataFrame:
    """Top-k over all passages from each query's k best matches (``qid, rank, passage_id, score``, a written table)."""
    fill = _fill_rows(best, base, passage_ids, k)
    if fill is not None:
        best = top_n(best.drop("rank").unionByName(fill), "qid", [F.col("score").desc(), F.col("passage_id").asc()], k)
    return best.select(F.col("qid").cast("long"), F.col("rank").cast("int"),
                       F.col("passage_id").cast("long"), F.col("score").cast("double"))


def exhaustive_topk(matched: DataFrame, base: DataFrame, passage_ids: DataFrame,
                    k: int, n_passages: int, can_fall_below_base: bool = False) -> DataFrame:
    """Top-k over all passages.

    matched: ``qid, passage_id, score`` (score already rounded);
    base: ``qid, base`` for every query (rounded);
    passage_ids: one ``passage_id`` column over the whole corpus.
    Output: ``qid long, rank int, passage_id long, score double``.
    """
    order = [F.col("score").desc(), F.col("passage_id").asc()]
    if can_fall_below_base:
        fill = _fill_from_numbered(matched, base, passage_ids, k, n_passages)
        ranked = top_n(matched.select("qid", "passage_id", "score").unionByName(fill), "qid", order, k)
    else:
        # one pass over the postings: the k best matches are written, what follows reads them
        best = materialize(top_n(matched.select("qid", "passage_id", "score"), "qid", order, k), "top-matches")
        return filled_topk(best, base, passage_ids, k)
    return ranked.select(F.col("qid").cast("long"), F.col("rank").cast("int"),
                         F.col("passage_id").cast("long"), F.col("score").cast("double"))


def matches_only_topk(matched: DataFrame, k: int) -> DataFrame:
    """Top-k among matched passages only (search-server style, no fill)."""
    ranked = top_n(matched, "qid", [F.col("score").desc(), F.col("passage_id").asc()], k)
    return ranked.select(F.col("qid").cast("long"), F.col("rank").cast("int"),
                         F.col("passage_id").cast("long"), F.col("score").cast("double"))


__all__ = ["exhaustive_topk", "filled_topk", "matches_only_topk"]
