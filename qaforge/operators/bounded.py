"""Exact BM25 top-k that leaves frequent, weak terms out of the sums until bounds ask for them.

The vocabulary holds each term's greatest density (tf over relative passage
length) in any passage, so what a query term can add at most is known before
a posting is read. Per query:

1. The terms that add least for the postings they cost, together at most
   ``SHARE`` of the query's greatest sum, are set aside (the rest). Sums over
   the other, leading terms give the query's k best; the k-th is its threshold.
2. A passage whose leading sum plus the bound of the rest stays below the
   threshold cannot be among the k best. The others, few, are looked up in the
   postings of the rest by (passage, term).
3. A query whose rest could reach the threshold alone (or with fewer than k
   leading matches) is scored in full.

Leading sums are computed twice (threshold, survivors) instead of being stored:
there may be one for every second passage of the corpus. ``row_costs`` says
what either way reads; ``worth`` chooses. Results are the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from . import retrieve as R
from .common import BROADCAST_MAX_ROWS, bounded_broadcast, rounded, top_n
from .index import LENGTH_WEIGHT, SparseIndex

SHARE = 0.03
#: Scores are rounded to 6 digits before they are compared.
SLACK = 2e-6


def usable(index: SparseIndex, variant: str, params: dict | None = None) -> bool:
    """Whether bounds hold: densities are stored, the length weight is theirs, and no term lowers a score."""
    if "peak" not in index.vocab.columns or {**R.DEFAULTS[variant], **(params or {})}["b"] != LENGTH_WEIGHT:
        return False
    return variant != "okapi" or R.mean_idf_of(index) >= 0


def query_bounds(index: SparseIndex, questions: DataFrame, variant: str, share: float = SHARE) -> DataFrame:
    """qid, term, qtf, df, idf, bound and whether the term is in the rest."""
    p = R.DEFAULTS[variant]
    mean_idf = R.mean_idf_of(index) if variant == "okapi" else None
    qv = (bounded_broadcast(R.query_terms(questions, index.tokenizer)).join(index.vocab, "term")
          .withColumn("idf", R._idf(variant, index.n_docs, mean_idf, p.get("epsilon", 0.25))))
    # the contribution at the greatest density: tf = peak where the relative length is 1
    at_peak, _ = R._contribution(index, variant, p, F.col("idf"), tf=F.col("peak"), length=F.lit(1.0))
    own = Window.partitionBy("qid")
    cheapest = own.orderBy((F.col("bound") / F.col("df")).asc(), F.col("term").asc())
    return (qv.withColumn("bound", at_peak)
            .withColumn("rest", F.sum("bound").over(cheapest) <= share * F.sum("bound").over(own))
            .select("qid", "term", "qtf", "df", "idf", "bound", "rest"))


def row_costs(terms: DataFrame) -> tuple[int, int]:
    """(postings met by all terms, by the leading terms), exact from document frequencies."""
    row = terms.agg(F.sum("df").alias("all"), F.sum(F.when(~F.col("rest"), F.col("df"))).alias("lead")).first()
    return int(row["all"] or 0), int(row["lead"] or 0)


def worth(every: int, lead: int) -> bool:
    """Two passes over the leading terms and some look-ups against one pass over all."""
    return 2.5 * lead < every


def _sums(index: SparseIndex, terms: DataFrame, variant: str) -> DataFrame:
    contrib, _ = R._contribution(index, variant, R.DEFAULTS[variant], F.col("idf"))
    side = bounded_broadcast(terms.select("qid", "term", "qtf", "df", "idf"))
    postings = R.postings_of(index, terms)
    small = terms.count() <= BROADCAST_MAX_ROWS
    return (R._join_postings(side, postings, small, R.HOT_DF).groupBy("qid", "passage_id").agg(F.sum(contrib).alias("s")))


def matched_pairs(index: SparseIndex, terms: DataFrame, variant: str, k: int) -> DataFrame:
    """qid, passage_id, s (sum above the base): all pairs that can be among a query's k best, with exact sums.

    ``terms`` is a stored table of ``query_bounds``."""
    lead, rest = terms.where(~F.col("rest")), terms.where("rest")
    best = materialize(top_n(_sums(index, lead, variant), "qid", [F.col("s").desc(), F.col("passage_id").asc()], k), "bounded-best")
    goal = (terms.groupBy("qid").agg(F.sum(F.when(F.col("rest"), F.col("bound")).otherwise(0.0)).alias("more"))
            .join(best.where(F.col("rank") == k).select("qid", F.col("s").alias("threshold")), "qid", "left"))
    goal = materialize(goal.withColumn("safe", F.coalesce(F.col("more") < F.col("threshold") - SLACK, F.lit(False))), "bounded-goals")
    safe = bounded_broadcast(goal.where("safe").select("qid", "more", "threshold"))
    kept = materialize(_sums(index, lead, variant).join(safe, "qid")
                       .where(F.col("s") + F.col("more") >= F.col("threshold") - SLACK).select("qid", "passage_id", "s"), "bounded-kept")
    contrib, _ = R._contribution(index, variant, R.DEFAULTS[variant], F.col("idf"))
    asked = bounded_broadcast(kept.select("qid", "passage_id").join(rest.select("qid", "term", "qtf", "idf"), "qid"))
    more = (R.postings_of(index, rest).drop("part").join(asked, ["passage_id", "term"])
            .select("qid", "passage_id", contrib.alias("s")))
    out = kept.unionByName(more).groupBy("qid", "passage_id").agg(F.sum("s").alias("s"))
    unsafe = goal.where(~F.col("safe")).select("qid")
    if unsafe.limit(1).count():
        out = out.unionByName(_sums(index, terms.join(bounded_broadcast(unsafe), "qid", "left_semi"), variant))
    return out


def bounded_topk(index: SparseIndex, questions: DataFrame, k: int = R.DEFAULT_K, variant: str = "okapi",
                 share: float = SHARE, terms: DataFrame | None = None) -> DataFrame:
    """The same rows as ``retrieve.bm25_topk`` (``server``: ``server_topk``)."""
    from .topk import exhaustive_topk, matches_only_topk

    if not usable(index, variant):
        raise ValueError("no bounds for this index: build it with stored densities and a positive idf floor")
    terms = terms if terms is not None else materialize(query_bounds(index, questions, variant, share), "bounded-terms")
    pairs = matched_pairs(index, terms, variant, k)
    if variant == "server":
        return matches_only_topk(pairs.select("qid", "passage_id", rounded(F.col("s")).alias("score")), k)
    _, base_term = R._contribution(index, variant, R.DEFAULTS[variant], F.col("idf"))
    base = (questions.select("qid").join(terms.groupBy("qid").agg(F.sum(base_term).alias("b")), "qid", "left")
            .select("qid", F.coalesce("b", F.lit(0.0)).alias("b")))
    matched = pairs.join(bounded_broadcast(base), "qid").select("qid", "passage_id", rounded(F.col("b") + F.col("s")).alias("score"))
    return exhaustive_topk(matched, base.select("qid", rounded(F.col("b")).alias("base")),
                           index.lengths.select("passage_id"), k, index.n_docs)


__all__ = ["bounded_topk", "matched_pairs", "query_bounds", "row_costs", "worth", "usable"]
