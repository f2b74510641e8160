"""Document-store retrieval: filters, AND/OR matching, multi-field scoring,
score scaling, highlighting (P1-P5, R9, R10 guard).

The index statistics (N, df, average length) always come from the whole
store, as a search server computes them; a metadata filter only narrows
which documents may be returned. The postings are semi-joined with the
allowed ids before they meet the query terms.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.filters import compile_filter
from ..functions.text import WORD_CLASS
from . import retrieve as R
from .common import rounded
from .index import SparseIndex, build_index
from .topk import matches_only_topk

# Fixed value: temperature of the logistic score scaling.
SCALE_TEMPERATURE = 8.0
STORE_TOP_K = 10


def scale_score(score: Column, temperature: float = SCALE_TEMPERATURE) -> Column:
    """Map an unbounded relevance score into (0, 1)."""
    return 1.0 / (1.0 + F.exp(-score / temperature))


def keyword_scores(index: SparseIndex, questions: DataFrame, allowed: DataFrame | None = None,
                   all_terms_must_match: bool = False, qid_col: str = "qid",
                   text_col: str = "question", **kw) -> DataFrame:
    """Server-BM25 matched scores ``qid, passage_id, score`` (unrounded sum),
    restricted to ``allowed`` ids (a filtered id table) and, for AND
    matching, to passages holding every distinct query term."""
    if allowed is not None:  # postings of other passages never meet a query term; hashed ids, so no postings are sorted
        index = replace(index, postings=index.postings.join(allowed.select("passage_id").hint("shuffle_hash"), "passage_id", "left_semi"))
    scored = R.score_bm25(index, questions, "server", qid_col, text_col, **kw)
    matched = scored.matched
    if all_terms_must_match:
        qterms = R.query_terms(questions, index.tokenizer, qid_col, text_col)
        need = qterms.groupBy("qid").agg(F.count(F.lit(1)).alias("need"))
        need = F.broadcast(need) if scored.small else need
        matched = matched.join(need, "qid").where(F.col("n_terms") == F.col("need"))
    return matched.select("qid", "passage_id", "score")


def keyword_retrieve(index: SparseIndex, questions: DataFrame, docs: DataFrame | None = None,
                     filters: dict | None = None, top_k: int = STORE_TOP_K,
                     all_terms_must_match: bool = False, scale: bool = True,
                     qid_col: str = "qid", text_col: str = "question") -> DataFrame:
    """Keyword retrieval over a store (R9): ``qid, rank, passage_id, score``.
    ``docs`` carries the metadata columns the filter refers to."""
    allowed = None
    if filters:
        if docs is None:
            raise ValueError("filters need the document table")
        allowed = docs.where(compile_filter(filters)).select("passage_id")
    ranked = matches_only_topk(
        keyword_scores(index, questions, allowed, all_terms_must_match, qid_col, text_col), top_k)
    if scale:
        ranked = ranked.withColumn("score", rounded(scale_score(F.col("score"))))
    return ranked


def keyword_retrieve_batch(index: SparseIndex, questions: DataFrame, docs: DataFrame,
                           filters: list, filter_of: DataFrame, top_k: int = STORE_TOP_K,
                           all_terms_must_match: bool = False, scale: bool = True) -> DataFrame:
    """One filter per query (R9 batch form). ``filters`` are the few distinct
    ones (None: unrestricted); the table ``filter_of`` (qid, filter_id) says
    which of them a query has. A query without one is unrestricted. One scan
    marks every document with the filters it passes, however many there are.
    """
    passes = F.array_compact(F.array(*[F.when(compile_filter(f) if f else F.lit(True), F.lit(i)) for i, f in enumerate(filters)]))
    passed = docs.select("passage_id", passes.alias("passes")).where(F.size("passes") > 0)
    tagged = questions.join(filter_of.select("qid", "filter_id"), "qid", "left")
    # the marks meet the postings by passage, as the postings lie; a pair that its filter drops is never summed
    marked = replace(index, postings=index.postings.join(passed.hint("shuffle_hash"), "passage_id", "left"))
    scores = keyword_scores(marked, tagged, None, all_terms_must_match, keep=("filter_id",), where=(
        F.col("filter_id").isNull() | F.coalesce(F.array_contains("passes", F.col("filter_id")), F.lit(False))))
    ranked = matches_only_topk(scores, top_k)
    if scale:
        ranked = ranked.withColumn("score", rounded(scale_score(F.col("score"))))
    return ranked


def filter_only(docs: DataFrame, filters: dict | None) -> DataFrame:
    """Filter retriever (P2): every document matching the filter."""
    return docs.where(compile_filter(filters))


def multi_field_retrieve(docs: DataFrame, questions: DataFrame, fields: list[str],
                         top_k: int = STORE_TOP_K, id_col: str = "passage_id",
                         source_key: str | None = None) -> DataFrame:
    """``most_fields`` match (P4): one server-BM25 index per field, the
    per-field scores summed; matches only. ``qid, rank, passage_id, score``.
    With ``source_key`` (see ``index_store.shared_index``) the field indexes are
    stored and reused."""
    from ..sources.index_store import shared_index

    total = None
    for field in fields:
        part = docs.select(F.col(id_col).alias("passage_id"), F.coalesce(F.col(field), F.lit("")).alias("text"))
        idx = shared_index(part, "bm25", "word", f"{source_key}-{field}") if source_key else build_index(part, "word")
        s = (R.score_bm25(idx, questions, "server").matched
             .select("qid", "passage_id", F.col("raw").alias(f"s_{field}")))
        total = s if total is None else total.join(s, ["qid", "passage_id"], "full")
    summed = total.select("qid", "passage_id", rounded(sum(
        (F.coalesce(F.col(f"s_{f}"), F.lit(0.0)) for f in fields), F.lit(0.0))).alias("score"))
    return matches_only_topk(summed, top_k)


def highlight(text: Column, terms: Column, pre: str = "<em>", post: str = "</em>") -> Column:
    """Wrap every word of ``text`` whose lower-case form is in ``terms``."""
    pieces = F.regexp_extract_all(F.coalesce(text, F.lit("")),
                                  F.lit(f"{WORD_CLASS}|[^{WORD_CLASS[1:-2]}]+"), 0)
    return F.array_join(F.transform(pieces, lambda p: F.when(
        F.array_contains(terms, F.lower(p)), F.concat(F.lit(pre), p, F.lit(post))).otherwise(p)), "")


def tfidf_store_guard(filters: dict | None = None, scale_score: bool | None = None) -> None:
    """The paragraph TF-IDF retriever supports neither filters nor scaling."""
    if filters:
        raise NotImplementedError("filters are not supported by the TF-IDF paragraph retriever")
    if scale_score:
        raise NotImplementedError("scale_score is not supported by the TF-IDF paragraph retriever")


__all__ = ["keyword_retrieve", "keyword_retrieve_batch", "filter_only", "multi_field_retrieve",
           "highlight", "scale_score", "tfidf_store_guard"]
