"""Score sums of a batch of questions, made in Arrow batches of whole passages.

Every score here is a sum of products: what a question weighs a term times
what a posting adds. The postings of the questions' terms are packed by
passage (stored postings lie by passage, so nothing is shuffled), and a task
adds the products of ``PASSAGES`` passages and ``QUESTIONS`` questions to a
dense table at a time, instead of one row per (question, term, passage). Of a
task's sums the k best of each question leave it. Memory is bounded by the
table, by ``PAIRS`` products at once and by the batch's own weights, which go to
the tasks and of which there are at most ``BATCH_TERMS``; beyond that the
joins of ``retrieve`` take over.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .index import SparseIndex

#: (question, term) rows that are sent to the tasks.
BATCH_TERMS = 200_000
QUESTIONS = 256
PASSAGES = 1 << 13
PAIRS = 1 << 21
#: Sums this near the k-th may be rounded to the same score, or to a higher one.
SLACK = 2e-6


def batch_weights(index: SparseIndex, weights: DataFrame, most: int | None = None) -> pa.Table | None:
    """``qid, term, w0, w1...`` as a table of the driver; None if there are too many rows or the ids are no whole numbers."""
    if index.postings.schema["passage_id"].dataType.simpleString() not in ("bigint", "int"):
        return None
    most = BATCH_TERMS if most is None else most
    rows = weights.limit(most + 1).toArrow()
    return rows if rows.num_rows <= most else None


def _runs(counts: np.ndarray, pairs: int) -> list[tuple[int, int]]:
    """Ranges of postings with about ``pairs`` products each."""
    done = (np.cumsum(counts) - counts) // pairs
    cuts = [0, *(np.flatnonzero(np.diff(done)) + 1).tolist(), len(counts)]
    return list(zip(cuts[:-1], cuts[1:]))


def _k_best(q: np.ndarray, ids: np.ndarray, s: np.ndarray, base: np.ndarray, k: int) -> tuple:
    """Each question's k best by rounded score, then id."""
    order = np.lexsort((ids, -np.round(base[q] + s, 6), q))
    q, ids, s = q[order], ids[order], s[order]
    first = np.searchsorted(q, q)  # rising: where the question's rows begin
    keep = np.arange(len(q)) - first < k
    return q[keep], ids[keep], s[keep]


def best_of_batches(batches, blocks: list, weights: list, base: list, n_questions: int, k: int,
                    questions: int, passages: int, pairs: int) -> list[tuple]:
    """Of each variant the (question, id, sum) arrays of the k best sums of all batches ``passage_id, hits``.

    ``blocks``: for that many questions each, per term the first of its products and their number, and per product the
    question and its row in ``weights``."""
    m = len(weights)
    best = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)) for _ in range(m)]
    for whole in batches:
        for lo in range(0, len(whole), passages):
            batch = whole.slice(lo, passages)
            n = len(batch)
            ids = pc.fill_null(batch.column("passage_id").cast(pa.int64()), np.iinfo(np.int64).min).to_numpy()
            hits = batch.column("hits")
            rows = np.repeat(np.arange(n), hits.value_lengths().to_numpy())
            hits = hits.flatten()
            term = hits.field("t").to_numpy()
            adds = [hits.field(f"g{v}").to_numpy() for v in range(m)]
            for number, (begin, count, question, weight) in enumerate(blocks):
                q0 = number * questions
                nq = min(questions, n_questions - q0)
                products = count[term]
                sums = [np.zeros(nq * n) for _ in range(m)]
                for a, b in _runs(products, pairs):
                    c = products[a:b]
                    posting = np.repeat(np.arange(a, b), c)
                    if not len(posting):
                        continue
                    at = np.arange(len(posting)) + np.repeat(begin[term[a:b]] - (np.cumsum(c) - c), c)
                    cell = question[at] * n + rows[posting]
                    at = weight[at]
                    for v in range(m):
                        sums[v] += np.bincount(cell, weights[v][at] * adds[v][posting], nq * n)
                for v in range(m):
                    table = sums[v].reshape(nq, n)
                    least = np.partition(table, n - k, axis=1)[:, n - k] if n > k else np.full(nq, -np.inf)
                    q, r = np.nonzero((table >= least[:, None] - SLACK) & (table != 0))
                    best[v] = _k_best(np.concatenate([best[v][0], q + q0]), np.concatenate([best[v][1], ids[r]]),
                                      np.concatenate([best[v][2], table[q, r]]), base[v], k)
    return best


def best_sums(index: SparseIndex, weights: pa.Table, postings: DataFrame, adds: list[Column], k: int,
              base: pa.Table | None = None) -> DataFrame:
    """``variant, qid, passage_id, s``: of each task the k best sums of every question that are not 0, as no match's is, plus its base.

    ``weights``: qid, term and for each variant ``w0, w1...``; ``adds``: what a posting adds to it, from the columns of
    ``postings``; ``base``: qid, ``b0, b1...``, for each variant."""
    spark, m = postings.sparkSession, len(adds)
    terms = pc.unique(weights.column("term"))
    qid = weights.column("qid").combine_chunks().dictionary_encode(null_encoding="encode")
    qid = qid.combine_chunks() if isinstance(qid, pa.ChunkedArray) else qid
    qids, question = qid.dictionary, qid.indices.to_numpy().astype(np.int64)
    term = pc.index_in(weights.column("term"), value_set=terms).to_numpy().astype(np.int64)
    values = [weights.column(f"w{v}").to_numpy() for v in range(m)]
    start = [np.zeros(len(qids)) for _ in range(m)]
    if base is not None:
        at = pc.fill_null(pc.index_in(qids, value_set=base.column("qid")), -1).to_numpy()
        start = [np.where(at >= 0, np.append(base.column(f"b{v}").to_numpy(), 0.0)[at], 0.0) for v in range(m)]
    blocks = []
    for q0 in range(0, len(qids), QUESTIONS):
        own = np.flatnonzero((question >= q0) & (question < q0 + QUESTIONS))
        own = own[np.argsort(term[own], kind="stable")]
        count = np.bincount(term[own], minlength=len(terms))
        blocks.append((np.cumsum(count) - count, count, question[own] - q0, own))
    kind, asked = postings.schema["passage_id"].dataType.simpleString(), str(weights.schema.field("qid").type)
    asked = {"int64": "long", "int32": "int"}.get(asked, asked)
    id_type = pa.int64() if kind == "bigint" else pa.int32()
    sizes = QUESTIONS, PASSAGES, PAIRS

    def run(batches):
        for v, (q, ids, s) in enumerate(best_of_batches(batches, blocks, values, start, len(qids), k, *sizes)):
            ids = pa.array(ids, mask=ids == np.iinfo(np.int64).min).cast(id_type)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(q), v, np.int32)), qids.take(pa.array(q)), ids, pa.array(start[v][q] + s)],
                                             ["variant", "qid", "passage_id", "s"])

    codes = spark.createDataFrame(list(zip(terms.to_pylist(), range(len(terms)))), "term string, t int")
    packed = (postings.join(F.broadcast(codes), "term").groupBy("passage_id")
              .agg(F.collect_list(F.struct("t", *[a.alias(f"g{v}") for v, a in enumerate(adds)])).alias("hits")))
    return packed.mapInArrow(run, f"variant int, qid {asked}, passage_id {kind}, s double")


__all__ = ["batch_weights", "best_sums"]
