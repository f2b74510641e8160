"""Exact top-k by inner product with MaxScore.

A vector is a document whose terms are its components; a component turned
into an integer (``floor(64 * x)``) is the term's impact. Rows are dealt to
shards of about ``SHARD`` vectors and queries to blocks of about ``BLOCK``;
every shard meets every block once, as two packed rows. In a shard:

* each term's impacts have a least and a greatest value, which bound what
  the term can add to a query's score;
* the query's terms are ordered by that bound. The non-essential terms are
  the longest run of the smallest bounds whose sum stays below ``SLACK`` times
  the query's threshold (its k-th best score so far): alone they cannot reach
  it. (With ``SLACK`` 1 this is the textbook split; a smaller one traverses
  more postings and probes far fewer vectors.)
* essential postings are traversed for all vectors of a stretch; a vector is
  dropped when its essential score plus the bound of all other terms is below
  the threshold. The non-essential terms are probed in falling order of
  bound, a few at a time, for the vectors that are still competitive;
* vectors that tie with the threshold are kept and ordered by id, so the
  result is exact.

The shards' best k of each query are merged by a window.

Defined cases: rows whose id is null, whose vector is null or holds a null
or non-finite component take no part; every row is a candidate and, if its id
is a query's, a query of its own, also rows that share an id or repeat another;
a query leaves out its own row only; a vector shorter than the others has zeros for the
rest; empty tables give an empty result; ties go to the smaller id; other
columns are not read. Integers stay exact while a score's terms sum to less
than 2**53 in magnitude; beyond that 64-bit integers are used.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

SCALE = 64
K = 20
SHARD = 8192
BLOCK = 4096
STRETCH = 1024
PROBE = 16
SLACK = 0.5
EXACT = float(1 << 53)


def components(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("long"))


def usable(vector: Column) -> Column:
    """True for a vector without null or non-finite components."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return F.coalesce(finite, F.lit(False))


def vectors_of(table: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, row, terms) of the rows that take part; row numbers are fixed once the result is written."""
    rows = table.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("_v"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("_v")))
    return rows.select("vec_id", F.monotonically_increasing_id().alias("row"), components(F.col("_v")).alias("terms"))


def _pack(rows: DataFrame, n: int, part: str) -> DataFrame:
    """One row per part: ids (ascending), row numbers, lengths and impacts as packed 64-bit integers."""
    def pack(group: pa.Table) -> pa.Table:
        order = np.argsort(group.column("vec_id").to_numpy(), kind="stable")
        group = group.take(pa.array(order))
        terms = group.column("terms").combine_chunks()
        sizes = np.diff(terms.offsets.to_numpy()).astype(np.int32)
        return pa.table({part: group.column(part)[:1], f"{part}_ids": [group.column("vec_id").to_numpy().tobytes()],
                         f"{part}_rows": [group.column("row").to_numpy().tobytes()],
                         f"{part}_sizes": [sizes.tobytes()],
                         f"{part}_terms": [np.asarray(terms.flatten(), np.int64).tobytes()]})

    dealt = rows.withColumn(part, F.pmod(F.xxhash64("row"), F.lit(n)).cast("int"))
    return dealt.groupBy(part).applyInArrow(
        pack, f"{part} int, {part}_ids binary, {part}_rows binary, {part}_sizes binary, {part}_terms binary")


def _matrix(ids, sizes, terms, width: int) -> tuple[np.ndarray, np.ndarray]:
    ids, sizes = np.frombuffer(ids, np.int64), np.frombuffer(sizes, np.int32)
    out = np.zeros((len(ids), width), np.int64)
    flat = np.frombuffer(terms, np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return ids, out


def maxscore_shard(ids: np.ndarray, rows: np.ndarray, impacts: np.ndarray, query_rows: np.ndarray, queries: np.ndarray, k: int
                   ) -> list[tuple[np.ndarray, np.ndarray]]:
    """(ids, scores) of each query's best k vectors of a shard, not the query's own row; ``ids`` ascend."""
    width = impacts.shape[1]
    low, high = impacts.min(0), impacts.max(0)
    magnitude = float(np.abs(queries).sum(1, dtype=np.float64).max(initial=0)) * float(max(abs(int(low.min())), abs(int(high.max())), 1))
    kind = np.float64 if magnitude < EXACT else np.int64
    x, q = impacts.astype(kind), queries.astype(kind)
    bound = np.maximum(q * low.astype(kind), q * high.astype(kind))  # most that a term can add
    order = np.argsort(-bound, axis=1, kind="stable")
    sorted_bound = np.take_along_axis(bound, order, 1)
    rest = np.zeros((len(q), width + 1), kind)  # bound of the terms from each rank on
    rest[:, :-1] = np.cumsum(sorted_bound[:, ::-1], axis=1)[:, ::-1]
    best = [(np.zeros(0, np.int64), np.zeros(0, kind))] * len(q)
    threshold = np.full(len(q), -np.inf)
    for at in range(0, len(ids), STRETCH):
        part, part_ids, part_rows = x[at:at + STRETCH], ids[at:at + STRETCH], rows[at:at + STRETCH]
        goal = np.where(threshold > 0, SLACK * threshold, 0)
        small = rest < goal[:, None]
        n_essential = np.where(small.any(1), small.argmax(1), width)
        lead = np.zeros_like(q)
        np.put_along_axis(lead, order, np.where(np.arange(width)[None, :] < n_essential[:, None],
                                                np.take_along_axis(q, order, 1), 0), 1)
        partial = part @ lead.T
        reach = threshold - rest[np.arange(len(q)), n_essential]
        live = partial >= reach[None, :]
        for j in np.flatnonzero(live.any(0)):
            who = np.flatnonzero(live[:, j])
            score, m = partial[who, j], int(n_essential[j])
            while m < width and len(who):
                terms = order[j, m:m + PROBE]
                score = score + part[np.ix_(who, terms)] @ q[j, terms]
                m = min(m + PROBE, width)
                stay = score + rest[j, m] >= threshold[j]
                who, score = who[stay], score[stay]
            other = part_rows[who] != query_rows[j]
            who, score = who[other], score[other]
            if not len(who):
                continue
            all_ids, all_scores = np.concatenate([best[j][0], part_ids[who]]), np.concatenate([best[j][1], score])
            keep = np.lexsort((all_ids, -all_scores))[:k]
            best[j] = all_ids[keep], all_scores[keep]
            if len(keep) == k:
                threshold[j] = float(all_scores[keep[-1]])
    return best


def top_k(queries: DataFrame, vectors: DataFrame, k: int = K, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id and score of the best ``k`` vectors of each query.

    ``queries`` and ``vectors`` have columns vec_id, row and terms (see ``vectors_of``).
    """
    n_shards = -(-max(vectors.count(), 1) // shard)
    n_blocks = -(-max(queries.count(), 1) // block)
    shards = _pack(vectors, n_shards, "shard").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    blocks = _pack(queries, n_blocks, "block").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [(np.zeros(0, np.int64),) * 4]
        if left.num_rows and right.num_rows:
            x, q = left.to_pylist()[0], right.to_pylist()[0]
            left_rows, right_rows = x["shard_rows"], q["block_rows"]
            width = max(1, *(np.frombuffer(s, np.int32).max(initial=0) for s in (x["shard_sizes"], q["block_sizes"])))
            ids, x = _matrix(x["shard_ids"], x["shard_sizes"], x["shard_terms"], width)
            query_ids, q = _matrix(q["block_ids"], q["block_sizes"], q["block_terms"], width)
            rows, query_rows = np.frombuffer(left_rows, np.int64), np.frombuffer(right_rows, np.int64)
            for lo in range(0, len(query_ids), 512):
                found = maxscore_shard(ids, rows, x, query_rows[lo:lo + 512], q[lo:lo + 512], k)
                n = [len(v) for v, _ in found]
                out.append((np.repeat(query_ids[lo:lo + 512], n), np.repeat(query_rows[lo:lo + 512], n),
                            np.concatenate([v for v, _ in found]),
                            np.concatenate([s for _, s in found]).astype(np.int64)))
        return pa.table(dict(zip(("query_id", "query_row", "vec_id", "score"), map(np.concatenate, zip(*out)))))

    found = (shards.groupBy("shard", "block").cogroup(blocks.groupBy("shard", "block"))
             .applyInArrow(search, "query_id long, query_row long, vec_id long, score long"))
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def search_table(table: DataFrame, every: int = 20, k: int = K) -> DataFrame:
    """Top ``k`` of every row whose vec_id is divisible by ``every``, against all rows."""
    vectors = materialize(vectors_of(table), "maxscore-vectors")
    return top_k(vectors.where(F.col("vec_id") % every == 0), vectors, k)


ORACLE = f"""
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS t FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.r AS q, q.vec_id AS query_id, v.vec_id, list_sum(list_transform(list_zip(q.t, v.t), lambda z: coalesce(z[1], 0) * coalesce(z[2], 0)))::BIGINT AS score
      FROM v q JOIN v ON q.r <> v.r WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, coalesce(score, 0) AS score FROM r WHERE rank <= {K}
"""
