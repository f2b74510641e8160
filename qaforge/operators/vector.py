"""Vector search: IVF cells from KMeans, approximate and exact top-k.

Cells: ``pyspark.ml`` KMeans over the vectors (one driver value: the
``n_cells x dim`` centroid matrix, bounded by the number of cells). A query
finds its nearest cells inside its own row -- distances to the centroid
array -- so there is no query x centroid join; then query and vectors meet
by an equi-join on ``cell``.

Exact search without comparing every pair: probe the nearest cells, take
each query's k-th distance ``d_k``, then probe every other cell whose
closest possible point can still beat it, ``|q - c| - radius_c <= sqrt(d_k)``
(triangle inequality). Radii and distances to centroids are sums of squared
differences, so their error is relative to the distance and not to how far
from the origin the vectors lie. The result equals brute force.

Vectors that are null, empty or hold null or non-finite components are in no
cell and no query.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import is_complete, materialize, shared_path
from .common import top_n

N_CELLS = 64
# Distances are rounded to 6 digits; sums of squared differences are exact to far more than TOLERANCE of their value.
ROUNDING = 1e-6
TOLERANCE = 1e-9
DEFAULT_NPROBE = 1


@dataclass
class IVFIndex:
    vectors: DataFrame        # vec_id, embedding, cell
    centroids: list           # list[list[float]]
    radii: dict               # cell -> max distance of a member to its centroid
    sizes: dict = None        # cell -> number of vectors

    def centroid_column(self) -> Column:
        return F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in self.centroids])


def usable(vector: Column) -> Column:
    """True for a vector without null or non-finite components."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))  # NaN is above it
    return F.coalesce(finite & (F.size(vector) > 0), F.lit(False))


def kmeans_centroids(vectors: DataFrame, n_cells: int = N_CELLS, seed: int = 42, max_iter: int = 20) -> list:
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    feats = vectors.select(array_to_vector(F.col("embedding")).alias("features"))
    return KMeans(k=n_cells, seed=seed, maxIter=max_iter, featuresCol="features").fit(feats).clusterCenters()


def _assigned(vectors: DataFrame, centroids: list, id_col: str, vec_col: str) -> DataFrame:
    """vec_id, embedding, its nearest cell and the distance to that cell's centroid."""
    base = vectors.where(usable(F.col(vec_col))).select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("embedding"))
    return base.withColumn("near", _nearest_udf(centroids)(F.col("embedding"))).select(
        "vec_id", "embedding", F.col("near.cell").cast("int").alias("cell"), F.col("near.far").alias("far"))


def _cell_stats(assigned: DataFrame) -> list:
    return assigned.groupBy("cell").agg(F.max("far").alias("r"), F.count(F.lit(1)).alias("n")).collect()


def build_ivf(vectors: DataFrame, n_cells: int = N_CELLS, seed: int = 42, max_iter: int = 20,
              id_col: str = "vec_id", vec_col: str = "embedding", centroids: list | None = None) -> IVFIndex:
    """Fit KMeans cells, or take the given centroids, and assign every vector to its nearest one."""
    if centroids is None:
        centroids = kmeans_centroids(vectors.where(usable(F.col(vec_col))).select(F.col(vec_col).alias("embedding")), n_cells, seed, max_iter)
    assigned = materialize(_assigned(vectors, centroids, id_col, vec_col), "ivf-cells")
    stats = _cell_stats(assigned)
    return IVFIndex(vectors=assigned.drop("far"), centroids=[list(map(float, c)) for c in centroids],
                    radii={int(r["cell"]): float(r["r"]) for r in stats}, sizes={int(r["cell"]): int(r["n"]) for r in stats})


def shared_ivf(vectors: DataFrame, n_cells: int = N_CELLS, seed: int = 42, max_iter: int = 20,
               id_col: str = "vec_id", vec_col: str = "embedding", source_key: str | None = None,
               fit: Callable[[DataFrame], list] | None = None, fit_name: str = "kmeans") -> IVFIndex:
    """``build_ivf`` once per (vector-table fingerprint, parameters): the cell
    assignment and centroids are written to the shared folder and reused.
    ``fit`` makes the centroids of the table in another way, named ``fit_name``."""
    import hashlib
    import json

    spark = vectors.sparkSession
    fp = {"source": source_key} if source_key else vectors.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(id_col)).alias("s"),
                     F.bit_xor(F.xxhash64(F.col(id_col), F.col(vec_col))).alias("h")).first().asDict()
    key = hashlib.sha1(json.dumps([fit_name, n_cells, seed, max_iter, fp], sort_keys=True).encode()).hexdigest()[:20]
    path = shared_path(spark, f"ivf-{key}")
    if not is_complete(spark, f"{path}/cells"):
        good = vectors.where(usable(F.col(vec_col)))
        centroids = fit(good) if fit else kmeans_centroids(good.select(F.col(vec_col).alias("embedding")), n_cells, seed, max_iter)
        _assigned(vectors, centroids, id_col, vec_col).write.mode("overwrite").partitionBy("cell").parquet(f"{path}/vectors")
        stats = {r["cell"]: r for r in _cell_stats(spark.read.parquet(f"{path}/vectors"))}
        rows = [(i, list(map(float, c)), float(stats[i]["r"]) if i in stats else 0.0, int(stats[i]["n"]) if i in stats else 0)
                for i, c in enumerate(centroids)]
        spark.createDataFrame(rows, "cell int, centroid array<double>, radius double, size long") \
            .coalesce(1).write.mode("overwrite").parquet(f"{path}/cells")  # last: marks a complete index
    cells = sorted(spark.read.parquet(f"{path}/cells").collect(), key=lambda r: r["cell"])
    assigned = spark.read.parquet(f"{path}/vectors").drop("far")
    return IVFIndex(vectors=assigned, centroids=[list(r["centroid"]) for r in cells],
                    radii={r["cell"]: r["radius"] for r in cells if r["size"]},
                    sizes={r["cell"]: r["size"] for r in cells if r["size"]})


# Rows of a batch that are compared with all centroids at once.
DISTANCE_ROWS = 128


def _squared_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Sums of squared differences, some rows at a time."""
    out = np.empty((len(x), len(centroids)))
    for lo in range(0, len(x), DISTANCE_ROWS):
        diff = x[lo:lo + DISTANCE_ROWS, None, :] - centroids[None]
        out[lo:lo + DISTANCE_ROWS] = np.einsum("ijk,ijk->ij", diff, diff)
    return out


def _nearest_udf(centroids: list):
    """Arrow-batched nearest centroid of each vector and the distance to it.

    A product of matrices, centred on the centroids' mean, finds the cells that
    may be nearest within its rounding error; those are compared exactly."""
    cmat = np.asarray(centroids, dtype=np.float64)
    mid = cmat.mean(axis=0)
    centred = cmat - mid
    cnorm = (centred * centred).sum(axis=1)

    @F.pandas_udf("cell int, far double")
    def nearest(vs: pd.Series) -> pd.DataFrame:
        if len(vs) == 0:
            return pd.DataFrame({"cell": pd.Series([], dtype="int32"), "far": pd.Series([], dtype="float64")})
        x = np.stack(vs.to_numpy()).astype(np.float64)
        y = x - mid
        norm = (y * y).sum(axis=1)
        d = norm[:, None] + cnorm[None, :] - 2.0 * (y @ centred.T)
        size = np.abs(x).max(axis=1) + np.abs(mid).max()
        error = 16 * cmat.shape[1] * np.finfo(float).eps * (norm + cnorm.max() + size * np.sqrt(norm + cnorm.max()))
        best = d.argmin(axis=1)
        for i in np.flatnonzero((d <= d.min(axis=1)[:, None] + 2 * error[:, None]).sum(axis=1) > 1):
            best[i] = _squared_distances(x[i:i + 1], cmat)[0].argmin()
        diff = x - cmat[best]
        return pd.DataFrame({"cell": best.astype(np.int32), "far": np.sqrt((diff * diff).sum(axis=1))})

    return nearest


def _centroid_distance_udf(centroids: list):
    """Arrow-batched squared distances from each query to every centroid
    (the centroid matrix is cells x dim, a bounded driver value)."""
    cmat = np.asarray(centroids, dtype=np.float64)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def dist(vs: pd.Series) -> pd.Series:
        if len(vs) == 0:
            return pd.Series([], dtype=object)
        return pd.Series(list(_squared_distances(np.stack(vs.to_numpy()).astype(np.float64), cmat)))

    return dist


def _centroid_distances(index: IVFIndex, q: Column) -> Column:
    """array<struct<d, cell>> of squared distances from q to every centroid."""
    udf = _centroid_distance_udf(index.centroids)
    return F.transform(udf(q), lambda d, i: F.struct(d.alias("d"), i.alias("cell")))


def nearest_cells(index: IVFIndex, q: Column, nprobe: int) -> Column:
    return F.transform(F.slice(F.array_sort(_centroid_distances(index, q)), 1, nprobe),
                       lambda s: s["cell"])


# Largest number of vectors / probing queries one block holds. A cell above
# either bound is split (vectors by id hash, queries by id hash), so a cell
# holding a third of all vectors becomes many bounded tasks.
VEC_BLOCK = 20_000
QUERY_BLOCK = 20_000
QUERY_CHUNK = 256


def _block_schema() -> str:
    return "qid long, vec_id long, distance double"


def _block_topk_fn(k: int):
    """The k best of a block: every vector whose approximate distance may, within
    its rounding error, reach the k-th one is compared exactly, so ties at the
    k-th place are broken by id among all of them."""
    def fn(qdf: pd.DataFrame, vdf: pd.DataFrame) -> pd.DataFrame:
        if qdf.empty or vdf.empty:
            return pd.DataFrame({"qid": pd.Series([], dtype="int64"), "vec_id": pd.Series([], dtype="int64"),
                                 "distance": pd.Series([], dtype="float64")})
        vecs = np.stack(vdf["v"].to_numpy()).astype(np.float64)
        vids = vdf["vec_id"].to_numpy(dtype=np.int64)
        vnorm = (vecs * vecs).sum(axis=1)
        qs = np.stack(qdf["q"].to_numpy()).astype(np.float64)
        qids = qdf["qid"].to_numpy(dtype=np.int64)
        m = min(k, len(vids))
        top = float(vnorm.max())
        out_q, out_v, out_d = [], [], []
        for lo in range(0, len(qids), QUERY_CHUNK):
            q = qs[lo:lo + QUERY_CHUNK]
            qnorm = (q * q).sum(axis=1)
            approx = qnorm[:, None] + vnorm[None, :] - 2.0 * (q @ vecs.T)
            # distances are rounded to 6 digits; the error of the approximation grows with the norms
            error = 1e-6 + 8 * q.shape[1] * np.finfo(float).eps * (qnorm + top)
            limit = np.partition(approx, m - 1, axis=1)[:, m - 1] + 2 * error
            for row in range(len(q)):
                cand = np.flatnonzero(approx[row] <= limit[row])
                diff = vecs[cand] - q[row]
                exact = np.round((diff * diff).sum(axis=1), 6)
                order = np.lexsort((vids[cand], exact))[:k]
                out_q.append(np.full(len(order), qids[lo + row], dtype=np.int64))
                out_v.append(vids[cand][order])
                out_d.append(exact[order])
        return pd.DataFrame({"qid": np.concatenate(out_q), "vec_id": np.concatenate(out_v),
                             "distance": np.concatenate(out_d)})
    return fn


def _probe(queries: DataFrame, index: IVFIndex, cells: Column, k: int) -> DataFrame:
    """Top-k candidates of each query inside the cells it probes.

    Queries and vectors meet per (cell, vector block, query block) in a
    cogrouped ``applyInPandas``; each block is a numpy distance matrix
    (no row per pair), cut to the block's k best per query. The block
    counts come from per-cell sizes (one row per cell on the driver)."""
    probes = queries.select("qid", F.col("embedding").alias("q"), F.explode(cells).alias("cell"))
    n_probe = {int(r["cell"]): int(r["n"]) for r in probes.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes = index.sizes or {}
    vsub = {c: max(1, math.ceil(sizes.get(c, 0) / VEC_BLOCK)) for c in set(sizes) | set(n_probe)}
    qblk = {c: max(1, math.ceil(n_probe.get(c, 0) / QUERY_BLOCK)) for c in vsub}

    def lookup(table: dict) -> Column:
        return F.create_map(*[x for c, v in sorted(table.items()) for x in (F.lit(c), F.lit(v))])

    vmap, qmap = lookup(vsub), lookup(qblk)
    q_side = (probes.withColumn("qb", F.pmod(F.xxhash64("qid"), F.element_at(qmap, F.col("cell"))))
              .withColumn("vs", F.explode(F.sequence(F.lit(0), F.element_at(vmap, F.col("cell")) - 1))))
    # only probed cells are read (stored vectors are partitioned by cell) and shuffled
    v_side = (index.vectors.where(F.col("cell").isin(sorted(n_probe))).select("vec_id", F.col("embedding").alias("v"), "cell")
              .withColumn("vs", F.pmod(F.xxhash64("vec_id"), F.element_at(vmap, F.col("cell"))))
              .withColumn("qb", F.explode(F.sequence(F.lit(0), F.element_at(qmap, F.col("cell")) - 1))))
    fn = _block_topk_fn(k)
    return (q_side.groupBy("cell", "vs", "qb")
            .cogroup(v_side.groupBy("cell", "vs", "qb"))
            .applyInPandas(fn, _block_schema()))


def _rank(cands: DataFrame, k: int) -> DataFrame:
    ranked = top_n(cands, "qid", [F.col("distance").asc(), F.col("vec_id").asc()], k)
    return ranked.select(F.col("qid").cast("long"), F.col("rank").cast("int"),
                         F.col("vec_id").cast("long"), F.col("distance").cast("double"))


def ivf_topk(index: IVFIndex, queries: DataFrame, k: int = 40, nprobe: int = DEFAULT_NPROBE) -> DataFrame:
    """Approximate top-k by squared L2 within the ``nprobe`` nearest cells.
    Fewer than k neighbours in the probed cells -> fewer rows (no -1 ids)."""
    q = queries.where(usable(F.col("embedding"))).select("qid", "embedding")
    return _rank(_probe(q, index, nearest_cells(index, F.col("embedding"), nprobe), k), k)


def exact_topk(index: IVFIndex, queries: DataFrame, k: int = 40, nprobe: int = 4) -> DataFrame:
    """Exact top-k: first pass over the nearest cells, second pass over the
    cells the triangle-inequality bound cannot exclude."""
    q = queries.where(usable(F.col("embedding"))).select("qid", "embedding")
    first_cells = nearest_cells(index, F.col("embedding"), nprobe)
    first = materialize(_rank(_probe(q, index, first_cells, k), k), "vector-first-pass")
    kth = first.groupBy("qid").agg(F.max("distance").alias("dk"), F.count(F.lit(1)).alias("n"))
    radius = F.create_map(*[x for c, r in sorted(index.radii.items()) for x in (F.lit(c), F.lit(r))]) \
        if index.radii else F.create_map().cast("map<int,double>")
    # cells not probed yet that may hold a closer point (all of them when
    # the first pass found fewer than k)
    reach = F.sqrt(F.col("dk") + ROUNDING) * (1 + TOLERANCE)
    more = F.filter(_centroid_distances(index, F.col("embedding")), lambda s: (
        ~F.array_contains(F.col("first"), s["cell"]))
        & (F.col("n").isNull() | (F.col("n") < k)
           | (F.sqrt(s["d"]) * (1 - TOLERANCE) - F.coalesce(F.element_at(radius, s["cell"]), F.lit(0.0)) * (1 + TOLERANCE)
              <= reach)))
    second_q = (q.withColumn("first", first_cells).join(kth, "qid", "left")
                .select("qid", "embedding", F.transform(more, lambda s: s["cell"]).alias("cells")))
    second = _probe(second_q, index, F.col("cells"), k)
    cands = first.select("qid", "vec_id", "distance").unionByName(second)
    return _rank(cands, k)


__all__ = ["build_ivf", "shared_ivf", "ivf_topk", "exact_topk"]
