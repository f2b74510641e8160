"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the triangular factor.

1. A row's vector becomes integers x = floor(scale * c) + shift. Count and
   sums per dimension are exact integers.
2. *Scatter.* Rows are centred on the integer part of the mean before they are
   multiplied; block products are exact in float64 (blocks are kept below
   2**53), their sums are Python integers, and the fractional rest of the mean
   is taken off in integers: n * sum(y y') - r r' is n**2 times the covariance,
   without rounding.
3. *Factor.* Cholesky with diagonal pivoting gives V = L L' with as many
   columns as V has rank (pivots below ``RANK`` times the largest end it).
4. *Jacobi.* Plane rotations make the columns of L orthogonal; squared column
   norms are the eigenvalues, normalised columns the components. Pairs of a
   round are disjoint and rotated together.
5. Rows are projected; a last pass over the fit list sums the covariance of
   the whitened values for the error that is reported.

The driver holds matrices of dimension x dimension only; rows stay in tasks.

Defined cases: rows whose vector is null, empty or holds null or non-finite
entries take no part, nor do rows whose x leaves +-2**40, or whose length is
not the most frequent one (of equally frequent ones the longest): they have no
value in some dimension. Repeated rows count as often as they occur; a null id
is carried; eigenvalues that are equal are numbered in the order of the
Jacobi columns; a component with eigenvalue 0 (beyond the rank) has no
whitened value and no row, so equal vectors or a single one give no rows;
an empty table gives an empty result. ``deviation`` is null where it exceeds
a 64-bit integer. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
LARGEST = float(1 << 40)
RANK = 1e-14
SWEEPS = 60
_EXACT = 1 << 53
_RESULT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass
class Fit:
    n: int
    sums: list            # exact sums of x by dimension
    components: np.ndarray  # rows: unit eigenvectors by falling eigenvalue
    values: np.ndarray    # their eigenvalues
    trace: float


def usable(vector: Column) -> Column:
    inside = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) <= F.lit(LARGEST / SCALE), F.lit(False))
                      & F.coalesce(~F.isnan(c), F.lit(False)))
    return F.coalesce(inside & (F.size(vector) > 0), F.lit(False))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return (np.floor(SCALE * flat).astype(np.int64) + SHIFT).reshape(-1, width)


def _whole(values) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def width_of(rows: DataFrame) -> int:
    """The most frequent length."""
    got = rows.groupBy(F.size("embedding").alias("w")).count().orderBy(F.desc("count"), F.desc("w")).limit(1).collect()
    return got[0]["w"] if got else 0


def column_sums(rows: DataFrame, width: int) -> tuple[int, list[int]]:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * width
        for batch in batches:
            x = _matrix(batch.column("embedding"), width)
            n += len(x)
            total = [a + int(b) for a, b in zip(total, x.sum(0))]
        yield pa.RecordBatch.from_arrays([pa.array(range(width + 1), pa.int32()), _whole([n, *total])], names=["i", "v"])

    got = dict(rows.select("embedding").mapInArrow(add, "i int, v decimal(38,0)").groupBy("i").agg(F.sum("v").alias("v")).collect())
    return int(got.get(0, 0)), [int(got.get(i + 1, 0)) for i in range(width)]


def scatter(rows: DataFrame, centre: np.ndarray) -> list[list[int]]:
    """Exact sum of y y' with y = x - centre."""
    width = len(centre)
    upper = np.triu_indices(width)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held = np.zeros(len(upper[0]), object), np.zeros((width, width))
        room = _EXACT
        for batch in batches:
            y = (_matrix(batch.column("embedding"), width) - centre).astype(np.float64)
            most = int(np.abs(y).max(initial=0)) ** 2 or 1
            step = max(1, _EXACT // most // 2)
            for lo in range(0, len(y), step):
                part = y[lo:lo + step]
                if most >= _EXACT:  # products of single entries are not exact in float64
                    whole = part.astype(np.int64).astype(object)
                    total += (whole.T @ whole)[upper]
                    continue
                if room < most * len(part):
                    total += held[upper].astype(np.int64).astype(object)
                    held[:], room = 0, _EXACT
                held += part.T @ part
                room -= most * len(part)
        total += held[upper].astype(np.int64).astype(object)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), _whole(total)], names=["i", "v"])

    summed = rows.select("embedding").mapInArrow(add, "i int, v decimal(38,0)").groupBy("i").agg(F.sum("v").alias("v"))
    out = [[0] * width for _ in range(width)]
    for r in summed.collect():  # width * (width + 1) / 2 rows
        i, j = int(upper[0][r["i"]]), int(upper[1][r["i"]])
        out[i][j] = out[j][i] = int(r["v"])
    return out


def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """L (dimension x rank) with v = L L'; rows in the order of ``v``, triangular in the order of the pivots."""
    rest, columns = v.astype(np.float64).copy(), []
    largest = float(np.diag(v).max(initial=0))
    for _ in range(len(v)):
        p = int(np.argmax(np.diag(rest)))
        if rest[p, p] <= RANK * largest or largest <= 0:
            break
        column = rest[:, p] / np.sqrt(rest[p, p])
        columns.append(column)
        rest -= np.outer(column, column)
        rest[p, :] = rest[:, p] = 0
    return np.stack(columns, 1) if columns else np.zeros((len(v), 0))


def one_sided_jacobi(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as rows) of factor factor', by rotating its columns."""
    a = factor.copy()
    r = a.shape[1]
    m = r + r % 2
    if r % 2:
        a = np.concatenate([a, np.zeros((len(a), 1))], 1)
    ring = np.arange(m)
    for _ in range(SWEEPS if r > 1 else 0):
        worst = 0.0
        for _ in range(m - 1):  # every pair once, m / 2 disjoint ones at a time
            i, j = ring[:m // 2], ring[::-1][:m // 2]
            x, y = a[:, i], a[:, j]
            p, q, c = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            scale = np.sqrt(p * q)
            turn = np.abs(c) > np.finfo(float).eps * scale
            worst = max(worst, float((np.abs(c[turn]) / scale[turn]).max(initial=0)))
            zeta = np.where(turn, (q - p) / np.where(turn, 2 * c, 1), 0)
            t = np.where(turn, np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta)), 0)
            cos = 1 / np.sqrt(1 + t * t)
            a[:, i], a[:, j] = cos * x - cos * t * y, cos * t * x + cos * y
            ring = np.r_[ring[0], ring[-1], ring[1:-1]]
        if worst <= 4 * np.finfo(float).eps:
            break
    values = (a * a).sum(0)
    order = np.argsort(-values, kind="stable")[:r]
    values, a = values[order], a[:, order]
    parts = (a / np.sqrt(values)).T if r else np.zeros((0, len(a)))
    if r:  # either sign will do; take the one whose largest entry is positive
        parts *= np.sign(parts[np.arange(r), np.abs(parts).argmax(1)])[:, None]
    return values, parts


def fit(rows: DataFrame, width: int, components: int = COMPONENTS) -> Fit:
    n, sums = column_sums(rows, width)
    centre = [s // n for s in sums]
    products = scatter(rows, np.array(centre, np.int64))
    rest = [s - n * c for s, c in zip(sums, centre)]
    square = n * n
    v = np.array([[(n * products[i][j] - rest[i] * rest[j]) / square for j in range(width)] for i in range(width)])
    trace = sum(n * products[i][i] - rest[i] * rest[i] for i in range(width)) / square
    values, parts = one_sided_jacobi(pivoted_cholesky(v))
    return Fit(n, sums, parts[:components], values[:components], trace)


def _centred(column: pa.Array, model: Fit) -> np.ndarray:
    """n * x - S, exact: 64-bit integers, or Python's where they would overflow."""
    x = _matrix(column, len(model.sums))
    most = model.n * max(int(np.abs(x).max(initial=0)), 1) + max(map(abs, model.sums))
    if most < 1 << 62:
        return model.n * x - np.array(model.sums, np.int64)
    return model.n * x.astype(object) - np.array(model.sums, object)


def _project(y: np.ndarray, model: Fit) -> np.ndarray:
    return (y.astype(np.float64) / model.n) @ (model.components / np.sqrt(model.values)[:, None]).T


def identity_error(rows: DataFrame, model: Fit) -> float:
    """Largest absolute entry of the covariance of the whitened values minus the identity."""
    k = len(model.values)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            w = _project(_centred(batch.column("embedding"), model), model)
            total += np.concatenate([w.sum(0)[None], w.T @ w])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())], names=["i", "v"])

    got = dict(rows.select("embedding").mapInArrow(add, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect())
    total = np.array([got[i] for i in range((k + 1) * k)]).reshape(k + 1, k) / model.n
    return float(np.abs(total[1:] - np.outer(total[0], total[0]) - np.eye(k)).max())


def whiten(table: DataFrame, components: int = COMPONENTS, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained and identity_error of every row that takes part."""
    kind = table.schema[key].dataType.simpleString()
    rows = table.select(F.col(key).alias("vec_id"), F.col(vector).alias("embedding")).where(usable(F.col("embedding")))
    width = width_of(rows)
    rows = rows.where(F.size("embedding") == width)
    schema = f"vec_id {kind}, {_RESULT}"
    empty = table.sparkSession.createDataFrame([], schema)
    if not width:
        return empty
    model = fit(rows, width, components)
    k = len(model.values)
    if not k:
        return empty
    error = identity_error(rows, model)
    explained = [float(v) / model.trace for v in model.values]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = _centred(batch.column("embedding"), model)
            if y.dtype == object or width * float(np.abs(y).max(initial=0)) ** 2 >= 2.0 ** 62:
                whole = y.astype(object)
                deviation = [d if d < 1 << 63 else None for d in (whole * whole).sum(1).tolist()]
            else:
                deviation = (y * y).sum(1).tolist()
            w, m = _project(y, model), len(y)
            repeat = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(repeat), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, model.n)), pa.array(deviation, pa.int64()).take(repeat), pa.array(w.ravel()),
                 pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                names=["vec_id", *(c.split()[0] for c in _RESULT.split(", "))])

    return rows.mapInArrow(apply, schema)
