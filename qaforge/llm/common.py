"""Helpers shared by the training-data operators.

Texts reach Python as whole Arrow batches. ``utf8`` exposes the bytes of a
string column without copying them row by row, ``spans`` cuts a batch into
runs of rows of bounded size, and the ``shingles`` family hashes words and
word n-grams of all rows of a run at once with numpy.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

RUN_BYTES = 1 << 18
#: Rows of text that reach a Python worker at once (Spark's default of 10,000 is meant for narrow rows).
BATCH_ROWS = 1000
_M = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INV = pow(BASE, -1, 1 << 64)
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_POWERS: dict[str, np.ndarray] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bounded_batches(df: DataFrame) -> None:
    """Have Spark hand texts to Python in batches of at most ``BATCH_ROWS`` rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, BATCH_ROWS)


#: What a Python worker keeps between tasks: name -> how to drop it.
CACHES: dict[str, Callable[[], None]] = {"powers": _POWERS.clear}


def trimmed(rows, keeps: tuple[str, ...] = ("powers",)):
    """``rows``, a function over batches, that gives freed memory back to the system when its task ends.

    Python workers are reused by the next stages; what they and the allocators
    keep would add up. A task drops the caches that it does not name.
    """
    def run(batches):
        for name, drop in CACHES.items():
            if name not in keeps:
                drop()
        yield from rows(batches)
        trim()

    return run


def trim() -> None:
    """Give freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):  # glibc
        libc.malloc_trim(0)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column (null counts as empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def spans(offsets: np.ndarray, most: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes; a longer row is a range of its own."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse modulo 2**64 for i < n; those of a run are kept, those of a longer text are not."""
    if n > RUN_BYTES + 1:
        return _powers(BASE, n), _powers(BASE_INV, n)
    if not _POWERS:
        _POWERS.update(p=_powers(BASE, RUN_BYTES + 1), q=_powers(BASE_INV, RUN_BYTES + 1))
    return _POWERS["p"][:n], _POWERS["q"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads all bits of a 64-bit value."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Running sum of (byte + 1) * BASE**i, with a leading zero."""
    p, _ = powers(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * p, out=out[1:])
    return out


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes [start, end): equal strings have equal hashes wherever they stand."""
    _, q = powers(len(sums))
    length = (end - start).astype(np.uint64)
    return mix((sums[end] - sums[start]) * q[start] + length * np.uint64(0xD6E8FEB86659FD93))


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word ``[^\\x20\\x09-\\x0D]+`` and, by row, the index of its first word."""
    n = len(data)
    white = WHITE[data]
    first, last = np.ones(n, bool), np.ones(n, bool)
    if n:
        first[1:] = white[:-1]
        last[:-1] = white[1:]
        inner = offsets[1:-1]
        inner = inner[(inner > 0) & (inner < n)]
        first[inner] = True
        last[inner - 1] = True
    start = np.flatnonzero(first & ~white)
    end = np.flatnonzero(last & ~white) + 1
    return start, end, np.searchsorted(start, offsets)


#: Words over so many bytes are hashed one by one: long strings built to collide modulo 2**64 exist for every base.
LONG_WORD = 128


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words [start, end)."""
    out = range_hash(prefix_sums(data), start, end)
    for i in np.flatnonzero(end - start > LONG_WORD):
        out[i] = xxhash.xxh3_64_intdigest(data[start[i]:end[i]].tobytes())
    return out


SHINGLE = 5
_ODD = [np.uint64((0xA0761D6478BD642F + 2 * k * 0xE7037ED1A0B428DB) & _M | 1) for k in range(SHINGLE)]


def shingle_hashes(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Distinct 64-bit hashes, ascending, of the five-word shingles of each row.

    A-Z is lower-cased; a row of one to four words has its whole sequence as
    its one shingle; a row without words has none.
    """
    data = LOWER[data]
    start, end, first = word_bounds(data, offsets)
    words = word_hashes(data, start, end)
    parts = [words * k for k in _ODD]
    n = len(words) - SHINGLE + 1
    grams = mix(sum((parts[k][k:k + n] for k in range(1, SHINGLE)), parts[0][:n].copy())) if n > 0 else words[:0]
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= SHINGLE:
            out.append(np.unique(grams[a:b - SHINGLE + 1]))
        elif b > a:
            whole = sum((parts[k][a + k:a + k + 1] for k in range(1, b - a)), parts[0][a:a + 1].copy())
            out.append(mix(whole + np.uint64(b - a)))
        else:
            out.append(words[:0])
    return out
