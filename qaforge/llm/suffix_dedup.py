"""Removal of repeated 400-byte strings by blockwise suffix sorting with a difference cover.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts
anywhere else in the corpus, in the same document or another; strings never
cross documents and are judged on the input. What counts is which suffixes
agree in their first ``LENGTH`` bytes, so suffixes are ordered by a 64-bit
hash of that prefix, and equal neighbours in the order are repeated strings.
Sorting every suffix would move eight bytes per byte of text, therefore:

1. *Cover sample.* A difference cover D modulo v has, for any two positions
   i and j, a shift d < v with i + d and j + d both in the cover. The suffixes
   at the cover's positions (6 % of all, v = 273) are ranked by their first
   ``LENGTH - v + 1`` bytes: a sample's rank is shared or its own. If two
   strings of ``LENGTH`` bytes agree, both have, at the same shift below v, a
   sample that shares its rank. A suffix all of whose samples below v have
   ranks of their own is thus settled, however long its ties.
2. *Blocks.* The remaining suffixes are sorted one bucket at a time:
   ``PASSES`` passes over ranges of the prefix order, each dealt over the
   cluster, so that only a fraction of them is on disk or in memory at once.
   A pass reports the suffixes whose prefix is unique.
3. *Removal.* Remaining suffixes that were not reported are repeated; the
   bytes they cover are cut.

Equal texts are one text here; a text of ``LENGTH`` bytes or more that occurs
in several rows goes as a whole. In each batch, suffixes with equal prefixes
are merged to one before the shuffle, so a passage of a third of all
documents reaches a bucket once per batch.

Defined cases: a null text is empty (0 bytes, the digest of no bytes); texts
shorter than ``LENGTH`` bytes are kept whole; repeated rows are repeated
texts; null ids are carried; very long texts are worked on in stretches; ties
do not arise; an empty table gives an empty result; other columns are not
read. Strings and texts are told apart by 64-bit hashes (a repeated string
must collide in two of them, its prefix and a sample, to be mistaken).
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import bounded_batches, partitions, prefix_sums, range_hash, spans, trimmed, utf8

LENGTH = 400
#: A perfect difference set modulo 273: every difference occurs once.
MODULUS = 273
COVER = [1, 2, 4, 8, 16, 32, 64, 91, 117, 128, 137, 182, 195, 205, 234, 239, 256]
SAMPLE = LENGTH - MODULUS + 1
PASSES = 4
STRETCH = 1 << 20
BATCH = 4 << 20
#: Rows up to which a table of places per text is broadcast.
PLACE_ROWS = 300_000
#: Bytes of text for each bucket of samples or suffixes.
BUCKET_BYTES = 64 << 20


def keys_at(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the strings of ``length`` bytes at ascending starts, in stretches."""
    out = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        base = int(starts[lo])
        hi = int(np.searchsorted(starts, base + STRETCH, "right"))
        sums = prefix_sums(data[base:base + STRETCH + length + 1])
        at = starts[lo:hi] - base
        out[lo:hi] = range_hash(sums, at, at + length)
        lo = hi
    return out


def sample_starts(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, position in the row) of the cover's positions of all rows with ``LENGTH`` bytes or more, ascending."""
    size = np.diff(offsets)
    n = np.where(size >= LENGTH, size - SAMPLE + 1, 0)
    periods = -(-n // MODULUS)
    ends = np.cumsum(periods)
    row = np.repeat(np.arange(len(n)), periods)
    turn = np.arange(len(row)) - np.repeat(ends - periods, periods)
    pos = (turn * MODULUS)[:, None] + np.array(COVER)[None, :]
    keep = pos < n[row][:, None]
    return np.broadcast_to(row[:, None], pos.shape)[keep], pos[keep]


def open_windows(n_bytes: int, samples: np.ndarray, length: int = LENGTH, modulus: int = MODULUS) -> np.ndarray:
    """Starts of the strings that have a sample of shared rank at a shift below ``modulus``."""
    last = n_bytes - length
    delta = np.zeros(last + 2, np.int64)
    np.add.at(delta, np.clip(samples - modulus + 1, 0, last + 1), 1)
    np.add.at(delta, np.clip(samples, 0, last) + 1, -1)
    return np.flatnonzero(np.cumsum(delta[:-1]) > 0)


# --- equal keys over the cluster ---------------------------------------------

KEYED = "bucket int, blob binary"
PLACES = "node long, places binary"


def pack_places(pos: np.ndarray) -> bytes:
    """Ascending positions, as compressed differences."""
    return zstandard.ZstdCompressor(1).compress(np.diff(pos, prepend=0).astype(np.uint32).tobytes())


def read_places(blob: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint32).astype(np.int64))


def pack_keys(keys: np.ndarray, node: np.ndarray, pos: np.ndarray, buckets: int, shared: bool) -> pa.RecordBatch:
    """One row per bucket: keys and places, of equal keys only the first, marked.

    With ``shared`` the places of keys that are equal here travel along as
    known answers (a bucket's blob has two parts).
    """
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    first = np.r_[True, k[1:] != k[:-1]] if len(k) else np.zeros(0, bool)
    same = ~first
    many = same.copy()
    many[:-1] |= same[1:]
    marked = np.zeros(len(keys), bool)
    marked[order] = many
    sent = np.zeros(len(keys), bool)
    sent[order] = first
    known = marked & ~sent & shared
    packer = zstandard.ZstdCompressor(1)
    bucket = (keys % np.uint64(buckets)).astype(np.int32)
    rows, blobs = [], []
    by = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[by], np.arange(buckets + 1))
    for b in range(buckets):
        at = by[cuts[b]:cuts[b + 1]]  # in order of place
        if not len(at):
            continue
        parts = []
        for part, some in enumerate((at[sent[at]], at[known[at]])):
            place = np.empty((2, len(some)), np.int64)
            names, place[0] = np.unique(node[some], return_inverse=True)
            place[1] = pos[some]
            d = np.diff(place, axis=1, prepend=0).astype(np.int32)
            parts += [np.array([len(some), len(names)], np.int64).tobytes(), names.astype(np.int64).tobytes()]
            tail = packer.compress(d.tobytes() + marked[some].tobytes())
            parts += [np.array([len(tail)], np.int64).tobytes(), tail]
            if part == 0:
                parts.append(keys[some].tobytes())
        rows.append(b)
        blobs.append(b"".join(parts))
    return pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "blob"])


def read_keys(blob: bytes):
    """(keys, node, pos, marked) and the known (node, pos) of one row."""
    out, at = [], 0
    for part in range(2):
        n, names = np.frombuffer(blob, np.int64, 2, at)
        at += 16
        name = np.frombuffer(blob, np.int64, names, at)
        at += 8 * int(names)
        size = int(np.frombuffer(blob, np.int64, 1, at)[0])
        at += 8
        raw = zstandard.ZstdDecompressor().decompress(blob[at:at + size], max_output_size=9 * int(n) + 16)
        at += size
        place = np.cumsum(np.frombuffer(raw, np.int32, 2 * int(n)).reshape(2, -1).astype(np.int64), axis=1)
        out += [name[place[0]], place[1]]
        if part == 0:
            marked = np.frombuffer(raw, bool, int(n), 8 * int(n))
            keys = np.frombuffer(blob, np.uint64, int(n), at)
            at += 8 * int(n)
    return keys, out[0], out[1], marked, out[2], out[3]


def _answer(shared: bool, targets: int):
    def settle(group: pa.Table) -> pa.Table:
        """Sort one bucket; the places of its shared (or unique) keys, one row per range of nodes."""
        got = [read_keys(b.as_py()) for b in group.column("blob")]
        keys, node, pos, marked, known_node, known_pos = (np.concatenate(x) for x in zip(*got))
        order = np.lexsort((pos, node, keys))
        k, x, p = keys[order], node[order], pos[order]
        start = np.r_[True, k[1:] != k[:-1]]
        # the same place may come from several copies of a text
        fresh = np.r_[True, (k[1:] != k[:-1]) | (x[1:] != x[:-1]) | (p[1:] != p[:-1])]
        first = np.flatnonzero(start)
        n = np.add.reduceat(fresh.astype(np.int64), first) + np.add.reduceat(marked[order].astype(np.int64), first)
        several = np.repeat(n > 1, np.diff(np.r_[first, len(k)]))
        take = (several if shared else ~several) & fresh
        x, p = np.r_[x[take], known_node], np.r_[p[take], known_pos]
        target = (x.view(np.uint64) % np.uint64(targets)).astype(np.int32)
        order = np.lexsort((p, x, target))
        x, p = x[order], p[order]
        cuts = np.searchsorted(target[order], np.arange(targets + 1))
        some = np.flatnonzero(np.diff(cuts))
        return pa.table({"target": pa.array(some, pa.int32()), "blob": pa.array(
            [pack_answer(x[cuts[t]:cuts[t + 1]], p[cuts[t]:cuts[t + 1]]) for t in some], pa.binary())})

    return settle


def pack_answer(node: np.ndarray, pos: np.ndarray) -> bytes:
    names, count = np.unique(node, return_counts=True)
    d = np.diff(pos, prepend=0).astype(np.int32)
    return b"".join([np.array([len(names)], np.int64).tobytes(), names.tobytes(), count.astype(np.int64).tobytes(),
                     zstandard.ZstdCompressor(1).compress(d.tobytes())])


def read_answer(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(blob, np.int64, 1)[0])
    names, count = np.frombuffer(blob, np.int64, n, 8), np.frombuffer(blob, np.int64, n, 8 + 8 * n)
    d = zstandard.ZstdDecompressor().decompress(blob[8 + 16 * n:])
    return np.repeat(names, count), np.cumsum(np.frombuffer(d, np.int32).astype(np.int64))


def _merge(group: pa.Table) -> pa.Table:
    """One row per node of a range of nodes."""
    x, p = (np.concatenate(c) for c in zip(*[read_answer(b.as_py()) for b in group.column("blob")]))
    order = np.lexsort((p, x))
    x, p = x[order], p[order]
    cuts = np.flatnonzero(np.r_[True, x[1:] != x[:-1]])
    ends = np.r_[cuts[1:], len(x)]
    return pa.table({"node": pa.array(x[cuts]), "places": pa.array(
        [pack_places(p[a:b]) for a, b in zip(cuts.tolist(), ends.tolist())], pa.binary())})


def settle_keys(keyed: DataFrame, shared: bool, name: str) -> DataFrame:
    """(node, places) of every node with such places."""
    targets = max(partitions(keyed.sparkSession), 16)
    settled = keyed.groupBy("bucket").applyInArrow(_answer(shared, targets), "target int, blob binary")
    return materialize(settled.groupBy("target").applyInArrow(_merge, PLACES), name)


def release(spark) -> None:
    """Let Spark's cleaner drop the shuffle files of finished passes now."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()


# --- the operator ---------------------------------------------------------------

def buckets_for(texts: DataFrame) -> int:
    """Buckets that grow with the bytes of text, so that a bucket's task keeps its size."""
    n_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(partitions(texts.sparkSession), 16, n_bytes // BUCKET_BYTES)


def texts_of(docs: DataFrame) -> DataFrame:
    bounded_batches(docs)
    return docs.select("doc_id", "text", F.xxhash64("text").alias("node"))


def shared_samples(texts: DataFrame) -> DataFrame:
    """(node, places) of the cover samples whose rank is shared."""
    buckets = buckets_for(texts)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            nodes = batch.column("node").to_numpy()
            for lo, hi in spans(offsets, BATCH):
                _, first = np.unique(nodes[lo:hi], return_index=True)
                row, pos = sample_starts(offsets[lo:hi + 1])
                own = np.zeros(hi - lo, bool)
                own[first] = True
                row, pos = row[own[row]], pos[own[row]]
                if len(row):
                    keys = keys_at(data, offsets[lo + row] + pos, SAMPLE)
                    yield pack_keys(keys, nodes[lo + row], pos, buckets, True)

    long = texts.where(F.octet_length("text") >= LENGTH).select("node", "text")
    return settle_keys(long.mapInArrow(trimmed(rows), KEYED), True, "suffix-samples")


def unique_windows(work: DataFrame, number: int, buckets: int) -> DataFrame:
    """(node, places) of the remaining suffixes of one block whose prefix is unique."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = zstandard.ZstdDecompressor()
        for batch in batches:
            held, weight = [], 0

            def flush():
                keys, node, pos = (np.concatenate(x) for x in zip(*held))
                return pack_keys(keys, node, pos, buckets, False)

            for node, blob, places in zip(batch.column("node").to_pylist(), batch.column("blob"), batch.column("places")):
                data = np.frombuffer(reader.decompress(blob.as_py()), np.uint8)
                at = open_windows(len(data), read_places(places.as_py()))
                for lo in range(0, len(at), STRETCH):
                    some = at[lo:lo + STRETCH]
                    keys = keys_at(data, some, LENGTH)
                    mine = (keys >> np.uint64(32)) % np.uint64(PASSES) == number
                    held.append((keys[mine], np.full(int(mine.sum()), node, np.int64), some[mine]))
                    weight += len(held[-1][0])
                    if weight > 1 << 20:
                        yield flush()
                        held, weight = [], 0
            if weight:
                yield flush()

    return settle_keys(work.mapInArrow(trimmed(rows), KEYED), False, f"suffix-block{number}")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(node, spans): starts and ends of the bytes to remove of every text that has some, once per different text."""
    spark = docs.sparkSession
    texts = texts_of(docs)
    copies = texts.where(F.octet_length("text") >= LENGTH).groupBy("node").agg(
        F.min("doc_id").alias("first"), F.count("*").alias("copies"), F.max(F.octet_length("text")).alias("n"))
    copies = materialize(copies, "suffix-texts")
    samples = shared_samples(texts)
    release(spark)
    wanted = materialize(samples.join(copies, "node").select(F.col("node").alias("_node"), "first", "places"), "suffix-wanted")
    chosen = texts.join(F.broadcast(wanted) if wanted.limit(PLACE_ROWS + 1).count() <= PLACE_ROWS else wanted,
                        (F.col("node") == F.col("_node")) & F.col("doc_id").eqNullSafe(F.col("first")))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(3)
        for batch in batches:
            blobs = [packer.compress(t.as_py().encode()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("places"), pa.array(blobs, pa.binary())],
                                             names=["node", "places", "blob"])

    work = materialize(chosen.select("node", "places", "text").mapInArrow(trimmed(pack), "node long, places binary, blob binary"),
                       "suffix-work")
    unique, buckets = [], buckets_for(texts)
    for number in range(PASSES):
        unique.append(unique_windows(work, number, buckets))
        release(spark)
    every = unique[0]
    for more in unique[1:]:
        every = every.unionByName(more)
    settled = every.groupBy("node").agg(F.collect_list("places").alias("unique"))
    open_ = (copies.join(wanted.select(F.col("_node").alias("node"), "places"), "node", "left").where("copies > 1 or places is not null")
             .join(settled, "node", "left"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for n, copies, places, unique in zip(*(batch.column(c).to_pylist() for c in ("n", "copies", "places", "unique"))):
                if copies > 1:
                    out.append(np.array([[0], [n]], np.int64).tobytes())
                    continue
                left = open_windows(n, read_places(places))
                if unique:
                    left = np.setdiff1d(left, np.concatenate([read_places(u) for u in unique]))
                gap = np.flatnonzero(np.diff(left) > LENGTH)  # strings that meet or overlap are one span
                start, end = left[np.r_[0, gap + 1]] if len(left) else left, left[np.r_[gap, len(left) - 1]] + LENGTH if len(left) else left
                out.append(np.stack([start, end]).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(out, pa.binary())], names=["node", "spans"])

    return materialize(open_.mapInArrow(trimmed(cut), "node long, spans binary").where("length(spans) > 0"), "suffix-spans")


def kept_of(text: bytes, spans_: bytes | None) -> tuple[list[bytes], int, int]:
    """(kept parts, bytes removed, spans removed)."""
    if not spans_:
        return [text], 0, 0
    start, end = np.frombuffer(spans_, np.int64).reshape(2, -1).tolist()
    parts = [text[a:b] for a, b in zip([0, *end], [*start, len(text)])]
    return parts, sum(end) - sum(start), len(start)


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """doc_id, kept (the remaining bytes), n_bytes, n_removed, n_spans and kept_sha256 of every row of ``docs``."""
    spans_ = repeated_spans(docs).withColumnRenamed("node", "_node")
    if spans_.limit(PLACE_ROWS + 1).count() <= PLACE_ROWS:
        spans_ = F.broadcast(spans_)
    texts = texts_of(docs)
    joined = texts.join(spans_, F.col("node") == F.col("_node"), "left").select("doc_id", "text", "spans")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                kept, size, gone, n, digest = [], [], [], [], []
                for text, s in zip(part.column("text"), part.column("spans")):
                    raw = (text.as_py() or "").encode()
                    parts, removed, count = kept_of(raw, s.as_py())
                    size.append(len(raw))
                    gone.append(removed)
                    n.append(count)
                    kept.append(b"".join(parts))
                    digest.append(hashlib.sha256(kept[-1]).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(kept, pa.binary()), *(pa.array(x, pa.int64()) for x in (size, gone, n)),
                     pa.array(digest, pa.string())], names=["doc_id", "kept", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return joined.mapInArrow(trimmed(rows), f"doc_id {kind}, kept binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


ORACLE = f"""
WITH b AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (SELECT doc_id, i, md5(b[i:i + {LENGTH - 1}]) AS h FROM (SELECT doc_id, b, unnest(range(1, octet_length(b) - {LENGTH - 2})) AS i FROM b)),
rep AS (SELECT doc_id, i FROM w WHERE h IN (SELECT h FROM w GROUP BY h HAVING count(*) > 1)),
cut AS (SELECT *, (i > lag(i, 1, -{LENGTH}) OVER (PARTITION BY doc_id ORDER BY i) + {LENGTH})::INTEGER AS first FROM rep),
isl AS (SELECT *, sum(first) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM cut),
span AS (SELECT doc_id, min(i) AS s, max(i) + {LENGTH} AS e FROM isl GROUP BY doc_id, k),
gap AS (SELECT doc_id, lag(e, 1, 1) OVER (PARTITION BY doc_id ORDER BY s) AS a, s AS z FROM span
        UNION ALL SELECT doc_id, max(e), NULL FROM span GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(hex(b[a:coalesce(z - 1, octet_length(b))]), '' ORDER BY a) AS hex
         FROM gap JOIN b USING (doc_id) WHERE a < coalesce(z, octet_length(b) + 1) GROUP BY doc_id),
gone AS (SELECT doc_id, sum(e - s)::BIGINT AS n_removed, count(*) AS n_spans FROM span GROUP BY doc_id)
SELECT b.doc_id, octet_length(b.b)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(CASE WHEN gone.doc_id IS NULL THEN b.b ELSE unhex(coalesce(kept.hex, '')) END) AS kept_sha256,
       coalesce(n_removed, 0) > 0 AS has_repeat
FROM b LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
