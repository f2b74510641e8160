"""Importance resampling towards a target corpus, ranked by parallel sorting by regular sampling.

Features of a text are its runs of 1 to ``most`` words, hashed into ``buckets``
buckets. How often a bucket occurs in the raw and in the target corpus gives
its gain (an array of ``buckets`` numbers, the one thing that the driver
holds); a document's weight is the mean gain of its features. A document of at
least ``least`` words draws a Gumbel number from its id; the ``percent`` per
cent with the highest weight + number are drawn. Their exact ranks come from a
parallel sort by regular sampling:

1. *Runs.* Every partition of the scored table sorts its rows; every
   ``stride``-th row of a run is a regular sample, so a sample stands for
   ``stride`` rows. There are about ``OVERSAMPLE`` samples a segment, whatever
   the number of rows, and they give the splitters.
2. *Prefix counts.* Each run is cut at the splitters; the counts of its
   segments, summed over the runs, say at which rank a segment begins.
3. *Exchange.* Only segments that begin within the draw are exchanged. A
   segment's pieces are merged in one task; place in the segment + prefix
   count is the rank.

The order is (score falling, doc_id rising, serial number), so a score or an
id that a third of all rows shares is cut by what follows it.

Defined cases: a null or empty text has no feature (weight 0); a null doc_id
counts as the empty text in the draw and is ordered last; repeated rows are
rows of their own, in the order of their serial numbers; an empty target or
raw table gives counts of 0; very long texts are worked on in pieces; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import bounded_batches, partitions, trimmed

#: Regular samples that the driver reads for each segment.
OVERSAMPLE = 32
PIECE = 1 << 20
#: Bytes outside of words become blanks, A-Z become a-z.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


@dataclass(frozen=True)
class Setting:
    most: int = 1            # words of the longest feature
    buckets: int = 10_000
    percent: int = 10        # share of the documents of at least `least` words
    least: int = 20
    seed: int = 2024


def features(text: str | None, setting: Setting) -> Iterator[tuple[int, np.ndarray]]:
    """(words, buckets of features) of the text's pieces; runs go on over the cuts."""
    raw = (text or "").encode().translate(WORD_BYTES)
    lo, tail = 0, []
    while lo < len(raw):
        hi = len(raw) if len(raw) - lo <= PIECE else raw.rfind(b" ", lo, lo + PIECE) + 1
        if hi <= lo:  # a word longer than a piece
            hi = raw.find(b" ", lo + PIECE) + 1 or len(raw)
        words = raw[lo:hi].split()
        held = tail + words
        grams = list(words)
        for n in range(2, setting.most + 1):
            # runs of n words that end in this piece
            first = max(0, len(tail) - n + 1)
            grams += [b" ".join(held[i:i + n]) for i in range(first, len(held) - n + 1)]
        yield len(words), np.fromiter(map(zlib.crc32, grams), np.uint32, len(grams)) % np.uint32(setting.buckets)
        tail = held[len(held) - setting.most + 1:] if setting.most > 1 else []
        lo = hi


def bucket_counts(texts: DataFrame, setting: Setting) -> np.ndarray:
    """Features in each bucket, over all rows of ``texts`` (column text)."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(setting.buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                for _, own in features(text.as_py(), setting):
                    total += np.bincount(own, minlength=setting.buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])

    bounded_batches(texts)
    counted = texts.select("text").mapInArrow(trimmed(rows), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(setting.buckets, np.int64)
    for r in counted.collect():  # at most one row a bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray, setting: Setting) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) of every bucket."""
    whole, goal = float(raw.sum() + setting.buckets), float(target.sum() + setting.buckets)
    return np.array([math.floor(1000 * math.log(float(t + 1) * whole / (float(s + 1) * goal)))
                     for s, t in zip(raw.tolist(), target.tolist())], np.int64)


def gumbel(doc_id, seed: int) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, setting: Setting) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every row, with a serial number; a written table."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros((4, batch.num_rows), np.int64)
            for i, (doc, text) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("text"))):
                words = n = total = 0
                for k, own in features(text.as_py(), setting):
                    words, n, total = words + k, n + len(own), total + int(gain[own].sum())
                weight = total // n if n else 0
                out[:, i] = words, n, weight, weight + gumbel(doc, setting.seed)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, out)],
                                             names=["doc_id", "n_words", "n_features", "weight", "score"])

    bounded_batches(docs)
    out = docs.select("doc_id", "text").mapInArrow(
        trimmed(rows), f"doc_id {kind}, n_words long, n_features long, weight long, score long")
    return materialize(out.withColumn("serial", F.monotonically_increasing_id()), "resample-scores")


def order() -> list:
    return [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("serial").asc()]


def _keys(score: np.ndarray, doc: pa.Array, serial: np.ndarray) -> np.ndarray:
    """Rows as sortable keys: (-score, id is null, id, serial)."""
    null = doc.is_null().to_numpy(zero_copy_only=False)
    ids = doc.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.rec.fromarrays([-score, null.astype(np.int64), ids, serial], names="a,b,c,d")


def splitters(eligible: DataFrame, n: int, segments: int) -> np.ndarray:
    """Keys that cut the order into about ``segments`` even parts, from regular samples of locally sorted runs."""
    stride = max(1, n // (OVERSAMPLE * segments))

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            at = np.arange(seen, seen + batch.num_rows)
            seen += batch.num_rows
            yield batch.filter(pa.array(at % stride == stride // 2))

    run = eligible.select("score", "doc_id", "serial").sortWithinPartitions(*order())
    got = run.mapInArrow(sample, run.schema).toArrow()  # about OVERSAMPLE rows a segment
    keys = _keys(got.column("score").to_numpy(), got.column("doc_id").combine_chunks(), got.column("serial").to_numpy())
    keys.sort()
    at = np.arange(1, segments) * len(keys) // segments
    return keys[np.unique(at)] if len(keys) else keys


def in_segments(eligible: DataFrame, cuts: np.ndarray) -> DataFrame:
    """``eligible`` with the number of its segment."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = _keys(batch.column("score").to_numpy(), batch.column("doc_id"), batch.column("serial").to_numpy())
            segment = np.searchsorted(cuts, keys, "right").astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(segment)], names=[*batch.schema.names, "segment"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in eligible.schema.fields)
    return eligible.mapInArrow(place, f"{kinds}, segment int")


def resample(docs: DataFrame, target: DataFrame, setting: Setting = Setting()) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null: not drawn) of every row of ``docs`` (doc_id long, text)."""
    gain = gains(bucket_counts(docs, setting), bucket_counts(target, setting), setting)
    every = scored(docs, gain, setting)
    eligible = every.where(F.col("n_words") >= setting.least)
    n = eligible.count()
    draw = setting.percent * n // 100
    cuts = splitters(eligible, n, partitions(docs.sparkSession))
    placed = in_segments(eligible, cuts)
    counts = dict(placed.groupBy("segment").count().collect())  # one row a segment
    before, begins = 0, {}
    for segment in range(len(cuts) + 1):
        begins[segment] = before
        before += counts.get(segment, 0)
    wanted = [s for s in begins if begins[s] < draw and counts.get(s)]
    columns = ["doc_id", "n_features", "weight", "score"]
    no_rank = F.lit(None).cast("long").alias("rank")
    short = every.where(F.col("n_words") < setting.least).select(*columns, no_rank)
    if not wanted:
        return short.unionByName(eligible.select(*columns, no_rank))
    offset = docs.sparkSession.createDataFrame([(s, begins[s]) for s in wanted], "segment int, skip long")  # segments are few
    last = max(wanted)
    merged = (placed.where(F.col("segment") <= last).withColumn("own", F.row_number().over(Window.partitionBy("segment").orderBy(*order())))
              .join(F.broadcast(offset), "segment").withColumn("rank", F.col("own") + F.col("skip")))
    ranked = merged.select(*columns, F.when(F.col("rank") <= draw, F.col("rank")).alias("rank"))
    return short.unionByName(ranked).unionByName(placed.where(F.col("segment") > last).select(*columns, no_rank))


_SET = Setting()
_BYTES = "list_transform(range(length(hex(encode(w))) // 2), lambda i: ('0x' || substr(hex(encode(w)), 2 * i + 1, 2))::BIGINT)"
ORACLE = f"""
WITH tab AS (SELECT list_transform(range(256), lambda n: list_reduce([n, 1, 2, 3, 4, 5, 6, 7, 8],
       lambda c, k: xor((c & 1) * 3988292384, c >> 1))) AS t),
dw AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
       '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
bw AS (SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
       '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w FROM benchmark),
dx AS (SELECT r, unnest(ws) AS w FROM dw),
voc AS (SELECT w, {_BYTES} AS b FROM (SELECT w FROM dx UNION SELECT w FROM bw)),
crc AS (SELECT w, (xor(4294967295, list_reduce(list_concat([4294967295], b), lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8))) % {_SET.buckets}) AS bucket
        FROM voc, tab),
s AS (SELECT bucket, count(*) AS s FROM dx JOIN crc USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM bw JOIN crc USING (w) GROUP BY bucket),
tot AS (SELECT (SELECT count(*) FROM dx) AS bs, (SELECT count(*) FROM bw) AS bt),
g AS (SELECT s.bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (bs + {_SET.buckets})::DOUBLE
             / ((s + 1)::DOUBLE * (bt + {_SET.buckets})::DOUBLE)))::BIGINT AS gain
      FROM s LEFT JOIN t USING (bucket), tot),
m AS (SELECT r, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM dx JOIN crc USING (w) JOIN g USING (bucket) GROUP BY r),
sc AS (SELECT doc_id, dw.r, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
       (('0x' || substr(sha256('{_SET.seed}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
       FROM dw LEFT JOIN m USING (r)),
rk AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, r) AS rank, count(*) OVER () AS n FROM sc WHERE n_features >= {_SET.least})
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= {_SET.percent} * n // 100 THEN rank END AS rank FROM sc LEFT JOIN rk USING (r)
"""
