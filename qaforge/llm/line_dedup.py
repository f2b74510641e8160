"""Line dedup over content-defined chunks of lines that overlap.

What repeats in a corpus are runs of lines, in surroundings that differ. A chunk
that ends at a cut chosen by content hangs on lines outside of a run as short
as itself, so whole chunks miss most runs. The chunks here are as short as a
run can be and overlap: every two neighbouring lines with text (blank lines
between them do not count) are a chunk, named by a rolling hash over their two
line hashes. What stands around a run changes none of the chunks inside it, and
an inserted or removed line changes those next to it only.

Of every chunk that stands in several places of the corpus, the first place is
kept (smallest doc_id, null last, then position); in the others its lines are
removed, with the blank lines between them. Neighbouring removed chunks grow
together to one run, so of a passage of two lines or more all lines go outside
its first place. Chunk hashes are counted first, pre-aggregated in each task;
only chunks whose hash repeats are compared, byte by byte (grouped by the
chunk's text).

Defined cases: null text stays null; a text without a repeated chunk is
returned unchanged; rows that share doc_id and text are one document given
twice and get the same result; of equal texts with the same doc_id nothing is
lost; a chunk that a text repeats itself stays at its first place; a text all of
whose lines are removed becomes empty; very long lines and texts are whole;
empty tables give an empty result; all columns of ``docs`` are carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..session import materialize
from .common import bounded_batches, trimmed

PRIME = (1 << 64) - 59
FACTOR = 6_364_136_223_846_793_005
BLANK = " \t\r\v\f"
#: Rows up to which a side is broadcast: hashes (8 bytes) and places (about 60 bytes).
HASH_ROWS = 1_000_000
PLACE_ROWS = 300_000


def line_hash(line: str) -> int:
    return int.from_bytes(hashlib.md5(line.encode()).digest()[8:], "big")


def chunks(lines: list[str]) -> list[tuple[int, int]]:
    """(first, last line) of every two neighbouring lines with text."""
    full = [i for i, line in enumerate(lines) if line.strip(BLANK)]
    return list(zip(full, full[1:]))


def rolling(first: int, second: int) -> int:
    """The rolling hash of two line hashes, as a signed 64-bit number."""
    h = (first * FACTOR + second) % PRIME
    return h - (1 << 64) if h >> 63 else h


def _chunk_rows(docs: DataFrame, with_text: bool) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column("doc_id").to_pylist(), batch.column("_t").to_pylist()
            rows: list[tuple] = []
            weight = 0
            for d, t, text in zip(ids, keys, batch.column("text")):
                lines = text.as_py().split("\n")
                hashes = {}
                for i, (a, b) in enumerate(chunks(lines)):
                    before = hashes.get(a) or line_hash(lines[a])
                    hashes = {b: line_hash(lines[b])}
                    whole = f"{lines[a]}\n{lines[b]}" if with_text else None
                    rows.append((d, t, i, rolling(before, hashes[b]), whole))
                    weight += len(whole) if with_text else 0
                    if len(rows) > 20_000 or weight > 4 << 20:
                        yield _pack(rows)
                        rows, weight = [], 0
                if len(rows) > 20_000 or weight > 4 << 20:
                    yield _pack(rows)
                    rows, weight = [], 0
            if rows:
                yield _pack(rows)

    def _pack(rows):
        d, t, i, h, x = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(d, id_type), pa.array(t, pa.int64()), pa.array(i, pa.int32()),
                                           pa.array(h, pa.int64()), pa.array(x, pa.string())],
                                          names=["doc_id", "_t", "i", "h", "chunk"])

    id_type = to_arrow_type(docs.schema["doc_id"].dataType)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(trimmed(cut), f"doc_id {kind}, _t long, i int, h long, chunk string")


def _small(df: DataFrame, most: int) -> DataFrame:
    """``df`` (a written table), marked for broadcast if it has at most ``most`` rows."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, _t, i): the chunks to remove.

    All joins are between written tables, so Spark can split a hot chunk's
    partition; the groupings are pre-aggregated.
    """
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("_t")).where("instr(text, '\n') > 0")
    again = materialize(_chunk_rows(texts, False).groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"),
                        "line-hashes")
    same = materialize(_chunk_rows(texts, True).join(_small(again, HASH_ROWS), "h"), "line-chunks")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_t", "i")
    # the byte comparison: one group per chunk text; its digest names it from here on
    first = materialize(same.groupBy("h", "chunk").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
                        .select(F.col("h").alias("_h"), F.sha2("chunk", 256).alias("_digest"), "first"), "line-first")
    named = same.select("h", F.sha2("chunk", 256).alias("digest"), "doc_id", "_t", "i")
    return (named.join(_small(first, PLACE_ROWS), (F.col("h") == F.col("_h")) & (F.col("digest") == F.col("_digest")))
            .where(place != F.col("first")).select("doc_id", "_t", "i"))


def dedup_lines(docs: DataFrame, counts: bool = False) -> DataFrame:
    """``docs`` with repeated lines cut out of ``text``; with ``counts`` also n_lines, n_removed (lines) and n_chunks_removed
    (runs of removed lines)."""
    bounded_batches(docs)
    gone = materialize(repeated_chunks(docs).groupBy("doc_id", "_t").agg(F.sort_array(F.collect_set("i")).alias("_gone"))
                       .withColumnRenamed("doc_id", "_id").withColumnRenamed("_t", "_k"), "line-gone")
    # the row stands in one struct, so that no column of docs meets a helper column's name
    keyed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.xxhash64("text").alias("t"))
    joined = keyed.join(_small(gone, PLACE_ROWS), F.col("row.doc_id").eqNullSafe(F.col("_id")) & (F.col("t") == F.col("_k")),
                        "left").select("row", "_gone")
    extra = ", n_lines int, n_removed int, n_chunks_removed int" if counts else ""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields) + extra
    columns = docs.columns
    at = columns.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, n_lines, n_gone, n_chunks = [], [], [], []
            row = batch.column("row").flatten()
            for text, gone in zip(row[at].to_pylist(), batch.column("_gone").to_pylist()):
                lines = text.count("\n") + 1 if text else 0
                removed = runs = 0
                if gone:
                    every, kept, end = text.split("\n"), [], 0  # end: line after the run so far
                    cut = chunks(every)
                    for a, b in (cut[i] for i in gone):
                        if a >= end:
                            kept += every[end:a]
                            runs += 1
                        removed += b + 1 - max(a, end)
                        end = b + 1
                    text = "\n".join(kept + every[end:])
                out.append(text)
                n_lines.append(lines)
                n_gone.append(removed)
                n_chunks.append(runs)
            arrays = row
            arrays[at] = pa.array(out, pa.string())
            names = list(columns)
            if counts:
                arrays += [pa.array(x, pa.int32()) for x in (n_lines, n_gone, n_chunks)]
                names += ["n_lines", "n_removed", "n_chunks_removed"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return joined.mapInArrow(trimmed(cut), schema)


ORACLE = """
WITH t AS (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS p FROM t),
f AS (SELECT *, lead(line) OVER w AS after, lead(p) OVER w AS q FROM l WHERE trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) <> ''
      WINDOW w AS (PARTITION BY doc_id, text ORDER BY p)),
g AS (SELECT doc_id, text, p, q FROM f WHERE after IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY line || chr(10) || after ORDER BY doc_id NULLS LAST, text, p) > 1),
d AS (SELECT DISTINCT doc_id, text, unnest(range(p, q + 1)) AS p FROM g),
m AS (SELECT l.*, d.p IS NOT NULL AS gone FROM l LEFT JOIN d ON l.doc_id IS NOT DISTINCT FROM d.doc_id AND l.text = d.text AND l.p = d.p),
r AS (SELECT *, gone AND NOT lag(gone, 1, false) OVER (PARTITION BY doc_id, text ORDER BY p) AS first FROM m),
o AS (SELECT doc_id, text, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed, count(*) FILTER (first) AS n_chunks_removed,
             coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '') AS kept FROM r GROUP BY doc_id, text)
SELECT d.doc_id, sha256(o.kept) AS kept_sha256, CASE WHEN d.text = '' THEN 0 ELSE coalesce(n_lines, 0) END::INTEGER AS n_lines,
       coalesce(n_removed, 0)::INTEGER AS n_removed, coalesce(n_chunks_removed, 0)::INTEGER AS n_chunks_removed
FROM documents d LEFT JOIN o ON d.doc_id IS NOT DISTINCT FROM o.doc_id AND d.text = o.text
"""
