"""Removal of repeated runs of words with suffix automata of reference shards.

A word goes if a window of ``WINDOW`` consecutive words that covers it also
starts in a document with a smaller doc_id. Words are compared as bytes.

1. *Anchors.* Of every ``SPREAD`` neighbouring runs of ``GRAM`` words, the one
   with the least hash is an anchor. The anchors chosen inside a window hang on
   its words alone, so all of them are shared by every document that holds
   the window. Windows with an anchor that stands in one text only are out.
2. *Reference shards.* A remaining window belongs to the least anchor inside it;
   the neighbouring windows of one anchor make a stretch, which goes to the
   shard of that anchor. A shard's task takes its stretches by rising doc_id: it
   streams them through the suffix automaton of the shard (the matching
   statistic of a word is the length of the longest run of words that ends
   there and is in the automaton; ``WINDOW`` or more is a match), then adds
   those that hold something new. So the automaton always holds the smaller
   doc_ids, each run of words once, however many documents repeat it.
3. *Hot anchors.* The stretches of an anchor with more than ``HOT`` places are
   dealt over salts. Windows that find no match in their own salt meet those of
   the other salts in a second round, one by one, in shards chosen by a hash of
   their words; copies of a window are there at most once for each salt.
4. Matched windows are joined into spans by text and cut.

Hashes only choose what meets where; every match is one of words. Equal texts
(two 64-bit hashes) are worked on once, for their smallest doc_id; later
copies of ``WINDOW`` words or more go as a whole.

Defined cases: a null or empty text has no word; a null doc_id counts as
larger than all others, and two nulls as equal; rows that share a doc_id do
not remove each other's words, nor does a text its own; repeated rows are
treated alike; a word may be of any length; very long texts are hashed row by
row, at some 40 bytes a word; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import bounded_batches, mix, powers, trimmed, word_bounds, word_hashes

WINDOW = 50
GRAM = 12
SPREAD = 24
#: Places of an anchor above which they are dealt over salts, and stretches that a shard holds on average.
HOT = 500
SHARD = 1500
#: Rows and list entries up to which a table of spans is broadcast.
PLACE_ROWS, PLACE_ENTRIES = 10_000, 100_000
ROWS = "node long, doc_id {kind}, lo int, hi int, key long, hot boolean, words binary"


# --- anchors --------------------------------------------------------------------

def least(x: np.ndarray, width: int) -> np.ndarray:
    """Place of the (leftmost) least value of every ``width`` neighbours."""
    at, have = np.arange(len(x)), 1
    while have < width:
        step = min(have, width - have)
        a, b = at[:-step], at[step:]
        at, have = np.where(x[b] < x[a], b, a), have + step
    return at


def grams_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) of the words of a text and the hashes of its runs of ``GRAM`` words."""
    start, end, _ = word_bounds(data, np.array([0, len(data)]))
    n = len(start) - GRAM + 1
    if len(start) < WINDOW:
        return start, end, np.zeros(0, np.uint64)
    p, q = powers(len(start) + 1)
    sums = np.zeros(len(start) + 1, np.uint64)
    np.cumsum(word_hashes(data, start, end) * p[:-1], out=sums[1:])
    return start, end, mix((sums[GRAM:] - sums[:-GRAM]) * q[:n])


def anchors(texts: DataFrame) -> DataFrame:
    """anchor, node, pos (word at which it starts) of all texts."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = zstandard.ZstdDecompressor()
        for batch in batches:
            held = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
            for node, blob in zip(batch.column("node").to_pylist(), batch.column("blob")):
                _, _, grams = grams_of(np.frombuffer(reader.decompress(blob.as_py()), np.uint8))
                if len(grams):
                    pos = np.unique(least(grams, SPREAD))
                    held.append((grams[pos], np.full(len(pos), node), pos))
            grams, node, pos = (np.concatenate(x) for x in zip(*held))
            yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(node), pa.array(pos.astype(np.int32))],
                                             names=["anchor", "node", "pos"])

    return texts.select("node", "blob").mapInArrow(trimmed(rows), "anchor long, node long, pos int")


def candidates(data: np.ndarray, shared: np.ndarray, salts: np.ndarray
               ) -> Iterator[tuple[int, int, int, int, np.ndarray]]:
    """(first window, last window, anchor, salts, bytes) of the stretches that may repeat."""
    start, end, grams = grams_of(data)
    of = np.zeros(len(grams), np.int32)
    of[shared] = salts
    bad = np.r_[0, np.cumsum(of[least(grams, SPREAD)] == 0)]
    n = len(start) - WINDOW + 1
    inner = WINDOW - GRAM + 1  # runs of GRAM words in a window
    clean = bad[inner - SPREAD + 1:][:n] == bad[:n]
    route = least(grams, inner)
    cut = np.flatnonzero(np.r_[True, (route[1:] != route[:-1]) | (clean[1:] != clean[:-1])])
    for a, b in zip(cut.tolist(), np.r_[cut[1:], n].tolist()):
        if clean[a]:
            yield a, b - 1, int(grams[route[a]]), int(of[route[a]]), data[start[a]:end[b + WINDOW - 2]]


def stretches(work: DataFrame, kind: str) -> DataFrame:
    """The stretches of all texts (node, doc_id, blob, places), with the key of their shard."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = zstandard.ZstdDecompressor()
        for batch in batches:
            for i, (node, blob, places) in enumerate(zip(*(batch.column(c) for c in ("node", "blob", "places")))):
                node = node.as_py()
                pos, salts = (places.values.field(c).to_numpy() for c in ("pos", "salts"))
                found = list(candidates(np.frombuffer(reader.decompress(blob.as_py()), np.uint8), pos, salts))
                if found:
                    lo, hi, anchor, n, words = zip(*found)
                    n = np.array(n)
                    key = mix(np.array(anchor, np.uint64) + (np.uint64(node) % n.astype(np.uint64)))
                    doc = batch.column("doc_id").take(pa.array(np.full(len(found), i)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(found), node)), doc, pa.array(lo, pa.int32()), pa.array(hi, pa.int32()),
                         pa.array(key.view(np.int64)), pa.array(n > 1), pa.array([w.tobytes() for w in words], pa.binary())],
                        names=[c.split()[0] for c in ROWS.split(", ")])

    return work.mapInArrow(trimmed(rows), ROWS.format(kind=kind))


# --- automata -------------------------------------------------------------------

class Automaton:
    """Suffix automaton of sequences of words, extended one sequence at a time."""

    def __init__(self):
        self.step, self.link, self.length = [{}], [-1], [0]

    def _state(self, step: dict, link: int, length: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        return len(self.step) - 1

    def _split(self, p: int, q: int, word) -> int:
        """The state of the runs that end with ``word`` after p: q itself, or a copy of q for the shorter ones."""
        if self.length[p] + 1 == self.length[q]:
            return q
        copy = self._state(dict(self.step[q]), self.link[q], self.length[p] + 1)
        self.link[q] = copy
        while p >= 0 and self.step[p].get(word) == q:
            self.step[p][word] = copy
            p = self.link[p]
        return copy

    def add(self, words: list) -> None:
        last = 0
        for word in words:
            q = self.step[last].get(word)
            if q is not None:
                last = self._split(last, q, word)
                continue
            new, p = self._state({}, 0, self.length[last] + 1), last
            while p >= 0 and word not in self.step[p]:
                self.step[p][word] = new
                p = self.link[p]
            if p >= 0:
                self.link[new] = self._split(p, self.step[p][word], word)
            last = new

    def statistics(self, words: list) -> Iterator[int]:
        """For every word, the length of the longest run that ends there and was added."""
        step, link, length = self.step, self.link, self.length
        state = size = 0
        for word in words:
            after = step[state].get(word)
            while after is None and state:
                state = link[state]
                size = length[state]
                after = step[state].get(word)
            if after is not None:
                state, size = after, size + 1
            yield size


def match_shard(docs: list, stretches_: list, window: int = WINDOW) -> list[list[bool]]:
    """For each stretch (its words as bytes), which of its windows stand in a stretch of a smaller doc; None is largest."""
    order = sorted(range(len(docs)), key=lambda i: (docs[i] is None, docs[i] or 0))
    known, shard, out = set(), Automaton(), [[]] * len(docs)
    at = 0
    while at < len(order):
        until = at
        own = {}  # equal stretches of one document are streamed once
        while until < len(order) and docs[order[until]] == docs[order[at]]:
            i = order[until]
            until += 1
            text = stretches_[i]
            if text not in own:
                words = text.split()
                own[text] = ([True] * (len(words) - window + 1) if text in known
                             else [size >= window for size in shard.statistics(words)][window - 1:])
            out[i] = own[text]
        for text, matched in own.items():
            if not all(matched):
                shard.add(text.split())
            known.add(text)
        at = until
    return out


def runs(flags: list[bool]) -> Iterator[tuple[int, int]]:
    """First and last place of the runs of true flags."""
    edge = np.diff(np.r_[0, np.array(flags, np.int8), 0])
    return zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) - 1).tolist())


def settle(rows: DataFrame, n_rows: int, kind: str, again: bool, name: str) -> DataFrame:
    """Matched windows of the stretches (words null); with ``again`` also the open windows of hot anchors, one by one."""
    shards = max(1, -(-n_rows // SHARD))

    def answer(group: pa.Table) -> pa.Table:
        node, doc, lo, key, hot, words = (group.column(c).to_pylist() for c in ("node", "doc_id", "lo", "key", "hot", "words"))
        out = []
        for i, matched in enumerate(match_shard(doc, words)):
            out += [(node[i], doc[i], lo[i] + a, lo[i] + b, 0, False, None) for a, b in runs(matched)]
            if again and hot[i] and not all(matched):
                own = words[i].split()
                for a, found in enumerate(matched):
                    if not found:
                        whole = b" ".join(own[a:a + WINDOW])
                        out.append((node[i], doc[i], lo[i] + a, lo[i] + a, xxhash.xxh3_64_intdigest(whole) - (1 << 63), True, whole))
        schema = pa.schema([("node", pa.int64()), ("doc_id", group.schema.field("doc_id").type), ("lo", pa.int32()), ("hi", pa.int32()),
                            ("key", pa.int64()), ("hot", pa.bool_()), ("words", pa.binary())])
        return pa.table([pa.array([r[c] for r in out], f.type) for c, f in enumerate(schema)], schema=schema)

    dealt = rows.withColumn("shard", F.pmod("key", F.lit(shards)))
    return materialize(dealt.groupBy("shard").applyInArrow(answer, ROWS.format(kind=kind)), name)


# --- the operator ---------------------------------------------------------------

def _bounded(df: DataFrame, entries: str) -> DataFrame:
    size = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.size(entries)), F.lit(0)).alias("m")).first()
    return F.broadcast(df) if size["n"] <= PLACE_ROWS and size["m"] <= PLACE_ENTRIES else df


def _packed(docs: DataFrame, kind: str) -> DataFrame:
    """node, doc_id, h1, h2 and the compressed text of one row of every text of ``WINDOW`` words or more; a written table."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(3)
        for batch in batches:
            blobs = pa.array([packer.compress(t.as_py().encode()) for t in batch.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("doc_id", "h1", "h2")] + [blobs], names=["doc_id", "h1", "h2", "blob"])

    long = docs.where(F.octet_length("text") >= 2 * WINDOW - 1)
    packed = long.select("doc_id", "h1", "h2", "text").mapInArrow(trimmed(pack), f"doc_id {kind}, h1 long, h2 long, blob binary")
    return materialize(packed.withColumn("node", F.monotonically_increasing_id()), "automata-texts")


def repeated_windows(docs: DataFrame) -> DataFrame:
    """h1, h2, first (the smallest doc_id) and spans (first and last repeated windows) of every text with several rows
    or repeated windows. ``docs`` has columns doc_id, text, h1 and h2."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    copies = (docs.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
              .where("n > 1").withColumn("none", F.array().cast("array<int>")))
    copies = materialize(copies, "automata-copies")
    known = _bounded(copies, "none").select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), F.col("first").alias("_first"),
                                            F.lit(True).alias("_many"))
    heads = docs.join(known, (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")), "left").where(
        F.col("_many").isNull() | F.col("doc_id").eqNullSafe(F.col("_first")))
    texts = _packed(heads, kind)
    found = anchors(texts)
    # an anchor in a third of all texts leaves each task as one row
    shared = (found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("a"), F.max("node").alias("b"))
              .where("a <> b").select("anchor", F.ceil(F.col("n") / HOT).cast("int").alias("salts")))
    shared = materialize(shared, "automata-shared")  # a join of two exchanges, whose hot partitions Spark can split
    places = (anchors(texts).join(shared, "anchor").groupBy("node")
              .agg(F.collect_list(F.struct("pos", "salts")).alias("places")))
    places = materialize(places, "automata-places")
    n = places.agg(F.sum(F.size("places"))).first()[0] or 0
    work = texts.join(_bounded(places, "places"), "node").select("node", "doc_id", "blob", "places")
    first = settle(stretches(work, kind), n, kind, True, "automata-first")
    hot = first.where("words is not null")
    matched = first.where("words is null")
    if n_hot := hot.count():
        matched = matched.unionByName(settle(hot, n_hot, kind, False, "automata-second"))
    spans = matched.groupBy("node").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    by_text = texts.select("node", "h1", "h2").join(spans, "node").groupBy("h1", "h2").agg(F.first("spans").alias("spans"))
    out = copies.select("h1", "h2", "first", F.lit(True).alias("many")).join(by_text, ["h1", "h2"], "full")
    return materialize(out, "automata-spans")


def kept_words(text: str | None, later_copy: bool, spans: list | None) -> tuple[int, int, bytes]:
    """(words, words removed, kept words joined by a space)."""
    words = (text or "").encode().split()
    n = len(words)
    if later_copy and n >= WINDOW:
        return n, n, b""
    if not spans:
        return n, 0, b" ".join(words)
    edge = np.zeros(n + 1, np.int64)
    for s in spans:
        edge[s["lo"]] += 1
        edge[s["hi"] + WINDOW] -= 1
    gone = np.cumsum(edge[:-1]) > 0
    return n, int(gone.sum()), b" ".join([w for w, g in zip(words, gone.tolist()) if not g])


def dedup_runs(docs: DataFrame) -> DataFrame:
    """doc_id, kept (the remaining words, joined by a space), n_words, n_removed and kept_sha256 of every row of ``docs``."""
    bounded_batches(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(WINDOW), "text").alias("h2"))
    info = _bounded(repeated_windows(keyed), "spans").select(
        F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), "first", "many", "spans")
    later = F.col("many") & F.col("first").isNotNull() & (F.col("doc_id").isNull() | (F.col("doc_id") > F.col("first")))
    joined = keyed.join(info, (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")), "left").select(
        "doc_id", "text", F.coalesce(later, F.lit(False)).alias("later"), "spans")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                out = [kept_words(t.as_py(), c.as_py(), s.as_py()) for t, c, s in zip(*(part.column(x) for x in ("text", "later", "spans")))]
                n, gone, kept = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([k.decode() for k in kept], pa.string()), pa.array(n, pa.int64()),
                     pa.array(gone, pa.int64()), pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())],
                    names=["doc_id", "kept", "n_words", "n_removed", "kept_sha256"])

    return joined.mapInArrow(trimmed(rows), f"doc_id {kind}, kept string, n_words long, n_removed long, kept_sha256 string")


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
w AS (SELECT r, doc_id, i, md5(array_to_string(ws[i:i + {WINDOW - 1}], ' ')) AS h
      FROM (SELECT r, doc_id, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM d)),
f AS (SELECT h, min(doc_id) AS first FROM w GROUP BY h),
x AS (SELECT r, i FROM w JOIN f USING (h) WHERE first < coalesce(doc_id, 9223372036854775807)),
e AS (SELECT r, i AS j, 1 AS up FROM x UNION ALL SELECT r, i + {WINDOW}, -1 FROM x),
c AS (SELECT r, j, sum(up) AS up FROM (SELECT r, j, up FROM e UNION ALL SELECT r, unnest(range(1, len(ws) + 1)), 0 FROM d) GROUP BY r, j),
k AS (SELECT r, j, sum(up) OVER (PARTITION BY r ORDER BY j) AS depth FROM c),
g AS (SELECT d.r, string_agg(d.ws[j], ' ' ORDER BY j) FILTER (depth = 0) AS kept, count(*) FILTER (depth > 0) AS n_removed
      FROM k JOIN d USING (r) WHERE j <= len(d.ws) GROUP BY d.r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256,
       coalesce(n_removed, 0) > 0 AS has_repeat
FROM d LEFT JOIN g USING (r)
"""
