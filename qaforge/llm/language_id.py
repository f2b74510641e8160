"""Language ID by prediction by partial matching.

One byte model per language: a context tree of the contexts of up to
``order`` bytes seen in training, with frozen counts. A byte is coded in its
longest known context; a byte not seen there costs an escape (method C:
``d / (n + d)`` with ``d`` distinct bytes and ``n`` occurrences left) and is
coded in the next shorter context, in which the bytes already seen above are
excluded; below order 0 the remaining byte values are equally likely. A
text's score under a language is its exact code length in bits; the language
with the shortest code wins.

Since the counts are frozen, all code lengths are computed once: the
contexts of all languages form one automaton (its state is the longest known
context of the bytes read so far) and a table holds the cost of every (state,
byte, language). Scoring is ``order`` table steps per byte, done with numpy
over whole Arrow batches; texts are read whole.

Training reads a bounded sample: at most ``SAMPLE_ROWS`` different texts per
language, each of at most ``SAMPLE_BYTES`` bytes (of a longer one its first
``SAMPLE_BYTES // 4`` characters), and the model keeps the ``CONTEXTS`` most
frequent contexts of all languages together and the ``OWN_CONTEXTS`` most
frequent of each language, so the broadcast table has at most ``(CONTEXTS +
OWN_CONTEXTS * languages) * 257 * languages`` floats. Every text is scored.

Defined cases: a null text or one without letters is ``und`` with score 0;
null ids are kept (held_out false, never trained on); repeated rows give
repeated results; ties go to the smaller language name; without training
rows every text is ``und``; other columns are not read. ``score`` is the
winner's share of the languages' probabilities, at the code length per byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, spans, trim, trimmed, utf8

ORDER = 3
SAMPLE_ROWS = 400
SAMPLE_BYTES = 20_000
CONTEXTS = 12_000
OWN_CONTEXTS = 3_000
#: Bytes scored at a time.
SLICE = 1 << 18
#: Bits a byte above which no learned language explains a text (plain bytes need 8).
REJECT_BITS = 6.0
#: Bits allowed beside that for the start of a text, which has no context yet (one plain byte).
START_BITS = 8.0


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0, F.lit(False))


def training_sample(docs: DataFrame, rows: int = SAMPLE_ROWS, most: int = SAMPLE_BYTES) -> DataFrame:
    """About ``2 * rows`` different texts per language at most, chosen by a hash of the text.

    Different texts are counted by language first; a hash threshold then passes
    twice the number wanted, so neither a hot language nor a hot text reaches one
    task, and copies do not thin out the sample. Of a text of over ``most`` bytes
    the first ``most // 4`` characters (``most`` bytes at most) are taken.
    """
    piece = F.when(F.octet_length("text") > most, F.substring("text", 1, most // 4)).otherwise(F.col("text"))
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()
                          & (F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) != 0)
                          ).select("lang", piece.alias("text"), F.xxhash64("text").alias("_h"))
    sizes = labelled.groupBy("lang", "_h").agg(F.lit(1)).groupBy("lang").agg(F.count("*").alias("_n"))
    few = F.pmod("_h", F.lit(1_000_003)) < F.lit(2.0 * rows * 1_000_003) / F.col("_n")
    return (labelled.join(F.broadcast(sizes), "lang").where(few)
            .groupBy("lang", "_h").agg(F.first("text").alias("text")))


class Model:
    """Automaton over the union of the languages' contexts, with exact costs."""

    def __init__(self, langs: list[str], order: int, symbol: np.ndarray, step: np.ndarray, cost: np.ndarray):
        self.langs, self.order, self.symbol, self.step, self.cost = langs, order, symbol, step, cost

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each row (rows x languages)."""
        out = np.zeros((len(offsets) - 1, len(self.langs)))
        for lo, hi in spans(offsets, SLICE):
            a, b = int(offsets[lo]), int(offsets[hi])
            for at in range(a, b, SLICE):  # a very long row in slices
                end = min(at + SLICE, b)
                out[lo:hi] += self._slice(data, offsets[lo:hi + 1], a, at, end)
        return out

    def _slice(self, data, offsets, a, at, end):
        width = self.step.shape[1]
        back = min(self.order, at - a)
        sym = self.symbol[data[at - back:end]].astype(np.int32)
        n = len(sym)
        begins = offsets[:-1] - (at - back)
        reach = np.arange(n, dtype=np.int64)
        starts = np.zeros(n, np.int64)
        inside = begins[(begins >= 0) & (begins < n)]
        starts[inside] = inside
        reach -= np.maximum.accumulate(starts)  # bytes of the same row before each one
        state = np.zeros(n, np.int32)
        flat = self.step.reshape(-1)
        for j in range(self.order, 0, -1):  # feed the byte j places back
            fed = np.zeros(n, np.int32)
            if n > j:
                fed[j:] = flat[state[j:] * width + sym[:-j]]
            state = np.where(reach >= j, fed, 0)
        state, sym, n = state[back:], sym[back:], n - back
        cost = self.cost[state * width + sym]
        ends = np.clip(offsets - at, 0, n)
        sums = np.zeros((n + 1, cost.shape[1]))
        np.cumsum(cost, axis=0, out=sums[1:])
        return sums[ends[1:]] - sums[ends[:-1]]


def train(texts: dict[str, list[bytes]], order: int = ORDER, contexts: int = CONTEXTS,
          own_contexts: int = OWN_CONTEXTS) -> Model:
    """Fit the context trees on the texts of each language."""
    langs = sorted(texts)
    seen = sorted({b for docs in texts.values() for d in docs for b in d})
    symbol = np.full(256, len(seen), np.int64)
    symbol[seen] = np.arange(len(seen))
    width = len(seen) + 1
    counts: dict[int, dict[tuple[int, ...], np.ndarray]] = {}
    # occurrences of every context and its next symbols, by language
    for li, lang in enumerate(langs):
        for k in range(order + 1):
            grams: list[np.ndarray] = []
            for d in texts[lang]:
                s = symbol[np.frombuffer(d, np.uint8)]
                if len(s) > k:
                    code = np.zeros(len(s) - k, np.int64)
                    for j in range(k + 1):
                        code = code * width + s[j:len(s) - k + j]
                    grams.append(code)
            code, n = np.unique(np.concatenate(grams) if grams else np.zeros(0, np.int64), return_counts=True)
            ctx, nxt = np.divmod(code, width)
            rows = counts.setdefault(k, {})
            for c, x, m in zip(ctx.tolist(), nxt.tolist(), n.tolist()):
                row = rows.get(c)
                if row is None:
                    row = rows[c] = np.zeros((len(langs), width), np.int32)
                row[li, x] += m
    # keep the most frequent contexts, of all and of each language; a prefix or suffix of a kept one is kept before it
    sums = [(row.sum(1), k, c) for k, rows in counts.items() if k for c, row in rows.items()]
    most = {x[1:] for x in sorted((-n.sum(), k, c) for n, k, c in sums)[:contexts]}
    for li in range(len(langs)):
        most.update(x[1:] for x in sorted((-n[li], k, c) for n, k, c in sums if n[li])[:own_contexts])
    kept: dict[tuple[int, int], int] = {(0, 0): 0}
    for k, c in sorted(most):
        if (k - 1, c // width) in kept and (k - 1, c % width ** (k - 1)) in kept:
            kept[k, c] = len(kept)
    step = np.zeros((len(kept), width), np.int32)
    cost = np.zeros((len(kept), width, len(langs)), np.float32)
    unseen = 256 - len(seen)
    empty = np.zeros((len(langs), width), np.int32)
    for (k, c), me in kept.items():
        for x in range(width):
            for m in range(min(k + 1, order), 0, -1):  # longest known suffix of context + byte
                to = kept.get((m, (c % width ** (m - 1)) * width + x)) if x < len(seen) else None
                if to is not None:
                    step[me, x] = to
                    break
        bits = np.zeros((len(langs), width))
        open_ = np.ones((len(langs), width), bool)
        escape = np.zeros(len(langs))
        for m in range(k, -1, -1):
            row = counts.get(m, {}).get(c % width ** m, empty) * open_
            n, d = row.sum(1), (row > 0).sum(1)
            # the escape is only taken if some byte is left below
            left = (open_ & ~(row > 0))[:, :len(seen)].any(1) | (unseen > 0)
            total = np.where(left, n + d, n)
            hit = row > 0
            with np.errstate(divide="ignore", invalid="ignore"):
                bits = np.where(hit, escape[:, None] + np.log2(total[:, None] / row), bits)
                escape = np.where(n > 0, escape + np.where(left, np.log2(total / d), 0), escape)
            open_ &= ~hit
        rest = open_[:, :len(seen)].sum(1) + unseen
        flat = escape + np.log2(np.maximum(rest, 1))
        bits = np.where(open_, flat[:, None], bits)
        cost[me] = bits.T
    return Model(langs, order, symbol, step, cost.reshape(len(kept) * width, len(langs)))


def fit(docs: DataFrame, **bounds) -> Model:
    """Train on the ``rows`` texts of each language with the smallest hashes (a bounded collect)."""
    texts: dict[str, list[tuple[int, bytes]]] = {}
    for r in training_sample(docs, **bounds).collect():
        texts.setdefault(r["lang"], []).append((r["_h"], r["text"].encode()))
    rows = bounds.get("rows", SAMPLE_ROWS)
    model = train({k: [t for _, t in sorted(v, key=lambda x: (x[0] % 1_000_003, x))[:rows]] for k, v in texts.items()})
    trim()  # the counts were the largest thing in the driver
    return model


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` that are named doc_id, plus held_out, lang_pred, score and bits_per_byte."""
    bounded_batches(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select("doc_id", "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"),
                         held_out(F.col("doc_id")).alias("held_out"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.langs, "und"], object)
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            letters = batch.column("letters").to_numpy(zero_copy_only=False).astype(bool)
            length = np.maximum(np.diff(offsets), 1)
            if model.langs:
                bits = model.code_lengths(data, offsets) / length[:, None]
                best = bits.argmin(1)
                least = bits.min(1)
                share = 1 / np.exp2(least[:, None] - bits).sum(1)
                known = letters
            else:
                best, least, share = np.zeros(len(length), int), np.zeros(len(length)), np.zeros(len(length))
                known = np.zeros(len(length), bool)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("held_out"),
                pa.array(names[np.where(known, best, len(names) - 1)], pa.string()),
                pa.array(np.where(known, share, 0.0)),
                pa.array(np.where(known, least, 0.0))], names=["doc_id", "held_out", "lang_pred", "score", "bits_per_byte"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(trimmed(score), f"doc_id {kind}, held_out boolean, lang_pred string, score double, bits_per_byte double")


def keep_known(docs: DataFrame, model: Model, most_bits: float = REJECT_BITS) -> DataFrame:
    """``docs`` without the rows in no learned language: no letters, or a code of over ``most_bits`` a byte and ``START_BITS``."""
    bounded_batches(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = docs.columns
    at = columns.index("text")
    source = docs.select(F.struct(*[docs[c] for c in columns]).alias("row"),
                         F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column("row").flatten()
            data, offsets = utf8(row[at])
            bits = shared.value.code_lengths(data, offsets)
            good = batch.column("letters").to_numpy(zero_copy_only=False).astype(bool)
            good &= bits.min(1) <= most_bits * np.diff(offsets) + START_BITS if bits.shape[1] else False
            yield pa.RecordBatch.from_arrays(row, names=columns).filter(pa.array(good))

    return source.mapInArrow(trimmed(keep), docs.schema)
