"""Sparse index tables: postings, vocabulary, passage lengths, corpus stats.

The index is three DataFrames plus two one-row statistics (N, average
length) that are read to the driver as literals -- the only driver values
the scoring plans use.

Stored postings lie in folders by a hash of the term (``part``) and, in each
folder, in files by a hash of the passage (buckets). A batch of questions
opens only the folders of its terms, and a question's terms for one passage
meet in one task: score sums need no shuffle, however many pairs there are,
and a term in a third of all passages is spread over all buckets.
"""

from __future__ import annotations

import uuid
import zlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import Tokenizer, get_tokenizer, uni_and_bigrams, whitespace_tokens
from ..session import materialize as _write
from ..session import shared_path, write_bucketed
from .common import BROADCAST_MAX_ROWS

# Postings that a bucket, and a file of a bucket, should hold.
BUCKET_POSTINGS = 4_000_000
FILE_POSTINGS = 500_000
LEAST_PARTS = 8
# Tokens, and bytes of text, that a task counts at once (more only in a longer passage); rows that it counts or sends at once.
TOKENS_AT_ONCE = 1 << 20
BYTES_AT_ONCE = 1 << 22
ROWS_AT_ONCE = 1 << 16
# Fixed value: the weight b of the passage length, the same in all BM25 variants.
LENGTH_WEIGHT = 0.75


@dataclass
class SparseIndex:
    postings: DataFrame   # term, passage_id, tf int, dl int
    vocab: DataFrame      # term, df long
    lengths: DataFrame    # passage_id, dl int (every passage, empty ones too)
    n_docs: int
    avgdl: float
    tokenizer: Tokenizer = field(repr=False)
    extras: dict = field(default_factory=dict, repr=False)


def _out(df: DataFrame, name: str, out_dir: str | None) -> DataFrame:
    return _write(df, name, f"{out_dir}/{name}" if out_dir else None)


def layout(spark, n_postings: int) -> tuple[int, int]:
    """(buckets, parts) of a postings table: both grow with it, so tasks and files keep their size."""
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_postings // BUCKET_POSTINGS))
    return buckets, max(LEAST_PARTS, -(-n_postings // (buckets * FILE_POSTINGS)))


def part_of(term: F.Column, parts: int) -> F.Column:
    """The folder of a term's postings."""
    return F.pmod(F.xxhash64(term), F.lit(parts)).cast("int")


def store_postings(postings: DataFrame, buckets: int, parts: int, out_dir: str | None) -> DataFrame:
    """Postings that are partitioned by passage, written in folders by term and buckets by passage."""
    path = f"{out_dir}/postings" if out_dir else shared_path(postings.sparkSession, f"postings-{uuid.uuid4().hex[:12]}")
    if "part" not in postings.columns:
        postings = postings.withColumn("part", part_of(F.col("term"), parts))
    return write_bucketed(postings, path, "passage_id", buckets, "term", "part")


@dataclass(frozen=True)
class Terms:
    """What a task gets of a passage and how it makes terms of it: ``source`` is an array of terms, or with ``split`` a
    text that is split on ASCII whitespace; with ``pairs`` neighbouring tokens, joined by a space, are terms too."""
    source: F.Column
    split: bool = False
    pairs: bool = False


def terms_of(tokenizer: Tokenizer, ngrams: bool = False) -> Terms:
    """The terms of the column text. The default tokenizer's are cut out of the lower-cased text's bytes in the task."""
    if tokenizer is whitespace_tokens:
        return Terms(F.lower(F.col("text")), True, ngrams)
    tokens = tokenizer(F.col("text"))
    return Terms(uni_and_bigrams(tokens) if ngrams else tokens)


IS_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def _bytes_of(column) -> tuple[np.ndarray, np.ndarray]:
    """Where the rows of a text column begin and end, and their bytes."""
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, places, data = column.buffers()
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    places = np.frombuffer(places, wide)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[places[0]:places[-1]] if data is not None else np.zeros(0, np.uint8)
    return places - places[0], data


def _token_starts(places: np.ndarray, data: np.ndarray, space: np.ndarray) -> np.ndarray:
    """Places of the first bytes of tokens; a token ends with its row."""
    start = ~space
    start[1:] &= space[:-1]
    first = places[:-1][places[:-1] < places[1:]]
    start[first] = ~space[first]
    return np.flatnonzero(start)


def _cut(weights: np.ndarray, most: int) -> list[tuple[int, int]]:
    """(first row, rows) of runs of rows that weigh about ``most`` and have ROWS_AT_ONCE rows at most; a heavier row is alone."""
    done = (np.cumsum(weights) - weights) // most
    new = np.flatnonzero((np.diff(done, prepend=-1) != 0) | (np.arange(len(done)) % ROWS_AT_ONCE == 0))
    return list(zip(new.tolist(), np.diff(new, append=len(done)).tolist()))


def token_runs(column, split: bool):
    """(first row, rows, tokens of each row, the tokens' codes, dictionary) of runs of a bounded size.

    Tokens become numbers by a dictionary of their run, so that no Python object or row is made for a token."""
    if split:
        places, data = _bytes_of(column)
        for first, n in _cut(np.diff(places), BYTES_AT_ONCE):
            own = places[first:first + n + 1]
            text, own = data[own[0]:own[-1]], own - own[0]
            space = IS_SPACE[text]
            starts = _token_starts(own, text, space)
            sizes = np.diff(np.searchsorted(starts, own))
            if len(starts):
                before = np.cumsum(~space, dtype=np.int64 if len(text) > 1 << 30 else np.int32)
                ends = np.append(before[starts] - 1, before[-1]).astype(np.int64)
                tokens = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(text[~space]))
                coded = tokens.dictionary_encode()
                yield first, n, sizes, coded.indices.to_numpy().astype(np.int64), coded.dictionary.cast(pa.string())
        return
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy().astype(np.int64)
    for first, n in _cut(sizes, TOKENS_AT_ONCE):
        coded = column.slice(first, n).flatten().dictionary_encode(null_encoding="encode")
        if len(coded):
            yield first, n, sizes[first:first + n], coded.indices.to_numpy().astype(np.int64), coded.dictionary


def run_terms(sizes: np.ndarray, codes: np.ndarray, distinct: int, pairs: bool) -> tuple[np.ndarray, np.ndarray]:
    """(code, row) of all terms of a run; the pair of tokens a, b has the code distinct * (1 + a) + b."""
    rows = np.repeat(np.arange(len(sizes)), sizes)
    if not pairs:
        return codes, rows
    near = np.flatnonzero(rows[1:] == rows[:-1])
    return np.concatenate([codes, distinct * (1 + codes[near]) + codes[near + 1]]), np.concatenate([rows, rows[near]])


def named(codes: np.ndarray, dictionary) -> pa.Array:
    """The terms of rising codes."""
    u = len(dictionary)
    one = int(np.searchsorted(codes, u))
    first, second = np.divmod(codes[one:] - u, max(u, 1))
    pairs = pc.binary_join_element_wise(dictionary.take(pa.array(first)), dictionary.take(pa.array(second)), " ")
    return pa.concat_arrays([dictionary.take(pa.array(codes[:one])), pairs]) if len(pairs) else dictionary.take(pa.array(codes[:one]))


def _counters(codes: np.ndarray, dictionary, counters: int) -> np.ndarray:
    """The counter of each term of ``run_terms``: by a hash of its tokens, the same in every run."""
    u = len(dictionary)
    own = pd.util.hash_array(np.array(dictionary.to_pylist(), dtype=object), categorize=False)
    left, right = own * np.uint64(0x9E3779B97F4A7C15), own * np.uint64(0xC2B2AE3D27D4EB4F)
    two = codes >= u
    out = own[np.where(two, 0, codes)]
    first, second = np.divmod(codes[two] - u, u)
    out[two] = (left[first] ^ (left[first] >> np.uint64(29))) + right[second]
    out = (out ^ (out >> np.uint64(32))) * np.uint64(0xFF51AFD7ED558CCD)
    return ((out >> np.uint64(24)) % np.uint64(counters)).astype(np.int64)


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


P1, P2, P3, P4, P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def xxhash64(texts) -> np.ndarray:
    """Spark's ``xxhash64`` of a text column without nulls, all texts at a time."""
    places, data = _bytes_of(texts)
    at, end = places[:-1].copy(), places[1:]
    data = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))

    def mixed(v, w):
        return _turned(v + w * P2, 31) * P1

    with np.errstate(over="ignore"):
        seed = np.uint64(42)
        h = np.full(len(at), seed + P5)
        wide = np.flatnonzero(end - at >= 32)
        if len(wide):
            lanes = [np.full(len(at), x) for x in (seed + P1 + P2, seed + P2, seed, seed - P1)]
            live = wide
            while len(live):
                for i, v in enumerate(lanes):
                    v[live] = mixed(v[live], words[at[live] + 8 * i])
                at[live] += 32
                live = live[end[live] - at[live] >= 32]
            h[wide] = sum(_turned(v[wide], bits) for v, bits in zip(lanes, (1, 7, 12, 18)))
            for v in lanes:
                h[wide] = (h[wide] ^ mixed(np.uint64(0), v[wide])) * P1 + P4
        h += np.diff(places).astype(np.uint64)
        live = np.flatnonzero(end - at >= 8)
        while len(live):
            h[live] = _turned(h[live] ^ mixed(np.uint64(0), words[at[live]]), 27) * P1 + P4
            at[live] += 8
            live = live[end[live] - at[live] >= 8]
        live = np.flatnonzero(end - at >= 4)
        h[live] = _turned(h[live] ^ ((words[at[live]] & np.uint64(0xFFFFFFFF)) * P1), 23) * P2 + P3
        at[live] += 4
        live = np.flatnonzero(at < end)
        while len(live):
            h[live] = _turned(h[live] ^ (data[at[live]].astype(np.uint64) * P5), 11) * P1
            at[live] += 1
            live = live[at[live] < end[live]]
        h = (h ^ (h >> np.uint64(33))) * P2
        h = (h ^ (h >> np.uint64(29))) * P3
        return (h ^ (h >> np.uint64(32))).view(np.int64)


def _likely(codes, rows, dictionary, may):
    """The terms whose counters ``may`` (a table of yes and no) names."""
    if may is None:
        return codes, rows
    keep = may[_counters(codes, dictionary, len(may))]
    return codes[keep], rows[keep]


def _sent(columns: list, names: list[str]):
    """Record batches of a bounded number of rows."""
    whole = pa.RecordBatch.from_arrays(columns, names)
    for lo in range(0, len(whole), ROWS_AT_ONCE):
        yield whole.slice(lo, ROWS_AT_ONCE)


def count_tokens(batches, split: bool = False, pairs: bool = False, may: np.ndarray | None = None, parts: int = 0):
    """``term, passage_id, dl, tf`` of rows ``passage_id, toks``: the distinct terms of each row with their numbers;
    dl is the number of all its terms.

    (term, row) pairs are sorted as integers, about ``TOKENS_AT_ONCE`` at a time; no row per token is made before
    the repeats are merged. Without pairs, the rows of one such run are in term order, with ``parts`` in the order of
    the stored postings (part, term), part being one more column."""
    for batch in batches:
        for first, n, sizes, codes, dictionary in token_runs(batch.column("toks"), split):
            if not pairs:
                order = pc.array_sort_indices(dictionary).to_numpy()
                if parts:
                    part = np.mod(xxhash64(dictionary), parts).astype(np.int32)
                    order = order[np.argsort(part[order], kind="stable")]
                place = np.empty(len(order), np.int64)
                place[order] = np.arange(len(order))
                codes, dictionary = place[codes], dictionary.take(pa.array(order))
            total = np.maximum(2 * sizes - 1, 0) if pairs else sizes
            codes, rows = _likely(*run_terms(sizes, codes, len(dictionary), pairs), dictionary, may)
            held, tf = np.unique(codes * n + rows, return_counts=True)
            term, row = np.divmod(held, n)
            columns = [named(term, dictionary), batch.column("passage_id").take(pa.array(row + first)),
                       pa.array(total[row].astype(np.int32)), pa.array(tf.astype(np.int32))]
            if parts:
                yield from _sent([*columns, pa.array(part[order][term])], ["term", "passage_id", "dl", "tf", "part"])
            else:
                yield pa.RecordBatch.from_arrays(columns, ["term", "passage_id", "dl", "tf"])


def count_lengths(batches, split: bool = True):
    """``passage_id, dl`` of rows ``passage_id, toks``; null where toks is null."""
    for batch in batches:
        column = batch.column("toks")
        places, data = _bytes_of(column)
        dl = np.zeros(len(column), np.int32)
        for first, n in _cut(np.diff(places), BYTES_AT_ONCE):
            own = places[first:first + n + 1]
            text, own = data[own[0]:own[-1]], own - own[0]
            dl[first:first + n] = np.diff(np.searchsorted(_token_starts(own, text, IS_SPACE[text]), own)) if len(text) else 0
        yield pa.RecordBatch.from_arrays([batch.column("passage_id"), pa.array(dl, mask=pc.is_null(column).to_numpy(zero_copy_only=False))],
                                         ["passage_id", "dl"])


def ids_repeat(passages: DataFrame) -> bool:
    """Whether several passages have one id; their terms are counted together."""
    return passages.groupBy("passage_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count() > 0


def term_postings(passages: DataFrame, tokens: F.Column | Terms, repeats: bool | None = None, may: np.ndarray | None = None,
                  parts: int = 0) -> DataFrame:
    """Postings ``term, passage_id, dl, tf`` of the terms of ``passages`` (a token-array expression, or ``Terms``).

    The tokens of a passage are counted within its row, so nothing is
    shuffled. Only where ids repeat (``repeats``; looked up if not given) rows
    of one term, id and length are merged by a shuffle. With ``may``, terms of other counters are left out. With ``parts``
    rows of the default tokenizer, whose ids do not repeat, come in the order in which they are stored, with their folder.
    """
    terms = tokens if isinstance(tokens, Terms) else Terms(tokens)
    repeats = ids_repeat(passages) if repeats is None else repeats
    kind, split, pairs = passages.schema["passage_id"].dataType.simpleString(), terms.split, terms.pairs
    parts = parts if split and not pairs and not repeats else 0
    counts = passages.select("passage_id", terms.source.alias("toks")).mapInArrow(
        lambda batches: count_tokens(batches, split, pairs, may, parts),
        f"term string, passage_id {kind}, dl int, tf int" + ", part int" * bool(parts))
    return counts.groupBy("term", "passage_id", "dl").agg(F.sum("tf").cast("int").alias("tf")) if repeats else counts


def passage_lengths(passages: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """``passage_id, dl``: the number of tokens."""
    if tokenizer is not whitespace_tokens:
        return passages.select("passage_id", F.size(tokenizer(F.col("text"))).alias("dl"))
    kind = passages.schema["passage_id"].dataType.simpleString()
    return passages.select("passage_id", F.col("text").alias("toks")).mapInArrow(count_lengths, f"passage_id {kind}, dl int")


def build_index(passages: DataFrame, tokenizer: str | Tokenizer = "whitespace",
                materialize: bool = True, out_dir: str | None = None, parts: int | None = None) -> SparseIndex:
    """Postings / vocabulary / stats for the BM25 family (A2). ``parts``: folders of the postings, if not by size.

    With ``materialize`` the tables are written once to the shared folder,
    so the statistics jobs and every later query read them instead of
    re-tokenizing the corpus.
    """
    tok = get_tokenizer(tokenizer)

    lengths = passage_lengths(passages, tok)
    if materialize:
        lengths = _out(lengths, "tokens", out_dir)
    stats = lengths.agg(F.count(F.lit(1)).alias("n"),
                        F.sum("dl").alias("total")).first()
    n, total = int(stats["n"]), int(stats["total"] or 0)
    avgdl = total / n if n else 0.0
    repeats = ids_repeat(lengths)
    extras = {}
    if materialize:
        buckets, by_size = layout(passages.sparkSession, total)
        parts = parts or by_size
        # one shuffle, of texts by passage; counting needs no other one
        dealt = passages.select("passage_id", "text").repartition(buckets, "passage_id")
        postings = store_postings(term_postings(dealt, terms_of(tok), repeats, parts=parts), buckets, parts, out_dir)
        extras = {"buckets": buckets, "parts": parts}
    else:
        postings = term_postings(passages, terms_of(tok), repeats)
    vocab = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.max(density(avgdl)).alias("peak"))
    if materialize:
        vocab = _out(vocab, "vocab", out_dir)
    return SparseIndex(postings=postings, vocab=vocab, lengths=lengths,
                       n_docs=n, avgdl=avgdl, tokenizer=tok, extras=extras)


def density(avgdl: float) -> F.Column:
    """tf over the passage's relative length; what a term adds to a BM25 score grows with it, for any k1."""
    return F.col("tf") / (1 - LENGTH_WEIGHT + LENGTH_WEIGHT * F.col("dl") / F.lit(avgdl or 1.0))


def top_terms(totals: DataFrame, max_features: int) -> DataFrame:
    """The ``max_features`` terms with the highest corpus count, ties by term
    (A3), without funnelling every partition's top rows into one task.

    1. per-term totals ``term, cf, df`` (given, a stored table);
    2. a histogram ``cf -> number of terms`` (one row per distinct count),
       of which only the largest ``max_features`` counts can matter: read
       to the driver (bounded by ``max_features`` rows) to find the cut-off
       count c* and how many terms lie strictly above it;
    3. every term with ``cf > c*`` plus the first remaining ones with
       ``cf = c*`` in term order (a limit over the tie set only).
    """
    hist = (totals.groupBy("cf").agg(F.count(F.lit(1)).alias("n_terms"))
            .orderBy(F.desc("cf")).limit(max_features).collect())
    seen, cut, above = 0, None, 0
    for row in hist:
        if seen + row["n_terms"] >= max_features:
            cut, above = row["cf"], seen
            break
        seen += row["n_terms"]
    if cut is None:                      # fewer terms than the cap: keep all
        return totals
    head = totals.where(F.col("cf") > cut)
    ties = totals.where(F.col("cf") == cut).orderBy("term").limit(max_features - above)
    return head.unionByName(ties)


# Counters of ``hashed_counts``, and how many of them a row of its result holds.
COUNTERS = 1 << 22
CHUNK = 1 << 12


def hashed_counts(passages: DataFrame, terms: Terms) -> DataFrame:
    """``counter, n``: how many terms fall to each counter by a hash; a term's count is at most its counter's.

    A task adds up its own counters and sends them as compressed runs, so
    what is shuffled grows with the number of tasks, not with the terms.
    """
    counters, split, pairs = COUNTERS, terms.split, terms.pairs

    def add(batches):
        total = np.zeros(counters, np.int64)
        for batch in batches:
            for _, _, sizes, codes, dictionary in token_runs(batch.column(0), split):
                total += np.bincount(_counters(run_terms(sizes, codes, len(dictionary), pairs)[0], dictionary, counters), minlength=counters)
        held = [c for c in range(0, counters, CHUNK) if total[c:c + CHUNK].any()]
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(
            [zlib.compress(total[c:c + CHUNK].tobytes(), 1) for c in held], pa.binary())], ["first", "counts"])

    def merged(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(zlib.decompress(x), np.int64) for x in pdf["counts"])
        at = np.flatnonzero(total)
        return pd.DataFrame({"counter": (at + int(pdf["first"].iloc[0])).astype(np.int32), "n": total[at]})

    return (passages.select(terms.source.alias("toks")).mapInArrow(add, "first int, counts binary")
            .groupBy("first").applyInPandas(merged, "counter int, n long"))


def term_totals(passages: DataFrame, terms: Terms, may: np.ndarray | None) -> DataFrame:
    """``term, cf, df`` of the terms of the counters ``may``, no passage id standing twice; a run's repeats are merged in its task."""
    split, pairs = terms.split, terms.pairs

    def add(batches):
        for batch in batches:
            for _, n, sizes, codes, dictionary in token_runs(batch.column(0), split):
                codes, rows = _likely(*run_terms(sizes, codes, len(dictionary), pairs), dictionary, may)
                held, tf = np.unique(codes * n + rows, return_counts=True)
                held, at = np.unique(held // n, return_index=True)
                if len(held):
                    yield from _sent([named(held, dictionary), pa.array(np.add.reduceat(tf, at)), pa.array(np.diff(at, append=len(tf)))],
                                     ["term", "cf", "df"])

    return (passages.select(terms.source.alias("toks")).mapInArrow(add, "term string, cf long, df long")
            .groupBy("term").agg(F.sum("cf").alias("cf"), F.sum("df").alias("df")))


def most_frequent(passages: DataFrame, tokens: F.Column | Terms, max_features: int,
                  repeats: bool | None = None) -> tuple[DataFrame, DataFrame]:
    """(``term, cf, df`` of the ``max_features`` terms of ``top_terms``, postings that hold all of theirs).

    Most terms are too rare to be among them, and need not be counted one by
    one: a term of a counter below a bound occurs less often than the bound.
    Terms of the other counters are counted exactly; when the last of the
    best reaches the bound, no other term can be among them. Otherwise the
    bound is lowered, at last to 1, where every term is counted.
    """
    terms = tokens if isinstance(tokens, Terms) else Terms(tokens)
    repeats = ids_repeat(passages) if repeats is None else repeats
    counters = _write(hashed_counts(passages, terms), "hashed-counts")
    hist = counters.groupBy("n").agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("n")).limit(2 * max_features).collect()
    bound, seen = 1, 0
    for row in hist:
        seen += row["k"]
        if seen >= 2 * max_features:
            bound = row["n"]
            break
    while True:
        often = counters.where(F.col("n") >= bound).select("counter")
        may = None
        if bound > 1 and often.count() <= BROADCAST_MAX_ROWS:
            may = np.zeros(COUNTERS, bool)
            may[often.toArrow().column(0).to_numpy()] = True
        else:
            bound = 1
        counts = term_postings(passages, terms, repeats, may)
        totals = (counts.groupBy("term").agg(F.sum("tf").alias("cf"), F.count(F.lit(1)).alias("df")) if repeats
                  else term_totals(passages, terms, may))
        best = top_terms(_write(totals, "term-totals"), max_features)  # read three times
        row = best.agg(F.count(F.lit(1)).alias("n"), F.min("cf").alias("last")).first()
        if bound == 1 or (row["n"] == max_features and row["last"] >= bound):
            return best, counts
        bound = max(1, bound // 4)


def weigh_tokens(batches, split: bool, pairs: bool, terms: pa.Array, idf: np.ndarray, part: np.ndarray):
    """``term, passage_id, tf, dl, w, part`` of rows ``passage_id, toks``, for the given terms only: w is tf * idf over the
    root of the sum of its squares in the row. The rows of a run are in the order of ``terms``."""
    blank = [t.find(" ") if pairs else -1 for t in terms.to_pylist()]
    ones = np.array([i for i, b in enumerate(blank) if b < 0], np.int64)
    twos = np.array([i for i, b in enumerate(blank) if b >= 0], np.int64)
    single = terms.take(pa.array(ones))
    left = pa.array([terms[int(i)].as_py()[:blank[i]] for i in twos], pa.string())
    right = pa.array([terms[int(i)].as_py()[blank[i] + 1:] for i in twos], pa.string())

    def found(values, among) -> np.ndarray:
        return pc.fill_null(pc.index_in(values, value_set=among), -1).to_numpy().astype(np.int64)

    for batch in batches:
        for first, n, sizes, codes, dictionary in token_runs(batch.column("toks"), split):
            u, rows = len(dictionary), np.repeat(np.arange(n), sizes)
            number = found(dictionary, single)
            number = np.where(number >= 0, ones[number] if len(ones) else -1, -1)[codes]
            keys = [number[number >= 0] * n + rows[number >= 0]]
            if len(twos):
                a, b = found(left, dictionary), found(right, dictionary)
                held = np.flatnonzero((a >= 0) & (b >= 0))
                held = held[np.argsort(a[held] * u + b[held])]
                known, begins, ends = a[held] * u + b[held], np.zeros(u, bool), np.zeros(u, bool)
                begins[a[held]], ends[b[held]] = True, True
                near = np.flatnonzero((rows[1:] == rows[:-1]) & begins[codes[:-1]] & ends[codes[1:]])
                if len(known) and len(near):
                    pair = codes[near] * u + codes[near + 1]
                    at = np.minimum(np.searchsorted(known, pair), len(known) - 1)
                    same = known[at] == pair
                    keys.append(twos[held[at[same]]] * n + rows[near[same]])
            keys, tf = np.unique(np.concatenate(keys), return_counts=True)
            if not len(keys):
                continue
            term, row = np.divmod(keys, n)
            w = tf * idf[term]
            w /= np.sqrt(np.bincount(row, w * w, n))[row]
            total = np.maximum(2 * sizes - 1, 0) if pairs else sizes
            yield from _sent([terms.take(pa.array(term)), batch.column("passage_id").take(pa.array(row + first)), pa.array(tf.astype(np.int32)),
                              pa.array(total[row].astype(np.int32)), pa.array(w), pa.array(part[term])], ["term", "passage_id", "tf", "dl", "w", "part"])


def weighted_postings(passages: DataFrame, terms: Terms, vocab: DataFrame, parts: int) -> DataFrame:
    """``weigh_tokens`` of all passages, no id standing twice. The vocabulary is capped; its terms go to the tasks in
    the order of the stored postings (part, term)."""
    rows = vocab.where(F.col("term").isNotNull()).select("term", "idf", part_of(F.col("term"), parts).alias("part")).toArrow()
    rows = rows.sort_by([("part", "ascending"), ("term", "ascending")]).combine_chunks()
    names = pa.concat_arrays(rows.column("term").chunks) if len(rows) else pa.array([], pa.string())
    idf, part = rows.column("idf").to_numpy(), rows.column("part").to_numpy().astype(np.int32)
    kind, split, pairs = passages.schema["passage_id"].dataType.simpleString(), terms.split, terms.pairs
    return passages.select("passage_id", terms.source.alias("toks")).mapInArrow(
        lambda batches: weigh_tokens(batches, split, pairs, names, idf, part),
        f"term string, passage_id {kind}, tf int, dl int, w double, part int")


def build_tfidf_index(passages: DataFrame, tokenizer: str | Tokenizer = "whitespace",
                      max_features: int = 50_000, ngrams: bool = True,
                      materialize: bool = True, out_dir: str | None = None) -> SparseIndex:
    """Capped 1-/2-gram TF-IDF with smooth idf and L2-normalized rows.

    ``idf = ln((1+N)/(1+df)) + 1``; the capped vocabulary has a proven size
    bound (``max_features`` rows), so it is the broadcast side of its joins.
    Postings carry ``w`` = tf*idf / ||passage||.
    """
    terms = terms_of(get_tokenizer(tokenizer), ngrams)
    lengths = passages.select("passage_id", F.lit(0).alias("dl"))
    if materialize:
        lengths = _out(lengths, "tokens", out_dir)
    n = lengths.count()
    repeats = ids_repeat(lengths)
    best, counts = most_frequent(passages, terms, max_features, repeats)
    vocab = best.withColumn("idf", F.log((1.0 + F.lit(n)) / (1.0 + F.col("df"))) + 1.0)
    if materialize:
        vocab = _out(vocab, "vocab", out_dir)
    extras = {"ngrams": ngrams, "max_features": max_features}
    buckets, parts = layout(passages.sparkSession, int(vocab.agg(F.sum("df")).first()[0] or 0)) if materialize else (0, 1)
    if repeats:
        # an id's rows are put together: the norm is a window over the passage's rows
        weighted = (counts.join(F.broadcast(vocab.select("term", "idf")), "term")
                    .withColumn("w", F.col("tf") * F.col("idf")))
        weighted = weighted.repartition(buckets, "passage_id") if materialize else weighted
        by_passage = Window.partitionBy("passage_id")
        postings = weighted.select(
            "term", "passage_id", "tf", "dl",
            (F.col("w") / F.sqrt(F.sum(F.col("w") * F.col("w")).over(by_passage))).alias("w"))
    else:
        # one shuffle, of texts by passage; weights are made in the passage's row
        dealt = passages.select("passage_id", "text")
        dealt = dealt.repartition(buckets, "passage_id") if materialize else dealt
        postings = weighted_postings(dealt, terms, vocab, parts)
        postings = postings if materialize else postings.drop("part")
    if materialize:
        postings = store_postings(postings, buckets, parts, out_dir)
        extras |= {"buckets": buckets, "parts": parts}
        vocab = vocab.join(postings.groupBy("term").agg(F.max("w").alias("peak")), "term")
        vocab = _out(vocab, "vocab_peaks", out_dir)
    return SparseIndex(postings=postings, vocab=vocab, lengths=lengths,
                       n_docs=n, avgdl=0.0, tokenizer=get_tokenizer(tokenizer), extras=extras)
