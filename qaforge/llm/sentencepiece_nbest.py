"""N-best SentencePiece encoding and decoding: forward Viterbi, backward A-star.

The pieces come from a public model file, and their log-probabilities from its
scores (``log_probabilities``: a BPE file holds merge ranks, which Zipf's law
turns into shares). A text is escaped (space
to the piece mark, one mark in front); its lattice has an edge for every
vocabulary piece that matches somewhere, and for a character that is no piece
an edge of that character's byte pieces at ``BYTE_SCORE`` a byte. A path's
score is the sum of its pieces' scores.

Forward Viterbi gives each position the best score of reaching it. The
backward search starts at the end and extends partial paths to the left; a
path's priority is its own score plus the Viterbi score of its left end,
which is exact, so paths leave the agenda in order of their total score. An
agenda entry stands for at least one full path of exactly its priority, and
different entries for different paths, so only the best ``n`` need to be
kept: the agenda is bounded whatever the length of the text.

No piece has a mark behind another character, so a lattice falls apart at the
marks into a chain of independent words. Words repeat, so each task keeps
their best path and the loss of the second best (both from the forward pass)
in a bounded cache. The n best paths of the text differ from its best one in
words with the n - 1 least losses; the backward search runs on those words
and the combinations of their detours are ranked exactly.

Encoding is lossless: decoding joins the pieces, reads byte pieces back as
UTF-8 and drops the first mark. A mark in the text itself is encoded as
bytes, so that it is told apart from a space.

Defined cases: a null text has null ids and scores, and no round trip; an
empty text has one path without pieces; repeated rows give repeated results;
of words with equal losses the earlier ones detour, and of equal paths the
search takes the first it meets (the same one each time); very long texts and
words are read whole; ids may be null; other columns are not read.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import CACHES, bounded_batches, powers, spans, trimmed, utf8

MARK = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Log-probability of a byte piece, below those of all others in a vocabulary of up to 10**8 pieces.
BYTE_SCORE = -24.0
#: Scores below this are no ranks or log-probabilities: files mark runs of spaces so.
UNRANKED = -1e8
#: Log-probabilities are whole multiples of 1 / STEPS, so that sums of them are exact in any order.
STEPS = 1024
NBEST = 4
CACHE_WORDS = 250_000
CACHE_LENGTH = 48
_NONE = float("-inf")


@dataclass
class Vocabulary:
    scores: dict[str, tuple[float, int]]
    suffixes: set[str]
    pieces: list[str]
    byte_ids: list[int]
    longest: int
    young: dict = field(default_factory=dict)
    old: dict = field(default_factory=dict)
    paths: dict = field(default_factory=dict)
    table: object = None
    #: By id: the piece with spaces for marks, an ASCII character for its byte piece, "\\0" for other bytes.
    texts: list[str] = field(default_factory=list)


def log_probabilities(scores: list[float]) -> list[float]:
    """Natural log-probabilities of pieces with these scores of a model file.

    Whole numbers are the merge ranks of a BPE model, from 0 downwards: adding
    them up would favour many frequent pieces over one rare piece whatever
    their frequencies are. The piece of rank r has a share in proportion to
    1 / r instead (Zipf's law). Other scores are log-probabilities already.
    Pieces below ``UNRANKED`` come after the last of the others.
    """
    known = [s for s in scores if s > UNRANKED]
    if not known:
        raise ValueError("the model has no scored pieces")
    scores = [s if s > UNRANKED else min(known) - 1 for s in scores]
    if all(s == int(s) <= 0 for s in known):
        total = math.log(sum(1 / (1 - s) for s in scores))
        scores = [-math.log(1 - s) - total for s in scores]
    return [round(s * STEPS) / STEPS for s in scores]


def load(path: str = MODEL) -> Vocabulary:
    """Pieces, scores and byte ids of a SentencePiece model file."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    names, suffixes, byte_ids = {}, set(), [-1] * 256
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    for i, p in enumerate(pieces):
        if sp.is_byte(i):
            byte_ids[int(p[3:5], 16)] = i
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)) and MARK not in p.lstrip(MARK) and "\n" not in p:
            names[p] = i
            suffixes.update(p[k:] for k in range(1, len(p)))
    if min(byte_ids) < 0:
        raise ValueError(f"{path} has no byte pieces")
    logs = log_probabilities([float(sp.get_score(i)) for i in names.values()])
    scores = {p: (s, i) for (p, i), s in zip(names.items(), logs)}
    texts = [p.replace(MARK, " ") for p in pieces]
    for b, i in enumerate(byte_ids):
        texts[i] = chr(b) if 0 < b < 0x80 else "\0"
    return Vocabulary(scores, suffixes, pieces, byte_ids, max(map(len, scores)), texts=texts)


_LOADED: dict[str, Vocabulary] = {}
CACHES["pieces"] = _LOADED.clear


def vocabulary(path: str = MODEL) -> Vocabulary:
    """One vocabulary per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = load(path)
    return _LOADED[path]


def split_words(text: str) -> list[str]:
    """The escaped text cut before each run of marks and around line ends, which no piece holds.

    Marks are still spaces; one is put in front of the text.
    """
    lines = (" " + text).split("\n")
    out = _line_words(lines[0])
    for line in lines[1:]:
        out.append("\n")
        if line:
            out += _line_words(line)
    return out


def _line_words(line: str) -> list[str]:
    parts = line.split(" ")
    if "" not in parts[1:]:
        out = [" " + part for part in parts]
        if parts[0]:
            out[0] = parts[0]
            return out
        return out[1:]
    out, pending = [], ""
    for k, part in enumerate(parts):
        pending += " " if k else ""
        if part:
            out.append(pending + part)
            pending = ""
    if pending:
        out.append(pending)
    return out


def edges(text: str, word: str, end: int, vocab: Vocabulary) -> list[tuple[int, float, tuple[int, ...]]]:
    """(start, score, ids) of the edges that end at ``end``; ``text`` is the escaped ``word``."""
    out = []
    for start in range(end - 1, max(end - vocab.longest, 0) - 1, -1):
        p = text[start:end]
        got = vocab.scores.get(p)
        if got is not None:
            out.append((start, got[0], (got[1],)))
        elif start == end - 1:
            raw = word[start].encode("utf-8", "surrogatepass")
            out.append((start, BYTE_SCORE * len(raw), tuple(vocab.byte_ids[b] for b in raw)))
        if p not in vocab.suffixes:
            break
    return out


def escape(word: str) -> str:
    return word.replace(MARK, "\0").replace(" ", MARK)  # the word's own marks match no piece


def forward(word: str, vocab: Vocabulary) -> tuple[list[float], list[list]]:
    """The best score of reaching each position, and the edges that end there."""
    text, best, steps = escape(word), [0.0], [[]]
    for end in range(1, len(word) + 1):
        steps.append(edges(text, word, end, vocab))
        best.append(max([best[start] + s for start, s, _ in steps[end]]))
    return best, steps


def nbest_word(word: str, vocab: Vocabulary, n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The n best paths of a word, best first, as (score, ids)."""
    best, steps = forward(word, vocab)
    done, order = [], 0
    # (loss so far, left end, order, score of the path's right part, path)
    agenda: list[tuple] = [(-best[-1], len(word), 0, 0.0, None)]
    while agenda and len(done) < n:
        cost, at, _, own, path = agenda.pop(0)
        if at == 0:
            ids: list[int] = []
            while path is not None:
                ids.extend(path[0])
                path = path[1]
            done.append((-cost, tuple(ids)))
            continue
        for start, s, piece in steps[at]:
            order += 1
            entry = (-(best[start] + s + own), start, order, own + s, (piece, path))
            k = len(agenda)
            while k and entry[:3] < agenda[k - 1][:3]:
                k -= 1
            if k < n - len(done):
                agenda.insert(k, entry)
                del agenda[n - len(done):]
    return done


def _best_path(word: str, vocab: Vocabulary) -> tuple[bytes, float, float]:
    """Ids (int32 bytes) and score of the best path, and the loss of the second best.

    The pass of ``forward``, without lists of edges.
    """
    text, n = escape(word), len(word)
    get, suffixes, longest = vocab.scores.get, vocab.suffixes, vocab.longest
    first, second, last = [0.0], [_NONE], [None]
    for end in range(1, n + 1):
        a = b = _NONE
        step = None
        start = end
        low = end - longest if end > longest else 0
        while start > low:
            start -= 1
            p = text[start:end]
            got = get(p)
            if got is not None:
                s, piece = got
                x = first[start] + s
                if x > a:
                    b = a
                    a, step = x, (start, piece)
                    y = second[start] + s
                    if y > b:
                        b = y
                elif x > b:
                    b = x
            elif start == end - 1:
                raw = word[start].encode("utf-8", "surrogatepass")
                s = BYTE_SCORE * len(raw)
                a, b, step = first[start] + s, second[start] + s, (start, raw)
            if p not in suffixes:
                break
        first.append(a)
        second.append(b)
        last.append(step)
    ids, at = [], n
    while at:
        at, piece = last[at]
        if piece.__class__ is bytes:
            ids.extend([vocab.byte_ids[c] for c in reversed(piece)])
        else:
            ids.append(piece)
    ids.reverse()
    return array("i", ids).tobytes(), first[n], first[n] - second[n]


def _word_paths(word: str, vocab: Vocabulary, n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The n best paths of a word (all, if fewer)."""
    held, got = vocab.paths.get(word, (0, []))
    if held < n:
        held, got = n, nbest_word(word, vocab, n)
        if len(word) <= CACHE_LENGTH:
            if len(vocab.paths) >= CACHE_WORDS // 20:
                vocab.paths.clear()
            vocab.paths[word] = held, got
    return got[:n]


#: An odd factor that spreads a polynomial hash over its high bits.
SPREAD = np.uint64(0x9FB21C651E98DF25)


class PieceTable:
    """Pieces by the hash of their code points: a large table, and a second one for pieces that collide in it."""

    def __init__(self, vocab: Vocabulary):
        names = list(vocab.scores)
        keys = np.zeros(len(names), np.uint64)
        by_size: dict[int, list[int]] = {}
        for k, p in enumerate(names):
            by_size.setdefault(len(p), []).append(k)
        for n, rows in by_size.items():
            points = np.frombuffer("".join([names[k] for k in rows]).encode("utf-32-le"), np.uint32)
            keys[rows] = prefix_sums_of(points.reshape(len(rows), n))[:, -1] * SPREAD
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two pieces with one hash")
        self.first, rest = self._place(keys, np.arange(len(keys)), 44, 20)
        self.second, left = self._place(keys, rest, 20, 22)
        if len(left):
            raise ValueError("pieces collide twice")
        self.keys = np.append(keys, np.uint64(0))
        self.scores = np.array([vocab.scores[p][0] for p in names] + [0.0])
        self.ids = np.array([vocab.scores[p][1] for p in names] + [-1], np.int32)

    @staticmethod
    def _place(keys, which, shift, bits):
        slot = (keys[which] >> np.uint64(shift)) & np.uint64((1 << bits) - 1)
        _, at = np.unique(slot, return_index=True)
        table = np.full(1 << bits, len(keys), np.int32)
        table[slot[at].astype(np.int64)] = which[at]
        return table, np.delete(which, at)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Index of the piece with each hash; the number of pieces if there is none."""
        none = len(self.keys) - 1
        got = self.first[(h >> np.uint64(44)).astype(np.int64)]
        # an empty place of the first table has no piece in the second one either
        missed = np.flatnonzero(got != none)
        missed = missed[self.keys[got[missed]] != h[missed]]
        if len(missed):
            again = self.second[((h[missed] >> np.uint64(20)) & np.uint64((1 << 22) - 1)).astype(np.int64)]
            got[missed] = np.where(self.keys[again] == h[missed], again, none)
        return got


def prefix_sums_of(points: np.ndarray) -> np.ndarray:
    """Running sums of (code point + 1) * BASE**i along the rows, with a leading zero."""
    p, _ = powers(points.shape[1])
    out = np.zeros((points.shape[0], points.shape[1] + 1), np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * p[None, :], axis=1, out=out[:, 1:])
    return out


def best_paths(words: list[str], vocab: Vocabulary) -> list[tuple[bytes, float, float]]:
    """``_best_path`` of many words at once: the forward pass runs over all words of a length together."""
    if vocab.table is None:
        vocab.table = PieceTable(vocab)
    table, out = vocab.table, [None] * len(words)
    by_size: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        by_size.setdefault(len(w) if len(w) <= CACHE_LENGTH else 0, []).append(k)
    for n, rows in by_size.items():
        if n == 0 or len(rows) < 16:
            for k in rows:
                out[k] = _best_path(words[k], vocab)
            continue
        for lo in range(0, len(rows), 1 << 15):
            some = rows[lo:lo + (1 << 15)]
            flat = escape("".join([words[k] for k in some])).encode("utf-32-le")
            sums = prefix_sums_of(np.frombuffer(flat, np.uint32).reshape(len(some), n))
            for k, got in zip(some, _forward_rows(sums, n, table, vocab.longest)):
                out[k] = got or _best_path(words[k], vocab)
    return out


def _forward_rows(sums: np.ndarray, n: int, table: PieceTable, longest: int):
    m = len(sums)
    columns = np.ascontiguousarray(sums.T)
    inverse = powers(n + 1)[1] * SPREAD
    first = np.full((n + 1, m), _NONE)
    second = np.full((n + 1, m), _NONE)
    first[0] = 0.0
    piece = np.zeros((n + 1, m), np.int32)
    back = np.zeros((n + 1, m), np.int32)
    plain = np.ones(m, bool)  # rows whose every character is a piece
    for end in range(1, n + 1):
        a, b = first[end], second[end]
        for start in range(end - 1, max(end - longest, 0) - 1, -1):
            at = table.find((columns[end] - columns[start]) * inverse[start])
            hit = np.flatnonzero(at != len(table.keys) - 1)
            if start == end - 1 and len(hit) < m:
                plain &= at != len(table.keys) - 1
            if not len(hit):
                continue
            s = table.scores[at[hit]]
            x, y = first[start][hit] + s, second[start][hit] + s
            was, then = a[hit], b[hit]
            better = x > was
            b[hit] = np.where(better, np.maximum(was, y), np.maximum(then, x))
            a[hit] = np.where(better, x, was)
            won = hit[better]
            piece[end][won] = table.ids[at[won]]
            back[end][won] = start
    with np.errstate(invalid="ignore"):
        loss = (first[n] - second[n]).tolist()
    path = np.zeros((m, n), np.int32)
    here, rank, every = np.full(m, n), np.full(m, n), np.arange(m)
    while True:
        live = every[here > 0]
        if not len(live):
            break
        rank[live] -= 1
        path[live, rank[live]] = piece[here[live], live]
        here[live] = back[here[live], live]
    flat, total = path.tobytes(), first[n].tolist()
    width = 4 * n
    return [(flat[k * width + 4 * r:(k + 1) * width], t, d) if ok else None
            for k, (r, t, d, ok) in enumerate(zip(rank.tolist(), total, loss, plain.tolist()))]


def learn(words: set[str], vocab: Vocabulary) -> dict:
    """Best paths of these short words, which the cache keeps: a table of one run's words is quicker to ask."""
    young, old = vocab.young, vocab.old
    fresh = []
    for w in words:
        if w not in young:
            got = old.get(w)
            if got is None:
                fresh.append(w)
            else:
                young[w] = got
    for w, got in zip(fresh, best_paths(fresh, vocab)):
        young[w] = got
    return {w: young[w] for w in words}


def _known(words: list[str], vocab: Vocabulary, learned: dict) -> list[tuple[bytes, float, float]]:
    out = list(map(learned.get, words))
    if None in out:
        for k, got in enumerate(out):
            if got is None:
                out[k] = _best_path(words[k], vocab)
    return out


def combine(losses: list[tuple[int, list[float]]], n: int) -> list[tuple[float, dict[int, int]]]:
    """The n least sums of losses, one detour (or none) per word: (loss, {word: path})."""
    best: list[tuple[float, dict[int, int]]] = [(0.0, {})]
    for k, extra in losses:
        grown = best + [(loss + x, taken | {k: m}) for loss, taken in best for m, x in enumerate(extra, 1)]
        best = sorted(grown, key=lambda x: x[0])[:n]
    return best


def nbest(text: str, vocab: Vocabulary, n: int = NBEST, words: list[str] | None = None,
          learned: dict | None = None) -> list[tuple[float, np.ndarray]]:
    """The n best segmentations of a whole text, best first, as (score, ids)."""
    if not text:
        return [(0.0, np.zeros(0, np.int32))]
    words = words or split_words(text)
    parts, scores, losses = zip(*_known(words, vocab, learned or vocab.young))
    total = sum(scores)
    out = [(total, np.frombuffer(b"".join(parts), np.int32))]
    if n > 1:
        loss = np.array(losses)
        few = np.flatnonzero(np.isfinite(loss))
        if len(few) > n - 1:
            limit = np.partition(loss[few], n - 2)[n - 2]
            below = few[loss[few] < limit]
            few = np.sort(np.concatenate([below, few[loss[few] == limit][:n - 1 - len(below)]]))
        # a detour of the word with the r-th least loss comes after those of the r - 1 words before it
        few = few[np.argsort(loss[few], kind="stable")].tolist()
        paths = {k: _word_paths(words[k], vocab, n - r) for r, k in enumerate(few)}
        ranked = combine([(k, [p[0][0] - s for s, _ in p[1:]]) for k, p in paths.items()], n)
        for lost, taken in ranked[1:]:
            swapped = list(parts)
            for k, m in taken.items():
                swapped[k] = np.array(paths[k][m][1], np.int32).tobytes()
            out.append((total - lost, np.frombuffer(b"".join(swapped), np.int32)))
    return out


def decode(ids, vocab: Vocabulary) -> str:
    """The text of a sequence of ids."""
    ids = np.asarray(ids, np.int32)
    plain = vocab.texts
    text = "".join([plain[i] for i in ids.tolist()])
    if "\0" not in text:  # every byte piece stands for a whole character
        return text[1:]
    byte_of = {i: b for b, i in enumerate(vocab.byte_ids)}
    out, raw = [], bytearray()
    for i in [*ids.tolist(), None]:
        if i in byte_of:
            raw.append(byte_of[i])
            continue
        if raw:
            out.append(raw.decode("utf-8", "surrogatepass"))
            raw = bytearray()
        if i is not None:
            out.append(plain[i])
    return "".join(out)[1:]


def _lists(values: list[np.ndarray | None], kind) -> pa.Array:
    offsets = np.zeros(len(values) + 1, np.int32)
    np.cumsum([0 if v is None else len(v) for v in values], out=offsets[1:])
    flat = np.concatenate([v for v in values if v is not None and len(v)] or [np.zeros(0)]).astype(kind)
    null = np.array([v is None for v in values], bool)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat), mask=pa.array(null))


def encode(docs: DataFrame, n: int = NBEST, path: str = MODEL, run_bytes: int = 1 << 20) -> DataFrame:
    """doc_id, n_pieces and ids of the best path, scores and piece counts of the n best, round_trip."""
    bounded_batches(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            _, offsets = utf8(batch.column("text"))
            for lo, hi in spans(offsets, run_bytes):
                if len(vocab.young) >= CACHE_WORDS // 2:  # two generations: words in use move on
                    vocab.old, vocab.young = vocab.young, {}
                part = batch.slice(lo, hi - lo)
                texts = part.column("text").to_pylist()
                words = [split_words(t) if t else None for t in texts]
                seen: set[str] = set()
                for w in words:
                    if w:
                        seen.update(w)
                learned = learn({w for w in seen if len(w) <= CACHE_LENGTH}, vocab)
                paths = [None if t is None else nbest(t, vocab, n, w, learned) for t, w in zip(texts, words)]
                ids = [p and p[0][1] for p in paths]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array([None if x is None else len(x) for x in ids], pa.int32()),
                    _lists(ids, np.int32),
                    _lists([p and np.array([s for s, _ in p]) for p in paths], np.float64),
                    _lists([p and np.array([len(i) for _, i in p]) for p in paths], np.int32),
                    pa.array([t is not None and decode(x, vocab) == t for t, x in zip(texts, ids)], pa.bool_())],
                    names=["doc_id", "n_pieces", "ids", "scores", "sizes", "round_trip"])
        # the worker may go on with other work: its word caches end with the task
        vocab.young, vocab.old, vocab.paths = {}, {}, {}

    return docs.select("doc_id", "text").mapInArrow(
        trimmed(rows, ("pieces",)), f"doc_id {kind}, n_pieces int, ids array<int>, scores array<double>, sizes array<int>, round_trip boolean")


def decode_ids(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id and text of encoded documents."""
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            texts = [None if x is None else decode(x, vocab) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(trimmed(rows, ("pieces",)), f"doc_id {kind}, text string")
