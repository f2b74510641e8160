"""Retrieve-then-read over passages (T7, D11, F4) and the retrieval
evaluation job (R14, U1).

Reading runs per (question, retrieved passage) example: windows -> model
scores -> span candidates; answers are then limited per window
(``top_k_per_sample``), per passage (``top_k_per_candidate``, equal
offsets counted once) and per question (``top_k``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import assemble as AS
from ..operators import ensemble as EN
from ..operators import retrieve as R
from ..operators import spans as SP
from ..operators import windows as WN
from ..operators.common import top_n
from ..operators.index import SparseIndex
from ..session import materialize

# Reader limits of the store configuration.
TOP_K_PER_SAMPLE = 1
TOP_K_PER_CANDIDATE = 3
READER_TOP_K = 1
RETRIEVER_TOP_K = 10
READER_MAX_LEN = 256
READER_QUESTION_LEN = 64
# The first READER_QUESTION_LEN tokens of a question.
QUESTION_HEAD = r"^\s*\S+(\s+\S+){0,%d}" % (READER_QUESTION_LEN - 1)
PAIR_SEED = 1_000_000     # seeds the stand-in scores of a (question, passage) pair

ScoreFn = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]
LOGITS_SCHEMA = ("example_id struct<qid:long,passage_id:long>, window int, offsets array<struct<s:int,e:int>>, "
                 "start_logits array<double>, end_logits array<double>")


#: Tokens, padding included, that a scorer gets at once.
TOKEN_BUDGET = 16_384
#: (batch of windows) -> (start scores, end scores), one list a window.
Scorer = Callable[[pd.DataFrame], tuple[list, list]]


def in_token_batches(frames: Iterator[pd.DataFrame], budget: int) -> Iterator[pd.DataFrame]:
    """Cut a stream of windows that rise in length into batches whose padded size (windows x longest) is at most
    ``budget`` tokens; a longer window is a batch of its own."""
    held: list = []
    for frame in frames:
        rest = pd.concat([*held, frame], ignore_index=True) if held else frame.reset_index(drop=True)
        lengths, lo = rest["n_tokens"].tolist(), 0
        for i, n in enumerate(lengths):
            if i > lo and (i - lo + 1) * n > budget:
                yield rest.iloc[lo:i].reset_index(drop=True)
                lo = i
        held = [rest.iloc[lo:]]
    if held and len(held[0]):
        yield held[0].reset_index(drop=True)


def score_features(features: DataFrame, model: ScoreFn | None = None, scorer: Scorer | None = None,
                   budget: int = TOKEN_BUDGET) -> DataFrame:
    """Model scores per window (F4). ``scorer`` gets batches of windows of like
    length, sorted within each partition (no shuffle, little padding) and cut
    by a budget of padded tokens; ids travel with their rows. ``model`` is a
    whole ``mapInPandas`` function returning ``LOGITS_SCHEMA`` rows. Without
    either, the deterministic stand-in scores are used (no model ships with
    this library)."""
    if scorer is not None:
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in in_token_batches(frames, budget):
                start, end = scorer(batch)
                yield batch[["example_id", "window", "offsets"]].assign(start_logits=list(start), end_logits=list(end))

        kinds = ", ".join(f"{c} {features.schema[c].dataType.simpleString()}" for c in ("example_id", "window", "offsets"))
        by_length = features.select("example_id", "window", "offsets", F.size("offsets").alias("n_tokens"))
        return (by_length.sortWithinPartitions("n_tokens", "example_id", "window")
                .mapInPandas(run, f"{kinds}, start_logits array<double>, end_logits array<double>"))
    if model is None:
        return WN.synthetic_logits(features, number=F.col("example_id.qid") * PAIR_SEED + F.col("example_id.passage_id"))
    return features.mapInPandas(model, LOGITS_SCHEMA)


def read_retrieved(ranked: DataFrame, passages: DataFrame, questions: DataFrame,
                   model: ScoreFn | None = None, top_k: int = READER_TOP_K,
                   per_candidate: int = TOP_K_PER_CANDIDATE, per_sample: int = TOP_K_PER_SAMPLE,
                   max_len: int = READER_MAX_LEN, stride: int = WN.DOC_STRIDE,
                   max_passages_per_question: int = RETRIEVER_TOP_K, scorer: Scorer | None = None) -> DataFrame:
    """Answers across retrieved passages: ``qid, rank, passage_id, text, score``."""
    bound = questions.count() * max_passages_per_question
    ranked = materialize(ranked.select("qid", "passage_id"), "reader-pairs")  # k rows per question
    pairs = AS.with_text(ranked, passages, bound_rows=bound).join(questions.select("qid", "question"), "qid")
    # a popular passage is tokenized once, not once per question
    texts = AS.with_text(ranked.select("passage_id").distinct(), passages, bound_rows=bound)
    offsets = WN.token_offsets(texts, "passage_id", "text")
    examples = pairs.select(F.struct(F.col("qid").cast("long").alias("qid"), F.col("passage_id").cast("long").alias("passage_id"))
                            .alias("example_id"),
                            "qid", "passage_id", F.regexp_extract("question", QUESTION_HEAD, 0).alias("question"),
                            F.col("text").alias("context"))
    feats = score_features(WN.context_windows(examples, max_len, stride, offsets=offsets, offsets_on="passage_id"), model, scorer)
    # a window's best candidates are chosen in its row: sorting all of them would be the largest step
    cands = SP.window_candidates(feats, best_of=per_sample)
    per_window = top_n(cands, ["example_id", "window"],
                       [F.col("score").desc(), F.col("si").asc(), F.col("ei").asc()], per_sample, "wr")
    # equal character spans from overlapping windows count once
    unique = top_n(per_window, ["example_id", "s_off", "e_off"],
                   [F.col("score").desc(), F.col("window").asc()], 1, "dr")
    per_passage = top_n(unique, "example_id",
                        [F.col("score").desc(), F.col("window").asc(), F.col("si").asc()], per_candidate, "pr")
    with_q = per_passage.join(examples.select("example_id", "qid", "passage_id", "context"), "example_id")
    best = top_n(with_q, "qid", [F.col("score").desc(), F.col("passage_id").asc(),
                                 F.col("s_off").asc(), F.col("e_off").asc()], top_k)
    return best.select("qid", F.col("rank").cast("int"), "passage_id",
                       F.substring("context", F.col("s_off") + 1, F.col("e_off") - F.col("s_off")).alias("text"),
                       F.col("score").cast("double"))


def evaluate_retrievers(indexes: dict[str, SparseIndex], passages: DataFrame, questions: DataFrame,
                        k: int = R.DEFAULT_K, gold_col: str = "question",
                        with_ensemble: bool = True) -> DataFrame:
    """Hit rate and mean scaled gold score per method (R14): one row per
    method. ``indexes`` maps a method name of ``retrieve.METHODS`` to its
    index (TF-IDF methods need a TF-IDF index)."""
    # each list is read several times (its own metrics and the ensemble):
    # write it once to the shared folder (k rows per question)
    variants = {m: v for m, v in (("bm25", "okapi"), ("bm25_plus", "plus"), ("bm25l", "l")) if m in indexes}
    shared = {id(indexes[m]) for m in variants}
    joint = R.bm25_lists(indexes[next(iter(variants))], questions, tuple(variants.values()), k) if len(shared) == 1 else {}
    lists = {m: materialize(joint[variants[m]] if m in variants and joint else R.retrieve(idx, questions, m, k), f"ranked-{m}")
             for m, idx in indexes.items()}
    bound = questions.count() * k
    if with_ensemble and all(m in lists for m in EN.ENSEMBLE_METHODS):
        lists["ensemble"] = EN.max_merge({m: lists[m] for m in EN.ENSEMBLE_METHODS}, k)
    rows = None
    for method, ranked in lists.items():
        assembled = AS.assemble(AS.with_text(ranked, passages, bound_rows=bound), questions, gold_col=gold_col)
        r = AS.hit_rate(assembled).select(F.lit(method).alias("method"), "*")
        rows = r if rows is None else rows.unionByName(r)
    return rows
