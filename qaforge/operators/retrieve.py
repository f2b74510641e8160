"""Sparse retrieval: BM25 Okapi / BM25+ / BM25L, search-server BM25, TF-IDF.

Plan shape for every method (J2 + A5 + T1):

    questions -> tokens -> (qid, term, qtf)          small side, size-checked
              -> join vocab (idf)                    broadcast if bounded
              -> join postings on term               postings stay in place
              -> sum per (qid, passage_id)           partial agg, then shuffle
              -> row_number <= k per qid             WindowGroupLimit

With the query side broadcast, the postings are never shuffled by term, so a
term present in a third of all passages causes no skewed reducer. When the
query side is too large to broadcast, the postings of a hot term are salted
by ``passage_id``, with as many salts as its document frequency asks for.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import Tokenizer, get_tokenizer, uni_and_bigrams
from ..session import materialize
from .batch import batch_weights, best_sums
from .common import BROADCAST_MAX_ROWS, bounded_broadcast, rounded, top_n
from .index import SparseIndex, part_of
from .topk import exhaustive_topk, filled_topk, matches_only_topk

# ---------------------------------------------------------------------------
# The parameters of the scoring functions.
OKAPI = {"k1": 1.5, "b": 0.75, "epsilon": 0.25}
PLUS = {"k1": 1.5, "b": 0.75, "delta": 1.0}
BM25L = {"k1": 1.5, "b": 0.75, "delta": 0.5}
SERVER = {"k1": 1.2, "b": 0.75}
DEFAULT_K = 40
# ---------------------------------------------------------------------------
# Postings of one term that a reducer takes.
HOT_DF = 500_000


def query_terms(questions: DataFrame, tokenizer: Tokenizer | str = "whitespace",
                qid_col: str = "qid", text_col: str = "question",
                ngrams: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """``qid, term, qtf``: query tokens with their repeat count, and the question's columns ``keep``.

    Counted inside each question's row (questions are short), so building
    the query side needs no shuffle.
    """
    tok = get_tokenizer(tokenizer)
    toks = tok(F.col(text_col))
    if ngrams:
        toks = uni_and_bigrams(toks)
    counted = F.transform(F.array_distinct(toks), lambda t: F.struct(
        t.alias("term"), F.size(F.filter(toks, lambda x: x == t)).cast("long").alias("qtf")))
    return (questions.select(F.col(qid_col).alias("qid"), *keep, F.explode(counted).alias("c"))
            .select("qid", *keep, "c.term", "c.qtf"))


def _small(df: DataFrame, max_rows: int) -> tuple[DataFrame, bool]:
    n = df.count()
    return (F.broadcast(df), True) if n <= max_rows else (df, False)


def postings_of(index: SparseIndex, terms: DataFrame) -> DataFrame:
    """The postings table, cut to the folders that hold ``terms`` (column term) where it has folders."""
    parts = index.extras.get("parts")
    if not parts or "part" not in index.postings.columns:
        return index.postings
    needed = [r[0] for r in terms.select(part_of(F.col("term"), parts).alias("part")).distinct().collect()]  # at most `parts`
    return index.postings.where(F.col("part").isin(needed)) if len(needed) < parts else index.postings


def _join_postings(qside: DataFrame, postings: DataFrame, is_small: bool, hot_df: int) -> DataFrame:
    """Query terms x postings on term. Broadcast when small; otherwise a term
    with more than ``hot_df`` postings is dealt over ``ceil(df / hot_df)``
    salts, so a reducer's share of a term has the same size at any scale."""
    postings = postings.drop("part")
    if is_small:
        return qside.join(postings, "term")
    salts = F.ceil(F.col("df") / hot_df).cast("int")
    hot = bounded_broadcast(qside.where(F.col("df") > hot_df).select("term", salts.alias("salts")).distinct())
    salted_q = qside.withColumn("salt", F.explode(F.sequence(F.lit(0), F.greatest(salts, F.lit(1)) - 1)))
    salted_p = (postings.join(hot, "term", "left")
                .withColumn("salt", F.pmod(F.xxhash64("passage_id"), F.coalesce("salts", F.lit(1))).cast("int")).drop("salts"))
    return salted_q.join(salted_p, ["term", "salt"]).drop("salt")


@dataclass
class Scored:
    """Sparse scores plus the per-query base every unmatched passage gets."""
    matched: DataFrame      # qid, passage_id, score (rounded); BM25 also raw, n_terms (distinct query terms held)
    base: DataFrame         # qid, base (rounded), one row per query
    can_fall_below_base: bool = False
    small: bool = True      # the query side passed the broadcast size check


def _relative_length(index: SparseIndex, b: float) -> Column:
    return 1 - b + b * F.col("dl") / F.lit(index.avgdl)


def _idf(variant: str, n: int, mean_idf: float | None = None, eps: float = 0.25) -> Column:
    df = F.col("df")
    if variant == "okapi":
        raw = F.log(F.lit(n) - df + 0.5) - F.log(df + 0.5)
        return F.when(raw < 0, F.lit(eps * mean_idf)).otherwise(raw)
    if variant == "plus":
        return F.log((F.lit(n) + 1.0) / df)
    if variant == "l":
        return F.log(F.lit(n) + 1.0) - F.log(df + 0.5)
    if variant == "server":
        return F.log(1.0 + (F.lit(n) - df + 0.5) / (df + 0.5))
    raise ValueError(variant)


def okapi_mean_idf(index: SparseIndex) -> float:
    """Mean raw Okapi idf over the whole vocabulary (A16), a driver value."""
    n = index.n_docs
    row = index.vocab.agg(F.avg(F.log(F.lit(n) - F.col("df") + 0.5)
                                - F.log(F.col("df") + 0.5)).alias("m")).first()
    return float(row["m"] or 0.0)


def mean_idf_of(index: SparseIndex) -> float:
    """The stored mean idf, or the computed one."""
    if index.extras.get("mean_idf") is None:
        index.extras["mean_idf"] = okapi_mean_idf(index)
    return index.extras["mean_idf"]


DEFAULTS = {"okapi": OKAPI, "plus": PLUS, "l": BM25L, "server": SERVER}


def _contribution(index: SparseIndex, variant: str, p: dict, idf: Column, tf: Column | None = None,
                  length: Column | None = None) -> tuple[Column, Column]:
    """What a (query term, posting) adds to the score above the base, and what the term adds to the base.
    ``tf`` and ``length`` (the weighted relative passage length) are the posting's unless given."""
    k1, b = p["k1"], p["b"]
    tf = F.col("tf") if tf is None else tf
    length = _relative_length(index, b) if length is None else length
    norm = k1 * length
    w = F.col("qtf") * idf
    if variant == "okapi":
        return w * tf * (k1 + 1) / (tf + norm), F.lit(0.0)
    if variant == "plus":
        return w * (tf * (k1 + 1) / (norm + tf)), w * p["delta"]
    if variant == "l":
        d = p["delta"]
        c = tf / length
        return w * (k1 + 1) * ((c + d) / (k1 + c + d) - d / (k1 + d)), w * (k1 + 1) * d / (k1 + d)
    return w * tf / (tf + norm), F.lit(0.0)  # server


def score_bm25(index: SparseIndex, questions: DataFrame, variant: str = "okapi",
               qid_col: str = "qid", text_col: str = "question",
               params: dict | None = None, max_broadcast_rows: int = BROADCAST_MAX_ROWS,
               hot_df: int = HOT_DF, keep: tuple[str, ...] = (), where: Column | None = None) -> Scored:
    """Sparse BM25 scores for every question (R1-R3, R7). ``where`` is a condition on (query term, posting)
    rows, before they are summed; it may use the question's columns ``keep`` and those of the postings."""
    defaults = DEFAULTS[variant]
    p = {**defaults, **(params or {})}
    mean_idf = mean_idf_of(index) if variant == "okapi" else None
    qterms = query_terms(questions, index.tokenizer, qid_col, text_col, keep=keep)
    qside, is_small = _small(qterms, max_broadcast_rows)
    qv = (qside.join(index.vocab, "term")
          .withColumn("idf", _idf(variant, index.n_docs, mean_idf, p.get("epsilon", 0.25))))
    qv_side = F.broadcast(qv) if is_small else qv

    contrib, base_term = _contribution(index, variant, p, F.col("idf"))

    met = _join_postings(qv_side, postings_of(index, qside), is_small, hot_df)
    met = met if where is None else met.where(where)
    sums = (met.groupBy("qid", "passage_id").agg(F.sum(contrib).alias("s"), F.count(F.lit(1)).alias("n_terms")))
    if variant in ("okapi", "server"):
        # unmatched passages score 0: no per-query base to join
        base = questions.select(F.col(qid_col).alias("qid"), F.lit(0.0).alias("base"))
        matched = sums.select("qid", "passage_id", rounded(F.col("s")).alias("score"),
                              F.col("s").alias("raw"), "n_terms")
    else:
        b0 = qv.groupBy("qid").agg(F.sum(base_term).alias("b0"))
        b0 = F.broadcast(b0) if is_small else b0
        base = (questions.select(F.col(qid_col).alias("qid")).join(b0, "qid", "left")
                .select("qid", rounded(F.coalesce(F.col("b0"), F.lit(0.0))).alias("base"),
                        F.coalesce(F.col("b0"), F.lit(0.0)).alias("base_raw")))
        base_side = F.broadcast(base) if is_small else base
        matched = sums.join(base_side, "qid").select(
            "qid", "passage_id", rounded(F.col("base_raw") + F.col("s")).alias("score"),
            (F.col("base_raw") + F.col("s")).alias("raw"), "n_terms")
    below = variant == "okapi" and mean_idf is not None and mean_idf < 0
    return Scored(matched=matched, base=base.select("qid", "base"), can_fall_below_base=below,
                  small=is_small)


def _tfidf_weights(index: SparseIndex, questions: DataFrame, qid_col: str, text_col: str,
                   max_broadcast_rows: int) -> tuple[DataFrame, DataFrame, bool]:
    """(qid, term, qw: the weights of the questions' vectors; the query side; whether it may be broadcast)."""
    qterms = query_terms(questions, index.tokenizer, qid_col, text_col,
                         ngrams=index.extras.get("ngrams", True))
    qside, is_small = _small(qterms, max_broadcast_rows)
    qv = (qside.join(bounded_broadcast(index.vocab.select("term", "df", "idf")), "term")
          .withColumn("qw", F.col("qtf") * F.col("idf")))
    qnorm = qv.groupBy("qid").agg(F.sqrt(F.sum(F.col("qw") * F.col("qw"))).alias("qn"))
    qv = qv.join(qnorm, "qid").withColumn("qw", F.col("qw") / F.col("qn"))
    return qv, qside, is_small


def score_tfidf(index: SparseIndex, questions: DataFrame, qid_col: str = "qid",
                text_col: str = "question", max_broadcast_rows: int = BROADCAST_MAX_ROWS,
                hot_df: int = HOT_DF) -> Scored:
    """Cosine of L2-normalized tf*idf vectors over the capped vocabulary.
    Query terms outside the vocabulary are ignored."""
    qv, qside, is_small = _tfidf_weights(index, questions, qid_col, text_col, max_broadcast_rows)
    qv_side = F.broadcast(qv) if is_small else qv
    matched = (_join_postings(qv_side, postings_of(index, qside), is_small, hot_df)
               .groupBy("qid", "passage_id")
               .agg(rounded(F.sum(F.col("qw") * F.col("w"))).alias("score")))
    base = questions.select(F.col(qid_col).alias("qid"), F.lit(0.0).alias("base"))
    return Scored(matched=matched, base=base, small=is_small)


def topk(index: SparseIndex, scored: Scored, k: int = DEFAULT_K) -> DataFrame:
    """Exhaustive top-k (matches, then base-score fill by id)."""
    return exhaustive_topk(scored.matched, scored.base, index.lengths.select("passage_id"),
                           k, index.n_docs, scored.can_fall_below_base)


def bm25_topk(index: SparseIndex, questions: DataFrame, k: int = DEFAULT_K,
              variant: str = "okapi", bounded: bool | None = False, **kw) -> DataFrame:
    """Top-k over all passages. ``bounded`` (see ``operators.bounded``) leaves weak, frequent terms out of the sums:
    always, never, or with None where the document frequencies say that it reads less."""
    from . import bounded as B

    if bounded is not False and not kw and B.usable(index, variant):
        terms = materialize(B.query_bounds(index, questions, variant), "bounded-terms")
        if bounded or B.worth(*B.row_costs(terms)):
            return B.bounded_topk(index, questions, k, variant, terms=terms)
    return topk(index, score_bm25(index, questions, variant, **kw), k)


def bm25_lists(index: SparseIndex, questions: DataFrame, variants=("okapi", "plus"), k: int = DEFAULT_K,
               max_broadcast_rows: int = BROADCAST_MAX_ROWS, hot_df: int = HOT_DF) -> dict[str, DataFrame]:
    """The top-k lists of several BM25 variants from one join with the postings:
    one score column per variant in one aggregate, one ranking over (question,
    variant)."""
    mean_idf = mean_idf_of(index) if "okapi" in variants else None
    if "okapi" in variants and mean_idf < 0:  # scores below the base need the wider fill
        return {v: bm25_topk(index, questions, k, v) for v in variants}
    qside, is_small = _small(query_terms(questions, index.tokenizer), max_broadcast_rows)
    qv = qside.join(index.vocab, "term")
    parts = {}
    for v in variants:
        qv = qv.withColumn(f"idf_{v}", _idf(v, index.n_docs, mean_idf, DEFAULTS[v].get("epsilon", 0.25)))
        parts[v] = _contribution(index, v, DEFAULTS[v], F.col(f"idf_{v}"))
    base = (questions.select("qid").join(qv.groupBy("qid").agg(*[F.sum(parts[v][1]).alias(f"b_{v}") for v in variants]), "qid", "left")
            .na.fill(0.0, [f"b_{v}" for v in variants]))
    base = materialize(base, "bm25-base")  # one row per question
    side = F.broadcast(base) if is_small else base
    order = [F.col("score").desc(), F.col("passage_id").asc()]
    weights = batch_weights(index, qv.select("qid", "term", *[(F.col("qtf") * F.col(f"idf_{v}")).alias(f"w{i}") for i, v in enumerate(variants)])
                            ) if is_small else None
    if weights is not None:
        adds = [_contribution(index, v, DEFAULTS[v], F.lit(1.0))[0] for v in variants]
        bases = base.select("qid", *[F.col(f"b_{v}").alias(f"b{i}") for i, v in enumerate(variants)]).toArrow()
        sums = best_sums(index, weights, postings_of(index, qside).drop("part").withColumn("qtf", F.lit(1)), adds, k, bases)
        name = F.array(*[F.lit(v) for v in variants])[F.col("variant")]
        rows = sums.select("qid", "passage_id", name.alias("variant"), rounded(F.col("s")).alias("score"))
        # a row for each question of the id, as there is one where sums meet their base
        rows = top_n(rows, ["qid", "variant"], order, k).drop("rank").join(F.broadcast(base.select("qid")), "qid")
    else:
        sums = (_join_postings(F.broadcast(qv) if is_small else qv, postings_of(index, qside), is_small, hot_df)
                .groupBy("qid", "passage_id").agg(*[F.sum(parts[v][0]).alias(f"s_{v}") for v in variants]).join(side, "qid"))
        scores = F.array(*[F.struct(F.lit(v).alias("variant"), rounded(F.col(f"b_{v}") + F.col(f"s_{v}")).alias("score")) for v in variants])
        rows = sums.select("qid", "passage_id", F.explode(scores).alias("x")).select("qid", "passage_id", "x.variant", "x.score")
    best = materialize(top_n(rows, ["qid", "variant"], order, k), "bm25-lists")
    ids = index.lengths.select("passage_id")
    return {v: filled_topk(best.where(F.col("variant") == v).drop("variant"),
                           base.select("qid", rounded(F.col(f"b_{v}")).alias("base")), ids, k) for v in variants}


def server_topk(index: SparseIndex, questions: DataFrame, k: int = DEFAULT_K, **kw) -> DataFrame:
    """Search-server BM25: matches only, no fill."""
    if not kw:
        qside = query_terms(questions, index.tokenizer)
        qv = qside.join(index.vocab, "term").withColumn("idf", _idf("server", index.n_docs))
        weights = batch_weights(index, qv.select("qid", "term", (F.col("qtf") * F.col("idf")).alias("w0")))
        if weights is not None:
            add = _contribution(index, "server", SERVER, F.lit(1.0))[0]
            sums = best_sums(index, weights, postings_of(index, qside).drop("part").withColumn("qtf", F.lit(1)), [add], k)
            return matches_only_topk(sums.select("qid", "passage_id", rounded(F.col("s")).alias("score")), k)
    return matches_only_topk(score_bm25(index, questions, "server", **kw).matched, k)


def tfidf_topk(index: SparseIndex, questions: DataFrame, k: int = DEFAULT_K, **kw) -> DataFrame:
    if not kw:
        qv, qside, _ = _tfidf_weights(index, questions, "qid", "question", BROADCAST_MAX_ROWS)
        weights = batch_weights(index, qv.select("qid", "term", F.col("qw").alias("w0")))
        if weights is not None:
            sums = best_sums(index, weights, postings_of(index, qside).drop("part"), [F.col("w")], k)
            base = questions.select("qid", F.lit(0.0).alias("base"))
            return topk(index, Scored(sums.select("qid", "passage_id", rounded(F.col("s")).alias("score")), base), k)
    return topk(index, score_tfidf(index, questions, **kw), k)


def unmatched_queries(index: SparseIndex, questions: DataFrame, qid_col: str = "qid",
                      text_col: str = "question", ngrams: bool = False, strict: bool = False) -> DataFrame:
    """Questions none of whose terms is in the vocabulary (P14), as rows; an error with ``strict``."""
    qterms = query_terms(questions, index.tokenizer, qid_col, text_col, ngrams=ngrams)
    known = qterms.join(index.vocab.select("term"), "term", "left_semi").select("qid")
    none = (questions.select(F.col(qid_col).alias("qid"), F.col(text_col).alias("question"))
            .join(known, "qid", "left_anti"))
    if strict and (bad := none.limit(1).collect()):
        raise ValueError(f"question {bad[0]['qid']} has no known term")
    return none


METHODS = {
    "bm25": lambda idx, q, k, **kw: bm25_topk(idx, q, k, "okapi", **kw),
    "bm25_plus": lambda idx, q, k, **kw: bm25_topk(idx, q, k, "plus", **kw),
    "bm25l": lambda idx, q, k, **kw: bm25_topk(idx, q, k, "l", **kw),
    "server_bm25": lambda idx, q, k, **kw: server_topk(idx, q, k, **kw),
    "tfidf": lambda idx, q, k, **kw: tfidf_topk(idx, q, k, **kw),
}
#: Methods that need more than one sparse index: "ensemble" takes a dict of the indexes of its
#: members, "ivf" and "vector" an IVF index and questions with an embedding.
COMBINED = ("ensemble", "ivf", "vector")


def _combined(index, questions: DataFrame, method: str, k: int, **kw) -> DataFrame:
    from . import ensemble as EN
    from . import vector as VE

    if method == "ensemble":
        return EN.max_merge({m: retrieve(index[m], questions, m, k) for m in EN.ENSEMBLE_METHODS}, k, **kw)
    found = (VE.ivf_topk if method == "ivf" else VE.exact_topk)(index, questions, k, **kw)
    return found.select("qid", "rank", F.col("vec_id").alias("passage_id"), (-F.col("distance")).alias("score"))


def retrieve(index, questions: DataFrame, method: str = "bm25",
             k: int = DEFAULT_K, **kw) -> DataFrame:
    """Retriever selection by name (R12); unknown names are an error."""
    if method in COMBINED:
        return _combined(index, questions, method, k, **kw)
    try:
        fn = METHODS[method]
    except KeyError:
        raise ValueError(f"unknown retrieval method {method!r}; known: {sorted([*METHODS, *COMBINED])}") from None
    return fn(index, questions, k, **kw)
