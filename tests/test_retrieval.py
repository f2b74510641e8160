"""BM25 family and TF-IDF against plain-Python brute force on tiny corpora."""

import math
from collections import Counter

import pytest

from qaforge.operators import retrieve as R
from qaforge.operators.corpus import distinct_passages
from qaforge.operators.index import build_index, build_tfidf_index

CORPUS = [
    (1, "the cat sat on the mat"),
    (2, "the dog sat on the log"),
    (3, "cats and dogs"),
    (4, "the cat sat on the mat"),      # copy of 1: dropped, id 1 kept
    (5, ""),                            # empty passage still counts in N and avgdl
    (6, "a bird on a wire the end"),
]
QUESTIONS = [
    (10, "cat on mat"),
    (11, "the the dog"),                # repeated term counts twice
    (12, "zebra unicorn"),              # no known term
    (13, "wire"),                       # fewer matches than k
]


def docs_df(spark, rows=CORPUS):
    return spark.createDataFrame(rows, "doc_id long, text string")


def q_df(spark, rows=QUESTIONS):
    return spark.createDataFrame(rows, "qid long, question string")


def passages_py(rows):
    seen = {}
    for i, t in sorted(rows):
        seen.setdefault(t, i)
    return sorted((i, t) for t, i in seen.items())


def bm25_py(rows, questions, variant, k):
    ps = passages_py(rows)
    toks = {i: t.lower().split() for i, t in ps}
    n = len(ps)
    avgdl = sum(len(v) for v in toks.values()) / n
    df = Counter(w for v in toks.values() for w in set(v))
    if variant == "okapi":
        raw = {w: math.log(n - d + 0.5) - math.log(d + 0.5) for w, d in df.items()}
        mean = sum(raw.values()) / len(raw)
        idf = {w: (0.25 * mean if v < 0 else v) for w, v in raw.items()}
    elif variant == "plus":
        idf = {w: math.log((n + 1) / d) for w, d in df.items()}
    else:
        idf = {w: math.log(n + 1) - math.log(d + 0.5) for w, d in df.items()}
    out = {}
    for qid, q in questions:
        scores = []
        for i, _ in ps:
            tf = Counter(toks[i])
            dl = len(toks[i])
            s = 0.0
            for w in q.lower().split():
                if w not in idf:
                    continue
                f = tf.get(w, 0)
                if variant == "okapi":
                    s += idf[w] * f * 2.5 / (f + 1.5 * (0.25 + 0.75 * dl / avgdl))
                elif variant == "plus":
                    s += idf[w] * (1.0 + f * 2.5 / (1.5 * (0.25 + 0.75 * dl / avgdl) + f))
                else:
                    c = f / (0.25 + 0.75 * dl / avgdl)
                    s += idf[w] * 2.5 * (c + 0.5) / (1.5 + c + 0.5)
            scores.append((round(s, 6), i))
        ranked = sorted(scores, key=lambda x: (-x[0], x[1]))[:k]
        out[qid] = [(i, s) for s, i in ranked]
    return out


def as_dict(df):
    out = {}
    for r in df.orderBy("qid", "rank").collect():
        out.setdefault(r["qid"], []).append((r["passage_id"], r["score"]))
    return out


def test_dedup_keeps_smallest_id(spark):
    got = sorted(tuple(r) for r in distinct_passages(docs_df(spark)).collect())
    assert got == passages_py(CORPUS)


@pytest.mark.parametrize("variant", ["okapi", "plus", "l"])
@pytest.mark.parametrize("k", [1, 3, 5])
def test_bm25_matches_brute_force(spark, variant, k):
    idx = build_index(distinct_passages(docs_df(spark)))
    got = as_dict(R.bm25_topk(idx, q_df(spark), k, variant))
    want = bm25_py(CORPUS, QUESTIONS, variant, k)
    assert got.keys() == want.keys()
    for qid in want:
        assert [p for p, _ in got[qid]] == [p for p, _ in want[qid]], (variant, qid)
        assert [s for _, s in got[qid]] == pytest.approx([s for _, s in want[qid]], abs=1e-6)


def test_fill_for_unknown_terms_is_lowest_ids(spark):
    idx = build_index(distinct_passages(docs_df(spark)))
    got = as_dict(R.bm25_topk(idx, q_df(spark), 3, "okapi"))
    assert got[12] == [(1, 0.0), (2, 0.0), (3, 0.0)]
    unmatched = [r["qid"] for r in R.unmatched_queries(idx, q_df(spark)).collect()]
    assert unmatched == [12]


def test_okapi_negative_floor_all_terms_everywhere(spark):
    # every term is in every passage: all raw idfs are negative, the floor is
    # negative, so matched passages score below the unmatched ones
    rows = [(1, "x y"), (2, "x y x"), (3, "y x"), (4, "x y y"), (5, "q")]
    questions = [(1, "x"), (2, "y x")]
    idx = build_index(distinct_passages(docs_df(spark, rows)))
    for k in (1, 2, 5):
        got = as_dict(R.bm25_topk(idx, q_df(spark, questions), k, "okapi"))
        want = bm25_py(rows, questions, "okapi", k)
        for qid in want:
            assert [p for p, _ in got[qid]] == [p for p, _ in want[qid]]


def tfidf_py(rows, questions, k, max_features=50_000):
    ps = passages_py(rows)

    def grams(t):
        w = t.lower().split()
        return w + [a + " " + b for a, b in zip(w, w[1:])]

    counts = {i: Counter(grams(t)) for i, t in ps}
    cf = Counter()
    for c in counts.values():
        cf.update(c)
    vocab = sorted(cf, key=lambda w: (-cf[w], w))[:max_features]
    n = len(ps)
    df = Counter(w for c in counts.values() for w in c if w in vocab)
    idf = {w: math.log((1 + n) / (1 + df[w])) + 1 for w in vocab}

    def vec(c):
        v = {w: f * idf[w] for w, f in c.items() if w in idf}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items()} if norm else {}

    pv = {i: vec(c) for i, c in counts.items()}
    out = {}
    for qid, q in questions:
        qv = vec(Counter(grams(q)))
        scores = [(round(sum(x * pv[i].get(w, 0.0) for w, x in qv.items()), 6), i) for i, _ in ps]
        out[qid] = [(i, s) for s, i in sorted(scores, key=lambda x: (-x[0], x[1]))[:k]]
    return out


@pytest.mark.parametrize("max_features", [3, 50_000])
def test_tfidf_matches_brute_force(spark, max_features):
    idx = build_tfidf_index(distinct_passages(docs_df(spark)), max_features=max_features)
    got = as_dict(R.tfidf_topk(idx, q_df(spark), 4))
    want = tfidf_py(CORPUS, QUESTIONS, 4, max_features)
    for qid in want:
        assert [p for p, _ in got[qid]] == [p for p, _ in want[qid]], qid
        assert [s for _, s in got[qid]] == pytest.approx([s for _, s in want[qid]], abs=1e-6)


def test_server_bm25_matches_only(spark):
    idx = build_index(distinct_passages(docs_df(spark)), "word")
    got = as_dict(R.server_topk(idx, q_df(spark), 5))
    assert 12 not in got                    # no match, no fill
    assert [p for p, _ in got[13]] == [6]   # only one passage has "wire"


def test_unknown_method_is_an_error(spark):
    idx = build_index(distinct_passages(docs_df(spark)))
    with pytest.raises(ValueError):
        R.retrieve(idx, q_df(spark), "dense_magic")


def test_permutation_invariance(spark):
    rows = list(reversed(CORPUS))
    a = as_dict(R.bm25_topk(build_index(distinct_passages(docs_df(spark))), q_df(spark), 3))
    b = as_dict(R.bm25_topk(build_index(distinct_passages(docs_df(spark, rows))), q_df(spark), 3))
    assert a == b


@pytest.mark.parametrize("variant", ["okapi", "plus"])
def test_salted_shuffle_path_equals_broadcast_path(spark, variant):
    """Above the broadcast bound the query side is shuffled and the postings
    are salted by passage id; the result must not change."""
    idx = build_index(distinct_passages(docs_df(spark)))
    a = as_dict(R.bm25_topk(idx, q_df(spark), 4, variant))
    b = as_dict(R.bm25_topk(idx, q_df(spark), 4, variant, max_broadcast_rows=0, hot_df=1))
    assert a == b
    plan = R.score_bm25(idx, q_df(spark), variant, max_broadcast_rows=0, hot_df=1).matched \
        ._jdf.queryExecution().executedPlan().toString()
    assert "salt" in plan


def test_tfidf_salted_path(spark):
    idx = build_tfidf_index(distinct_passages(docs_df(spark)))
    a = as_dict(R.tfidf_topk(idx, q_df(spark), 3))
    b = as_dict(R.tfidf_topk(idx, q_df(spark), 3, max_broadcast_rows=0, hot_df=1))
    assert a == b
