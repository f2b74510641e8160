"""Terms cut out of texts' bytes, weights made in the passage's row, sums of a batch of questions."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from qaforge.functions.text import uni_and_bigrams, whitespace_tokens
from qaforge.operators import batch as BA
from qaforge.operators import index as IX
from qaforge.operators import retrieve as R


ODD = ["", " ", None, "a", "A  b\ta\nB a", " x\x0by\x0cz\r", " nb sp éÉ İ ΣΑΣ", "\U0001f600 a", "a b " * 300, "\n\n", "word"]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "passage_id long, text string")


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def some_texts(n, seed=2, words=60):
    rng = random.Random(seed)
    return [" ".join(f"t{min(int(rng.expovariate(0.08)), words)}" for _ in range(rng.randrange(1, 40))) for _ in range(n)]


@pytest.mark.parametrize("at_once", [7, 1 << 20])
def test_terms_of_bytes_equal_the_tokenizers(spark, monkeypatch, at_once):
    monkeypatch.setattr(IX, "BYTES_AT_ONCE", at_once)
    docs = frame(spark, ODD)
    for ngrams in (False, True):
        terms = IX.terms_of(whitespace_tokens, ngrams)
        assert terms.split
        column = uni_and_bigrams(whitespace_tokens(F.col("text"))) if ngrams else whitespace_tokens(F.col("text"))
        assert rows(IX.term_postings(docs, terms), "term", "passage_id", "dl", "tf") == rows(IX.term_postings(docs, column), "term", "passage_id", "dl", "tf")
        toks = docs.select(column.alias("toks"))
        batches = toks.where("toks is not null").toArrow().to_batches()
        lists = [t for b in batches for t in b.column(0).to_pylist()]
        text = docs.where("text is not null").select(F.lower("text").alias("toks")).toArrow().to_batches()
        runs = [r for b in text for r in IX.token_runs(b.column(0), True)]
        assert sum(int(r[2].sum()) for r in runs) == sum(len(whole.split(" ")) for t in lists for whole in t if " " not in whole)
    assert rows(IX.passage_lengths(docs, whitespace_tokens), "passage_id", "dl") == rows(
        docs.select("passage_id", F.size(whitespace_tokens(F.col("text"))).alias("dl")), "passage_id", "dl")


def test_weights_are_made_without_a_shuffle_of_terms(spark):
    texts = some_texts(300)
    docs = frame(spark, texts)
    index = IX.build_tfidf_index(docs, max_features=200, materialize=False)
    plan = plan_of(index.postings)
    assert "MapInArrow" in plan and "Window" not in plan and "Exchange" not in plan
    cf, df, held = Counter(), Counter(), []
    for t in texts:
        w = t.split()
        held.append(Counter(w + [f"{a} {b}" for a, b in zip(w, w[1:])]))
        cf.update(held[-1])
        df.update(held[-1].keys())
    best = sorted(cf, key=lambda t: (-cf[t], t))[:200]
    idf = {t: np.log((1 + len(texts)) / (1 + df[t])) + 1 for t in best}
    want = {}
    for i, c in enumerate(held):
        own = {t: n * idf[t] for t, n in c.items() if t in idf}
        norm = np.sqrt(sum(x * x for x in own.values()))
        want.update({(t, i): x / norm for t, x in own.items()})
    got = {(r["term"], r["passage_id"]): r["w"] for r in index.postings.collect()}
    assert got.keys() == want.keys() and all(abs(got[x] - want[x]) < 1e-12 for x in want)
    stored = IX.build_tfidf_index(docs, max_features=200)
    assert {(r["term"], r["passage_id"]): r["w"] for r in stored.postings.collect()} == pytest.approx(want, abs=1e-12)


def test_weights_of_repeated_ids(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "b c"), (2, "a"), (None, "a c"), (None, "c")], "passage_id long, text string")
    index = IX.build_tfidf_index(docs, max_features=50)
    for r in index.postings.groupBy("passage_id").agg(F.sum(F.col("w") * F.col("w")).alias("n")).collect():
        assert abs(r["n"] - 1) < 1e-9


@pytest.mark.parametrize("small", [False, True])
def test_sums_of_a_batch_equal_the_joins(spark, monkeypatch, small):
    if small:
        for name, value in (("QUESTIONS", 3), ("PASSAGES", 7), ("PAIRS", 11)):
            monkeypatch.setattr(BA, name, value)
    docs = frame(spark, [*some_texts(200), "same words", "same words", "same words", ""])
    asked = [(i, t) for i, t in enumerate([*some_texts(20, seed=9, words=90), "same", "unknown", "t1 t1 t2", ""])]
    qs = spark.createDataFrame([*asked, (3, "t5 t6"), (None, "t1 t7")], "qid long, question string")  # an id stands twice, one is null
    bm, tf = IX.build_index(docs), IX.build_tfidf_index(docs, max_features=300)
    variants = ("okapi", "plus", "l")
    out, calls = {}, []
    best = R.best_sums
    monkeypatch.setattr(R, "best_sums", lambda *a, **b: calls.append(1) or best(*a, **b))
    for limit in (BA.BATCH_TERMS, 0):
        monkeypatch.setattr(BA, "BATCH_TERMS", limit)
        lists = R.bm25_lists(bm, qs, variants, 5) | {"tfidf": R.tfidf_topk(tf, qs, 5), "server": R.server_topk(bm, qs, 5)}
        out[limit] = {v: rows(df, "qid", "rank", "passage_id", "score") for v, df in lists.items()}
        assert len(calls) == 3
    both = list(out.values())
    assert both[0] == both[1] and all(both[0].values())


def test_a_batch_makes_no_row_per_pair(spark):
    bm = IX.build_index(frame(spark, some_texts(100)))
    qs = spark.createDataFrame(list(enumerate(some_texts(10, seed=4))), "qid long, question string")
    plan = plan_of(R.server_topk(bm, qs, 5))
    assert "MapInArrow" in plan and "Bucketed: true" in plan
    before_sums = plan[plan.index("MapInArrow"):]
    assert "qid" not in before_sums.split("\n", 1)[1] and "Exchange hashpartitioning(passage_id" not in plan


def test_folders_of_terms_equal_sparks(spark):
    rng = random.Random(8)
    terms = ["", "a", "é", *("".join(rng.choice("abcdeé中\U0001f600") for _ in range(n)) for n in range(90))]
    frame = spark.createDataFrame([(t,) for t in terms], "term string")
    got = IX.xxhash64(frame.toArrow().column(0).combine_chunks())
    assert got.tolist() == [r[0] for r in frame.select(F.xxhash64("term")).collect()]


def test_stored_postings_lie_in_the_folders_of_their_terms(spark):
    index = IX.build_index(frame(spark, [t or "" for t in ODD] + some_texts(50)), parts=16)
    assert index.postings.where(F.col("part") != IX.part_of(F.col("term"), 16)).count() == 0
    assert rows(index.postings, "term", "passage_id", "dl", "tf") == rows(
        IX.build_index(frame(spark, [t or "" for t in ODD] + some_texts(50)), materialize=False).postings, "term", "passage_id", "dl", "tf")
