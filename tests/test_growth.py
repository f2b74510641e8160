"""What grows with the tables: counts without a shuffle of terms, filters without a sort of postings, dealt examples."""

import random
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from qaforge.functions.text import uni_and_bigrams, whitespace_tokens
from qaforge.operators import index as IX
from qaforge.operators import relevance as RV
from qaforge.operators import spans as SP
from qaforge.operators import store as ST
from qaforge.operators import windows as WN
from qaforge.operators.common import top_n
from qaforge.plans import registry


def grams():
    return uni_and_bigrams(whitespace_tokens(F.col("text")))



def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def corpus(spark, n=200, words=400, seed=3):
    rng = random.Random(seed)
    texts = [" ".join(f"w{min(int(rng.expovariate(0.02)), words)}" for _ in range(rng.randrange(0, 30))) for _ in range(n)]
    return [(i, t) for i, t in enumerate(texts)]


def frame(spark, data):
    return spark.createDataFrame(data, "passage_id long, text string")


def by_hand(data):
    """(passage id, number of grams) -> grams and their numbers."""
    out = defaultdict(Counter)
    for i, text in data:
        words = (text or "").lower().split()
        grams = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
        out[i, len(grams)].update(grams)
    return out


def test_terms_are_counted_without_a_shuffle(spark):
    data = [(1, "a b a B"), (2, ""), (3, None), (4, "x"), (5, " b  a ")]
    counts = IX.term_postings(frame(spark, data), grams())
    assert "Exchange" not in plan_of(counts)
    want = sorted((t, i, n, k) for (i, n), c in by_hand(data).items() for t, k in c.items())
    assert sorted(map(tuple, counts.collect())) == want


def test_tokens_are_counted_in_runs_of_a_bounded_size(spark, monkeypatch):
    plan = plan_of(IX.term_postings(frame(spark, [(1, "a b")]), grams(), repeats=False))
    assert "MapInArrow" in plan and "Generate" not in plan  # no array of structs per row that is then exploded
    monkeypatch.setattr(IX, "TOKENS_AT_ONCE", 40)
    rng = random.Random(5)
    toks = [None if i % 11 == 0 else [rng.choice("abcdé") for _ in range(rng.choice([0, 3, 25, 90]))] for i in range(200)]
    ids = [None if i % 50 == 7 else i for i in range(200)]
    batch = pa.record_batch([pa.array(ids, pa.int64()), pa.array([len(t or []) for t in toks], pa.int32()),
                             pa.array(toks, pa.list_(pa.string()))], ["passage_id", "dl", "toks"])
    runs = [[tuple(r.values()) for r in run.to_pylist()] for run in IX.count_tokens([batch.slice(0, 70), batch.slice(70)])]
    want = [(t, i, len(ts or []), n) for i, ts in zip(ids, toks) for t, n in Counter(ts or []).items()]
    assert sorted((r for run in runs for r in run), key=str) == sorted(want, key=str)
    assert all([r[0] for r in run] == sorted(r[0] for r in run) for run in runs)
    longest = max(len(t or []) for t in toks)
    assert len(runs) > 20 and max(sum(r[3] for r in run) for run in runs) <= 40 + longest


def test_terms_of_repeated_ids_are_counted_together(spark):
    data = [(1, "a b"), (1, "b a"), (1, "a"), (2, "a b"), (None, "a a"), (None, "a a")]
    got = sorted(map(tuple, IX.term_postings(frame(spark, data), grams()).collect()), key=str)
    assert got == sorted(((t, i, n, k) for (i, n), c in by_hand(data).items() for t, k in c.items()), key=str)


@pytest.mark.parametrize("counters", [1 << 22, 1 << 12])
@pytest.mark.parametrize("most", [5, 60, 700, 10_000])
def test_most_frequent_terms_are_exact(spark, monkeypatch, counters, most):
    monkeypatch.setattr(IX, "COUNTERS", counters)
    data = corpus(spark)
    cf, df = Counter(), Counter()
    for c in by_hand(data).values():
        cf.update(c)
        df.update(c.keys())
    want = sorted(cf, key=lambda t: (-cf[t], t))[:most]
    best, counts = IX.most_frequent(frame(spark, data), grams(), most)
    assert sorted(map(tuple, best.select("term", "cf", "df").collect())) == sorted((t, cf[t], df[t]) for t in want)
    assert counts.join(F.broadcast(best.select("term")), "term").count() == sum(df[t] for t in want)


def test_bound_is_lowered_until_enough_terms_reach_it(spark, monkeypatch):
    monkeypatch.setattr(IX, "COUNTERS", 1 << 12)
    # many terms of one count and few frequent ones: counters of several terms stand above any term
    data = [(i, f"u{i} v{i} u{i} v{i}") for i in range(3000)]
    best, _ = IX.most_frequent(frame(spark, data), grams(), 1000)
    every = Counter()
    for c in by_hand(data).values():
        every.update(c)
    assert {r["term"] for r in best.collect()} == set(sorted(every, key=lambda t: (-every[t], t))[:1000])


def test_filters_do_not_sort_the_postings(spark):
    docs = frame(spark, corpus(spark)).withColumn("lang", F.when(F.col("passage_id") % 2 == 0, "en").otherwise("de"))
    index = IX.build_index(docs.select("passage_id", "text"), "word")
    qs = spark.createDataFrame([(1, "w1 w2 w3"), (2, "w4 w70")], "qid long, question string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scores = ST.keyword_scores(index, qs, docs.where("lang = 'en'").select("passage_id"))
        plan = plan_of(scores)
        assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
        got = {tuple(r) for r in scores.select("qid", "passage_id").collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    every = {tuple(r) for r in ST.keyword_scores(index, qs).select("qid", "passage_id").collect()}
    assert got == {(q, p) for q, p in every if p % 2 == 0}


def test_examples_are_dealt_before_they_are_decoded(spark, sf0001):
    _, feats = registry._features(spark, sf0001)
    assert feats.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_answers_are_normalized_once_for_their_f1(spark):
    from qaforge.functions import text as TX

    df = spark.createDataFrame([("ab ba", "b a c"), ("", "x"), (None, "x"), ("x", None)], "p string, g string")
    scored = df.select(TX.char_f1(F.col("p"), F.col("g")).alias("f1"))
    assert plan_of(scored).count("translate(") <= 4
    assert [r["f1"] and round(r["f1"], 6) for r in scored.collect()] == [round(2 * (2 / 4) * (2 / 3) / (2 / 4 + 2 / 3), 6), 0.0, None, None]


def test_gold_passages_without_a_shuffle_of_texts(spark):
    """Neither postings nor texts are dealt anew; the candidates hold several rare terms of the text."""
    rows = [(i, f"x{i} common words of the house {'tail' if i % 2 else 'end'} y{i}") for i in range(60)]
    rows += [(100, "he said: common words of the house tail."), (101, "the house of words common tail"), (102, ""), (103, None)]
    passages = frame(spark, rows)
    golds = [(1, "common words of the house tail"), (1, "words of the house end"), (2, "x3 common words"), (2, "x3 common words"),
             (3, "no such text here at all"), (4, "x5"), (5, ""), (6, None), (7, "said: common words")]
    items = spark.createDataFrame(golds, "qid long, question string")
    index = IX.build_index(passages)
    out = RV.containing_passages(items.where("length(question) > 10"), passages, index)
    assert "Exchange hashpartitioning" not in plan_of(out)
    got = sorted(map(tuple, RV.containing_passages(items, passages, index).collect()))
    want = sorted((q, i) for q, g in golds for i, t in rows if g and t and g in t)
    assert got == want


def test_gold_passages_of_repeated_ids(spark):
    rows = [(1, "a b c d"), (1, "x b c d y"), (2, "a b c"), (2, "c d b c"), (3, "a b c d e")]
    passages = frame(spark, rows)
    items = spark.createDataFrame([(9, "b c d")], "qid long, question string")
    got = sorted(map(tuple, RV.containing_passages(items, passages, IX.build_index(passages)).collect()))
    assert got == [(9, 1), (9, 1), (9, 3)]


def test_a_windows_best_candidates_are_chosen_in_its_row(spark):
    rng = random.Random(5)
    rows = [(i // 2, i % 2, [None] + [(3 * t, 3 * t + 2) for t in range(12)] + [None], *[[float(rng.randrange(4)) for _ in range(14)] for _ in "se"])
            for i in range(40)]
    rows.append((7, 0, *rows[3][2:]))  # a window that comes twice
    feats = spark.createDataFrame(rows, "example_id long, window int, offsets array<struct<s:int,e:int>>, "
                                        "start_logits array<double>, end_logits array<double>")
    order = [F.col("score").desc(), F.col("si").asc(), F.col("ei").asc()]
    for best in (1, 3):
        cut = SP.window_candidates(feats, best_of=best)
        assert cut.count() == best * len(rows)
        want, got = (sorted(tuple(r) for r in top_n(c, ["example_id", "window"], order, best).drop("rank").collect())
                     for c in (SP.window_candidates(feats), cut))
        assert got == want


def test_pieces_of_a_text_are_not_shuffled(spark):
    rows = [(1, " ab  c\u00e9 d"), (2, ""), (3, None), (4, "x")]
    out = WN.token_offsets(frame(spark, rows), "passage_id", "text")
    below = plan_of(out).split("Exchange hashpartitioning")[1]
    assert "piece" not in below.split("Project")[0] and "length(piece" in below
    got = {r[0]: [tuple(x) for x in r[1]] for r in out.collect()}
    assert got == {1: [(1, 3), (5, 7), (8, 9)], 4: [(0, 1)]}
