"""Filters, store retrieval, labels, answer metrics, curriculum, ranking metrics."""

import pytest
from pyspark.sql import functions as F

from qaforge.functions.filters import compile_filter
from qaforge.operators import ensemble as EN
from qaforge.operators import metrics as MT
from qaforge.operators import prep as PR
from qaforge.operators import relevance as RV
from qaforge.operators import store as ST

META = [(1, "en", "src1", 100), (2, "de", "src2", 2500), (3, "fr", "src3", 1500),
        (4, "en", "src9", 800), (5, "fr", "src1", 50)]


def meta_df(spark):
    return spark.createDataFrame(META, "doc_id long, lang string, source string, n_chars long")


def ids(df):
    return sorted(r["doc_id"] for r in df.collect())


@pytest.mark.parametrize("flt,want", [
    ({"lang": "en"}, [1, 4]),                                            # scalar -> $eq
    ({"lang": ["en", "fr"]}, [1, 3, 4, 5]),                              # list -> $in
    ({"n_chars": {"$gte": 100, "$lt": 2000}}, [1, 3, 4]),
    ({"$or": [{"$and": {"lang": "en", "n_chars": {"$lt": 500}}},
              {"$and": {"lang": "fr", "n_chars": {"$gte": 1000}}}]}, [1, 3]),
    ({"$not": {"lang": "en"}}, [2, 3, 5]),
    ({"$and": {"lang": {"$in": ["en", "de"]}, "$or": {"source": ["src1"], "lang": "de"}}}, [1, 2]),
])
def test_filters(spark, flt, want):
    assert ids(meta_df(spark).where(compile_filter(flt))) == want


def test_unknown_filter_operator(spark):
    with pytest.raises(ValueError):
        compile_filter({"lang": {"$regex": "e.*"}})
    with pytest.raises(ValueError):
        compile_filter({"$xor": {"lang": "en"}})


def test_filter_pushed_to_parquet_scan(spark, sf0001):
    from qaforge.sources.tables import table
    df = table(spark, sf0001, "documents").where(compile_filter({"lang": "en", "n_chars": {"$gte": 100}}))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "n_chars" in plan


def test_store_and_or_matching_and_scaling(spark):
    from qaforge.operators.index import build_index
    docs = spark.createDataFrame([(1, "red apple pie", "en"), (2, "red car", "en"), (3, "apple tree", "de")],
                                 "passage_id long, text string, lang string")
    qs = spark.createDataFrame([(1, "red apple")], "qid long, question string")
    idx = build_index(docs, "word")
    any_ = [r["passage_id"] for r in ST.keyword_retrieve(idx, qs, top_k=10).orderBy("rank").collect()]
    all_ = [r["passage_id"] for r in ST.keyword_retrieve(idx, qs, all_terms_must_match=True).collect()]
    flt = [r["passage_id"] for r in ST.keyword_retrieve(idx, qs, docs, {"lang": "de"}).collect()]
    assert sorted(any_) == [1, 2, 3] and any_[0] == 1
    assert all_ == [1]
    assert flt == [3]
    scores = [r["score"] for r in ST.keyword_retrieve(idx, qs).collect()]
    assert all(0.0 < s < 1.0 for s in scores)


def test_tfidf_store_rejects_filters_and_scaling():
    with pytest.raises(NotImplementedError):
        ST.tfidf_store_guard(filters={"lang": "en"})
    with pytest.raises(NotImplementedError):
        ST.tfidf_store_guard(scale_score=True)


def test_highlight(spark):
    df = spark.createDataFrame([("The Red-apple, red!", ["red", "apple"])], "t string, terms array<string>")
    got = df.select(ST.highlight(F.col("t"), F.col("terms")).alias("h")).first()["h"]
    assert got == "The <em>Red</em>-<em>apple</em>, <em>red</em>!"


EX = "id string, question string, context string, document_id long, answers struct<text:array<string>,answer_start:array<int>>"


def test_label_rows_and_aggregation(spark):
    ex = spark.createDataFrame([("a", "q1", "ctx", 1, (["x", "y"], [0, 2])), ("b", "q2", "ctx", 1, ([], []))], EX)
    labels = PR.label_rows(ex)
    rows = sorted((r["id"], r["answer"], r["no_answer"]) for r in labels.collect())
    assert rows == [("a", "x", False), ("a", "y", False), ("b", "", True)]
    agg = PR.aggregate_labels(labels).collect()
    assert [(r["query"], r["n_labels"], r["answers"], r["document_ids"]) for r in agg] == [("q1", 2, ["x", "y"], [1])]


def test_squad_record_without_answer_is_impossible(spark):
    ex = spark.createDataFrame([("b", "q2", "ctx", 1, ([], []))], EX).withColumn("title", F.lit("t"))
    rec = PR.squad_records(ex).first()["record"]
    qa = rec["paragraphs"][0]["qas"][0]
    assert qa["answers"] == [] and qa["is_impossible"] is True


def test_answer_metrics_golds_and_missing(spark):
    gold = spark.createDataFrame([("a", (["Seoul", "서울"],)), ("b", ([],)), ("c", (["x"],))],
                                 "id string, answers struct<text:array<string>>")
    preds = spark.createDataFrame([("a", "서울"), ("b", "anything")], "id string, prediction_text string")
    per = {r["id"]: r for r in MT.per_question(gold, preds).collect()}
    assert per["a"]["em"] == 1.0 and per["a"]["f1"] == 1.0        # best gold counts
    assert per["b"]["em"] == 0.0 and per["b"]["f1"] == 0.0        # no gold -> 0
    assert per["c"]["answered"] is False and per["c"]["em"] == 0.0
    assert [r["id"] for r in MT.unanswered(gold, preds).collect()] == ["c"]
    rep = MT.report(MT.per_question(gold, preds)).first()
    assert rep["em"] == pytest.approx(1 / 3)
    assert '"EM":{"value":"33.33%","rank":true,"decs":true}' in rep["report"]


def test_curriculum_empty_is_hard(spark):
    gold = spark.createDataFrame([("a", ([""],)), ("b", (["x"],)), ("c", (["y"],))],
                                 "id string, answers struct<text:array<string>>")
    preds = spark.createDataFrame([("a", ""), ("b", "x"), ("c", "z")], "id string, prediction_text string")
    pairs = PR.difficulty_pairs(preds, gold)
    split = {r["id"]: r["difficulty"] for r in PR.curriculum_split(gold, pairs).collect()}
    assert split == {"a": "hard", "b": "easy", "c": "hard"}


def test_word_splits_pack_sentences(spark):
    text = "One two three. Four five.  Six seven eight nine ten eleven.\n\n\n\nTwelve."
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = [(r["split_idx"], r["n_words"], r["content"]) for r in PR.split_words(df, split_length=5)
           .orderBy("split_idx").collect()]
    assert got == [(0, 5, "One two three. Four five."),
                   (1, 6, "Six seven eight nine ten eleven."),     # longer sentence stays whole
                   (2, 1, "Twelve.")]


def test_minmax_constant_and_single(spark):
    df = spark.createDataFrame([(1, "a", 1, 10, 2.0), (1, "a", 2, 11, 2.0), (2, "a", 1, 12, 5.0)],
                               "qid long, retriever string, rank int, passage_id long, score double")
    got = {(r["qid"], r["passage_id"]): r["scaled"] for r in EN.minmax_scaled(df).collect()}
    assert got == {(1, 10): 0.0, (1, 11): 0.0, (2, 12): 0.0}


def test_ensemble_keeps_max_and_tie_order(spark):
    schema = "qid long, rank int, passage_id long, score double"
    a = spark.createDataFrame([(1, 1, 7, 3.0), (1, 2, 8, 1.0)], schema)
    b = spark.createDataFrame([(1, 1, 8, 9.0), (1, 2, 7, 1.0)], schema)
    c = spark.createDataFrame([(1, 1, 9, 4.0), (1, 2, 7, 2.0)], schema)
    got = [(r["passage_id"], r["score"]) for r in EN.max_merge({"a": a, "b": b, "c": c}, 3)
           .orderBy("rank").collect()]
    # scaled: a: 7->1, 8->0; b: 8->1, 7->0; c: 9->1, 7->0 -> ties at 1.0 in list order
    assert got == [(7, 1.0), (8, 1.0), (9, 1.0)]
    assert EN.short_queries(EN.max_merge({"a": a}, 3), 3).count() == 1


def test_ranking_metrics(spark):
    ranked = spark.createDataFrame([(1, 1, 10), (1, 2, 11), (1, 3, 12), (2, 1, 20), (2, 2, 21), (3, 1, 30)],
                                   "qid long, rank int, passage_id long")
    gold = spark.createDataFrame([(1, 10), (1, 12), (2, 99), (3, 30), (3, 31)], "qid long, passage_id long")
    m = RV.ranking_metrics(ranked, gold).first()
    assert m["n_questions"] == 3
    assert m["recall_single_hit"] == pytest.approx(2 / 3)
    assert m["mrr"] == pytest.approx((1 + 0 + 1) / 3)
    ap1 = (1 / 1 + 2 / 3) / 2
    ap3 = (1 / 1) / 2
    assert m["map"] == pytest.approx((ap1 + 0 + ap3) / 3, abs=1e-6)


def test_containing_passages_matches_brute_force(spark, sf0001):
    from qaforge.operators.index import build_index
    from qaforge.sources import fixtures as FX
    psg = FX.passages(spark, sf0001)
    qs = FX.questions(spark, sf0001)
    idx = build_index(psg)
    got = sorted(tuple(r) for r in RV.containing_passages(qs, psg, idx).collect())
    texts = [(r["passage_id"], r["text"]) for r in psg.collect()]
    want = sorted((q["qid"], p) for q in qs.collect() for p, t in texts if q["question"] in t)
    assert got == want and len(want) > 0


def test_keyword_batch_one_filter_per_query(spark):
    from qaforge.operators.index import build_index
    docs = spark.createDataFrame([(1, "red apple pie", "en"), (2, "red car", "en"), (3, "red tree", "de")],
                                 "passage_id long, text string, lang string")
    qs = spark.createDataFrame([(1, "red"), (2, "red")], "qid long, question string")
    idx = build_index(docs, "word")
    got = ST.keyword_retrieve_batch(idx, qs, docs, [{"lang": "de"}, {"lang": "en"}],
                                     spark.createDataFrame([(1, 0), (2, 1)], "qid long, filter_id int")).collect()
    by_q = {}
    for r in got:
        by_q.setdefault(r["qid"], set()).add(r["passage_id"])
    assert by_q == {1: {3}, 2: {1, 2}}


def test_keyword_batch_shared_and_missing_filters(spark):
    from qaforge.operators.index import build_index
    docs = spark.createDataFrame([(1, "red apple pie", "en"), (2, "red car", "en"), (3, "red tree", "de")],
                                 "passage_id long, text string, lang string")
    qs = spark.createDataFrame([(1, "red"), (2, "red"), (3, "red")], "qid long, question string")
    idx = build_index(docs, "word")
    got = ST.keyword_retrieve_batch(idx, qs, docs, [{"lang": "de"}],
                                     spark.createDataFrame([(1, 0), (2, 0)], "qid long, filter_id int")).collect()
    by_q = {}
    for r in got:
        by_q.setdefault(r["qid"], set()).add(r["passage_id"])
    assert by_q == {1: {3}, 2: {3}, 3: {1, 2, 3}}     # query 3 has no filter
