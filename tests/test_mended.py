"""Cases the round's review named: ties, wide keys, unanswered questions, caps, stored indexes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from qaforge import session
from qaforge.operators import ensemble as EN
from qaforge.operators import metrics as MT
from qaforge.operators import relevance as RV
from qaforge.operators import retrieve as R
from qaforge.operators import spans as SP
from qaforge.operators import topk as TK
from qaforge.operators import vector as VE
from qaforge.operators import windows as WN
from qaforge.operators.index import build_index
from qaforge.plans import reading_flow as RF
from qaforge.plans import registry
from qaforge.sources import index_store as IS


def test_equal_vectors_keep_the_smallest_ids(spark):
    rows = [(i, [0.25, 0.5]) for i in range(100)] + [(100 + i, [float(i), 3.0]) for i in range(5)]
    emb = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = VE.build_ivf(emb, centroids=[[0.0, 0.0], [2.0, 3.0]])
    qs = spark.createDataFrame([(1, [0.25, 0.5]), (2, [0.3, 0.5])], "qid long, embedding array<double>")
    for found in (VE.exact_topk(index, qs, 5, nprobe=1), VE.ivf_topk(index, qs, 5, nprobe=2), R.retrieve(index, qs, "vector", 5)):
        ids = {}
        for r in found.orderBy("qid", "rank").collect():
            ids.setdefault(r["qid"], []).append(r[2])
        assert ids == {1: [0, 1, 2, 3, 4], 2: [0, 1, 2, 3, 4]}


def test_exact_search_with_large_norms(spark):
    pick = np.random.default_rng(0)
    x = 1e5 + pick.normal(size=(200, 4))
    emb = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    index = VE.build_ivf(emb, n_cells=4, seed=1)
    qs = emb.where("vec_id < 20").select(F.col("vec_id").alias("qid"), "embedding")
    got = {}
    for r in VE.exact_topk(index, qs, 5, nprobe=1).orderBy("qid", "rank").collect():
        got.setdefault(r["qid"], []).append(r["vec_id"])
    for q in range(20):
        d = np.round(((x - x[q]) ** 2).sum(1), 6)
        assert got[q] == np.lexsort((np.arange(200), d))[:5].tolist()


def test_reader_keeps_passages_with_large_ids_apart(spark):
    passages = spark.createDataFrame([(1_000_005, "one two three"), (5, "alpha beta gamma")], "passage_id long, text string")
    ranked = spark.createDataFrame([(1, 1, 1_000_005, 1.0), (2, 1, 5, 1.0)], "qid long, rank int, passage_id long, score double")
    qs = spark.createDataFrame([(1, "q one"), (2, "q two")], "qid long, question string")
    got = {r["qid"]: (r["passage_id"], r["text"]) for r in RF.read_retrieved(ranked, passages, qs).collect()}
    assert set(got) == {1, 2}
    assert got[1][0] == 1_000_005 and got[1][1] in "one two three"
    assert got[2][0] == 5 and got[2][1] in "alpha beta gamma"


def test_paragraph_keys_of_large_documents(spark):
    doc = (1 << 33) + 7
    key = F.shiftleft(F.lit(doc), registry.PARAGRAPH_BITS) + 3
    row = spark.range(1).select(F.shiftright(key, registry.PARAGRAPH_BITS).alias("d"),
                                key.bitwiseAND(F.lit((1 << registry.PARAGRAPH_BITS) - 1)).alias("p")).first()
    assert (row["d"], row["p"]) == (doc, 3)


def test_unanswered_question_counts_as_zero(spark):
    gold = spark.createDataFrame([("a", (["x y"],)), ("b", (["z"],))], "id string, answers struct<text:array<string>>")
    answers = spark.createDataFrame([("a", 1, "x y")], "id string, rank int, text string")
    m = MT.reader_topk_metrics(answers, gold, k=1).first()
    assert (m["n_questions"], m["em"], m["f1"]) == (2, 0.5, 0.5)


def test_short_golds_by_substring(spark):
    passages = spark.createDataFrame([(1, "xab cdy é"), (2, "ab"), (3, "a b cd"), (4, None)], "passage_id long, text string")
    items = spark.createDataFrame([(1, "ab cd"), (2, "ab"), (3, "é"), (4, ""), (5, "no"), (6, "a b cd")], "qid long, question string")
    got = sorted(map(tuple, RV.containing_passages(items, passages, build_index(passages.na.fill("")), "qid", "question").collect()))
    assert got == [(1, 1), (2, 1), (2, 2), (3, 1), (6, 3)]


def test_fill_below_the_base(spark):
    ids = list(range(0, 600, 3))
    passages = spark.createDataFrame([(i,) for i in ids], "passage_id long")
    below = [(1, i, -1.0) for i in ids[:150]] + [(1, ids[199], 2.0)] + [(2, i, -0.5) for i in ids]
    matched = spark.createDataFrame(below, "qid long, passage_id long, score double")
    base = spark.createDataFrame([(1, 0.0), (2, 0.0), (3, 0.0)], "qid long, base double")
    got = {}
    for r in TK.exhaustive_topk(matched, base, passages, 4, len(ids), True).orderBy("qid", "rank").collect():
        got.setdefault(r["qid"], []).append((r["passage_id"], r["score"]))
    assert got[1] == [(ids[199], 2.0)] + [(i, 0.0) for i in ids[150:153]]
    assert got[2] == [(i, -0.5) for i in ids[:4]] and got[3] == [(i, 0.0) for i in ids[:4]]


def test_max_context_map_rejects_starts(spark):
    rows = [(1, 0, [None, (0, 1), (2, 3), None], [0.0, 9.0, 5.0, 0.0], [0.0, 1.0, 8.0, 0.0], {1: False, 2: True}),
            (2, 0, [None, (0, 1), (2, 3), None], [0.0, 9.0, 5.0, 0.0], [0.0, 1.0, 8.0, 0.0], None)]
    feats = spark.createDataFrame(rows, "example_id long, window int, offsets array<struct<s:int,e:int>>, start_logits array<double>, "
                                        "end_logits array<double>, token_is_max_context map<int,boolean>")
    best = {r["example_id"]: r["s_off"] for r in SP.window_candidates(feats).orderBy("score").collect()}
    assert best == {1: 2, 2: 0}


def test_window_length_is_clamped(spark):
    ex = spark.createDataFrame([(1, "q", " ".join("abcdefghij"))], "example_id long, question string, context string")
    assert WN.context_windows(ex, 100, 2, model_max_len=8).agg(F.max("n_ctx")).first()[0] == 4


def test_strict_modes(spark):
    lists = {m: spark.createDataFrame([(1, 1, 7, 1.0)], "qid long, rank int, passage_id long, score double") for m in ("a", "b")}
    with pytest.raises(ValueError, match="distinct passages"):
        EN.max_merge(lists, 2, strict=True)
    index = build_index(spark.createDataFrame([(1, "a b")], "passage_id long, text string"))
    qs = spark.createDataFrame([(5, "zz")], "qid long, question string")
    with pytest.raises(ValueError, match="no known term"):
        R.unmatched_queries(index, qs, strict=True)


def test_retrieve_by_combined_name(spark):
    passages = spark.createDataFrame([(1, "red fox"), (2, "blue fox"), (3, "green hen")], "passage_id long, text string")
    from qaforge.operators.index import build_tfidf_index
    bm, tf = build_index(passages), build_tfidf_index(passages)
    qs = spark.createDataFrame([(1, "blue fox")], "qid long, question string")
    got = R.retrieve({"tfidf": tf, "bm25": bm, "bm25_plus": bm}, qs, "ensemble", 2).orderBy("rank").collect()
    assert got[0]["passage_id"] == 2


def test_stored_index_opens_without_reading_the_corpus(spark, tmp_path):
    passages = spark.createDataFrame([(1, "red fox"), (2, "blue fox")], "passage_id long, text string")
    key = f"test-{tmp_path.name}"
    IS.shared_index(passages, source_key=key)
    gone = spark.createDataFrame([], passages.schema).withColumn("text", F.raise_error(F.lit("read")).cast("string"))
    assert IS.shared_index(gone, source_key=key).n_docs == 2


def test_cluster_needs_a_shared_folder():
    class Conf(dict):
        def get(self, key, default=None):
            return super().get(key, default)

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_label_table_is_written_counted_and_cleared(spark, tmp_path):
    name = "labels_" + tmp_path.name.replace("-", "_")
    labels = spark.createDataFrame([("q", "a", False), ("q", "b", False)], "query string, answer string, no_answer boolean")
    try:
        assert IS.write_rows(labels, name) == 2 and IS.write_rows(labels, name) == 4
        IS.set_index_properties(spark, name, {"note": "it's a 'label' store"})
        assert IS.index_properties(spark, name)["note"] == "it's a 'label' store"
        IS.clear_table(spark, name)
        assert spark.table(name).count() == 0
    finally:
        IS.drop_index_table(spark, name)
