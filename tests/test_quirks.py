"""One test per reference quirk whose fixed behaviour is not covered elsewhere
(SURVEY 2.14). Covered elsewhere: Q6 (test_vectors_plans), Q8
(test_reading alignment), Q9 (curriculum), Q11/Q10 (test_io sinks), Q12
(SQuAD record), Q13 (answer metrics)."""

import pytest

from qaforge.operators import ensemble as EN
from qaforge.operators import retrieve as R
from qaforge.operators import spans as SP
from qaforge.operators.corpus import distinct_passages
from qaforge.operators.index import build_index, build_tfidf_index
from qaforge.sources import index_store as IS

DOCS = [(1, "apple banana"), (2, "banana cherry"), (3, "cherry date"), (4, "date apple fig")]


def test_q1_q2_q4_single_question_is_a_one_row_table(spark):
    docs = distinct_passages(spark.createDataFrame(DOCS, "doc_id long, text string"))
    one = spark.createDataFrame([(7, "apple fig")], "qid long, question string")
    many = spark.createDataFrame([(7, "apple fig"), (8, "cherry")], "qid long, question string")
    bm, tf = build_index(docs), build_tfidf_index(docs)

    def lists(q):
        return {"tfidf": R.tfidf_topk(tf, q, 2), "bm25": R.bm25_topk(bm, q, 2),
                "bm25_plus": R.bm25_topk(bm, q, 2, "plus")}

    single = [tuple(r) for r in EN.max_merge(lists(one), 2).orderBy("rank").collect()]
    batch = [tuple(r) for r in EN.max_merge(lists(many), 2).where("qid = 7").orderBy("rank").collect()]
    assert single == batch
    # Q3: a real top-k (3 of the 4 matching passages), not a count of response keys
    four = spark.createDataFrame([(9, "apple cherry")], "qid long, question string")
    assert R.server_topk(build_index(docs, "word"), four, 3).count() == 3


def test_q14_every_candidate_empty_gives_empty_string(spark):
    ex = spark.createDataFrame([(1, "1", "q", "ab", ([], []))],
                               "example_id long, id string, question string, context string, "
                               "answers struct<text:array<string>,answer_start:array<int>>")
    # only the null candidate exists (no context offsets): n-best = [empty-fallback, null]
    fdf = spark.createDataFrame([(1, 0, [None, None], [1.0, 0.5], [1.0, 0.5])],
                                "example_id long, window int, offsets array<struct<s:int,e:int>>, "
                                "start_logits array<double>, end_logits array<double>")
    nb = SP.nbest(fdf, ex, with_null=True)
    texts = [r["text"] for r in nb.orderBy("rank").collect()]
    assert texts == ["empty", ""]
    r = SP.null_odds(nb).first()
    assert r["prediction_text"] in ("", "empty")
    assert r["score_diff"] == pytest.approx(2.0)


def test_q15_settings_argument_wins(spark):
    import uuid
    tag = uuid.uuid4().hex[:8]          # managed-table folders outlive a session
    df = spark.createDataFrame([(1, "x")], "passage_id long, document_text string")
    IS.drop_index_table(spark, f"q15_index_{tag}")
    assert IS.create_index_table(df, f"q15_index_{tag}", {"analyzer": "word", "similarity": "bm25"})
    assert IS.index_properties(spark, f"q15_index_{tag}")["analyzer"] == "word"
    assert not IS.create_index_table(df, f"q15_index_{tag}")          # create-if-absent keeps it
    assert f"q15_index_{tag}" in IS.list_index_tables(spark)
    stored, rejected = IS.write_with_rejects(
        spark.createDataFrame([(1, "ok"), (2, None)], "passage_id long, document_text string"),
        __import__("pyspark.sql.functions", fromlist=["col"]).col("document_text").isNotNull(),
        f"q15_loaded_{tag}", f"q15_rejects_{tag}")
    assert (stored, rejected) == (1, 1)
    IS.drop_index_table(spark, f"q15_index_{tag}")
    assert f"q15_index_{tag}" not in IS.list_index_tables(spark)
