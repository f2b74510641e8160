"""Readers, writers, index store and the question stream."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from qaforge.operators import retrieve as R
from qaforge.operators.index import build_index
from qaforge.sources import index_store as IS
from qaforge.sources import readers as RD
from qaforge.sources import sinks as SK


def tmpdir():
    return tempfile.mkdtemp(prefix="qaforge-test-", dir="/tmp")


def test_corpus_object_and_defaults(spark):
    d = tmpdir()
    obj = {"0": {"text": "first doc", "title": "T0"},
           "1": {"text": "second doc", "url": "http://x", "document_id": "77"}}
    with open(os.path.join(d, "wiki.json"), "w") as f:
        json.dump(obj, f)
    docs = RD.to_documents(RD.read_corpus_object(spark, os.path.join(d, "wiki.json")))
    rows = {r["id"]: r for r in docs.collect()}
    assert rows["0"]["content"] == "first doc" and rows["0"]["meta"]["url"] == ""
    assert rows["0"]["meta"]["document_id"] == "0" and rows["0"]["meta"]["title"] == "T0"
    assert rows["77"]["meta"]["url"] == "http://x"


def test_csv_split_and_answers_parse(spark):
    d = tmpdir()
    path = os.path.join(d, "valid.csv")
    with open(path, "w") as f:
        f.write('id,question,answers\n')
        f.write('"a","What, exactly?","{\'text\': [""it\'s""], \'answer_start\': [3]}"\n')
        f.write('"b","multi\nline","{\'text\': [], \'answer_start\': []}"\n')
    df = RD.read_csv_split(spark, path).withColumn("parsed", RD.parse_answers(F.col("answers")))
    rows = {r["id"]: r for r in df.collect()}
    assert rows["a"]["question"] == "What, exactly?"
    assert rows["a"]["parsed"]["text"] == ["it's"] and rows["a"]["parsed"]["answer_start"] == [3]
    assert rows["b"]["question"] == "multi\nline" and rows["b"]["parsed"]["text"] == []


def test_resolve_and_project(spark):
    df = spark.createDataFrame([("1", "q", "x")], "c0 string, c1 string, extra string")
    assert RD.resolve_column(df, "question", 1) == "c1"
    out = RD.project_to(df.withColumnRenamed("c0", "id").withColumnRenamed("c1", "question"),
                        RD.PREDICT_SCHEMA)
    assert out.columns == ["id", "question"]


def test_sinks_roundtrip(spark):
    d = tmpdir()
    preds = spark.createDataFrame([("a", "x"), ("b", "")], "id string, prediction_text string")
    SK.write_predictions(preds, None, None, d, prefix="test")
    back = sorted(tuple(r) for r in spark.read.json(f"{d}/test_predictions").select("id", "prediction_text").collect())
    assert back == [("a", "x"), ("b", "")]
    split = spark.createDataFrame([("a", "easy"), ("b", "hard")], "id string, difficulty string")
    SK.write_by_difficulty(split, f"{d}/curri")
    assert sorted(os.listdir(f"{d}/curri"))[:2] == ["_SUCCESS", "difficulty=easy"] or \
        "difficulty=easy" in os.listdir(f"{d}/curri")
    SK.export_csv(spark.createDataFrame([("a", (["x"], [0]))],
                                        "id string, answers struct<text:array<string>,answer_start:array<int>>"),
                  f"{d}/csv")
    got = RD.read_csv_split(spark, f"{d}/csv").first()
    assert json.loads(got["answers"]) == {"text": ["x"], "answer_start": [0]}


def test_index_store_reuse_and_staleness(spark):
    d = tmpdir()
    psg = spark.createDataFrame([(1, "a b c"), (2, "b c d")], "passage_id long, text string")
    idx = IS.load_or_build(spark, psg, f"{d}/idx", build_index)
    assert idx.n_docs == 2
    again = IS.load_or_build(spark, psg, f"{d}/idx", lambda p: (_ for _ in ()).throw(AssertionError("rebuilt")))
    assert again.n_docs == 2                                    # fingerprint matched: reused
    changed = spark.createDataFrame([(1, "a b c"), (2, "b c e")], "passage_id long, text string")
    rebuilt = IS.load_or_build(spark, changed, f"{d}/idx", build_index)
    assert sorted(r["term"] for r in rebuilt.vocab.collect()) == ["a", "b", "c", "e"]
    old = IS.fingerprint(psg.withColumn("g", F.lit(1)), by=["g"])
    new = IS.fingerprint(changed.withColumn("g", F.lit(1)), by=["g"])
    assert IS.stale_groups(old, new, ["g"]).count() == 1
    assert IS.stale_groups(old, old, ["g"]).count() == 0


def test_question_stream_matches_batch(spark):
    from qaforge.streaming.questions import retrieve_stream
    d = tmpdir()
    psg = spark.createDataFrame([(1, "red apple pie"), (2, "red car"), (3, "apple tree"), (4, "blue sky")],
                                "passage_id long, text string")
    idx = build_index(psg)
    qs = spark.createDataFrame([(1, "red apple"), (2, "sky"), (3, "tree car")], "qid long, question string")
    qs.repartition(2).write.parquet(f"{d}/in")
    q = retrieve_stream(spark, idx, f"{d}/in", f"{d}/out", k=2, checkpoint=f"{d}/ckpt")
    q.awaitTermination(120)
    got = sorted(tuple(r) for r in spark.read.parquet(f"{d}/out").select("qid", "rank", "passage_id").collect())
    want = sorted(tuple(r) for r in R.bm25_topk(idx, qs, 2).select("qid", "rank", "passage_id").collect())
    assert got == want


def test_stage_results_export(spark):
    d = tmpdir()
    stages = {"retriever": spark.createDataFrame([(1, 0.5)], "qid long, recall double"),
              "reader": spark.createDataFrame([("a", 1.0)], "id string, em double")}
    SK.save_stage_results(stages, d)
    got = RD.read_csv_split(spark, f"{d}/reader").collect()
    assert [(r["id"], r["em"]) for r in got] == [("a", "1.0")]
    assert sorted(os.listdir(d)) == ["reader", "retriever"]
