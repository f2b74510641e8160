"""Storage layout and bounds of the sparse index, segments, keyed stores, vector codes and cells, token batches."""

import glob
import os
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from qaforge import session
from qaforge.operators import bounded as B
from qaforge.operators import relevance as RV
from qaforge.operators import retrieve as R
from qaforge.operators import store as ST
from qaforge.operators import vector as VE
from qaforge.operators import vector_codes as VC
from qaforge.operators import vector_tree as VT
from qaforge.operators.corpus import distinct_passages
from qaforge.operators.index import build_index
from qaforge.plans import reading_flow as RF
from qaforge.sources import fixtures as FX
from qaforge.sources import index_store as IS
from qaforge.sources.keyed_store import KeyedStore
from qaforge.sources.segments import SegmentedIndex

SF001 = "/root/testdata/sf0.01"


def rows(df):
    return sorted(map(tuple, df.collect()))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def corpus(spark, n=300, seed=0, extra=()):
    rng = random.Random(seed)
    texts = [" ".join(f"t{min(int(rng.expovariate(0.08)), 90)}" for _ in range(rng.randrange(1, 60))) for _ in range(n)]
    return spark.createDataFrame([(i, t) for i, t in enumerate([*texts, *extra])], "passage_id long, text string")


def questions(spark, seed=1, n=25):
    rng = random.Random(seed)
    return spark.createDataFrame([(i, " ".join(f"t{min(int(rng.expovariate(0.05)), 120)}" for _ in range(rng.randrange(1, 9))))
                                  for i in range(n)], "qid long, question string")


# --- layout -----------------------------------------------------------------------

def test_pairs_are_summed_without_a_shuffle(spark):
    index, qs = build_index(corpus(spark)), questions(spark)
    plan = plan_of(R.score_bm25(index, qs, "okapi").matched)
    assert "Bucketed: true" in plan and "Exchange hashpartitioning" not in plan


def test_a_batch_opens_the_folders_of_its_terms(spark):
    index = build_index(corpus(spark), parts=32)
    terms = index.vocab.select("term")
    files = [len(R.postings_of(index, terms.orderBy("term").limit(n)).inputFiles()) for n in (1, 8, 90)]
    assert files[0] * 8 < files[2] and files[0] < files[1] < files[2]
    one = terms.orderBy("term").limit(1)
    assert R.postings_of(index, one).join(one, "term").count() == index.postings.join(one, "term").count() > 0


def test_stored_index_opens_in_a_session_without_its_catalog_entry(spark, tmp_path):
    key = f"layout-{tmp_path.name}"
    first = IS.shared_index(corpus(spark), source_key=key)
    want, n = rows(R.bm25_topk(first, questions(spark), 5)), first.postings.count()
    name = first.postings.inputFiles()[0].split("/postings/")[0] + "/postings"
    spark.sql(f"DROP TABLE {session._table_name(name.replace('file://', '') if not spark.conf.get('spark.checkpoint.dir').startswith('file') else name)}")
    again = IS.shared_index(corpus(spark).limit(0), source_key=key)
    assert again.postings.count() == n and rows(R.bm25_topk(again, questions(spark), 5)) == want


def test_temporary_tables_are_dropped(spark):
    kept, mine = list(session._TEMPORARY), session.materialize(spark.range(3))
    path = session._TEMPORARY[-1]
    session._TEMPORARY[:] = [path]
    assert mine.count() == 3 and session.drop_temporary(spark) == 1 and not session.path_exists(spark, path)
    session._TEMPORARY[:] = kept


# --- bounds -----------------------------------------------------------------------

@pytest.mark.parametrize("variant", ["okapi", "plus", "l", "server"])
@pytest.mark.parametrize("share", [0.0, 0.03, 0.5, 1.0])
def test_bounded_scoring_is_exact(spark, variant, share):
    index, qs = build_index(corpus(spark, extra=["", "t0", "t0 t0"]), "word" if variant == "server" else "whitespace"), questions(spark)
    want = R.server_topk(index, qs, 7) if variant == "server" else R.bm25_topk(index, qs, 7, variant)
    assert rows(B.bounded_topk(index, qs, 7, variant, share=share)) == rows(want)


def test_bounds_leave_few_pairs(spark):
    index, qs = build_index(FX.passages(spark, SF001)), FX.questions(spark, SF001)
    terms = session.materialize(B.query_bounds(index, qs, "okapi"))
    pairs, every = B.matched_pairs(index, terms, "okapi", 40).count(), qs.count() * index.n_docs
    assert pairs < 0.2 * every < R.score_bm25(index, qs).matched.count()
    all_rows, lead = B.row_costs(terms)
    assert lead < 0.7 * all_rows and B.worth(100, 39) and not B.worth(100, 41)
    frequent = spark.createDataFrame([(1, "t0 t1 t2 t3 t88")], "qid long, question string")
    index = build_index(corpus(spark, 2000))
    auto = R.bm25_topk(index, frequent, 3, bounded=None)
    assert rows(auto) == rows(R.bm25_topk(index, frequent, 3))


def test_bounds_need_a_positive_floor(spark):
    index = build_index(spark.createDataFrame([(1, "a b"), (2, "a b"), (3, "a c")], "passage_id long, text string"))
    assert R.mean_idf_of(index) < 0 and not B.usable(index, "okapi") and B.usable(index, "plus")
    with pytest.raises(ValueError, match="bounds"):
        B.bounded_topk(index, questions(spark), 2)


# --- dedup, golds, filters ----------------------------------------------------------

def test_dedup_shuffles_no_text(spark, monkeypatch):
    data = [(5, "same", "x"), (3, "same", "y"), (4, "other", None), (3, "same", "w"), (9, None, "z"), (None, "other", "q"), (8, "", "e")]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    got = sorted(map(tuple, distinct_passages(docs, keep=("lang",)).collect()), key=repr)
    assert got == sorted([(3, "same", "w"), (None, "other", "q"), (8, "", "e")], key=repr)
    plan = plan_of(distinct_passages(FX.table(spark, SF001, "documents")))
    assert "SortAggregate" not in plan and "Exchange hashpartitioning" not in plan


def test_terms_containing(spark):
    vocab = spark.createDataFrame([(t,) for t in ("abc", "xabcx", "ab", "σας", "b", "über")], "term string")
    asked = spark.createDataFrame([(t,) for t in ("abc", "AB", "Σ", "σασ", "BE", "zz", "abcd", "Ü")], "token string")
    assert rows(RV.terms_containing(asked, vocab)) == sorted(
        [("abc", "abc"), ("abc", "xabcx"), ("AB", "abc"), ("AB", "xabcx"), ("AB", "ab"), ("Σ", "σας"), ("σασ", "σας"), ("BE", "über"), ("Ü", "über")])


def test_short_golds_match_brute_force(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abAB \n\tς") for _ in range(rng.randrange(12))) for _ in range(80)]
    golds = sorted({"".join(rng.choice("abA \t") for _ in range(rng.randrange(1, 4))) for _ in range(40)} | {"Aς", " ", ""})
    passages = spark.createDataFrame(list(enumerate(texts)), "passage_id long, text string")
    items = spark.createDataFrame(list(enumerate(golds)), "qid long, question string")
    want = sorted((q, p) for q, g in enumerate(golds) for p, t in enumerate(texts) if g and g in t)
    assert rows(RV.containing_passages(items, passages, build_index(passages))) == want


def test_batch_filters_come_before_the_sum(spark):
    docs = corpus(spark).withColumn("lang", F.when(F.col("passage_id") % 3 == 0, "de").otherwise("en")).withColumn("n", F.col("passage_id"))
    index, qs = build_index(docs, "word"), questions(spark)
    filters = [{"lang": "de"}, {"n": {"$gte": 100}}, None]
    kinds = qs.where("qid % 5 <> 4").select("qid", (F.col("qid") % 3).cast("int").alias("filter_id"))
    got = ST.keyword_retrieve_batch(index, qs, docs, filters, kinds)
    plan = plan_of(got)
    assert plan.rindex("array_contains") > plan.rindex("HashAggregate")  # plans print from the result down
    want = []
    for q in range(25):
        f = filters[q % 3] if q % 5 != 4 else None
        want += rows(ST.keyword_retrieve(index, qs.where(F.col("qid") == q), docs, f))
    assert rows(got) == sorted(want)


# --- segments -------------------------------------------------------------------------

def _files(path):
    return {f: (os.path.getmtime(f), os.path.getsize(f)) for f in glob.glob(f"{path}/segments/**/*.parquet", recursive=True)}


def test_segments_equal_a_full_build(spark, tmp_path):
    full, qs, path = corpus(spark, 400), questions(spark), f"{tmp_path}/seg"
    index = SegmentedIndex(spark, path)
    with pytest.raises(ValueError, match="empty"):
        index.open()
    index.add(full.where("passage_id < 390").withColumn("text", F.when(F.col("passage_id") % 40 == 0, F.lit("t1 t2 old")).otherwise(F.col("text"))))
    before = _files(path)
    index.add(full.where("passage_id >= 390 or passage_id % 40 = 0"))
    index.add(spark.createDataFrame([(1000, "t1 t1 t5"), (1001, "zz")], "passage_id long, text string"))
    index.delete(spark.createDataFrame([(1000,), (1001,), (7,)], "passage_id long"))
    index.add(full.where("passage_id = 7"))
    assert {f: before[f] for f in before} == {f: x for f, x in _files(path).items() if f in before}
    built = build_index(full)

    def same(opened):
        assert (opened.n_docs, opened.avgdl) == (built.n_docs, built.avgdl)
        assert rows(opened.vocab.select("term", "df")) == rows(built.vocab.select("term", "df"))
        for variant in ("okapi", "plus"):
            assert rows(R.bm25_topk(opened, qs, 6, variant)) == rows(R.bm25_topk(built, qs, 6, variant))

    same(index.open())
    assert SegmentedIndex(spark, path).merge(below=100) == 2
    same(SegmentedIndex(spark, path).open())
    assert index.merge() == 1 and index.deletes() is None
    same(index.open())
    index.delete(full.select("passage_id"))
    with pytest.raises(ValueError, match="empty"):
        index.open()


# --- keyed store ------------------------------------------------------------------------

def test_keyed_store_policies(spark, tmp_path):
    make = lambda x: spark.createDataFrame(x, "id string, v long")
    store = KeyedStore(spark, f"{tmp_path}/s", "id", 16)
    assert store.rows() is None and store.count() == 0
    assert store.write(make([(f"k{i}", i) for i in range(40)])) == {"new": 40, "repeated": 0, "buckets": len(store.manifest())}
    old = store.manifest()
    with pytest.raises(ValueError, match="in the store"):
        store.write(make([("k1", 5), ("new", 1)]))
    with pytest.raises(ValueError, match="several rows"):
        store.write(make([("n", 1), ("n", 2)]))
    with pytest.raises(ValueError, match="without id"):
        store.write(make([(None, 1)]), "skip")
    assert store.manifest() == old
    assert store.write(make([("k1", 500), ("k1", 600), ("a", 1)]), "skip") | {"buckets": 0} == {"new": 1, "repeated": 1, "buckets": 0}
    touched = {b for b in store.manifest() if store.manifest()[b] != old.get(b)}
    assert len(touched) <= 2 and {b: f for b, f in store.manifest().items() if b not in touched} == {b: f for b, f in old.items() if b not in touched}
    assert store.write(make([("k2", 7), ("k2", 9)]), "overwrite")["repeated"] == 1
    got = dict(rows(store.rows().select("id", "v")))
    assert store.count() == len(got) == 41 and (got["k1"], got["k2"], got["a"], got["k39"]) == (1, 9, 1, 39)
    again = KeyedStore(spark, f"{tmp_path}/s", "id")
    assert again.buckets == 16 and again.vacuum() == 0  # every folder still holds a bucket
    again.write(again.rows().select("id", "v"), "overwrite")
    assert again.vacuum() == 3 and dict(rows(again.rows().select("id", "v"))) == got
    again.clear()
    assert store.count() == 0 and store.rows() is None and store.write(make([("k1", 1)])) == {"new": 1, "repeated": 0, "buckets": 1}


# --- vectors ------------------------------------------------------------------------------

def brute(vectors, queries, k):
    out = []
    for qid, q in queries:
        d = sorted((round(float(((np.array(v) - np.array(q)) ** 2).sum()), 6), i) for i, v in vectors)[:k]
        out += [(qid, r, i, x) for r, (x, i) in enumerate(d, 1)]
    return sorted(out)


@pytest.mark.parametrize("shift", [0.0, 1e6, 1e8])
def test_exact_search_far_from_the_origin_and_with_nulls(spark, shift):
    rng = np.random.default_rng(5)
    good = [(i, [float(x) for x in rng.integers(-50, 50, 6) + shift]) for i in range(300)]
    bad = [(900, None), (901, [None] * 6), (902, [float("nan")] * 6), (903, [float("inf")] * 6), (904, [])]
    table = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>")
    qs = table.where("vec_id % 7 = 0 or vec_id >= 900").withColumnRenamed("vec_id", "qid")
    index = VE.build_ivf(table, n_cells=12, max_iter=4)
    assert sum(index.sizes.values()) == 300
    want = brute(good, [x for x in good if x[0] % 7 == 0], 9)
    assert rows(VE.exact_topk(index, qs, 9, nprobe=1)) == want
    assert rows(VC.coded_topk(VC.build_codes(table), qs, 9, factor=40)) == want
    tree = VT.build_tree(table)
    assert rows(VT.tree_topk(tree, qs, 9, 1000)) == want
    assert VC.recall(VT.tree_topk(tree, qs, 9, VT.probe_for(tree, qs.where("qid < 900"), 9)), VE.exact_topk(index, qs, 9)).first()["recall"] >= 0.85


def test_tree_cells_grow_with_the_square_root(spark):
    rng = np.random.default_rng(0)
    sizes = []
    for n in (100, 1600):
        table = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=4)]) for i in range(n)], "vec_id long, embedding array<double>")
        tree = VT.build_tree(table)
        sizes.append(tree.blocks.count())
        assert tree.vectors.count() == n and tree.vectors.select("vec_id").distinct().count() == n
        assert "array(array(" not in plan_of(VT.probed_cells(tree, table.withColumnRenamed("vec_id", "qid"), 2)).lower()
    assert sizes[0] <= 12 and 30 <= sizes[1] <= 42


def test_codes_of_constant_and_empty_tables(spark):
    table = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(5)], "vec_id long, embedding array<double>")
    got = VC.coded_topk(VC.build_codes(table), table.withColumnRenamed("vec_id", "qid"), 2)
    assert [r[2] for r in rows(got) if r[1] == 1] == [0, 1, 2, 3, 4]
    none = table.limit(0)
    assert VC.coded_topk(VC.build_codes(none), none.withColumnRenamed("vec_id", "qid"), 2).count() == 0


# --- token batches --------------------------------------------------------------------------

def test_windows_of_like_length_share_a_batch(spark):
    rng = random.Random(2)
    lengths = [rng.choice([5, 9, 40, 200, 500]) for _ in range(400)]
    frame = pd.DataFrame({"n_tokens": sorted(lengths), "x": range(400)})
    batches = list(RF.in_token_batches(iter([frame.iloc[:7], frame.iloc[7:300], frame.iloc[300:]]), 1000))
    padded = sum(len(b) * b["n_tokens"].max() for b in batches)
    assert [x for b in batches for x in b["x"]] == list(range(400)) and all(len(b) * b["n_tokens"].max() <= 1000 for b in batches)
    unsorted = sum(max(lengths[i:i + 4]) * len(lengths[i:i + 4]) for i in range(0, 400, 4))
    assert padded < 1.3 * sum(lengths) < unsorted
    assert len(list(RF.in_token_batches(iter([pd.DataFrame({"n_tokens": [3, 5000]})]), 100))) == 2
    assert list(RF.in_token_batches(iter([]), 10)) == []


def test_scorer_gets_batches_and_answers_stay_equal(spark):
    from qaforge.plans.registry import standin_scorer

    passages = corpus(spark, 60)
    qs = questions(spark, n=6)
    ranked = R.bm25_topk(build_index(passages), qs, 4)
    plain, batched = (rows(RF.read_retrieved(ranked, passages, qs, max_len=160, **kw)) for kw in ({}, {"scorer": standin_scorer}))
    assert plain == batched and len(plain) == 6
