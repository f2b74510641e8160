"""Importance resampling, embedding whitening and removal of repeated word runs."""

import hashlib
import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from qaforge.llm import embedding_whitening as EW
from qaforge.llm import importance_resample as IR
from qaforge.llm import queries
from qaforge.llm import substring_automata as SA


# --- importance resampling -----------------------------------------------------

def _words(rng, n, vocabulary=300):
    return " ".join(f"w{min(int(rng.expovariate(0.03)), vocabulary)}" for _ in range(n))


def _resample(spark, rows, target, **kw):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("rank", F.lit("x")).withColumn("serial", F.lit(0)).repartition(3)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    out = IR.resample(docs, goal, IR.Setting(**kw))
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {t for _, t in out.dtypes} == {"bigint"}
    return sorted((tuple(r) for r in out.collect()), key=repr)


@pytest.mark.parametrize("kw", [{}, {"percent": 50, "least": 1, "buckets": 97}, {"most": 3, "percent": 100, "least": 5, "seed": 7}])
def test_resample_matches_brute_force(spark, monkeypatch, kw):
    monkeypatch.setattr(IR, "OVERSAMPLE", 2)
    rng = random.Random(1)
    rows = [(i, _words(rng, rng.choice([0, 3, 19, 20, 60, 200]))) for i in range(300)]
    rows += [(900 + i, "Ärger, É-mail 7x NOT_a_word " * 9) for i in range(40)]  # one weight for many
    rows += [(1000, None), (1001, ""), (None, _words(rng, 40)), (5, rows[5][1])]
    target = [_words(rng, 30, 20), None, "é-mail"]
    got, want = _resample(spark, rows, target, **kw), brute.resampled(rows, target, **kw)
    loose = lambda x: [r if r[0] != 5 else r[:4] for r in x]  # the two equal rows may swap ranks
    assert sorted(loose(got), key=repr) == sorted(loose(want), key=repr)
    ranks = sorted(r[4] for r in got if r[4])
    assert ranks == list(range(1, len(ranks) + 1))


def test_resample_hot_id_and_empty_tables(spark):
    rows = [(7, "one two three " * 10)] * 200 + [(i, "four five six " * 10) for i in range(100, 200)]
    got = _resample(spark, rows, [], percent=50)
    assert sorted(r[4] for r in got if r[4]) == list(range(1, 151))
    hot = sorted(r[4] for r in got if r[0] == 7 and r[4])  # one score: neighbours, unless the draw ends among them
    assert hot == list(range(hot[0], hot[0] + len(hot))) and (len(hot) == 200 or hot[-1] == 150)
    assert _resample(spark, [], ["a b"]) == []
    assert _resample(spark, [(1, None)], ["a"]) == brute.resampled([(1, None)], ["a"])


def test_resample_long_text_in_pieces(monkeypatch):
    text = " ".join(f"Wort{i % 37}" for i in range(500)) + " " + "x" * 300
    for most in (1, 3):
        want = [b for _, p in IR.features(text, IR.Setting(most=most)) for b in p]
        monkeypatch.setattr(IR, "PIECE", 64)
        parts = list(IR.features(text, IR.Setting(most=most)))
        monkeypatch.undo()
        assert len(parts) > 10 and sum(n for n, _ in parts) == 501
        assert sorted(b for _, p in parts for b in p) == sorted(want)


# --- whitening -----------------------------------------------------------------

def _whiten_brute(rows, k):
    x = np.array([[int(np.floor(1024 * float(c))) + 100_000 for c in v] for _, v in rows], object)
    n, s = len(x), x.sum(0)
    y = n * x - s
    centred = y.astype(float) / n
    values, parts = np.linalg.eigh(centred.T @ centred / n)
    values, parts = values[::-1], parts[:, ::-1]
    return n, (y * y).sum(1), centred @ parts[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


def _whiten(spark, rows, **kw):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("n", F.lit("x")).repartition(3)
    return EW.whiten(table, **kw).orderBy("vec_id", "component").collect()


@pytest.mark.parametrize("width, k", [(12, 8), (5, 8), (7, 3)])
def test_whitening_matches_eigh(spark, width, k):
    rng = np.random.default_rng(width)
    mix = rng.normal(size=(width, width))
    good = [(i, [float(c) for c in np.float32(mix @ rng.normal(size=width) + 3)]) for i in range(90)] + [(3, [0.5] * width)]
    bad = [(200, None), (201, [None] + [0.0] * (width - 1)), (202, [float("nan")] * width), (203, [float("inf")] * width),
           (204, []), (205, [1.0] * (width + 1)), (206, [1e30] * width)]
    got = _whiten(spark, good + bad, components=k)
    order = sorted(range(len(good)), key=lambda i: good[i][0])
    n, deviation, white, explained = _whiten_brute(good, k)
    k = min(k, width)
    assert len(got) == len(good) * k and {r["n"] for r in got} == {n}
    for c in range(k):
        mine = [r for r in got if r["component"] == c + 1]
        a, b = np.array([r["whitened"] for r in mine if r["vec_id"] != 3]), np.array([white[i, c] for i in order if good[i][0] != 3])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-9
        assert abs(mine[0]["explained"] / explained[c] - 1) < 1e-9
    assert [int(deviation[i]) for i in order if good[i][0] != 3] == [r["deviation"] for r in got if r["component"] == 1 and r["vec_id"] != 3]
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9


def test_whitening_rank_and_empty(spark):
    line = [(i, [float(i), 2.0 * i, -1.0 * i]) for i in range(20)]
    assert {r["component"] for r in _whiten(spark, line)} == {1}
    assert _whiten(spark, [(1, [1.0, 2.0])] * 5) == [] and _whiten(spark, [(1, [1.0, 2.0])]) == [] and _whiten(spark, []) == []


def test_whitening_far_from_the_origin_is_exact(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(c) for c in np.float32(2.0 ** 22 + rng.integers(-4, 5, 3))]) for i in range(60)]
    _, deviation, white, _ = _whiten_brute(rows, 3)
    got = _whiten(spark, rows)
    assert [r["deviation"] for r in got if r["component"] == 1] == [int(d) for d in deviation]
    a = np.array([r["whitened"] for r in got]).reshape(-1, 3)
    assert np.abs(a * np.sign((a * white).sum(0)) - white).max() < 1e-9 and got[0]["identity_error"] < 1e-9


def test_jacobi_with_equal_values():
    values, parts = EW.one_sided_jacobi(EW.pivoted_cholesky(np.diag([2.0, 5.0, 2.0, 0.0])))
    assert np.allclose(values, [5, 2, 2]) and np.allclose(parts @ parts.T, np.eye(3))


# --- suffix automata --------------------------------------------------------------

def _dedup(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("first", F.lit("x")).withColumn("h1", F.lit(0)).repartition(3)
    out = SA.dedup_runs(docs)
    got = [tuple(r) for r in out.collect()]
    assert all(hashlib.sha256(kept.encode()).hexdigest() == digest for _, kept, _, _, digest in got)
    return sorted(((d, n, gone, kept) for d, kept, n, gone, _ in got), key=repr)


def _corpus(seed):
    rng = random.Random(seed)
    some = lambda n: [rng.choice(["the", "of", "a", f"x{rng.randrange(400)}", f"é{rng.randrange(60)}"]) for _ in range(n)]
    shared = [some(n) for n in (49, 50, 51, 70, 130)]
    rows = [(i, " ".join(some(rng.randrange(30)) + sum(([*rng.choice(shared), *some(rng.randrange(3))] for _ in range(rng.randrange(3))), [])
                         + some(rng.randrange(200)))) for i in range(60)]
    base = some(300)
    for i in range(60, 75):  # near copies
        edited = list(base)
        for _ in range(rng.randrange(8)):
            edited[rng.randrange(300)] = f"y{rng.randrange(9)}"
        rows.append((i, (" " * rng.randrange(1, 3)).join(edited)))
    rows += [(80, rows[62][1]), (81, rows[62][1]), (62, rows[62][1]), (90, " ".join(["again"] * 200)), (91, " ".join(["again"] * 70)),
             (92, " ".join(base[:120] + base[:120])), (None, rows[3][1] + " " + " ".join(base)), (None, " ".join(base[5:90])),
             (95, None), (96, ""), (97, " \n "), (98, "short\ttext"), (70, " ".join(shared[4]))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, hot, shard, rows", [(1, 500, 1500, 300_000), (2, 3, 5, 0), (3, 2, 1500, 0), (4, 500, 1, 300_000)])
def test_automata_match_brute_force(spark, monkeypatch, seed, hot, shard, rows):
    for name, value in (("HOT", hot), ("SHARD", shard), ("PLACE_ROWS", rows)):
        monkeypatch.setattr(SA, name, value)
    docs = _corpus(seed)
    assert _dedup(spark, docs) == sorted(brute.repeated_runs(docs), key=repr)


def test_automata_empty_and_long(spark):
    assert _dedup(spark, []) == []
    long = " ".join(f"v{i * i % 9973}" for i in range(60_000))
    docs = [(1, long), (2, "a b c " + long[1000:300_000] + " end"), (3, "z" * 5000 + " " + long)]
    assert _dedup(spark, docs) == sorted(brute.repeated_runs(docs), key=repr)


def test_matching_statistics():
    rng = random.Random(0)
    for _ in range(60):
        known = [[rng.choice("ab") for _ in range(rng.randrange(1, 12))] for _ in range(4)]
        shard = SA.Automaton()
        for words in known:
            shard.add(words)
        text = [rng.choice("abc") for _ in range(20)]
        held = {tuple(w[i:j]) for w in known for i in range(len(w)) for j in range(i, len(w) + 1)} | {()}
        want = [max(n for n in range(i + 2) if tuple(text[i + 1 - n:i + 1]) in held) for i in range(20)]
        assert list(shard.statistics(text)) == want


def test_whole_tables_have_every_row(spark, sf0001):
    docs = spark.read.parquet(f"{sf0001}/documents.parquet")
    for name in ("op11_importance_resample", "op13_substring_automata"):
        got = queries.QUERIES[name](spark, sf0001)
        assert got.select("doc_id").exceptAll(docs.select("doc_id")).count() == 0 and got.count() == docs.count()
