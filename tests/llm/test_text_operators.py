"""Language ID, line dedup, substring dedup, decontamination and the Jaccard join against brute force."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from qaforge.llm import decontaminate, jaccard_join, language_id, line_dedup, suffix_dedup

SCHEMA = "doc_id long, text string"
CLASH = "doc_id long, text string, row string, _t long, _gone string, node long, t int, _bad int, n int"


def clashing(spark, rows):
    """The rows with columns that bear the operators' own helper names."""
    return spark.createDataFrame([(*r, "x", 1, "y", 2, 3, 4, None) for r in rows], CLASH)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def near_rows():
    pick = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    base, rows = [pick.choice(vocabulary) for _ in range(60)], []
    for i in range(160):
        w = list(base)
        for _ in range(pick.choice([0, 1, 1, 2, 3, 4])):
            w[pick.randrange(60)] = pick.choice(vocabulary)
        if i % 5 == 0:
            w = w[:40] + [pick.choice(vocabulary) for _ in range(20)]
        if i % 7 == 0:
            base = w
        rows.append((i, " ".join(w).upper() if i % 11 == 0 else " ".join(w)))
    rows += [(1000 + i, " ".join(pick.choice(vocabulary) for _ in range(pick.randrange(0, 30)))) for i in range(40)]
    rows += [(2000, None), (2001, ""), (2002, " \n\t"), (2003, rows[3][1]), (None, rows[4][1]), (2004, "a b"), (2005, "A  B"), (2006, "a b")]
    return rows + [rows[9]]


@pytest.mark.parametrize("block, hot", [(4096, 50_000), (24, 50_000), (24, 0)])
def test_jaccard_join(spark, near_rows, monkeypatch, block, hot):
    monkeypatch.setattr(jaccard_join, "HOT_REGIONS", hot)
    monkeypatch.setattr(jaccard_join, "LEAST_BLOCK", min(block, 256))
    monkeypatch.setattr(jaccard_join, "MOST_BLOCK", block)
    monkeypatch.setattr(jaccard_join, "PIVOTS", 4)
    got = rows_of(jaccard_join.join_documents(spark.createDataFrame(near_rows, SCHEMA)))
    assert got == sorted(brute.components(near_rows), key=str)


def test_connect_equals_all_pairs():
    pick = np.random.default_rng(1)
    for _ in range(40):
        base = [np.unique(pick.integers(0, 400, 40)) for _ in range(4)]
        sets = []
        for _ in range(25):
            u = base[pick.integers(4)]
            u = np.unique(np.r_[u[pick.random(len(u)) < pick.choice([0.8, 0.95, 1])], pick.integers(0, 400, pick.integers(0, 5))])
            sets.append(u.astype(np.uint64))
        root = list(range(25))
        for _ in range(25):
            for i in range(25):
                for j in range(25):
                    both = len(np.intersect1d(sets[i], sets[j]))
                    if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                        root[i] = root[j] = min(root[i], root[j])
        assert jaccard_join.connect(sets).tolist() == root


def test_keep_one(spark, near_rows):
    kept = rows_of(jaccard_join.keep_one(clashing(spark, near_rows)).select("doc_id", "text"))
    groups = {(r[0], t): (c, n) for (r, (_, t)) in zip(brute.components(near_rows), near_rows) for c, n in [(r[2], r[1])]}
    want = sorted({(d, t) for (d, t), (c, n) in groups.items() if not n or d == c}, key=str)
    assert kept == want


def test_keep_one_of_every_component(spark):
    text = lambda name: " ".join(f"{name}{i}" for i in range(60))
    rows = [(5, text("a")), (8, text("a") + " end"), (5, text("b")), (9, text("b") + " end"),  # one id in two components
            (None, text("c")), (None, text("c") + " end"), (None, text("d")), (None, text("d")), (None, text("e"))]
    kept = jaccard_join.keep_one(clashing(spark, rows)).select("doc_id", "text").collect()
    assert sorted((r["text"].split()[0][0], r["doc_id"]) for r in kept) == [("a", 5), ("b", 5), ("c", None), ("d", None), ("e", None)]


def test_jaccard_join_empty(spark):
    assert jaccard_join.join_documents(spark.createDataFrame([], SCHEMA)).collect() == []
    assert jaccard_join.keep_one(spark.createDataFrame([], SCHEMA)).collect() == []


def test_decontaminate(spark):
    pick = random.Random(2)
    word = lambda n: " ".join(f"w{pick.randrange(500)}" for _ in range(n))
    items = [(i, word(pick.choice([5, 12, 40]))) for i in range(12)] + [(50, None), (51, ""), (52, "two words"), (None, word(9))]
    items.append(items[3])
    docs = [(0, None), (1, ""), (2, "Two  WORDS"), (3, word(4000) + " " + items[1][1].upper() + " " + word(4000))]
    for i, (_, text) in enumerate(items):
        w = (text or "").split()
        docs += [(10 + i, word(30) + " " + " ".join(w[: len(w) * 9 // 10]) + " " + word(20)), (100 + i, " ".join(w)), (200 + i, word(50))]
    docs += [(None, items[2][1]), (None, word(20)), docs[6]]
    d, b = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string")
    want = brute.leaks(docs, items)
    assert {tuple(r)[:4] for r in decontaminate.leaks(d, b).collect()} == want
    bad = {(i, t) for i, t in docs for x in [brute.leaks([(i, t)], items)] if x}
    left = rows_of(decontaminate.remove_leaking(clashing(spark, docs), b).select("doc_id", "text"))
    assert left == sorted([r for r in docs if r not in bad], key=str)
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.leaks(d, none).count() == 0 and decontaminate.remove_leaking(d, none).count() == len(docs)
    assert decontaminate.leaks(spark.createDataFrame([], SCHEMA), b).count() == 0


def test_decontaminate_shuffled_paths(spark, monkeypatch):
    items = [(i, " ".join(f"w{i}x{k}" for k in range(20))) for i in range(6)]
    docs = [(i, items[i % 6][1] + f" tail {i}") for i in range(60)]
    for name in ("SKETCH_ROWS", "FOUND_ROWS", "GRAM_BYTES"):
        monkeypatch.setattr(decontaminate, name, 0)
    got = decontaminate.leaks(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string"))
    assert {tuple(r)[:4] for r in got.collect()} == brute.leaks(docs, items)


@pytest.fixture(scope="module")
def line_rows():
    pick = random.Random(4)
    lines = [" ".join(pick.choice("abcdefgh") * pick.randrange(1, 5) for _ in range(6)) for _ in range(60)] + ["", " ", "\t"]
    rows = []
    for i in range(80):
        a = pick.randrange(50)
        rows.append((i, "\n".join(pick.sample(lines, pick.randrange(0, 6)) + lines[a:a + pick.randrange(2, 12)])))
    return rows + [(100, None), (101, ""), (102, "\n\n\n"), (103, rows[5][1]), (None, rows[6][1]), rows[7], (7, "other\ntext")]


@pytest.mark.parametrize("small", [True, False])
def test_line_dedup(spark, line_rows, monkeypatch, small):
    if not small:
        monkeypatch.setattr(line_dedup, "HASH_ROWS", 0)
        monkeypatch.setattr(line_dedup, "PLACE_ROWS", 0)
    # copies of one (doc_id, text) are told apart by the hash of their text, ties of doc_id by that hash too
    got = rows_of(line_dedup.dedup_lines(clashing(spark, line_rows)).select("doc_id", "text"))
    want = sorted(zip([d for d, _ in line_rows], brute.dedup_lines(line_rows)), key=str)
    assert got == want
    assert sum(len(t or "") for _, t in want) < sum(len(t or "") for _, t in line_rows)


def test_planted_passages_of_few_lines(spark):
    """Passages of 2 to 8 lines and over 50 words go outside their first place, whatever stands around them."""
    pick = random.Random(8)
    line = lambda n=30: " ".join(f"x{pick.randrange(10**6)}" for _ in range(n))
    passages = [[line() for _ in range(n)] for n in range(2, 9)]
    rows, want = [], []
    for i in range(70):
        before, after = [line(9) for _ in range(pick.randrange(4))], [line(9) for _ in range(1 + pick.randrange(4))]
        passage = passages[i % 7]
        gap = [""] * (i % 3)
        rows.append((i, "\n".join(before + passage[:1] + gap + passage[1:] + after)))
        want.append((i, "\n".join(before + (passage[:1] + gap + passage[1:] if i < 7 else []) + after)))
    assert rows_of(line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA)).select("doc_id", "text")) == sorted(want, key=str)


def test_line_dedup_counts(spark, line_rows):
    out = line_dedup.dedup_lines(spark.createDataFrame(line_rows, SCHEMA), counts=True).collect()
    for r in out:
        left = r["text"].count("\n") + 1 if r["text"] else 0
        assert r["n_removed"] <= r["n_lines"] and left in (r["n_lines"] - r["n_removed"], 0, 1)
    assert line_dedup.dedup_lines(spark.createDataFrame([], SCHEMA)).collect() == []


def test_substring_dedup(spark):
    pick = random.Random(3)
    text = lambda n, letters="abcdé \n": "".join(pick.choice(letters) for _ in range(n))
    base, rows = [text(pick.randrange(300, 3000)) for _ in range(12)], []
    for i in range(80):
        t = text(pick.randrange(0, 900))
        for _ in range(pick.randrange(3)):
            b = pick.choice(base)
            a = pick.randrange(len(b))
            t += b[a:a + pick.choice([395, 399, 400, 401, 500, 1500])] + text(pick.randrange(0, 50), "xyz")
        rows.append((i, t))
    rows += [(900, None), (901, ""), (902, "a" * 1500), (903, rows[5][1]), (904, "ab" * 500), (905, "z" * 399), (906, "z" * 400),
             (None, rows[7][1]), (907, "q" * 401), rows[11]]
    got = suffix_dedup.dedup_substrings(clashing(spark, rows)).drop("kept")
    assert rows_of(got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) == sorted(brute.repeated_strings(rows), key=str)
    assert suffix_dedup.dedup_substrings(spark.createDataFrame([], SCHEMA)).collect() == []


def test_cover_and_places():
    cover = set(suffix_dedup.COVER)
    assert all(sum((c + d) % 273 in cover for c in cover) == 1 for d in range(1, 273))
    keys = np.array([5, 9, 5, 7, 9, 1], np.uint64)
    node, pos = np.array([3, 3, 3, 8, 8, 8]), np.array([0, 4, 9, 0, 2, 700])
    for shared in (True, False):
        batch = suffix_dedup.pack_keys(keys, node, pos, 1, shared)
        k, x, p, marked, kx, kp = suffix_dedup.read_keys(batch.column("blob")[0].as_py())
        assert list(zip(k.tolist(), x.tolist(), p.tolist(), marked.tolist())) == [
            (5, 3, 0, True), (9, 3, 4, True), (7, 8, 0, False), (1, 8, 700, False)]
        assert list(zip(kx.tolist(), kp.tolist())) == ([(3, 9), (8, 2)] if shared else [])


def test_answers_round_trip():
    node, pos = np.array([-9, -9, -9, 4, 4, 70]), np.array([0, 5, 900, 3, 4, 1 << 30])
    x, p = suffix_dedup.read_answer(suffix_dedup.pack_answer(node, pos))
    assert x.tolist() == node.tolist() and p.tolist() == pos.tolist()
    assert suffix_dedup.read_places(suffix_dedup.pack_places(pos[:3])).tolist() == [0, 5, 900]


def test_ppm_code_lengths():
    pick = random.Random(1)
    texts = {lang: ["".join(pick.choice(letters) for _ in range(300)).encode() for _ in range(3)]
             for lang, letters in (("a", "abcd "), ("b", "bcdeé "))}
    model, slow = language_id.train(texts), brute.PPM(texts)
    docs = ["", "abc", "zzz é", "a" * 50, *("".join(pick.choice("abcdeéx ") for _ in range(60)) for _ in range(10))]
    raw = [d.encode() for d in docs]
    offsets = np.cumsum([0, *map(len, raw)])
    got = model.code_lengths(np.frombuffer(b"".join(raw), np.uint8), offsets)
    want = [[slow.bits(d, lang) for lang in model.langs] for d in raw]
    assert np.allclose(got, want, rtol=1e-4, atol=1e-3)


def test_language_held_out(spark, sf0001):
    docs = spark.read.parquet(f"{sf0001}/documents.parquet")
    out = language_id.predict(docs, language_id.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id")
    out = out.where("held_out and lang is not null")
    assert out.where("lang = lang_pred").count() >= 0.95 * out.count() > 0


def test_language_cases(spark):
    rows = [(i, ("the cat sat on the mat " if i % 2 else "der hund lief durch den wald ") * 5, "en" if i % 2 else "de") for i in range(40)]
    rows += [(100, None, "en"), (101, "", "en"), (102, "12 + 3", "de"), (None, "the cat", "xx"), (103, "the mat", None), rows[0]]
    docs = spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id long, text string, lang string, row string, letters int")
    model = language_id.fit(docs)
    assert model.langs == ["de", "en"]
    out = {r["doc_id"]: r for r in language_id.predict(docs, model).collect()}
    assert language_id.predict(docs, model).count() == len(rows)
    assert [out[k]["lang_pred"] for k in (100, 101, 102, 103, None, 0, 1)] == ["und"] * 3 + ["en", "en", "de", "en"]
    assert all(0 <= r["score"] <= 1 for r in out.values()) and out[None]["held_out"] is False
    assert language_id.keep_known(docs, model).count() == len(rows) - 3
    assert language_id.keep_known(docs, model).columns == docs.columns
    none = spark.createDataFrame([], docs.schema)
    empty = language_id.fit(none)
    assert language_id.predict(none, empty).count() == 0
    assert {r["lang_pred"] for r in language_id.predict(docs, empty).collect()} == {"und"}


def test_training_sample_of_copies_and_long_texts(spark):
    rows = [("hot", "the same text")] * 4000 + [("hot", f"text number {i}") for i in range(400)]
    rows += [("few", f"copied text {i % 3}") for i in range(600)]
    rows += [("long", f"{i} " + "ж" * 40_000) for i in range(10)]
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")
    got = language_id.training_sample(docs, rows=20, most=1000).collect()
    texts = {lang: [r["text"] for r in got if r["lang"] == lang] for lang in ("hot", "few", "long")}
    assert 20 <= len(texts["hot"]) <= 80 and len(set(texts["hot"])) == len(texts["hot"])
    assert len(texts["few"]) == 3 and len(texts["long"]) >= 5
    assert all(0 < len(t.encode()) <= 1000 for t in texts["long"])
    assert language_id.fit(docs, rows=20, most=1000).langs == ["few", "hot", "long"]


def test_short_texts_are_not_rejected_for_their_start(spark):
    pick = random.Random(8)
    words = ["".join(pick.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5)) for _ in range(300)]
    text = lambda: ". ".join(" ".join(pick.choice(words) for _ in range(6)).capitalize() for _ in range(14)) + "."
    model = language_id.train({"en": [text().encode() for _ in range(60)]})
    offsets = np.array([0, 2, 4])
    bits = model.code_lengths(np.frombuffer(b"A.E.", np.uint8), offsets)[:, 0]
    assert (bits > 2 * language_id.REJECT_BITS).all()
    rows = [(1, "A."), (2, "E."), (3, "日本語の文章です"), (4, text()), (5, "日")]
    kept = language_id.keep_known(spark.createDataFrame(rows, SCHEMA), model).collect()
    assert sorted(r["doc_id"] for r in kept) == [1, 2, 4]


def test_a_small_language_keeps_its_contexts():
    pick = random.Random(9)
    text = lambda letters, n: "".join(pick.choice(letters) for _ in range(n)).encode()
    large, small = [text("abcdefghij ", 3000) for _ in range(20)], [b"the cat sat on the mat " * 3] * 2
    model = language_id.train({"large": large, "small": small}, contexts=200, own_contexts=200)
    slow = brute.PPM({"small": small})
    raw = b"the cat sat on the mat"
    got = model.code_lengths(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0]
    assert got[1] < 1.2 * slow.bits(raw, "small") and 2 * got[1] < got[0]
    many = language_id.train({f"l{i}": [text("abcdefghijklmnopqrstuvwxyz"[i:i + 9], 2000)] for i in range(6)}, contexts=50, own_contexts=40)
    assert 6 * 40 / 2 < len(many.step) <= 50 + 6 * 40 + 1


def test_held_out_fold(spark):
    import zlib
    ids = spark.range(300).select("id", language_id.held_out(F.col("id")).alias("h"))
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in ids.collect())


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def test_words_that_collide_in_polynomial_hashes(spark):
    """Strings whose polynomial hashes modulo 2**64 are equal for every base are different words."""
    word = thue_morse(4096)
    other = word.translate(str.maketrans("ab", "ba"))
    rows = [(1, word), (2, other), (3, " ".join([word] * 5)), (4, " ".join([other] * 5)), (5, word)]
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.join_documents(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1}


def test_very_long_texts(spark):
    """Texts longer than the runs and stretches that tasks work in."""
    pick = random.Random(11)
    long = " ".join(f"w{pick.randrange(50_000)}" for _ in range(260_000))
    rows = [(1, long), (2, long[:700_000] + " cut " + long[700_005:]), (3, "short text of a few words only here"), (4, long[900_000:901_000])]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.join_documents(docs).collect()}
    assert got == {d: (len(brute.shingles(t)), 1 if d < 3 else d) for d, t in rows}
    cut = suffix_dedup.dedup_substrings(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert rows_of(cut) == sorted(brute.repeated_strings(rows), key=str)
