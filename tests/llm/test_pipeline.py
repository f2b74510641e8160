"""The pipeline against the brute-force operators, stage by stage and in one run."""

import random

import brute

import corpus_pipeline
from qaforge.llm import language_id, sentencepiece_nbest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    pick = random.Random(6)
    word = {"en": [f"the{i}" for i in range(200)], "de": [f"und{i}ö" for i in range(200)]}
    line = lambda lang, n=8: " ".join(pick.choice(word[lang]) for _ in range(n))
    shared = [line("en") for _ in range(12)]
    items = [(i, line("en", 25)) for i in range(4)]
    docs = []
    for i in range(60):
        lang = "en" if i % 3 else "de"
        text = "\n".join([line(lang) for _ in range(6)] + (shared if i % 10 == 1 else []))
        if i % 9 == 4:
            text = docs[-1][1] if i % 2 else docs[-1][1] + " end"
        if i in (20, 41):
            text += " " + items[i % 4][1]
        docs.append((i, text, lang if i % 7 else None, "s", len(text)))
    docs += [(90, None, "en", None, None), (91, "", "en", "s", 0), (92, "12 34", "en", "s", 5), (93, "日本語の文章です" * 4, None, "s", 32), docs[8]]
    return docs, items


def test_pipeline(spark, tmp_path):
    docs, items = corpus()
    spark.createDataFrame(docs, COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")

    model = language_id.fit(frame)
    texts = {}
    for r in language_id.training_sample(frame).collect():
        texts.setdefault(r["lang"], []).append(r["text"].encode())
    slow = brute.PPM(texts)
    kept = [(d, t) for d, t, *_ in docs if t and any(c.isalpha() for c in t)
            and min(slow.bits(t.encode(), x) for x in model.langs) <= language_id.REJECT_BITS * len(t.encode())]
    assert (93, "日本語の文章です" * 4) not in kept and len(kept) > 50
    cut = list(zip([d for d, _ in kept], brute.dedup_lines(kept)))
    classes = brute.components(cut)
    one = sorted({(d, t) for (d, t), (_, n, c) in zip(cut, classes) if not n or c == d})
    clean = [(d, t) for d, t in one if not brute.leaks([(d, t)], items)]
    assert len(docs) > len(kept) and len(one) < len(cut) and len(clean) < len(one)

    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in out) == [d for d, _ in clean]
    vocab = sentencepiece_nbest.vocabulary()
    want = dict(clean)
    for r in out:
        assert r["round_trip"] and sentencepiece_nbest.decode(r["ids"], vocab) == want[r["doc_id"]]


def test_stages_keep_columns(spark, tmp_path):
    docs, items = corpus()
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frame = spark.createDataFrame([], COLUMNS)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame, str(tmp_path))
        assert out.columns == frame.columns and out.count() == 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "jaccard_join", "decontaminate", "sentencepiece"]


CLASHING = "row string, node long, label string, _node string, _label long, _first string, h long, i int, c long, chunk string, letters string, item_id long, ids string, spans string"


def test_defined_cases(spark, tmp_path):
    """Null ids, repeated rows, very long texts and columns named like the operators' own; and empty tables."""
    docs, items = corpus()
    pick = random.Random(8)
    long = " ".join(f"the{pick.randrange(200)}" for _ in range(200_000))  # over a megabyte in one line
    docs += [(94, long, "en", "s", len(long)), (95, long + " more", "en", "s", len(long) + 5), (None, "the1 the2 the3 the4 the5 the6", None, None, None),
             (96, "the7\nthe8", "en", "s", 9), (96, "the7\nthe8", "en", "s", 9)]
    extra = ("x", 1, "x", "x", 1, "x", 1, 1, 1, "x", "x", 1, "x", "x")
    schema = f"{COLUMNS}, {CLASHING}"
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/full/benchmark.parquet")
    spark.createDataFrame([d + extra for d in docs], schema).write.parquet(f"{tmp_path}/full/documents.parquet")
    frame = spark.read.parquet(f"{tmp_path}/full/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, frame, f"{tmp_path}/full").columns == frame.columns, name
    out = corpus_pipeline.run(spark, f"{tmp_path}/full").select("doc_id", "n_pieces", "round_trip").collect()
    ids = [r["doc_id"] for r in out]
    assert None in ids and 94 in ids and 95 not in ids and ids.count(96) == 1 and not {90, 91, 92, 93} & set(ids)
    assert all(r["round_trip"] for r in out) and max(r["n_pieces"] for r in out) > 200_000

    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/none/benchmark.parquet")
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").collect() == []
