"""Windows, gold alignment and span decoding against plain Python."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from qaforge.operators import spans as SP
from qaforge.operators import windows as WN

EX_SCHEMA = ("example_id long, id string, question string, context string, "
             "answers struct<text:array<string>,answer_start:array<int>>")


def examples(spark, rows):
    return spark.createDataFrame(rows, EX_SCHEMA)


def ctx_tokens(text):
    return [(m.start(), m.end()) for m in re.finditer(r"\S+", text)]


def windows_py(n, qn, max_len, stride):
    cap = max_len - 3 - qn
    step = cap - stride
    last = math.ceil(max(n - cap, 0) / step) * step
    return [(w, f, min(cap, n - f)) for w, f in enumerate(range(0, last + 1, step))]


def test_token_offsets_cut_the_right_text(spark):
    text = "  Héllo wörld 😀 \n\nnext\tline  "
    df = spark.createDataFrame([(1, text)], "id long, t string")
    offs = WN.token_offsets(df, "id", "t").first()["offsets"]
    got = [text[o["s"]:o["e"]] for o in offs]
    assert got == text.split()


@pytest.mark.parametrize("n_tokens,max_len,stride", [(3, 20, 4), (12, 15, 3), (30, 16, 7), (11, 17, 5)])
def test_windows_cover_every_token(spark, n_tokens, max_len, stride):
    context = " ".join(f"w{i}" for i in range(n_tokens))
    ex = examples(spark, [(1, "1", "q1 q2", context, ([], []))])
    got = [(r["window"], r["first_token"], r["n_ctx"])
           for r in WN.context_windows(ex, max_len, stride).orderBy("window").collect()]
    assert got == windows_py(n_tokens, 2, max_len, stride)
    covered = set()
    for _, f, c in got:
        covered.update(range(f, f + c))
    assert covered == set(range(n_tokens))
    assert got[-1][1] + got[-1][2] == n_tokens     # the last window reaches the last token


def test_overlap_is_capacity_minus_one(spark):
    # capacity 10, stride 9 -> step 1: every window starts one token later
    context = " ".join(f"w{i}" for i in range(13))
    ex = examples(spark, [(1, "1", "q", context, ([], []))])
    got = [r["first_token"] for r in WN.context_windows(ex, 14, 9).orderBy("window").collect()]
    assert got == [0, 1, 2, 3]


def test_blank_context_has_one_window_and_long_question_is_rejected(spark):
    ex = examples(spark, [(1, "1", "q", "   ", ([], [])),
                          (2, "2", " ".join(["q"] * 20), "a b c", ([], []))])
    (w,) = WN.context_windows(ex, 24, 4).collect()
    assert (w["example_id"], w["window"], w["first_token"], w["n_ctx"], w["offsets"]) == (1, 0, 0, 0, [None] * 4)
    scored = WN.synthetic_logits(WN.context_windows(ex, 24, 4))
    answers = {r["example_id"]: r["text"] for r in SP.nbest(scored, ex).where("rank = 1").collect()}
    assert answers == {1: "empty", 2: "empty"}
    assert [tuple(r)[2:] for r in WN.align_answers(WN.context_windows(ex, 24, 4), ex).collect()] == [(0, 0)]
    assert [r["example_id"] for r in WN.rejected_examples(ex, 24, 4).collect()] == [2]


def test_alignment_cases(spark):
    context = "alpha beta gamma delta epsilon zeta"
    rows = [
        (1, "1", "q", context, (["alpha"], [0])),             # first token
        (2, "2", "q", context, (["zeta"], [31])),             # last token
        (3, "3", "q", context, (["delta epsilon"], [17])),    # across a window edge
        (4, "4", "q", context, ([], [])),                     # no answer
    ]
    ex = examples(spark, rows)
    win = WN.context_windows(ex, 3 + 1 + 4, 2)               # capacity 4, step 2
    got = {(r["example_id"], r["window"]): (r["start_position"], r["end_position"])
           for r in WN.align_answers(win, ex).collect()}
    q0 = 1 + 2                                               # CLS + 1 question token + SEP
    assert got[(1, 0)] == (q0 + 0, q0 + 0)
    assert got[(2, 1)] == (q0 + 3, q0 + 3)                   # tokens 2..5 in window 1
    assert got[(3, 0)] == (0, 0)                             # window 0 holds tokens 0..3 only
    assert got[(3, 1)] == (q0 + 1, q0 + 2)
    assert all(v == (0, 0) for (e, _), v in got.items() if e == 4)


def decode_py(feature_rows, context, n_best=20, max_len=30):
    """Plain-Python n-best decoder (no null answers)."""
    prelim = []
    for w, offsets, sl, el in sorted(feature_rows):
        starts = sorted(range(len(sl)), key=lambda i: (-sl[i], i))[:n_best]
        ends = sorted(range(len(el)), key=lambda i: (-el[i], i))[:n_best]
        for si, s in enumerate(starts):
            for ei, e in enumerate(ends):
                if offsets[s] is None or offsets[e] is None or e < s or e - s + 1 > max_len:
                    continue
                prelim.append((-(sl[s] + el[e]), w, si, ei, offsets[s][0], offsets[e][1], sl[s], el[e]))
    prelim.sort()
    kept = prelim[:n_best]
    preds = [(context[a:b], sl_, el_, -neg) for neg, _, _, _, a, b, sl_, el_ in kept]
    if not preds or (len(preds) == 1 and preds[0][0] == ""):
        preds.insert(0, ("empty", 0.0, 0.0, 0.0))
    m = max(p[3] for p in preds)
    ex = [math.exp(p[3] - m) for p in preds]
    return [(t, s, e, x / sum(ex)) for (t, s, e, _), x in zip(preds, ex)]


def test_nbest_matches_plain_python(spark):
    rng = random.Random(7)
    context = " ".join(f"tok{i}" for i in range(40))
    ex = examples(spark, [(1, "1", "what is it", context, ([], []))])
    feats = WN.context_windows(ex, 3 + 3 + 16, 6).select("example_id", "window", "offsets").collect()
    rows, py_rows = [], []
    for r in feats:
        n = len(r["offsets"])
        sl = [float(rng.randint(0, 30)) for _ in range(n)]   # many ties on purpose
        el = [float(rng.randint(0, 30)) for _ in range(n)]
        offs = [None if o is None else (o["s"], o["e"]) for o in r["offsets"]]
        rows.append((1, r["window"], [None if o is None else {"s": o[0], "e": o[1]} for o in offs], sl, el))
        py_rows.append((r["window"], offs, sl, el))
    fdf = spark.createDataFrame(rows, "example_id long, window int, offsets array<struct<s:int,e:int>>, "
                                      "start_logits array<double>, end_logits array<double>")
    got = [(r["text"], r["start_logit"], r["end_logit"], r["probability"])
           for r in SP.nbest(fdf, ex).orderBy("rank").collect()]
    want = decode_py(py_rows, context)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want])
    assert sum(g[3] for g in got) == pytest.approx(1.0)


def test_all_offsets_null_gives_empty(spark):
    ex = examples(spark, [(1, "1", "q", "abc", ([], []))])
    fdf = spark.createDataFrame([(1, 0, [None, None, None], [1.0, 2.0, 3.0], [1.0, 2.0, 3.0])],
                                "example_id long, window int, offsets array<struct<s:int,e:int>>, "
                                "start_logits array<double>, end_logits array<double>")
    nb = SP.nbest(fdf, ex).collect()
    assert [(r["text"], r["probability"]) for r in nb] == [("empty", 1.0)]
    assert SP.best_answers(SP.nbest(fdf, ex)).first()["prediction_text"] == "empty"


def test_end_before_start_and_long_spans_rejected(spark):
    offs = [None] + [{"s": i * 2, "e": i * 2 + 1} for i in range(40)]
    sl = [0.0] + [0.0] * 40
    el = [0.0] + [0.0] * 40
    sl[35], el[2] = 9.0, 9.0          # best start after best end: rejected
    sl[1], el[32] = 8.0, 8.0          # length 32 > 30: rejected
    ex = examples(spark, [(1, "1", "q", "x " * 40, ([], []))])
    fdf = spark.createDataFrame([(1, 0, offs, sl, el)],
                                "example_id long, window int, offsets array<struct<s:int,e:int>>, "
                                "start_logits array<double>, end_logits array<double>")
    nb = SP.nbest(fdf, ex).orderBy("rank").collect()
    assert (nb[0]["start_logit"], nb[0]["end_logit"]) == (8.0, 9.0)     # (1, 2) is the best valid pair
    assert all((r["start_logit"], r["end_logit"]) not in ((9.0, 9.0), (8.0, 8.0)) for r in nb)


def test_null_odds_threshold(spark):
    # CLS score 10 beats every span (best 2+2=4): diff > 0 -> empty answer
    offs = [None, {"s": 0, "e": 1}, {"s": 2, "e": 3}]
    ex = examples(spark, [(1, "1", "q", "a b", ([], []))])
    fdf = spark.createDataFrame([(1, 0, offs, [5.0, 2.0, 1.0], [5.0, 1.0, 2.0])],
                                "example_id long, window int, offsets array<struct<s:int,e:int>>, "
                                "start_logits array<double>, end_logits array<double>")
    r = SP.null_odds(SP.nbest(fdf, ex, with_null=True)).first()
    assert r["score_diff"] == pytest.approx(10.0 - 4.0)
    assert r["prediction_text"] == ""
    nb = SP.nbest(fdf, ex, with_null=True).collect()
    assert sum(x["probability"] for x in nb) == pytest.approx(1.0)
    assert any(x["is_null"] for x in nb)


def test_synthetic_logits_shape(spark):
    ex = examples(spark, [(7, "7", "q", "a b c", ([], []))])
    f = WN.synthetic_logits(WN.context_windows(ex)).first()
    assert len(f["start_logits"]) == len(f["offsets"]) == len(f["end_logits"])
    assert f["start_logits"][1] == ((7 * 7919 + 0 * 31 + 1 * 104729) % 2003) / 100.0
    assert F is not None


def test_user_model_hook_and_reader_metrics(spark):
    """a user scorer runs through mapInPandas; T7/D11 limits; E7 metrics."""
    import pandas as pd

    from qaforge.operators import metrics as MT
    from qaforge.plans import reading_flow as RF

    passages = spark.createDataFrame([(1, "the capital is Seoul city"), (2, "Busan is a port")],
                                     "passage_id long, text string")
    questions = spark.createDataFrame([(5, "what is the capital")], "qid long, question string")
    ranked = spark.createDataFrame([(5, 1, 1, 1.0), (5, 2, 2, 0.5)], "qid long, rank int, passage_id long, score double")

    def model(batches):
        # prefers the token "Seoul" as start and end
        for pdf in batches:
            starts, ends = [], []
            for offs in pdf["offsets"]:
                s = [0.0] * len(offs)
                for i, o in enumerate(offs):
                    if o is not None and o["e"] - o["s"] == 5:
                        s[i] = 5.0
                starts.append(s)
                ends.append(list(s))
            yield pd.DataFrame({"example_id": pdf["example_id"], "window": pdf["window"],
                                "offsets": pdf["offsets"], "start_logits": starts, "end_logits": ends})

    out = RF.read_retrieved(ranked, passages, questions, model=model, top_k=2,
                            max_passages_per_question=2)
    rows = out.orderBy("rank").collect()
    assert rows[0]["text"] in ("Seoul", "Busan") and rows[0]["score"] == 10.0
    answers = out.withColumn("id", out["qid"].cast("string"))
    gold = spark.createDataFrame([("5", (["Seoul"],))], "id string, answers struct<text:array<string>>")
    m = MT.reader_topk_metrics(answers, gold, k=2).first()
    assert m["em"] == 1.0 and m["n_questions"] == 1
