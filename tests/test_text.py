"""Answer normalization and answer metrics: hand-computed cases."""

import pytest
from pyspark.sql import functions as F

from qaforge.functions import text as TX


def one(spark, expr_fn, *values):
    cols = [f"c{i}" for i in range(len(values))]
    df = spark.createDataFrame([tuple(values)], ",".join(f"{c} string" for c in cols))
    return df.select(expr_fn(*[F.col(c) for c in cols]).alias("r")).first()["r"]


@pytest.mark.parametrize("raw,expected", [
    ("《A》 (b)-c’s  D", "a b c s d"),
    ("!!!...", ""),
    ("a　b c", "a b c"),
    ("  Hello,   World!  ", "hello world"),
    ("'quoted' \"x\"", "quoted x"),
])
def test_normalize_answer(spark, raw, expected):
    assert one(spark, TX.normalize_answer, raw) == expected


def test_char_f1_multiset(spark):
    # 'aab' vs 'aaa': two shared a's -> precision = recall = 2/3
    assert one(spark, TX.char_f1, "aab", "aaa") == pytest.approx(2 / 3)


def test_char_f1_empty_and_disjoint(spark):
    assert one(spark, TX.char_f1, "", "") == 0.0
    assert one(spark, TX.char_f1, "abc", "xyz") == 0.0


def test_f1_symmetric_and_em_implies_f1(spark):
    pairs = [("Seoul City", "seoul city!"), ("ab cd", "cd ab"), ("한국어 답", "한국어")]
    for p, g in pairs:
        assert one(spark, TX.char_f1, p, g) == pytest.approx(one(spark, TX.char_f1, g, p))
        if one(spark, TX.exact_match, p, g) == 1:
            assert one(spark, TX.char_f1, p, g) == pytest.approx(1.0)


def test_squad_tokens_drop_articles(spark):
    assert one(spark, TX.squad_normalize, "The cat, a dog and AN owl.") == "cat dog and owl"
    assert one(spark, TX.squad_f1, "the cat sat", "cat sat down") == pytest.approx(0.8)


def test_bigrams(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["x"],), ([],)], "t array<string>")
    got = [r["g"] for r in df.select(TX.bigrams(F.col("t")).alias("g")).collect()]
    assert got == [["a b", "b c"], [], []]


def test_tokenizers(spark):
    df = spark.createDataFrame([("  Hello  World\tfoo ",)], "s string")
    r = df.select(TX.whitespace_tokens(F.col("s")).alias("w"), TX.word_tokens(F.col("s")).alias("x")).first()
    assert r["w"] == ["hello", "world", "foo"]
    assert r["x"] == ["hello", "world", "foo"]
