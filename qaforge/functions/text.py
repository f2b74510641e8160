"""Column -> Column text functions: tokenizers, n-grams, answer normalization.

All of them are built-in Spark SQL expressions, so they run inside
whole-stage code generation; none needs a Python UDF. A tokenizer is any
``Callable[[Column], Column]`` returning ``array<string>``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

Tokenizer = Callable[[Column], Column]

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's behaviour for equal results).
#
# Characters that answer normalization replaces by a space, in this order:
#   '  "  《  》  <  >  〈  〉  (  )  ‘  ’
QUOTE_CHARS = "'\"《》<>〈〉()‘’"
# ASCII punctuation (Python's string.punctuation, the same 32 characters),
# written as ranges so Java regex and RE2 read it alike.
ASCII_PUNCT_CLASS = r"[!-/:-@\[-`{-~]"
# The characters Python's str.split() treats as whitespace.
UNICODE_SPACE_CLASS = (r"[\t\n\x{0b}\f\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}"
                       r"\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
# Word characters of the search-server style analyzer: letters, marks,
# digits and the underscore, after lower-casing.
WORD_CLASS = r"[\p{L}\p{M}\p{N}_]+"
# ---------------------------------------------------------------------------


def whitespace_tokens(text: Column) -> Column:
    """Default tokenizer: lower-case, split on ASCII whitespace, drop empties."""
    return F.filter(F.split(F.lower(text), r"\s+"), lambda t: t != F.lit(""))


def word_tokens(text: Column) -> Column:
    """Search-server analyzer: lower-cased runs of letters/marks/digits/_."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_CLASS), 0)


TOKENIZERS: dict[str, Tokenizer] = {
    "whitespace": whitespace_tokens,
    "word": word_tokens,
}


def get_tokenizer(name_or_fn: str | Tokenizer) -> Tokenizer:
    if callable(name_or_fn):
        return name_or_fn
    try:
        return TOKENIZERS[name_or_fn]
    except KeyError:
        raise ValueError(f"unknown tokenizer {name_or_fn!r}; "
                         f"known: {sorted(TOKENIZERS)}") from None


def bigrams(tokens: Column) -> Column:
    """Adjacent token pairs joined by one space (empty for < 2 tokens)."""
    n = F.greatest(F.size(tokens) - 1, F.lit(0))
    return F.zip_with(F.slice(tokens, 1, n), F.slice(tokens, 2, n),
                      lambda a, b: F.concat(a, F.lit(" "), b))


def uni_and_bigrams(tokens: Column) -> Column:
    # an array of one element names the tokens, so that they are made once
    return F.transform(F.array(tokens), lambda t: F.concat(t, bigrams(t)))[0]


def normalize_answer(text: Column) -> Column:
    """Answer normalization: quotes/brackets -> space, lower, drop ASCII
    punctuation, collapse Unicode whitespace, trim. Also the index cleanup."""
    replaced = F.translate(text, QUOTE_CHARS, " " * len(QUOTE_CHARS))
    no_punct = F.regexp_replace(F.lower(replaced), ASCII_PUNCT_CLASS, "")
    return F.trim(F.regexp_replace(no_punct, UNICODE_SPACE_CLASS + "+", " "))


ARTICLES = ("a", "an", "the")


def squad_tokens(text: Column) -> Column:
    """SQuAD-style words: lower, drop ASCII punctuation, split on whitespace,
    drop the articles a/an/the."""
    no_punct = F.regexp_replace(F.lower(text), ASCII_PUNCT_CLASS, "")
    words = F.split(F.trim(F.regexp_replace(no_punct, UNICODE_SPACE_CLASS + "+", " ")), " ")
    return F.filter(words, lambda w: (w != F.lit("")) & ~w.isin(*ARTICLES))


def squad_normalize(text: Column) -> Column:
    return F.array_join(squad_tokens(text), " ")


def chars_of(normalized: Column) -> Column:
    """Characters of a normalized answer without its spaces."""
    stripped = F.replace(normalized, F.lit(" "), F.lit(""))
    return F.when(F.length(stripped) == 0, F.array().cast("array<string>")) \
        .otherwise(F.split(stripped, ""))


def common_count(a: Column, b: Column) -> Column:
    """Size of the multiset intersection of two string arrays."""
    return F.aggregate(
        F.array_distinct(a), F.lit(0),
        lambda acc, c: acc + F.least(F.size(F.filter(a, lambda x: x == c)),
                                     F.size(F.filter(b, lambda x: x == c))))


def overlap_f1(pred_items: Column, gold_items: Column) -> Column:
    """Harmonic mean of precision and recall of shared items; 0 if none.

    Arrays of one element name the items and their overlap, so that neither is
    made again for each item."""
    def f1(x):
        precision = x["same"] / F.size(x["p"])
        recall = x["same"] / F.size(x["g"])
        return F.when(x["same"] == 0, F.lit(0.0)).otherwise(
            2 * precision * recall / (precision + recall))

    named = F.array(F.struct(pred_items.alias("p"), gold_items.alias("g")))
    shared = F.transform(named, lambda x: F.struct(common_count(x["p"], x["g"]).alias("same"), x["p"].alias("p"), x["g"].alias("g")))
    return F.transform(shared, f1)[0]


def char_f1(pred: Column, gold: Column) -> Column:
    """Character-level F1 after answer normalization."""
    return overlap_f1(chars_of(normalize_answer(pred)),
                      chars_of(normalize_answer(gold)))


def exact_match(pred: Column, gold: Column) -> Column:
    return (normalize_answer(pred) == normalize_answer(gold)).cast("int")


def squad_f1(pred: Column, gold: Column) -> Column:
    """SQuAD word F1 (0..1)."""
    return overlap_f1(squad_tokens(pred), squad_tokens(gold))


def squad_em(pred: Column, gold: Column) -> Column:
    return (squad_normalize(pred) == squad_normalize(gold)).cast("int")
