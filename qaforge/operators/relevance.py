"""Gold passages by containment, and per-query ranking metrics.

Which passages contain a gold text? A brute-force answer tests every
(question, passage) pair. Instead: every passage containing the text holds
each *interior* whitespace token of it (all but the first and last, which
may be glued to neighbouring characters) as a whole token. So the passages
that hold the text's rarest interior terms, looked up in the postings where
they lie (a passage's postings meet in one task), are a candidate superset,
and ``contains`` verifies it. Few are left, so the texts are read in place too:
neither postings nor texts are shuffled while the terms and the candidates may
be broadcast. A text with fewer than three tokens
has no interior token: its longest token is part of some term of every passage
that holds the text. The terms of the vocabulary (far fewer than the passages'
characters) are listed by their runs of ``GRAM`` characters, the token is looked
up by its rarest run, and the terms' postings are the candidates. A text of
white space only is tested against each passage. An empty text has no gold
passage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import BROADCAST_MAX_ROWS, bounded_broadcast, rounded, top_n
from .index import SparseIndex
from .retrieve import HOT_DF, _join_postings, _small, postings_of

# Characters of a run by which terms are listed.
GRAM = 3
# Interior terms of a text, the rarest, that a candidate must hold.
RARE_TERMS = 3


def containing_passages(items: DataFrame, passages: DataFrame, index: SparseIndex,
                        qid_col: str = "qid", text_col: str = "question") -> DataFrame:
    """``qid, passage_id`` for every passage whose text contains the item text.

    ``index`` must be a whitespace-token index of ``passages``.
    """
    raw = F.filter(F.split(F.col(text_col), r"\s+"), lambda t: t != F.lit(""))
    base = materialize(items.select(F.col(qid_col).alias("qid"), F.col(text_col).alias("gold"), raw.alias("toks"))
                       .withColumn("item", F.monotonically_increasing_id()), "gold-items")
    long_items = base.where(F.size("toks") >= 3)
    interior = long_items.select(
        "item", F.explode(F.array_distinct(F.transform(
            F.slice("toks", 2, F.size("toks") - 2), lambda t: F.lower(t)))).alias("term"))
    texts = passages.select("passage_id", "text")
    candidates = _holding_rarest(interior, index)
    verified = (texts.join(bounded_broadcast(candidates), "passage_id")
                .join(bounded_broadcast(long_items.select("item", "qid", "gold")), "item")
                .where(F.col("text").contains(F.col("gold")))
                .select("qid", "passage_id"))
    short = base.where((F.size("toks") < 3) & (F.length("gold") > 0))
    if short.limit(1).count() == 0:
        return verified
    blank = [r[0] for r in short.where(F.size("toks") == 0).select("gold").distinct().collect()]  # runs of white space
    tokens = short.where(F.size("toks") > 0).select("qid", "gold", F.try_element_at(F.array_sort(
        "toks", lambda a, b: F.length(a) - F.length(b)), F.lit(-1)).alias("token"))
    asked = materialize(tokens.join(terms_containing(tokens.select("token").distinct(), index.vocab), "token")
                        .select("qid", "gold", "term"), "gold-terms")
    verified = verified.unionByName(
        postings_of(index, asked).select("term", "passage_id").join(bounded_broadcast(asked), "term")
        .select("qid", "gold", "passage_id").distinct()
        .join(texts, "passage_id").where(F.col("text").contains(F.col("gold"))).select("qid", "passage_id"))
    if not blank:
        return verified
    held = F.filter(F.array(*map(F.lit, blank)), lambda g: F.col("text").contains(g))
    return verified.unionByName(texts.select("passage_id", F.explode(held).alias("gold"))
                                .join(short.select("qid", "gold"), "gold").select("qid", "passage_id"))


def _holding_rarest(interior: DataFrame, index: SparseIndex) -> DataFrame:
    """``item, passage_id``, stored: the passages that hold each of an item's ``RARE_TERMS`` rarest terms
    (columns item, term). Terms that the vocabulary lacks are left to the later test."""
    rare = top_n(bounded_broadcast(interior).join(index.vocab.select("term", "df"), "term"), "item",
                 [F.col("df").asc(), F.col("term").asc()], RARE_TERMS, "no")
    rare = materialize(rare.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("item"))), "gold-rare-terms")
    side, small = _small(rare, BROADCAST_MAX_ROWS)
    bit = F.call_function("shiftleft", F.lit(1), F.col("no") - 1)
    # terms are bits: where ids repeat, a term may have several postings of one passage
    held = (_join_postings(side, postings_of(index, rare), small, HOT_DF)
            .groupBy("item", "passage_id", "n").agg(F.bit_or(bit).alias("held")))
    every = F.call_function("shiftleft", F.lit(1), F.col("n").cast("int")) - 1
    return materialize(held.where(F.col("held") == every).select("item", "passage_id"), "gold-candidates")


def _folded(token: Column) -> Column:
    """Lower case, with the final sigma as the other one: the last letter of a part may be an inner one of the term."""
    return F.translate(F.lower(token), "ς", "σ")


def _grams(text: Column, q: int) -> Column:
    starts = F.sequence(F.lit(1), F.greatest(F.length(text) - q + 1, F.lit(1)))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, F.lit(q))))


def terms_containing(tokens: DataFrame, vocab: DataFrame) -> DataFrame:
    """``token, term`` for every vocabulary term that contains a token (column token), in any case of letters."""
    folded = tokens.select("token", _folded(F.col("token")).alias("part"))
    sizes = sorted(r[0] for r in folded.select(F.least(F.length("part"), F.lit(GRAM))).distinct().collect())  # at most GRAM numbers
    terms = vocab.select("term", _folded(F.col("term")).alias("whole"))
    out = None
    for q in sizes:
        mine = folded.where(F.least(F.length("part"), F.lit(GRAM)) == q)
        asked = mine.select("token", "part", F.explode(_grams(F.col("part"), q)).alias("gram"))
        # only runs that a token asks for get a posting list
        lists = (terms.where(F.length("whole") >= q).select("term", "whole", F.explode(_grams(F.col("whole"), q)).alias("gram"))
                 .join(bounded_broadcast(asked.select("gram").distinct()), "gram", "left_semi"))
        sizes_of = lists.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
        rarest = (asked.join(sizes_of, "gram", "left").groupBy("token", "part")
                  .agg(F.min_by("gram", F.coalesce("n", F.lit(0))).alias("gram")))
        found = (lists.join(bounded_broadcast(rarest), "gram").where(F.col("whole").contains(F.col("part"))).select("token", "term"))
        out = found if out is None else out.unionByName(found)
    return out if out is not None else tokens.select("token", F.lit("").alias("term")).limit(0)


def ranking_metrics(ranked: DataFrame, gold: DataFrame) -> DataFrame:
    """Per-query recall (single/multi hit), precision, reciprocal rank,
    average precision and NDCG of a ranked list against gold passage ids,
    then their means over the questions that have gold. One row."""
    n_gold = gold.groupBy("qid").agg(F.count(F.lit(1)).alias("n_gold"))
    flagged = (ranked.join(gold.withColumn("rel", F.lit(1)), ["qid", "passage_id"], "left")
               .withColumn("rel", F.coalesce(F.col("rel"), F.lit(0))))
    w = Window.partitionBy("qid").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    flagged = flagged.withColumn("cum_rel", F.sum("rel").over(w))
    per_q = (flagged.groupBy("qid").agg(
        F.count(F.lit(1)).alias("n_ret"),
        F.sum("rel").alias("n_hit"),
        F.min(F.when(F.col("rel") == 1, F.col("rank"))).alias("first_hit"),
        F.sum(F.col("rel") / F.log2(F.col("rank") + 1.0)).alias("dcg"),
        F.sum(F.col("rel") * F.col("cum_rel") / F.col("rank")).alias("ap_sum"))
        .join(n_gold, "qid"))
    ideal = F.aggregate(F.sequence(F.lit(1), F.least(F.col("n_gold"), F.col("n_ret"))),
                        F.lit(0.0), lambda acc, i: acc + 1.0 / F.log2(i + 1.0))
    per_q = per_q.select(
        "qid",
        F.least(F.col("n_hit"), F.lit(1)).cast("double").alias("recall_single_hit"),
        (F.col("n_hit") / F.col("n_gold")).alias("recall_multi_hit"),
        (F.col("n_hit") / F.col("n_ret")).alias("precision"),
        F.coalesce(1.0 / F.col("first_hit"), F.lit(0.0)).alias("rr"),
        (F.col("ap_sum") / F.col("n_gold")).alias("ap"),
        (F.col("dcg") / ideal).alias("ndcg"))
    return per_q.agg(
        F.count(F.lit(1)).alias("n_questions"),
        *[rounded(F.avg(c)).alias(c if c not in ("rr", "ap") else {"rr": "mrr", "ap": "map"}[c])
          for c in ("recall_single_hit", "recall_multi_hit", "precision", "rr", "ap", "ndcg")])


__all__ = ["containing_passages", "ranking_metrics"]
