"""Token offsets, sliding context windows and gold alignment.

Tokens are maximal non-whitespace runs with code-point offsets ``[s, e)``.
Spark has no "find all matches with positions", so a context is cut into
alternating token/space pieces, exploded, and a running ``sum(length)``
window per example gives each start. That is O(n log n) per text, where an
``aggregate`` building the offset array would copy it O(n^2) times.

Feature layout (one row per window), as a question/context pair encoder
lays it out: position 0 = CLS, 1..qn = question tokens, qn+1 = SEP, then
the window's context tokens, then SEP. ``offsets`` is null outside the
context (D2). Window starts are 0, step, 2*step, ... with
``capacity = max_len - qn - 3`` and ``step = capacity - stride``; the last
window reaches the last token and none follows it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Window defaults and special-token count.
MAX_LEN = 385
DOC_STRIDE = 128
SPECIAL_TOKENS = 3

OFFSET_TYPE = "array<struct<s:int,e:int>>"


def token_offsets(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``<id_col>, offsets array<struct<s,e>>`` for rows with at least one token."""
    pieces = F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(r"(\S+|\s+)"), 1)
    exploded = df.select(F.col(id_col).alias("_id"), F.posexplode(pieces).alias("i", "piece")).select(
        "_id", "i", F.length("piece").alias("n"), F.col("piece").rlike(r"^\S").alias("token"))  # the pieces stay where they are
    before = (Window.partitionBy("_id").orderBy("i")
              .rowsBetween(Window.unboundedPreceding, -1))
    starts = exploded.withColumn("s", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("int"))
    toks = (starts.where("token")
            .groupBy("_id")
            .agg(F.array_sort(F.collect_list(F.struct("i", "s", (F.col("s") + F.col("n"))
                                                      .cast("int").alias("e")))).alias("t")))
    offsets = F.transform("t", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))
    return toks.select(F.col("_id").alias(id_col), offsets.alias("offsets"))


def question_token_count(question: Column) -> Column:
    return F.size(F.regexp_extract_all(F.coalesce(question, F.lit("")), F.lit(r"\S+"), 0))


def context_windows(examples: DataFrame, max_len: int = MAX_LEN, stride: int = DOC_STRIDE,
                    id_col: str = "example_id", model_max_len: int | None = None,
                    offsets: DataFrame | None = None, offsets_on: str | None = None) -> DataFrame:
    """One row per window: ``example_id, window, first_token, qn, n_ctx,
    offsets`` (full feature length, null outside the context).

    An example whose context has no token has one window without context
    offsets. Examples whose question leaves no room for ``stride`` overlap
    have no window; ``rejected_examples`` reports them. A window is never
    longer than the model's own limit ``model_max_len``. Contexts that many
    examples share can bring their token ``offsets``, made once per context and
    joined on ``offsets_on``.
    """
    max_len = max_len if model_max_len is None else min(max_len, model_max_len)  # D4
    on = offsets_on or id_col
    offs = token_offsets(examples, id_col, "context") if offsets is None else offsets
    ex = (examples.select(*dict.fromkeys((id_col, on)), "question").join(offs, on, "left")
          .withColumn("offsets", F.coalesce(F.col("offsets"), F.array().cast(OFFSET_TYPE)))
          .withColumn("qn", question_token_count(F.col("question")))
          .withColumn("cap", F.lit(max_len - SPECIAL_TOKENS) - F.col("qn"))
          .withColumn("step", F.col("cap") - F.lit(stride))
          .withColumn("n", F.size("offsets"))
          .where(F.col("step") > 0))
    last_first = (F.ceil(F.greatest(F.col("n") - F.col("cap"), F.lit(0)) / F.col("step"))
                  * F.col("step")).cast("int")
    # windows are cut inside the row, so that no copy of all offsets is exploded
    cut = F.transform(F.sequence(F.lit(0), last_first, F.col("step")), lambda f: F.struct(
        f.alias("first_token"), F.slice("offsets", f + 1, F.col("cap")).alias("ctx")))
    wins = ex.select(id_col, "qn", F.posexplode(cut).alias("window", "w")).select(id_col, "qn", "window", "w.first_token", "w.ctx")
    ctx = F.col("ctx")
    nulls = F.array_repeat(F.lit(None).cast("struct<s:int,e:int>"), F.col("qn") + 2)
    tail = F.array(F.lit(None).cast("struct<s:int,e:int>"))
    return wins.select(
        id_col, F.col("window").cast("int"), F.col("first_token").cast("int"),
        F.col("qn").cast("int"), F.size(ctx).alias("n_ctx"),
        F.concat(nulls, ctx, tail).alias("offsets"))


def rejected_examples(examples: DataFrame, max_len: int = MAX_LEN, stride: int = DOC_STRIDE) -> DataFrame:
    """Examples whose question is too long for the window and overlap."""
    cap = F.lit(max_len - SPECIAL_TOKENS) - question_token_count(F.col("question"))
    return examples.where(cap - F.lit(stride) <= 0)


def align_answers(windows: DataFrame, examples: DataFrame, id_col: str = "example_id") -> DataFrame:
    """Gold start/end token positions per window (D3); 0 (CLS) when the
    example has no answer or the answer is not fully inside the window.
    The start is clamped to the last context token."""
    gold = examples.select(
        id_col,
        F.try_element_at("answers.answer_start", F.lit(1)).alias("a_start"),
        F.try_element_at("answers.text", F.lit(1)).alias("a_text"))
    w = windows.join(gold, id_col)
    first_pos = F.col("qn") + 2
    last_pos = F.col("qn") + 1 + F.col("n_ctx")
    start_char = F.col("a_start")
    end_char = F.col("a_start") + F.length("a_text")
    first_off = F.get("offsets", first_pos)
    last_off = F.get("offsets", last_pos)
    inside = (start_char.isNotNull() & (first_off["s"] <= start_char) & (last_off["e"] >= end_char))
    positions = F.sequence(first_pos, last_pos)
    start_pos = F.array_max(F.filter(positions, lambda p: F.get("offsets", p)["s"] <= start_char))
    end_pos = F.array_min(F.filter(positions, lambda p: F.get("offsets", p)["e"] >= end_char))
    return w.select(id_col, "window",
                    F.when(inside, start_pos).otherwise(F.lit(0)).cast("int").alias("start_position"),
                    F.when(inside, end_pos).otherwise(F.lit(0)).cast("int").alias("end_position"))


def synthetic_logits(windows: DataFrame, id_col: str = "example_id", number: Column | None = None) -> DataFrame:
    """Deterministic stand-in for model scores (the reader model is out of
    scope; a user supplies real ones with ``mapInPandas``). Integer
    arithmetic, so every engine computes the same values. ``number`` seeds an
    example's scores when its id is no number."""
    n = F.size("offsets")
    pos = F.sequence(F.lit(0), n - 1)
    ex = (F.col(id_col) if number is None else number) % 1_000_003
    win = F.col("window")
    # Multipliers and moduli of the stand-in scores.
    start = F.transform(pos, lambda p: ((ex * 7919 + win * 31 + p * 104729) % 2003).cast("double") / 100.0)
    end = F.transform(pos, lambda p: ((ex * 104729 + win * 17 + p * 7919) % 2003).cast("double") / 100.0)
    return windows.withColumn("start_logits", start).withColumn("end_logits", end)
