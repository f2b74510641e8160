"""Roles of the given tables, derived with Spark expressions.

* passages: ``documents`` deduplicated by text (``distinct_passages``);
* questions: ``benchmark`` -- id = item_id, question = the whole item text;
  its gold is the item text itself (a passage is relevant when it contains
  it);
* QA examples: ``conversations`` -- a user turn is the question, the next
  turn of the same conversation (when it is an assistant turn) is the
  context, and the gold answer is the 3rd..5th whitespace token of that
  context with its character offset. User turns without such a context, or
  contexts shorter than five tokens, give examples without answers.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.corpus import distinct_passages
from ..session import is_complete, shared_path
from .tables import table

# How a gold answer is cut out of a context (tokens 3..5).
ANSWER_PATTERN = r"^(\s*\S+\s+\S+\s+)(\S+\s+\S+\s+\S+)"
# Example id = conv_id * EXAMPLE_ID_STRIDE + turn.
EXAMPLE_ID_STRIDE = 1 << 31


def passages(spark: SparkSession, sf_dir: str, keep=("lang", "source", "n_chars"),
             stored: bool = True) -> DataFrame:
    """Distinct passages of ``documents``. With ``stored`` the deduplicated
    table is written once per input (keyed by the source files' names,
    sizes and modification times) to the shared folder, and read from there
    by every later query instead of re-shuffling all texts."""
    docs = table(spark, sf_dir, "documents")
    if not stored:
        return distinct_passages(docs, keep=tuple(keep))
    path = shared_path(spark, f"passages-{source_key(spark, sf_dir, 'documents', *keep)}")
    if not is_complete(spark, path):
        distinct_passages(docs, keep=tuple(keep)).write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def source_key(spark: SparkSession, sf_dir: str, name: str, *more: str) -> str:
    """Names the present state of a table: a hash over its files' paths, sizes and
    modification times, made of the file listing without reading the table."""
    # the binaryFile source prunes the unread content column
    listing = spark.read.format("binaryFile").load(f"{sf_dir.rstrip('/')}/{name}.parquet")
    one = F.xxhash64("path", "length", F.col("modificationTime").cast("string"))
    stamp = listing.agg(F.count(F.lit(1)), F.bit_xor(one), F.sum("length")).first()
    return hashlib.sha1(repr((name, tuple(stamp), more)).encode()).hexdigest()[:20]


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``qid long, question string`` (gold text = question)."""
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("qid"), F.col("text").alias("question"))


def qa_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``example_id long, id string, question, context, answers struct<text
    array<string>, answer_start array<int>>, title, document_id``."""
    conv = table(spark, sf_dir, "conversations")
    users = conv.where(F.col("role") == "user").alias("u")
    nxt = conv.where(F.col("role") == "assistant").alias("a")
    joined = users.join(nxt, (F.col("u.conv_id") == F.col("a.conv_id"))
                        & (F.col("a.turn") == F.col("u.turn") + 1), "left")
    ctx = F.col("a.text")
    has_answer = ctx.isNotNull() & ctx.rlike(ANSWER_PATTERN)
    ans_text = F.regexp_extract(ctx, ANSWER_PATTERN, 2)
    ans_start = F.length(F.regexp_extract(ctx, ANSWER_PATTERN, 1)).cast("int")
    answers = F.when(has_answer, F.struct(F.array(ans_text).alias("text"),
                                          F.array(ans_start).alias("answer_start"))) \
        .otherwise(F.struct(F.array().cast("array<string>").alias("text"),
                            F.array().cast("array<int>").alias("answer_start")))
    example_id = F.col("u.conv_id") * EXAMPLE_ID_STRIDE + F.col("u.turn")
    return joined.select(
        example_id.alias("example_id"),
        example_id.cast("string").alias("id"),
        F.col("u.text").alias("question"),
        F.coalesce(ctx, F.lit("")).alias("context"),
        answers.alias("answers"),
        F.concat(F.lit("conversation "), F.col("u.conv_id").cast("string")).alias("title"),
        F.col("u.conv_id").alias("document_id"),
    )


# Page cleanup patterns (title, dropped blocks, tags).
TITLE_PATTERN = r"(?s)<title>(.*?)</title>"
DROP_BLOCKS_PATTERN = r"(?s)<script.*?</script>|<style.*?</style>"
TAG_PATTERN = r"<[^>]*>"


def store_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document store: every document (no dedup), id = doc_id, meta as columns."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("passage_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
        "lang", "source", "n_chars")


def page_text(html):
    body = F.regexp_replace(F.regexp_replace(html, DROP_BLOCKS_PATTERN, " "), TAG_PATTERN, " ")
    return F.trim(F.regexp_replace(body, r"\s+", " "))


def pages_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as two-field documents: ``passage_id, title, content``."""
    pages = table(spark, sf_dir, "pages")
    return pages.select(F.col("page_id").alias("passage_id"),
                        F.regexp_extract(F.col("html"), TITLE_PATTERN, 1).alias("title"),
                        page_text(F.col("html")).alias("content"), "url")
