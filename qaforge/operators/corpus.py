"""Corpus preparation: first-seen distinct passages, paragraphs, word splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import bounded_broadcast


def distinct_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per distinct text; ``passage_id`` is the smallest id holding it.

    Only (hash, id) rows are grouped: a 32-byte SHA-256 and a number, counted
    partially on the map side, so a text copied into a third of all rows leaves
    each map task as a few rows. What comes out are the texts that occur more
    than once, with their least id; every document is met with that table and
    kept if its text is not in it or it is the one named there. The table is
    broadcast while its size allows (no text is shuffled), joined beyond that.
    Rows that repeat both id and text are merged at the end, only where there
    are such rows; of their other columns the least values are kept.
    Output: ``passage_id long, text string, <keep...>``.
    """
    keyed = docs.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("passage_id"), F.col(text_col).alias("text"), *[F.col(c) for c in keep],
        F.unhex(F.sha2(F.col(text_col), 256)).alias("text_hash"))
    per_id = keyed.groupBy("text_hash", "passage_id").agg(F.count(F.lit(1)).alias("n"))
    # min over ids only: nulls are least here, as in a struct comparison
    least = per_id.groupBy("text_hash").agg(F.min(F.struct("passage_id", "n")).alias("head"), F.sum("n").alias("rows"))
    copied = materialize(least.where("rows > 1").select("text_hash", F.col("head.passage_id").alias("least"), (F.col("head.n") > 1).alias("twice")),
                         "copied-texts")
    met = keyed.join(bounded_broadcast(copied), "text_hash", "left")
    heads = met.where(F.col("twice").isNull() | F.col("passage_id").eqNullSafe(F.col("least")))
    once = heads.where(~F.coalesce("twice", F.lit(False))).select("passage_id", "text", *keep)
    if copied.where("twice").limit(1).count() == 0:
        return once
    packed = F.struct("passage_id", "text", *keep)
    return once.unionByName(heads.where("twice").groupBy("text_hash").agg(F.min(packed).alias("p")).select("p.*"))


def paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               delimiter: str = "\n\n", keep: tuple[str, ...] = ()) -> DataFrame:
    """Split each document on a literal delimiter; blank pieces are dropped.

    Key: (document_id, paragraph_pos) -- stable without a global running
    number. Output: ``document_id, paragraph_pos int, content, <keep...>``.
    """
    pattern = "".join("\\" + ch if not ch.isalnum() else ch for ch in delimiter)
    return (docs.select(F.col(id_col).alias("document_id"), *[F.col(c) for c in keep],
                        F.posexplode(F.split(F.col(text_col), pattern))
                        .alias("paragraph_pos", "content"))
            .where(F.col("content").rlike(r"\S"))
            .select("document_id", F.col("paragraph_pos").cast("int"), "content", *keep))
