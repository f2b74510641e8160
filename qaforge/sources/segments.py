"""A sparse index in append-only segments.

New passages become a segment of their own: postings, vocabulary and lengths of
those passages only. A passage that is added again, or deleted, gets an entry
(passage_id, before) in a delete list: what segments numbered below ``before``
hold of it is dead. No old segment is rewritten by either. Opening the index
sums the statistics: number and lengths of the live passages, document
frequencies of all segments less those of dead postings; scores equal those of
an index built at once. ``merge`` writes the live postings of some segments as
one, without reading a text. Which segments and delete lists count is named by
a manifest (see ``keyed_store``), so a write that fails changes nothing.
An index without a live passage is an error.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import get_tokenizer
from ..operators.common import bounded_broadcast
from ..operators.index import LEAST_PARTS, SparseIndex, build_index, layout, store_postings
from ..session import materialize, open_bucketed, path_exists
from .keyed_store import commit, newest

MANIFEST = "kind string, number int, folder string, buckets int, n_docs long, total long"


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


class SegmentedIndex:
    def __init__(self, spark: SparkSession, path: str, tokenizer: str = "whitespace", parts: int = LEAST_PARTS):
        """Open the segments at ``path`` or make an index without any."""
        self.spark, self.path = spark, path.rstrip("/")
        if path_exists(spark, f"{self.path}/layout"):
            row = spark.read.parquet(f"{self.path}/layout").first()
            tokenizer, parts = row["tokenizer"], row["parts"]
        else:
            spark.createDataFrame([(tokenizer, parts)], "tokenizer string, parts int").coalesce(1).write.parquet(f"{self.path}/layout")
        self.tokenizer, self.parts = tokenizer, parts

    # --- what there is ------------------------------------------------------------

    def _entries(self, kind: str) -> list:
        return sorted((r for r in newest(self.spark, self.path, MANIFEST) if r["kind"] == kind), key=lambda r: r["number"])

    def segments(self) -> list:
        return self._entries("segment")

    def _next(self) -> int:
        return max((r["number"] for r in newest(self.spark, self.path, MANIFEST)), default=0) + 1

    def deletes(self) -> DataFrame | None:
        """passage_id, before."""
        lists = self._entries("deletes")
        if not lists:
            return None
        return (self.spark.read.parquet(*[r["folder"] for r in lists]).groupBy("passage_id").agg(F.max("before").alias("before")))

    def _live(self, rows: DataFrame, number: int, deletes: DataFrame | None) -> DataFrame:
        if deletes is None:
            return rows
        return rows.join(bounded_broadcast(deletes.where(F.col("before") > number).select("passage_id")), "passage_id", "left_anti")

    def _postings(self, seg) -> DataFrame:
        return open_bucketed(self.spark, f"{seg['folder']}/postings", "passage_id", seg["buckets"], "term", "part")

    def _lengths(self, seg) -> DataFrame:
        return self.spark.read.parquet(f"{seg['folder']}/lengths")

    # --- writing --------------------------------------------------------------------

    def add(self, passages: DataFrame) -> int:
        """A segment of ``passages`` (passage_id, text), which replace those of the same id; returns its number."""
        number, folder = self._next(), f"{self.path}/segments/{uuid.uuid4().hex}"
        index = build_index(passages.select("passage_id", "text"), self.tokenizer, out_dir=folder, parts=self.parts)
        lengths = materialize(index.lengths, path=f"{folder}/lengths")
        total = int(lengths.agg(F.sum("dl")).first()[0] or 0)
        rows = [tuple(r) for r in newest(self.spark, self.path, MANIFEST)]
        rows.append(("segment", number, folder, index.extras["buckets"], index.n_docs, total))
        old = [self._lengths(s).select("passage_id") for s in self.segments()]
        if old:
            again = _union(old).join(lengths.select("passage_id"), "passage_id", "left_semi").distinct()
            rows += self._delete_list(again, number)
        commit(self.spark, self.path, rows, MANIFEST)
        return number

    def _delete_list(self, ids: DataFrame, before: int) -> list[tuple]:
        folder = f"{self.path}/deletes/{uuid.uuid4().hex}"
        written = materialize(ids.select("passage_id", F.lit(before).alias("before")), path=folder)
        n = written.count()
        return [("deletes", before, folder, 0, n, 0)] if n else []

    def delete(self, ids: DataFrame) -> None:
        """Drop the passages whose ids are in ``ids`` (passage_id)."""
        rows = [tuple(r) for r in newest(self.spark, self.path, MANIFEST)]
        commit(self.spark, self.path, rows + self._delete_list(ids.distinct(), self._next()), MANIFEST)

    def merge(self, below: int | None = None) -> int:
        """Write the live postings of the segments with fewer than ``below`` passages (None: of all) as one segment;
        returns how many segments there are now."""
        chosen = [s for s in self.segments() if below is None or s["n_docs"] < below]
        if len(chosen) > 1 or (chosen and below is None and self._entries("deletes")):
            deletes, number, folder = self.deletes(), self._next(), f"{self.path}/segments/{uuid.uuid4().hex}"
            lengths = materialize(_union([self._live(self._lengths(s), s["number"], deletes) for s in chosen]), path=f"{folder}/lengths")
            row = lengths.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("dl"), F.lit(0)).alias("total")).first()
            postings = _union([self._live(self._postings(s), s["number"], deletes).drop("part") for s in chosen])
            buckets, _ = layout(self.spark, row["total"])
            stored = store_postings(postings.repartition(buckets, "passage_id"), buckets, self.parts, folder)
            materialize(stored.groupBy("term").agg(F.count(F.lit(1)).alias("df")), path=f"{folder}/vocab")
            gone = {s["number"] for s in chosen}
            rows = [tuple(r) for r in newest(self.spark, self.path, MANIFEST) if not (r["kind"] == "segment" and r["number"] in gone)]
            if len(gone) == len(self.segments()):  # no older segment is left that a delete list could speak of
                rows = []
            commit(self.spark, self.path, rows + [("segment", number, folder, buckets, row["n"], row["total"])], MANIFEST)
        return len(self.segments())

    # --- reading ----------------------------------------------------------------------

    def open(self) -> SparseIndex:
        """The index of the live passages."""
        segs, deletes = self.segments(), self.deletes()
        n, total = sum(s["n_docs"] for s in segs), sum(s["total"] for s in segs)
        if deletes is not None:
            deletes = materialize(deletes, "segment-deletes")
            dead = lambda rows, s: rows.join(bounded_broadcast(deletes.where(F.col("before") > s["number"]).select("passage_id")), "passage_id", "left_semi")
            row = _union([dead(self._lengths(s), s) for s in segs]).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("dl"), F.lit(0)).alias("t")).first()
            n, total = n - row["n"], total - row["t"]
        if n <= 0:
            raise ValueError("the store is empty: there is nothing to retrieve")
        vocab = _union([self.spark.read.parquet(f"{s['folder']}/vocab").select("term", "df") for s in segs])
        if deletes is not None:
            lost = _union([dead(self._postings(s), s).groupBy("term").agg((-F.count(F.lit(1))).alias("df")) for s in segs])
            vocab = vocab.unionByName(lost)
        vocab = vocab.groupBy("term").agg(F.sum("df").alias("df")).where("df > 0")
        postings = _union([self._live(self._postings(s), s["number"], deletes) for s in segs])
        lengths = _union([self._live(self._lengths(s), s["number"], deletes) for s in segs])
        return SparseIndex(postings=postings, vocab=materialize(vocab, "segment-vocab"), lengths=lengths, n_docs=n, avgdl=total / n,
                           tokenizer=get_tokenizer(self.tokenizer), extras={"parts": self.parts})
