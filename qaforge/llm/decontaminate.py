"""Benchmark decontamination by size-partitioned MinHash containment search [native].

A document leaks a test item when it holds at least 80 % of the item's
distinct five-word shingles, however long the document is. Jaccard MinHash
fails here (a short item inside a long document has a Jaccard similarity
near 0), so items are partitioned by size and sketched one-sidedly: an item
of a size class with at most u shingles is represented by the k(u) = u -
ceil(0.8 u) + 1 shingles with the smallest hashes (its bottom-k MinHash). A
document that misses at most u - ceil(0.8 u) of the item's shingles holds one
of these at least, so probing the documents' shingle hashes against the
sketches loses nothing. Candidate (document, item) pairs are verified by
exact containment of the shingles themselves, as strings.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a text of one to four
words has its whole sequence as its one shingle, so an item that short is found
in documents with the same words and no others. Only built-in expressions run
here. Sketches, candidates and shingle lists are broadcast after their
rows or bytes were counted (``SKETCH_ROWS``, ``FOUND_ROWS``, ``GRAM_BYTES``);
beyond that they are shuffled, shingle lists with salts for hot items.
Candidates, not documents, are grouped.

Defined cases: a null or blank text or item has no shingles and never
matches; repeated rows of documents or items give one pair (the smallest
doc_id stands for nothing: every different doc_id is reported); a null doc_id
or item_id is an id like any other; items with equal text are separate items;
empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .url_filter import LOWER, UPPER

SKETCH_ROWS = 200_000
FOUND_ROWS = 500_000
GRAM_BYTES = 64 << 20
SALTS = 64
NUM, DEN = 8, 10


def words(text: Column) -> Column:
    return F.filter(F.split(F.translate(text, UPPER, LOWER), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def shingles(w: Column, make) -> Column:
    """``make`` of the words at i..i+4 of every i (of all words if there are fewer than five)."""
    at = F.sequence(F.lit(1), F.greatest(F.size(w) - 4, F.lit(1)))
    return F.when(F.size(w) > 0, F.transform(at, make)).otherwise(F.array())


def shingle_strings(w: Column) -> Column:
    return F.array_distinct(shingles(w, lambda i: F.array_join(F.slice(w, i, F.lit(5)), " ")))


def shingle_hashes(w: Column) -> Column:
    return shingles(w, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(-1, 4)]))


def item_sketches(items: DataFrame) -> DataFrame:
    """item_id, n, grams (the shingles) and sketch (the least hashes) of every different item with shingles."""
    w = items.select("item_id", "text").where("text is not null").distinct().select(
        "item_id", words(F.col("text")).alias("w"))
    sized = (w.select("item_id", shingle_strings(F.col("w")).alias("grams"),
                      F.array_distinct(shingle_hashes(F.col("w"))).alias("hashes"))
             .withColumn("n", F.size("grams")).where("n > 0"))
    # size classes grow by a quarter; the class bound sets the sketch length
    bound = F.ceil(F.pow(F.lit(1.25), F.ceil(F.log(F.col("n")) / F.log(F.lit(1.25)) - 1e-9))).cast("int")
    sized = sized.withColumn("bound", F.greatest(bound, "n"))
    k = F.col("bound") - F.ceil(F.col("bound") * NUM / DEN).cast("int") + 1
    return sized.select("item_id", "n", "grams", F.slice(F.array_sort("hashes"), F.lit(1), k).alias("sketch"))


def documents_words(docs: DataFrame) -> DataFrame:
    """doc_id, text hash and words; the words are one column, read by what follows, not computed again for every shingle."""
    return docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("t"), words(F.col("text")).alias("w"))


def candidates(docs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Distinct (doc_id, text hash, item_id) with a sketch hash among the document's shingle hashes."""
    hashed = documents_words(docs).select("doc_id", "t", F.explode(shingle_hashes(F.col("w"))).alias("h"))
    slim = sketches.select("item_id", F.explode("sketch").alias("h")).distinct()
    if slim.limit(SKETCH_ROWS + 1).count() <= SKETCH_ROWS:
        slim = F.broadcast(slim)
    return hashed.join(slim, "h").select("doc_id", "t", "item_id").distinct()


def leaking_texts(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, t (text hash), item_id, n_item, n_common, containment of every leak."""
    docs = docs.select("doc_id", "text")
    sketches = materialize(item_sketches(items), "decontaminate-items")
    found = materialize(candidates(docs, sketches).groupBy("doc_id", "t").agg(F.collect_set("item_id").alias("items"),
                                                                             F.count_if(F.col("item_id").isNull()).alias("nameless")),
                        "decontaminate-candidates")
    # null ids are no set members
    found = found.select(F.col("doc_id").alias("_doc"), F.col("t").alias("_t"), F.when(
        F.col("nameless") > 0, F.concat("items", F.array(F.lit(None).cast(sketches.schema["item_id"].dataType))))
        .otherwise(F.col("items")).alias("items"))
    if found.limit(FOUND_ROWS + 1).count() <= FOUND_ROWS:
        found = F.broadcast(found)
    # documents without a candidate leave before their words are made
    live = (docs.where("text is not null").withColumn("t", F.xxhash64("text"))
            .join(found, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("t") == F.col("_t")))
            .select("doc_id", "t", "text", "items").distinct()
            .select("doc_id", "t", "items", words(F.col("text")).alias("w")))
    pairs = live.select("doc_id", "t", shingle_strings(F.col("w")).alias("own"), F.explode("items").alias("item"))
    grams = sketches.select("item_id", "n", "grams").distinct()
    size = sketches.agg(F.sum(F.expr("aggregate(grams, 0L, (a, g) -> a + length(g) + 16)"))).first()[0] or 0
    if size <= GRAM_BYTES:
        met = pairs.join(F.broadcast(grams), F.col("item").eqNullSafe(F.col("item_id")))
    else:  # a hot item meets its documents in SALTS places
        salted = grams.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = pairs.withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).join(
            salted, F.col("item").eqNullSafe(F.col("item_id")) & (F.col("_salt") == F.col("salt")))
    return (met.withColumn("n_common", F.size(F.array_intersect("own", "grams")))
            .where(F.col("n_common") * DEN >= F.col("n") * NUM)
            .select("doc_id", "t", "item_id", F.col("n").alias("n_item"), "n_common",
                    F.round(F.col("n_common") / F.col("n"), 6).alias("containment")).distinct())


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, n_item, n_common, containment of every leak."""
    return leaking_texts(docs, items).drop("t").distinct()


def remove_leaking(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text leaks an item (rows with the same id and another text stay)."""
    bad = materialize(leaking_texts(docs, items).select(F.col("doc_id").alias("_bad"), "t").distinct(), "decontaminate-bad")
    if bad.limit(FOUND_ROWS + 1).count() <= FOUND_ROWS:
        bad = F.broadcast(bad)
    keyed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.xxhash64("text").alias("_t"))
    return keyed.join(bad, F.col("row.doc_id").eqNullSafe(F.col("_bad")) & (F.col("_t") == F.col("t")), "left_anti").select("row.*")


def _grams(name: str, source: str, key: str) -> str:
    return f"""
{name}_w AS (SELECT DISTINCT {key}, text, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM {source} WHERE text IS NOT NULL),
{name} AS (SELECT DISTINCT {key}, text, unnest(CASE WHEN len(w) = 0 THEN [] ELSE list_transform(range(1, greatest(len(w) - 4, 1) + 1),
    lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM {name}_w)"""


ORACLE = f"""
WITH {_grams('d', 'documents', 'doc_id')}, {_grams('b', 'benchmark', 'item_id')},
size AS (SELECT item_id, text, count(*) AS n FROM b GROUP BY ALL),
pair AS (SELECT d.doc_id, d.text AS doc, b.item_id, b.text, count(*) AS c FROM d JOIN b ON d.g = b.g GROUP BY ALL)
SELECT DISTINCT doc_id, item_id, n::INTEGER AS n_item, c::INTEGER AS n_common, round(c / n, 6) AS containment
FROM pair JOIN size USING (item_id, text) WHERE 10 * c >= 8 * n
"""
