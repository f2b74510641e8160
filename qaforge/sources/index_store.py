"""Persisted index tables and their lifecycle.

An index is written as Parquet tables under one folder -- ``postings``
(folders by term, buckets by passage, see ``operators.index``), ``vocab``,
``lengths`` and a one-row ``stats`` table that also records the layout and the
corpus fingerprint. Reading it back cuts the lineage, so later
queries do not re-tokenize the corpus and survive executor loss.

The fingerprint is computed by Spark over the whole corpus: row count, id
sum, character count and an order-independent XOR of 64-bit row hashes.
A stored index is reused only when the fingerprint and tokenizer match
(the file-existence check alone would reuse a stale index).
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import TOKENIZERS, get_tokenizer
from ..operators.index import SparseIndex, build_index, build_tfidf_index
from ..session import is_complete, open_bucketed, shared_path

# Named in the keys of stored indexes: one of another layout is not opened.
LAYOUT = 2


def fingerprint(df: DataFrame, id_col: str = "passage_id", text_col: str = "text",
                by: list[str] | None = None) -> DataFrame:
    """Per-group (or whole-table) fingerprint columns."""
    aggs = [F.count(F.lit(1)).alias("n_docs"),
            F.sum(F.col(id_col)).alias("id_sum"),
            F.sum(F.length(F.col(text_col))).alias("char_sum"),
            F.bit_xor(F.xxhash64(F.col(id_col), F.col(text_col))).alias("row_hash")]
    return (df.groupBy(*by) if by else df).agg(*aggs)


def portable_fingerprint(df: DataFrame, id_col: str, text_col: str, by: list[str]) -> DataFrame:
    """Fingerprint columns any SQL engine can recompute (no engine-specific hash)."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_docs"),
                               F.sum(F.col(id_col)).alias("id_sum"),
                               F.sum(F.length(F.col(text_col))).cast("long").alias("char_sum"))


def save_index(index: SparseIndex, path: str, fp: dict | None = None, tokenizer_name: str = "whitespace",
               mode: str = "overwrite") -> None:
    spark = index.postings.sparkSession
    (index.postings.sortWithinPartitions("term")
     .write.mode(mode).parquet(f"{path}/postings"))
    index.vocab.write.mode(mode).parquet(f"{path}/vocab")
    index.lengths.write.mode(mode).parquet(f"{path}/lengths")
    row = {"n_docs": index.n_docs, "avgdl": index.avgdl, "tokenizer": tokenizer_name,
           **{f"fp_{k}": v for k, v in (fp or {}).items()}}
    spark.createDataFrame([row]).coalesce(1).write.mode(mode).parquet(f"{path}/stats")


def load_index(spark: SparkSession, path: str) -> tuple[SparseIndex, dict]:
    stats = spark.read.parquet(f"{path}/stats").first().asDict()
    extras = {}
    if stats.get("mean_idf") is not None:
        extras["mean_idf"] = float(stats["mean_idf"])
    if stats.get("kind") == "tfidf":
        extras = {"ngrams": bool(stats["ngrams"]), "max_features": int(stats["max_features"])}
    if stats.get("buckets"):
        extras |= {"buckets": int(stats["buckets"]), "parts": int(stats["parts"])}
        postings = open_bucketed(spark, f"{path}/postings", "passage_id", extras["buckets"], "term", "part")
    else:
        postings = spark.read.parquet(f"{path}/postings")
    index = SparseIndex(postings=postings,
                        vocab=spark.read.parquet(f"{path}/vocab_peaks" if stats.get("kind") == "tfidf" else f"{path}/vocab"),
                        lengths=spark.read.parquet(f"{path}/tokens" if stats.get("kind") else f"{path}/lengths")
                        .select("passage_id", "dl"),
                        n_docs=int(stats["n_docs"]), avgdl=float(stats["avgdl"]),
                        tokenizer=get_tokenizer(stats["tokenizer"]), extras=extras)
    return index, stats


def shared_index(passages: DataFrame, kind: str = "bm25", tokenizer: str = "whitespace",
                 source_key: str | None = None, **params) -> SparseIndex:
    """The index of this corpus, built once per (kind, tokenizer, params,
    corpus) in the shared folder and loaded afterwards, by later sessions too
    (S11, R11). ``source_key`` names the state of the corpus (see
    ``fixtures.source_key``) and costs a file listing; without one, the
    corpus is fingerprinted by a scan. A changed corpus has another key, so a
    stale index is never reused. Named tokenizers only (a callable has no
    stable name)."""
    if tokenizer not in TOKENIZERS:
        raise ValueError("shared_index needs a named tokenizer")
    spark = passages.sparkSession
    fp = {"source": source_key} if source_key else fingerprint(passages).first().asDict()
    key = hashlib.sha1(json.dumps([LAYOUT, kind, tokenizer, params, fp], sort_keys=True,
                                  default=str).encode()).hexdigest()[:20]
    path = shared_path(spark, f"index-{kind}-{key}")
    if index_exists(spark, path):
        return load_index(spark, path)[0]
    return build_and_save(passages, path, kind, tokenizer, fp, **params)


def build_and_save(passages: DataFrame, path: str, kind: str = "bm25", tokenizer: str = "whitespace",
                   fp: dict | None = None, **params) -> SparseIndex:
    """Build an index straight into ``path`` (each table written once) and
    record its statistics; ``load_index(path)`` reads it back."""
    spark = passages.sparkSession
    if kind == "bm25":
        from ..operators.retrieve import okapi_mean_idf
        index = build_index(passages, tokenizer, out_dir=path)
        row = {"kind": kind, "ngrams": False, "max_features": 0}
        if tokenizer == "whitespace":      # Okapi's index; others compute it on demand
            index.extras["mean_idf"] = okapi_mean_idf(index)
            row["mean_idf"] = index.extras["mean_idf"]
    elif kind == "tfidf":
        index = build_tfidf_index(passages, tokenizer, out_dir=path, **params)
        row = {"kind": kind, "ngrams": bool(index.extras["ngrams"]),
               "max_features": int(index.extras["max_features"])}
    else:
        raise ValueError(f"unknown index kind {kind!r}")
    if not index.n_docs:
        raise ValueError("the store is empty: there is nothing to retrieve")
    row.update({"n_docs": index.n_docs, "avgdl": float(index.avgdl), "tokenizer": tokenizer,
                "buckets": index.extras["buckets"], "parts": index.extras["parts"],
                **{f"fp_{k}": v for k, v in (fp or {}).items()}})
    # the stats table is written last: its presence marks a complete index
    spark.createDataFrame([row]).coalesce(1).write.mode("overwrite").parquet(f"{path}/stats")
    return index


def index_exists(spark: SparkSession, path: str) -> bool:
    return is_complete(spark, f"{path}/stats")  # written last


def load_or_build(spark: SparkSession, passages: DataFrame, path: str,
                  build: Callable[[DataFrame], SparseIndex], tokenizer_name: str = "whitespace") -> SparseIndex:
    """Reuse the stored index when its fingerprint and tokenizer match the
    corpus; otherwise (or when absent) build, write and re-read it (R11)."""
    fp = fingerprint(passages).first().asDict()
    if index_exists(spark, path):
        index, stats = load_index(spark, path)
        stored = {k[3:]: v for k, v in stats.items() if k.startswith("fp_")}
        if stats.get("tokenizer") == tokenizer_name and stored == fp:
            return index
    save_index(build(passages), path, fp, tokenizer_name)
    return load_index(spark, path)[0]


def stale_groups(stored: DataFrame, current: DataFrame, by: list[str]) -> DataFrame:
    """Groups whose stored fingerprint differs from the current one, or
    exists on one side only (what an incremental refit rebuilds)."""
    cols = [c for c in stored.columns if c not in by]
    s = stored.select(*by, F.struct(*cols).alias("s"))
    c = current.select(*by, F.struct(*cols).alias("c"))
    return s.join(c, by, "full").where(~F.col("s").eqNullSafe(F.col("c"))).select(*by)


# ---- index tables in the catalog (S12-S14) ---------------------------------

def create_index_table(df: DataFrame, name: str, properties: dict | None = None,
                       if_absent: bool = True) -> bool:
    """Create a named index table; returns False if it existed and was kept."""
    spark = df.sparkSession
    if if_absent and spark.catalog.tableExists(name):
        return False
    df.write.mode("overwrite").saveAsTable(name)
    if properties:
        set_index_properties(spark, name, properties)
    return True


def drop_index_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def write_rows(df: DataFrame, name: str) -> int:
    """Add documents or labels to a named table (S14); returns its row count."""
    df.write.mode("append").saveAsTable(name)
    return df.sparkSession.table(name).count()


def clear_table(spark: SparkSession, name: str) -> None:
    """Remove all rows of a named table and keep the table."""
    spark.sql(f"TRUNCATE TABLE {name}")


def list_index_tables(spark: SparkSession) -> list[str]:
    return [t.name for t in spark.catalog.listTables()]


def index_properties(spark: SparkSession, name: str) -> dict:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def set_index_properties(spark: SparkSession, name: str, properties: dict) -> None:
    quoted = lambda x: "'" + str(x).replace("\\", "\\\\").replace("'", "\\'") + "'"
    pairs = ", ".join(f"{quoted(k)} = {quoted(v)}" for k, v in properties.items())
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")


def write_with_rejects(df: DataFrame, good: F.Column, name: str, reject_name: str) -> tuple[int, int]:
    """Load rows into a named table; rows failing ``good`` go to a reject
    table instead of stopping the load. Returns (stored, rejected) counts."""
    flagged = df.withColumn("_ok", F.coalesce(good, F.lit(False)))
    flagged.where("_ok").drop("_ok").write.mode("overwrite").saveAsTable(name)
    flagged.where(~F.col("_ok")).drop("_ok").write.mode("overwrite").saveAsTable(reject_name)
    spark = df.sparkSession
    return spark.table(name).count(), spark.table(reject_name).count()
