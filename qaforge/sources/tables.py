"""Table readers with explicit schemas (no inference on hot paths)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SCHEMAS: dict[str, T.StructType] = {
    "documents": T.StructType([
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]),
    "benchmark": T.StructType([
        T.StructField("item_id", T.LongType()),
        T.StructField("text", T.StringType()),
    ]),
    "conversations": T.StructType([
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ]),
    "embeddings": T.StructType([
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
    ]),
    "labels": T.StructType([
        T.StructField("doc_id", T.LongType()),
        T.StructField("quality", T.IntegerType()),
        T.StructField("toxic", T.IntegerType()),
    ]),
    "pages": T.StructType([
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the given parquet tables by name."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(path)
