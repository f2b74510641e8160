"""Readers for the reference's input formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The corpus fields and their defaults.
META_FIELDS = ("corpus_source", "url", "domain", "title", "author", "html", "document_id")
CORPUS_ENTRY = T.StructType([T.StructField("text", T.StringType())]
                            + [T.StructField(f, T.StringType()) for f in META_FIELDS])
ANSWERS_TYPE = T.StructType([T.StructField("text", T.ArrayType(T.StringType())),
                             T.StructField("answer_start", T.ArrayType(T.IntegerType()))])
PREDICT_SCHEMA = T.StructType([T.StructField("id", T.StringType()),
                               T.StructField("question", T.StringType())])
EVAL_SCHEMA = T.StructType([T.StructField("id", T.StringType()),
                            T.StructField("question", T.StringType()),
                            T.StructField("context", T.StringType()),
                            T.StructField("answers", ANSWERS_TYPE),
                            T.StructField("title", T.StringType()),
                            T.StructField("document_id", T.LongType())])


def read_corpus_object(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object ``{key: {text, ...}}`` per file (S1): ``key`` + fields.

    A single object is one unsplittable task; convert it once to Parquet
    (or JSON Lines, ``read_corpus_lines``) and work from that."""
    raw = spark.read.text(path, wholetext=True)
    parsed = raw.select(F.explode(F.from_json("value", T.MapType(T.StringType(), CORPUS_ENTRY)))
                        .alias("key", "v"))
    return parsed.select("key", "v.*")


def read_corpus_lines(spark: SparkSession, path: str) -> DataFrame:
    """JSON Lines corpus, one ``{key, text, ...}`` record per line (splittable)."""
    schema = T.StructType([T.StructField("key", T.StringType())] + CORPUS_ENTRY.fields)
    return spark.read.schema(schema).json(path)


def to_documents(corpus: DataFrame) -> DataFrame:
    """Content + meta with defaults (S2): missing fields -> '', document_id ->
    the key. Output ``id, content, meta struct<...>``."""
    meta = F.struct(*[F.coalesce(F.col(f), F.col("key") if f == "document_id" else F.lit("")).alias(f)
                      for f in META_FIELDS])
    return corpus.select(F.coalesce(F.col("document_id"), F.col("key")).alias("id"),
                         F.coalesce(F.col("text"), F.lit("")).alias("content"), meta.alias("meta"))


def read_csv_split(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV split with quoted multi-line fields (S4); all columns strings
    unless a schema is given."""
    reader = spark.read.option("header", True).option("multiLine", True) \
        .option("quote", '"').option("escape", '"')
    return reader.schema(schema).csv(path) if schema is not None else reader.csv(path)


def parse_answers(col: Column) -> Column:
    """Stringified answers dict ``{'text': [...], 'answer_start': [...]}`` ->
    struct (S5). Read as lenient JSON, never evaluated as code."""
    return F.from_json(col, ANSWERS_TYPE, {"allowSingleQuotes": "true",
                                          "allowBackslashEscapingAnyCharacter": "true"})


def resolve_column(df: DataFrame, name: str, position: int) -> str:
    """Column by name, else by position."""
    return name if name in df.columns else df.columns[position]


def project_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to a declared schema (P13): cast the named columns, drop the rest."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def load_splits(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Concatenate named splits (U1) with a ``split`` column."""
    out = None
    for name, path in paths.items():
        df = spark.read.parquet(path).withColumn("split", F.lit(name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out
