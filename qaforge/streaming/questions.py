"""Retrieval over a stream of question files (Structured Streaming).

Questions arrive as Parquet files in a folder; every micro-batch is scored
against the static, stored index with the same batch operator and appended
to a Parquet sink. Writes are keyed by batch id and overwrite that batch's
folder, so a batch replayed after a failure leaves one copy (exactly-once
output with the checkpointed offsets).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators import retrieve as R
from ..operators.index import SparseIndex
from ..session import shared_path

QUESTION_SCHEMA = T.StructType([T.StructField("qid", T.LongType()),
                                T.StructField("question", T.StringType())])


def retrieve_stream(spark: SparkSession, index: SparseIndex, source_dir: str, sink_dir: str,
                    method: str = "bm25", k: int = R.DEFAULT_K, checkpoint: str | None = None,
                    available_now: bool = True, max_files_per_trigger: int = 64):
    """Start the stream; returns the ``StreamingQuery``."""
    stream = (spark.readStream.schema(QUESTION_SCHEMA)
              .option("maxFilesPerTrigger", max_files_per_trigger).parquet(source_dir))

    def score_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        ranked = R.retrieve(index, batch, method, k)
        ranked.write.mode("overwrite").parquet(f"{sink_dir}/batch={batch_id}")

    writer = (stream.writeStream.foreachBatch(score_batch)
              .option("checkpointLocation", checkpoint or shared_path(spark, "stream-checkpoint")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
