"""Writers (S6-S10, S15). All are distributed writes, one file per task;
nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def export_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV export of a split (S6); struct/array columns become JSON text."""
    cols = [F.to_json(F.col(f.name)).alias(f.name)
            if f.dataType.typeName() in ("struct", "array", "map") else F.col(f.name)
            for f in df.schema.fields]
    (df.select(*cols).write.mode(mode).option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON Lines."""
    df.write.mode(mode).json(path)


def write_predictions(predictions: DataFrame, nbest: DataFrame | None, null_odds: DataFrame | None,
                      out_dir: str, prefix: str = "", mode: str = "overwrite") -> None:
    """Predictions, n-best lists and null-odds as JSON Lines (S8). The
    prefix is part of the file name (Q11)."""
    name = (prefix + "_") if prefix else ""
    write_json(predictions, f"{out_dir}/{name}predictions", mode)
    if nbest is not None:
        write_json(nbest, f"{out_dir}/{name}nbest_predictions", mode)
    if null_odds is not None:
        write_json(null_odds, f"{out_dir}/{name}null_odds", mode)


def top_answers(answers: DataFrame, id_col: str = "id") -> DataFrame:
    """id -> the rank-1 answer."""
    return answers.where(F.col("rank") == 1).select(id_col, F.col("text").alias("prediction_text"))


def write_by_difficulty(split: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Easy / hard examples as one Parquet table partitioned by difficulty."""
    split.write.mode(mode).partitionBy("difficulty").parquet(path)


def save_stage_results(stages: dict[str, DataFrame], out_dir: str, mode: str = "overwrite") -> None:
    """Per-stage evaluation tables as CSV."""
    for stage, df in stages.items():
        export_csv(df, f"{out_dir}/{stage}", mode)
