"""Scalar logs, prompts and progress counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def metrics_to_scalars(wide: DataFrame, run: str, path: str, metric_cols: list[str],
                       step_col: str = "step", time_col: str = "wall_time") -> DataFrame:
    """Unpivot a wide metrics table into scalar-log rows (S13); null metrics
    (not logged at that step) are dropped. ``seq`` follows the step, then the
    metric's place in ``metric_cols``."""
    place = F.array_position(F.array(*[F.lit(c) for c in metric_cols]), F.col("tag")) - 1
    long = wide.unpivot([step_col, time_col], metric_cols, "tag", "value")
    return long.filter(F.col("value").isNotNull()).select(
        F.lit(run).alias("run"), F.lit(path).alias("path"),
        (F.col(step_col) * len(metric_cols) + place).cast("long").alias("seq"), "tag", F.col(step_col).cast("long").alias("step"),
        F.col("value").cast("double").alias("value"), F.col(time_col).alias("wall_time"))


def append_scalars(scalars: DataFrame, root: str) -> None:
    """Append to the scalar-log table, one directory per run."""
    scalars.write.mode("append").partitionBy("run").parquet(root)


def read_scalars(spark: SparkSession, root: str, runs: list[str] | None = None) -> DataFrame:
    """Every run under ``root``, or the named ones; the run filter prunes
    directories (S19). ``path`` is the file each row came from (S12)."""
    df = spark.read.parquet(root)
    if runs:
        df = df.filter(F.col("run").isin(runs))
    if "path" not in df.columns:
        df = df.withColumn("path", F.col("_metadata.file_path"))
    return df


def read_prompts(spark: SparkSession, path: str) -> DataFrame:
    """Prompt files, one prompt per whole file."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("prompt_file"), F.col("value").alias("prompt"))


def with_progress(df: DataFrame, tokens_col: str = "n_tokens") -> tuple[DataFrame, Observation]:
    """Attach progress counters (documents, tokens) that fill in when the job
    runs (S17): ``obs.get`` after the action."""
    obs = Observation("progress")
    return df.observe(obs, F.count(F.lit(1)).alias("docs"), F.sum(tokens_col).alias("tokens")), obs
