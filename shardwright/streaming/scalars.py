"""Growing scalar logs: last write wins, kept up to date from new files alone.

The merge of all files is a streaming aggregation: its state, spread over the
shuffle partitions by (run, tag, step), holds the winner of each key with its
place (path, seq), so a file that arrives late but ranks earlier changes
nothing. Each micro-batch writes the keys whose winner it has touched to a
partition of its own, ``batch=N``; one that is run again after a failure
overwrites it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import SCALARS

KEY = ["run", "tag", "step"]


def merge_new_scalars(spark: SparkSession, log_dir: str, out_dir: str, checkpoint: str, files_per_batch: int | None = None) -> DataFrame:
    """Reads the files that came to ``log_dir`` since the last call with this
    ``checkpoint``, and returns the merged table (run, tag, step, value, wall_time)
    of all files, equal to ``runlog.merge_scalars`` over them."""
    reader = spark.readStream.schema(SCALARS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.parquet(log_dir).withColumn("path", F.coalesce("path", F.col("_metadata.file_path")))
    merged = rows.groupBy(*KEY).agg(F.max_by(F.struct("value", "wall_time"), F.struct("path", "seq")).alias("last"))

    def write_batch(df: DataFrame, batch_id: int):
        df.select(*KEY, "last.*").write.mode("overwrite").parquet(f"{out_dir}/batch={batch_id}")

    (merged.writeStream.outputMode("update").foreachBatch(write_batch)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())
    return merged_scalars(spark, out_dir)


def merged_scalars(spark: SparkSession, out_dir: str) -> DataFrame:
    """The merged table as of the last batch: the newest winner of each key."""
    schema = T.StructType([SCALARS[c] for c in (*KEY, "value", "wall_time")]).add("batch", "long")
    last = F.max_by(F.struct("value", "wall_time"), "batch").alias("last")
    return spark.read.schema(schema).parquet(out_dir).groupBy(*KEY).agg(last).select(*KEY, "last.*")
