"""shardwright: corpus, chat, window, evaluation and run-metric jobs on Spark.

Every job is DataFrame / SQL / Structured Streaming code over explicit ordering
keys. Python runs only inside Arrow-batched helpers (byte and BPE encoding,
binary shard export) that Spark partitions and schedules.
"""

__version__ = "0.1.0"
