"""Headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each job runs to completion through the ``noop`` sink (full execution, nothing
collected), after one warm-up of the JVM and the Python workers. Rates: byte
tokens/s and MB of text/s for the text job, MB/s for BPE encoding and decoding,
tokens/s for the chat job, windows/s for window sampling, scored examples/s for
choice evaluation.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from shardwright.plans.registry import load_all  # noqa: E402
from shardwright.session import get_spark  # noqa: E402

HEADLINE = [
    ("tokenize_corpus", "text_shard_files"),
    ("tokenize_chat", "shard_file_roundtrip"),
    ("sample_windows", "window_gather"),
    ("chat_windows", "chat_window_targets"),
    ("evaluate_choices", "choice_report"),
    ("summarize_runs", "utilisation"),
    ("loss_table", "loss_table"),
    ("bpe_encode", "bpe_roundtrip"),
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(f"local[{cpus}]", int(cpus))
    qs, _ = load_all()
    times, rates = {}, {}
    # Warm the JVM and the Python workers once so the first job is not charged for it.
    from shardwright.functions.tokens import utf8_ids
    from shardwright.session import spread
    warm = spread(spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    warm.select(F.size(utf8_ids("text")).alias("n")).agg(F.sum("n")).collect()
    for label, name in HEADLINE:
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[label] = round(time.time() - t0, 3)
        spark.catalog.clearCache()
    # Volumes for rates (from the job outputs, outside the timed region).
    man = qs["split_manifest"](spark, sf_dir).agg(F.sum("tokens")).first()[0] or 0
    chat = qs["chat_manifest"](spark, sf_dir).agg(F.sum("tokens")).first()[0] or 0
    n_win = qs["window_gather"](spark, sf_dir).count()
    n_ex = qs["choice_picks"](spark, sf_dir).count()  # examples that were scored
    text_mb = spark.read.parquet(f"{sf_dir}/documents.parquet").agg(F.sum(F.octet_length("text"))).first()[0] / 1e6
    rates["tokenize_corpus_tokens_per_s"] = round(man / times["tokenize_corpus"], 1)
    rates["tokenize_corpus_mb_per_s"] = round(text_mb / times["tokenize_corpus"], 2)
    rates["bpe_encode_mb_per_s"] = round(text_mb / times["bpe_encode"], 2)
    rates["tokenize_chat_tokens_per_s"] = round(chat / times["tokenize_chat"], 1)
    rates["sample_windows_per_s"] = round(n_win / times["sample_windows"], 1)
    rates["evaluate_choices_examples_per_s"] = round(n_ex / times["evaluate_choices"], 1)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_jobs_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "rates": rates, "sf": sf, "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
