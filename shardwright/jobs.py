"""End-to-end jobs: read inputs, run the operators, write outputs (S2.12).

    spark-submit -m shardwright.jobs tokenize-corpus --docs DIR --out DIR [--val-tokens N] [--max-tokens N]
    spark-submit -m shardwright.jobs tokenize-chat --conversations DIR --out DIR [--max-len N] ...
    spark-submit -m shardwright.jobs summarize-runs --scalars DIR --out DIR [--run NAME ...]

Each job is a function taking a SparkSession, so it can be called from code
as well. Outputs land in ``--out``; the checkpoint folder comes from
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import logging
import time
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import bpe as B
from .operators import chat as C
from .operators import choice as X
from .operators import corpus as K
from .operators import prompts as P
from .operators import runlog as R
from .operators import vocab as V
from .operators.order import ordinal
from .schemas import BYTES, SEED, ChatSpec, CorpusSpec, id_dtype
from .session import scratch_path
from .sources import manifest as M
from .sources.logs import with_progress
from .sources import token_shards as TS
from .sources import windows as SW
from .streaming.scalars import merge_new_scalars

log = logging.getLogger("shardwright")


def _vocabulary(spark: SparkSession, rank_file: str | None):
    """(ranks, vocabulary) of a rank file, or the byte vocabulary without one."""
    if rank_file is None:
        return None, BYTES
    ranks = B.ranks_dict(B.load_rank_file(spark, rank_file))
    return ranks, B.bpe_vocabulary(ranks, "bpe", rank_file)


#: Counts of a job without a shard: Spark leaves such a plan out, and its counters with it.
NOTHING = {"docs": 0, "tokens": 0}


def _report(name: str, counts: dict, seconds: float) -> None:
    """What a job has written, and how fast."""
    tokens = counts["tokens"] or 0
    log.info("%s: %d rows, %d tokens in %.1f s, %.2f M tokens/s", name, counts["docs"], tokens, seconds, tokens / max(seconds, 1e-9) / 1e6)


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder: encoded once, read by several steps."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def needed_documents(docs: DataFrame, spec: CorpusSpec, encode) -> DataFrame:
    """``encode(documents)`` of those up to the batch in which ``val_tokens`` and ``max_tokens`` are reached.

    The rest is read for its ids alone. One batch is encoded first; the tokens found per
    document tell how many more to take, until both are reached at the end of a whole
    batch. Nothing is encoded twice, and the result of the job is that of all documents.
    """
    if spec.max_tokens is None:
        return encode(docs)
    order = ordinal(docs.select("doc_id").filter(F.col("doc_id").isNotNull()), "doc_id", out="doc_ord").checkpoint()
    total, end, found, before = order.count(), 0, None, None
    need, want = (spec.val_tokens or 0) + spec.max_tokens, spec.batch_docs
    while end < total:
        end = min(total, want)
        last = order.filter(F.col("doc_ord") == end - 1).first()["doc_id"]
        part = docs.filter(F.col("doc_id") <= last)
        part = encode(part if before is None else part.filter(F.col("doc_id") > before))
        found, before = part if found is None else found.unionByName(part), last
        meta = K.document_meta(found)
        split = {r["split"]: r for r in K.split_streams(meta, spec).groupBy("split").agg(
            F.sum("n_kept").alias("kept"), F.count(F.lit(1)).alias("docs")).collect()}
        kept = {s: r["kept"] for s, r in split.items()}
        if (kept.get("train", 0) >= spec.max_tokens and kept.get("val", 0) >= (spec.val_tokens or 0)
                and all(r["docs"] % spec.batch_docs == 0 for r in split.values())):
            break
        tokens = meta.agg(F.sum("n_tokens")).first()[0] or 0
        want = end + spec.batch_docs + (max(0, int((need - tokens) * end / tokens * 1.05)) if tokens else end)
    return encode(docs) if found is None else found


def tokenize_corpus(spark: SparkSession, docs: DataFrame, out_dir: str, spec: CorpusSpec,
                    val_docs: DataFrame | None = None, resume: bool = False) -> DataFrame:
    """Text corpus -> token shards under ``out_dir/shards`` (rows) and
    ``out_dir/bin`` (flat .bin files), ``out_dir/manifest`` and
    ``out_dir/progress`` (E1). With ``spec.rank_file`` documents are encoded by BPE.
    ``spec.val_tokens`` carves val off the front and replaces a shipped val split;
    documents past ``spec.max_tokens`` are neither encoded nor read.

    ``resume`` goes on where a run over the first part of the documents ended:
    shards that were closed then are kept, the open one and all later ones are
    written, and only documents after the closed shards are encoded. The documents
    of the closed ones are read and held against the ledger of the earlier run
    (``out_dir/progress``); it fails if any has changed, came or went, or if batches,
    shards, vocabulary or val carve are of another size. Returns the manifest.
    """
    if spec.val_tokens is not None:
        val_docs = None
    ranks, vocab = _vocabulary(spark, spec.rank_file)
    encode = (lambda d: _stored(B.encode_documents(d, ranks, vocab), "encoded")) if ranks else (lambda d: d)
    rule = f"batches of {spec.batch_docs}, shards of {spec.shard_tokens}, val carve {spec.val_tokens}, {vocab.name} {vocab.text_size}"
    done, todo, old = f"{out_dir}/progress", spec, []
    if resume:
        old = _closed(spark.read.parquet(done), spec, rule)
        _unchanged(docs, val_docs, old)
        docs, val_docs, todo = _after(docs, val_docs, spec, old)
    columns = "split string, shard_id int, file string, tokens long, docs long"
    before = spark.createDataFrame([(r["split"], r["shard_id"], r["file"], r["tokens"], r["docs"]) for r in old], columns) if old else None
    texts, val_texts = docs, val_docs
    docs = needed_documents(docs, todo, encode)
    if ranks:
        val_docs = None if val_docs is None else _stored(B.encode_documents(val_docs, ranks, vocab), "encoded-val")
    streams, sb, shards, man = K.tokenize_corpus(docs, todo, val_docs, vocab, before)
    ranges, cut = K.shard_ranges(streams, sb)
    rows, listed = K.corpus_rows(docs, ranges, cut, vocab.text_size, val_docs)
    rows, counted = with_progress(rows, "n_kept")
    began = time.monotonic()
    TS.write_text_shards(rows, listed, f"{out_dir}/bin", f"{out_dir}/shards", keep=bool(old))
    _report(spec.name, counted.get if listed else NOTHING, time.monotonic() - began)
    _ledger(shards, K.shard_digests(texts, ranges, val_texts), ranges, streams, old, spec, rule, done)
    M.write_manifest(man, f"{out_dir}/manifest")
    return man


def _ledger(shards: DataFrame, digests: DataFrame, ranges: list, streams: DataFrame, old: list, spec: CorpusSpec, rule: str, path: str) -> None:
    """A row per shard, from which a later run can go on: its size, its documents (id range, number, digest), the last
    document that its split has consumed, the cap and the sizes that must be the same."""
    spark = shards.sparkSession
    kind = streams.schema["doc_id"].dataType.simpleString()
    limits = spark.createDataFrame([(r["split"], int(r["shard_id"]), r["first"], r["last"]) for r in ranges],
                                   f"split string, shard_id int, first {kind}, last {kind}")
    consumed = streams.groupBy("split").agg(F.max("doc_id").alias("consumed"))
    new = (shards.select("split", F.col("shard_id").cast("int").alias("shard_id"), "file", "tokens", "docs")
           .join(limits, ["split", "shard_id"]).join(digests, ["split", "shard_id"]).join(consumed, "split")
           .withColumn("cap", F.lit(spec.max_tokens).cast("long")).withColumn("rule", F.lit(rule)))
    if old:
        new = new.unionByName(spark.createDataFrame([[r[c] for c in new.columns] for r in old], new.schema))
    rows = new.collect()  # as many as the manifest lists; the old ledger may be what is overwritten
    spark.createDataFrame(rows, new.schema).coalesce(1).write.mode("overwrite").parquet(path)


def _closed(ledger: DataFrame, spec: CorpusSpec, rule: str) -> list:
    """The shards of an earlier run that no later document can change: those before the first that is not full, ends inside
    a batch or was cut by the cap. A carved val split that is complete counts as closed; one that isn't leaves nothing."""
    rows = ledger.orderBy("split", "shard_id").collect()  # as many as the manifest lists
    if any(r["rule"] != rule for r in rows):
        raise ValueError(f"the earlier run used {rows[0]['rule']}, not {rule}")
    kept = []
    for split in ("train", "val"):
        mine = [r for r in rows if r["split"] == split]
        tokens, docs = sum(r["tokens"] for r in mine), sum(r["docs"] for r in mine)
        if split == "val" and spec.val_tokens is not None:
            if tokens != spec.val_tokens or docs % spec.batch_docs:
                return []
            kept += mine
            continue
        if split == "train" and mine and tokens == mine[-1]["cap"]:
            mine.pop()
        docs = 0
        for r in mine:
            docs += r["docs"]
            if r["tokens"] < spec.shard_tokens or docs % spec.batch_docs:
                break
            kept.append(r)
    return kept


def _unchanged(docs: DataFrame, val_docs: DataFrame | None, old: list) -> None:
    now = {(r["split"], r["shard_id"]): (r["texts"], r["digest"]) for r in K.shard_digests(docs, old, val_docs).collect()} if old else {}
    changed = [r["file"] for r in old if now.get((r["split"], r["shard_id"])) != (r["texts"], r["digest"])]
    if changed:
        raise ValueError(f"the documents of closed shards have changed: {', '.join(changed[:5])}" + ", ..." * (len(changed) > 5))


def _after(docs: DataFrame, val_docs: DataFrame | None, spec: CorpusSpec, old: list):
    """The documents after the closed shards, and what is left to do with them."""
    train, val = ([r for r in old if r["split"] == s] for s in ("train", "val"))
    if val and spec.val_tokens is not None:
        spec = replace(spec, val_tokens=None)
        docs = docs.filter(F.col("doc_id") > F.lit(val[-1]["consumed"]))
    elif val:
        val_docs = val_docs.filter(F.col("doc_id") > F.lit(val[-1]["last"]))
    if train:
        docs = docs.filter(F.col("doc_id") > F.lit(train[-1]["last"]))
        if spec.max_tokens is not None:
            left = spec.max_tokens - sum(r["tokens"] for r in train)
            if left < 0:
                raise ValueError("the closed shards of the earlier run hold more than max_tokens")
            docs, spec = (docs, replace(spec, max_tokens=left)) if left else (docs.limit(0), replace(spec, max_tokens=None))
    return docs, val_docs, spec


def tokenize_chat(spark: SparkSession, turns: DataFrame, out_dir: str, spec: ChatSpec,
                  val_turns: DataFrame | None = None) -> DataFrame:
    """Conversations, a row per turn or nested with a column ``messages`` (S4), ->
    .bin/.mask.bin/.idx.bin shards and a chat manifest (E2); with ``spec.rank_file`` encoded by BPE. Returns the outcome
    counters per split. A separate val table may use the same conversation ids as
    the train table: each split is its own."""
    turns, val_turns = (C.turns_from_messages(t) if t is not None and "messages" in t.columns else t for t in (turns, val_turns))
    ranks, vocab = _vocabulary(spark, spec.rank_file)
    encode = None
    if ranks:
        longest = max(map(len, ranks))
        encode = lambda t: B.encode_turns(C.reachable_turns(t, spec.max_len, longest, vocab), ranks, vocab)
    convs, shards, counters = C.tokenize_chat(turns, spec, val_turns, vocab, encode)
    convs, counted = with_progress(convs)
    began = time.monotonic()
    TS.export_chat_shards(convs, f"{out_dir}/shards", id_dtype(vocab.chat_size), shards)
    _report(spec.name, NOTHING if shards.isEmpty() else counted.get, time.monotonic() - began)
    M.write_manifest(M.chat_manifest(shards, counters, spec, vocab), f"{out_dir}/manifest")
    return counters


def sample_windows(spark: SparkSession, shard_dir: str, block: int, steps: int, accum: int, batch: int,
                   split: str = "train", seed: int = SEED, manifest_dir: str | None = None) -> DataFrame:
    """Training windows (step, micro, row, x, y, tokens_seen) drawn from the flat files of
    the text job (``out/bin``) or the chat job (``out/shards``: windows begin with
    conversations, targets outside the mask are -100) (E4). Sizes and id type are those
    of the manifest, by default the one beside the folder. The number of bytes read
    follows the number of draws. Warns if a chat corpus has conversations longer than
    ``block`` (P18)."""
    manifest_dir = manifest_dir or shard_dir.rstrip("/").rpartition("/")[0] + "/manifest"
    M.warn_if_longer_than_block(M.read_manifest(spark, manifest_dir), block)
    return SW.drawn_windows(spark, shard_dir, manifest_dir, block, steps, accum, batch, split, seed)


def _matching(spark: SparkSession, vocab, manifest_dir: str | None) -> None:
    """Fails unless ``vocab`` is the vocabulary that the manifest records (P20)."""
    if manifest_dir is not None:
        found = M.read_manifest(spark, manifest_dir).first()["encoding"]
        if found.removesuffix("-chat") != vocab.name:
            raise ValueError(f"the corpus is encoded by {found}, not {vocab.name}")


def evaluate_choices(spark: SparkSession, choices: DataFrame, token_losses: DataFrame,
                     out_dir: str | None = None, block: int = 1024, limit: int = 0,
                     rank_file: str | None = None, manifest_dir: str | None = None) -> DataFrame:
    """Choice examples + per-position losses -> per-source report.
    ``choices`` come from ``choice.read_choices``; of the first ``limit`` (0: all),
    those longer than ``block`` ids of the vocabulary (``rank_file``, or bytes) are
    skipped and counted in the column ``skipped``. ``token_losses`` as in
    ``schemas.TOKEN_LOSSES``, of the same vocabulary."""
    ranks, vocab = _vocabulary(spark, rank_file)
    _matching(spark, vocab, manifest_dir)
    fits = X.length_filter(X.render_choices(choices, B.id_columns(spark, ranks, vocab)[0]), block, limit).select("example_id", "kept")
    ex = choices.join(fits, "example_id").select(
        "example_id", F.col("label").cast("int").alias("label"), F.substring_index("source_id", "~", 1).alias("source"), "kept").checkpoint()
    rep = X.report(X.example_picks(X.candidate_scores(token_losses), ex.filter("kept").drop("kept")))
    skipped = ex.rollup("source").agg(F.count_if(~F.col("kept")).alias("skipped"), F.grouping("source").alias("every"))
    skipped = skipped.select(F.when(F.col("every") == 1, "OVERALL").otherwise(F.col("source")).alias("source"), "skipped")
    # A row per source, like the report; sources in order, OVERALL last.
    rep = rep.join(F.broadcast(skipped), "source", "left").orderBy(F.col("source") == "OVERALL", "source")
    if out_dir:
        rep.coalesce(1).write.mode("overwrite").option("header", True).csv(out_dir)
    return rep


def render_prompts(spark: SparkSession, prompts: DataFrame, block: int, chat: bool,
                   rank_file: str | None = None, manifest_dir: str | None = None) -> DataFrame:
    """(prompt_id, prompt[, system]) -> start ids of the vocabulary (``rank_file``, or
    bytes), the last ``block`` of them; it must be the one that the data's manifest
    records. A chat prompt must not be empty; an empty plain one starts a document."""
    ranks, vocab = _vocabulary(spark, rank_file)
    _matching(spark, vocab, manifest_dir)
    ordinary, document = B.id_columns(spark, ranks, vocab)
    system = F.col("system") if "system" in prompts.columns else F.lit(None).cast("string")
    ids = (P.chat_prompt_ids(F.col("prompt"), system, vocab, ordinary) if chat
           else P.plain_prompt_ids(F.col("prompt"), vocab, document))
    return prompts.select("prompt_id", P.keep_tail(ids, block).alias("ids"))


def decode_generations(spark: SparkSession, generations: DataFrame, manifest_dir: str, vocabulary: DataFrame) -> DataFrame:
    """Sampled ids -> (sample_id, text, answer) with the vocabulary that the data's manifest names."""
    man = M.read_manifest(spark, manifest_dir)
    return P.decode_generations(generations, man, vocabulary, bool(man.select("chat").first()[0]))


def summarize_runs(spark: SparkSession, scalars: DataFrame, out_dir: str, train_tag: str = "loss/train",
                   val_tag: str = "loss/val", perf_tags: tuple = (), configs: DataFrame | None = None,
                   peaks: DataFrame | None = None, ms_tag: str = "perf/ms_per_iter", mfu_tag: str = "perf/mfu",
                   lr_tag: str = "lr") -> DataFrame:
    """Scalar logs -> one report for all runs (E5): ``out_dir`` gets the loss CSV of
    runs that have val losses (S16, P16), ``out_dir-step-times`` the seconds between
    logged steps (W10); with ``perf_tags`` also ``out_dir-medians`` (steady medians)
    and ``out_dir-ema`` (smoothed series). With ``configs`` (run, path, seq, text: the
    recorded parameter tables) ``out_dir-utilisation`` gets stored and recomputed
    utilisation, flagged where they differ (F2-F4, A19; ``peaks``: run, peak), and
    ``out_dir-lr`` the learning-rate audit (F1). Returns the loss table."""
    def write(df: DataFrame, part: str) -> None:
        df.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}-{part}")

    merged = R.merge_scalars(scalars).checkpoint()
    has_val = merged.filter(F.col("tag") == val_tag).select("run").distinct()
    table = R.loss_table(merged.join(has_val, "run", "left_semi"), train_tag, val_tag)
    R.write_loss_csv(table, out_dir)
    write(R.step_times(merged, train_tag), "step-times")
    if perf_tags:
        write(R.steady_medians(merged, list(perf_tags), val_tag), "medians")
        write(R.ema(merged, list(perf_tags)), "ema")
    if configs is not None:
        values = has_val.join(R.config_values(R.parse_config(configs)), "run", "left").checkpoint()
        peaks = spark.createDataFrame([], "run string, peak double") if peaks is None else peaks
        write(R.utilisation(merged, values, peaks, ms_tag, mfu_tag, val_tag), "utilisation")
        write(R.lr_audit(merged, values, lr_tag), "lr")
    return table


def _main(argv=None):
    ap = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = ap.add_subparsers(dest="job", required=True)
    a = sub.add_parser("tokenize-corpus")
    a.add_argument("--docs", required=True)
    a.add_argument("--val-docs")
    a.add_argument("--out", required=True)
    a.add_argument("--name", default="corpus")
    a.add_argument("--resume", action="store_true", help="keep the shards that an earlier run closed")
    a.add_argument("--rank-file", help="BPE ranks, base64 token and rank a line; bytes without it")
    a.add_argument("--val-tokens", type=int)
    a.add_argument("--max-tokens", type=int)
    a.add_argument("--batch-docs", type=int, default=CorpusSpec.batch_docs)
    a.add_argument("--shard-tokens", type=int, default=CorpusSpec.shard_tokens)
    b = sub.add_parser("tokenize-chat")
    b.add_argument("--conversations", required=True)
    b.add_argument("--val-conversations")
    b.add_argument("--out", required=True)
    b.add_argument("--name", default="chat")
    b.add_argument("--rank-file")
    b.add_argument("--max-len", type=int, default=ChatSpec.max_len)
    b.add_argument("--max-examples", type=int)
    b.add_argument("--val-examples", type=int, default=ChatSpec.val_examples)
    b.add_argument("--shard-tokens", type=int, default=ChatSpec.shard_tokens)
    e = sub.add_parser("evaluate-choices")
    e.add_argument("--choices", required=True, help="JSON lines")
    e.add_argument("--token-losses", required=True)
    e.add_argument("--out", required=True)
    e.add_argument("--block", type=int, default=1024)
    e.add_argument("--limit", type=int, default=0)
    e.add_argument("--rank-file")
    e.add_argument("--manifest", help="of the corpus whose vocabulary the losses are of")
    r = sub.add_parser("render-prompts")
    r.add_argument("--prompts", required=True, help="text files, a prompt each")
    r.add_argument("--system")
    r.add_argument("--out", required=True)
    r.add_argument("--block", type=int, default=1024)
    r.add_argument("--chat", action="store_true")
    r.add_argument("--rank-file")
    r.add_argument("--manifest")
    g = sub.add_parser("decode-generations")
    g.add_argument("--generations", required=True, help="Parquet: sample_id, prompt, n_prompt, ids[, system]")
    g.add_argument("--manifest", required=True)
    g.add_argument("--out", required=True)
    g.add_argument("--rank-file")
    w = sub.add_parser("sample-windows")
    w.add_argument("--shards", required=True)
    w.add_argument("--out", required=True)
    w.add_argument("--block", type=int, default=1024)
    w.add_argument("--steps", type=int, required=True)
    w.add_argument("--accum", type=int, default=1)
    w.add_argument("--batch", type=int, default=16)
    w.add_argument("--split", default="train")
    w.add_argument("--manifest", help="by default the one beside the shards")
    n = sub.add_parser("merge-scalars", help="brings the merged table up to date from new log files")
    n.add_argument("--scalars", required=True)
    n.add_argument("--out", required=True)
    c = sub.add_parser("summarize-runs")
    c.add_argument("--scalars", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--run", action="append")
    c.add_argument("--perf-tag", action="append", default=[])
    c.add_argument("--configs", help="Parquet: run, path, seq, text (the recorded parameter table)")
    c.add_argument("--peak", action="append", default=[], metavar="RUN=FLOPS")
    args = ap.parse_args(argv)

    logging.basicConfig(level=logging.WARNING)
    log.setLevel(logging.INFO)
    from .session import get_spark
    from .sources.logs import read_prompts, read_scalars
    spark = get_spark()
    if args.job == "tokenize-corpus":
        spec = CorpusSpec(name=args.name, val_tokens=args.val_tokens, max_tokens=args.max_tokens,
                          batch_docs=args.batch_docs, shard_tokens=args.shard_tokens, rank_file=args.rank_file)
        val = spark.read.parquet(args.val_docs).select("doc_id", "text") if args.val_docs else None
        tokenize_corpus(spark, spark.read.parquet(args.docs).select("doc_id", "text"), args.out, spec, val, args.resume)
    elif args.job == "tokenize-chat":
        spec = ChatSpec(name=args.name, max_len=args.max_len, max_examples=args.max_examples,
                        val_examples=args.val_examples, shard_tokens=args.shard_tokens, rank_file=args.rank_file)
        val = spark.read.parquet(args.val_conversations) if args.val_conversations else None
        tokenize_chat(spark, spark.read.parquet(args.conversations), args.out, spec, val)
    elif args.job == "evaluate-choices":
        evaluate_choices(spark, X.read_choices(spark, args.choices), spark.read.parquet(args.token_losses), args.out,
                         args.block, args.limit, args.rank_file, args.manifest)
    elif args.job == "render-prompts":
        prompts = read_prompts(spark, args.prompts).select(
            F.col("prompt_file").alias("prompt_id"), "prompt", F.lit(args.system).cast("string").alias("system"))
        render_prompts(spark, prompts, args.block, args.chat, args.rank_file, args.manifest).write.mode("overwrite").parquet(args.out)
    elif args.job == "decode-generations":
        ranks, vocab = _vocabulary(spark, args.rank_file)
        name = M.read_manifest(spark, args.manifest).first()["encoding"]
        _matching(spark, vocab, args.manifest)
        table = V.bpe_vocab(spark, ranks, name) if ranks else V.byte_vocab(spark, name)
        decode_generations(spark, spark.read.parquet(args.generations), args.manifest, table).write.mode("overwrite").parquet(args.out)
    elif args.job == "sample-windows":
        sample_windows(spark, args.shards, args.block, args.steps, args.accum, args.batch, args.split,
                       manifest_dir=args.manifest) \
            .write.mode("overwrite").parquet(args.out)
    elif args.job == "merge-scalars":
        merge_new_scalars(spark, args.scalars, f"{args.out}/merged", f"{args.out}/checkpoint")
    else:
        peaks = [(run, float(flops)) for run, flops in (p.rsplit("=", 1) for p in args.peak)]
        summarize_runs(spark, read_scalars(spark, args.scalars, args.run), args.out, perf_tags=tuple(args.perf_tag),
                       configs=spark.read.parquet(args.configs) if args.configs else None,
                       peaks=spark.createDataFrame(peaks, "run string, peak double"))


if __name__ == "__main__":
    _main()
