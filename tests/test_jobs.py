import glob
import os
from dataclasses import replace

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from shardwright import jobs
from shardwright.functions import bpe as B
from shardwright.operators import choice as X
from shardwright.operators import runlog as R
from shardwright.plans import chat_queries as CQ
from shardwright.operators import vocab as V
from shardwright.operators import windows as W
from shardwright.schemas import ChatSpec, CorpusSpec
from shardwright.session import scratch_path
from shardwright.sources import manifest as M
from shardwright.sources import token_shards as TS

SF = "/root/testdata/sf0.001"


def test_tokenize_corpus_job(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    out = scratch_path(spark, "job-text")
    spec = CorpusSpec(name="t", batch_docs=16, shard_tokens=60_000, val_tokens=30_000)
    jobs.tokenize_corpus(spark, docs, out, spec)
    man = M.read_manifest(spark, f"{out}/manifest").first()
    shards = spark.read.parquet(f"{out}/shards")
    written = {r.split: r.t for r in shards.groupBy("split").agg((F.sum(F.octet_length("tokens")) / 2).alias("t")).collect()}
    assert written == {k: v.tokens for k, v in man.splits.items()}
    assert man.splits["val"].tokens == 30_000 and man.dtype == "uint16"


def test_tokenize_chat_and_eval_and_runs_jobs(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    out = scratch_path(spark, "job-chat")
    counters = {r.split: r for r in jobs.tokenize_chat(spark, turns, out, CQ.CHAT_SPEC).collect()}
    man = M.read_manifest(spark, f"{out}/manifest", require_chat=True).first()
    assert set(man.splits) == set(counters)
    for split, c in counters.items():
        assert man.splits[split].examples == c.kept and man.splits[split].tokens == c.tokens
    # Choice evaluation from a token-loss table.
    ch = X.choices_from_benchmark(spark.read.parquet(f"{SF}/benchmark.parquet"))
    pairs, uni = X.bigram_table(spark.read.parquet(f"{SF}/documents.parquet"))
    losses = X.token_losses(X.render_choices(ch), pairs, uni)
    rep = {r.source: r.n for r in jobs.evaluate_choices(spark, ch, losses).collect()}
    assert rep["OVERALL"] == ch.count() == rep["even"] + rep["odd"]
    # Run summary CSV.
    sc = R.scalars_from_events(spark.read.parquet(f"{SF}/events.parquet"))
    t = jobs.summarize_runs(spark, sc, scratch_path(spark, "job-runs"), "view", "click")
    assert t.count() > 0


def test_cli_tokenize_corpus(spark):
    out = scratch_path(spark, "cli-text")
    jobs._main(["tokenize-corpus", "--docs", f"{SF}/documents.parquet", "--out", out,
                "--val-tokens", "20000", "--batch-docs", "32", "--shard-tokens", "100000"])
    man = M.read_manifest(spark, f"{out}/manifest").first()
    assert man.splits["val"].tokens == 20_000
    assert man.splits["val"].tokens + man.splits["train"].tokens <= 496_092


def _rows(n, first=0, step=1):
    return [(first + step * i, f"text number {i} " * (i % 5 + 1)) for i in range(n)]


def _written(spark, out):
    """Tokens of each split as written, by doc_id, and the manifest."""
    man = M.read_manifest(spark, f"{out}/manifest").first()
    got = {}
    for r in spark.read.parquet(f"{out}/shards").orderBy("split", "shard_id", "doc_id").collect():
        got.setdefault(r.split, []).append((r.doc_id, bytes(r.tokens)))
    return got, man


def _ids(text):
    return np.array([*text.encode(), 256], "<u2").tobytes()


def test_text_job_with_a_cap_writes_exactly_the_cap(spark):
    out, rows = scratch_path(spark, "job-cap"), _rows(40)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    jobs.tokenize_corpus(spark, docs, out, CorpusSpec(name="t", batch_docs=4, shard_tokens=300, max_tokens=1000))
    got, man = _written(spark, out)
    flat = b"".join(t for _, t in got["train"])
    assert flat == b"".join(_ids(t) for _, t in rows)[:2000] and man.splits["train"].tokens == 1000
    files = {f.file for f in man.splits["train"].shards}
    binary = spark.read.format("binaryFile").load(f"{out}/bin/*.bin").orderBy("path").collect()
    assert {r.path.rsplit("/", 1)[1] for r in binary} == files and b"".join(bytes(r.content) for r in binary) == flat


def test_carved_val_replaces_a_shipped_one(spark):
    out, rows = scratch_path(spark, "job-both-val"), _rows(30)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spec = CorpusSpec(name="t", batch_docs=4, shard_tokens=300, val_tokens=200)
    jobs.tokenize_corpus(spark, docs, out, spec, val_docs=spark.createDataFrame([(0, "other")], "doc_id long, text string"))
    got, _ = _written(spark, out)
    assert b"".join(t for _, t in got["val"]) == b"".join(_ids(t) for _, t in rows)[:400]
    assert not {d for d, _ in got["val"]} & {d for d, _ in got["train"]}


def test_shipped_val_may_share_ids_with_train(spark):
    out, rows = scratch_path(spark, "job-val"), _rows(10)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    val = spark.createDataFrame([(i, "val " + t) for i, t in rows[:4]], "doc_id long, text string")
    jobs.tokenize_corpus(spark, docs, out, CorpusSpec(name="t", batch_docs=4, shard_tokens=300), val)
    got, _ = _written(spark, out)
    assert got == {"train": [(i, _ids(t)) for i, t in rows], "val": [(i, _ids("val " + t)) for i, t in rows[:4]]}


def test_text_job_with_large_ids_and_without_documents(spark):
    out, rows = scratch_path(spark, "job-big"), _rows(20, 2 ** 60, 1)
    jobs.tokenize_corpus(spark, spark.createDataFrame(rows, "doc_id long, text string"), out,
                         CorpusSpec(name="t", batch_docs=2, shard_tokens=100))
    got, _ = _written(spark, out)
    assert got["train"] == [(i, _ids(t)) for i, t in rows]
    out = scratch_path(spark, "job-empty")
    man = jobs.tokenize_corpus(spark, spark.createDataFrame([], "doc_id long, text string"), out, CorpusSpec(name="t"))
    assert not man.first().splits


def test_text_and_chat_jobs_with_bpe(spark):
    import public_tokenizers
    rank_file = "file://" + public_tokenizers.path("byte_bpe_50k.tiktoken")
    from tokenizers import Tokenizer
    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out, rows = scratch_path(spark, "job-bpe"), _rows(12)
    jobs.tokenize_corpus(spark, spark.createDataFrame(rows, "doc_id long, text string"), out,
                         CorpusSpec(name="t", batch_docs=4, shard_tokens=60, rank_file=rank_file))
    got, man = _written(spark, out)
    assert [np.frombuffer(t, "<u2").tolist() for _, t in got["train"]] == [other.encode(t).ids + [50256] for _, t in rows]
    assert (man.encoding, man.vocab_size, man.eot_token) == ("bpe", 50257, 50256)
    turns = [(1, 0, "user", "hello there"), (1, 1, "assistant", "general reply"), (2, 0, "user", "x")]
    out = scratch_path(spark, "job-chat-bpe")
    counters = jobs.tokenize_chat(spark, spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"), out,
                                  ChatSpec(name="c", max_len=64, val_examples=None, rank_file=rank_file)).first()
    assert (counters.seen, counters.kept, counters.dropped) == (2, 1, 1)
    TS.register(spark)
    row = spark.read.format("token_shard").load(f"{out}/shards").first()
    e = lambda t: other.encode(t).ids
    want = [50257, *e("user\n"), *e("hello there"), 50258, 198, 50257, *e("assistant\n"), *e("general reply"), 50258, 198]
    assert row.tokens == want and sum(row["mask"]) == len(e("general reply")) + 1


def test_sample_windows_job_reads_the_shards(spark):
    out, rows = scratch_path(spark, "job-windows"), _rows(60)
    jobs.tokenize_corpus(spark, spark.createDataFrame(rows, "doc_id long, text string"), out,
                         CorpusSpec(name="t", batch_docs=4, shard_tokens=400))
    got, man = _written(spark, out)
    stream = np.frombuffer(b"".join(t for _, t in got["train"]), "<u2").tolist()
    starts, shards = 0, {}
    for f in man.splits["train"].shards:
        shards[int(f.file[-10:-4])] = stream[starts:starts + f.tokens]
        starts += f.tokens
    win = jobs.sample_windows(spark, f"{out}/bin", 32, 3, 2, 4).collect()
    assert len(win) == 24
    for r in win:
        s = shards[r.shard_id]
        assert r.x == s[r.start:r.start + 32] and r.y == s[r.start + 1:r.start + 33]


def test_choice_file_to_report(spark):
    import json
    import os
    d = scratch_path(spark, "choice-file").removeprefix("file:")
    os.makedirs(d)
    for part in range(2):
        with open(f"{d}/{part}.jsonl", "w") as f:
            for i in range(5):
                n = part * 5 + i
                f.write(json.dumps({"ctx": "c" * (50 if n == 3 else 5), "endings": [f"end {n} {k}" for k in range(3)],
                                    "label": str(n % 3), "source_id": f"src{n % 2}~{n}"}) + "\n")
    ch = X.read_choices(spark, d)
    assert [r.endings[0] for r in ch.orderBy("ord").collect()] == [f"end {n} 0" for n in range(10)]
    pairs, uni = X.bigram_table(spark.read.parquet(f"{SF}/documents.parquet"))
    losses = X.token_losses(X.render_choices(ch), pairs, uni)
    rep = jobs.evaluate_choices(spark, ch, losses, block=40, limit=8).collect()
    assert [(r.source, r.n) for r in rep] == [("src0", 4), ("src1", 3), ("OVERALL", 7)]
    scores = {}
    for r in X.candidate_scores(losses).collect():
        scores.setdefault(r.example_id, {})[r.ending_idx] = r.per_token
    margins = [(sum(s.values()) - s[n % 3]) / 2 - s[n % 3] for n, s in scores.items() if n < 8 and n != 3]
    assert abs(rep[-1].margin - sum(margins) / 7) < 1e-9


def test_windows_fail_on_a_shard_without_one(spark):
    picked = spark.createDataFrame([(0, 0, 0, 5)], "step long, micro long, row long, shard_tokens long")
    with pytest.raises(Exception, match="fewer than block_size"):
        W.text_starts(picked, 10, 1).collect()


def test_resume_keeps_closed_shards(spark):
    out, whole, rows = scratch_path(spark, "job-resume"), scratch_path(spark, "job-whole"), _rows(40)
    spec = CorpusSpec(name="t", batch_docs=4, shard_tokens=300)
    frame = lambda r: spark.createDataFrame(r, "doc_id long, text string")
    jobs.tokenize_corpus(spark, frame(rows[:24]), out, spec)
    closed = {r.shard_id for r in spark.read.parquet(f"{out}/progress").where("tokens >= 300").collect()}
    stamp = lambda: {f: os.stat(f).st_mtime_ns for f in glob.glob(out.removeprefix("file:") + "/bin/*.bin")}
    before = stamp()
    jobs.tokenize_corpus(spark, frame(rows), out, spec, resume=True)
    jobs.tokenize_corpus(spark, frame(rows), whole, spec)
    assert _written(spark, out)[0] == _written(spark, whole)[0] and len(closed) > 1
    assert _written(spark, out)[1].splits == _written(spark, whole)[1].splits
    after = stamp()
    kept = {f for f in before if int(f[-10:-4]) in closed}
    assert kept and all(before[f] == after[f] for f in kept) and len(after) > len(before)
    with pytest.raises(ValueError, match="closed shards"):
        jobs.tokenize_corpus(spark, frame([(i, "changed " + t) for i, t in rows]), out, spec, resume=True)


def _resumed(spark, rows, part, edit=None, after=None, **kw):
    """Documents that a run over ``rows[:part]`` and a resumed one over all encode, with the shards of both ways."""
    out, whole = scratch_path(spark, "job-ledger"), scratch_path(spark, "job-ledger-whole")
    spec = CorpusSpec(name="t", batch_docs=4, shard_tokens=60, rank_file="file://" + public_tokenizers.path("byte_bpe_50k.tiktoken"), **kw)
    frame = lambda r: spark.createDataFrame(r, "doc_id long, text string")
    jobs.tokenize_corpus(spark, frame(rows[:part]), out, spec)
    ledger = spark.read.parquet(f"{out}/progress").orderBy("split", "shard_id").collect()
    spec = replace(spec, **(after or {}))
    encoded, real = [], B.encode_documents
    with pytest.MonkeyPatch.context() as m:
        m.setattr(B, "encode_documents", lambda d, *a: (encoded.extend(r.doc_id for r in d.collect()), real(d, *a))[1])
        jobs.tokenize_corpus(spark, frame(edit(rows) if edit else rows), out, spec, resume=True)
    jobs.tokenize_corpus(spark, frame(rows), whole, spec)
    assert _written(spark, out)[0] == _written(spark, whole)[0]
    assert _written(spark, out)[1].splits == _written(spark, whole)[1].splits
    read = lambda d: sorted(map(tuple, spark.read.parquet(f"{d}/progress").select("split", "shard_id", "tokens", "docs", "first", "last", "texts", "digest").collect()))
    assert read(out) == read(whole)
    return encoded, ledger


def test_resume_encodes_from_the_first_open_shard(spark):
    rows = _rows(60)
    encoded, ledger = _resumed(spark, rows, 32)
    closed = [r for r in ledger if r.tokens >= 60]
    assert len(closed) > 2 and encoded == [i for i, _ in rows if i > closed[-1].last]


def test_resume_after_a_partial_batch_rewrites_its_shard(spark):
    rows = _rows(60)
    encoded, ledger = _resumed(spark, rows, 31)
    assert min(encoded) == ledger[-1].first


def test_resume_with_a_carved_val_and_a_raised_cap(spark):
    rows = _rows(60)
    encoded, ledger = _resumed(spark, rows, 60, val_tokens=50, max_tokens=150, after={"max_tokens": 260})
    val = [r for r in ledger if r.split == "val"]
    assert sum(r.tokens for r in val) == 50 and encoded and min(encoded) > val[-1].consumed


def test_resume_finds_any_edit_of_a_closed_shard(spark):
    rows = _rows(40)
    one_letter = lambda r: [(i, ("z" + t[1:]) if i == r[2][0] else t) for i, t in r]
    exchanged = lambda r: [(r[0][0], r[1][1]), (r[1][0], r[0][1]), *r[2:]]
    for edit in (one_letter, exchanged, lambda r: r[1:]):
        with pytest.raises(ValueError, match="closed shards have changed"):
            _resumed(spark, rows, 32, edit)
    with pytest.raises(ValueError, match="the earlier run used"):
        _resumed(spark, rows, 32, after={"batch_docs": 5})


def test_prompts_and_generations(spark):
    p = spark.createDataFrame([(1, "hi", "sys"), (2, "yo", None)], "prompt_id long, prompt string, system string")
    chat = {r.prompt_id: r.ids for r in jobs.render_prompts(spark, p, 1000, chat=True).collect()}
    turn = lambda role, text: [257, *f"{role}\n{text}".encode(), 258, 10]
    head = [257, *b"assistant\n"]
    assert chat == {1: turn("system", "sys") + turn("user", "hi") + head, 2: turn("user", "yo") + head}
    empty = spark.createDataFrame([(1, "")], "prompt_id long, prompt string")
    assert jobs.render_prompts(spark, empty, 8, chat=False).first().ids == [256]
    with pytest.raises(Exception, match="prompt is empty"):
        jobs.render_prompts(spark, empty, 8, chat=True).collect()
    out = scratch_path(spark, "job-decode")
    jobs.tokenize_corpus(spark, spark.createDataFrame(_rows(3), "doc_id long, text string"), out, CorpusSpec(name="t"))
    gen = spark.createDataFrame([(1, "ab", 2, [97, 98, 99, 300, 256, 100]), (2, "", 1, [256, 104, 0xE2])],
                                "sample_id long, prompt string, n_prompt int, ids array<int>")
    got = jobs.decode_generations(spark, gen, f"{out}/manifest", V.byte_vocab(spark, "bytes")).orderBy("sample_id").collect()
    assert [(r.text, r.answer) for r in got] == [("c", "abc"), ("h\ufffd", "h\ufffd")]
    with pytest.raises(Exception, match="does not match"):
        jobs.decode_generations(spark, gen, f"{out}/manifest", V.byte_vocab(spark, "other")).collect()
