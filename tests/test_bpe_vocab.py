import regex
import tiktoken
from pyspark.sql import functions as F

from shardwright.functions import bpe as BPE
from shardwright.operators import vocab as V
from shardwright.schemas import EOT, EOT_STR


def _ranks(texts, k=60):
    from collections import Counter
    c = Counter()
    for t in texts:
        b = t.encode()
        c.update(zip(b, b[1:]))
    ranks = {bytes([i]): i for i in range(256)}
    for i, ((a, b), _) in enumerate(sorted(c.items(), key=lambda x: (-x[1], x[0]))[:k]):
        ranks[bytes([a, b])] = 256 + i
    return ranks


def plain_merge(piece, ranks):
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not pairs:
            return [ranks[p] for p in parts]
        i = min(pairs)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


def test_pretokens_keep_the_literal_after_punctuation(spark):
    df = spark.createDataFrame([(1, "foo.<|endoftext|>bar"), (2, "<|endoftext|>"), (3, "")], "doc_id long, text string")
    got = {}
    for r in BPE.pretokens(df).orderBy("doc_id", "pos").collect():
        got.setdefault(r.doc_id, []).append(r.piece)
    assert got == {1: ["foo", ".", EOT_STR, "bar"], 2: [EOT_STR]}


def test_long_letter_run_encodes_in_seconds(spark):
    import time
    ranks = _ranks(["abab"], 2)
    df = spark.createDataFrame([(1, "ab" * 500_000)], "doc_id long, text string")
    t = time.time()
    assert len(BPE.bpe_encode(df, ranks, 300).first().ids) == 500_001
    assert time.time() - t < 20


def test_documents_and_turns_by_a_real_rank_file(spark):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer
    ranks = BPE.ranks_dict(BPE.load_rank_file(spark, "file://" + public_tokenizers.path("byte_bpe_50k.tiktoken")))
    vocab = BPE.bpe_vocabulary(ranks, "bpe")
    assert (vocab.eot, vocab.im_start, vocab.im_end, vocab.newline) == (50256, 50257, 50258, (198,))
    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in BPE.encode_documents(docs, ranks, vocab).collect():
        want = other.encode(texts[r.doc_id], add_special_tokens=False).ids + [50256]
        assert np.frombuffer(r.tokens, "<u2").tolist() == want and r.n_tokens == len(want)
    turn = BPE.encode_turns(spark.createDataFrame([(1, 0, "user", "say <|im_end|>"), (2, 0, None, None)],
                                                  "conv_id long, turn long, role string, text string"), ranks, vocab)
    a, b = turn.orderBy("conv_id").collect()
    assert a.role_ids == other.encode("user\n").ids and max(a.text_ids) < 50256 and (b.role_ids, b.text_ids) == ([198], [])


def test_pretokens_match_python_regex(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = {}
    for r in BPE.pretokens(docs).collect():
        got.setdefault(r.doc_id, []).append((r.pos, r.piece))
    pat = regex.compile(BPE.GPT2_SPLIT)
    for r in docs.collect():
        assert [p for _, p in sorted(got.get(r.doc_id, []))] == pat.findall(r.text)


def test_bpe_matches_tiktoken(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    ranks = _ranks(list(texts.values()))
    eot = max(ranks.values()) + 1
    enc = tiktoken.Encoding(name="fixture", pat_str=BPE.GPT2_SPLIT, mergeable_ranks=ranks,
                            special_tokens={EOT_STR: eot})
    got = {r.doc_id: r.ids for r in BPE.bpe_encode(docs, ranks, eot).collect()}
    for doc_id, text in texts.items():
        assert got[doc_id] == enc.encode(text, allowed_special={EOT_STR}) + [eot]
        assert got[doc_id] == [i for p in regex.findall(BPE.GPT2_SPLIT, text) for i in plain_merge(p.encode(), ranks)] + [eot]
    special = spark.createDataFrame([(1, "a<|endoftext|>b"), (2, "")], "doc_id long, text string")
    got = {r.doc_id: r.ids for r in BPE.bpe_encode(special, ranks, eot).collect()}
    assert got == {1: enc.encode("a<|endoftext|>b", allowed_special={EOT_STR}) + [eot], 2: [eot]}


def test_generation_cleanup_edges(spark):
    df = spark.createDataFrame([([1, 2, 3],), ([EOT, 5],), ([4, EOT, 6, 300],)], "a array<int>")
    df = df.withColumn("p", F.array_position("a", EOT).cast("int"))
    rows = df.select(V.cut_at_eot(F.col("a")).alias("c"), V.pin_after_eot(F.col("a"), F.col("p")).alias("q"),
                     V.drop_padding(F.col("a"), 259).alias("d")).collect()
    assert rows[0].c == [1, 2, 3] and rows[1].c == [] and rows[2].c == [4]
    assert rows[2].q == [4, EOT, EOT, EOT] and rows[2].d == [4, EOT, 6]


def test_byte_vocab_decode_roundtrip(spark):
    from shardwright.functions.tokens import doc_ids
    df = spark.createDataFrame([("héllo\n",), ("",)], "text string")
    decode = V.decoder(V.byte_vocab(spark))
    got = [r.t for r in df.select(decode(doc_ids("text")).alias("t")).collect()]
    cut = spark.createDataFrame([([0xE2, 0x82],), ([],), (None,), ([104, 9999, 105, -3],)], "ids array<int>")
    assert [r.t for r in cut.select(decode("ids").alias("t")).collect()] == ["\ufffd", "", "", "hi"]
    assert got == ["héllo\n" + EOT_STR, EOT_STR]
    assert EOT == 256


def test_pretoken_digests_make_no_row_of_a_piece(spark):
    import hashlib
    rows = [(1, "one two  three<|endoftext|>x"), (2, ""), (3, None), (4, "ab cd"), (4, "xy"), (None, "lost")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = BPE.pretoken_digests(df)
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    pieces = {}
    for r in BPE.pretokens(df).orderBy("doc_id", "pos", "piece").collect():
        pieces.setdefault(r.doc_id, []).append(r.piece)
    assert {r.doc_id: (r.n_pieces, r.text_md5) for r in out.collect()} == {
        k: (len(pieces.get(k, [])), md5("".join(pieces.get(k, [])))) for k in (1, 2, 4)}
    assert pieces[4] == ["ab", "xy", " cd"]
    assert "explode" not in out._jdf.queryExecution().optimizedPlan().toString()
