"""Table schemas, fixed ids and job parameter records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values that must match the reference's conventions ---------------
# Special strings and their meaning:
#   "<|endoftext|>" ends every document; a literal one inside a document
#   becomes the end-of-text id. "<|im_start|>" / "<|im_end|>" delimit chat turns
#   and are never produced from message text.
EOT_STR = "<|endoftext|>"
IM_START_STR = "<|im_start|>"
IM_END_STR = "<|im_end|>"
# Shard sizes (tokens) and documents per encoder batch in the reference.
REFERENCE_SHARD_TOKENS = 100_000_000
REFERENCE_BATCH_DOCS = 8192
REFERENCE_VAL_EXAMPLES = 5_000
REFERENCE_MAX_LEN = 1024
# Masked target value used by the loss.
IGNORE_INDEX = -100
# Default peak FLOP/s when a run has no entry in the peak table.
DEFAULT_PEAK_FLOPS = 71e12
# Upper-median comparison tolerance for stored vs recomputed utilisation.
UTILISATION_TOLERANCE = 0.02
# Seed of every counter-based draw.
SEED = 1337
# Model shape the parameter count and the utilisation are stated for.
MODEL_VOCAB, MODEL_BLOCK, MODEL_LAYERS, MODEL_HEADS, MODEL_WIDTH, MODEL_FF = 50304, 512, 8, 8, 512, 2048
# --- end of fixed values -----------------------------------------------------

# Byte vocabulary: ids 0..255 are UTF-8 bytes, then the three specials. The base
# GPT-2 rank file is not available offline, so the byte vocabulary is the
# default encoding; a BPE rank table can be loaded instead (functions.bpe).
BYTE_VOCAB_BASE = 256
EOT = 256
IM_START = 257
IM_END = 258
BYTE_VOCAB_SIZE = 259


@dataclass(frozen=True)
class Vocab:
    """What encoding needs to know of a vocabulary; ``rank_file`` is a path all
    workers can read, or None for bytes."""
    name: str
    eot: int
    im_start: int
    im_end: int
    text_size: int
    chat_size: int
    newline: tuple
    rank_file: str | None = None


BYTES = Vocab("bytes", EOT, IM_START, IM_END, BYTE_VOCAB_SIZE, BYTE_VOCAB_SIZE, (10,))


def padded_vocab(n: int, multiple: int = 64) -> int:
    """Vocabulary rows rounded up to a multiple of 64 (embedding padding)."""
    return -(-n // multiple) * multiple


def id_dtype(n_vocab: int) -> str:
    """Narrowest unsigned type the token ids fit in."""
    return "uint16" if n_vocab <= 65535 else "uint32"


DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
])

CONVERSATIONS = T.StructType([
    T.StructField("conv_id", T.LongType()),
    T.StructField("turn", T.LongType()),
    T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()),
])

MESSAGES = T.ArrayType(T.StructType([
    T.StructField("role", T.StringType()),
    T.StructField("content", T.StringType()),
]))

CHOICE = T.StructType([
    T.StructField("ctx", T.StringType()),
    T.StructField("endings", T.ArrayType(T.StringType())),
    T.StructField("label", T.StringType()),
    T.StructField("source_id", T.StringType()),
])

TOKEN_LOSSES = T.StructType([
    T.StructField("example_id", T.LongType()),
    T.StructField("ending_idx", T.IntegerType()),
    T.StructField("pos", T.IntegerType()),
    T.StructField("loss", T.DoubleType()),
    T.StructField("mask", T.IntegerType()),
])

SCALARS = T.StructType([
    T.StructField("run", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("tag", T.StringType()),
    T.StructField("step", T.LongType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("wall_time", T.TimestampType()),
])

SHARD_ENTRY = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("tokens", T.LongType()),
    T.StructField("examples", T.LongType()),
])

SPLIT_INFO = T.StructType([
    T.StructField("tokens", T.LongType()),
    T.StructField("bytes", T.LongType()),
    T.StructField("supervised_tokens", T.LongType()),
    T.StructField("examples", T.LongType()),
    T.StructField("shards", T.ArrayType(SHARD_ENTRY)),
])

MANIFEST = T.StructType([
    T.StructField("dataset", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("config", T.StringType()),
    T.StructField("encoding", T.StringType()),
    T.StructField("dtype", T.StringType()),
    T.StructField("vocab_size", T.LongType()),
    T.StructField("eot_token", T.LongType()),
    T.StructField("im_start", T.LongType()),
    T.StructField("im_end", T.LongType()),
    T.StructField("chat", T.BooleanType()),
    T.StructField("max_len", T.LongType()),
    T.StructField("splits", T.MapType(T.StringType(), SPLIT_INFO)),
])


@dataclass(frozen=True)
class CorpusSpec:
    """What differs between corpora; the text job itself is corpus-agnostic.

    ``val_tokens`` set means val is carved off the front of train; otherwise
    a separate val table is expected.
    """
    name: str
    source: str = ""
    config: str | None = None
    val_tokens: int | None = None
    max_tokens: int | None = None
    batch_docs: int = REFERENCE_BATCH_DOCS
    shard_tokens: int = REFERENCE_SHARD_TOKENS
    rank_file: str | None = None  # BPE ranks; None: bytes

    def __post_init__(self):
        for k in ("val_tokens", "max_tokens"):
            v = getattr(self, k)
            if v is not None and v <= 0:
                raise ValueError(f"{k} must be positive or None (unset), got {v}")
        if self.batch_docs <= 0 or self.shard_tokens <= 0:
            raise ValueError("batch_docs and shard_tokens must be positive")


@dataclass(frozen=True)
class ChatSpec:
    name: str
    source: str = ""
    config: str | None = None
    max_len: int = REFERENCE_MAX_LEN
    max_examples: int | None = None
    val_examples: int | None = REFERENCE_VAL_EXAMPLES
    shard_tokens: int = REFERENCE_SHARD_TOKENS
    train_roles: tuple = ("assistant",)
    rank_file: str | None = None

    def __post_init__(self):
        for k in ("max_examples", "val_examples"):
            v = getattr(self, k)
            if v is not None and v <= 0:
                raise ValueError(f"{k} must be positive or None (unset), got {v}")
        if self.max_len < 4:
            raise ValueError("max_len must leave room for one turn")


@dataclass(frozen=True)
class ModelConfig:
    vocab_size: int = MODEL_VOCAB
    block_size: int = MODEL_BLOCK
    n_layer: int = MODEL_LAYERS
    n_head: int = MODEL_HEADS
    n_embd: int = MODEL_WIDTH
    d_ff: int = MODEL_FF
