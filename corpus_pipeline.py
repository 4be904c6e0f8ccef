"""A training corpus from raw documents: five stages over the operators of ``shardwright.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's docs; all but the last keep
the columns of ``documents``.
"""

from shardwright.llm import fuzzy_lines, mixing, packing, simhash, toxicity
from shardwright.llm.common import read, written


def drop_toxic(spark, docs, sf_dir):
    """Documents that the classifier rejects go; it learns from the labels of ``docs``."""
    return toxicity.clean(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def dedup_lines(spark, docs, sf_dir):
    """Of near-equal lines the first stays; documents stay, their texts lose the others."""
    return fuzzy_lines.without_repeats(docs)


def dedup_documents(spark, docs, sf_dir):
    """One document of each SimHash component stays (4-word shingles, 4 bits)."""
    return simhash.one_of_each(docs, simhash.SHINGLE, simhash.MAX_BITS)


def mix_sources(spark, docs, sf_dir):
    """Documents are left out or repeated so that sources come to their target weights."""
    return mixing.mixed(docs)


def pack_sequences(spark, docs, sf_dir):
    """Tokenised pieces with their places in sequences of 2048 ids."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("simhash_dedup", dedup_documents),
    ("source_mixing", mix_sources),
    ("packing", pack_sequences),
]

#: The learned and the similarity stages have no SQL; tests/llm/test_pipeline.py holds every stage against a plain version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
