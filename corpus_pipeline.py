"""The corpus pipeline: language ID, near-dedup, repeated passages, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept and gives a DataFrame, which
is written as Parquet and read again for the next one.
"""

from basketry.llm import decontamination, language_crf, packing, prefix_free, simhash
from basketry.llm.common import stage, table


def identify_language(spark, docs, sf_dir):
    """Rows with a language; texts that are null or without letters go."""
    return language_crf.keep_identified(docs, language_crf.fit_on(docs))


def drop_near_duplicates(spark, docs, sf_dir):
    """One row of each group of near duplicates."""
    return simhash.drop_near_duplicates(docs)


def remove_repeats(spark, docs, sf_dir):
    """Rows without the passages of at least 400 bytes that occur more than once; rows of which nothing is left go."""
    return prefix_free.remove_repeats(docs).where("length(trim(text)) > 0")


def decontaminate(spark, docs, sf_dir):
    """Rows that hold no window of a benchmark item, with or without an id."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), null_items=True)


def pack(spark, docs, sf_dir):
    """Token pieces with their place in the training sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("repeated_passages", remove_repeats),
    ("decontamination", decontaminate),
    ("packing", pack),
]

# The language model and the tokenizer have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
