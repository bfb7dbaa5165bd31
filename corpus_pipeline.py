"""A training corpus from raw documents: five stages, each written as Parquet before the next reads it.

Defined cases are those of the operators: null texts count as empty and pass; an empty table gives
an empty result at every stage; of rows that repeat, exact dedup keeps one; extra columns are kept
up to packing, whatever their names; very long texts are read whole.
"""

from __future__ import annotations

from quirework.llm import decontam, exact_dedup, near_dup, packing, toxicity
from quirework.llm.common import materialise, read_table


def drop_toxic(spark, docs, sf_dir):
    return toxicity.clean(docs, read_table(spark, sf_dir, "labels"))


def drop_exact_copies(spark, docs, sf_dir):
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark, docs, sf_dir):
    # no contract binds this stage, so it links from a similarity of 0.8 on
    return near_dup.deduplicate(docs, percent=80)


def drop_leaks(spark, docs, sf_dir):
    return decontam.clean(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark, docs, sf_dir):
    return packing.pack(docs, added_tokens=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("packing", pack),
]

#: Scoring, tokenising and edit matching are beyond SQL; tests compare run() with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the documents of sf_dir."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
