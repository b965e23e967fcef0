"""The corpus pipeline: quality rules, near duplicates, repeated passages, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the columns of
``documents``.  :func:`run` applies them to ``documents``, writing each stage's rows to the shared folder.
No stage is expressible in SQL, so there is no oracle; the stages are tested against brute force.

Defined cases, for each stage: null ids, texts and other columns, empty and very long texts, ties, repeated rows and
empty tables are as in the operator's module; further columns pass through all stages but the last, whatever their
names; ``n_chars`` is that of the text which a stage leaves (null for a null text).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealflow.llm import compression_bands, simhash_bktree, sos_packing, suffix_levels
from dealflow.llm.common import stage, table


#: A repeated passage is one of 200 bytes or more.  Passages of over 50 words have 315 bytes in the median, few have
#: less than 250, and a string of the shortest kind must lie wholly inside one.
PASSAGE = suffix_levels.Spec(length=200, window=128)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the compression bands keep."""
    return compression_bands.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each group of linked fingerprints."""
    return simhash_bktree.one_per_component(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the bytes of ``PASSAGE`` strings that start elsewhere too."""
    return suffix_levels.remove(docs, spec=PASSAGE).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences."""
    return sos_packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, with_ids=False,
                            cache_entries=300_000)          # workers keep it while the other stages run


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
