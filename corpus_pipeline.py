"""Corpus pipeline: quality filter, exact and near dedup, decontamination, packing.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir),
where ``docs`` is what the stage before kept, and returns a DataFrame.  All but
the last return the columns of ``documents``, the last the packed pieces.
``run`` applies them to ``documents``; each result is written to the folder in
``spark.checkpoint.dir`` and read again, so a lost executor costs a stage at
most; once it is written, the folders that led to it are deleted.  Labels and benchmark items come from the tables beside ``documents``.
An empty table passes through all stages as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontamination, exact_dedup, packing, quality, simhash
from tessera.llm.common import read_table, write_stage
from tessera.sources.sinks import drop_scratch, scratch_mark


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest-neighbour classifier accepts."""
    return quality.keep_quality(docs, quality.fit(docs, read_table(spark, sf_dir, "labels")))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-equal fingerprints."""
    return simhash.drop_near_copies(docs, simhash.SHINGLE, simhash.DISTANCE)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages; mostly contaminated ones go."""
    return decontamination.remove_benchmark(docs, read_table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences."""
    return packing.packed_documents(docs)


STAGES = [
    ("quality_filter", quality_filter),
    ("exact_dedup", exact_dedup_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("best_fit_packing", packing_stage),
]

#: Classifier scores, fingerprints and tokenizers are beyond SQL; the tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, mark = read_table(spark, sf_dir, "documents"), scratch_mark()
    for name, stage in STAGES:
        docs = write_stage(stage(spark, docs, sf_dir), name)
        drop_scratch(spark, mark, keep_last=True)  # the stage is written: what led to it can go
    return docs
