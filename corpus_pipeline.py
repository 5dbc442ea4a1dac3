"""A training corpus from documents: language identification, near-duplicate removal, removal of repeated
passages, mixing to target weights, packing into sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm import jaccard_join, language_id, mixing, packing, substring_dedup
from kerbside.llm.catalog import WEIGHTS, domain_of, table
from kerbside.llm.common import stored


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3. Documents without any letter go; a missing ``lang`` is filled in."""
    return language_id.keep_identified(docs, language_id.fit_documents(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8. Of each group of near duplicates the document with the smallest doc_id stays."""
    return jaccard_join.keep_one(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7. Passages stay where they occur first; documents left empty go."""
    return substring_dedup.drop_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1. As many tokens as there are, by the target weights; documents of short sources repeat."""
    return mixing.mix_documents(docs, domain_of(), F.col("total"), WEIGHTS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2. Pieces of the mixture's documents in sequences of 1024 tokens."""
    return packing.pack(docs)


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("substring dedup", cut_repeated_passages),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_sequences),
]

#: Models, min-hash values and token ids have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each one's result is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
