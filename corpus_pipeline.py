"""A training-corpus pipeline: quality, near duplicates, repeated passages, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir), works on all documents that its predecessor kept, and returns the columns of
documents; the last one returns pieces of sequences. ``run`` writes each stage's result to the shared folder and reads
it again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import documents, stored
from sluice.llm.decontam import without_leaks
from sluice.llm.neardup import near_duplicates
from sluice.llm.packing import pack, public_tokenizer
from sluice.llm.quality import good_documents
from sluice.llm.substr import without_repeats


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field takes for bad go."""
    return good_documents(docs, documents(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the document with the least doc_id stays."""
    gone = near_duplicates(docs).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone.hint("shuffle_hash"), "doc_id", "left_anti").select(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that stand earlier in the corpus go."""
    out = without_repeats(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item go."""
    return without_leaks(docs, documents(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 tokens."""
    return pack(docs, public_tokenizer("word_bpe_49k.json"))


STAGES = [("quality_classifier", quality_classifier), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup), ("decontamination", decontamination), ("packing", packing)]

#: The stages' models, graphs and fingerprints have no SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
