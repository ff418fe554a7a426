"""From raw documents to packed training sequences, in five stages.

Each stage is a function of (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet and read again
as the next stage's documents, so a lost executor never costs more than one stage.  All but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cairn.llm import pii
from cairn.llm.common import table
from cairn.llm.mixing import mixed_documents
from cairn.llm.packing import pack_documents
from cairn.llm.quality import grade_documents, graded_labels
from cairn.llm.queries import bpe_path
from cairn.llm.simhash import drop_near_duplicates
from cairn.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose best grade is likelier than not, by the ordinal classifier learned from the labels."""
    graded = grade_documents(docs.select(*COLUMNS), graded_labels(table(spark, sf_dir, "labels")))
    return graded.where("kept").select(*COLUMNS)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (3-word shingles, at most 3 differing bits): the smallest id."""
    return drop_near_duplicates(docs.select(*COLUMNS), shingle=3, max_bits=3)


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind, by patterns and the skip-chain field."""
    return pii.redact(docs.select(*COLUMNS))


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to weights 3, 1, 2 over 150 % of the words: documents repeated, kept, cut or left out."""
    return mixed_documents(docs.select(*COLUMNS))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of 1024, by the grouping genetic algorithm."""
    return pack_documents(docs, tokenizer=bpe_path())


STAGES = [("quality classifier", select_quality), ("SimHash near-dedup", drop_copies), ("PII", remove_personal_data),
          ("mixing", mix_to_weights), ("best-fit packing", pack_sequences)]
#: The classifier, fingerprints, the field and the packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; intermediate results lie in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k + 1 == len(STAGES):
            return out
        path = scratch_path(spark, f"pipeline-{k}")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
