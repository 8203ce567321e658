"""The corpus pipeline: five stages of the training-data operators, each over all its predecessor kept.

language_id   drops documents that the language profiles reject (no letter, or like
              none of the languages) and fills an unknown language with the prediction
near_dups     keeps one document (the smallest id) of every group of near duplicates
pii           masks personal data in the texts
mixing        takes the words of every source that its target asks for
packing       assigns the documents to length buckets and token-budget batches

Every stage but the last returns the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replylens.llm import langid, mixing, ngram_join, packing, pii
from replylens.llm.common import held_out, materialize, table

# Training and random hashing are no SQL; tests/llm holds each stage against a brute-force version.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Null texts are rejected; without any known language every document is."""
    profiles = langid.train(docs.where(~held_out(F.col("doc_id"), 4, 2)), F.col("lang"))
    names = tuple("_" * 8 + n for n in langid.RESULT)       # no column of the documents
    found = langid.predict(docs, profiles, docs.columns, names=names)
    return found.where(~F.col(names[3])).withColumn("lang", F.coalesce("lang", names[0])).select(*docs.columns)


def near_dups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without an id or without a word stay; of equal rows one stays."""
    return ngram_join.distinct_documents(docs)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.masked_documents(docs, pii.train(docs))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document taken more than once is repeated; one taken in part has just those words."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("language_id", language_id), ("near_dups", near_dups), ("pii", private_data), ("mixing", mixed), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
