"""The registered queries of this package: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (balltree, collocation, fingerprint, html_extract, langid, minhash, mixing, ngram_join, packing, pii, quality, topk,
               toxicity)
from .common import held_out, table

QueryFn = Callable[[SparkSession, str], DataFrame]


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), lambda i: ~held_out(i, 3, 1))
    return toxicity.score(docs, model, ["doc_id"], 0.7).select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score", "predicted")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = langid.train(docs.where(~held_out(F.col("doc_id"), 4, 2)), F.col("lang"))
    found = langid.predict(docs.select("doc_id", "text"), profiles, ["doc_id"])
    return found.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"), lambda i: ~held_out(i, 5, 0))
    return quality.score(docs, model, ["doc_id"], 0.3).select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", "predicted")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.train(docs))


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    found = topk.top_k(vectors, vectors.where(F.col("id") % 50 == 0), k=5, scale=256)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocation.collocations(table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balltree.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, QueryFn] = {f.__name__: f for f in (
    op1_packing, op2_toxicity, op3_language_id, op4_html_extraction, op5_quality, op6_mixing, op7_fingerprint, op8_pii,
    op9_exact_top_k, op10_ngram_join, op11_minhash, op12_collocations, op13_lexical_search)}
