"""A training corpus from raw documents, in five stages.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs, sf_dir)``
and returns the next stage's documents (the last one: the packed pieces).
Nulls, empty texts, repeated rows and empty tables are handled as the operators
that the stages call say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tessera.llm import lines, minhash, mixing, packing, quality
from tessera.llm.common import small, staged, table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier accepts."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without runs of lines that an earlier one has; a
    document that is nothing but such runs stays with an empty text."""
    return lines.dedup(docs).withColumn("n_chars", F.length("text").cast("bigint"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one of the smallest
    doc_id, and of several rows of that id the first by a hash of the text.
    Documents without words and rows without an id all stay."""
    groups = staged(minhash.near_duplicates(docs, words=5, percent=80).select("doc_id", "n_shingles", "kept"), "groups")
    gone = groups.where("not kept").select("doc_id").distinct()
    docs = docs.join(small(gone, gone.count()), "doc_id", "left_anti")
    many = groups.where("kept and doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
    many = staged(many.where("rows > 1").select("doc_id"), "repeated")
    if many.isEmpty():
        return docs
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text")))
    once = docs.join(many, "doc_id", "left_semi").withColumn("_nth", first).where("_nth = 1").drop("_nth")
    return docs.join(many, "doc_id", "left_anti").unionByName(once)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of sources takes them, shard by shard."""
    return mixing.drawn_documents(mixing.mix(docs)).select("doc.*")


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in training sequences."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", good_documents),
    ("line dedup", distinct_lines),
    ("near-duplicate removal", distinct_documents),
    ("source mixing", mixed_sources),
    ("packing", packed_sequences),
]

#: Models, signatures and draws have no SQL form; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written as Parquet and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
