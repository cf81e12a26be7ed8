"""A corpus pipeline of five operators, each stage written and read again.

Each stage works on all rows that the one before it kept, and returns the columns of documents; the last returns the
packed pieces. Every row is a document of its own and goes by its own text, also where it has no doc_id or shares it
with other rows. Of each group of documents with like shingles one row stays, the one with the least doc_id (without
doc_id only if no other has one).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm import mixing, packing, quality, secret_scan
from graphloom.llm.common import fresh_dir, small, little_memory, stored, table
from graphloom.llm.jaccard_join import jaccard_classes

VOCABULARY = "word_bpe_49k.json"


def _keyed(docs: DataFrame) -> DataFrame:
    """docs with a number of each row, `_row`: its doc_id, if all rows have one and no two the same; else one that is
    stored with the rows, so that it is the same whenever a task runs again."""
    if docs.count() == docs.where("doc_id is not null").select("doc_id").distinct().count():
        return docs.withColumn("_row", F.col("doc_id").cast("long"))
    return stored(docs.withColumn("_row", F.monotonically_increasing_id()), "keyed")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.passing(docs, table(spark, sf_dir, "labels"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents with like shingles, the one with the least doc_id."""
    rows = _keyed(docs)
    classes = jaccard_classes(rows.select(F.col("_row").alias("doc_id"), "text"))
    named = classes.join(rows.select("_row", F.col("doc_id").alias("_doc")), F.col("doc_id") == F.col("_row"))
    first = named.groupBy("component_id").agg(F.min(F.struct(F.col("_doc").isNull(), "_doc", "_row"))["_row"].alias("_first"))
    first = stored(first.select("_first"), "first")
    return rows.join(small(first), F.col("_row") == F.col("_first"), "left_semi").select(docs.columns)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret; n_chars follows the text."""
    rows = secret_scan.scan(docs.select(F.struct("*").alias("_row"), "text"))
    text = secret_scan.redacted(F.col("text"), F.col("spans"))
    fields = {c: F.col("_row").getField(c) for c in docs.columns} | {"text": text}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        fields["n_chars"] = F.when(F.size("spans") > 0, F.char_length(text).cast(kind)).otherwise(fields["n_chars"])
    return rows.select(*(fields[c].alias(c) for c in docs.columns))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    mixed = mixing.mix(docs.select("doc_id", "source", "text", F.struct("*").alias("_row")), keep=("_row",))
    return mixed.where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*(F.col("_row").getField(c).alias(c) for c in docs.columns))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes."""
    return packing.pack(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("secret_scans", secret_scans),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]

#: SQL can't tell a tokenizer's ids, nor the hashes that the quality model counts by; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with little_memory(spark):
            stage(spark, docs, sf_dir).write.parquet(at := fresh_dir(spark, name))
        docs = spark.read.parquet(at)
    return STAGES[-1][1](spark, docs, sf_dir)
