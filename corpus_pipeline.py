"""A training corpus from the documents, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all that the one before has kept, and is written as Parquet
and read again. All but the last return the columns of the documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brisa.llm import bpe, mixing, radix_dedup, shingle_join, toxicity
from brisa.llm.common import documents
from brisa.session import as_written_table


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out the documents that the toxicity model predicts to be toxic."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.scored(docs, model).where(F.col("__score") < toxicity.THRESHOLD).select(*docs.columns)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return radix_dedup.keep_one(docs)


def with_row(docs: DataFrame) -> DataFrame:
    """The documents with a written key of their own, as ids may be null or repeat."""
    return as_written_table(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked texts: the one with the smallest id.

    A row without an id stays only if it is linked with no row that has one. Among rows that repeat an id, or have none,
    the text's hash decides.
    """
    rows = with_row(docs)
    found = shingle_join.near_duplicates(rows.select(F.col("__row").alias("doc_id"), "text"))
    found = found.select(F.col("doc_id").alias("__row"), "component_id")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text"), "__row")
    asked = rows.select("__row", order.alias("order")).join(found, "__row")
    kept = asked.groupBy("component_id").agg(F.min_by("__row", "order").alias("__row"))
    return rows.join(kept, "__row", "left_semi").select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: up to three rows, or none."""
    rows = with_row(docs)
    plan = mixing.standard_mix(rows, carried=["__row"]).where("repeats > 0").select("__row", F.col("repeats").alias("__repeats"))
    rows = rows.join(plan, "__row")
    return rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), "__repeats"))).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts, and digests of the ids and of the bytes that they decode to."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(docs, ranks, public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", toxic),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("mixing sources to target weights", mixed),
    ("byte-level BPE encoding and decoding", encoded),
]

# No stage but the second is a matter of SQL: a trained model, a seeded choice, a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = as_written_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
