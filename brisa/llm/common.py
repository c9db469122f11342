"""Shared pieces of the text operators.

Every operator reads the columns that it names and no other, so that extra columns of the input never
clash with its own. Rows cross into Python as Arrow batches of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brisa.session import as_written_table

# The white space that separates words.
SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

BATCH_ROWS = 2000
BATCH_BYTES = 16 * 1024 * 1024


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches end at a number of rows or bytes, whichever comes first.

    Python then holds a few megabytes whatever the length of the texts. The settings are read when a plan
    runs, so they stay set.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


Batch = TypeVar("Batch")


def released(batches: Iterable[Batch]) -> Iterator[Batch]:
    """The batches, one by one; what Arrow took for those before goes back to the system.

    Arrow keeps what it took, and a worker outlives its task: some 50 MB of each would be missing to its executor in all later stages.
    """
    for batch in batches:
        yield batch
        pa.default_memory_pool().release_unused()


ARROW = {T.StringType: pa.string(), T.IntegerType: pa.int32(), T.LongType: pa.int64(), T.DoubleType: pa.float64()}


def small_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A few rows of the driver as a table of the plan itself.

    As a list they would be read by Python workers of another kind than those of the batches, three processes more on each executor.
    """
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    arrays = [pa.array(c, ARROW[type(f.dataType)]) for f, c in zip(schema, columns, strict=True)]
    return spark.createDataFrame(pa.table(arrays, names=schema.names), schema)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def text_bytes(name: str = "text") -> Column:
    """UTF-8 bytes of a text, empty for null."""
    return F.coalesce(F.col(name), F.lit("")).cast("binary")


def held_out() -> Column:
    """Rows that no classifier may learn labels from: crc32 of the id's text is 2 modulo 4.

    A row without an id counts as the empty text (remainder 0).
    """
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2


# Shuffle partitions that one task of a derived table may take together.
PARTITIONS_A_FILE = 8


def as_derived_table(df: DataFrame, label: str) -> DataFrame:
    """``as_written_table`` for rows that are few or narrow against the corpus, in fewer files than shuffle partitions.

    Every file costs its own creation, which a table of a few kilobytes in some hundred files pays hundreds of times. A task takes no more
    than some partitions of the cluster's setting together, so that it does not grow with the data; a cluster has
    work for all its cores in any case. Adaptive execution, where it merges partitions itself, has mostly done so before.
    """
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return as_written_table(df.coalesce(max(2 * spark.sparkContext.defaultParallelism, partitions // PARTITIONS_A_FILE)), label)
