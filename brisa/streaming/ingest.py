"""Streaming forms: incremental keyed loads, and the daily mean per parameter."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from brisa import schemas
from brisa.operators.flatten import flatten_measurements, with_reject_reason
from brisa.operators.loads import replace_partition, stamp, upsert_partial
from brisa.operators.summaries import summary_changes
from brisa.session import as_written_table
from brisa.sources import tables
from brisa.sources.files import explode_envelopes, tag_context

MEASUREMENT = schemas.TABLES["measurements"]


def incremental_ingest(
    pages: DataFrame,
    sensors: DataFrame,
    target: str,
    checkpoint: str,
    as_of: date | datetime | str,
    rejected: str,
    loaded: str | None = None,
) -> StreamingQuery:
    """Each run takes the pages that have newly landed and upserts them by key.

    A late or corrected period overwrites its row no matter how late it comes: the
    state is the table itself, so no watermark is needed. Records that cannot
    be loaded are kept under ``rejected``, one folder per batch: the checkpoint
    moves past them, so that is the only place where they stay. So are pages that are cut or malformed, as one record each with
    their text, if ``pages`` comes from ``files.stream_pages``; without the raw text they would be lost. ``loaded`` gets the
    number of records that went into the table, also by batch.
    """
    records = tag_context(explode_envelopes(pages), sensors)

    def load(batch: DataFrame, batch_id: int) -> None:
        # parsed once; the rows to load and those to set aside are read back
        parsed = flatten_measurements(with_reject_reason(batch))
        rows = as_written_table(stamp(parsed, as_of), "batch")
        good = rows.where(F.col("reason").isNull())
        upsert_partial(
            target, good, MEASUREMENT.key,
            schemas.MEASUREMENT_FIRST, schemas.MEASUREMENT_LAST, ["seq"], written=True,
        )
        bad = rows.where(F.col("reason").isNotNull())
        bad.select("sensor_id", F.col("rejected_record").alias("record"), "reason").write.mode(
            "overwrite"
        ).json(f"{rejected}/batch={batch_id}")
        if loaded is not None:
            good.agg(F.count(F.lit(1)).alias("records")).write.mode("overwrite").json(f"{loaded}/batch={batch_id}")

    return (
        records.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def daily_means(m: DataFrame, ts: str = "period_from_utc") -> DataFrame:
    """Mean per day and parameter. Without a value the mean is null and ``n`` is 0; undated rows belong to no day."""
    return (
        m.where(F.col(ts).isNotNull())
        .groupBy(F.to_date(ts).alias("day"), "parameter_name")
        .agg(F.round(F.avg("value"), 2).alias("mean_value"), F.count("value").alias("n"))
    )


def daily_avg_stream(
    m: DataFrame, table: str, target: str, checkpoint: str, seq: Sequence[str], ts: str = "period_from_utc"
) -> StreamingQuery:
    """Daily mean per parameter under ``target``, kept current as measurements arrive.

    Each batch is first loaded by key into ``table``; then the days that it touches are averaged anew and replaced. So
    a corrected row counts once, a late one counts no matter how late it is, and a repeated batch is harmless. A key
    never leaves the table, hence a touched day always has rows. Undated rows are left out.
    """
    rows = m.where(F.col(ts).isNotNull()).withColumn("period_date", F.to_date(ts))
    last = ["parameter_name", "value"]
    rows = rows.select(*MEASUREMENT.key, *last, "period_date", *seq)

    def publish(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        written = as_written_table(batch, "batch")
        if written.isEmpty():
            return
        upsert_partial(table, written, MEASUREMENT.key, [], last, seq, written=True)
        days = as_written_table(written.select("period_date").distinct(), "batch-days")
        touched = spark.read.parquet(table).join(days, "period_date", "left_semi")
        replace_partition(daily_means(touched, ts), target, "day")

    return (
        rows.writeStream.foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def daily_summary_stream(
    m: DataFrame, table: str, target: str, checkpoint: str, seq: Sequence[str], ts: str = "period_from_utc"
) -> StreamingQuery:
    """The daily summary of a table that is loaded by key, kept by what each batch changes.

    ``target`` gets one folder per batch with what the batch adds to the summary, negative where it takes back; ``summaries.merged`` of
    all of them is the summary of ``table``. The change needs the stored rows with keys of the batch, no other row of their
    days. It is written before the batch goes into the table and never again: a batch that is tried anew finds it
    complete and only repeats the load, which changes nothing. One checkpoint belongs to one target.
    """
    rows = m.where(F.col(ts).isNotNull()).withColumn("period_date", F.to_date(ts))
    last = ["parameter_name", "value"]
    rows = rows.select(*MEASUREMENT.key, *last, "period_date", *seq)

    def publish(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        written = as_written_table(batch, "batch")
        if written.isEmpty():
            return
        change = f"{target}/batch={batch_id}"
        if not tables.exists(spark, f"{change}/_SUCCESS"):
            stored = None
            if tables.exists(spark, table):
                stored = spark.read.schema(written.drop(*seq).schema).parquet(table)
            changes = summary_changes(stored, written, MEASUREMENT.key, seq, ts)
            changes.coalesce(1).write.mode("overwrite").parquet(change)  # a row per touched day and parameter
        upsert_partial(table, written, MEASUREMENT.key, [], last, seq, written=True)

    return (
        rows.writeStream.foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def new_codes_stream(records: DataFrame, code: str, target: str, checkpoint: str) -> StreamingQuery:
    """Codes that no earlier record had, one folder of ``target`` per run; the codes seen are the stream's state.

    The state lies in the checkpoint and grows with the number of codes, not of records. A later run restores it, so that a code which comes
    again is not new. A null code is a code.
    """

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return (
        records.select(code).dropDuplicates([code])
        .writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
