"""Exact duplicates by distributed radix partitioning from the first byte on.

All texts start in one group. Each level splits every open group by the next run of bytes, counted with
combiners before the shuffle, so a group that holds a third of all rows is a few rows per task. A group
with one text is done; so is a group whose texts have ended: its texts are equal, byte for byte, and no
digest was compared. The rest goes on behind the bytes that were used. Only texts that still share all
bytes so far with another text are read at the next level, and the runs grow, so the number of levels
follows the logarithm of the longest shared prefix.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from brisa.llm.common import SPACE, as_derived_table, text_or_empty
from brisa.session import as_written_table

FIRST_RUN = 32
RUN_GROWTH = 32
LONGEST_RUN = 32 * 1024 * 1024


def runs() -> Iterator[int]:
    """Bytes that each level uses: 32, 1 KiB, 32 KiB, 1 MiB, then 32 MiB for ever."""
    width = FIRST_RUN
    while True:
        yield width
        width = min(width * RUN_GROWTH, LONGEST_RUN)


def without_space(text: Column) -> Column:
    return F.translate(text, SPACE, "")


def exact_groups(docs: DataFrame, normalise=without_space) -> DataFrame:
    """Group, keeper and digest of every row.

    Reads ``doc_id`` and ``text``; returns doc_id, keep_id, group_size, kept, text_sha256, one row per row.

    * Null text counts as empty; empty texts are equal to one another.
    * The row with the most code points in its original text stays, then the smallest ``doc_id``, a null id
      last. Of rows that agree in both, exactly one stays.
    * An empty table gives an empty result.

    The digest is an output only; it decides nothing.
    """
    text = text_or_empty()
    rows = docs.select(
        "doc_id",
        F.length(text).alias("length"),
        normalise(text).cast("binary").alias("rest"),
    ).withColumn("sha", F.sha2("rest", 256))
    finished: list[DataFrame] = []
    opened: DataFrame | None = None
    for level, width in enumerate(runs()):
        if opened is None:
            rows = rows.withColumn("part", F.lit(0).cast("long"))
        else:
            rows = opened
        # the row number is taken when a level is written, so that it stays as it is from then on
        table = as_written_table(_split(rows, width, first=level == 0), "radix")
        single = F.col("part").isNull()
        finished.append(
            table.where(single).select(
                "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"),
            )
        )
        if level:
            finished.append(
                table.where(F.col("keep").isNotNull()).select(
                    "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
                    (F.col("keep.row") == F.col("row")).alias("kept"), F.col("sha").alias("text_sha256"),
                )
            )
        opened = table.where(F.col("part").isNotNull() & F.col("keep").isNull()).drop("keep", "group_size")
        if opened.isEmpty():
            break
    result = finished[0]
    for more in finished[1:]:
        result = result.unionByName(more)
    return result


def _split(rows: DataFrame, width: int, first: bool) -> DataFrame:
    """One level: ``part`` is the new group, null for a text that is alone; ``keep`` is set where the texts have ended.

    The first level only tells single texts from the rest, as its rows get their number when it is written;
    texts that have ended there go on with no bytes.
    """
    rest = F.col("rest")
    rows = rows.select(
        "*",
        F.substring(rest, 1, width).alias("run"),
        (F.octet_length(rest) <= (-1 if first else width)).alias("ended"),
    )
    keys = ["part", "run", "ended"]
    kept = F.struct(F.col("doc_id").alias("doc_id"), (F.lit(None).cast("long") if first else F.col("row")).alias("row"))
    best = F.struct(-F.col("length"), F.col("doc_id").isNull(), F.col("doc_id"), kept["row"])
    groups = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min_by(kept, best).alias("best"))
    groups = as_written_table(
        groups.where("n > 1").withColumn("next", F.monotonically_increasing_id()), "radix-groups"
    )
    beyond = F.expr(f"substring(rest, {width + 1})")
    number = F.monotonically_increasing_id() if first else F.col("row")
    # the same join at every size: a level's groups grow with the input
    return rows.join(groups.hint("merge"), keys, "left").select(
        "doc_id", "length", "sha", number.alias("row"),
        F.col("next").alias("part"),
        F.when(F.col("next").isNotNull() & ~F.col("ended"), beyond).alias("rest"),
        F.when(F.col("ended") & F.col("next").isNotNull(), F.col("best")).alias("keep"),
        F.col("n").alias("group_size"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, with one row of each group of equal texts.

    Rows are found again by id and digest. Where rows repeat both, the one with the most code points stays, as in
    the groups; the order of all its columns decides among equals.
    """
    name = "__llm_sha256"
    found = as_derived_table(exact_groups(docs), "radix-result")
    kept = found.where("kept").select(F.col("doc_id").alias("__llm_id"), F.col("text_sha256").alias("__llm_key"))
    rows = docs.withColumn(name, F.sha2(without_space(text_or_empty()).cast("binary"), 256))
    match = rows["doc_id"].eqNullSafe(kept["__llm_id"]) & (rows[name] == kept["__llm_key"])
    rows_kept = rows.join(kept, match, "left_semi")
    again = found.groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not again.isEmpty():
        place, length = "__llm_place", -F.length(text_or_empty())
        columns = F.to_json(F.struct(*docs.columns), {"ignoreNullFields": "false"})
        first = Window.partitionBy("doc_id", name).orderBy(length, columns)
        rows_kept = rows_kept.withColumn(place, F.row_number().over(first)).where(F.col(place) == 1).drop(place)
    return rows_kept.drop(name)
