"""What is stored and added to: summaries, bitmaps, sketches, lookups, hashed partitions."""

import os
import random
import statistics
from datetime import datetime, timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from brisa.bindings import Model
from brisa.functions.aggregates import list_parts
from brisa.operators import distincts, loads, summaries
from brisa.operators.ordering import budget_cutoff
from brisa.plans import compare
from brisa.session import scratch_path
from brisa.sources import lookups, session_catalog
from brisa.streaming import ingest

SCHEMA = (
    "sensor_id BIGINT, period_from_utc TIMESTAMP_NTZ, period_to_utc TIMESTAMP_NTZ, parameter_name STRING, "
    "value DECIMAL(15,6), seq INT, period_date DATE"
)
START = datetime(2024, 1, 1)


def rows_of(*rows):
    out = []
    for sensor, hours, name, value, seq in rows:
        at = None if hours is None else START + timedelta(hours=hours)
        value = None if value is None else Decimal(value)
        out.append((sensor, at, at and at + timedelta(hours=1), name, value, seq, at and at.date()))
    return out


def local(path):
    return Path(path.removeprefix("file:"))


def files_of(path):
    return {str(p): (p.stat().st_mtime_ns, p.stat().st_size) for p in local(path).rglob("*.parquet")}


def scan_metric(df, name):
    """Collects the rows; the sum of a metric over the scans of the executed plan."""
    rows = df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), 0
    todo = [plan]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        elif node.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(node.plan())
        if node.nodeName().startswith("Scan") and node.metrics().contains(name):
            found += node.metrics().apply(name).value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return rows, found


def test_summary_follows_corrections_late_rows_and_repeats(spark):
    table, target, landed, state = (scratch_path(spark, n) for n in ("table", "summary", "landed", "state"))
    rng = random.Random(6)
    held = {}
    for run in range(4):
        batch = []
        for _ in range(60):
            key = (rng.randrange(6), rng.randrange(72))
            value = None if rng.random() < 0.1 else Decimal(rng.randrange(-5_000_000, 5_000_000)).scaleb(-6)
            batch.append((*key, rng.choice(["no2", "o3"]), value, len(batch)))
        batch.append((1, None, "o3", Decimal(1), 0))
        spark.createDataFrame(rows_of(*batch), SCHEMA).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(SCHEMA).parquet(landed)
        ingest.daily_summary_stream(stream, table, target, state, ["seq"]).awaitTermination()
        held |= {(s, h): (p, v) for s, h, p, v, _ in batch if h is not None}
        want = {}
        for (_, hour), (name, value) in held.items():
            want.setdefault(((START + timedelta(hours=hour)).date(), name), []).append(value)
        kept = summaries.merged(spark.read.schema(summaries.SCHEMA).parquet(target)).collect()
        assert {(r.day, r.parameter_name): (r.rows, r.n, r.total, r.squares) for r in kept} == {
            k: (len(v), len(x), sum(x, Decimal(0)), sum((y * y for y in x), Decimal(0))) for k, v in want.items() for x in [[y for y in v if y is not None]]
        }
    whole = summaries.daily_summary(spark.read.parquet(table))
    assert sorted(whole.collect()) == sorted(kept)
    for r in summaries.summary_statistics(whole).collect():
        values = [float(v) for p, v in held.values() if p == r.parameter_name and v is not None]
        assert float(r.mean_all) == pytest.approx(statistics.mean(values)) and r.sd_all == pytest.approx(statistics.stdev(values))


def test_a_batch_that_is_tried_anew_changes_the_summary_once(spark):
    table, target, landed = (scratch_path(spark, n) for n in ("table", "summary", "landed"))
    runs = [rows_of((1, 1, "o3", 10, 1), (2, 2, "o3", 4, 1)), rows_of((1, 1, "o3", 30, 1), (1, 30, "no2", 7, 1))]
    for i, run in enumerate(runs):
        spark.createDataFrame(run, SCHEMA).write.mode("append").parquet(landed)
        if i == 1:  # the load of the second batch was done, its end not noted
            batch = spark.createDataFrame(run, SCHEMA)
            changes = summaries.summary_changes(spark.read.parquet(table), batch, loads_key(), ["seq"])
            changes.write.parquet(f"{target}/batch=1")
            loads.upsert_partial(table, batch, loads_key(), [], ["parameter_name", "value"], ["seq"])
        stream = spark.readStream.schema(SCHEMA).parquet(landed)
        ingest.daily_summary_stream(stream, table, target, f"{target}-state", ["seq"]).awaitTermination()
    means = summaries.summary_means(summaries.merged(spark.read.schema(summaries.SCHEMA).parquet(target))).collect()
    assert sorted((r.day.day, r.parameter_name, float(r.mean_value), r.n) for r in means) == [(1, "o3", 17.0, 2), (2, "no2", 7.0, 1)]


def loads_key():
    return ["sensor_id", "period_from_utc", "period_to_utc"]


def test_means_of_a_batch_read_the_rows_of_its_keys(spark):
    table = scratch_path(spark, "table")
    many = rows_of(*[(s, h, "o3", s + h, 1) for s in range(50) for h in range(48)])
    loads.upsert_partial(table, spark.createDataFrame(many, SCHEMA), loads_key(), [], ["parameter_name", "value"], ["seq"])
    batch = spark.createDataFrame(rows_of((3, 5, "no2", 1, 1), (4, 6, "o3", 2, 1), (99, 6, "o3", 3, 1)), SCHEMA)
    found = summaries.summary_changes(spark.read.parquet(table), batch, loads_key(), ["seq"]).collect()
    assert sorted((r.parameter_name, r.rows, float(r.total)) for r in found) == [("no2", 1, 1.0), ("o3", 0, 2.0 + 3 - 8 - 10)]


def test_a_value_without_spread(spark):
    df = spark.createDataFrame(rows_of((1, 1, "o3", 5, 1), (1, 2, "no2", None, 1)), SCHEMA)
    summary = summaries.daily_summary(df)
    (row,) = summaries.summary_deviations(summary).collect()
    assert (row.parameter_name, row.n, row.sd_value) == ("o3", 1, None)
    assert summaries.summary_statistics(summary).collect()[0].sd_all is None
    assert summaries.merged(summary.limit(0)).collect() == []


def test_bitmaps_count_all_ids_and_add_up(spark):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), rng.choice([None, 0, 32767, 32768, rng.randrange(200_000)]), rng.randrange(40)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, x long, y long")
    maps = distincts.distinct_bitmaps(df, {"xs": "x", "ys": "y"}, ["g"])
    halves = [distincts.distinct_bitmaps(df.where(F.col("y") % 2 == i), {"xs": "x", "ys": "y"}, ["g"]) for i in (0, 1)]
    want = {g: (len({x for h, x, _ in rows if h == g and x is not None}), len({y for h, _, y in rows if h == g})) for g in "ab"}
    for found in (maps, distincts.merged_bitmaps(halves[0].unionByName(halves[1]), ["g"])):
        counts = distincts.bitmap_counts(found, ["xs", "ys"], ["g"])
        assert {r.g: (r.xs, r.ys) for r in counts.collect()} == want
    plan = maps._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "Expand" in df.groupBy("g").agg(F.count_distinct("x"), F.count_distinct("y"))._jdf.queryExecution().optimizedPlan().toString()
    none = distincts.bitmap_counts(distincts.distinct_bitmaps(df.limit(0), {"xs": "x"}), ["xs"]).collect()
    assert [r.xs for r in none] == [0]


def test_overview_by_bitmaps_has_no_expand(spark):
    from brisa.catalog import ENTRIES

    plan = ENTRIES["s_overview_bitmaps"].run(Model(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "count(distinct" not in plan


def test_sketches_of_days_answer_spans(spark):
    df = spark.range(0, 60_000).select((F.col("id") % 20_011).alias("x"), (F.col("id") % 30).alias("day"))
    stored = distincts.daily_sketches(df, "x", ["day"])
    for last in (0, 9, 29):
        exact = df.where(F.col("day") <= last).select(F.count_distinct("x")).first()[0]
        near = distincts.sketch_counts(stored.where(F.col("day") <= last), "n").first().n
        assert abs(near - exact) <= distincts.SKETCH_BOUND * exact


def test_a_lookup_reads_few_row_groups(spark):
    path, n = scratch_path(spark, "lookups"), 400_000
    df = spark.range(0, n).select(
        F.col("id").alias("place"), (F.col("id") * 7_919 % n).alias("id"), F.sha2(F.col("id").cast("string"), 256).alias("filler")
    )
    lookups.write_for_lookups(df, path, ["place"], ["id"], row_group_bytes=256 * 1024, ids_per_group=5_000, files=4)
    rows, read = scan_metric(lookups.look_up(spark, path, df.schema, "id", 7_919 * 1234 % n), "numOutputRows")
    assert [r.place for r in rows] == [1234] and 0 < read < n / 10
    rows, read = scan_metric(lookups.look_up(spark, path, df.schema, "place", 5), "numOutputRows")
    assert [r.id for r in rows] == [7_919 * 5 % n] and 0 < read < n / 10
    rows, _ = scan_metric(lookups.look_up(spark, path, df.schema, "id", 3, 4, -1), "numOutputRows")
    assert sorted(r.id for r in rows) == [3, 4]


def test_hashed_upsert_leaves_other_partitions_alone(spark):
    target, plain = scratch_path(spark, "hashed"), scratch_path(spark, "plain")
    schema = "k long, v string, seq int"
    first = spark.createDataFrame([(i, f"a{i}", 1) for i in range(500)] + [(None, "x", 1)], schema)
    second = spark.createDataFrame([(3, "b3", 2), (3, "old", 1), (7_000, "new", 1), (None, "y", 1)], schema)
    for batch in (first, second):
        before = files_of(target) if local(target).exists() else {}
        result = loads.upsert_hashed(target, batch, ["k"], ["seq"], buckets=32)
        same = loads.upsert(plain, batch, ["k"], ["seq"])
        assert result.columns == ["k", "v"] and sorted(map(str, result.collect())) == sorted(map(str, same.collect()))
    after = files_of(target)
    touched = {os.path.dirname(p) for p in before if before[p] != after.get(p)}
    assert len({os.path.dirname(p) for p in before}) > 25 and len(touched) <= 3


def test_touched_partitions_alone_are_read(spark):
    target = scratch_path(spark, "hashed")
    df = spark.range(0, 20_000).select(F.col("id").alias("k"), F.lit("v").alias("v"), F.lit(1).alias("seq"))
    loads.upsert_hashed(target, df, ["k"], ["seq"], buckets=50)
    stored = spark.read.parquet(target)
    batch = stored.where("k = 77").select("key_bucket")
    _, read = scan_metric(loads.touched(stored, batch, "key_bucket"), "numFiles")
    assert 0 < read <= 4


def test_list_parts_of_hot_values(spark):
    rng = random.Random(2)
    rows = [("hot", "aa")] * 5000 + [("hot", rng.choice(["b", "cc", "é", "x" * 40, None])) for _ in range(300)] + [("one", "z"), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v string")
    parts = list_parts(df, ["g"], "v", "text", part_chars=64).collect()
    for g in ("hot", "one", "none"):
        mine = sorted((r.part, r.text) for r in parts if r.g == g)
        assert ", ".join(text for _, text in mine) == ", ".join(sorted((v for h, v in rows if h == g and v is not None), key=lambda v: v.encode()))
        assert [p for p, _ in mine] == list(range(len(mine))) and all(len(text) < 64 + 42 for _, text in mine)
    assert len(parts) > 250


@pytest.mark.parametrize("budget", [0, 1, 7, 30, 500, 10_000])
def test_budget_over_ranges(spark, budget):
    rng = random.Random(budget)
    rows = [(rng.choice([f"g{i:02}" for i in range(40)] + [None]), i) for i in range(1000)]
    counts, kept, total = {}, set(), 0
    for g, _ in rows:
        counts[g] = counts.get(g, 0) + 1
    for g in sorted(g for g in counts if g is not None):
        if total >= budget:
            break
        kept.add(g)
        total += counts[g]
    result = budget_cutoff(spark.createDataFrame(rows, "g string, i int"), "g", budget)
    assert sorted(r.i for r in result.collect()) == [i for g, i in rows if g in kept]
    assert "SinglePartition" not in result._jdf.queryExecution().executedPlan().toString()


def test_differences_of_copies(spark):
    schema = "a long, b string, v double, w string"
    rows = [(i, "x", float(i), None) for i in range(200)] + [(7, None, 1.0, "n"), (8, "x", 8.0, None), (9, "x", 9.5, None)]
    source = spark.createDataFrame(rows, schema)
    assert compare.table_difference(source, source.select("w", "v", "b", "a").repartition(7), ["a", "b"], 8).collect() == []
    copy = [r for r in rows if r[0] not in (3, 8)] + [(8, "x", 8.0, None), (500, "x", 1.0, None), (500, None, 1.0, None)]
    copy = [(a, b, v, "" if a == 4 else w) for a, b, v, w in copy]
    found = compare.table_difference(source, spark.createDataFrame(copy, schema), ["a", "b"], 8).collect()
    assert sorted((r.a, r.b or "", r.difference) for r in found) == [
        (3, "x", "missing"), (4, "x", "changed"), (8, "x", "changed"), (500, "", "extra"), (500, "x", "extra"),
    ]
    with pytest.raises(ValueError):
        compare.table_difference(source, source.drop("w"), ["a"])


def test_ranges_outside_of_the_days(spark):
    m = spark.createDataFrame(rows_of((1, 0, "o3", 1, 1), (1, 50, "o3", 1, 1), (1, None, "o3", 1, 1)), SCHEMA)
    day = START.date()
    spans = [(0, "before", -9, -1), (1, "turned round", 1, 0), (2, "between", 1, 1), (3, "around", -400, 400), (4, "last", 2, 2), (5, "after", 3, 9)]
    ranges = spark.createDataFrame(
        [(i, name, day + timedelta(days=a), day + timedelta(days=b)) for i, name, a, b in spans], "ordinal int, range string, first_day date, last_day date"
    )
    found = compare.availability_of_ranges(m, ranges).collect()
    assert {r.range: (r.n, r.is_answer) for r in found} == {
        "before": (0, False), "turned round": (0, False), "between": (0, False), "around": (2, True), "last": (1, False), "after": (0, False),
    }
    assert {(r.n, r.is_answer) for r in compare.availability_of_ranges(m.limit(0), ranges).collect()} == {(0, False)}


def test_codes_seen_in_an_earlier_run_are_not_new(spark):
    path, target, state = (scratch_path(spark, n) for n in ("pages", "codes", "state"))
    for codes in (["a", "b", "a", None], ["b", "c", None], ["a"]):
        spark.createDataFrame([(c, 1) for c in codes], "code string, page int").write.mode("append").parquet(path)
        landed = spark.readStream.schema("code string, page int").parquet(path)
        ingest.new_codes_stream(landed, "code", target, state).awaitTermination()
    found = spark.read.schema("code string, batch long").parquet(target).collect()
    assert sorted((r.batch, r.code or "") for r in found) == [(0, ""), (0, "a"), (0, "b"), (1, "c")]


def test_catalog_tables_keep_other_partitions(spark):
    location = scratch_path(spark, "database")
    database = f"brisa_{location[-8:]}"
    assert len(session_catalog.create_tables(spark, database, location)) == 7 and session_catalog.create_tables(spark, database) == []
    rows = spark.createDataFrame(rows_of((1, 1, "o3", 1, 1), (2, 30, "o3", 2, 1)), SCHEMA).drop("seq")
    session_catalog.load_table(spark, database, "measurements", rows)
    session_catalog.load_table(spark, database, "measurements", rows.where("sensor_id = 2").withColumn("value", F.lit(9)))
    found = spark.table(f"{database}.measurements").select("sensor_id", "value", "has_flags").collect()
    assert sorted((r.sensor_id, int(r.value), r.has_flags) for r in found) == [(1, 1, False), (2, 9, False)]
    listed = {r.table_name: (r.rows, len(r.samples)) for r in session_catalog.catalog_inventory(spark, database).collect()}
    assert len(listed) == 7 and listed["measurements"] == (2, 2) and listed["countries"] == (0, 0)
