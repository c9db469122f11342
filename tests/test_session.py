"""The shared folder and the settings of a session."""

from types import SimpleNamespace

import pytest

from brisa.session import ADAPTIVE, AT_MOST, as_written_table, prepare, shared_folder


class Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


def session(master, **conf):
    context = SimpleNamespace(master=master, applicationId=f"app-{master}")
    return SimpleNamespace(conf=Conf(conf), sparkContext=context)


def test_the_named_folder_is_used_everywhere():
    named = session("spark://head:7077", **{"spark.checkpoint.dir": "hdfs://shared/ck/"})
    assert shared_folder(named) == "hdfs://shared/ck"


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session("yarn"))


def test_a_local_session_keeps_its_own_folder():
    local = session("local[2]")
    assert shared_folder(local) == shared_folder(local)


def test_prepare_leaves_the_partitions_to_the_cluster(spark):
    names = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"]
    before = [spark.conf.get(name, None) for name in names]
    prepare(spark)
    assert [spark.conf.get(name, None) for name in names] == before
    assert all(spark.conf.get(name) == value for name, value in ADAPTIVE.items())


def test_prepare_bounds_what_one_task_takes(spark):
    before = {name: spark.conf.get(name) for name in AT_MOST}
    try:
        for given, kept in (("64MB", None), ("67108864b", None), ("1g", None), ("16k", "16k"), ("4096", "4096")):
            for name, most in AT_MOST.items():
                spark.conf.set(name, given)
                prepare(spark)
                assert spark.conf.get(name) == (kept or str(most))
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_written_table_keeps_rows_and_schema(spark):
    df = spark.range(10).selectExpr("id", "CAST(id AS DECIMAL(15,6)) AS value", "CAST(NULL AS STRING) AS t")
    written = as_written_table(df, "check")
    assert written.schema.simpleString() == df.schema.simpleString() and written.count() == 10
