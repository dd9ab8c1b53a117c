"""The number and size of shuffle tasks follow the input."""

import __spark_entry__ as E
from conftest import SMALL
from tallyhall import session
from tallyhall.sinks.files import Store


def test_shuffle_partitions_follow_the_input(spark):
    key, task = session._FIRST, session._TASK
    session.unsize_tasks(spark)
    try:
        session.size_tasks(spark, 10 * session.INPUT_BYTES)
        assert spark.conf.get(key) == "10" and spark.conf.get(task) == str(session.TASK_BYTES)
        assert spark.range(1000).repartition("id").rdd.getNumPartitions() <= 10
        session.size_tasks(spark, 100 * session.INPUT_BYTES)
        assert spark.conf.get(key) == "100"
        session.size_tasks(spark, 1)
        assert spark.conf.get(key) == spark.conf.get("spark.sql.shuffle.partitions")
    finally:
        session.unsize_tasks(spark)
    assert spark.conf.get(key, None) is None and spark.conf.get(task, None) is None


def test_a_session_with_its_own_sizes_keeps_them(spark):
    session.unsize_tasks(spark)
    spark.conf.set(session._TASK, "3m")
    try:
        session.size_tasks(spark, 100 * session.INPUT_BYTES)
        assert spark.conf.get(session._TASK) == "3m" and spark.conf.get(session._FIRST) == "100"
        session.unsize_tasks(spark)
        assert spark.conf.get(session._TASK) == "3m" and spark.conf.get(session._FIRST, None) is None
    finally:
        spark.conf.unset(session._TASK)


def test_catalogue_queries_size_their_tasks_and_operators_do_not(spark):
    assert Store(spark, SMALL).size(f"{SMALL}/lineitem.parquet") > 0 and Store(spark, SMALL).size(f"{SMALL}/none.parquet") == 0
    try:
        E.queries()["week_event_drilldown"](spark, SMALL)
        assert spark.conf.get(session._TASK) == str(session.TASK_BYTES)
    finally:
        session.unsize_tasks(spark)
