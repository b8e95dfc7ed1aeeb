"""Session settings, without starting another session."""

from unittest import mock

from tidemark import session


def built(**arguments):
    with mock.patch.object(session, "SparkSession") as spark_session:
        builder = spark_session.builder.appName.return_value
        builder.master.return_value = builder.config.return_value = builder
        session.build_session(**arguments)
        return {c.args[0]: c.args[1] for c in builder.config.call_args_list}


def test_tasks_of_a_shuffle(spark):
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert session.shuffle_tasks(spark) == 8
    spark.conf.set(name, "30")
    try:
        assert session.shuffle_tasks(spark) == 30
    finally:
        spark.conf.unset(name)


def test_defaults_give_way_to_the_caller():
    conf = built(conf={"spark.sql.session.timeZone": "Asia/Tokyo", "x": "y"})
    assert conf["spark.sql.session.timeZone"] == "Asia/Tokyo"
    assert conf["x"] == "y" and conf["spark.ui.enabled"] == "false"


def test_shuffles_are_sized_by_their_data():
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert name not in built()
    small, large, huge = (built(largest_shuffle=n) for n in (1, 1 << 40, 100 << 40))
    assert [c[name] for c in (small, large, huge)] == ["200", "4096", "50000"]
    scan = "spark.sql.files.maxPartitionBytes"
    assert [c[scan] for c in (small, large, huge)] == [
        str(128 << 20),
        str(128 << 20),
        str(1 << 30),
    ]
