import pytest
from conftest import message, messages_frame
from pyspark.sql import functions as F

from tidegauge.operators.enrich import enrich, hot_ids
from tidegauge.operators.parse import accepted, parse_events
from tidegauge.schemas import DICTIONARY_SCHEMA
from tidegauge.sources import dictionary as d


def events(spark, ids):
    return accepted(parse_events(messages_frame(spark, [message(device_type_id=str(i)) for i in ids])))


def per_type(df):
    return {r["device_type"]: r["count"] for r in df.groupBy("device_type").count().collect()}


def test_every_event_is_kept_once_with_a_name(spark, device_types):
    found = enrich(events(spark, [3, 3, 1, 8, 9, -1]), device_types)
    assert found.columns == ["device_type", "event_time", "temperature", "humidity"]
    assert per_type(found) == {"weather_station": 2, "temperature_sensor": 1, "unknown_device_type": 3}


def test_empty_dictionary(spark):
    empty = d.snapshot(spark.createDataFrame([], DICTIONARY_SCHEMA))
    assert per_type(enrich(events(spark, [1, 2]), empty)) == {"unknown_device_type": 2}


def test_small_dictionary_is_broadcast_and_a_large_one_is_not(spark, device_types):
    large = d.Dictionary(device_types.frame, device_types.rows, broadcast_rows=4)
    one_hot_id = events(spark, [3] * 400 + [1, 9])
    assert "BroadcastHashJoin" in plan(enrich(one_hot_id, device_types))
    shuffled = enrich(one_hot_id, large)
    assert per_type(shuffled) == per_type(enrich(one_hot_id, device_types))
    # At the session's own threshold, which five rows are far below.
    assert "SortMergeJoin" in plan(shuffled) and "Broadcast" not in plan(shuffled)


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_hot_id_is_split_into_more_tasks_as_it_grows(spark, device_types):
    large = d.Dictionary(device_types.frame, device_types.rows, broadcast_rows=0)
    small_limits = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
    }
    for key, value in small_limits.items():
        spark.conf.set(key, value)
    try:
        tasks = []
        for size in (2_000, 20_000):
            ids = spark.range(size).select(F.when(F.col("id") % 50 == 0, F.col("id") % 4).otherwise(3).alias("i"))
            rows = ids.select(
                F.col("i").cast("int").alias("device_type_id"), F.lit(0).cast("timestamp").alias("event_time"),
                F.rand(1).alias("temperature"), F.rand(2).alias("humidity"),
            ).repartition(16)
            joined = enrich(rows, large)
            tasks.append(joined._jdf.queryExecution().toRdd().getNumPartitions())
            assert joined.count() == size
        assert tasks[1] > 2 * tasks[0]
    finally:
        for key in small_limits:
            spark.conf.unset(key)


def test_snapshot_does_not_see_later_changes(spark, tmp_path):
    path = str(tmp_path / "types")
    d.replace_table(d.default_device_types(spark), path)
    frozen = d.snapshot(d.read_table(spark, path))
    renamed = d.default_device_types(spark).withColumn("type_name", F.upper("type_name"))
    d.replace_table(renamed, path)
    assert per_type(enrich(events(spark, [3]), frozen)) == {"weather_station": 1}
    assert per_type(enrich(events(spark, [3]), d.snapshot(d.read_table(spark, path)))) == {"WEATHER_STATION": 1}


@pytest.mark.parametrize(
    "rows, problem",
    [
        ([(1, "a"), (1, "b")], "repeated ids"),
        ([(1, None)], "null names"),
        ([(None, "a")], "null ids"),
        ([(1, "x" * 101)], "names over 100 characters"),
    ],
)
def test_invalid_dictionary_is_refused(spark, tmp_path, rows, problem):
    frame = spark.createDataFrame(rows, "id INT, type_name STRING")
    with pytest.raises(ValueError, match=problem):
        d.snapshot(frame)
    with pytest.raises(ValueError, match=problem):
        d.replace_table(frame, str(tmp_path / "t"))
    assert not (tmp_path / "t").exists()


def test_names_may_repeat(spark):
    shared = d.snapshot(spark.createDataFrame([(1, "same"), (2, "same")], DICTIONARY_SCHEMA))
    assert per_type(enrich(events(spark, [1, 2, 2]), shared)) == {"same": 3}


def test_table_roundtrip(spark, tmp_path):
    d.replace_table(d.default_device_types(spark), str(tmp_path / "t"))
    assert sorted(map(tuple, d.read_table(spark, str(tmp_path / "t")).collect())) == [
        (1, "temperature_sensor"),
        (2, "humidity_sensor"),
        (3, "weather_station"),
        (4, "smart_thermostat"),
        (5, "air_quality_sensor"),
    ]


class Recorder:
    """Stands in for a reader or writer and records the calls made on it."""

    def __init__(self, result=None):
        self.calls = []
        self._result = result

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls.append((name, args, kwargs))
            return self._result if name in ("jdbc", "load") else self

        return call


def test_jdbc_read_takes_two_columns_and_the_callers_credentials(spark):
    class Session:
        read = Recorder(spark.createDataFrame([(1, "a", 0)], "id INT, type_name STRING, more INT"))

    got = d.read_jdbc(Session, "jdbc:postgresql://host/db", properties={"user": "u", "password": "p"})
    assert got.columns == ["id", "type_name"]
    assert Session.read.calls == [
        ("jdbc", ("jdbc:postgresql://host/db", "device_types"), {"properties": {"user": "u", "password": "p"}})
    ]


def test_a_wide_id_is_written_in_its_type(spark, tmp_path):
    path = str(tmp_path / "types")
    d.replace_table(spark.createDataFrame([(1, "a")], "id LONG, type_name STRING"), path)
    assert [tuple(r) for r in d.read_table(spark, path).collect()] == [(1, "a")]


def test_hot_ids_are_found_and_joined_apart(spark):
    """One id has a third of the events; only its entry is copied to all tasks."""
    rows = 9000
    given = spark.range(rows).selectExpr(
        "CAST(IF(id % 3 = 0, 7, IF(id % 50 = 1, NULL, id)) AS INT) AS device_type_id",
        "timestamp_seconds(id) AS event_time", "1D AS temperature", "CAST(id AS DOUBLE) AS humidity",
    )
    entries = spark.range(0, rows, 2).selectExpr("CAST(id AS INT) AS id", "concat('name ', id) AS type_name")
    entries = entries.unionByName(spark.sql("SELECT 7 AS id, 'hot' AS type_name"))
    large = d.snapshot(entries, broadcast_rows=0)
    assert hot_ids(given) == [7]
    assert hot_ids(given.limit(0)) == []
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        apart = enrich(given, large, [7])
        assert sorted(apart.collect()) == sorted(enrich(given, large).collect()) == sorted(enrich(given, d.snapshot(entries)).collect())
        plan = apart._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" in plan and "Generate" not in plan
        # The hot events are spread over the partitions of the shuffled join.
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spread = enrich(given, large, [7]).where("device_type = 'hot'").withColumn("task", F.spark_partition_id())
        counts = [r["count"] for r in spread.groupBy("task").count().collect()]
        assert sum(counts) == rows // 3 + 1 and len(counts) == 4 and max(counts) < rows // 9
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_problems_are_told_by_id(spark):
    rows = [(1, "a"), (1, "b"), (2, None), (3, "x" * 101), (None, "c"), (4, "fine"), (2, None)]
    got = {(r.id, r.problem): r.rows for r in d.problems(spark.createDataFrame(rows, "id INT, type_name STRING")).collect()}
    assert got == {
        (1, "repeated id"): 2, (2, "repeated id"): 2, (2, "null name"): 2, (3, "name over 100 characters"): 1, (None, "null id"): 1,
    }
    assert d.problems(d.default_device_types(spark)).count() == 0
