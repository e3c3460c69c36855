import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidegauge.sources import archive
from tidegauge.sources.messages import decode_value

START = datetime.datetime(2026, 6, 2, tzinfo=datetime.UTC)
SCHEMA = "key STRING, value STRING, partition INT, offset LONG, timestamp TIMESTAMP"


def record(partition, offset):
    return (None, f"{partition}/{offset}", partition, offset, START + datetime.timedelta(seconds=offset))


@pytest.fixture
def path(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archive, "BLOCK", 10)
    rows = [record(p, o) for p in range(3) for o in range(95) if o % 7]
    for part in (rows[::2], rows[1::2]):
        archive.append(spark.createDataFrame(part, SCHEMA), str(tmp_path / "topic"))
    return str(tmp_path / "topic")


def values(records):
    return sorted(r.value for r in decode_value(records).collect())


def expected(chosen):
    return sorted(f"{p}/{o}" for p in range(3) for o in range(95) if o % 7 and chosen(p, o))


def test_all_of_it(spark, path):
    records = archive.read(spark, path)
    assert sorted(records.columns) == ["key", "offset", "partition", "timestamp", "value"]
    assert values(records) == expected(lambda p, o: True)
    assert values(archive.read(spark, path, "earliest", "latest")) == expected(lambda p, o: True)


@pytest.mark.parametrize(
    "starts, ends",
    [({0: 30}, {}), ({}, {1: 41}), ({0: 29, 1: 31, 2: 90}, {0: 31, 1: 31, 2: 900}), ({0: -2, 1: 50}, {0: 20, 1: -1}), ({2: 500}, {0: 0})],
)
def test_ranges(spark, path, starts, ends):
    def chosen(p, o):
        start, end = starts.get(p, -2), ends.get(p, -1)
        return o >= start and (end == -1 or o < end)

    assert values(archive.read(spark, path, starts, ends)) == expected(chosen)


def test_only_the_blocks_of_the_range_are_opened(spark, path):
    condition = archive.between({0: 35, 1: 90, 2: 95}, {0: 52, 1: 95, 2: 96})
    chosen = spark.read.schema(archive.SCHEMA).parquet(path).where(condition)
    opened = {tuple(r.f.split("/")[-3:-1]) for r in chosen.select(F.col("_metadata.file_path").alias("f")).collect()}
    # 35-39, 40-49, 50-51, 90-94: of thirty blocks, four.
    assert opened == {("partition=0", f"first_offset={b}") for b in (30, 40, 50)} | {("partition=1", "first_offset=90")}
    scan = next(line for line in str(chosen._jdf.queryExecution().executedPlan()).splitlines() if "FileScan" in line)
    folders, offsets = scan.split("PartitionFilters")[1].split("PushedFilters")
    assert "first_offset" in folders and "partition" in folders and "offset" in offsets


def test_positions_of_a_time(spark, path):
    millis = int(START.timestamp() * 1000)
    assert archive.positions_at(spark, path, millis + 35_000) == {0: 36, 1: 36, 2: 36}
    assert archive.positions_at(spark, path, millis + 10**7) == {0: 95, 1: 95, 2: 95}
    assert archive.positions_at(spark, path, 0) == {0: 1, 1: 1, 2: 1}
    assert values(archive.read(spark, path, archive.positions_at(spark, path, millis + 35_500))) == expected(lambda p, o: o > 35)


def test_a_stream_begins_at_its_start_and_goes_on(spark, path, tmp_path):
    def run():
        records = decode_value(archive.stream(spark, path, {0: 90, 1: 93, 2: 94}))
        records.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
            "checkpointLocation", str(tmp_path / "state")
        ).trigger(availableNow=True).start().awaitTermination()
        return sorted(r.value for r in spark.read.parquet(str(tmp_path / "out")).collect())

    first = expected(lambda p, o: o >= (90, 93, 94)[p])
    assert run() == first
    archive.append(spark.createDataFrame([record(0, 3000), record(1, 2), record(5, 1)], SCHEMA), path)
    assert run() == sorted([*first, "0/3000", "5/1"])


def test_defined_cases(spark, tmp_path):
    for wrong in ("latest", {0: -1}, {0: -7}):
        with pytest.raises(ValueError, match="no such position"):
            archive.between(starting=wrong)
    with pytest.raises(ValueError, match="no such position"):
        archive.between(ending="earliest")
    for row in ((None, "x", None, 1, None), (None, "x", 1, None, None)):
        with pytest.raises(PySparkException, match="record without"):
            archive.append(spark.createDataFrame([row], SCHEMA), str(tmp_path / "refused"))
    extra = spark.createDataFrame([("k", None, 0, 7, None, 9)], SCHEMA + ", first_offset LONG")
    archive.append(extra, str(tmp_path / "one"))
    row = archive.read(spark, str(tmp_path / "one")).first()
    assert (bytes(row.key), row.value, row.partition, row.offset, row.timestamp) == (b"k", None, 0, 7, None)
