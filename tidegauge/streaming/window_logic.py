"""A user's own logic per (device type, window) of a stream, with its state and a timer at the window's end."""

from __future__ import annotations

import math
import pickle
import sys
from collections import Counter
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from typing import Any, Protocol

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

from tidegauge.operators.windows import with_watermark
from tidegauge.schemas import AGGREGATE_SCHEMA, MAX_OUT_OF_ORDER, WINDOW_SIZE
from tidegauge.sources.sinks import BatchWriter

# Workers need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class WindowLogic(Protocol):
    """What is done with the events of one window and type.

    A state is made for the events of a task, events are added, states of one window are merged in any order, and
    when the window closes its state becomes rows. It is what travels and is kept, so its size matters, not the number of
    events.
    """

    def create(self) -> Any: ...

    def add(self, state: Any, temperature: float, humidity: float) -> Any: ...

    def merge(self, state: Any, other: Any) -> Any: ...

    def finish(self, device_type: str, start: datetime, end: datetime, state: Any) -> list[tuple]: ...


class MeanAndMedian:
    """Mean temperature and exact median humidity, as :func:`~tidegauge.operators.windows.aggregate_rows` gives them."""

    def create(self):
        # Temperatures are kept as doubles that do not overlap, whose sum is exact.
        return [], Counter()

    def add(self, state, temperature, humidity):
        parts, values = state
        values[humidity] += 1
        return _added(parts, temperature), values

    def merge(self, state, other):
        parts = state[0]
        for x in other[0]:
            parts = _added(parts, x)
        return parts, state[1] + other[1]

    def finish(self, device_type, start, end, state):
        parts, values = state
        n = values.total()
        ordered, before, middle = sorted(values), 0, []
        for value in ordered:
            before += values[value]
            while len(middle) < 2 and before > (n - 1 + len(middle)) // 2:
                middle.append(value)
        median = middle[0] if n % 2 else (middle[0] + middle[1]) / 2
        mean = math.fsum(parts) / n if all(map(math.isfinite, parts)) else sum(parts) / n
        return [(start.strftime("%H:%M"), end.strftime("%H:%M"), device_type, _rounded(mean), _rounded(median))]


def _rounded(x: float) -> float:
    return round(x, 2) if math.isfinite(x) else x


def _added(parts: list[float], x: float) -> list[float]:
    """Doubles with the same exact sum as ``parts`` and ``x``, few of them whatever the number added."""
    if not math.isfinite(x) or not all(map(math.isfinite, parts)):
        return [sum(parts) + x]
    out = []
    for y in parts:
        large, small = (x, y) if abs(x) >= abs(y) else (y, x)
        x = large + small
        if error := small - (x - large):
            out.append(error)
    return [*out, x]


class _Windows(StatefulProcessor):
    """Merges the partial states of a window and calls ``finish`` once the watermark has passed its end."""

    def __init__(self, logic: WindowLogic, names: list[str]):
        self._logic = logic
        self._names = names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._state = handle.getValueState("state", "state BINARY")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self._state.get() if self._state.exists() else None
        state = pickle.loads(held[0]) if held else self._logic.create()
        for row in rows:
            state = self._logic.merge(state, pickle.loads(row["state"]))
        self._state.update((pickle.dumps(state),))
        if not held:
            # It fires as soon as the watermark is at the window's end.
            self._handle.registerTimer(key[2])
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        state = pickle.loads(self._state.get()[0])
        self._state.clear()
        device_type, start, end = key
        for values in self._logic.finish(device_type, _utc(start), _utc(end), state):
            yield Row(**dict(zip(self._names, values)))

    def close(self) -> None:
        pass


def _utc(millis: int) -> datetime:
    return datetime.fromtimestamp(0, timezone.utc) + timedelta(milliseconds=millis)


def _partial_states(events: DataFrame, logic: WindowLogic, size: str) -> DataFrame:
    """One row per task, window and type: the state of its events and the newest time among them.

    What the shuffle and the state store see of a hot window is a row a task, not its events.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("device_type", "start", "event_time", "temperature", "humidity")]
            for device_type, start, at, temperature, humidity in zip(*columns):
                own = held.setdefault((device_type, start), [at, None])
                own[0] = max(own[0], at)
                own[1] = logic.add(logic.create() if own[1] is None else own[1], temperature, humidity)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([device_type for device_type, _ in held], pa.string()),
                pa.array([at for at, _ in held.values()], pa.timestamp("us", "UTC")),
                pa.array([pickle.dumps(state) for _, state in held.values()], pa.binary()),
            ],
            names=["device_type", "event_time", "state"],
        )

    placed = events.select(
        "device_type", F.window("event_time", size)["start"].alias("start"), "event_time", "temperature", "humidity"
    )
    return placed.mapInArrow(run, "device_type string, event_time timestamp, state binary")


def process_windows(
    events: DataFrame,
    logic: WindowLogic,
    rows: StructType,
    size: str = WINDOW_SIZE,
    delay: str = MAX_OUT_OF_ORDER,
) -> DataFrame:
    """Rows that ``logic`` makes of every window of enriched streaming ``events``, when the watermark passes its end.

    Events of windows that are closed already are dropped. Needs the RocksDB state store (:func:`start`).
    """
    # The newest time of a partial state lies in its window and moves the watermark as the events would.
    partial = with_watermark(_partial_states(events, logic, size), delay)
    windows = partial.select("device_type", F.window("event_time", size).alias("window"), "state")
    # The window stays beside the key: by its end, late states are told.
    keyed = windows.withColumns({name: F.unix_millis(F.col("window")[name]) for name in ("start", "end")})
    return keyed.groupBy("device_type", "start", "end").transformWithState(_Windows(logic, rows.names), rows, "append", "eventTime")


_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def start(
    spark: SparkSession,
    events: DataFrame,
    write: BatchWriter,
    checkpoint: str,
    logic: WindowLogic | None = None,
    rows: StructType = AGGREGATE_SCHEMA,
    size: str = WINDOW_SIZE,
    delay: str = MAX_OUT_OF_ORDER,
    **trigger,
) -> StreamingQuery:
    """Start the job on enriched streaming events, by default with the mean and the median.

    The session's state store setting is put back once the query has taken it over.
    """
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        writer = (
            process_windows(events, logic or MeanAndMedian(), rows, size, delay)
            .writeStream.outputMode("append")
            .option("checkpointLocation", checkpoint)
            .foreachBatch(lambda batch, batch_id: write(batch, batch_id))
        )
        return (writer.trigger(**trigger) if trigger else writer).start()
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)
