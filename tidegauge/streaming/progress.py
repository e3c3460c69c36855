"""What a running job has read, rejected and dropped (``on_written`` tells what it has written)."""

from __future__ import annotations

import threading

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


def summarize(progress) -> dict:
    """The counters of one micro-batch."""
    observed = progress.observedMetrics.get("messages")
    return {
        "batch_id": progress.batchId,
        "input_rows": progress.numInputRows,
        "rejected": observed["rejected"] if observed else 0,
        "late_groups_dropped": sum(s.numRowsDroppedByWatermark for s in progress.stateOperators),
        "state_rows": sum(s.numRowsTotal for s in progress.stateOperators),
        "watermark": progress.eventTime.get("watermark"),
    }


def delivery_report(query: StreamingQuery) -> list[dict]:
    """Counters of the micro-batches Spark still remembers of a query, the last hundred or so.

    :class:`DeliveryTotals` adds up all of them.
    """
    return [summarize(p) for p in query.recentProgress]


class DeliveryListener(StreamingQueryListener):
    """Passes the counters of every micro-batch, or the failure of a query, to callbacks."""

    def __init__(self, on_batch, on_failure=None):
        self._on_batch = on_batch
        self._on_failure = on_failure

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        self._on_batch(summarize(event.progress))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if event.exception and self._on_failure:
            self._on_failure(event.exception)


class DeliveryTotals(StreamingQueryListener):
    """Adds up the counters of all micro-batches of one query, however many there are.

    Use it as a context around the start of the query; ``wait`` returns the totals once the query's
    end, which is told after its batches, has been heard.
    """

    COUNTERS = ("input_rows", "rejected", "late_groups_dropped")

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._totals: dict[str, dict[str, int]] = {}
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def __enter__(self) -> DeliveryTotals:
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, *failure) -> None:
        self._spark.streams.removeListener(self)

    def _end(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        counters = summarize(event.progress)
        with self._lock:
            own = self._totals.setdefault(str(event.progress.runId), dict.fromkeys(self.COUNTERS, 0))
            for name in self.COUNTERS:
                own[name] += counters[name]

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self._end(str(event.runId)).set()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> dict[str, int]:
        query.awaitTermination()
        if not self._end(str(query.runId)).wait(seconds):
            raise TimeoutError("the end of the query was not reported")
        return self._totals.get(str(query.runId), dict.fromkeys(self.COUNTERS, 0))
