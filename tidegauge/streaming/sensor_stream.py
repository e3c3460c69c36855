"""The whole job over an unbounded stream of messages."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from tidegauge.operators.enrich import enrich
from tidegauge.operators.parse import accepted, parse_events, quarantined
from tidegauge.operators.windows import aggregate_rows, stats_from_counts, value_counts, with_watermark
from tidegauge.schemas import EVENT_SCHEMA, MAX_OUT_OF_ORDER, STATISTICS_INPUT, WINDOW_SIZE
from tidegauge.sources.dictionary import Dictionary
from tidegauge.sources.sinks import BatchWriter

ACCEPTED, REJECTED = "accepted", "rejected"


def closed_window_counts(
    messages: DataFrame,
    dictionary: Dictionary | None,
    size: str = WINDOW_SIZE,
    delay: str = MAX_OUT_OF_ORDER,
    hot: Sequence[int] = (),
) -> DataFrame:
    """Value counts of each window, emitted once, when the watermark has passed its end.

    ``messages`` are raw messages, or events that :func:`start_split` has parsed already, or that
    :mod:`~tidegauge.streaming.refreshed` has named already.
    """
    if "device_type" in messages.columns:
        return value_counts(with_watermark(messages, delay), size)
    if set(EVENT_SCHEMA.names) <= set(messages.columns):
        return value_counts(with_watermark(enrich(messages, dictionary, hot), delay), size)
    parsed = parse_events(messages, keep=STATISTICS_INPUT).observe(
        "messages",
        F.count("*").alias("read"),
        F.count("reject_reason").alias("rejected"),
    )
    return value_counts(with_watermark(enrich(accepted(parsed), dictionary, hot), delay), size)


def finish_batch(write: BatchWriter, on_written: Callable[[int, int], None] | None = None):
    """The batch function that turns closed-window counts into aggregate rows and writes them.

    All counts of a window arrive in the one batch that closes it, so each batch is a complete
    input for the batch operators. ``on_written`` is told the batch id and the number of rows once
    a batch has been written; a failed write fails the query. The rows are counted by the first
    action of ``write``.
    """

    def finish(counts: DataFrame, batch_id: int) -> None:
        held: list[DataFrame] = []

        def keep(df: DataFrame) -> DataFrame:
            held.append(df.persist(StorageLevel.MEMORY_AND_DISK))
            return held[-1]

        try:
            counts = keep(counts)
            # Counting, unlike a look for one row, runs all partitions of the batch at once.
            if counts.count():
                rows = aggregate_rows(stats_from_counts(counts, keep=keep))
                if on_written:
                    written = Observation()
                    write(rows.observe(written, F.count("*").alias("rows")), batch_id)
                    on_written(batch_id, written.get["rows"])
                else:
                    write(rows, batch_id)
        finally:
            for df in held:
                df.unpersist()

    return finish


def start(
    messages: DataFrame,
    dictionary: Dictionary | None,
    write: BatchWriter,
    checkpoint: str,
    size: str = WINDOW_SIZE,
    delay: str = MAX_OUT_OF_ORDER,
    on_written: Callable[[int, int], None] | None = None,
    hot: Sequence[int] = (),
    **trigger,
) -> StreamingQuery:
    """Start the job. ``trigger`` is passed on, e.g. ``availableNow=True`` for a finite run.

    ``hot`` are the ids that many events have; it matters for a dictionary too large to broadcast only.

    A restart with the same ``checkpoint`` resumes where the job stopped.
    """
    writer = (
        closed_window_counts(messages, dictionary, size, delay, hot)
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(finish_batch(write, on_written))
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def start_quarantine(messages: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Keep every rejected message, whole, with the reason, as a stream of its own."""
    writer = (
        quarantined(parse_events(messages))
        .writeStream.format("json")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def start_split(messages: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Parse every message once into a table of files split by outcome, accepted and rejected.

    The statistics then read the accepted part (:func:`stream_accepted`), so that keeping rejected
    messages (:func:`read_rejected`) costs no second pass over the topic.
    """
    outcome = F.when(F.col("reject_reason").isNull(), ACCEPTED).otherwise(REJECTED)
    # The message itself is kept only where it was refused.
    value = F.when(F.col("reject_reason").isNotNull(), F.col("value"))
    writer = (
        parse_events(messages)
        .select(*EVENT_SCHEMA.names, value.alias("value"), "reject_reason", outcome.alias("outcome"))
        .writeStream.format("parquet")
        .partitionBy("outcome")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def stream_accepted(spark: SparkSession, path: str) -> DataFrame:
    """The accepted events of :func:`start_split`, as a stream."""
    split = spark.readStream.schema(_split_schema()).parquet(path)
    return split.where(F.col("outcome") == ACCEPTED).select(*EVENT_SCHEMA.names)


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """The rejected messages of :func:`start_split` with the reason, as they are now."""
    split = spark.read.schema(_split_schema()).parquet(path)
    return split.where(F.col("outcome") == REJECTED).select("value", F.col("reject_reason").alias("reason"))


def _split_schema() -> StructType:
    texts = [StructField(name, StringType()) for name in ("value", "reject_reason", "outcome")]
    return StructType([*EVENT_SCHEMA.fields, *texts])
