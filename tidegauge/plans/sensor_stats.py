"""The whole job over a bounded set of messages."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidegauge.operators.enrich import enrich
from tidegauge.operators.parse import accepted, parse_events
from tidegauge.operators.windows import aggregate_rows, window_stats
from tidegauge.schemas import STATISTICS_INPUT, WINDOW_SIZE
from tidegauge.sources.dictionary import Dictionary

VIEW = "iot_aggregates_view"


def enriched_events(messages: DataFrame, dictionary: Dictionary) -> DataFrame:
    """Messages to enriched events; works on batch and streaming frames alike."""
    return enrich(accepted(parse_events(messages, keep=STATISTICS_INPUT)), dictionary)


def sensor_stats(messages: DataFrame, dictionary: Dictionary, size: str = WINDOW_SIZE) -> DataFrame:
    """Aggregate rows of every window in ``messages``, the last one included."""
    return aggregate_rows(window_stats(enriched_events(messages, dictionary), size))


def select_from_view(rows: DataFrame, view: str = VIEW) -> DataFrame:
    """Register the rows as a temporary view and select the output columns by SQL."""
    rows.createOrReplaceTempView(view)
    return rows.sparkSession.sql(
        f"SELECT window_start, window_end, device_type, avg_temperature, median_humidity FROM {view}"
    )
