"""Raw messages to typed events, with rejected messages kept apart."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.event_time import parse_event_times
from tidegauge.functions.json_fields import Field, is_object, is_single_value, parse_document, with_kinds
from tidegauge.schemas import EVENT_SCHEMA

DOCUMENT = "_document"


def _bound(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns, unchanged, as the output of a generator.

    Predicate pushdown stops at a generator: without one, each filter on a result column (also the
    not-null filter that ``window`` implies) would copy the whole parse below itself. Spark also
    compiles what follows as a method of its own; in a single method the parse would pass the 8000
    bytes above which the JVM interprets instead of compiling.
    """
    return df.select(F.inline(F.array(F.struct(*columns))))


def _shape_reason(time: Field) -> Column:
    """Why the message has no event time to look at, if so."""
    return (
        F.when(F.col(DOCUMENT).isNull() | ~is_single_value(DOCUMENT), "malformed_json")
        .when(time.is_missing() & ~is_object(DOCUMENT), "not_an_object")
        .when(time.is_missing(), "missing_event_time")
    )


def _field_reason(fields: dict[str, Field]) -> Column:
    """The first of the other fields that is missing or not of its type, if any."""
    reason = F.when(fields["device_id"].is_missing(), "missing_device_id")  # any value will do
    for name in ("device_type_id", "temperature", "humidity"):
        reason = reason.when(fields[name].is_missing(), f"missing_{name}").when(F.col(name).isNull(), f"bad_{name}")
    return reason


def parse_events(messages: DataFrame, value: str = "value", keep: Sequence[str] | None = None) -> DataFrame:
    """Add the five event columns and ``reject_reason`` (null for an accepted message).

    ``keep`` names the columns of the messages and of the event that are needed; the others are
    checked all the same but not carried along. By default all are.

    Every message yields exactly one row. The reason is the first rule that fails: the shape of the
    message, its time, then the other fields. To use accepted and rejected rows of a large batch,
    keep the result with :func:`tidegauge.session.written`, so that it is parsed once.
    """
    parsed = messages.select("*", F.explode(F.array(parse_document(F.col(value)))).alias(DOCUMENT))
    parsed = with_kinds(parsed, DOCUMENT, EVENT_SCHEMA.names)
    fields = {name: Field(DOCUMENT, name) for name in EVENT_SCHEMA.names}
    typed = parsed.withColumns({
        "device_id": fields["device_id"].any_text(),
        "device_type_id": fields["device_type_id"].integer(),
        "temperature": fields["temperature"].double(),
        "humidity": fields["humidity"].double(),
        "_time": fields["event_time"].json_string(),
        "_shape": _shape_reason(fields["event_time"]),
    }).withColumn("_fields", _field_reason(fields))
    given = [name for name in messages.columns if keep is None or name in keep]
    wanted = [name for name in EVENT_SCHEMA.names if keep is None or name in keep or name == "event_time"]
    values = [name for name in wanted if name != "event_time"]
    timed = parse_event_times(_bound(typed, *given, *values, "_time", "_shape", "_fields"), "_time")
    bad_time = F.when(F.col("event_time").isNull(), "bad_event_time")
    checked = timed.withColumn("reject_reason", F.coalesce("_shape", bad_time, "_fields"))
    return _bound(checked, *given, *wanted, "reject_reason")


def accepted(parsed: DataFrame) -> DataFrame:
    """The events of :func:`parse_events` that passed every rule, with the event columns it kept."""
    columns = [name for name in EVENT_SCHEMA.names if name in parsed.columns]
    return parsed.where(F.col("reject_reason").isNull()).select(*columns)


def quarantined(parsed: DataFrame, value: str = "value") -> DataFrame:
    """The messages that failed a rule, whole, with the first rule they failed."""
    return parsed.where(F.col("reject_reason").isNotNull()).select(
        F.col(value).alias("value"), F.col("reject_reason").alias("reason")
    )
