"""Reading, writing and labelling event times as column expressions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the accepted ISO-8601 grammar. Any one character may separate date and time, the
# fraction has 3 or 6 digits, and an offset has at least hours and minutes.
ISO_TIMESTAMP = (
    r"(?s)^(?!0000)\d{4}-\d{2}-\d{2}"
    r"(?:.\d{2}(?::\d{2}(?::\d{2}(?:\.\d{3}(?:\d{3})?)?)?)?"
    r"(?:[+-]\d{2}:\d{2}(?::\d{2}(?:\.\d{6})?)?)?)?\z"
)
DAY_IN_MICROS = 24 * 60 * 60 * 1_000_000


def _number(text: Column, start: int, length: int) -> Column:
    # Not left to a failing cast: an empty text would cost an exception per row.
    return F.when(F.length(text) >= start, F.substring(text, start, length).try_cast("bigint")).otherwise(0)


def parse_event_times(df: DataFrame, text: str, into: str = "event_time") -> DataFrame:
    """Add ``into``: the ISO-8601 text as a timestamp cut to milliseconds, null when not accepted.

    Spark's cast reads the usual form, which ends in an offset. What it cannot read (offsets from 18
    hours up to a day, other separators), or would read in the session zone (no offset, which means
    UTC here), is taken apart. Steps are columns of their own so that each is evaluated once.
    """
    iso, offset, clock, shift = F.col("_iso"), F.col("_offset"), F.col("_clock"), F.col("_shift")
    # No accepted text of 19 or more characters has a sign here unless it starts the offset.
    ends_in_offset = (F.length(iso) >= 19) & F.substring(iso, -6, 1).isin("+", "-")
    steps = (
        df.withColumn("_iso", F.replace(F.col(text), F.lit("Z"), F.lit("+00:00")))
        .withColumn("_iso", F.when(iso.rlike(ISO_TIMESTAMP), iso))
        .withColumn("_micros", F.unix_micros(F.when(ends_in_offset, iso.try_cast("timestamp"))))
        .withColumn("_iso", F.when(F.col("_micros").isNull(), iso))
        .withColumn("_offset", F.regexp_extract(iso, "(?s)^.{11,}?([+-].*)", 1))
        .withColumns({
            "_clock": F.substr(iso, F.lit(12), F.length(iso) - F.length(offset) - 11),
            "_shift": (_number(offset, 2, 2) * 3600 + _number(offset, 5, 2) * 60 + _number(offset, 8, 2))
            * 1_000_000
            + _number(offset, 11, 6),
        })
    )
    # Hours alone, or hours and minutes, are filled up with zeros.
    full_clock = F.concat(
        F.when(clock == "", "00").otherwise(clock),
        F.when(F.length(clock) <= 2, ":00:00").when(F.length(clock) == 5, ":00").otherwise(""),
    )
    local = F.concat(F.substring(iso, 1, 10), F.lit("T"), full_clock, F.lit("Z")).try_cast("timestamp")
    shifted = F.unix_micros(local) - F.when(F.startswith(offset, F.lit("-")), -shift).otherwise(shift)
    micros = F.coalesce("_micros", F.when(shift < DAY_IN_MICROS, shifted))
    # Integer division cuts towards the epoch.
    millis = F.call_function("div", micros, F.lit(1000))
    return steps.withColumn(into, F.timestamp_millis(millis)).drop("_iso", "_micros", "_offset", "_clock", "_shift")


def format_event_time(at: Column) -> Column:
    """Timestamp to ISO-8601 text with offset; the fraction is left out when it is zero."""
    whole = F.unix_micros(at) % 1_000_000 == 0
    return F.when(whole, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ssxxx")).otherwise(
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    )


def event_time_millis(at: Column) -> Column:
    """Milliseconds since the epoch."""
    return F.unix_millis(at)


def minute_label(at: Column) -> Column:
    """``HH:MM`` in the session zone (UTC after :func:`tidegauge.session.configure`)."""
    return F.date_format(at, "HH:mm")
