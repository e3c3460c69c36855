"""Declared schemas and the fixed values every result depends on."""

from pyspark.sql import types as T

# They decide names, labels and numbers in the output.
INPUT_TOPIC = "iot_events"
OUTPUT_TOPIC = "iot_aggregates"
UNKNOWN_TYPE = "unknown_device_type"
WINDOW_SIZE = "1 minute"
MAX_OUT_OF_ORDER = "5 seconds"
TYPE_NAME_LENGTH = 100
DEVICE_TYPES = [
    (1, "temperature_sensor"),
    (2, "humidity_sensor"),
    (3, "weather_station"),
    (4, "smart_thermostat"),
    (5, "air_quality_sensor"),
]

DICTIONARY_SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType(), False),
    T.StructField("type_name", T.StringType(), False),
])

EVENT_SCHEMA = T.StructType([
    T.StructField("device_id", T.StringType()),
    T.StructField("device_type_id", T.IntegerType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("humidity", T.DoubleType()),
])

AGGREGATE_SCHEMA = T.StructType([
    T.StructField("window_start", T.StringType()),
    T.StructField("window_end", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("avg_temperature", T.DoubleType()),
    T.StructField("median_humidity", T.DoubleType()),
])

# What the statistics need of an event.
STATISTICS_INPUT = ("device_type_id", "event_time", "temperature", "humidity")
