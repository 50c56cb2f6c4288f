"""Schemas of the tables and streams the operators work on."""

from pyspark.sql import types as T

_S, _D, _L, _TS = T.StringType(), T.DoubleType(), T.LongType(), T.TimestampType()


def _fields(*specs: tuple) -> T.StructType:
    return T.StructType([T.StructField(*spec) for spec in specs])


# One message of a reading topic; the time travels as ISO-8601 text.
READING_SCHEMA = _fields(
    ("sensor_id", _S),
    ("sensor_type", _S),
    ("location", _S),
    ("timestamp", _S),
    ("value", _D),
    ("unit", _S),
    ("status", _S),
    ("metadata", T.MapType(_S, _S)),
)

# The same message with every scalar still text, so that a number sent as text can be coerced and a bad one reported.
RAW_READING_SCHEMA = _fields(
    *[(f.name, _S if f.name != "metadata" else f.dataType) for f in READING_SCHEMA.fields]
)

# Columns of a broker source; file replays of a topic carry the same ones.
ENVELOPE_SCHEMA = _fields(
    ("topic", _S),
    ("partition", T.IntegerType()),
    ("offset", _L),
    ("timestamp", _TS),
    ("key", T.BinaryType()),
    ("value", T.BinaryType()),
)

# Readings table: everything but the location is required.
READINGS_TABLE = _fields(
    ("id", _L, False),
    ("sensor_id", _S, False),
    ("sensor_type", _S, False),
    ("value", _D, False),
    ("unit", _S, False),
    ("timestamp", _TS, False),
    ("location", _S, True),
)

# Tags that tell one time series from another.
SERIES_KEY = ("sensor_id", "sensor_type", "location", "status")

# Reading topics and output topics.
READING_TOPICS = ("sensors.temperature", "sensors.vibration", "sensors.pressure", "sensors.humidity")
ALERT_TOPIC = "alerts.anomalies"
MINUTE_TOPIC = "aggregations.minute"
HOUR_TOPIC = "aggregations.hour"

# Statuses that mean an alarm.
ALARM_STATUSES = ("HIGH_ALARM", "LOW_ALARM")
