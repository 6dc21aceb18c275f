"""Declared schemas (never inferred).

READING      one sensor message, as sent on the bus (time still text).
WINDOW_AVG   one closed tumbling window per device.
METRIC       one sample of a named series with string labels.
ENVELOPE     a bus record: the column layout of Spark's Kafka source, so the
             same code reads a live topic or a replayed file of records.
"""

from pyspark.sql import types as T

READING = T.StructType([
    T.StructField("device_id", T.StringType(), True),
    T.StructField("timestamp", T.StringType(), True),
    T.StructField("temperature", T.DoubleType(), True),
    T.StructField("humidity", T.DoubleType(), True),
    T.StructField("status", T.StringType(), True),
])

# Wire form used for decoding: numbers are read as text first so that a quoted
# number ("31.5") is accepted the way a lenient float() would, then cast.
READING_WIRE = T.StructType([
    T.StructField("device_id", T.StringType(), True),
    T.StructField("timestamp", T.StringType(), True),
    T.StructField("temperature", T.StringType(), True),
    T.StructField("humidity", T.StringType(), True),
    T.StructField("status", T.StringType(), True),
])

READING_TYPED = T.StructType([
    T.StructField("device_id", T.StringType(), True),
    T.StructField("ts", T.TimestampType(), True),
    T.StructField("temperature", T.DoubleType(), True),
    T.StructField("humidity", T.DoubleType(), True),
    T.StructField("status", T.StringType(), True),
])

WINDOW_AVG = T.StructType([
    T.StructField("device_id", T.StringType(), True),
    T.StructField("window_start", T.TimestampType(), True),
    T.StructField("window_end", T.TimestampType(), True),
    T.StructField("avg_temp", T.DoubleType(), True),
])

METRIC = T.StructType([
    T.StructField("metric", T.StringType(), True),
    T.StructField("labels", T.MapType(T.StringType(), T.StringType()), True),
    T.StructField("ts", T.TimestampType(), True),
    T.StructField("value", T.DoubleType(), True),
])

ENVELOPE = T.StructType([
    T.StructField("key", T.BinaryType(), True),
    T.StructField("value", T.BinaryType(), True),
    T.StructField("topic", T.StringType(), True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("offset", T.LongType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
])

# Window-average message as it travels on the averages topic (times as text,
# number read as text first, like READING_WIRE).
WINDOW_AVG_WIRE = T.StructType([
    T.StructField("device_id", T.StringType(), True),
    T.StructField("window_start", T.StringType(), True),
    T.StructField("window_end", T.StringType(), True),
    T.StructField("avg_temperature", T.StringType(), True),
])

# Both kinds of message as one, so that a consumer of both topics parses once.
ROUTED_WIRE = T.StructType([*READING_WIRE.fields,
                            *(f for f in WINDOW_AVG_WIRE.fields if f.name != "device_id")])

# Window-average message written by the windowed job (avg_temp, P7 encoding).
WINDOW_AVG_MESSAGE = T.StructType([
    T.StructField("device_id", T.StringType(), True),
    T.StructField("window_start", T.StringType(), True),
    T.StructField("window_end", T.StringType(), True),
    T.StructField("avg_temp", T.DoubleType(), True),
])

# Rejected input, one row per bad message (quarantine table).
REJECT = T.StructType([
    T.StructField("topic", T.StringType(), True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("offset", T.LongType(), True),
    T.StructField("reject_reason", T.StringType(), True),
    T.StructField("raw", T.StringType(), True),
])

# Fixed values of the reference's data contract.
SQL_TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"          # wire time of readings
ISO_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"     # ISO-8601, microseconds
STATUS_VALUES = ("OK", "WARN", "FAIL")
DEFAULT_TOPIC_READINGS = "iot_sensor_data"
DEFAULT_TOPIC_AVERAGES = "temperature_averages"
