"""Explicit schemas for every table (no inference)."""

from __future__ import annotations

from pyspark.sql import types as T

# Canonical raw message rows. Timestamps are UTC wall clock (TIMESTAMP_NTZ).
RAW_MESSAGE = T.StructType([
    T.StructField("message_id", T.LongType()),
    T.StructField("channel_name", T.StringType()),
    T.StructField("channel_username", T.StringType()),
    T.StructField("channel_title", T.StringType()),
    T.StructField("message_date", T.TimestampNTZType()),
    T.StructField("message_text", T.StringType()),
    T.StructField("has_media", T.BooleanType()),
    T.StructField("image_path", T.StringType()),
    T.StructField("views", T.LongType()),
    T.StructField("forwards", T.LongType()),
    T.StructField("scraped_at", T.TimestampNTZType()),
])

# Landing JSON as written by the collector: timestamps are ISO-8601 text with an offset,
# so they are read as strings and converted explicitly (see sources.landing).
LANDING_JSON = T.StructType([
    T.StructField("message_id", T.LongType()),
    T.StructField("channel_name", T.StringType()),
    T.StructField("channel_username", T.StringType()),
    T.StructField("channel_title", T.StringType()),
    T.StructField("message_date", T.StringType()),
    T.StructField("message_text", T.StringType()),
    T.StructField("has_media", T.BooleanType()),
    T.StructField("image_path", T.StringType()),
    T.StructField("views", T.LongType()),
    T.StructField("forwards", T.LongType()),
    T.StructField("scraped_at", T.StringType()),
    # extended variant
    T.StructField("replies", T.LongType()),
    T.StructField("hashtags", T.ArrayType(T.StringType())),
    T.StructField("potential_products", T.ArrayType(T.StringType())),
])

MANIFEST = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("run_utc", T.TimestampNTZType()),
    T.StructField("channels", T.MapType(T.StringType(), T.LongType())),
    T.StructField("total_messages", T.LongType()),
    T.StructField("extra", T.MapType(T.StringType(), T.StringType())),
])

# Raw detector output, one row per processed image.
RAW_DETECTION = T.StructType([
    T.StructField("image_path", T.StringType()),
    T.StructField("detected_objects", T.ArrayType(T.StringType())),
    T.StructField("confidence_scores", T.ArrayType(T.DoubleType())),
    T.StructField("detection_time", T.TimestampNTZType()),
])

# One row per box.
BOX_DETECTION = T.StructType([
    T.StructField("image_path", T.StringType()),
    T.StructField("class", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("bbox", T.ArrayType(T.DoubleType())),
    T.StructField("timestamp", T.TimestampNTZType()),
])

REJECT = T.StructType([
    T.StructField("source_file", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("record", T.StringType()),
])
