"""M1: staging of raw messages (cleaning + quality flags). Narrow transformations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import as_of_col

STAGING_COLUMNS = [
    "message_id", "channel_name", "channel_username", "channel_title", "message_date", "scraped_at",
    "message_text", "cleaned_message_text", "message_length", "has_media", "image_path", "has_image",
    "views", "forwards", "is_empty_message", "is_future_date", "has_negative_views", "data_quality_status",
]


def stage_messages(raw: DataFrame, as_of=None) -> DataFrame:
    """Raw messages -> ``stg_messages``.

    Drops undated rows and rows dated after ``as_of`` (compared as timestamps), defaults
    null views/forwards to 0, trims text, and sets the quality flags and status.
    """
    now = as_of_col(as_of)
    cleaned = F.trim(F.col("message_text"))
    views = F.coalesce(F.col("views"), F.lit(0).cast("bigint"))
    forwards = F.coalesce(F.col("forwards"), F.lit(0).cast("bigint"))
    is_empty = F.col("message_text").isNull() | (cleaned == "")
    is_future = F.col("message_date") > now
    negative = views < 0
    staged = (
        raw.filter(F.col("message_date").isNotNull() & ~is_future)
        .select(
            "message_id", "channel_name", "channel_username", "channel_title", "message_date", "scraped_at",
            "message_text",
            cleaned.alias("cleaned_message_text"),
            F.length(cleaned).cast("int").alias("message_length"),
            "has_media", "image_path",
            F.col("image_path").isNotNull().alias("has_image"),
            views.alias("views"),
            forwards.alias("forwards"),
            is_empty.alias("is_empty_message"),
            F.lit(False).alias("is_future_date"),
            negative.alias("has_negative_views"),
        )
    )
    status = F.when(F.col("is_empty_message") | F.col("is_future_date") | F.col("has_negative_views"),
                    "needs_review").otherwise("valid")
    return staged.withColumn("data_quality_status", status)


def valid_messages(stg: DataFrame) -> DataFrame:
    return stg.filter(F.col("data_quality_status") == "valid")
