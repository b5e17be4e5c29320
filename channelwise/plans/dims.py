"""M2 calendar dimension and M3 channel dimension."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import params
from ..functions import calendar as cal
from ..functions.rules import Rules, channel_type, recency_bucket
from ..operators.ranking import ordered_row_number
from .staging import valid_messages

DATE_COLUMNS = ["date_key", "full_date", "year", "quarter", "month", "month_name", "week_of_year",
                "day_of_month", "day_of_week", "day_name", "is_weekend"]

CHANNEL_COLUMNS = ["channel_key", "channel_name", "channel_username", "channel_title", "channel_type",
                   "first_post_date", "last_post_date", "total_posts", "avg_views", "avg_forwards",
                   "posts_with_media", "posts_with_image", "media_percentage", "image_percentage",
                   "activity_status"]

CHANNEL_ID = ["channel_name", "channel_username", "channel_title"]


def _calendar_rows(days: DataFrame) -> DataFrame:
    d = F.col("full_date")
    dow = cal.day_of_week_sunday0(d)
    return days.select(
        cal.date_key(d).alias("date_key"),
        d,
        F.year(d).cast("int").alias("year"),
        F.quarter(d).cast("int").alias("quarter"),
        F.month(d).cast("int").alias("month"),
        cal.month_name(d).alias("month_name"),
        cal.week_of_year_monday(d).alias("week_of_year"),
        F.dayofmonth(d).cast("int").alias("day_of_month"),
        dow.alias("day_of_week"),
        cal.day_name(d).alias("day_name"),
        dow.isin(0, 6).alias("is_weekend"),
    )


def date_dimension(spark: SparkSession, start: _dt.date = params.CALENDAR_START,
                   end: _dt.date = params.CALENDAR_END) -> DataFrame:
    """One row per day in [start, end] (declared range)."""
    n = (end - start).days + 1
    days = spark.range(0, max(n, 0)).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("full_date"))
    return _calendar_rows(days)


def date_dimension_for(stg: DataFrame, pad_days: int = params.CALENDAR_PAD_DAYS, as_of=None) -> DataFrame:
    """Calendar spanning the staged message dates +/- ``pad_days``; as_of +/- 365 days when
    there are no dated messages. Stays lazy: a one-row min/max feeds ``sequence``."""
    bounds = stg.agg(F.min(F.to_date("message_date")).alias("lo"), F.max(F.to_date("message_date")).alias("hi"))
    today = F.to_date(cal.as_of_col(as_of))
    lo = F.when(F.col("lo").isNotNull(), F.date_sub("lo", pad_days)).otherwise(F.date_sub(today, 365))
    hi = F.when(F.col("hi").isNotNull(), F.date_add("hi", pad_days)).otherwise(F.date_add(today, 365))
    days = bounds.select(F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    return _calendar_rows(days)


def channel_dimension(stg: DataFrame, as_of=None, rules: Rules = params.CHANNEL_TYPE_RULES,
                      default_type: str = params.CHANNEL_TYPE_DEFAULT) -> DataFrame:
    """One row per (name, username, title) over valid staged messages, with type,
    activity status and a surrogate key numbered by total_posts desc (ties by the three
    identifying columns).

    The grouping is a hash aggregate with map-side partial aggregation, so a channel
    holding a large share of the messages is pre-combined in every task before the shuffle.
    """
    stats = (valid_messages(stg).groupBy(*CHANNEL_ID).agg(
        F.min("message_date").alias("first_post_date"),
        F.max("message_date").alias("last_post_date"),
        F.count(F.lit(1)).alias("total_posts"),
        F.avg("views").alias("_avg_views"),
        F.avg("forwards").alias("_avg_forwards"),
        F.count_if(F.col("has_media")).alias("posts_with_media"),
        F.count_if(F.col("has_image")).alias("posts_with_image"),
    ))
    pct = lambda c: F.round(F.col(c) * 100.0 / F.nullif(F.col("total_posts"), F.lit(0)), 2)
    shaped = stats.select(
        *CHANNEL_ID,
        channel_type("channel_name", rules, default_type).alias("channel_type"),
        "first_post_date", "last_post_date", "total_posts",
        F.round("_avg_views", 2).alias("avg_views"),
        F.round("_avg_forwards", 2).alias("avg_forwards"),
        "posts_with_media", "posts_with_image",
        pct("posts_with_media").alias("media_percentage"),
        pct("posts_with_image").alias("image_percentage"),
        recency_bucket(F.col("last_post_date"), as_of).alias("activity_status"),
    )
    order = [F.col("total_posts").desc()] + [F.col(c).asc_nulls_first() for c in CHANNEL_ID]
    keyed = ordered_row_number(shaped, order, out="channel_key")
    return keyed.select(*CHANNEL_COLUMNS)
