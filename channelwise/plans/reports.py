"""Report functions over the star schema.

Conventions:
* every report takes DataFrames (fact, dimensions) and returns a lazy DataFrame;
* aggregating reports reduce the fact per dimension key before descriptive dimension columns
  are joined (partial aggregation runs map-side, so a hot channel or day is pre-combined in
  every task); a join that only selects rows (one channel) comes first, as a filter;
* "now" is the explicit ``as_of`` argument;
* every top-k has a total order (tie-breaks on name/id) so results are deterministic;
* shares of a total are computed with a window over the grouped rows only where the
  number of groups is bounded by a fixed list (categories, flags).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import params
from ..functions.calendar import date_key, days_before, hour_text
from ..functions.rules import any_substring, classify_by_rules, performance_bucket
from ..operators.scalars import combine_scalars
from .staging import valid_messages
from ..operators.validate import check_choice, check_range, check_text

r2 = lambda c: F.round(c, 2)


def _pct(part: Column, whole: Column) -> Column:
    return r2(part * 100.0 / F.nullif(whole, F.lit(0)))


def _bound_key(as_of, days: int) -> Column:
    """date_key of ``DATE(as_of, '-days days')``: a literal-like bound pushed to the fact."""
    return date_key(days_before(as_of, days))


def _share_of_total(df: DataFrame, count_col: str, out: str) -> DataFrame:
    """Percent of the column total; used on grouped rows of a bounded group set."""
    total = F.sum(count_col).over(Window.partitionBy())
    return df.withColumn(out, _pct(F.col(count_col), total))


# ---------------------------------------------------------------- products (M5, M6)

def _product_mentions(fct: DataFrame) -> DataFrame:
    return (fct.filter(F.col("message_text").isNotNull() & (F.col("message_text") != ""))
            .withColumn("_t", F.lower(F.trim("message_text"))))


def top_products(fct: DataFrame, dim_channels: DataFrame, limit: int = 10, complete: bool = False) -> DataFrame:
    """Product-category mentions ranked by count (rule set A).

    ``complete=False`` keeps the report's mention filter (without "pill"/"liquid");
    ``complete=True`` derives the filter from the rules. ``channel_count`` counts distinct
    channel types (as the report does); ``distinct_channels`` counts channels.
    """
    check_range("limit", limit, 1, params.LIMIT_MAX)
    rules = params.PRODUCT_RULES_REPORT
    words = [k for _, kws in rules for k in kws] if complete else params.PRODUCT_FILTER_REPORT
    m = _product_mentions(fct).filter(any_substring(F.col("_t"), words))
    # reduce the fact to one row per (category, channel) first: two distinct counts on the raw
    # rows would make Spark expand every row once per distinct column
    per_ch = (m.groupBy(classify_by_rules("_t", rules, params.PRODUCT_DEFAULT).alias("product_category"),
                        "channel_key")
              .agg(F.count(F.lit(1)).alias("_n"), F.sum("view_count").alias("_v")))
    per_ch = per_ch.join(dim_channels.select("channel_key", "channel_type"), "channel_key")
    g = (per_ch.groupBy("product_category")
         .agg(F.sum("_n").alias("mention_count"),
              F.sum("_v").alias("total_views"),
              F.count_distinct("channel_type").alias("channel_count"),
              F.count(F.lit(1)).alias("distinct_channels"))
         .filter(F.col("mention_count") > 0))
    # at most one row per rule + default: a bounded window
    w = Window.orderBy(F.col("mention_count").desc(), F.col("product_category"))
    return (g.select(
        F.col("product_category").alias("product_name"), "product_category", "mention_count", "channel_count",
        "distinct_channels", "total_views",
        r2(F.col("total_views") * 1.0 / F.nullif(F.col("mention_count"), F.lit(0))).alias("avg_views"),
        F.row_number().over(w).cast("bigint").alias("popularity_rank"))
        .orderBy("popularity_rank").limit(limit))


def product_extract(fct: DataFrame, limit: int = 20) -> DataFrame:
    """Product categories (rule set B) without 'Other', average views per mention, top ``limit``."""
    m = _product_mentions(fct)
    g = (m.groupBy(classify_by_rules("_t", params.PRODUCT_RULES_EXTRACT, params.PRODUCT_DEFAULT)
                   .alias("product_category"))
         .agg(F.count(F.lit(1)).alias("mention_count"), F.sum("view_count").alias("total_views")))
    return (g.filter(F.col("product_category") != params.PRODUCT_DEFAULT)
            .select("product_category", "mention_count", "total_views",
                    r2(F.col("total_views") * 1.0 / F.col("mention_count")).alias("avg_views_per_mention"))
            .orderBy(F.col("mention_count").desc(), F.col("product_category")).limit(limit))


# ---------------------------------------------------------------- channels

def _fact_per_channel(fct: DataFrame) -> DataFrame:
    return fct.groupBy("channel_key").agg(
        F.count("message_id").alias("_n"),
        F.sum("view_count").alias("_views"),
        F.count("view_count").alias("_nviews"),
        F.count_if(F.col("has_image")).alias("_nimg"),
        F.sum(F.when(F.col("has_image"), F.col("view_count"))).alias("_img_views"),
        F.count(F.when(F.col("has_image"), F.col("view_count"))).alias("_img_nviews"),
        F.sum(F.when(~F.col("has_image"), F.col("view_count"))).alias("_txt_views"),
        F.count(F.when(~F.col("has_image"), F.col("view_count"))).alias("_txt_nviews"),
    )


def _avg(s: str, n: str) -> Column:
    return F.col(s) / F.nullif(F.col(n), F.lit(0))


def channel_performance(dim_channels: DataFrame, fct: DataFrame, min_posts: int = 1) -> DataFrame:
    """Channels with a performance category and per-message averages from the fact."""
    check_range("min_posts", min_posts, 1, None)
    agg = _fact_per_channel(fct)
    c = dim_channels.filter(F.col("total_posts") >= min_posts)
    j = c.join(agg, "channel_key", "left")
    return (j.select(
        "channel_name", "channel_type", "total_posts", "avg_views", "image_percentage", "activity_status",
        performance_bucket(F.col("avg_views")).alias("performance_category"),
        F.coalesce(F.col("_n"), F.lit(0)).cast("bigint").alias("warehouse_messages"),
        r2(_avg("_views", "_nviews")).alias("avg_message_views"))
        .orderBy(F.col("avg_message_views").desc_nulls_last(), "channel_name"))


def top_image_channels(dim_channels: DataFrame, fct: DataFrame, limit: int = 10) -> DataFrame:
    """Channels ranked by image posts."""
    agg = (fct.filter(F.col("has_image")).groupBy("channel_key")
           .agg(F.count(F.lit(1)).alias("image_posts"), F.avg("view_count").alias("_avg")))
    j = dim_channels.join(agg, "channel_key")
    return (j.select("channel_name", "channel_type", "total_posts", "image_percentage", "image_posts",
                     r2(F.col("_avg")).alias("avg_image_views"))
            .orderBy(F.col("image_posts").desc(), "channel_name").limit(limit))


def visual_stats_by_type(dim_channels: DataFrame, fct: DataFrame) -> DataFrame:
    """Per channel type: messages, image messages and share, average views with/without images."""
    agg = _fact_per_channel(fct)
    j = agg.join(dim_channels.select("channel_key", "channel_type"), "channel_key")
    g = j.groupBy("channel_type").agg(*[F.sum(c).alias(c) for c in
                                         ["_n", "_nimg", "_img_views", "_img_nviews", "_txt_views", "_txt_nviews"]])
    return g.select(
        "channel_type",
        F.col("_n").cast("bigint").alias("total_messages"),
        F.col("_nimg").cast("bigint").alias("image_messages"),
        r2(F.col("_nimg") * 100.0 / F.col("_n")).alias("image_percentage"),
        _avg("_img_views", "_img_nviews").alias("avg_views_with_images"),
        _avg("_txt_views", "_txt_nviews").alias("avg_views_without_images"),
    )


def channel_activity(dim_channels: DataFrame) -> DataFrame:
    return (dim_channels.select("channel_name", "channel_type", "total_posts", r2(F.col("avg_views")).alias("avg_views"),
                                "activity_status", "image_percentage",
                                F.to_date("last_post_date").alias("last_post"))
            .orderBy(F.col("total_posts").desc(), "channel_name"))


def performance_by_type(dim_channels: DataFrame) -> DataFrame:
    return (dim_channels.groupBy("channel_type")
            .agg(F.count(F.lit(1)).alias("channel_count"), F.sum("total_posts").alias("total_posts"),
                 r2(F.avg("avg_views")).alias("avg_views_per_channel"))
            .orderBy(F.col("total_posts").desc(), "channel_type"))


def most_active_channels(dim_channels: DataFrame, limit: int = 10) -> DataFrame:
    check_range("limit", limit, 1, params.LIMIT_MAX)
    return (dim_channels.select("channel_name", "channel_type", "total_posts", "avg_views", "activity_status")
            .orderBy(F.col("total_posts").desc(), "channel_name").limit(limit))


LIST_COLUMNS = ["channel_key", "channel_name", "channel_username", "channel_title", "channel_type", "first_post_date",
                "last_post_date", "total_posts", "avg_views", "avg_forwards", "media_percentage", "image_percentage",
                "activity_status"]


def list_channels(dim_channels: DataFrame, sort_by: str = "total_posts", order: str = "desc") -> DataFrame:
    """All channels sorted by a whitelisted column."""
    check_choice("sort_by", sort_by, params.CHANNEL_SORT_FIELDS)
    check_choice("order", order, ["asc", "desc"])
    key = F.col(sort_by).desc() if order == "desc" else F.col(sort_by).asc()
    return dim_channels.select(*LIST_COLUMNS).orderBy(key, "channel_key")


# ---------------------------------------------------------------- daily

def _fact_per_day(fct: DataFrame, bound: Column | None = None) -> DataFrame:
    f = fct if bound is None else fct.filter(F.col("date_key") >= bound)
    return f.groupBy("date_key").agg(
        F.count("message_id").alias("_n"),
        F.sum("view_count").alias("_views"),
        F.avg("view_count").alias("_avg"),
        F.count_distinct("channel_key").alias("_channels"),
        F.count_if(F.col("has_image")).alias("_nimg"),
    )


def daily_trends(dim_dates: DataFrame, fct: DataFrame, days: int = 7, as_of=None) -> DataFrame:
    """Every calendar day from ``as_of - days`` on, zero-filled: posts, views, average, active channels."""
    check_range("days", days, 1, params.DAYS_MAX)
    d = dim_dates.filter(F.col("full_date") >= days_before(as_of, days))
    agg = _fact_per_day(fct, _bound_key(as_of, days))
    j = d.join(agg, "date_key", "left")
    return (j.select("full_date", "day_name",
                     F.coalesce("_n", F.lit(0)).cast("bigint").alias("post_count"),
                     F.coalesce("_views", F.lit(0)).cast("bigint").alias("total_views"),
                     r2(F.col("_avg")).alias("avg_views_per_post"),
                     F.coalesce("_channels", F.lit(0)).cast("bigint").alias("channels_active"))
            .orderBy(F.col("full_date").desc()))


def daily_posting(dim_dates: DataFrame, fct: DataFrame) -> DataFrame:
    """Days with posts, all time: posts, views, unrounded average."""
    agg = _fact_per_day(fct)
    j = agg.join(dim_dates.select("date_key", "full_date", "day_name"), "date_key")
    return (j.select("full_date", "day_name", F.col("_n").alias("post_count"), F.col("_views").alias("total_views"),
                     F.col("_avg").alias("avg_views_per_post"))
            .orderBy(F.col("full_date").desc()))


def daily_trend_extract(dim_dates: DataFrame, fct: DataFrame, days: int = 30, as_of=None) -> DataFrame:
    """Days with posts in the last ``days`` days."""
    agg = _fact_per_day(fct, _bound_key(as_of, days))
    d = dim_dates.filter(F.col("full_date") >= days_before(as_of, days)).select("date_key", "full_date", "day_name")
    j = agg.join(d, "date_key")
    return (j.select("full_date", "day_name", F.col("_n").alias("post_count"), F.col("_views").alias("total_views"),
                     F.col("_avg").alias("avg_views"))
            .orderBy(F.col("full_date").desc()))


def daily_image_trends(dim_dates: DataFrame, fct: DataFrame, days: int = 30, as_of=None) -> DataFrame:
    """Every day from ``as_of - days`` on: posts, image posts and image share (zero-filled)."""
    d = dim_dates.filter(F.col("full_date") >= days_before(as_of, days)).select("date_key", "full_date")
    agg = _fact_per_day(fct, _bound_key(as_of, days))
    j = d.join(agg, "date_key", "left")
    n = F.coalesce("_n", F.lit(0)).cast("bigint")
    img = F.coalesce("_nimg", F.lit(0)).cast("bigint")
    return (j.select("full_date", n.alias("total_posts"), img.alias("image_posts"), _pct(img, n).alias("image_percentage"))
            .orderBy(F.col("full_date").desc()))


# ---------------------------------------------------------------- image share

def image_vs_text(fct: DataFrame) -> DataFrame:
    """Messages with and without images: count, share of all, average views and forwards."""
    g = (fct.groupBy("has_image")
         .agg(F.count(F.lit(1)).alias("message_count"), F.avg("view_count").alias("_v"),
              F.avg("forward_count").alias("_f")))
    g = _share_of_total(g, "message_count", "percentage")  # at most 3 groups
    return (g.select(F.when(F.col("has_image"), "With Images").otherwise("Text Only").alias("message_type"),
                     "message_count", "percentage", r2(F.col("_v")).alias("avg_views"),
                     r2(F.col("_f")).alias("avg_forwards"))
            .orderBy(F.col("message_count").desc(), "message_type"))


# ---------------------------------------------------------------- one channel

def _one_channel(dim_channels: DataFrame, channel: str) -> DataFrame:
    check_text("channel", channel, 1)
    return dim_channels.filter(F.col("channel_name") == channel)


def recent_messages(fct: DataFrame, dim_channels: DataFrame, dim_dates: DataFrame, channel: str,
                    limit: int = 10) -> DataFrame:
    c = _one_channel(dim_channels, channel).select("channel_key", "channel_name")
    j = (fct.join(c, "channel_key").join(dim_dates.select("date_key", "full_date"), "date_key"))
    return (j.select("message_id", "channel_name", F.col("full_date").alias("message_date"), "message_text",
                     "message_length", "view_count", "forward_count", "has_image")
            .orderBy(F.col("message_date").desc(), F.col("message_id").desc()).limit(limit))


def channel_daily_trends(fct: DataFrame, dim_channels: DataFrame, dim_dates: DataFrame, channel: str,
                         days: int = 30, as_of=None) -> DataFrame:
    """One channel's posting days since ``as_of - days`` (days without posts are absent)."""
    c = _one_channel(dim_channels, channel).select("channel_key")
    f = fct.filter(F.col("date_key") >= _bound_key(as_of, days)).join(c, "channel_key")
    agg = f.groupBy("date_key").agg(F.count("message_id").alias("post_count"),
                                    F.sum("view_count").alias("total_views"),
                                    r2(F.avg("view_count")).alias("avg_views_per_post"))
    d = dim_dates.filter(F.col("full_date") >= days_before(as_of, days)).select("date_key", "full_date", "day_name")
    return (agg.join(d, "date_key").select("full_date", "day_name", "post_count", "total_views", "avg_views_per_post")
            .orderBy(F.col("full_date").desc()))


def channel_engagement(fct: DataFrame, dim_channels: DataFrame, channel: str) -> DataFrame:
    """Totals and conditional averages for one channel; no row when the channel is unknown."""
    c = _one_channel(dim_channels, channel).select("channel_key", "channel_name")
    f = fct.join(c, "channel_key")
    return f.groupBy("channel_name").agg(
        F.count(F.lit(1)).alias("total_messages"),
        F.sum("view_count").alias("total_views"),
        F.sum("forward_count").alias("total_forwards"),
        F.avg("view_count").alias("avg_message_views"),
        F.avg("forward_count").alias("avg_message_forwards"),
        F.count_if(F.col("has_image")).alias("image_messages"),
        r2(F.avg(F.when(F.col("has_image"), F.col("view_count")))).alias("avg_image_views"),
        r2(F.avg(F.when(~F.col("has_image"), F.col("view_count")))).alias("avg_text_views"),
    )


def posting_hours(stg: DataFrame, dim_channels: DataFrame, dim_dates: DataFrame, channel: str,
                  limit: int = 5) -> DataFrame:
    """Best posting hours of one channel. The fact holds the valid staged messages whose channel and day
    are in the dimensions and no hour, so one scan of those staged messages gives the same counts."""
    ident = ["channel_name", "channel_username", "channel_title"]
    c = _one_channel(dim_channels, channel).select(*[F.col(k).alias(f"_c_{k}") for k in ident])
    s = valid_messages(stg).filter(F.col("channel_name") == channel).select(
        *ident, "message_date", F.to_date("message_date").alias("full_date"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_c_{k}")) for k in ident])
    kept = s.join(c, same, "left_semi").join(dim_dates.select("full_date"), "full_date", "left_semi")
    return (kept.groupBy(hour_text(F.col("message_date")).alias("hour_of_day"))
            .agg(F.count(F.lit(1)).alias("post_count"))
            .orderBy(F.col("post_count").desc(), "hour_of_day").limit(limit))


def top_messages(fct: DataFrame, dim_channels: DataFrame, dim_dates: DataFrame, channel: str,
                 limit: int = 5) -> DataFrame:
    c = _one_channel(dim_channels, channel).select("channel_key")
    j = fct.join(c, "channel_key").join(dim_dates.select("date_key", "full_date"), "date_key")
    return (j.select("message_id", "message_text", "view_count", "forward_count", "has_image",
                     F.col("full_date").alias("message_date"))
            .orderBy(F.col("view_count").desc(), "message_id").limit(limit))


INFO_COLUMNS = ["channel_name", "channel_type", "total_posts", "avg_views", "avg_forwards", "media_percentage",
                "image_percentage", "activity_status", "first_post_date", "last_post_date"]


def channel_info(dim_channels: DataFrame, channel: str) -> DataFrame:
    """Dimension row(s) of one channel; empty when unknown (the not-found case)."""
    return _one_channel(dim_channels, channel).select(*INFO_COLUMNS)


# ---------------------------------------------------------------- warehouse stats

def warehouse_stats(dim_channels: DataFrame, fct: DataFrame) -> DataFrame:
    return combine_scalars({
        "channels": dim_channels.agg(F.count(F.lit(1))),
        "messages": fct.agg(F.count(F.lit(1))),
        "channel_types": dim_channels.agg(F.count_distinct("channel_type")),
    })
