"""Analytics marts: M7 product mart and M9 channel-performance mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params
from ..functions.calendar import days_before
from ..functions.rules import classify_by_rules, performance_bucket, recommendation
from ..functions.text import strength
from ..operators.ranking import ordered_row_number


def product_pattern(rules=params.PRODUCT_RULES_MART) -> str:
    """Regex finding product mentions: a product word from the rules, optionally followed
    by a strength (``tablet 500mg``). Longer words first so ``injectable`` beats ``injection``."""
    words = sorted({k for _, kws in rules for k in kws}, key=lambda w: (-len(w), w))
    return "(" + "|".join(words) + r")(\s+\d+\s*(mg|ml|g))?"


def with_potential_products(fct: DataFrame, pattern: str | None = None) -> DataFrame:
    """Add ``potential_products`` (array<string>) extracted from the lower-cased message text
    (the extended raw variant carries this column from the collector instead)."""
    pat = pattern or product_pattern()
    return fct.withColumn("potential_products",
                          F.regexp_extract_all(F.lower(F.col("message_text")), F.lit(pat), 0))


def engagement_score(views: Column | str = "view_count", forwards: Column | str = "forward_count") -> Column:
    """Our engagement definition (not given by the source): views + forwards."""
    v = F.col(views) if isinstance(views, str) else views
    f = F.col(forwards) if isinstance(forwards, str) else forwards
    return v + f


def product_mart(fct_with_products: DataFrame, engagement: Column | None = None) -> DataFrame:
    """Per product name: mentions, channels, views, forwards, engagement, first/last mention
    date key, category (rule set C), strength, and two global ranks.

    Products are exploded from the array column; the aggregation is partial (map-side), and
    both ranks use the distributed ranker, since the number of products is data-dependent.
    """
    eng = engagement if engagement is not None else engagement_score()
    m = (fct_with_products
         .filter(F.col("potential_products").isNotNull() & (F.size("potential_products") > 0))
         .select(F.explode("potential_products").alias("product_name"), "channel_key", "date_key",
                 F.col("view_count").alias("views"), F.col("forward_count").alias("forwards"),
                 eng.alias("engagement_score")))
    stats = (m.filter(F.col("product_name").isNotNull() & (F.trim("product_name") != ""))
             .groupBy(F.lower(F.trim("product_name")).alias("product_name"))
             .agg(F.count(F.lit(1)).alias("mention_count"),
                  F.count_distinct("channel_key").alias("channel_count"),
                  F.sum("views").alias("total_views"),
                  F.avg("views").alias("avg_views"),
                  F.sum("forwards").alias("total_forwards"),
                  F.avg("engagement_score").alias("avg_engagement"),
                  F.min("date_key").alias("first_mentioned_date"),
                  F.max("date_key").alias("last_mentioned_date")))
    cat = stats.select("*",
                       classify_by_rules("product_name", params.PRODUCT_RULES_MART,
                                         params.PRODUCT_DEFAULT).alias("product_category"),
                       strength(F.col("product_name")).alias("strength"))
    ranked = ordered_row_number(cat, [F.col("mention_count").desc(), F.col("product_name")], "popularity_rank")
    ranked = ordered_row_number(ranked, [F.col("total_views").desc(), F.col("product_name")], "views_rank")
    return (ranked.filter(F.col("mention_count") >= 1)
            .orderBy(F.col("mention_count").desc(), F.col("total_views").desc(), "product_name"))


def daily_stats(fct: DataFrame, dim_dates: DataFrame, engagement: Column | None = None) -> DataFrame:
    """Per channel and day: posts, views, forwards, average engagement and image posts."""
    eng = engagement if engagement is not None else engagement_score()
    f = fct.join(dim_dates.select("date_key", "full_date"), "date_key")
    return (f.groupBy("channel_key", "full_date")
            .agg(F.count(F.lit(1)).alias("daily_posts"),
                 F.sum("view_count").alias("daily_views"),
                 F.sum("forward_count").alias("daily_forwards"),
                 F.avg(eng).alias("avg_daily_engagement"),
                 F.count_if(F.col("has_image")).alias("daily_images")))


def weekly_stats(daily: DataFrame) -> DataFrame:
    """Per channel and week (from Monday), out of ``daily_stats``; the week's engagement is the mean of
    its days' averages."""
    return (daily.groupBy("channel_key", F.date_trunc("week", "full_date").cast("date").alias("week_start"))
            .agg(F.sum("daily_posts").alias("weekly_posts"),
                 F.sum("daily_views").alias("weekly_views"),
                 F.sum("daily_forwards").alias("weekly_forwards"),
                 F.avg("avg_daily_engagement").alias("avg_weekly_engagement"),
                 F.sum("daily_images").alias("weekly_images")))


def channel_performance_mart(fct: DataFrame, dim_channels: DataFrame, dim_dates: DataFrame, as_of=None) -> DataFrame:
    """Per channel: posts in the last 7 days, weekly growth, content effectiveness,
    performance category and a recommendation.

    Daily and weekly statistics are each reduced to one row per channel before they meet
    the dimension, so the summary join is 1:1 (no daily x weekly fan-out).
    """
    daily = daily_stats(fct, dim_dates)
    weekly = weekly_stats(daily)
    recent = (daily.groupBy("channel_key")
              .agg(F.sum(F.when(F.col("full_date") >= days_before(as_of, 7), F.col("daily_posts")))
                   .alias("_recent")))
    growth = (weekly.groupBy("channel_key")
              .agg(F.count_distinct("week_start").alias("_weeks"),
                   F.max("weekly_posts").alias("_wmax"), F.min("weekly_posts").alias("_wmin")))
    c = dim_channels.select("channel_key", "channel_name", "channel_type", "total_posts", "avg_views",
                            "avg_forwards", "media_percentage", "image_percentage", "activity_status")
    j = c.join(recent, "channel_key", "left").join(growth, "channel_key", "left")
    growth_pct = F.when(F.col("_weeks") >= 2,
                        (F.col("_wmax") - F.col("_wmin")).cast("double") / F.nullif(F.col("_wmin"), F.lit(0)) * 100
                        ).otherwise(F.lit(0.0))
    score = F.when(F.col("total_posts") > 0,
                   (F.col("avg_views") * F.col("total_posts")) / F.nullif(F.col("total_posts"), F.lit(0))
                   ).otherwise(F.lit(0.0))
    s = j.select(*c.columns,
                 F.coalesce(F.col("_recent"), F.lit(0)).cast("bigint").alias("posts_last_7_days"),
                 growth_pct.alias("weekly_growth_percentage"),
                 score.alias("content_effectiveness_score"))
    return (s.withColumn("performance_category", performance_bucket(F.col("content_effectiveness_score")))
            .withColumn("improvement_recommendation",
                        recommendation(F.col("image_percentage"), F.col("posts_last_7_days"), F.col("avg_views")))
            .orderBy(F.col("content_effectiveness_score").desc(), "channel_key"))
