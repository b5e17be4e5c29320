"""Image-detection enrichment: classification (M40), per-box counts (P23) and the
analysis reports M29-M34. All DataFrame code; only the detector itself runs in Python
(see ``operators.detect``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import params
from ..functions.rules import box_category, image_category
from ..functions.text import channel_from_image_path, message_id_from_image_path, round_each
from .reports import _share_of_total

r2 = lambda c: F.round(c, 2)

DETECTION_COLUMNS = ["image_path", "channel_name", "message_id", "detected_objects", "confidence_scores",
                     "detection_count", "image_category", "has_person", "has_product", "detection_time"]


def classify_images(raw: DataFrame, person=params.PERSON_OBJECTS, product=params.PRODUCT_OBJECTS,
                    medical=params.MEDICAL_OBJECTS) -> DataFrame:
    """Raw detector rows -> detection table: channel and message id parsed from the image
    path, object count, category, person/product flags, scores rounded to 3 places."""
    objs = F.coalesce(F.col("detected_objects"), F.array().cast("array<string>"))
    return raw.select(
        "image_path",
        channel_from_image_path(F.col("image_path")).alias("channel_name"),
        message_id_from_image_path(F.col("image_path")).alias("message_id"),
        objs.alias("detected_objects"),
        round_each(F.coalesce(F.col("confidence_scores"), F.array().cast("array<double>")), 3)
        .alias("confidence_scores"),
        F.size(objs).cast("int").alias("detection_count"),
        image_category(objs, person, product, medical).alias("image_category"),
        F.arrays_overlap(objs, F.array(*[F.lit(x) for x in person])).alias("has_person"),
        F.arrays_overlap(objs, F.array(*[F.lit(x) for x in product])).alias("has_product"),
        "detection_time",
    )


def box_category_counts(boxes: DataFrame) -> DataFrame:
    """Per-box classification counted per category (one class name per box)."""
    return boxes.groupBy(box_category(F.col("class")).alias("category")).agg(F.count(F.lit(1)).alias("box_count"))


def image_category_stats(det: DataFrame) -> DataFrame:
    g = det.groupBy("image_category").agg(F.count(F.lit(1)).alias("count"),
                                          F.avg("detection_count").alias("avg_detections"))
    g = _share_of_total(g, "count", "percentage")  # at most five categories
    return g.orderBy(F.col("count").desc(), "image_category")


def _with_channel_key(det: DataFrame, dim_channels: DataFrame) -> DataFrame:
    """Detections with the key of their channel: the dimension is met by the detections, not by the
    fact, which is then joined on two integers. A name that several dimension rows share matches all."""
    return det.join(dim_channels.select("channel_key", "channel_name"), "channel_name")


def image_engagement(det: DataFrame, fct: DataFrame, dim_channels: DataFrame, categories=None) -> DataFrame:
    """Views and forwards of messages per image category (images matched to their message
    by (message_id, channel) parsed from the path)."""
    d = det if categories is None else det.filter(F.col("image_category").isin(list(categories)))
    j = (_with_channel_key(d.select("message_id", "channel_name", "image_category"), dim_channels)
         .join(fct.select("message_id", "channel_key", "view_count", "forward_count"), ["message_id", "channel_key"]))
    return (j.groupBy("image_category")
            .agg(F.count(F.lit(1)).alias("image_count"), F.avg("view_count").alias("avg_views"),
                 F.avg("forward_count").alias("avg_forwards"), F.sum("view_count").alias("total_views"))
            .orderBy(F.col("avg_views").desc(), "image_category"))


def promotional_vs_display(det: DataFrame, fct: DataFrame, dim_channels: DataFrame) -> DataFrame:
    """One row: average views of promotional vs product-display images and which is higher."""
    e = image_engagement(det, fct, dim_channels, ["promotional", "product_display"])
    row = e.agg(F.max(F.when(F.col("image_category") == "promotional", F.col("avg_views"))).alias("promotional_avg_views"),
                F.max(F.when(F.col("image_category") == "product_display", F.col("avg_views")))
                .alias("product_display_avg_views"))
    return row.withColumn("promotional_gets_more",
                          F.col("promotional_avg_views") > F.col("product_display_avg_views"))


def visual_channels(det: DataFrame, fct: DataFrame, dim_channels: DataFrame, limit: int = 5) -> DataFrame:
    """Channels by images per message. Messages are counted from the fact without a join; only fact
    rows that have a detection are joined. A message with several images counts once for each, as in a
    left join of fact and images."""
    per_msg = (_with_channel_key(det.select("message_id", "channel_name"), dim_channels)
               .groupBy("message_id", "channel_key").agg(F.count(F.lit(1)).alias("_img")))
    messages = fct.groupBy("channel_key").agg(F.count("message_id").alias("_messages"))
    matched = (fct.select("message_id", "channel_key").join(per_msg, ["message_id", "channel_key"])
               .groupBy("channel_key").agg(F.sum("_img").alias("image_count"), F.sum(F.col("_img") - 1).alias("_more")))
    per_ch = messages.join(matched, "channel_key", "left").select(
        "channel_key", "image_count", (F.col("_messages") + F.coalesce("_more", F.lit(0))).alias("message_count"))
    c = dim_channels.select("channel_key", "channel_name", "channel_type").join(per_ch, "channel_key", "left")
    m = F.coalesce(F.col("message_count"), F.lit(0))
    i = F.coalesce(F.col("image_count"), F.lit(0))
    return (c.select("channel_name", "channel_type", i.cast("bigint").alias("image_count"),
                     m.cast("bigint").alias("message_count"),
                     r2(i * 100.0 / F.nullif(m, F.lit(0))).alias("images_percentage"))
            .filter(F.col("message_count") > 0)
            .orderBy(F.col("images_percentage").desc(), "channel_name").limit(limit))


def top_objects(det: DataFrame, limit: int = 10) -> DataFrame:
    """Most detected objects with their share of all detected objects."""
    objs = det.select(F.explode("detected_objects").alias("object_name"))
    g = objs.groupBy("object_name").agg(F.count(F.lit(1)).alias("count"))
    g = _share_of_total(g, "count", "percentage")  # one row for each class that a detector knows
    return g.orderBy(F.col("count").desc(), "object_name").limit(limit)


def recent_detections(det: DataFrame, limit: int = 5) -> DataFrame:
    return (det.select("channel_name", "image_category", "detection_count", "detection_time", "image_path")
            .orderBy(F.col("detection_time").desc(), "image_path").limit(limit))
