"""Scalar helpers (F-list) and sinks."""

import datetime as dt

from pyspark.sql import functions as F

from channelwise import functions as cf
from channelwise.plans.warehouse import fixture_warehouse
from channelwise.sources import sinks
from channelwise.operators.detect import argmax_class

from .conftest import AS_OF


def test_scalar_helpers(spark):
    df = spark.createDataFrame(
        [("@@chan@", "data/raw/images/chemed/123.jpg", "paracetamol 500 mg tab", ["a", "b"], [0.12345, 0.5])],
        "h string, p string, t string, arr array<string>, s array<double>")
    r = df.select(cf.strip_handle("h").alias("h"), cf.channel_from_image_path("p").alias("c"),
                  cf.message_id_from_image_path("p").alias("m"), cf.strength("t").alias("st"),
                  cf.strength(F.lit("no strength")).alias("none"), cf.csv_join("arr").alias("j"),
                  cf.csv_split(F.lit("")).alias("empty"), cf.round_each("s", 3).alias("r"),
                  cf.hour_text(F.lit(dt.datetime(2024, 1, 1, 7, 5)).cast("timestamp_ntz")).alias("hh")).first()
    assert (r.h, r.c, r.m, r.st, r.none, r.j, r.empty, r.r, r.hh) == (
        "chan", "chemed", 123, "500 mg", None, "a,b", [], [0.123, 0.5], "07")


def test_map_helpers(spark):
    df = spark.createDataFrame([({"a": 1, "b": 2}, {"b": 5, "c": 7})], "m1 map<string,bigint>, m2 map<string,bigint>")
    r = df.select(cf.merge_maps("m1", "m2").alias("m"), cf.map_total("m1").alias("t")).first()
    assert r.m == {"a": 1, "b": 5, "c": 7} and r.t == 3


def test_argmax_class(spark):
    df = spark.createDataFrame([([0.1, 0.7, 0.2], ["a", "b", "c"]), ([0.1, 0.2], ["a", "b"])],
                               "s array<double>, c array<string>")
    assert [r.x for r in df.select(argmax_class(F.col("s"), F.col("c")).alias("x")).collect()] == ["b", None]


def test_api_extracts_and_table_load(spark, tmp_path):
    w = fixture_warehouse(spark, "/root/testdata/sf0.001", AS_OF)
    out = sinks.write_api_extracts(w, str(tmp_path / "api"), as_of=AS_OF)
    assert set(out) == {"top_products", "channel_activity", "visual_stats", "daily_trends"}
    assert spark.read.option("header", True).csv(out["channel_activity"]).count() == 15  # a channel for each user at sf0.001
    target = str(tmp_path / "raw")
    sinks.load_parquet_table(w.raw, target)
    n = spark.read.parquet(target).count()
    sinks.load_parquet_table(w.raw, target)
    assert spark.read.parquet(target).count() == n == w.raw.count()


def test_declared_sources_and_listing(spark, tmp_path):
    p = str(tmp_path / "t")
    spark.range(3).write.parquet(p)
    sinks.declare_sources(spark, {"my_src": p})
    names = {r.name for r in sinks.list_tables(spark).collect()}
    assert "my_src" in names


def test_extended_raw(spark):
    w = fixture_warehouse(spark, "/root/testdata/sf0.001", AS_OF)
    raw = (w.raw.withColumn("replies", F.lit(None).cast("bigint"))
           .withColumn("hashtags", F.array(F.lit("x"), F.lit("y")))
           .withColumn("potential_products", F.lit(None).cast("array<string>")))
    r = sinks.extended_raw(raw).filter("message_text IS NOT NULL").first()
    assert r.hashtags_text == "x,y" and r.potential_products == [] and r.replies == 0
    assert r.message_length == len(r.message_text)


def test_violation_sample_results_csv_and_detection_append(spark, tmp_path):
    from channelwise.operators import quality as Q
    from channelwise.plans.catalog import save_quality_results

    df = spark.createDataFrame([(1, -1), (2, -5), (3, 4)], "id long, v long")
    check = Q.not_negative("nn_v", "v")
    assert Q.violations(df, check, ["id"]).count() == 2
    assert Q.violations(df, check, ["id"], limit=1).count() == 1  # sample, as a dev run does
    out = str(tmp_path / "dq")
    save_quality_results(Q.with_status(Q.row_checks(df, [check])), out, as_of=AS_OF)
    row = spark.read.option("header", True).csv(out).first()
    assert (row.test_name, row.status, row.result) == ("nn_v", "FAIL", "2") and row.checked_at.startswith("2024-01-29")
    det = spark.createDataFrame([("images/a/1.jpg", ["cup"])], "image_path string, detected_objects array<string>")
    target = str(tmp_path / "det")
    sinks.load_detections(det, target)
    sinks.load_detections(det, target)
    back = spark.read.parquet(target)
    assert back.count() == 2 and back.first().detected_objects == ["cup"] and "created_at" in back.columns
