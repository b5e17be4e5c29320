"""Image classification, detection job (binaryFile + mapInPandas), streaming jobs."""

import json
import os
import tempfile
import time

from pyspark.sql import functions as F

from channelwise.operators.detect import detect_images, detect_new_images, image_files, stub_detector
from channelwise.plans import enrich
from channelwise.plans.staging import stage_messages
from channelwise.sources import fixtures
from channelwise.streaming import jobs

from .conftest import AS_OF


def test_classify_images_rules(spark):
    rows = [("x/images/chemed/5.jpg", [], []), ("x/images/chemed/6.jpg", ["person", "bottle"], [0.9, 0.5]),
            ("x/images/a/7.png", ["bottle"], [0.44449]), ("x/images/a/8.jpg", ["person"], [0.3]),
            ("x/images/a/9.jpg", ["car"], [0.3]), ("x/other/10.jpg", None, None)]
    df = spark.createDataFrame(rows, "image_path string, detected_objects array<string>, confidence_scores array<double>")
    d = {r.image_path: r for r in enrich.classify_images(df.withColumn("detection_time", F.lit(None).cast("timestamp_ntz")))
         .collect()}
    assert d["x/images/chemed/5.jpg"].image_category == "no_detection"
    assert d["x/images/chemed/6.jpg"].image_category == "promotional" and d["x/images/chemed/6.jpg"].message_id == 6
    assert d["x/images/a/7.png"].image_category == "product_display" and d["x/images/a/7.png"].confidence_scores == [0.444]
    assert d["x/images/a/8.jpg"].image_category == "lifestyle"
    assert d["x/images/a/9.jpg"].image_category == "other_content"
    assert d["x/other/10.jpg"].channel_name is None and d["x/other/10.jpg"].detection_count == 0


def test_box_categories(spark):
    boxes = spark.createDataFrame([("p", "person"), ("p", "Bottle"), ("p", "dog"), ("p", "person with packet")],
                                  "image_path string, class string")
    got = {r.category: r.box_count for r in enrich.box_category_counts(boxes).collect()}
    assert got == {"lifestyle": 1, "product_display": 1, "other": 1, "promotional": 1}


def test_detection_job_over_image_files(spark):
    root = tempfile.mkdtemp(prefix="cw-img-")
    os.makedirs(os.path.join(root, "images", "chemed"))
    os.makedirs(os.path.join(root, "images", "medicalhub"))
    payloads = {"images/chemed/1.jpg": b"abc" * 10, "images/chemed/2.JPG": b"xyz" * 7,
                "images/medicalhub/3.png": b"\x00bad", "images/medicalhub/notes.txt": b"nope"}
    for rel, data in payloads.items():
        with open(os.path.join(root, rel), "wb") as f:
            f.write(data)
    files = image_files(spark, root)
    assert files.count() == 3
    raw = detect_images(files)
    det = enrich.classify_images(raw).collect()
    assert sorted(r.message_id for r in det) == [1, 2]  # unreadable image dropped
    for r in det:
        expected = [c for c, s in stub_detector(payloads[f"images/{r.channel_name}/{os.path.basename(r.image_path)}"])
                    if s > 0.25]
        assert r.detected_objects == expected


def test_new_images_are_detected_once_and_faults_are_kept(spark, tmp_path):
    root, target, ckpt = tmp_path / "img" / "images" / "chemed", str(tmp_path / "det"), str(tmp_path / "ck")
    root.mkdir(parents=True)

    def run(**files):
        for name, data in files.items():
            (root / f"{name}.jpg").write_bytes(data)
        q = detect_new_images(spark, str(tmp_path / "img"), target, ckpt, images_per_batch=2)
        q.awaitTermination()
        rows = spark.read.parquet(target).collect()
        return sorted((os.path.basename(r.image_path), r.fault) for r in rows), sum(p.numInputRows for p in q.recentProgress)

    first, read = run(a=b"abc", b=b"\x00bad", c=b"xyz")
    assert first == [("a.jpg", None), ("b.jpg", "ValueError: unreadable image"), ("c.jpg", None)] and read == 3
    again, read = run(d=b"new")
    assert again == sorted([*first, ("d.jpg", None)]) and read == 1
    found = enrich.classify_images(spark.read.parquet(target).filter("fault IS NULL").drop("fault"))
    assert found.count() == 3


def test_stream_daily_trend_equals_batch(spark):
    sf = "/root/testdata/sf0.001"
    part = fixtures.read_table(spark, sf, "part")
    raw = fixtures.raw_messages_from(fixtures.events_stream(spark, sf), part)
    out = jobs.run_to_table(jobs.daily_trend_stream(stage_messages(raw, AS_OF)), "t3test")
    got = {r.full_date: (r.post_count, r.total_views, r.channels_active)
           for r in jobs.daily_trend(spark.read.parquet(out)).collect()}
    stg = stage_messages(fixtures.raw_messages(spark, sf), AS_OF).filter("data_quality_status = 'valid'")
    want = {r.d: (r.n, r.v, r.c) for r in stg.groupBy(F.to_date("message_date").alias("d"))
            .agg(F.count("*").alias("n"), F.sum("views").alias("v"), F.count_distinct("channel_name").alias("c")).collect()}
    assert got == want


def test_landing_stream_and_keyed_load_are_incremental(spark):
    root = tempfile.mkdtemp(prefix="cw-slanding-")
    target = tempfile.mkdtemp(prefix="cw-starget-") + "/t"
    ckpt = tempfile.mkdtemp(prefix="cw-sckpt-")

    def put(date, ch, ids, scraped):
        os.makedirs(os.path.join(root, date), exist_ok=True)
        rows = [{"message_id": i, "channel_name": ch, "message_date": f"{date}T10:00:00Z", "views": i,
                 "scraped_at": scraped} for i in ids]
        with open(os.path.join(root, date, f"{ch}.json"), "w") as f:
            json.dump(rows, f)

    put("2024-01-10", "chemed", [1, 2, 3], "2024-01-11T00:00:00Z")
    jobs.keyed_load(jobs.landing_stream(spark, root), target, ckpt).awaitTermination()
    assert spark.read.parquet(target).count() == 3
    time.sleep(1)
    put("2024-01-11", "chemed", [3, 4], "2024-01-12T00:00:00Z")  # 3 is a re-delivery
    jobs.keyed_load(jobs.landing_stream(spark, root), target, ckpt).awaitTermination()
    got = spark.read.parquet(target)
    assert sorted(r.message_id for r in got.collect()) == [1, 2, 3, 4]
    assert got.filter("message_id = 3").first().scrape_date.isoformat() == "2024-01-10"


def test_quality_counter_stream(spark):
    sf = "/root/testdata/sf0.001"
    raw = fixtures.raw_messages_from(fixtures.events_stream(spark, sf), fixtures.read_table(spark, sf, "part"))
    out = jobs.run_to_table(jobs.quality_counter_stream(stage_messages(raw, AS_OF)), "t4test")
    r = spark.read.parquet(out).first()
    batch = stage_messages(fixtures.raw_messages(spark, sf), AS_OF)
    assert r.messages == batch.count()
    assert r.needs_review == batch.filter("data_quality_status = 'needs_review'").count()


def test_dedupe_stream_bounded_state(spark):
    root = tempfile.mkdtemp(prefix="cw-dlanding-")
    for date, ids in [("2024-01-10", [1, 2]), ("2024-01-11", [2, 3])]:
        os.makedirs(os.path.join(root, date))
        with open(os.path.join(root, date, "chemed.json"), "w") as f:
            json.dump([{"message_id": i, "channel_name": "chemed", "message_date": f"{date}T09:00:00Z",
                        "scraped_at": f"{date}T12:00:00Z"} for i in ids], f)
    # append-mode file sink collecting every micro-batch
    target = tempfile.mkdtemp(prefix="cw-dout-") + "/t"
    q = (jobs.dedupe_stream(jobs.landing_stream(spark, root)).writeStream.format("parquet")
         .option("path", target).option("checkpointLocation", tempfile.mkdtemp(prefix="cw-dck-"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted(r.message_id for r in spark.read.parquet(target).collect())
    assert got == [1, 2, 3]


def test_landing_stream_equals_batch_scan(spark):
    from channelwise.sources import landing

    root = tempfile.mkdtemp(prefix="cw-eq-")

    def put(date, name, payload, raw=False):
        os.makedirs(os.path.join(root, date), exist_ok=True)
        with open(os.path.join(root, date, name), "w") as f:
            f.write(payload if raw else json.dumps(payload))

    m = lambda i, ch="chemed": {"message_id": i, "channel_name": ch, "message_date": "2024-01-10T10:00:00+03:00",
                               "message_text": f"t{i}", "scraped_at": "2024-01-11T00:00:00Z"}
    put("2024-01-10", "chemed.json", [m(1), 7, m(2), m(None)])
    put("2024-01-10", "solo.json", m(5, "solo"))
    put("2024-01-10", "bad.json", '[{"message_id": 1', raw=True)
    put("2024-01-10", "_manifest.json", {"x": 1})
    batch_msgs, batch_rej = landing.read_landing(spark, root)
    s_msgs, s_rej = jobs.landing_stream(spark, root, with_rejects=True)
    outs = []
    for df in (s_msgs, s_rej):
        path = tempfile.mkdtemp(prefix="cw-eqo-") + "/t"
        (df.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", tempfile.mkdtemp(prefix="cw-eqc-")).trigger(availableNow=True)
         .start().awaitTermination())
        outs.append(spark.read.parquet(path))
    cols = ["message_id", "channel_name", "message_date", "message_text", "views", "scraped_at", "scrape_date"]
    key = lambda rows: sorted(map(tuple, rows), key=repr)
    assert key(outs[0].select(*cols).collect()) == key(batch_msgs.select(*cols).collect())
    assert key(outs[1].select("reason").collect()) == key(batch_rej.select("reason").collect())
    assert outs[0].count() == 3


def test_detection_job_over_pages_matches_brute_force(spark):
    import pandas as pd

    from channelwise.plans import enrich
    from channelwise.sources.fixtures import FIXTURE_CHANNELS

    sf = "/root/testdata/sf0.001"
    got = {r.image_path: r for r in enrich.classify_images(detect_images(fixtures.image_file_rows(spark, sf))).collect()}
    pages = pd.read_parquet(f"{sf}/pages.parquet")
    assert len(got) == len(pages)
    for pid, html in zip(pages.page_id, pages.html):
        path = f"data/raw/images/{FIXTURE_CHANNELS[pid % 8]}_{pid}/{pid}.jpg"
        want = [c for c, s in stub_detector(html.encode("utf-8")) if s > 0.25]
        assert got[path].detected_objects == want and got[path].message_id == pid


def test_update_mode_keeps_rows_of_earlier_batches(spark, tmp_path):
    src = tmp_path / "in"
    for n, (k, v) in enumerate([("a", 1), ("b", 2), ("a", 3)]):
        spark.createDataFrame([(k, v)], "k string, v long").coalesce(1).write.mode("append").parquet(str(src))
    stream = spark.readStream.schema("k string, v long").option("maxFilesPerTrigger", 1).parquet(str(src))
    out = jobs.run_to_table(stream.groupBy("k").agg(F.sum("v").alias("v")), "upd", "update", keys=["k"])
    assert {r.k: r.v for r in spark.read.parquet(out).collect()} == {"a": 4, "b": 2}
    (tmp_path / "none").mkdir()
    empty = spark.readStream.schema("k string, v long").parquet(str(tmp_path / "none"))
    out = jobs.run_to_table(empty.groupBy("k").agg(F.sum("v").alias("v")), "none")
    assert spark.read.parquet(out).count() == 0
