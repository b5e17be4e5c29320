"""Landing scan (S1-S4), lake write (S5), manifest (S6), CSV export (S7), idempotent load."""

import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from channelwise.plans.catalog import dedupe_messages, landing_manifest, manifest_rows
from channelwise.sources import landing


def _m(i, ch="chemed", date="2024-01-10T10:00:00+03:00", **kw):
    d = {"message_id": i, "channel_name": ch, "channel_username": f"@{ch}", "channel_title": (ch or "").title(),
         "message_date": date, "message_text": f"text {i}", "has_media": False, "image_path": None,
         "views": 10 * i if i is not None else 1, "forwards": i, "scraped_at": "2024-01-11T00:00:00+00:00"}
    d.update(kw)
    return d


@pytest.fixture
def landing_dir():
    root = tempfile.mkdtemp(prefix="cw-landing-")

    def put(date, name, payload, raw=False):
        os.makedirs(os.path.join(root, date), exist_ok=True)
        with open(os.path.join(root, date, name), "w") as f:
            f.write(payload if raw else json.dumps(payload, indent=2))

    put("2024-01-10", "chemed.json", [_m(1), _m(2), 42, _m(3, views=None, forwards=None)])   # mixed array
    put("2024-01-10", "medicalhub.json", _m(7, ch="medicalhub"))                            # single object
    put("2024-01-10", "broken.json", '[{"message_id": 9, "channel_name": "x"', raw=True)   # truncated
    put("2024-01-10", "_manifest.json", {"date": "2024-01-10", "channels": {"chemed": 3}})  # skipped
    put("2024-01-11", "chemed.json", [_m(1, scraped_at="2024-01-12T00:00:00Z", views=999), _m(None), _m(4, ch=None)])
    return root


def test_read_landing_isolates_bad_records(spark, landing_dir):
    msgs, rejects = landing.read_landing(spark, landing_dir)
    got = sorted((r.message_id, r.channel_name, str(r.scrape_date)) for r in msgs.collect())
    assert got == [(1, "chemed", "2024-01-10"), (1, "chemed", "2024-01-11"), (2, "chemed", "2024-01-10"),
                   (3, "chemed", "2024-01-10"), (7, "medicalhub", "2024-01-10")]
    reasons = sorted(r.reason for r in rejects.collect())
    assert reasons == ["malformed file", "not an object", "null channel_name", "null message_id"]
    r3 = msgs.filter("message_id = 3").first()
    assert r3.views == 0 and r3.forwards == 0  # defaults for absent values
    # +03:00 offset normalised to UTC wall clock
    assert msgs.filter("message_id = 2").first().message_date == dt.datetime(2024, 1, 10, 7, 0)


def test_dedupe_keeps_earliest_scrape_and_is_idempotent(spark, landing_dir):
    msgs, _ = landing.read_landing(spark, landing_dir)
    raw = landing.raw_columns(msgs)
    first = dedupe_messages(raw)
    one = first.filter("message_id = 1").first()
    assert first.count() == 4 and one.views == 10  # the 2024-01-11 copy (views 999) is ignored
    target = tempfile.mkdtemp(prefix="cw-target-") + "/t"
    first.write.parquet(target)
    existing = spark.read.parquet(target)
    assert dedupe_messages(raw, existing).count() == 0


def test_lake_roundtrip_and_manifest(spark, landing_dir):
    msgs, _ = landing.read_landing(spark, landing_dir)
    lake = tempfile.mkdtemp(prefix="cw-lake-") + "/lake"
    landing.write_lake(msgs.drop("record", "source_file"), lake)
    back, rej = landing.read_landing(spark, lake, layout="lines")
    assert back.count() == msgs.count() and rej.count() == 0
    man = landing_manifest(msgs, run_utc=dt.datetime(2024, 1, 12))
    rows = {(str(r.date), r.channel_name): (r.message_count, r.total_messages) for r in manifest_rows(man).collect()}
    assert rows[("2024-01-10", "chemed")] == (3, 4) and rows[("2024-01-10", "medicalhub")] == (1, 4)
    out = tempfile.mkdtemp(prefix="cw-man-")
    landing.write_manifest(man, out)
    landing.write_manifest(man, out)  # a rerun replaces its dates
    assert spark.read.json(out + "/manifests").count() == 3  # a row for each date and channel


def test_csv_export_joins_arrays(spark):
    df = spark.createDataFrame([(1, ["a", "b"])], "id long, tags array<string>")
    out = tempfile.mkdtemp(prefix="cw-csv-") + "/x"
    landing.export_csv(df, out)
    back = spark.read.option("header", True).csv(out).first()
    assert back.tags == "a,b"
    audit = landing.extract_audit(spark, out).agg(F.sum("rows")).first()[0]
    assert audit == 1


def test_landing_audit(spark, landing_dir):
    a = landing.landing_audit(spark, landing_dir).first()
    assert a.file_count == 4


@pytest.mark.parametrize("by_channel", [False, True])
def test_lake_keeps_channel_names(spark, tmp_path, by_channel):
    names = ["a b", "x%y", "q=1", "c:d", "ዜና ማሰራጫ", "plain", "a/b"]
    rows = spark.createDataFrame([(i, n, "2024-01-10") for i, n in enumerate(names)],
                                 "message_id long, channel_name string, scrape_date string")
    lake = str(tmp_path / "lake")
    landing.write_lake(rows.withColumn("scrape_date", F.to_date("scrape_date")), lake, by_channel)
    back, rej = landing.read_landing(spark, lake, layout="lines")
    assert {r.message_id: r.channel_name for r in back.collect()} == dict(enumerate(names)) and rej.count() == 0


def test_bad_values_are_rejected_by_name(spark, tmp_path):
    folder = tmp_path / "2024-01-10"
    folder.mkdir()
    good = {"message_id": 1, "channel_name": "c", "message_date": "2024-01-09T10:00:00+03:00"}
    rows = [good, {**good, "message_date": "not a date"}, {**good, "message_date": "2024-13-45T99:00:00Z"},
            {**good, "message_date": ""}, {**good, "views": "12"}, {**good, "scraped_at": "x"}, 7, {"channel_name": "c"}]
    (folder / "c.json").write_text(json.dumps(rows))
    (folder / "cut.json").write_text(json.dumps(rows)[:-20])
    msgs, rej = landing.read_landing(spark, str(tmp_path))
    assert [r.message_date for r in msgs.collect()] == [dt.datetime(2024, 1, 9, 7)]
    assert sorted(r.reason for r in rej.collect()) == sorted(
        ["bad message_date"] * 3 + ["malformed object", "bad scraped_at", "not an object", "null message_id", "malformed file"])


def test_unreadable_target_rises(spark, tmp_path):
    from channelwise.sources import keyed_table as sinks
    assert sinks.read_existing(spark, str(tmp_path / "none")) is None
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "part-0.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception):
        sinks.read_existing(spark, str(bad)).count()


def test_counts_of_an_empty_load(spark):
    from channelwise.operators.dedupe import load_counts
    empty = spark.createDataFrame([], "message_id long, channel_name string")
    assert set(load_counts(empty, ["message_id", "channel_name"], empty).first().asDict().values()) == {0}
