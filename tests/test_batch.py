"""End-to-end batch job on a small landing zone: rerun inserts nothing, checks pass."""

import json
import os

from channelwise.batch import run_batch

from .conftest import AS_OF


def _landing(root):
    for date, ch, ids in [("2024-01-10", "chemed", [1, 2, 3]), ("2024-01-11", "chemed", [3, 4]),
                          ("2024-01-11", "skinbeautyet", [1])]:
        os.makedirs(os.path.join(root, date), exist_ok=True)
        rows = [{"message_id": i, "channel_name": ch, "channel_username": f"@{ch}", "channel_title": ch,
                 "message_date": f"{date}T0{i}:00:00+00:00", "message_text": f"syrup {i}00 ml", "views": 10 * i,
                 "forwards": i, "has_media": i % 2 == 0, "scraped_at": f"{date}T20:00:00Z"} for i in ids]
        with open(os.path.join(root, date, f"{ch}.json"), "w") as f:
            json.dump(rows + [17], f)  # a non-object element is rejected, the rest is kept


def test_batch_job_is_idempotent(spark, tmp_path):
    root = str(tmp_path / "landing")
    _landing(root)
    out = str(tmp_path / "out")
    first = run_batch(spark, root, out, AS_OF)
    assert (first["read"], first["inserted"], first["duplicate"], first["all_passed"]) == (6, 5, 1, True)
    assert first["landing_rejects"] == 3  # one non-object element per file
    second = run_batch(spark, root, out, AS_OF)
    assert second["inserted"] == 0
    assert spark.read.parquet(out + "/raw_messages").count() == 5
    assert spark.read.parquet(out + "/warehouse/fct_messages").count() == 5
    assert spark.read.parquet(out + "/rejects").count() == 3  # a rerun replaces the rejects of its dates
    assert (second["duplicate"], second["already_loaded"]) == (1, 5)
    assert spark.read.option("header", True).csv(out + "/api_extracts/channel_activity").count() == 2


def test_batch_fixed_calendar(spark, tmp_path):
    root = str(tmp_path / "landing")
    _landing(root)
    out = str(tmp_path / "out")
    run_batch(spark, root, out, AS_OF, calendar="fixed")
    assert spark.read.parquet(out + "/warehouse/dim_dates").count() == 1096
