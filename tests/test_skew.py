"""Skewed inputs: one channel with over a third of all messages, one key with thousands of
copies. Results are checked against a brute-force pandas computation of the same rules."""

import datetime as dt

import pandas as pd
import pytest

from channelwise.plans import reports
from channelwise.plans.catalog import dedupe_messages
from channelwise.plans.warehouse import Warehouse

from .conftest import AS_OF, msg


@pytest.fixture(scope="module")
def skewed_rows():
    rows = []
    base = dt.datetime(2024, 1, 1, 0, 0)
    for i in range(6000):  # hot channel: 6000 of 15000 rows
        rows.append(msg(i, channel="hotpharma", date=base + dt.timedelta(minutes=7 * i), views=i % 500,
                        image=(i % 3 == 0)))
    for i in range(9000):
        rows.append(msg(100000 + i, channel=f"ch{i % 30}", date=base + dt.timedelta(minutes=5 * i), views=i % 97))
    for k in range(3000):  # one key delivered 3000 times
        rows.append(msg(7, channel="hotpharma", date=base + dt.timedelta(minutes=49), views=10_000 + k,
                        scraped=dt.datetime(2024, 1, 2) + dt.timedelta(seconds=k + 1)))
    return rows


def test_dedupe_hot_key(raw_df, skewed_rows):
    out = dedupe_messages(raw_df(skewed_rows))
    assert out.count() == 15000
    hot = out.filter("message_id = 7 AND channel_name = 'hotpharma'").first()
    # the original (scraped one day after posting, 2024-01-02 00:49) is not the earliest:
    # the first re-delivery is at 2024-01-02 00:00:01
    assert hot.views == 10_000


def test_reports_with_hot_channel_match_brute_force(raw_df, skewed_rows):
    rows = [r for r in skewed_rows if not (r[0] == 7 and r[8] >= 10_000)]
    w = Warehouse(raw_df(rows), AS_OF)
    pdf = pd.DataFrame(rows, columns=["message_id", "channel_name", "u", "t", "message_date", "text", "media",
                                      "image_path", "views", "forwards", "scraped_at"])
    pdf = pdf[pdf.message_date <= AS_OF]
    ch = {r.channel_name: r for r in w.dim_channels.collect()}
    counts = pdf.groupby("channel_name").size()
    assert ch["hotpharma"].total_posts == counts["hotpharma"]
    assert ch["hotpharma"].channel_key == 1
    assert sorted(r.channel_key for r in ch.values()) == list(range(1, len(ch) + 1))
    perf = {r.channel_name: r for r in reports.channel_performance(w.dim_channels, w.fct).collect()}
    want = pdf.groupby("channel_name").views.mean().round(2)
    for name, r in perf.items():
        assert r.avg_message_views == pytest.approx(want[name], abs=0.006)
    daily = {r.full_date: r.post_count for r in reports.daily_posting(w.dim_dates, w.fct).collect()}
    want_daily = pdf.groupby(pdf.message_date.dt.date).size().to_dict()
    assert daily == want_daily
