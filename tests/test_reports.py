"""Report, search and mart behaviour on hand-made rows."""

import datetime as dt

import pytest

from channelwise.plans import marts, reports, search
from channelwise.plans.warehouse import Warehouse

from .conftest import AS_OF, msg


@pytest.fixture
def wh(raw_df):
    rows = [
        msg(1, channel="novapharma", text="Amoxicillin 500mg capsule", views=200, image=True),
        msg(2, channel="novapharma", text="100% pure_vitamin C", views=50, date=dt.datetime(2024, 1, 25, 8)),
        msg(3, channel="novacosmetics", text="face cream 50 ml", views=10, date=dt.datetime(2024, 1, 26, 21)),
        msg(4, channel="novacosmetics", text="nothing to see", views=5, date=dt.datetime(2024, 1, 26, 22)),
        msg(5, channel="novapharma", text="pill organiser", views=7, date=dt.datetime(2024, 1, 27, 9)),
    ]
    return Warehouse(raw_df(rows), AS_OF)


def test_daily_trends_zero_filled(wh):
    t = {r.full_date: r for r in reports.daily_trends(wh.dim_dates, wh.fct, days=7, as_of=AS_OF).collect()}
    assert min(t) == dt.date(2024, 1, 22)
    assert t[dt.date(2024, 1, 23)].post_count == 0 and t[dt.date(2024, 1, 23)].total_views == 0  # D25
    assert t[dt.date(2024, 1, 23)].avg_views_per_post is None
    assert t[dt.date(2024, 1, 26)].post_count == 2 and t[dt.date(2024, 1, 26)].channels_active == 1


def test_top_products_strict_filter_skips_pill_only(wh):
    rows = {r.product_category: r for r in reports.top_products(wh.fct, wh.dim_channels).collect()}
    assert "Tablets" not in rows  # "pill organiser" has no filtered keyword (D14)
    assert rows["Capsules"].mention_count == 1 and rows["Topical"].mention_count == 1
    complete = {r.product_category for r in reports.top_products(wh.fct, wh.dim_channels, complete=True).collect()}
    assert "Tablets" in complete


def test_search_is_literal_unless_wildcards(wh):
    lit = search.search_count(wh.fct, wh.dim_channels, wh.dim_dates, "100%").first().total_count
    assert lit == 1
    pct = search.search_count(wh.fct, wh.dim_channels, wh.dim_dates, "0%p").first().total_count
    assert pct == 0  # "%" is a plain character (D12)
    wild = search.search_count(wh.fct, wh.dim_channels, wh.dim_dates, "0%p", wildcards=True).first().total_count
    assert wild == 2  # "100% pure..." and "...500mg capsule"
    assert search.search_count(wh.fct, wh.dim_channels, wh.dim_dates, "CREAM").first().total_count == 1  # D13


def test_search_paging_and_keyset(wh):
    full = [r.message_id for r in search.search_messages(wh.fct, wh.dim_channels, wh.dim_dates, "in", limit=100).collect()]
    p1 = search.search_messages(wh.fct, wh.dim_channels, wh.dim_dates, "in", limit=2, page=1).collect()
    p2 = search.search_messages(wh.fct, wh.dim_channels, wh.dim_dates, "in", limit=2, page=2).collect()
    assert len(full) == 3 and [r.message_id for r in p1 + p2] == full
    last = p1[-1]
    k2 = search.search_messages_after(wh.fct, wh.dim_channels, wh.dim_dates, "in",
                                      after=(last.message_date, last.channel_name, last.message_id), limit=2).collect()
    assert [r.message_id for r in k2] == [r.message_id for r in p2]


def test_argument_validation(wh):
    with pytest.raises(ValueError):
        search.search_messages(wh.fct, wh.dim_channels, wh.dim_dates, "a")
    with pytest.raises(ValueError):
        reports.list_channels(wh.dim_channels, sort_by="views; DROP TABLE x")
    with pytest.raises(ValueError):
        reports.daily_trends(wh.dim_dates, wh.fct, days=366)
    with pytest.raises(ValueError):
        reports.top_products(wh.fct, wh.dim_channels, limit=0)


def test_unknown_channel_is_empty(wh):
    assert reports.channel_info(wh.dim_channels, "nope").count() == 0
    assert reports.channel_engagement(wh.fct, wh.dim_channels, "nope").count() == 0


def test_channel_engagement_and_hours(wh):
    e = reports.channel_engagement(wh.fct, wh.dim_channels, "novapharma").first()
    assert e.total_messages == 3 and e.total_views == 257 and e.image_messages == 1
    assert e.avg_image_views == 200.0 and e.avg_text_views == 28.5
    hours = reports.posting_hours(wh.stg, wh.dim_channels, wh.dim_dates, "novapharma").collect()
    assert {h.hour_of_day: h.post_count for h in hours} == {"10": 1, "08": 1, "09": 1}


def test_posting_hours_ignores_same_id_in_other_channel(raw_df):
    rows = [msg(1, channel="a", date=dt.datetime(2024, 1, 20, 5)), msg(1, channel="b", date=dt.datetime(2024, 1, 20, 6))]
    w = Warehouse(raw_df(rows), AS_OF)
    hours = reports.posting_hours(w.stg, w.dim_channels, w.dim_dates, "a").collect()
    assert [(h.hour_of_day, h.post_count) for h in hours] == [("05", 1)]  # D24


def test_channel_performance_mart_no_fanout(raw_df):
    rows = [msg(i, channel="novapharma", date=dt.datetime(2024, 1, 1) + dt.timedelta(days=i), image=True)
            for i in range(28)] + [msg(100, channel="novapharma", date=dt.datetime(2024, 1, 3), image=True)]
    w = Warehouse(raw_df(rows), AS_OF)
    m = marts.channel_performance_mart(w.fct, w.dim_channels, w.dim_dates, as_of=AS_OF).first()
    # 2024-01-22..28 are within 7 days of 2024-01-29; four Monday weeks of 8, 7, 7, 7 posts
    assert m.posts_last_7_days == 7  # D17: not multiplied by the number of weeks
    assert m.weekly_growth_percentage == pytest.approx((8 - 7) / 7 * 100)
    assert m.improvement_recommendation == "Maintain current strategy" or m.avg_views < 50


def test_product_mart_extracts_and_ranks(wh):
    m = marts.product_mart(marts.with_potential_products(wh.fct)).collect()
    names = {r.product_name: r for r in m}
    assert "capsule" in names or "500mg capsule" not in names
    assert names["cream 50 ml"].strength == "50 ml" and names["cream 50 ml"].product_category == "Topical"
    assert sorted(r.popularity_rank for r in m) == list(range(1, len(m) + 1))
    assert sorted(r.views_rank for r in m) == list(range(1, len(m) + 1))


def test_search_date_range(wh):
    got = search.search_messages(wh.fct, wh.dim_channels, wh.dim_dates, "in", limit=100,
                                 since=dt.date(2024, 1, 21), until=dt.date(2024, 1, 26)).collect()
    assert sorted(r.message_id for r in got) == [2, 4]
