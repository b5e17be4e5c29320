"""Staging, calendar, channel dimension and fact (M1-M4) on hand-made rows."""

import datetime as dt

from pyspark.sql import functions as F

from channelwise.functions.rules import channel_type, minimal_keywords
from channelwise.plans.dims import channel_dimension, date_dimension, date_dimension_for
from channelwise.plans.facts import message_fact
from channelwise.plans.staging import stage_messages
from channelwise.plans.warehouse import Warehouse

from .conftest import AS_OF, msg


def test_staging_flags_and_future_drop(raw_df):
    rows = [
        msg(1, text="  hello  "),
        msg(2, text="   "),                                 # blank -> needs_review
        msg(3, text=None),                                  # null -> needs_review
        msg(4, views=-1),                                   # negative -> needs_review
        msg(5, views=None, forwards=None),                  # defaults to 0, valid
        msg(6, date=dt.datetime(2024, 1, 29, 13, 0)),       # after as_of -> dropped
        msg(7, date=dt.datetime(2024, 1, 29, 10, 0)),       # same day, earlier (D1) -> kept
        msg(8, date=None),                                  # undated -> dropped
        msg(9, text="\n a "),                               # trim strips spaces only (D29)
    ]
    stg = {r.message_id: r for r in stage_messages(raw_df(rows), AS_OF).collect()}
    assert set(stg) == {1, 2, 3, 4, 5, 7, 9}
    assert stg[1].cleaned_message_text == "hello" and stg[1].message_length == 5
    assert stg[1].data_quality_status == "valid"
    assert stg[2].is_empty_message and stg[2].data_quality_status == "needs_review"
    assert stg[3].is_empty_message and stg[3].message_length is None
    assert stg[4].has_negative_views and stg[4].data_quality_status == "needs_review"
    assert stg[5].views == 0 and stg[5].forwards == 0 and stg[5].data_quality_status == "valid"
    assert stg[7].data_quality_status == "valid"
    assert stg[9].message_length == 3
    assert all(not r.is_future_date for r in stg.values())


def test_channel_type_rule_order():
    assert minimal_keywords(["pharma", "med", "pharmacy"]) == ["pharma", "med"]


def test_channel_type_classification(spark):
    names = ["novapharma", "chemed", "medicalhub", "novacosmetics", "skinbeautyet", "cityhealthclinic",
             "doctorsonline", "dailynews", "MEDICALnews", None]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = {r.name: r.t for r in df.select("name", channel_type(F.col("name")).alias("t")).collect()}
    assert got["novapharma"] == got["chemed"] == got["medicalhub"] == "Pharmaceutical"  # D3: med before medical
    assert got["MEDICALnews"] == "Pharmaceutical"
    assert got["novacosmetics"] == got["skinbeautyet"] == "Cosmetics"
    assert got["cityhealthclinic"] == got["doctorsonline"] == "Medical"
    assert got["dailynews"] == "Other" and got[None] == "Other"


def test_date_dimension_parts(spark):
    d = {r.full_date: r for r in date_dimension(spark, dt.date(2023, 12, 30), dt.date(2024, 1, 8)).collect()}
    assert len(d) == 10
    sun = d[dt.date(2023, 12, 31)]
    assert sun.date_key == 20231231 and sun.day_of_week == 0 and sun.day_name == "Sunday" and sun.is_weekend
    mon = d[dt.date(2024, 1, 1)]
    assert mon.week_of_year == 2 and mon.quarter == 1 and mon.month_name == "January" and not mon.is_weekend
    # %W + 1: Monday-start weeks; 2023-12-30 is in week 53 (+1 = 53)
    for day, r in d.items():
        assert r.week_of_year == int(day.strftime("%W")) + 1


def test_date_dimension_week_matches_python_over_years(spark):
    rows = date_dimension(spark, dt.date(2020, 1, 1), dt.date(2027, 12, 31)).select("full_date", "week_of_year")
    bad = [r for r in rows.collect() if r.week_of_year != int(r.full_date.strftime("%W")) + 1]
    assert not bad and rows.count() == 2922


def test_date_dimension_for_pads_and_empty(raw_df, spark):
    stg = stage_messages(raw_df([msg(1, date=dt.datetime(2024, 1, 10)), msg(2, date=dt.datetime(2024, 1, 12))]), AS_OF)
    dd = date_dimension_for(stg, 30, AS_OF).agg(F.min("full_date"), F.max("full_date"), F.count("*")).first()
    assert dd[0] == dt.date(2023, 12, 11) and dd[1] == dt.date(2024, 2, 11) and dd[2] == 63
    empty = stage_messages(raw_df([msg(1, date=None)]), AS_OF)
    e = date_dimension_for(empty, 30, AS_OF).agg(F.min("full_date"), F.max("full_date")).first()
    assert e[0] == dt.date(2023, 1, 29) and e[1] == dt.date(2025, 1, 28)


def test_channel_dimension_keys_and_ties(raw_df):
    rows = ([msg(i, channel="b_channel") for i in range(3)] + [msg(10 + i, channel="a_channel") for i in range(3)]
            + [msg(20, channel="zz", date=dt.datetime(2023, 12, 1))])
    stg = stage_messages(raw_df(rows), AS_OF)
    ch = {r.channel_name: r for r in channel_dimension(stg, AS_OF).collect()}
    assert ch["a_channel"].channel_key == 1 and ch["b_channel"].channel_key == 2  # D5 tie-break by name
    assert ch["zz"].channel_key == 3 and ch["zz"].activity_status == "inactive"
    assert ch["a_channel"].activity_status == "moderate"  # last post 2024-01-20 < 2024-01-22
    assert ch["a_channel"].total_posts == 3 and ch["a_channel"].avg_views == 100.0


def test_activity_status_boundaries(raw_df):
    rows = [msg(1, channel="c7", date=dt.datetime(2024, 1, 22, 0, 0)),     # exactly as_of date - 7 -> active
            msg(2, channel="c8", date=dt.datetime(2024, 1, 21, 23, 59)),   # moderate
            msg(3, channel="c30", date=dt.datetime(2023, 12, 30, 0, 0)),   # moderate
            msg(4, channel="c31", date=dt.datetime(2023, 12, 29, 23, 0))]  # inactive
    ch = {r.channel_name: r.activity_status for r in channel_dimension(stage_messages(raw_df(rows), AS_OF), AS_OF).collect()}
    assert ch == {"c7": "active", "c8": "moderate", "c30": "moderate", "c31": "inactive"}


def test_renamed_channel_does_not_duplicate_facts(raw_df):
    # same channel_name, two titles (D4): two dimension rows, each fact joins exactly one
    rows = [msg(1, title="Old"), msg(2, title="Old"), msg(3, title="New")]
    w = Warehouse(raw_df(rows), AS_OF)
    assert w.dim_channels.count() == 2
    f = w.fct.collect()
    assert sorted(r.message_id for r in f) == [1, 2, 3]
    keys = {r.message_id: r.channel_key for r in f}
    assert keys[1] == keys[2] != keys[3]


def test_fact_keeps_only_valid_and_calendar_days(raw_df, spark):
    rows = [msg(1), msg(2, text=""), msg(3, views=-5)]
    stg = stage_messages(raw_df(rows), AS_OF)
    ch = channel_dimension(stg, AS_OF)
    small_cal = date_dimension(spark, dt.date(2024, 1, 21), dt.date(2024, 1, 21))
    assert message_fact(stg, ch, small_cal).count() == 0
    cal = date_dimension(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 31))
    f = message_fact(stg, ch, cal).collect()
    assert [r.message_id for r in f] == [1] and f[0].date_key == 20240120


def test_invariants_on_fixture(spark):
    from channelwise.plans.warehouse import fixture_warehouse
    w = fixture_warehouse(spark, "/root/testdata/sf0.001", AS_OF)
    valid = w.stg.filter("data_quality_status = 'valid'").count()
    assert w.fct.count() <= valid
    assert w.dim_channels.agg(F.sum("total_posts")).first()[0] == valid
    keys = [r.channel_key for r in w.dim_channels.orderBy("channel_key").collect()]
    assert keys == list(range(1, len(keys) + 1))
