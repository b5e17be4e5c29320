"""Driver contract: entry runs, every query has a callable, every oracle a query."""

import __spark_entry__ as entry

from channelwise.plans.catalog import data_dictionary, run_quality_suite
from channelwise.plans.warehouse import fixture_warehouse
from channelwise.operators.quality import all_passed

from .conftest import AS_OF


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns[:2] == ["full_date", "day_name"]


def test_oracles_cover_queries():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 46 and len(o) >= 45


def test_quality_suite_passes_on_fixture(spark):
    w = fixture_warehouse(spark, "/root/testdata/sf0.001", AS_OF)
    res = run_quality_suite(w.stg, w.dim_channels, w.dim_dates, w.fct, AS_OF)
    assert all_passed(res), [r for r in res.collect() if r.result]


def test_data_dictionary(spark):
    w = fixture_warehouse(spark, "/root/testdata/sf0.001", AS_OF)
    dd = data_dictionary(spark, w.tables(), {"dim_channels": ["channel_key"], "dim_dates": ["date_key"]})
    rows = {(r.table, r.column): r for r in dd.collect()}
    assert rows[("dim_channels", "channel_key")].pk and rows[("dim_dates", "full_date")].type == "date"
    assert len(rows) == 18 + 11 + 15 + 9


def test_materialize_roundtrip(spark, tmp_path):
    w = fixture_warehouse(spark, "/root/testdata/sf0.001", AS_OF)
    m = w.materialize(str(tmp_path / "wh"))
    assert m.fct.count() == w.fct.count()


def test_materialized_context_matches_lazy(spark, tmp_path):
    from channelwise import queries as Q
    sf = "/root/testdata/sf0.001"
    lazy = Q.lazy_context(spark, sf)
    mat = Q.materialized_context(spark, sf, str(tmp_path / "wh"))
    assert dict(mat.w.fct.dtypes) == dict(lazy.w.fct.dtypes)
    for name in ["q_daily_trends", "q_top_products", "q_channel_performance_mart", "q_visual_channels",
                 "q_quality_suite", "q_search_messages"]:
        a = sorted(map(tuple, Q.REPORTS[name](lazy).collect()), key=repr)
        b = sorted(map(tuple, Q.REPORTS[name](mat).collect()), key=repr)
        assert a == b, name


def test_results_do_not_depend_on_session_time_zone(spark):
    from channelwise import queries as Q
    from channelwise.plans.warehouse import fixture_warehouse as fw

    def run(names):
        ctx = Q.Context(spark, "/root/testdata/sf0.001", fw(spark, "/root/testdata/sf0.001", AS_OF))
        return {n: sorted(map(tuple, Q.REPORTS[n](ctx).collect()), key=repr) for n in names}

    names = ["q_stage_messages", "q_daily_trends", "q_dim_channels", "q_posting_hours", "q_stream_daily_trend"]
    utc = run(names)
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        other = run(names)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    for n in names:
        assert utc[n] == other[n], n
