"""Plan regressions: the scale properties the design relies on, read from executed plans."""

from pyspark.sql import functions as F

from channelwise import queries as Q
from channelwise.operators.ranking import ordered_row_number
from channelwise.plans import reports

from .conftest import AS_OF

SF = "/root/testdata/sf0.001"


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_registered_fact_build_does_not_shuffle_the_fact(spark):
    plan = final_plan(Q.queries()["q_fct_messages"](spark, SF))
    assert "SortMergeJoin" not in plan
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan


def test_date_bounded_report_prunes_fact_partitions(spark, tmp_path):
    ctx = Q.materialized_context(spark, SF, str(tmp_path / "wh"))
    plan = final_plan(reports.daily_trends(ctx.w.dim_dates, ctx.w.fct, days=7, as_of=AS_OF))
    assert "PartitionFilters: [isnotnull(date_key" in plan and ">= 20240122" in plan
    assert "partial_count" in plan  # fact reduced map-side before the calendar join


def test_ranker_reads_its_input_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 5000).selectExpr("id", "id % 97 AS g").write.parquet(path)
    agg = spark.read.parquet(path).groupBy("g").agg(F.count("*").alias("n"))
    plan = final_plan(ordered_row_number(agg, [F.col("n").desc(), F.col("g")], "rn", num_partitions=4))
    # counts and rows both come of the written ordering; the input isn't planned again
    assert plan.count("FileScan parquet") == 2 and plan.count("ordered_rows") >= 2 and str(path) not in plan
    assert "rangepartitioning" not in plan
    assert "Window" in plan and plan.count("Exchange SinglePartition") == 1  # only the per-partition counts


def test_quality_suite_scans_the_fact_once(spark):
    reads = []
    w = Q.lazy_context(spark, SF).w
    from channelwise.operators import quality
    plain = quality.profile
    try:
        quality.profile = lambda df, keys, checks: reads.append(keys) or plain(df, keys, checks)
        from channelwise.plans.catalog import run_quality_suite
        plan = final_plan(run_quality_suite(w.stg, w.dim_channels, w.dim_dates, w.fct, AS_OF))
    finally:
        quality.profile = plain
    assert ["channel_key", "date_key"] in reads
    assert plan.count("events.parquet") == 1  # staging's own checks; the fact's come of the written profile


def test_image_join_and_posting_hours_plans(spark):
    c = Q.lazy_context(spark, SF)
    assert final_plan(Q.REPORTS["q_posting_hours"](c)).count("events.parquet") == 1
    assert final_plan(Q.REPORTS["q_visual_channels"](c)).count("events.parquet") <= 3
