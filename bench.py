"""Benchmark: the warehouse build plus the headline reports, on local[$BENCH_CPUS] at
$BENCH_SF_DIR.

Serving setup (as the reproduced system works: build the warehouse, then answer reports
from it): ``warehouse_build`` times the full build from the parquet test tables (staging,
calendar, channel dimension, fact partitioned by date_key, image detections) written to the
checkpoint folder; each report is then timed over those tables. ``BENCH_MODE=end_to_end``
instead times every registered query from the raw test tables.

Every report is planned and run into a no-op sink, with the jobs that it runs on the way; one warm-up,
then the median of ``BENCH_REPS`` (3) runs. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from channelwise import queries as Q  # noqa: E402
from channelwise.session import local_session, scratch_path  # noqa: E402

HEADLINE = [
    "q_daily_trends", "q_top_products", "q_product_extract", "q_channel_performance", "q_daily_posting",
    "q_image_vs_text", "q_top_image_channels", "q_visual_by_type", "q_perf_by_type", "q_search_messages",
    "q_search_count", "q_recent_messages", "q_channel_engagement", "q_posting_hours", "q_top_messages",
    "q_product_mart", "q_channel_performance_mart", "q_image_categories", "q_image_engagement",
    "q_visual_channels", "q_top_objects", "q_quality_suite", "q_warehouse_stats",
    "q_stage_messages", "q_classify_images", "q_landing_manifest", "q_weekly_stats", "q_landing_array", "q_dedupe",
    "q_two_batch_load", "q_stream_daily_trend",
]
END_TO_END = ["q_stage_messages", "q_dim_channels", "q_fct_messages", "q_daily_trends", "q_top_products",
              "q_product_mart", "q_quality_suite", "q_dedupe", "q_landing_manifest", "q_image_engagement"]


def timed(action) -> float:
    t = time.perf_counter()
    action()
    return time.perf_counter() - t


def noop(df):
    return lambda: df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    mode = os.environ.get("BENCH_MODE", "warehouse")
    event_log = None
    if os.environ.get("BENCH_EVENT_LOG"):
        import tempfile
        event_log = tempfile.mkdtemp(prefix="channelwise-eventlog-")
        print(f"event log: {event_log}", file=sys.stderr)
    spark = local_session(cpus, shuffle_partitions=cpus, app="channelwise-bench", event_log_dir=event_log)
    times = {}
    if mode == "warehouse":
        names = sys.argv[1:] or HEADLINE
        Q.materialized_context(spark, sf_dir, scratch_path(spark, "bench_warmup"))  # warm-up
        builds, ctx = [], None
        for _ in range(reps):
            path = scratch_path(spark, "bench_warehouse")
            t = time.perf_counter()
            ctx = Q.materialized_context(spark, sf_dir, path)
            builds.append(time.perf_counter() - t)
        times["warehouse_build"] = round(statistics.median(builds), 3)
        for name in names:
            def run(name=name):  # planning and the jobs that a report runs on the way count too
                noop(Q.REPORTS[name](ctx))()

            run()
            times[name] = round(statistics.median(timed(run) for _ in range(reps)), 3)
    else:
        names = sys.argv[1:] or END_TO_END
        qs = Q.queries()
        for name in names:
            def run(name=name):
                noop(qs[name](spark, sf_dir))()

            run()
            times[name] = round(statistics.median(timed(run) for _ in range(reps)), 3)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": f"{mode}_total_wall", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "mode": mode}))


if __name__ == "__main__":
    main()
