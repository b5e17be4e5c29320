"""Registered queries.

Each report is a function of a :class:`Context` (the star schema, the classified image
detections, and the raw test tables). ``queries()`` exposes every report as a callable
``(spark, sf_dir) -> DataFrame`` over the driver's test tables (mapped to raw messages and
detections by ``sources.fixtures``): staging, the fact, the detections and the report are
computed from the test tables on every run; the two small dimensions are computed from them
once per (session, folder) and written to the shared checkpoint folder (see
``Warehouse.stage_dimensions``). ``materialized_context`` builds the whole warehouse into
tables (the serving setup) for the benchmark.

Timestamps leave as TIMESTAMP_NTZ (UTC wall clock), dates as DATE.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import params
from .plans import catalog, enrich, marts, reports, search
from .plans.staging import stage_messages
from .plans.warehouse import Warehouse, fixture_warehouse, run_concurrently
from .sources import fixtures

AS_OF = params.DEFAULT_AS_OF
CHANNEL = "tabletmart_0"

Query = Callable[[SparkSession, str], DataFrame]


@dataclass
class Context:
    spark: SparkSession
    sf_dir: str
    w: Warehouse
    _det: DataFrame | None = field(default=None, repr=False)

    @property
    def det(self) -> DataFrame:
        if self._det is None:
            self._det = enrich.classify_images(fixtures.raw_detections(self.spark, self.sf_dir))
        return self._det


REPORTS: dict[str, Callable[[Context], DataFrame]] = {}


def report(fn):
    REPORTS[fn.__name__] = fn
    return fn


# ---------------------------------------------------------------- star schema

@report
def q_stage_messages(c: Context):
    return c.w.stg


@report
def q_dim_dates(c: Context):
    return c.w.dim_dates


@report
def q_dim_channels(c: Context):
    return c.w.dim_channels


@report
def q_fct_messages(c: Context):
    return c.w.fct


# ---------------------------------------------------------------- reports

@report
def q_daily_trends(c: Context):
    return reports.daily_trends(c.w.dim_dates, c.w.fct, days=7, as_of=AS_OF)


@report
def q_top_products(c: Context):
    return reports.top_products(c.w.fct, c.w.dim_channels, limit=10)


@report
def q_product_extract(c: Context):
    return reports.product_extract(c.w.fct)


@report
def q_channel_performance(c: Context):
    return reports.channel_performance(c.w.dim_channels, c.w.fct, min_posts=1)


@report
def q_daily_posting(c: Context):
    return reports.daily_posting(c.w.dim_dates, c.w.fct)


@report
def q_daily_extract(c: Context):
    return reports.daily_trend_extract(c.w.dim_dates, c.w.fct, days=30, as_of=AS_OF)


@report
def q_image_vs_text(c: Context):
    return reports.image_vs_text(c.w.fct)


@report
def q_top_image_channels(c: Context):
    return reports.top_image_channels(c.w.dim_channels, c.w.fct, limit=10)


@report
def q_daily_image_trends(c: Context):
    return reports.daily_image_trends(c.w.dim_dates, c.w.fct, days=30, as_of=AS_OF)


@report
def q_visual_by_type(c: Context):
    return reports.visual_stats_by_type(c.w.dim_channels, c.w.fct)


@report
def q_channel_activity(c: Context):
    return reports.channel_activity(c.w.dim_channels)


@report
def q_perf_by_type(c: Context):
    return reports.performance_by_type(c.w.dim_channels)


@report
def q_active_channels(c: Context):
    return reports.most_active_channels(c.w.dim_channels, limit=10)


@report
def q_list_channels(c: Context):
    return reports.list_channels(c.w.dim_channels, "avg_views", "asc")


@report
def q_search_messages(c: Context):
    return search.search_messages(c.w.fct, c.w.dim_channels, c.w.dim_dates, "tablet", channel="med",
                                  limit=20, page=2)


@report
def q_search_count(c: Context):
    return search.search_count(c.w.fct, c.w.dim_channels, c.w.dim_dates, "tablet", channel="med")


@report
def q_search_channels(c: Context):
    return search.search_channels(c.w.dim_channels, name="e", channel_type="Pharmaceutical", min_posts=10)


@report
def q_recent_messages(c: Context):
    return reports.recent_messages(c.w.fct, c.w.dim_channels, c.w.dim_dates, CHANNEL, limit=10)


@report
def q_channel_daily(c: Context):
    return reports.channel_daily_trends(c.w.fct, c.w.dim_channels, c.w.dim_dates, CHANNEL, days=30, as_of=AS_OF)


@report
def q_channel_engagement(c: Context):
    return reports.channel_engagement(c.w.fct, c.w.dim_channels, CHANNEL)


@report
def q_posting_hours(c: Context):
    return reports.posting_hours(c.w.stg, c.w.dim_channels, c.w.dim_dates, CHANNEL, limit=5)


@report
def q_top_messages(c: Context):
    return reports.top_messages(c.w.fct, c.w.dim_channels, c.w.dim_dates, CHANNEL, limit=5)


@report
def q_channel_info(c: Context):
    return reports.channel_info(c.w.dim_channels, CHANNEL)


@report
def q_warehouse_stats(c: Context):
    return reports.warehouse_stats(c.w.dim_channels, c.w.fct)


# ---------------------------------------------------------------- marts

@report
def q_product_mart(c: Context):
    return marts.product_mart(marts.with_potential_products(c.w.fct))


@report
def q_channel_performance_mart(c: Context):
    return marts.channel_performance_mart(c.w.fct, c.w.dim_channels, c.w.dim_dates, as_of=AS_OF)


# ---------------------------------------------------------------- enrichment

@report
def q_classify_images(c: Context):
    return c.det.select("image_path", "channel_name", "message_id",
                        F.array_join("detected_objects", ",").alias("detected_objects"),
                        "detection_count", "image_category", "has_person", "has_product", "detection_time")


@report
def q_score_argmax(c: Context):
    """X4 over the embeddings taken as score vectors: the class (the component's number) of the highest
    score, where that exceeds the threshold."""
    from .operators.detect import argmax_class
    e = fixtures.read_table(c.spark, c.sf_dir, "embeddings").select("vec_id", "embedding")
    classes = F.transform(F.sequence(F.lit(0), F.size("embedding") - 1), lambda i: i.cast("string"))
    return e.select("vec_id", argmax_class(F.col("embedding"), classes, 0.25).alias("class"))


@report
def q_image_scores(c: Context):
    """F32: the rounded confidence scores of every image: how many, smallest and largest."""
    scores = F.col("confidence_scores")
    return c.det.select("image_path", F.size(scores).alias("scores"), F.array_min(scores).alias("lowest"),
                        F.array_max(scores).alias("highest"))


@report
def q_box_categories(c: Context):
    raw = fixtures.raw_detections(c.spark, c.sf_dir)
    boxes = raw.select("image_path", F.explode("detected_objects").alias("class"))
    return enrich.box_category_counts(boxes)


@report
def q_image_categories(c: Context):
    return enrich.image_category_stats(c.det)


@report
def q_image_engagement(c: Context):
    return enrich.image_engagement(c.det, c.w.fct, c.w.dim_channels)


@report
def q_promo_vs_display(c: Context):
    return enrich.promotional_vs_display(c.det, c.w.fct, c.w.dim_channels)


@report
def q_visual_channels(c: Context):
    return enrich.visual_channels(c.det, c.w.fct, c.w.dim_channels, limit=5)


@report
def q_top_objects(c: Context):
    return enrich.top_objects(c.det, limit=10)


@report
def q_recent_detections(c: Context):
    return enrich.recent_detections(c.det, limit=5)


# ---------------------------------------------------------------- quality and catalog

@report
def q_quality_suite(c: Context):
    return catalog.run_quality_suite(c.w.stg, c.w.dim_channels, c.w.dim_dates, c.w.fct, as_of=AS_OF)


@report
def q_landing_manifest(c: Context):
    raw = fixtures.raw_messages(c.spark, c.sf_dir).withColumn("scrape_date", F.to_date("scraped_at"))
    return catalog.manifest_rows(catalog.landing_manifest(raw, run_utc=AS_OF))


@report
def q_table_counts(c: Context):
    return catalog.table_counts({"raw_messages": c.w.raw, **c.w.tables()})


@report
def q_dedupe(c: Context):
    return catalog.dedupe_messages(fixtures.raw_messages_with_redeliveries(c.spark, c.sf_dir))


@report
def q_quality_damaged(c: Context):
    """The quality suite over tables with faults of every kind, read from a written copy."""
    from .session import scratch_path
    names = ("stg", "channels", "dates", "fct")
    path = scratch_path(c.spark, "damaged")
    for name, df in zip(names, fixtures.damaged(c.w)):
        df.write.parquet(f"{path}/{name}")
    stg, ch, dates, fct = (c.spark.read.parquet(f"{path}/{n}") for n in names)
    return catalog.run_quality_suite(stg, ch, dates, fct, as_of=AS_OF)


@report
def q_quality_csv(c: Context):
    """The quality results of the damaged tables through their CSV file."""
    from .session import scratch_path
    path = scratch_path(c.spark, "quality_csv")
    catalog.save_quality_results(q_quality_damaged(c), path, AS_OF)
    return (c.spark.read.option("header", True).schema("test_name string, status string, result long, checked_at "
                                                       "timestamp_ntz").csv(path).select("test_name", "status", "result"))


@report
def q_failing_rows(c: Context):
    """Q13: the staged messages that need review for negative views."""
    from .operators import quality
    return quality.violations(c.w.stg, quality.not_negative("negative views", "views"),
                              ["message_id", "channel_name", "views"])


@report
def q_landing_array(c: Context):
    """Collector files (JSON arrays, with fixed faults) parsed; messages and rejects counted by
    scrape date and reason."""
    from .session import scratch_path
    from .sources import landing
    root = scratch_path(c.spark, "collector")
    fixtures.write_landing_files(c.spark, c.sf_dir, root)
    parsed = landing.parse_landing(c.spark, root, as_of=AS_OF, pattern="*/*/*.txt")
    good = F.col("reason").isNull()
    return parsed.groupBy("scrape_date", F.coalesce("reason", F.lit("")).alias("reason")).agg(
        F.count(F.lit(1)).alias("records"), F.sum(F.when(good, F.col("message_id"))).alias("ids"),
        F.sum(F.when(good, F.col("views"))).alias("views"), F.max(F.when(good, F.col("message_date"))).alias("last_message"))


@report
def q_two_batch_load(c: Context):
    """The even messages are loaded, then all messages with their re-deliveries; the counts of
    both loads and what the table holds after each."""
    every = fixtures.raw_messages_with_redeliveries(c.spark, c.sf_dir)
    return _loads(c, [fixtures.raw_messages(c.spark, c.sf_dir).filter("message_id % 2 = 0"), every])


def _loads(c: Context, batches: list) -> DataFrame:
    """The figures of successive loads of one table, and what it holds after each: a row for each load."""
    from .session import scratch_path
    from .sources.keyed_table import KeyedTable
    table, rows = KeyedTable(c.spark, scratch_path(c.spark, "loaded")), []
    for n, batch in enumerate(batches, 1):
        figures = table.load(batch).counts.first().asDict()
        held = table.rows()
        after = (0, None) if held is None else tuple(held.agg(F.count(F.lit(1)), F.sum("views")).first())
        rows.append((n, *(figures[k] for k in ("read", "rejected", "duplicate", "already_loaded", "inserted")), *after))
    return c.spark.createDataFrame(rows, "load_no int, read long, rejected long, duplicate long, already_loaded long, "
                                         "inserted long, table_rows long, table_views long")


@report
def q_channel_id_loads(c: Context):
    """Messages that a second channel posts again under the same ids, loaded three times: the older
    ones, then all from the middle of the ids on with re-deliveries, then rows without keys."""
    base = fixtures.raw_messages(c.spark, c.sf_dir)
    both = base.unionByName(base.withColumn("channel_name", F.concat(F.lit("re_"), "channel_name")).withColumn(
        "views", F.col("views") + 1))
    middle = (c.spark.read.parquet(f"{c.sf_dir.rstrip('/')}/events.parquet").agg(F.max("event_id")).first()[0] or 0) // 2
    again = both.filter(f"message_id > {middle} and message_id % 10 = 0").withColumn("views", F.lit(0).cast("long")).withColumn(
        "scraped_at", F.expr("scraped_at + INTERVAL 1 DAY"))
    keyless = both.withColumn("message_id", F.expr("nullif(message_id % 3, 0)"))
    return _loads(c, [both.filter(f"message_id <= {middle} + 100"), both.filter(f"message_id > {middle}").unionByName(again),
                      keyless.filter("message_id is null")])


@report
def q_extended_raw(c: Context):
    """The extended raw variant, through CSV (S7) and back."""
    from .session import scratch_path
    from .sources import landing, sinks
    path = scratch_path(c.spark, "extended")
    raw = (fixtures.raw_messages(c.spark, c.sf_dir).withColumn("replies", F.lit(None).cast("bigint"))
           .withColumn("hashtags", F.expr("CASE WHEN message_id % 2 = 0 THEN array('a', channel_username) END"))
           .withColumn("potential_products", F.array().cast("array<string>")))
    kept = sinks.extended_raw(raw).select("message_id", "channel_name", "message_length", "replies", "hashtags",
                                          "hashtags_text", "potential_products_text")
    landing.export_csv(kept, path)
    back = c.spark.read.option("header", True).schema(
        "message_id long, channel_name string, message_length int, replies long, hashtags string, hashtags_text string, "
        "potential_products_text string").csv(path)
    return back.fillna("", ["hashtags", "hashtags_text", "potential_products_text"])


@report
def q_detections_csv(c: Context):
    """Classified detections appended to a table, exported as CSV and read back."""
    from .session import scratch_path
    from .sources import landing, sinks
    path = scratch_path(c.spark, "detections")
    sinks.load_detections(c.det, f"{path}/table")
    landing.export_csv(c.spark.read.parquet(f"{path}/table").select(
        "image_path", "channel_name", "message_id", "detected_objects", "detection_count", "image_category"), f"{path}/csv")
    return c.spark.read.option("header", True).schema(
        "image_path string, channel_name string, message_id long, detected_objects string, detection_count int, "
        "image_category string").csv(f"{path}/csv").fillna("", ["detected_objects"])


@report
def q_extract_audit(c: Context):
    """The four API extracts written as CSV; rows of each."""
    from functools import reduce

    from pyspark.sql import DataFrame as D

    from .session import scratch_path
    from .sources import landing, sinks
    paths = sinks.write_api_extracts(c.w, scratch_path(c.spark, "extracts"), AS_OF)
    return reduce(D.unionByName, [landing.extract_audit(c.spark, p).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
                                  .select(F.lit(n).alias("extract"), "rows") for n, p in sorted(paths.items())])


@report
def q_fixed_calendar(c: Context):
    """The declared calendar with the posts of each of its days."""
    from .plans.dims import date_dimension
    posts = c.w.fct.groupBy("date_key").agg(F.count(F.lit(1)).alias("posts"))
    return (date_dimension(c.spark).join(posts, "date_key", "left")
            .select("date_key", "full_date", "week_of_year", "day_name", F.coalesce("posts", F.lit(0)).alias("posts")))


@report
def q_search_after(c: Context):
    """O3 by keyset: the page after the last row of the first one."""
    first = search.search_messages_after(c.w.fct, c.w.dim_channels, c.w.dim_dates, "tablet", limit=20)
    last = first.orderBy("message_date", F.col("channel_name").desc(), F.col("message_id").desc()).limit(1).collect()
    after = (last[0]["message_date"], last[0]["channel_name"], last[0]["message_id"]) if last else None
    return search.search_messages_after(c.w.fct, c.w.dim_channels, c.w.dim_dates, "tablet", after=after, limit=20)


def _text_index(c: Context):
    from .plans.text_index import build_text_index
    from .session import scratch_path
    rows = c.w.fct.count()
    return build_text_index(c.w.fct, scratch_path(c.spark, "text_index"), max(1, rows // 64))


@report
def q_search_indexed(c: Context):
    """M21 through the text index: the second page of a term in some channels."""
    return _text_index(c).search(c.w.dim_channels, c.w.dim_dates, "tablet", channel="med", limit=20, page=2)


@report
def q_search_indexed_counts(c: Context):
    """M21 through the text index: matches of terms of two letters (all blocks), of three and more, and of a pattern."""
    index, terms = _text_index(c), [("mg", False), ("pil", False), ("vitamin 3", False), ("no such text", False), ("cap%le 1_0", True)]
    counts = [index.count(c.w.dim_channels, c.w.dim_dates, term, wildcards=wild).select(F.lit(term).alias("term"), "total_count")
              for term, wild in terms]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out


@report
def q_weekly_stats(c: Context):
    """Weekly posts, views, forwards, images and engagement of every channel."""
    weekly = marts.weekly_stats(marts.daily_stats(c.w.fct, c.w.dim_dates))
    return weekly.withColumn("avg_weekly_engagement", F.round("avg_weekly_engagement", 6))


@report
def q_channel_maps(c: Context):
    """Handles without ``@``; sums of a map's values before and after another is merged in."""
    from .functions.text import map_total, merge_maps, strip_handle
    base = F.create_map(F.lit("media"), F.col("posts_with_media"), F.lit("image"), F.col("posts_with_image"))
    more = F.create_map(F.lit("image"), F.col("total_posts"), F.lit("all"), F.col("total_posts"))
    return c.w.dim_channels.select("channel_key", strip_handle("channel_username").alias("handle"),
                                   map_total(base).alias("total"), map_total(merge_maps(base, more)).alias("merged_total"))


# ---------------------------------------------------------------- streaming

@report
def q_stream_daily_trend(c: Context):
    """T3 run as a stream over the events files (availableNow), result read back."""
    from .streaming import jobs
    raw = fixtures.raw_messages_from(fixtures.events_stream(c.spark, c.sf_dir),
                                     fixtures.read_table(c.spark, c.sf_dir, "part"))
    out = jobs.run_to_table(jobs.daily_trend_stream(stage_messages(raw, AS_OF)), "daily_trend")
    return jobs.daily_trend(c.spark.read.parquet(out))


@report
def q_stream_closed_days(c: Context):
    """T3 in append mode: the messages arrive in three batches by day, the last one with late copies of the first days,
    which the watermark drops; each day that is over is emitted once."""
    from .session import scratch_path
    from .streaming import jobs
    path, raw = scratch_path(c.spark, "arrivals"), fixtures.raw_messages(c.spark, c.sf_dir)
    files = fixtures.files_per_batch(c.spark, c.sf_dir)
    late = raw.filter("day(message_date) <= 10 AND message_id % 11 = 0")
    for batch in (raw.filter("day(message_date) <= 10"), raw.filter("day(message_date) BETWEEN 11 AND 20"),
                  raw.filter("day(message_date) > 20").unionByName(late)):
        fixtures.write_arrivals(batch, path, files)  # in this order
    stream = c.spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", files).parquet(path)
    run = jobs.run_append(jobs.closed_days(stage_messages(stream, AS_OF)), "closed_days")
    return c.spark.read.parquet(run.path).withColumn("late_groups", F.lit(run.late_groups).cast("long"))


@report
def q_stream_quality_counters(c: Context):
    """T4 run as a stream over the events files (availableNow, complete mode), result read back."""
    from .streaming import jobs
    raw = fixtures.raw_messages_from(fixtures.events_stream(c.spark, c.sf_dir),
                                     fixtures.read_table(c.spark, c.sf_dir, "part"))
    out = jobs.run_to_table(jobs.quality_counter_stream(stage_messages(raw, AS_OF)), "quality_counters")
    return c.spark.read.parquet(out)


@report
def q_stream_keyed_load(c: Context):
    """S5 + T1 + T2: the raw messages (with later re-deliveries) are written to the partitioned
    JSON-lines lake, streamed back (availableNow) and loaded with insert-or-ignore into a target
    table, which is read back."""
    from .sources.landing import raw_columns, write_lake
    from .session import scratch_path
    from .streaming import jobs
    lake, target = scratch_path(c.spark, "lake"), scratch_path(c.spark, "raw_target")
    incoming = fixtures.raw_messages_with_redeliveries(c.spark, c.sf_dir)
    write_lake(incoming.withColumn("scrape_date", F.to_date("scraped_at")), lake)
    # several micro-batches, so that later ones meet the keys that earlier ones have loaded
    files = len(c.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
                .load(lake).select("path").inputFiles())
    stream = jobs.landing_stream(c.spark, lake, layout="lines", max_files_per_trigger=max(1, -(-files // 3)))
    jobs.keyed_load(stream, target).awaitTermination()
    return raw_columns(c.spark.read.parquet(target))


@report
def q_stream_state_load(c: Context):
    """T2 with its keys as state: messages in two batches by id, then all their re-deliveries; two runs over one
    checkpoint, the second meeting the keys of the first."""
    from .session import scratch_path
    from .streaming import jobs
    arrivals, target, ckpt = (scratch_path(c.spark, f"state_{x}") for x in ("arrivals", "target", "checkpoint"))
    raw, copies = fixtures.raw_messages(c.spark, c.sf_dir), fixtures.raw_messages_with_redeliveries(c.spark, c.sf_dir)
    files = fixtures.files_per_batch(c.spark, c.sf_dir)
    for batches in ([raw.filter("message_id % 2 = 0"), raw.filter("message_id % 2 = 1")], [copies]):
        for batch in batches:
            fixtures.write_arrivals(batch, arrivals, files)  # in this order
        stream = c.spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", files).parquet(arrivals)
        jobs.state_load(stream, target, ckpt, "90 days").awaitTermination()
    return c.spark.read.parquet(target)


# ---------------------------------------------------------------- contexts

_PLANS: dict = {}


def lazy_context(spark: SparkSession, sf_dir: str) -> Context:
    """Context over the test tables: staging and the fact are lazy plans; the two small
    dimensions are written once to the shared checkpoint folder (from the test tables) so that
    joins see their real size. Plan objects are shared per (session, folder); every query still
    computes staging, the fact and its report from the test tables when it runs."""
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - sessions without a local SparkContext (e.g. Spark Connect)
        app = None
    key = (id(spark), app, sf_dir)
    if key not in _PLANS:
        w = fixture_warehouse(spark, sf_dir, AS_OF, stage_dimensions=True)
        w.stg, w.dim_dates, w.dim_channels, w.fct  # noqa: B018 - build the shared plans once
        _PLANS[key] = Context(spark, sf_dir, w)
    return _PLANS[key]


def materialized_context(spark: SparkSession, sf_dir: str, path: str) -> Context:
    """Build the warehouse and the detection table once into ``path`` (the serving setup:
    reports then read tables; the fact is partitioned by date_key for pruning)."""
    lazy = fixture_warehouse(spark, sf_dir, AS_OF)
    det_path = f"{path.rstrip('/')}/image_detections"
    # the detection table is independent of the star schema: built as a concurrent job
    w, _ = run_concurrently(
        lambda: lazy.materialize(path, partition_fact_by="date_key"),
        lambda: enrich.classify_images(fixtures.raw_detections(spark, sf_dir)).write.mode("overwrite")
        .parquet(det_path))
    return Context(spark, sf_dir, w, spark.read.parquet(det_path))


def _bind(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(lazy_context(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Query]:
    return {name: _bind(fn) for name, fn in REPORTS.items()}


def __getattr__(name: str):
    # q_<name>(spark, sf_dir) as module attributes, e.g. for the entry module
    if name in REPORTS:
        return _bind(REPORTS[name])
    raise AttributeError(name)
