"""Structured Streaming versions of the incremental behaviour.

* T1 ``landing_stream``: new landing files only (file-source bookkeeping in the checkpoint).
* T2 ``keyed_load``: idempotent insert-or-ignore into a keyed table, per micro-batch; ``state_load``: the same with the
  keys of the last days as the query's own state, so that the target is never read.
* T3 ``daily_trend_stream``: running event-time days with a watermark; ``closed_days``: each day once, when it is over,
  with state that is evicted.
* T4 ``quality_counter_stream``: running violation counters.

All state lives in checkpoint folders under the shared ``spark.checkpoint.dir``; a restarted
query resumes from it, so a lost executor or driver restart does not duplicate output.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.calendar import to_utc_ntz, utc_instant
from ..session import scratch_path
from ..sources.keyed_table import KeyedTable
from ..sources.landing import DATE_IN_PATH, LAKE_DATE, _lines, _split_elements, finish_landing, good_messages, rejects

KEYS = ["message_id", "channel_name"]


def landing_stream(spark: SparkSession, root: str, max_files_per_trigger: int | None = None,
                   as_of=None, with_rejects: bool = False, layout: str = "array"):
    """Streaming scan of the landing zone, new files only, parsed exactly as the batch scan.
    ``layout="array"``: collector files ``<root>/<date>/<channel>.json`` (whole file -> elements
    -> per-element parse); ``layout="lines"``: our JSON-lines lake (one record per line).
    Defaults and key checks as in batch. Returns the message stream, or (messages, rejects)
    streams with ``with_rejects``."""
    tz = spark.conf.get("spark.sql.session.timeZone")
    if layout == "array":
        r = spark.readStream.option("wholetext", True)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        files = (r.text(f"{root.rstrip('/')}/*/*.json")
                 .select(F.col("value"), F.col("_metadata.file_path").alias("source_file")))
        records, date_pat = _split_elements(files), DATE_IN_PATH
    elif layout == "lines":
        r = spark.readStream.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        lines = (r.text(root).select(F.col("value").alias("record"),
                                     F.col("_metadata.file_path").alias("source_file")))
        records, date_pat = _lines(lines), LAKE_DATE
    else:
        raise ValueError(f"unknown layout {layout!r}")
    parsed = finish_landing(records, date_pat, tz, as_of)
    return (good_messages(parsed), rejects(parsed)) if with_rejects else good_messages(parsed)


def keyed_load(stream: DataFrame, target: str, checkpoint: str | None = None,
               order=("scrape_date", "scraped_at", "source_file")) -> StreamingQuery:
    """Each micro-batch is a load of the ``KeyedTable`` at ``target``, so replays and re-deliveries insert
    nothing twice, whatever their delay. Its index tells new keys, and only the buckets of the others are read. The earliest
    copy (scrape date, scrape time, file) wins. Runs to completion over what is available (``availableNow``)."""
    spark = stream.sparkSession
    ckpt = checkpoint or scratch_path(spark, "keyed_load_checkpoint")

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        KeyedTable(batch.sparkSession, target).load(batch, order)

    return (stream.writeStream.foreachBatch(upsert).option("checkpointLocation", ckpt)
            .trigger(availableNow=True).start())


def dedupe_stream(stream: DataFrame, delay: str = "2 days", keys=KEYS) -> DataFrame:
    """T2 with bounded state: drop re-deliveries of a key that arrive within ``delay`` (event
    time = scrape time) of its first copy. State is evicted by the watermark, so it stays
    proportional to the keys of the last ``delay`` instead of every key ever loaded."""
    tz = stream.sparkSession.conf.get("spark.sql.session.timeZone")
    return (stream.withColumn("_scraped_instant", utc_instant(F.col("scraped_at"), tz))
            .withWatermark("_scraped_instant", delay)
            .dropDuplicatesWithinWatermark(list(keys))
            .drop("_scraped_instant"))


def state_load(stream: DataFrame, target: str, checkpoint: str | None = None, delay: str = "30 days",
               columns: list[str] | None = None) -> StreamingQuery:
    """T2 without reading the target: keys live in the query's state, checkpointed with the offsets, and new rows go to
    a Parquet file sink whose log commits each batch once, so a replayed batch and a resumed query insert nothing twice.
    The first copy to arrive wins. State is bounded: a key is forgotten ``delay`` (of scrape time) after its first copy; rows
    scraped longer ago than that when they arrive are dropped as late (``keyed_load`` has no such limit). Runs over
    what is available; ``columns``: those to keep, if not all."""
    rows = dedupe_stream(stream, delay)
    return ((rows.select(*columns) if columns else rows).writeStream.format("parquet").outputMode("append")
            .option("path", target).option("checkpointLocation", checkpoint or scratch_path(stream.sparkSession, "state_load"))
            .trigger(availableNow=True).start())


def daily_trend_stream(staged: DataFrame, watermark: str = "1 day") -> DataFrame:
    """Per event-time day and channel, posts / views / image posts of valid messages. Late data
    within ``watermark`` updates its day; older data is dropped by the watermark. Channels are kept
    apart in the state, so ``daily_trend`` counts the active ones exactly."""
    tz = staged.sparkSession.conf.get("spark.sql.session.timeZone")
    valid = (staged.filter(F.col("data_quality_status") == "valid")
             .withColumn("event_time", utc_instant(F.col("message_date"), tz)))
    return (valid.withWatermark("event_time", watermark)
            .groupBy(F.window("event_time", "1 day").alias("w"), "channel_name")
            .agg(F.count(F.lit(1)).alias("post_count"), F.sum("views").alias("total_views"),
                 F.sum(F.col("has_image").cast("int")).alias("image_posts"))
            .select(F.to_date(to_utc_ntz(F.col("w.start"), tz)).alias("full_date"), "channel_name", "post_count",
                    "total_views", "image_posts"))


def daily_trend(per_channel: DataFrame) -> DataFrame:
    """The stream's per-channel result as one row per day, with the exact number of active channels."""
    return (per_channel.groupBy("full_date")
            .agg(F.sum("post_count").alias("post_count"), F.sum("total_views").alias("total_views"),
                 F.sum("image_posts").alias("image_posts"), F.count(F.lit(1)).alias("channels_active")))


def quality_counter_stream(staged: DataFrame) -> DataFrame:
    """T4: running totals of staging quality flags (update mode)."""
    return staged.agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_if(F.col("is_empty_message")).alias("empty_messages"),
        F.count_if(F.col("has_negative_views")).alias("negative_views"),
        F.count_if(F.col("data_quality_status") == "needs_review").alias("needs_review"),
    )


def closed_days(staged: DataFrame, watermark: str = "1 day") -> DataFrame:
    """T3 for append mode: one row per event-time day, emitted once, when the watermark has passed its end. Two
    stateful operators in a chain: (day, channel) counts, then days; both forget a day when it is emitted, so state
    holds the open days only. What comes later than that is dropped (and counted, see ``run_append``). The number of active
    channels is exact."""
    tz = staged.sparkSession.conf.get("spark.sql.session.timeZone")
    valid = (staged.filter(F.col("data_quality_status") == "valid")
             .withColumn("event_time", utc_instant(F.col("message_date"), tz)))
    by_channel = (valid.withWatermark("event_time", watermark).groupBy(F.window("event_time", "1 day").alias("w"), "channel_name")
                  .agg(F.count(F.lit(1)).alias("post_count"), F.sum("views").alias("total_views"),
                       F.sum(F.col("has_image").cast("int")).alias("image_posts")))
    days = by_channel.groupBy(F.window(F.window_time("w"), "1 day").alias("day")).agg(
        F.sum("post_count").alias("post_count"), F.sum("total_views").alias("total_views"),
        F.sum("image_posts").alias("image_posts"), F.count(F.lit(1)).alias("channels_active"))
    return days.select(F.to_date(to_utc_ntz(F.col("day.start"), tz)).alias("full_date"), "post_count", "total_views",
                       "image_posts", "channels_active")


@dataclass
class AppendRun:
    """One finished run of ``run_append``: where its rows are, how many late groups (here: a day and channel of one batch)
    the watermark dropped, and the rows of state held after each batch."""

    path: str
    late_groups: int
    state_rows: list[int]


def run_append(df: DataFrame, name: str, checkpoint: str | None = None, path: str | None = None) -> AppendRun:
    """Run an append-mode stream over everything available into a Parquet file sink, whose log commits each
    batch once. The same ``checkpoint`` and ``path`` resume: rows that were emitted are not emitted again."""
    spark = df.sparkSession
    out = path or scratch_path(spark, f"stream_out/{name}")
    ckpt = checkpoint or scratch_path(spark, f"stream_ckpt/{name}")
    q = (df.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    batches = [[op for op in p.stateOperators] for p in q.recentProgress]
    return AppendRun(out, sum(op.numRowsDroppedByWatermark for ops in batches for op in ops),
                     [sum(op.numRowsTotal for op in ops) for ops in batches])


def _committed_batches(spark: SparkSession, out: str) -> list[int]:
    """Numbers of the batch folders below ``out`` that were written to the end."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    folders = path(f"{out}/batch=*")
    fs = folders.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s.getPath() for s in fs.globStatus(folders) or []]
    return sorted(int(p.getName().split("=")[1]) for p in found if fs.exists(path(p, "_SUCCESS")))


def run_to_table(df: DataFrame, name: str, output_mode: str = "complete", keys: list[str] | None = None,
                 checkpoint: str | None = None, path: str | None = None) -> str:
    """Run a streaming aggregation over everything available and keep its latest result as a Parquet
    table, one folder per micro-batch; returns the newest folder. ``complete``: each batch is the whole
    result. ``update``: each batch holds changed rows, which replace those of the same ``keys`` in the
    result before it. The same ``checkpoint`` and ``path`` resume from the result that is there; with nothing new to
    read it stays. With nothing to read at all, the result is an empty table."""
    spark = df.sparkSession
    out = path or scratch_path(spark, f"stream_out/{name}")
    ckpt = checkpoint or scratch_path(spark, f"stream_ckpt/{name}")
    if output_mode == "update" and not keys:
        raise ValueError("update mode needs the result's keys")
    if not _committed_batches(spark, out):
        spark.createDataFrame([], df.schema).write.mode("overwrite").parquet(f"{out}/batch=-1")

    def sink(batch: DataFrame, epoch_id: int) -> None:
        result = batch
        if output_mode == "update":
            # a batch that is run again replaces itself, so it starts from the one before it
            last = max(n for n in _committed_batches(spark, out) if n < epoch_id)
            before = batch.sparkSession.read.schema(batch.schema).parquet(f"{out}/batch={last}")
            result = batch.unionByName(before.join(batch.select(*keys), keys, "left_anti"))
        result.write.mode("overwrite").parquet(f"{out}/batch={epoch_id}")

    q = (df.writeStream.outputMode(output_mode).foreachBatch(sink).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return f"{out}/batch={_committed_batches(spark, out)[-1]}"
