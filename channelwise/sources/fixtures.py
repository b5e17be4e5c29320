"""Stand-in inputs built from the driver's test tables.

These builders only produce rows in the schema the jobs expect (raw messages, raw
detections); they do none of the jobs' work. The mapping is fixed (FIXTURES.md §3/§4).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Fixed values of the mapping. A channel belongs to each user (so channels grow with the data); every
# third event belongs to channel 0, which so holds a third of all messages. The name's first part goes
# by the channel number % 8, and one of them holds characters that folder names and paths escape.
CHANNEL_KEY = "CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END"
FIXTURE_CHANNELS = ["tabletmart", "lotionshop", "doctorline", "cityclinic", "daily news 50%=ዜና:", "skincorner",
                    "chemed", "medicalhub"]
# Product-form words keyed by event_id % 13 (index 12 -> 'offer').
FIXTURE_FORMS = [
    "Tablet", "pill", "capsule", "cream", "ointment", "syrup", "liquid", "injection", "vitamin",
    "supplement", "device", "equipment",
]
FIXTURE_OBJECTS = ["", "person,bottle", "bottle,cup", "person", "vase", "car,dog", "person,cell phone,bottle"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def channel_name(key: str = CHANNEL_KEY) -> str:
    """SQL expression of a channel's name from its number."""
    names = ", ".join(f"'{n}'" for n in FIXTURE_CHANNELS)
    return f"concat(element_at(array({names}), CAST(({key}) % 8 AS INT) + 1), '_', CAST({key} AS STRING))"


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events ⋈ part -> raw message rows (schema ``schemas.RAW_MESSAGE``)."""
    return raw_messages_from(read_table(spark, sf_dir, "events"), read_table(spark, sf_dir, "part"))


def events_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The events table as a streaming file source (new files under the glob are picked up)."""
    schema = read_table(spark, sf_dir, "events").schema
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(f"{sf_dir.rstrip('/')}/events*.parquet")


def _sql_case(key_sql: str, values, default: str) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {key_sql} {whens} ELSE '{default}' END"


def raw_messages_from(events: DataFrame, part: DataFrame) -> DataFrame:
    """The mapping over given events (batch or streaming) and part tables. The projection is
    written as SQL expressions (parsed once in the JVM)."""
    e = events.select("event_id", "ts", "user_id", "event_type", "value", "props")
    # every part takes part: the events go round the parts' whole key range
    p = part.select("p_partkey", "p_name", "p_size")
    keys = part.agg(F.max("p_partkey").alias("m")).first()["m"]
    j = (e.withColumn("channel_name", F.expr(channel_name()))
         .join(p, (F.col("event_id") % F.lit((keys or 0) + 1)) == F.col("p_partkey")))
    form = _sql_case("event_id % 13", FIXTURE_FORMS, "offer")
    image = "concat('data/raw/images/', channel_name, '/', CAST(event_id AS STRING), '.jpg')"
    return j.selectExpr(
        "event_id AS message_id",
        "channel_name",
        "concat('@', channel_name) AS channel_username",
        "concat('Title ', channel_name) AS channel_title",
        "CAST(ts AS TIMESTAMP_NTZ) AS message_date",
        "CASE WHEN event_id % 20 = 0 THEN CAST(NULL AS STRING) WHEN event_id % 20 = 1 THEN '   ' "
        f"ELSE concat('  ', p_name, ' ', {form}, ' ', CAST(p_size * 10 AS STRING), "
        "CASE event_id % 3 WHEN 0 THEN 'mg' WHEN 1 THEN ' ml' ELSE '' END, ' ') END AS message_text",
        "event_type IN ('view', 'click') AS has_media",
        f"CASE WHEN event_type = 'view' THEN {image} END AS image_path",
        "CASE WHEN event_id % 50 = 0 THEN CAST(NULL AS BIGINT) WHEN event_id % 97 = 0 THEN CAST(-1 AS BIGINT) "
        "ELSE CAST(floor(value * 40) AS BIGINT) END AS views",
        "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS forwards",
        "CAST(ts AS TIMESTAMP_NTZ) + INTERVAL 1 DAY AS scraped_at",
    )


def raw_messages_with_redeliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw messages plus a later re-delivery of every 10th message (scraped one day later,
    views + 1), as input for the insert-or-ignore load."""
    base = raw_messages(spark, sf_dir)
    again = (base.filter(F.col("message_id") % 10 == 0)
             .withColumn("scraped_at", F.col("scraped_at") + F.expr("INTERVAL 1 DAY"))
             .withColumn("views", F.col("views") + 1))
    return base.unionByName(again)


#: Events for each file of a batch of arrivals.
EVENTS_PER_FILE = 250_000


def files_per_batch(spark: SparkSession, sf_dir: str, events_per_file: int = EVENTS_PER_FILE) -> int:
    """Files that a batch of arrivals is written to, in proportion to the events table."""
    return max(1, -(-read_table(spark, sf_dir, "events").count() // events_per_file))


def write_arrivals(batch: DataFrame, path: str, files: int) -> None:
    """Append ``batch`` to the Parquet folder at ``path`` as exactly ``files`` files of about the same size, so that a
    stream of ``files`` files a trigger reads batch after batch. Empty parts leave no file; empty files stand for them."""
    def listed() -> int:
        try:
            return len(spark.read.schema(batch.schema).parquet(path).inputFiles())
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return 0
            raise

    spark = batch.sparkSession
    before = listed()
    batch.repartition(files).write.option("maxRecordsPerFile", 0).mode("append").parquet(path)
    for _ in range(before + files - listed()):
        spark.createDataFrame([], batch.schema).coalesce(1).write.mode("append").parquet(path)


def raw_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events(view) -> raw detector output rows (schema ``schemas.RAW_DETECTION``)."""
    e = (read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
         .filter(F.col("event_type") == "view"))
    csv = _sql_case("event_id % 7", FIXTURE_OBJECTS, FIXTURE_OBJECTS[-1])
    objs = f"CASE WHEN {csv} = '' THEN CAST(array() AS ARRAY<STRING>) ELSE split({csv}, ',') END"
    j = e.withColumn("channel_name", F.expr(channel_name()))
    return (j.selectExpr(
        "concat('data/raw/images/', channel_name, '/', CAST(event_id AS STRING), '.jpg') AS image_path",
        f"{objs} AS detected_objects", "event_id", "ts")
        .selectExpr(
            "image_path", "detected_objects",
            # deterministic stand-in scores, one per object, above the threshold
            "transform(detected_objects, (x, i) -> round(0.3 + ((event_id + i) % 70) / 100.0, 3)) "
            "AS confidence_scores",
            "CAST(ts AS TIMESTAMP_NTZ) + INTERVAL 1 HOUR AS detection_time"))


def image_file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages -> rows in the ``binaryFile`` schema (path, modificationTime, length, content): each
    page's HTML bytes stand in for an image file at ``data/raw/images/<channel>/<page_id>.jpg``
    (the channel's number is the page_id). Input for the detection job only."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "html")
    j = pages.withColumn("channel_name", F.expr(channel_name("page_id")))
    return j.selectExpr(
        "concat('data/raw/images/', channel_name, '/', CAST(page_id AS STRING), '.jpg') AS path",
        "CAST(TIMESTAMP_NTZ '2024-01-20 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, page_id) AS TIMESTAMP)"
        " AS modificationTime",
        "CAST(octet_length(html) AS BIGINT) AS length",
        "encode(html, 'UTF-8') AS content")


def write_landing_files(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Collector files built from the raw messages: ``<root>/d=<date>/f=<n>/part-*.txt``, each one JSON
    array of a scrape date and a block of 500 message ids. Fixed faults: every 37th element is text instead
    of an object, every 41st has a count as text, every 43rd no id, every 31st no readable date, every even
    one an offset of three hours; files of the 13th of a month are cut off in the middle."""
    raw = raw_messages(spark, sf_dir)
    zone = "concat(date_format(message_date + INTERVAL 3 HOUR, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), '+03:00')"
    plain = "date_format(message_date, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")"
    rows = raw.selectExpr(
        "message_id AS id", "to_date(scraped_at) AS d", "CAST(floor(message_id / 500) AS BIGINT) AS f",
        f"""to_json(named_struct(
          'message_id', CASE WHEN message_id % 43 = 0 THEN NULL ELSE message_id END,
          'channel_name', channel_name, 'channel_username', channel_username, 'channel_title', channel_title,
          'message_date', CASE WHEN message_id % 31 = 0 THEN 'some day' WHEN message_id % 2 = 0 THEN {zone} ELSE {plain} END,
          'message_text', message_text, 'has_media', has_media, 'image_path', image_path, 'views', views,
          'forwards', forwards, 'scraped_at', date_format(scraped_at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))) AS good""",
    ).selectExpr("d", "f", "id", """CASE WHEN id % 37 = 0 THEN '"just text"'
          WHEN id % 41 = 0 THEN concat('{"message_id":', id, ',"channel_name":"x","views":"many"}') ELSE good END AS e""")
    files = rows.groupBy("d", "f").agg(F.array_join(F.array_sort(F.collect_list("e")), ",").alias("es"))
    text = F.concat(F.lit("["), F.col("es"), F.lit("]"))
    cut = F.when(F.dayofmonth("d") == 13, F.substring(text, F.lit(1), F.floor(F.length(text) / 2).cast("int"))).otherwise(text)
    files.select("d", "f", cut.alias("value")).write.partitionBy("d", "f").text(root)


def damaged(w) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The warehouse's staging, channels, calendar and fact with fixed faults of every kind that the
    quality suite looks for (rows are picked by their ids)."""
    stg = (w.stg.withColumn("message_date", F.expr("CASE WHEN message_id % 101 = 0 THEN message_date + INTERVAL 90 DAY "
                                                   "ELSE message_date END"))
           .withColumn("views", F.expr("CASE WHEN message_id % 103 = 0 THEN -5 ELSE views END"))
           .withColumn("message_length", F.expr("CASE WHEN message_id % 107 = 0 THEN 20000 WHEN message_id % 109 = 0 "
                                                "THEN -1 ELSE message_length END")))
    ch = (w.dim_channels.withColumn("channel_type", F.expr("CASE channel_key % 7 WHEN 0 THEN '' WHEN 1 THEN NULL "
                                                           "WHEN 2 THEN 'Unknown' ELSE channel_type END"))
          .withColumn("channel_name", F.expr("CASE WHEN channel_key % 11 = 0 THEN NULL ELSE channel_name END"))
          .withColumn("total_posts", F.expr("CASE WHEN channel_key % 5 = 0 THEN -1 WHEN channel_key % 5 = 1 THEN NULL "
                                            "ELSE total_posts END"))
          .withColumn("channel_key", F.expr("CASE WHEN channel_key % 13 = 0 THEN NULL WHEN channel_key % 13 = 1 "
                                            "THEN channel_key + 1 ELSE channel_key END")))
    dates = (w.dim_dates.withColumn("full_date", F.expr("CASE WHEN date_key % 9 = 0 THEN NULL ELSE full_date END"))
             .withColumn("date_key", F.expr("CASE WHEN date_key % 10 = 0 THEN NULL WHEN date_key % 10 = 1 THEN "
                                            "CAST(date_key + 1 AS INT) ELSE date_key END")))
    fct = (w.fct.withColumn("view_count", F.expr("CASE message_id % 17 WHEN 0 THEN NULL WHEN 1 THEN -1 ELSE view_count END"))
           .withColumn("forward_count", F.expr("CASE message_id % 19 WHEN 0 THEN NULL WHEN 1 THEN -1 ELSE forward_count END"))
           .withColumn("channel_key", F.expr("CASE message_id % 23 WHEN 0 THEN NULL WHEN 1 THEN -1 ELSE channel_key END"))
           .withColumn("date_key", F.expr("CASE message_id % 29 WHEN 0 THEN NULL WHEN 1 THEN 19000101 ELSE date_key END"))
           .withColumn("message_id", F.expr("CASE WHEN message_id % 31 = 0 THEN NULL ELSE message_id END")))
    return stg, ch, dates, fct
