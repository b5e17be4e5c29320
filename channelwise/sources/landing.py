"""Landing zone: raw per-(date, channel) JSON files -> typed raw message rows.

Collector layout: ``<root>/<YYYY-MM-DD>/<channel>.json``, each file a JSON array of message
objects (a single object is accepted too); ``_manifest.json`` files are skipped.
Our own lake writes JSON lines by ``scrape_date`` (splittable; by channel too if asked for),
read back with ``layout="lines"``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import as_of_col, to_utc_ntz
from ..functions.text import csv_join
from . import schemas

KEYS = ["message_id", "channel_name"]
DATE_IN_PATH = r"/(?:\w+=)?(\d{4}-\d{2}-\d{2})/"
LAKE_DATE = r"scrape_date=(\d{4}-\d{2}-\d{2})"
# microseconds kept (the JSON writer's default keeps milliseconds)
LAKE_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _session_tz(spark: SparkSession) -> str:
    return spark.conf.get("spark.sql.session.timeZone")


def _iso_to_utc(c, tz: str):
    """ISO-8601 text (with or without offset) -> UTC wall clock; zoneless text is taken as UTC.
    Null for text that is no timestamp."""
    has_zone = c.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    return F.when(has_zone, to_utc_ntz(c.try_cast("timestamp"), tz)).otherwise(c.try_cast("timestamp_ntz"))


_CORRUPT = "_corrupt"
_PARSED = T.StructType([*schemas.LANDING_JSON.fields, T.StructField(_CORRUPT, T.StringType())])


def _parse(record):
    """One JSON object; ``_corrupt`` holds its text if it is broken or a field has the wrong type."""
    return F.from_json(record, _PARSED, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})


def _split_elements(files: DataFrame) -> DataFrame:
    """(value = whole file text, source_file) -> (source_file, record, bad). A file is a JSON array
    (split into elements in the JVM) or one object; a file that is neither is one bad record."""
    body = F.trim(F.col("value"))
    elements = (F.when(body.startswith("["), F.from_json(body, T.ArrayType(T.StringType())))
                .when(body.startswith("{"), F.array(body)))
    els = files.select("source_file", "value", elements.alias("_els")).select(
        "source_file", F.col("_els").isNull().alias("_file"), F.explode(F.coalesce("_els", F.array("value"))).alias("record"))
    is_object = F.coalesce(F.trim("record").startswith("{"), F.lit(False))
    return els.select("source_file", "record", F.when(F.col("_file"), F.lit("malformed file"))
                      .when(~is_object, F.lit("not an object")).alias("bad"))


def _lines(lines: DataFrame) -> DataFrame:
    """(record = one JSON line, source_file) -> (source_file, record, bad); blank lines are left out."""
    return lines.filter(F.trim("record") != "").select("source_file", "record", F.lit(None).cast("string").alias("bad"))


def finish_landing(records: DataFrame, date_pat: str, tz: str, as_of=None) -> DataFrame:
    """(source_file, record, bad) -> one row per record: the typed message with defaults for absent
    non-key fields, source_file, scrape_date (from the path), record, and ``reason``: null for a good
    message, else why it is rejected (malformed file or object, not an object, null key, bad date)."""
    m = F.col("m")
    parsed = records.withColumn("m", F.when(F.col("bad").isNull(), _parse(F.col("record"))))
    posted, scraped = _iso_to_utc(m["message_date"], tz), _iso_to_utc(m["scraped_at"], tz)
    broken = m.isNull() | m[_CORRUPT].isNotNull()
    faults = F.concat_ws(
        ",", F.when(m["message_id"].isNull(), F.lit("null message_id")),
        F.when(m["channel_name"].isNull(), F.lit("null channel_name")),
        F.when(m["message_date"].isNotNull() & posted.isNull(), F.lit("bad message_date")),
        F.when(m["scraped_at"].isNotNull() & scraped.isNull(), F.lit("bad scraped_at")))
    zero = F.lit(0).cast("bigint")
    return parsed.select(
        m["message_id"].alias("message_id"), m["channel_name"].alias("channel_name"),
        m["channel_username"].alias("channel_username"), m["channel_title"].alias("channel_title"),
        posted.alias("message_date"),
        F.coalesce(m["message_text"], F.lit("")).alias("message_text"),
        F.coalesce(m["has_media"], F.lit(False)).alias("has_media"),
        m["image_path"].alias("image_path"),
        F.coalesce(m["views"], zero).alias("views"),
        F.coalesce(m["forwards"], zero).alias("forwards"),
        F.coalesce(scraped, as_of_col(as_of)).alias("scraped_at"),
        F.coalesce(m["replies"], zero).alias("replies"),
        m["hashtags"].alias("hashtags"), m["potential_products"].alias("potential_products"),
        "source_file", F.regexp_extract("source_file", date_pat, 1).try_cast("date").alias("scrape_date"),
        "record",
        F.coalesce("bad", F.when(broken, F.lit("malformed object")), F.nullif(faults, F.lit(""))).alias("reason"))


def good_messages(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reason").isNull()).drop("record", "reason")


def rejects(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reason").isNotNull()).select("source_file", "scrape_date", "reason", "record")


def parse_landing(spark: SparkSession, root: str, layout: str = "array", as_of=None,
                  pattern: str = "*/*.json") -> DataFrame:
    """Scan the landing zone once -> one row per record, good or rejected (see ``finish_landing``).

    ``layout="array"``: each file is read whole (files are one channel-day each) and its JSON array is
    split into elements in the JVM; every element is parsed on its own, so a bad element is rejected
    without losing the file's good messages. ``layout="lines"``: JSON lines (our lake), splittable.
    """
    if layout == "array":
        files = (spark.read.text(f"{root.rstrip('/')}/{pattern}", wholetext=True)
                 .select(F.col("value"), F.col("_metadata.file_path").alias("source_file")))
        records, date_pat = _split_elements(files), DATE_IN_PATH
    elif layout == "lines":
        lines = spark.read.text(root).select(F.col("value").alias("record"),
                                             F.col("_metadata.file_path").alias("source_file"))
        records, date_pat = _lines(lines), LAKE_DATE
    else:
        raise ValueError(f"unknown layout {layout!r}")
    return finish_landing(records, date_pat, _session_tz(spark), as_of)


def read_landing(spark: SparkSession, root: str, layout: str = "array", as_of=None) -> tuple[DataFrame, DataFrame]:
    """(messages, rejects) of ``parse_landing``. Both are views of one parse; write that once (as the
    batch job does) where both are used."""
    parsed = parse_landing(spark, root, layout, as_of)
    return good_messages(parsed), rejects(parsed)


def raw_columns(df: DataFrame, *more: str) -> DataFrame:
    """Just the canonical raw message columns (``schemas.RAW_MESSAGE``), and ``more``."""
    return df.select(*[f.name for f in schemas.RAW_MESSAGE.fields], *more)


def write_lake(messages: DataFrame, base: str, by_channel: bool = False) -> None:
    """JSON lines, one folder per scrape date (``by_channel``: per scrape date and channel, as the
    collector lays them out; with many small channels that is one small file each). Rerunning a date
    replaces only that date's folders (dynamic partition overwrite). The channel's name always stays in
    the record: folder names escape characters, so the name is never read from a path."""
    by = ["scrape_date", "channel"] if by_channel else ["scrape_date"]
    if by_channel:
        messages = messages.withColumn("channel", F.coalesce("channel_name", F.lit("unknown")))
    # rebalance on the folder columns: few files per folder, a hot folder split across tasks
    (messages.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("timestampNTZFormat", LAKE_TIMESTAMP_FORMAT).partitionBy(*by).json(base))


def write_manifest(manifest: DataFrame, base: str) -> None:
    """The run manifest stored as data under ``manifests/`` (no leading underscore, so file
    sources do not treat it as hidden). A rerun replaces the manifests of its scrape dates."""
    (manifest.withColumn("scrape_date", F.col("date")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("scrape_date").json(f"{base.rstrip('/')}/manifests"))


def write_rejects(found: DataFrame, base: str) -> None:
    """Rejects by scrape date; a rerun replaces those of its scrape dates."""
    (found.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("scrape_date")
     .parquet(f"{base.rstrip('/')}/rejects"))


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; array columns are written comma-joined."""
    cols = [csv_join(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name)
            for f in df.schema.fields]
    df.select(*cols).write.mode("overwrite").option("header", True).csv(path)


def landing_audit(spark: SparkSession, root: str) -> DataFrame:
    """Q16: landing file count, the latest file (by modification time) and its message count
    (each file's array is parsed to count its elements)."""
    files = (spark.read.text(f"{root.rstrip('/')}/*/*.json", wholetext=True)
             .select(F.col("_metadata.file_path").alias("path"),
                     F.col("_metadata.file_modification_time").alias("mtime"),
                     F.size(F.from_json(F.trim("value"), T.ArrayType(T.StringType()))).alias("n")))
    return files.agg(F.count(F.lit(1)).alias("file_count"),
                     F.max_by("path", F.struct("mtime", "path")).alias("latest_file"),
                     F.max_by("n", F.struct("mtime", "path")).alias("latest_file_messages"))


def extract_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Q17: rows per CSV extract file."""
    return (spark.read.option("header", True).csv(folder)
            .groupBy(F.col("_metadata.file_name").alias("file_name")).agg(F.count(F.lit(1)).alias("rows")))
