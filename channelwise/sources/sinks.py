"""Table sinks and declared sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedupe import insert_or_ignore
from ..plans import reports
from ..plans.warehouse import Warehouse
from . import schemas
from .keyed_table import KeyedTable
from .landing import export_csv

RAW_KEYS = ["message_id", "channel_name"]


def declare_sources(spark: SparkSession, tables: dict[str, str], fmt: str = "parquet") -> dict[str, DataFrame]:
    """Register each ``name -> path`` as a temp view and return the DataFrames."""
    out = {}
    for name, path in tables.items():
        df = spark.read.format(fmt).load(path)
        df.createOrReplaceTempView(name)
        out[name] = df
    return out


def list_tables(spark: SparkSession) -> DataFrame:
    """Q15: the registered tables/views (metadata), one row each."""
    rows = [(t.name, t.tableType, bool(t.isTemporary)) for t in spark.catalog.listTables()]
    return spark.createDataFrame(rows, "name string, table_type string, is_temporary boolean")


def extended_raw(messages: DataFrame) -> DataFrame:
    """The extended raw variant: message length, replies, and the list columns both as
    arrays and comma-joined text (the text form of the source's storage)."""
    return messages.select(
        *[f.name for f in schemas.RAW_MESSAGE.fields],
        F.length(F.coalesce("message_text", F.lit(""))).cast("int").alias("message_length"),
        F.coalesce("replies", F.lit(0).cast("bigint")).alias("replies"),
        F.coalesce("hashtags", F.array().cast("array<string>")).alias("hashtags"),
        F.coalesce("potential_products", F.array().cast("array<string>")).alias("potential_products"),
        F.array_join(F.coalesce("hashtags", F.array().cast("array<string>")), ",").alias("hashtags_text"),
        F.array_join(F.coalesce("potential_products", F.array().cast("array<string>")), ",")
        .alias("potential_products_text"),
    )


def load_parquet_table(incoming: DataFrame, path: str, order=("scraped_at",), drop=()) -> DataFrame:
    """S8 as a table load: insert-or-ignore into the ``KeyedTable`` at ``path``; the rows that went in."""
    return KeyedTable(incoming.sparkSession, path).load(incoming, order, drop).inserted


def load_jdbc(incoming: DataFrame, url: str, table: str, properties: dict[str, str],
              keys=RAW_KEYS, order=("scraped_at",)) -> None:
    """Insert-or-ignore into a database table over JDBC. The keys already in the table are
    read once (key columns only), the new rows are computed in Spark and appended in batches
    by the JDBC writer. Needs the database's JDBC driver on the classpath (not shipped)."""
    spark = incoming.sparkSession
    existing = spark.read.jdbc(url, f"(SELECT {', '.join(keys)} FROM {table}) k", properties=properties)
    new = insert_or_ignore(incoming, keys, list(order), existing)
    new.write.mode("append").jdbc(url, table, properties=properties)


def load_detections(det: DataFrame, path: str) -> None:
    """Append classified detections (native arrays) with a load timestamp."""
    det.withColumn("created_at", F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())) \
        .write.mode("append").parquet(path)


def write_api_extracts(w: Warehouse, folder: str, as_of=None) -> dict[str, str]:
    """The four extract files (top products, channel activity, visual stats, daily trends)
    as CSV folders with headers."""
    base = folder.rstrip("/")
    extracts = {
        "top_products": reports.product_extract(w.fct),
        "channel_activity": reports.channel_activity(w.dim_channels),
        "visual_stats": reports.visual_stats_by_type(w.dim_channels, w.fct),
        "daily_trends": reports.daily_trend_extract(w.dim_dates, w.fct, days=30, as_of=as_of),
    }
    out = {}
    for name, df in extracts.items():
        export_csv(df, f"{base}/{name}")
        out[name] = f"{base}/{name}"
    return out
