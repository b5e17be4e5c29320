"""Quality suite (M36), landing manifest (M37), table counts and data dictionary (M38),
insert-or-ignore as a query (M39)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import params
from ..functions.calendar import as_of_col
from ..operators import quality as Q
from ..operators.dedupe import insert_or_ignore
from ..session import scratch_path

RAW_KEYS = ["message_id", "channel_name"]


def run_quality_suite(stg: DataFrame, dim_channels: DataFrame, dim_dates: DataFrame, fct: DataFrame,
                      as_of=None) -> DataFrame:
    """Every check of the warehouse as one DataFrame (test_name, status, result).

    Contains the five in-process checks (future dates, negative views, channel types, the two
    foreign keys), the schema tests (not-null, unique, accepted values, not-negative,
    relationships) and the message-length test. The fact is read once: its row checks are counted by
    (channel_key, date_key) into a small written table, from which totals and foreign keys follow.
    A check that can't be evaluated is a FAIL with a null result.
    """
    now = as_of_col(as_of)
    valid = F.col("data_quality_status") == "valid"
    stg_checks = Q.row_checks(stg, [
        Q.expression("No future dates", (F.col("message_date") > now) & valid),
        Q.expression("No negative views", (F.col("views") < 0) & valid),
        Q.expression("assert_valid_message_lengths",
                     (F.col("message_length") < 0) | (F.col("message_length") > params.MAX_MESSAGE_LENGTH)),
    ])
    ch_checks = Q.row_checks(dim_channels, [
        Q.expression("All channels have type", F.col("channel_type").isNull() | (F.col("channel_type") == "")),
        Q.not_null("not_null_dim_channels_channel_key", "channel_key"),
        Q.not_null("not_null_dim_channels_channel_name", "channel_name"),
        Q.accepted_values("accepted_values_dim_channels_channel_type", "channel_type", params.CHANNEL_TYPES),
        Q.not_null("not_null_dim_channels_total_posts", "total_posts"),
        Q.not_negative("not_negative_dim_channels_total_posts", "total_posts"),
    ])
    date_checks = Q.row_checks(dim_dates, [
        Q.not_null("not_null_dim_dates_date_key", "date_key"),
        Q.not_null("not_null_dim_dates_full_date", "full_date"),
        Q.accepted_values("accepted_values_dim_dates_is_weekend", "is_weekend", [True, False]),
    ])
    checks_of_fact = [
        Q.not_null("not_null_fct_messages_message_id", "message_id"),
        Q.not_null("not_null_fct_messages_channel_key", "channel_key"),
        Q.not_null("not_null_fct_messages_date_key", "date_key"),
        Q.not_null("not_null_fct_messages_view_count", "view_count"),
        Q.not_negative("not_negative_fct_messages_view_count", "view_count"),
        Q.not_null("not_null_fct_messages_forward_count", "forward_count"),
        Q.not_negative("not_negative_fct_messages_forward_count", "forward_count"),
        Q.accepted_values("accepted_values_fct_messages_has_image", "has_image", [True, False]),
    ]
    spark = fct.sparkSession
    path = scratch_path(spark, "fact_profile")
    Q.profile(fct, [k for k in ("channel_key", "date_key") if k in fct.columns], checks_of_fact).write.parquet(path)
    by_key = spark.read.parquet(path)
    fct_checks = Q.profile_results(fct, by_key, checks_of_fact)

    def orphans(name, key, parent, null_passes):
        return Q.guarded(spark, name, lambda: Q.relationships(name, by_key, key, parent, key, null_passes))

    def doubled(name, df, key):
        return Q.guarded(spark, name, lambda: Q.unique(name, df, [key]))

    sets = [
        orphans("Foreign key integrity (channels)", "channel_key", dim_channels, False),
        orphans("Foreign key integrity (dates)", "date_key", dim_dates, False),
        doubled("unique_dim_channels_channel_key", dim_channels, "channel_key"),
        doubled("unique_dim_dates_date_key", dim_dates, "date_key"),
        orphans("relationships_fct_messages_channel_key", "channel_key", dim_channels, True),
        orphans("relationships_fct_messages_date_key", "date_key", dim_dates, True),
    ]
    results = reduce(DataFrame.unionByName, [stg_checks, ch_checks, date_checks, fct_checks, *sets])
    return Q.with_status(results)


def save_quality_results(results: DataFrame, path: str, as_of=None) -> None:
    """Results table with a timestamp column, written as CSV with a header."""
    # one row per check: a single output file is bounded
    (results.withColumn("checked_at", as_of_col(as_of)).coalesce(1)
     .write.mode("overwrite").option("header", True).csv(path))


def landing_manifest(messages: DataFrame, date_col: str = "scrape_date", run_utc=None,
                     extra: dict[str, str] | None = None) -> DataFrame:
    """One row per landing date and channel: message_count, the date's total, run time and extra
    fields. The total is an aggregate of the counts, joined back; no list of channels is built."""
    per = messages.groupBy(F.col(date_col).alias("date"), "channel_name").agg(F.count(F.lit(1)).alias("message_count"))
    total = per.groupBy(F.col("date").alias("_d")).agg(F.sum("message_count").alias("total_messages"))
    ex = F.create_map(*[x for k, v in (extra or {}).items() for x in (F.lit(k), F.lit(str(v)))]) if extra else \
        F.create_map().cast("map<string,string>")
    return (per.join(total, F.col("date").eqNullSafe(F.col("_d")))
            .select("date", "channel_name", "message_count", "total_messages", as_of_col(run_utc).alias("run_utc"),
                    ex.alias("extra")))


def manifest_rows(manifest: DataFrame) -> DataFrame:
    """The counts of a manifest: (date, channel_name, message_count, total_messages)."""
    return manifest.select("date", "channel_name", "message_count", "total_messages")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for every table: one small aggregate per table, unioned."""
    return reduce(DataFrame.unionByName,
                  [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
                   for name, df in tables.items()])


def data_dictionary(spark: SparkSession, tables: dict[str, DataFrame],
                    primary_keys: dict[str, list[str]] | None = None) -> DataFrame:
    """(table, column, type, nullable, pk) from the schemas (metadata only, no data scan)."""
    pks = primary_keys or {}
    rows = [(t, f.name, f.dataType.simpleString(), bool(f.nullable), f.name in pks.get(t, []))
            for t, df in tables.items() for f in df.schema.fields]
    return spark.createDataFrame(rows, "table string, column string, type string, nullable boolean, pk boolean")


def dedupe_messages(incoming: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Insert-or-ignore on (message_id, channel_name): the earliest scraped copy wins (ties by
    the remaining columns); rows with a null key are rejected; keys already loaded are skipped."""
    return insert_or_ignore(incoming, RAW_KEYS, ["scraped_at"], existing)
