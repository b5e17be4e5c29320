"""M4: message fact keyed to the channel and calendar dimensions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import date_key
from .dims import CHANNEL_ID
from .staging import valid_messages

FACT_COLUMNS = ["message_id", "channel_key", "date_key", "message_text", "message_length", "view_count",
                "forward_count", "has_image", "data_quality_status"]


def message_fact(stg: DataFrame, dim_channels: DataFrame, dim_dates: DataFrame) -> DataFrame:
    """Valid staged messages with channel_key and date_key.

    Channels are matched null-safely on all three identifying columns (a renamed channel
    is its own dimension row, so no fact is duplicated). The date key is computed from
    the message timestamp and kept only where the calendar has that day (semi-join).
    Neither dimension is hinted: both are aggregates whose size AQE measures at runtime,
    broadcasting them when small and keeping a sort-merge join (with skew splitting) otherwise.
    """
    m = valid_messages(stg).select(
        "message_id", *CHANNEL_ID,
        date_key(F.to_date("message_date")).alias("date_key"),
        F.col("cleaned_message_text").alias("message_text"),
        "message_length",
        F.col("views").alias("view_count"),
        F.col("forwards").alias("forward_count"),
        "has_image", "data_quality_status",
    )
    ch = dim_channels.select(*[F.col(c).alias(f"_d_{c}") for c in CHANNEL_ID], "channel_key")
    cond = reduce(lambda a, b: a & b, [m[c].eqNullSafe(ch[f"_d_{c}"]) for c in CHANNEL_ID])
    keyed = m.join(ch, cond, "inner")
    dated = keyed.join(dim_dates.select("date_key"), "date_key", "left_semi")
    return dated.select(*FACT_COLUMNS)
