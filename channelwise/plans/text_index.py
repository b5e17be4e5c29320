"""A trigram index for message search.

``build_text_index`` lays the searchable columns of the fact out in blocks of about ``BLOCK_ROWS`` messages, a folder
each, ordered by channel and day so that a block's messages share their words, and writes the postings: for
every three successive characters of the lower-cased texts the blocks that hold them. Postings are sorted by gram, so
looking a few up reads a few row groups.

A search for three or more characters takes the blocks that hold all grams of the term; their numbers become a
partition filter, so only those folders are read, and ``contains`` decides there. Shorter terms and patterns
without three literal characters in a row read all blocks. Results are those of the plain search.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranking import ordered_row_number
from . import search

GRAM = 3
BLOCK_ROWS = 100_000
LISTED = 4096  # block numbers that go into a filter as literals; more are joined
COLUMNS = ["message_id", "channel_key", "date_key", "message_text", "message_length", "view_count", "forward_count", "has_image"]


def grams_of(term: str, wildcards: bool = False) -> list[str]:
    """The distinct grams that every matching text holds; ``%`` and ``_`` stand for anything if ``wildcards``."""
    runs = re.split("[%_]", term.lower()) if wildcards else [term.lower()]
    return sorted({run[i:i + GRAM] for run in runs for i in range(len(run) - GRAM + 1)})


def build_text_index(fct: DataFrame, path: str, block_rows: int = BLOCK_ROWS) -> "TextIndex":
    """Write the blocks and postings of ``fct`` below ``path``."""
    base = path.rstrip("/")
    rows = ordered_row_number(fct.select(*COLUMNS), [F.col("channel_key"), F.col("date_key"), F.col("message_id"),
                                                     F.col("message_text"), F.col("view_count")], "place")
    blocks = rows.withColumn("block", F.expr(f"cast((place - 1) div {block_rows} as int)")).drop("place")
    blocks.write.mode("overwrite").partitionBy("block").parquet(f"{base}/blocks")
    text = F.lower("message_text")
    # a block's grams are bounded by its characters, and equal ones are dropped in the tasks that cut them
    cut = F.transform(F.sequence(F.lit(1), F.length(text) - (GRAM - 1)), lambda i: F.substring(text, i, F.lit(GRAM)))
    grams = (TextIndex(fct.sparkSession, base).blocks().filter(F.length("message_text") >= GRAM)
             .select("block", F.explode(F.array_distinct(cut)).alias("gram")).distinct())
    grams.repartitionByRange("gram", "block").sortWithinPartitions("gram", "block") \
        .write.mode("overwrite").parquet(f"{base}/postings")
    return TextIndex(fct.sparkSession, base)


@dataclass
class TextIndex:
    """The index below ``path``."""

    spark: SparkSession
    path: str

    def blocks(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/blocks")

    def candidates(self, term: str, wildcards: bool = False) -> DataFrame | None:
        """(block) of the blocks that hold all grams of the term; None if it has none, so that any block may match."""
        grams = grams_of(term, wildcards)
        if not grams:
            return None
        return (self.spark.read.parquet(f"{self.path}/postings").filter(F.col("gram").isin(grams))
                .groupBy("block").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == len(grams)).select("block"))

    def messages(self, term: str, wildcards: bool = False) -> DataFrame:
        """The rows of the blocks that may match ``term``, to be searched like the fact."""
        found = self.candidates(term, wildcards)
        if found is None:
            return self.blocks().drop("block")
        listed = [r.block for r in found.limit(LISTED + 1).collect()]
        if len(listed) <= LISTED:
            return self.blocks().filter(F.col("block").isin(listed)).drop("block")
        return self.blocks().join(found, "block", "left_semi").drop("block")

    def search(self, dim_channels: DataFrame, dim_dates: DataFrame, query: str, channel: str | None = None, limit: int = 20,
               page: int = 1, wildcards: bool = False, since=None, until=None) -> DataFrame:
        """One page of matches, as ``search.search_messages`` gives them."""
        return search.search_messages(self.messages(query, wildcards), dim_channels, dim_dates, query, channel, limit, page,
                                      wildcards, since, until)

    def count(self, dim_channels: DataFrame, dim_dates: DataFrame, query: str, channel: str | None = None,
              wildcards: bool = False, since=None, until=None) -> DataFrame:
        """The number of matches, as ``search.search_count`` gives it."""
        return search.search_count(self.messages(query, wildcards), dim_channels, dim_dates, query, channel, wildcards, since,
                                   until)
