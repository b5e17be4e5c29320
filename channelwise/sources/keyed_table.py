"""A Parquet table that is loaded by key and reads only what a load touches.

*Layout.* Message ids are unique only within a channel, so rows lie in ``bucket`` folders chosen by a hash of
(channel, block of ``ID_BLOCK`` ids). A channel's neighbouring messages share a bucket, so a load of new
messages names few; the blocks of a channel that holds a third of all rows spread over all buckets.

*Index.* Beside the table lie Bloom filters, as small Parquet rows: for every bucket a fixed number of pages of
32,768 bits. A key belongs to one page of its bucket and sets ``BITS`` bits there, so testing it takes one row.
A load adds rows for the pages it touches (``compact_index`` merges them with ``bitmap_or_agg``). Building and testing
are built-in functions. The index is written before the rows: a load that dies between the two leaves only bits without
rows, which cost a look and never a message.

*Load.* The input's keys are counted once, and that gives the load's figures, its rejects and the keys that need reducing.
Keys that miss the index are new. The others are looked up, in their buckets alone: the bucket numbers (a bounded list) become a
partition filter, so Spark lists and reads only those folders.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedupe import first_per_key
from ..session import scratch_path

KEYS = ("message_id", "channel_name")
ID_BLOCK = 1000
BUCKETS = 64
PAGES = 4
PAGE_BITS = 32_768  # of bitmap_construct_agg
BITS = 3


def read_existing(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None if there is none yet. Any other fault (a damaged file, missing
    rights) rises: a table that can't be read must not count as empty."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


@dataclass
class Load:
    """One finished load: the rows it inserted, its figures (one row: read, rejected, duplicate, already_loaded,
    inserted) and the buckets that it read."""

    inserted: DataFrame
    counts: DataFrame
    buckets_read: list[int]


class KeyedTable:
    """The table at ``path`` and its index at ``path``_index. The numbers of buckets and pages belong to the table: they
    are fixed by its first load. Size them so that a page gets fewer than about 3,000 keys (one test in a
    hundred then finds a key that isn't there) and a bucket's files suit one task."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, pages: int = PAGES,
                 keys: Sequence[str] = KEYS):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.index_path = f"{self.path}_index"
        shape = read_existing(spark, f"{self.index_path}/shape")
        self.is_new = shape is None
        if shape is None:
            if read_existing(spark, self.path) is not None:
                raise ValueError(f"{path} has no index: it wasn't loaded as a keyed table")
            self.buckets, self.pages = buckets, pages
        else:
            self.buckets, self.pages = shape.select("buckets", "pages").first()

    # ------------------------------------------------------------------ layout and index

    def bucket(self) -> Column:
        ident, channel = self.keys
        block = F.floor(F.col(ident) / ID_BLOCK)
        return F.pmod(F.xxhash64(F.lit("bucket"), channel, block), F.lit(self.buckets)).cast("int")

    def _probes(self, keys: DataFrame) -> DataFrame:
        """``keys`` with their bucket, page and bits."""
        bits = [F.pmod(F.xxhash64(F.lit(f"bit{k}"), *self.keys), F.lit(PAGE_BITS)) for k in range(BITS)]
        page = F.pmod(F.xxhash64(F.lit("page"), *self.keys), F.lit(self.pages)).cast("int")
        return keys.select(*self.keys, self.bucket().alias("bucket"), page.alias("page"), F.array(*bits).alias("bits"))

    def _page_rows(self, keys: DataFrame) -> DataFrame:
        """(bucket, page, bitmap) of the keys."""
        return (self._probes(keys).select("bucket", "page", F.explode("bits").alias("bit"))
                .groupBy("bucket", "page").agg(F.bitmap_construct_agg("bit").alias("bitmap")))

    def index(self) -> DataFrame | None:
        return read_existing(self.spark, f"{self.index_path}/pages")

    def possible(self, keys: DataFrame) -> DataFrame:
        """Those of ``keys`` that the table may hold, with their bucket. A key that it holds is always among them."""
        index = self.index()
        if index is None:
            return self._probes(keys).select(*self.keys, "bucket").limit(0)
        # a set of bits is tested byte by byte, as bitmap_construct_agg lays them out
        held = F.expr("forall(bits, x -> (cast(conv(hex(substring(bitmap, cast(x div 8 as int) + 1, 1)), 16, 10) as int)"
                      " & shiftleft(1, cast(x % 8 as int))) != 0)")
        return (self._probes(keys).join(index.select("bucket", "page", "bitmap"), ["bucket", "page"]).filter(held)
                .select(*self.keys, "bucket").distinct())

    def compact_index(self) -> None:
        """Merge the pages of all loads, one row for each page. To be run while no load does."""
        index = self.index()
        if index is not None:
            copy = scratch_path(self.spark, "index")
            index.groupBy("bucket", "page").agg(F.bitmap_or_agg("bitmap").alias("bitmap")).write.parquet(copy)
            self.spark.read.parquet(copy).write.mode("overwrite").parquet(f"{self.index_path}/pages")

    # ------------------------------------------------------------------ reads and loads

    def rows(self, buckets: Sequence[int] | None = None) -> DataFrame | None:
        """The table, or only some of its buckets (a partition filter)."""
        table = read_existing(self.spark, self.path)
        if table is None or buckets is None:
            return table
        return table.filter(F.col("bucket").isin([int(b) for b in buckets]))

    def _written(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def load(self, incoming: DataFrame, order: Sequence[Column | str] = ("scraped_at",), drop: Sequence[str] = ()) -> Load:
        """Insert-or-ignore ``incoming``: of each key's copies the first in ``order`` goes in, unless the table
        holds the key. Rows with a null key are rejected. The same input again inserts nothing."""
        copies = self._written(incoming.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("copies")), "load_keys")
        null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in self.keys])
        keys = copies.filter(~null_key)
        held = keys.limit(0).select(*self.keys)
        possible = self._written(self.possible(keys.select(*self.keys)), "load_possible")
        buckets = sorted(r.bucket for r in possible.select("bucket").distinct().collect())  # at most self.buckets
        if buckets:
            there = self.rows(buckets)
            if there is not None:
                held = self._written(there.select(*self.keys, "bucket").join(possible, [*self.keys, "bucket"], "left_semi")
                                     .select(*self.keys), "load_held")
        first = first_per_key(incoming.filter(~null_key), self.keys, list(order), keys.filter("copies > 1"))
        new = self._written(first.join(held, self.keys, "left_anti").drop(*drop), "load_stage")
        if self.is_new:
            # written once, so that every later load uses the same numbers
            self.spark.range(1).select(F.lit(self.buckets).alias("buckets"), F.lit(self.pages).alias("pages")) \
                .write.mode("ignore").parquet(f"{self.index_path}/shape")
            self.is_new = False
        figures = copies.agg(
            F.coalesce(F.sum("copies"), F.lit(0)).alias("read"),
            F.coalesce(F.sum(F.when(null_key, F.col("copies"))), F.lit(0)).alias("rejected"),
            F.coalesce(F.sum(F.when(~null_key, F.col("copies") - 1)), F.lit(0)).alias("duplicate"),
            F.count_if(~null_key).alias("distinct_keys")).first()
        inserted = new.count()
        if inserted:
            self._page_rows(new.select(*self.keys)).write.mode("append").parquet(f"{self.index_path}/pages")
            new.withColumn("bucket", self.bucket()).write.mode("append").partitionBy("bucket").parquet(self.path)
        counts = self.spark.createDataFrame(
            [(figures["read"], figures["rejected"], figures["duplicate"], figures["distinct_keys"] - inserted, inserted)],
            "read long, rejected long, duplicate long, already_loaded long, inserted long")
        return Load(new, counts, buckets)
