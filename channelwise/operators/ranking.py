"""Global ``ROW_NUMBER() OVER (ORDER BY ...)`` without a single-partition window.

A window with no PARTITION BY moves every row into one task. Here the rows are range-partitioned on
the order keys (balanced by sampling), sorted within partitions, and written once, below the shared
checkpoint folder, with their partition's number and their place in it. The row counts of the
partitions and the rows themselves are both taken from that table, so they belong to the same
partitioning whatever columns are read, and a retried task can't change them. The only data that
meets in one place is one count per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

_STEP = 1 << 33  # monotonically_increasing_id starts each partition at a multiple of this


def ordered_row_number(df: DataFrame, order: Sequence[Column], out: str = "row_number",
                       num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 1-based position of each row in the total order ``order``.

    ``order`` should be a total order (append unique tie-breaks) for deterministic numbers;
    it also keeps equal leading keys from piling into one range partition. Runs a job: the ordered
    rows are written when the function is called. ``num_partitions`` defaults to the session's
    shuffle partitions.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # an explicit count: AQE must not coalesce, as partition numbers carry the order
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    placed = ranged.withColumn("_pid", F.spark_partition_id()).withColumn(
        "_local", F.monotonically_increasing_id() - F.col("_pid").cast("bigint") * F.lit(_STEP))
    path = scratch_path(spark, "ordered_rows")
    placed.write.parquet(path)
    rows = spark.read.schema(placed.schema).parquet(path)
    counts = rows.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: bounded by ``n``; a window over it is cheap
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_offset"))
    numbered = rows.join(F.broadcast(offsets), "_pid")
    return numbered.withColumn(out, F.col("_offset") + F.col("_local") + 1).drop("_pid", "_local", "_offset")
