"""Combine one-row aggregates into one row without a cartesian product."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def combine_scalars(parts: dict[str, DataFrame]) -> DataFrame:
    """``{name: one-row one-column aggregate}`` -> one row with a bigint column per name.

    The scalars are unioned as (name, value) rows and folded by one global aggregation.
    """
    rows = reduce(DataFrame.unionByName,
                  [df.select(F.lit(k).alias("_k"), F.col(df.columns[0]).cast("bigint").alias("_v"))
                   for k, df in parts.items()])
    return rows.agg(*[F.max(F.when(F.col("_k") == k, F.col("_v"))).alias(k) for k in parts])
