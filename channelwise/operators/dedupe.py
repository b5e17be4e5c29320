"""Keep-first-per-key and insert-or-ignore loads.

``first_per_key`` first finds the keys that occur more than once (a hash aggregate over the key columns
alone) and writes them to the shared checkpoint folder. Rows of other keys pass through as they are;
only the copies are reduced, with ``min(struct(order..., payload...))``: an ordinary aggregate with
map-side combining, so a key holding a third of all rows costs one row per task, not one task holding
all copies (which a ``row_number()`` window partitioned by the key would). Spark broadcasts the
written keys if they are few, by their measured size.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .scalars import combine_scalars


def _order_fields(order: Sequence[Column | str]) -> list[Column]:
    """Ascending, nulls last: a null sorts after every value (as ``ORDER BY x`` in most SQL engines)."""
    out = []
    for i, o in enumerate(order):
        c = F.col(o) if isinstance(o, str) else o
        out += [c.isNull().alias(f"_o{i}n"), c.alias(f"_o{i}")]
    return out


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                  repeated: DataFrame | None = None) -> DataFrame:
    """One row per ``keys``: the first in ``order`` (ties broken by the remaining columns). ``repeated``: the
    keys that occur more than once, where the caller has counted them."""
    payload = [c for c in df.columns if c not in keys]
    path = scratch_path(df.sparkSession, "repeated_keys")
    counted = repeated
    if counted is None:
        counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    counted.select(*[F.col(k).alias(f"_k_{k}") for k in keys]).write.parquet(path)
    repeated = df.sparkSession.read.parquet(path)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    best = F.min(F.struct(*_order_fields(order), *[F.col(c) for c in payload])).alias("_best")
    picked = df.join(repeated, same, "left_semi").groupBy(*keys).agg(best)
    reduced = picked.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in payload]).select(*df.columns)
    return df.join(repeated, same, "left_anti").unionByName(reduced)


def split_rejects(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with all keys present, rows with a null key + reason)."""
    bad = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    reason = F.concat_ws(",", *[F.when(F.col(k).isNull(), F.lit(f"null {k}")) for k in keys])
    return df.filter(~bad), df.filter(bad).withColumn("reject_reason", reason)


def insert_or_ignore(incoming: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                     existing: DataFrame | None = None) -> DataFrame:
    """Rows to append: first copy per key among valid incoming rows, minus keys already in
    ``existing``. Appending the result and re-running with the same input appends nothing."""
    good, _ = split_rejects(incoming, keys)
    first = first_per_key(good, keys, order)
    if existing is None:
        return first
    return first.join(existing.select(*keys), list(keys), "left_anti")


def load_counts(incoming: DataFrame, keys: Sequence[str], inserted: DataFrame) -> DataFrame:
    """Counts of one load, as one row: read = rejected (null key) + duplicate (further copies of a key
    in this load) + already_loaded (keys that the target held) + inserted."""
    bad = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    good = incoming.filter(~bad)
    counts = combine_scalars({
        "read": incoming.agg(F.count(F.lit(1))),
        "rejected": incoming.agg(F.count_if(bad)),
        "duplicate": good.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(
            F.coalesce(F.sum(F.col("_n") - 1), F.lit(0).cast("bigint"))),
        "inserted": inserted.agg(F.count(F.lit(1))),
    })
    return counts.withColumn("already_loaded", F.col("read") - F.col("rejected") - F.col("duplicate") - F.col("inserted"))
