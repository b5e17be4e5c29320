"""Data-quality checks as DataFrames (Q1-Q13).

Row-level checks on one table are fused into a single aggregation (one ``count_if`` per check, one
scan). Where a table also has foreign keys, the same aggregation is taken by its key columns
(``profile``), so that referential checks read groups instead of the table again. Every check yields
rows (test_name, result) where ``result`` is the number of violating rows (or, for uniqueness,
violating values), 0 = pass. A check that can't be evaluated (a column is missing or has an unfit
type) yields a null result, which counts as a failure; the other checks still run.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RowCheck:
    name: str
    violation: Column  # True on a violating row


def not_null(name: str, col: str) -> RowCheck:
    return RowCheck(name, F.col(col).isNull())


def accepted_values(name: str, col: str, values: Sequence) -> RowCheck:
    # a null value passes, as in the schema-test convention
    return RowCheck(name, ~F.col(col).isin(list(values)))


def not_negative(name: str, col: str) -> RowCheck:
    return RowCheck(name, F.col(col) < 0)


def expression(name: str, violation: Column) -> RowCheck:
    return RowCheck(name, violation)


def _usable(df: DataFrame, checks: Sequence[RowCheck]) -> list[RowCheck]:
    def works(c: RowCheck) -> bool:
        try:
            return df.select(c.violation).schema.fields[0].dataType.typeName() == "boolean"
        except AnalysisException:
            return False

    return [c for c in checks if works(c)]


def profile(df: DataFrame, keys: Sequence[str], checks: Sequence[RowCheck]) -> DataFrame:
    """One row per combination of ``keys`` (none: one row in all): ``rows`` and, by position, how many
    rows violate each usable check (``_c0`` ...). One pass over the table."""
    counts = [F.count_if(c.violation).alias(f"_c{i}") for i, c in enumerate(_usable(df, checks))]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), *counts)


def profile_results(df: DataFrame, profiled: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    """Rows (test_name, result) of the checks behind ``profile``; unusable ones have a null result."""
    usable = _usable(df, checks)
    agg = profiled.agg(*[F.coalesce(F.sum(f"_c{i}"), F.lit(0)).alias(f"_c{i}") for i in range(len(usable))],
                       F.lit(1).alias("_one"))
    pairs = [F.struct(F.lit(c.name).alias("test_name"), F.col(f"_c{i}").cast("bigint").alias("result"))
             for i, c in enumerate(usable)]
    names = {c.name for c in usable}
    pairs += [F.struct(F.lit(c.name).alias("test_name"), F.lit(None).cast("bigint").alias("result"))
              for c in checks if c.name not in names]
    return agg.select(F.inline(F.array(*pairs)))


def row_checks(df: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    """All row-level checks of one table in one pass -> rows (test_name, result)."""
    return profile_results(df, profile(df, [], checks), checks)


def guarded(spark: SparkSession, name: str, check) -> DataFrame:
    """The result of ``check()``, or a null result under ``name`` if it can't be planned."""
    try:
        return check()
    except AnalysisException:
        return spark.range(1).select(F.lit(name).alias("test_name"), F.lit(None).cast("bigint").alias("result"))


def unique(name: str, df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Number of key values that occur more than once (nulls are ignored)."""
    keyed = df.select(*cols).filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))
    dup = keyed.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    return dup.agg(F.count(F.lit(1)).cast("bigint").alias("result")).select(F.lit(name).alias("test_name"), "result")


def relationships(name: str, child: DataFrame, fk: str, parent: DataFrame, pk: str,
                  null_passes: bool = True) -> DataFrame:
    """Child rows whose foreign key has no parent row. With ``null_passes`` a null key is not a
    violation (schema-test convention); without it, it is (LEFT JOIN ... IS NULL). ``child`` may be a
    profile: its ``rows`` are counted then, otherwise the child is reduced to one row per key first."""
    grouped = child.groupBy(F.col(fk).alias("_fk")).agg(
        (F.sum("rows") if "rows" in child.columns else F.count(F.lit(1))).alias("_n"))
    if null_passes:
        grouped = grouped.filter(F.col("_fk").isNotNull())
    orphans = grouped.join(parent.select(F.col(pk).alias("_fk")), "_fk", "left_anti")
    return orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("result")).select(
        F.lit(name).alias("test_name"), "result")


def violations(df: DataFrame, check: RowCheck, cols: Sequence[str], limit: int | None = None) -> DataFrame:
    """The failing rows of a check (Q13); ``limit`` gives a sample, as a dev run does."""
    out = df.filter(check.violation).select(*cols)
    return out.limit(limit) if limit else out


def with_status(results: DataFrame) -> DataFrame:
    return results.select("test_name", F.when(F.col("result") == 0, "PASS").otherwise("FAIL").alias("status"),
                          "result")


def all_passed(results: DataFrame) -> bool:
    """Driver-side verdict from the (small) results table."""
    row = results.agg(F.count_if(~F.col("result").eqNullSafe(0)).alias("failed")).first()
    return row is not None and row["failed"] == 0
