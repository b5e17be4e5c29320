r"""Mixing sources to target word counts, with DataFrame functions only.

``size_of`` counts the runs of characters other than space and U+0009-U+000D. ``source_targets``
gives each source a weight (3, 1, 2, repeating, by code point of the name, null last) and splits
150 % of all sizes by weight; no target passes twice its source's size and what is cut off is
shared again by weight. That fixed point is ``least(2 * size, weight * level)`` with one common
level: with the sources in order of size/weight, the level is the largest of
``(1.5 * total - 2 * sizes before) / (weights from here on)``.

``mix`` then deals every row a hash-random key, and orders the rows of a source by that key. The
key space is split into equal cells, so a source that holds most rows is spread over all of them;
prefix sums run over the cells of a source (at most ``CELLS`` rows) and over the rows of a cell.
A source repeats whole epochs while its budget allows and cuts the last one at the exact word.

Cases: null text has size 0; null source is a source of its own; rows without a doc_id, or with one doc_id, are
dealt their keys by their texts too; rows equal in doc_id, size and text are interchangeable, so reruns agree; sources
without words get target 0; empty tables give empty results; columns of other names pass through
(``mix`` refuses rows that hold its own result columns).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD_RUN = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
CELLS = 1 << 16


def size_of(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD_RUN)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    The windows below see one row per source, never documents."""
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    fill = Window.orderBy((F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    onward = fill.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (sizes
            .withColumn("weight", F.element_at(weights, (F.row_number().over(by_name) - 1) % len(WEIGHTS) + 1))
            .withColumn("total", F.sum("source_size").over(everything))
            .withColumn("level", (SHARE * F.col("total")
                                  - MOST * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
                        / F.sum("weight").over(onward))
            .withColumn("level", F.max("level").over(everything))
            .select("source", "source_size",
                    F.least((MOST * F.col("source_size")).cast("double"), F.col("weight") * F.col("level"))
                    .alias("target")))


def mix(rows: DataFrame, key: list[Column], seed: str = "mix") -> DataFrame:
    """``rows`` (with ``source`` and ``size``) plus source_size, target and taken (words of this row
    in the mix, repeats counted). ``key``: columns that name a row; their hash deals it to its cell."""
    taken_names = {"source_size", "target", "taken"} & {c.lower() for c in rows.columns}
    if taken_names:
        raise ValueError(f"rows already hold {sorted(taken_names)}")
    hashed = F.md5(F.concat_ws("|", F.lit(seed), *[F.coalesce(k.cast("string"), F.lit("null")) for k in key]))
    keyed = (rows.withColumn("__mix_key", hashed)
             .withColumn("__mix_cell", F.conv(F.substring("__mix_key", 1, 4), 16, 10).cast("int")))
    cells = keyed.groupBy(F.col("source").alias("__mix_source"), F.col("__mix_cell").alias("__mix_c")).agg(
        F.sum("size").alias("__mix_size"))
    in_source = Window.partitionBy("__mix_source").orderBy("__mix_c")
    cells = cells.withColumn("__mix_before", F.sum("__mix_size").over(in_source) - F.col("__mix_size"))
    sources = cells.groupBy(F.col("__mix_source").alias("source")).agg(F.sum("__mix_size").alias("source_size"))
    targets = source_targets(sources).withColumnRenamed("source", "__mix_s")
    cells = (cells.join(targets, F.col("__mix_source").eqNullSafe(F.col("__mix_s")))
             .select("__mix_source", "__mix_c", "__mix_before", "source_size", "target"))
    in_cell = (Window.partitionBy("source", "__mix_cell")
               .orderBy("__mix_key", *key, "size").rowsBetween(Window.unboundedPreceding, -1))
    joined = keyed.join(cells, F.col("source").eqNullSafe(F.col("__mix_source"))
                        & (F.col("__mix_cell") == F.col("__mix_c")))
    budget = F.floor(F.col("target") + 0.5)
    epochs = F.coalesce(F.floor(budget / F.col("source_size")), F.lit(0))
    rest = budget - epochs * F.col("source_size")
    before = F.col("__mix_before") + F.coalesce(F.sum("size").over(in_cell), F.lit(0))
    return (joined.withColumn("__mix_before", before)
            .withColumn("taken", (epochs * F.col("size") + F.greatest(
                F.lit(0), F.least(F.col("size"), rest - F.col("__mix_before")))).cast("long"))
            .select(*[F.col(c) for c in rows.columns], "source_size", "target", "taken"))


def draw(mixed: DataFrame, text: str = "text") -> DataFrame:
    """The rows of the mix: each whole copy of a row, then the partial copy (its first words, with
    the white space between them) of the row at which an epoch is cut. Rows without words have
    nothing to take and don't appear."""
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(0)
    part = F.when(F.col("size") > 0, F.col("taken") % F.col("size")).otherwise(0)
    copies = F.concat(F.array_repeat(F.lit(0), whole.cast("int")),
                      F.when(part > 0, F.array(part.cast("int"))).otherwise(F.array().cast("array<int>")))
    words = F.regexp_extract_all(F.col(text), F.lit(r"[\x20\x09-\x0D]*" + WORD_RUN), F.lit(0))
    cut = F.array_join(F.slice(words, F.lit(1), F.col("__mix_copy")), "")
    out = mixed.withColumn("__mix_copy", F.explode(copies)).withColumn(
        text, F.when(F.col("__mix_copy") == 0, F.col(text)).otherwise(cut))
    return out.drop("__mix_copy")


def op4_mix_sources(spark, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row of ``documents``."""
    from .common import materialize, table
    rows = materialize(table(spark, sf_dir, "documents").select("doc_id", "source", F.md5("text").alias("digest"),
                                                                size_of().alias("size")), "sizes")
    return mix(rows, [F.col("doc_id"), F.col("digest")]).select("doc_id", "size", "source_size", "target", "taken")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the rows of the mix, with the columns of ``docs``."""
    clash = {c: f"__own_{c}" for c in docs.columns if c.lower() in ("size", "source_size", "target", "taken")}
    rows = docs.withColumnsRenamed(clash).withColumn("size", size_of())
    drawn = draw(mix(rows, [F.col("doc_id"), F.xxhash64("text")]))
    if "n_chars" in docs.columns:
        cut = F.length("text").cast(docs.schema["n_chars"].dataType)
        drawn = drawn.withColumn("n_chars", F.when(F.col("n_chars").isNull(), F.col("n_chars")).otherwise(cut))
    return drawn.select(*[F.col(clash.get(c, c)).alias(c) for c in docs.columns])


ORACLE_OP4 = r"""
WITH sized AS (
  SELECT doc_id, source, md5(text) AS digest,
         md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), 'null') || '|' || coalesce(md5(text), 'null')) AS k,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3
              WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight,
         sum(source_size) OVER () AS total FROM src),
levels AS (
  SELECT *, (1.5::DOUBLE * total - 2 * coalesce(sum(source_size) OVER (
               ORDER BY source_size::DOUBLE / weight, source ASC NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY source_size::DOUBLE / weight, source ASC NULLS LAST
               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighted),
targets AS (
  SELECT source, source_size,
         least(CAST(2 * source_size AS DOUBLE), weight * (max(level) OVER ())) AS target FROM levels),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         CAST(floor(t.target + 0.5) AS BIGINT) AS budget,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id, s.digest, s.size
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0
            ELSE (budget // source_size) * size
                 + greatest(0, least(size, budget - (budget // source_size) * source_size - before))
            END AS BIGINT) AS taken
FROM placed
"""
