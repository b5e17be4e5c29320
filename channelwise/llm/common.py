"""Shared helpers of the training-data operators.

Nothing here holds data on the driver: ``materialize`` writes a table below the shared
checkpoint folder and reads it back, which cuts lineage and survives lost executors.
"""

from __future__ import annotations

import ctypes
import gc
import re
import sys
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import TypeVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

T = TypeVar("T")

#: 64-bit odd constants of the usual multiply/xor-shift finalisers (fixed values).
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors as a zip file, once per Spark context, so that workers can
    import the functions they run wherever the driver was started."""
    context = spark.sparkContext
    if getattr(context, "_channelwise_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    out = Path(tempfile.mkdtemp(prefix="channelwise-zip-"), "channelwise.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, Path(package.name, source.relative_to(package)))
    context.addPyFile(str(out))
    context._channelwise_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` wrote, once nothing reads them any more."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t._scratch_path)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def release_shuffles(spark: SparkSession) -> None:
    """Spark deletes a shuffle's files when the driver's JVM has collected the plan that made it, which it can't while
    Python holds on to it. A job of many large steps asks for both between them, so that only the present step's
    files are on disk."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser over an array of uint64."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(30))
        x = x * MIX_1
        x = x ^ (x >> np.uint64(27))
        x = x * MIX_2
        return x ^ (x >> np.uint64(31))


def unit_interval(x: np.ndarray) -> np.ndarray:
    """Hashes as doubles in (0, 1): 53 bits, never 0."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * (1.0 / (1 << 53))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def held_out(doc_id: str = "doc_id") -> Column:
    """The fixed evaluation fold: crc32 of the id as text, modulo 3, is 1 (a null id: never held out)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


#: 64-bit words of the bitmap that ``perhaps_among`` broadcasts: at most so many rows.
BITMAP_WORDS = 1 << 18


def perhaps_among(rows: DataFrame, keys: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` with a column ``__perhaps``: false only if the row's ``columns`` surely don't occur in
    ``keys``. The keys are folded into a bitmap of a fixed number of bits, broadcast as at most
    BITMAP_WORDS rows; with more keys than bits it only lets more rows through. It spares rows with wide
    texts a shuffle towards a join that they have no part in."""
    h = F.xxhash64(*columns)
    word, bit = F.pmod(F.shiftrightunsigned(h, 6), F.lit(BITMAP_WORDS)), h.bitwiseAND(F.lit(63)).cast("int")
    bits = (keys.select(word.alias("__word"), bit.alias("__bit"))
            .groupBy("__word").agg(F.bit_or(F.expr("shiftleft(1L, __bit)")).alias("__bits")))
    hit = F.expr("__bits & shiftleft(1L, __bit)") != 0
    return (rows.withColumn("__word", word).withColumn("__bit", bit)
            .join(F.broadcast(bits), "__word", "left")
            .withColumn("__perhaps", F.coalesce(hit, F.lit(False))).drop("__word", "__bit", "__bits"))


def most_frequent(rows: DataFrame, count: str, bound: int) -> DataFrame:
    """At most ``bound`` of ``rows``, those whose ``count`` (1 or more) is largest, cut between eighths of powers of
    two: a few hundred sizes tell where, and no rows are sorted."""
    step = F.floor(F.log2(count) * 8)
    kept, least = 0, None
    for size in sorted(rows.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect(), reverse=True):
        kept += size.n
        if kept > bound:
            break
        least = size.step
    return rows.limit(0) if least is None else rows.filter(step >= least)


def batches_by_bytes(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20
                     ) -> Iterator[pa.RecordBatch]:
    """Slices of the Arrow batches whose ``column`` holds about ``limit`` bytes (at least one row),
    so that a task's working memory follows the longest text and not the batch length."""
    for b in batches:
        if not b.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(b.column(column)), 0))
        ends = np.cumsum(sizes.astype(np.int64))
        at = 0
        while at < b.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield b.slice(at, to - at)
            at = to


def sampled_labels(labels: DataFrame, value: str, bound: int) -> DataFrame:
    """(doc_id, label, fold) of the labelled rows that may be learned from: those whose crc32
    fold is 0 or 2 and whose label is 0 or 1, thinned by hash to about ``bound`` rows and cut at
    ``bound``, one row per doc_id (the largest label where rows disagree). At most ``bound`` rows,
    so the result may be broadcast."""
    rows = (labels.filter(F.col("doc_id").isNotNull() & F.col(value).isin(0, 1) & ~held_out())
            .groupBy("doc_id").agg(F.max(value).cast("int").alias("label"))
            .withColumn("fold", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3))
    n = rows.count()
    if n > bound:
        keep = int(bound / n * (1 << 20))
        chosen = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 20))
        rows = rows.filter(chosen < keep).orderBy(chosen, "doc_id").limit(bound)  # the same rows however they are laid out
    return rows


def distinct_rows(rows: DataFrame, content: str, bound: int, name: str) -> DataFrame:
    """One of ``rows`` for each doc_id and hash of ``content``; where these are more than ``bound``, those
    whose hash of both is smallest, so that a doc_id of many rows stands for no more than its share."""
    rows = materialize(rows.withColumn("__content", F.xxhash64(content)).dropDuplicates(["doc_id", "__content"]), name)
    if rows.count() > bound:
        keys = ["doc_id", "__content"]
        chosen = rows.select(*keys).orderBy(F.xxhash64(F.lit("sample"), *keys), *keys).limit(bound)
        rows = materialize(rows.join(F.broadcast(chosen), keys), f"{name}-bounded")
    return rows.drop("__content")


_STORE: dict = {}


def worker_store(owner: tuple | str, build: Callable[[], T]) -> T:
    """What ``build`` makes, kept for ``owner`` in this worker process until another owner asks. Workers are
    used again by all stages of an application, so what one operator holds must not outlive its turn."""
    if owner not in _STORE:
        _STORE.clear()
        release_memory()
        _STORE[owner] = build()
    return _STORE[owner]


def worker_turn(owner: str) -> None:
    """Empty the store of what other operators left in this worker process, for an operator that keeps nothing there."""
    worker_store(owner, lambda: None)


def release_memory() -> None:
    """Give back to the machine what this process has freed; Arrow and the C library keep it otherwise."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)):  # not in every C library
        trim(0)


WORD = re.compile(r"[^\W\d_]+")


class Recent(dict):
    """A cache of at most twice ``size`` entries: when it is full, it becomes the old half, and
    entries that are asked for again move over from there."""

    def __init__(self, size: int):
        super().__init__()
        self.size, self.old = size, {}

    def put(self, key, value):
        if len(self) >= self.size:
            self.old.clear()
            self.old.update(self)
            self.clear()
        self[key] = value

    def fetch(self, keys: list, work, longest: int) -> list:
        """The values of ``keys`` in order. ``work`` gets those that aren't held, once each, and returns
        a dict of their values; keys of more than ``longest`` characters aren't kept."""
        held = list(map(self.get, keys))
        if None in held:
            new, lacking = {}, []
            missed = [at for at, v in enumerate(held) if v is None]
            for key in {keys[at] for at in missed}:
                if (value := self.old.get(key)) is None:
                    lacking.append(key)
                else:
                    new[key] = value
            if lacking:
                new.update(work(lacking))
            for at in missed:
                held[at] = new[keys[at]]
            kept = new if max(map(len, new)) <= longest else {k: v for k, v in new.items() if len(k) <= longest}
            if len(self) + len(kept) <= self.size:
                self.update(kept)
            else:
                for key, value in kept.items():
                    self.put(key, value)
        return held
