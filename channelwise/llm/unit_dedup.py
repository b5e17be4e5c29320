"""Substring deduplication by hashed units.

A text is cut into units: its lines, and within a line its sentences (a unit ends behind ``.``, ``!``
or ``?`` and white space), so that a passage is found whether it stands on lines of its own or inside
a paragraph. A unit is normalised (lower case, single spaces, trimmed) and hashed to 128 bits. The
digests are grouped over all documents. The earliest occurrence of a digest (smallest doc_id, then
hash of the text, then smallest offset) is kept; every other one is a repeat, in the same document too. Adjoining
repeats of a document form a passage, and passages of at least ``MIN_CHARS`` characters are removed; the original
character offsets of what goes are kept. A short sentence that two texts share by chance stays, but one
within a longer repeated passage goes with it. A repeated passage that starts or ends inside a sentence loses its whole
sentences only.

Grouping is two aggregations with map-side combining (by digest and document, then by digest; a group is
a few minima and a flag), so a passage that a third of all documents share costs a task one row per map task. Only the digests
that occur again meet the units once more, in a join that Spark may split at a hot digest.

Cases: null and empty texts have no units and stay as they are; rows of one doc_id, or without one, are
documents of their own if their texts differ, ranked by a hash of the text (rows that agree in both can't be
told apart and count as one); a null doc_id ranks last; a text whose every
unit repeats becomes empty; extra columns pass through ``remove_repeats``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batches_by_bytes, materialize, perhaps_among, ship, table, text_or_empty, worker_turn

MIN_CHARS = 40  # of a passage; what is shorter repeats by chance
LAST = (1 << 63) - 1  # ranks a null doc_id behind all others
UNIT = re.compile(r"[^\n]*?[.!?](?=\s)|[^\n]+")
UNITS = "doc long, t long, h1 long, h2 long, at long, size int, words int, k int, again boolean"


def units(text: str) -> list[tuple[str, int, int]]:
    """(normalised unit, start, end) of a text; units without a word are left out."""
    out = []
    for m in UNIT.finditer(text):
        words = m.group().lower().split()
        if words:
            out.append((" ".join(words), m.start(), m.end()))
    return out


def _unit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    worker_turn("units")
    for b in batches_by_bytes(batches, "text"):
        hashes, row, at, size, words, index, again = [], [], [], [], [], [], []
        for r, text in enumerate(b.column("text").to_pylist()):
            seen = set()
            for k, (unit, start, end) in enumerate(units(text)):
                h = xxhash.xxh3_128_digest(unit)
                again.append(h in seen)
                seen.add(h)
                hashes.append(h)
                row.append(r)
                at.append(start)
                size.append(end - start)
                words.append(unit.count(" ") + 1)
                index.append(k)
        h = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
        rows = pa.array(row, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [b.column("doc").take(rows), b.column("t").take(rows), pa.array(h[:, 0]), pa.array(h[:, 1]),
             pa.array(at, pa.int64()), pa.array(size, pa.int32()), pa.array(words, pa.int32()),
             pa.array(index, pa.int32()), pa.array(again, pa.bool_())],
            ["doc", "t", "h1", "h2", "at", "size", "words", "k", "again"])


def _doc():
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))


def repeated_passages(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc, t, start, end, words, first_doc): the passages to remove, as character offsets into the
    original text; ``doc`` is the doc_id (the largest long for null), ``t`` the hash of its text and ``first_doc`` the document
    that holds the earliest occurrence of the passage's first unit."""
    texts = docs.select(_doc().alias("doc"), F.xxhash64("text").alias("t"), text_or_empty().alias("text"))
    found = texts.mapInArrow(_unit_rows, UNITS)
    # in two steps, as the minimum of (doc, t) pairs would be a sorting aggregate
    by_doc = found.groupBy("h1", "h2", "doc").agg(F.min("t").alias("t"), F.max("t").alias("last_t"), F.max("again").alias("within"))
    repeated = (by_doc.groupBy("h1", "h2").agg(F.min("doc").alias("first_doc"), F.max("doc").alias("last_doc"),
                                               F.min_by("t", "doc").alias("first_t"),
                                               F.max(F.expr("within or t != last_t")).alias("within"))
                .filter("first_doc != last_doc or within").select("h1", "h2", "first_doc", "first_t"))
    repeats = (found.join(materialize(repeated, "repeated-units"), ["h1", "h2"])
               .filter("doc != first_doc or t != first_t or again")
               .select("doc", "t", "at", "size", "words", "k", "first_doc").distinct())
    in_doc = Window.partitionBy("doc", "t").orderBy("k")
    runs = repeats.withColumn("run", F.col("k") - F.row_number().over(in_doc))
    return (runs.groupBy("doc", "t", "run")
            .agg(F.min("at").alias("start"), F.max(F.col("at") + F.col("size")).alias("end"),
                 F.sum("words").cast("int").alias("words"), F.min_by("first_doc", "k").alias("first_doc"))
            .filter(F.col("end") - F.col("start") >= min_chars).drop("run"))


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the spans; a line break that only closed a removed line goes with it."""
    out, at = [], 0
    for start, end in sorted(spans):
        out.append(text[at:start])
        at = max(at, end)
        if (start == 0 or text[start - 1] == "\n") and text[at:at + 1] == "\n":
            at += 1
    out.append(text[at:])
    return "".join(out)


def remove_repeats(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` without the repeated passages; ``n_chars``, if there, follows the new text. Texts
    without such a passage are left exactly as they are."""
    spans = materialize(repeated_passages(docs, min_chars), "repeated-passages")
    by_doc = spans.groupBy(F.col("doc").alias("__cut_doc"), F.col("t").alias("__cut_t")).agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias("__cut_spans"))
    by_doc = materialize(by_doc, "passages-by-document")
    keyed = docs.withColumn("__cut_doc", _doc()).withColumn("__cut_t", F.xxhash64("text"))
    split = perhaps_among(keyed, by_doc, ["__cut_doc", "__cut_t"])
    untouched = split.filter("not __perhaps").select(*docs.columns)
    joined = (split.filter("__perhaps").join(by_doc, ["__cut_doc", "__cut_t"], "left")
              .select(*docs.columns, "__cut_spans"))
    names = docs.columns
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_turn("units")
        for b in batches_by_bytes(batches, "text"):
            spans_of = b.column("__cut_spans")
            b = b.select(names)
            if spans_of.null_count < len(spans_of):
                texts = [t if s is None or t is None else cut(t, [(x["start"], x["end"]) for x in s])
                         for t, s in zip(b.column("text").to_pylist(), spans_of.to_pylist())]
                b = b.set_column(names.index("text"), b.schema.field("text"), pa.array(texts, pa.string()))
                if "n_chars" in names:
                    kind = b.schema.field("n_chars")
                    sizes = [n if s is None or t is None else len(t) for n, s, t in
                             zip(b.column("n_chars").to_pylist(), spans_of.to_pylist(), texts)]
                    b = b.set_column(names.index("n_chars"), kind, pa.array(sizes, kind.type))
            yield b

    return untouched.unionByName(joined.mapInArrow(run, schema))


def op10_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """The repeated passages of ``documents``: doc_id, start, end, words, first_doc_id."""
    found = repeated_passages(table(spark, sf_dir, "documents"))
    back = [F.when(F.col(c) != LAST, F.col(c)).alias(to) for c, to in (("doc", "doc_id"), ("first_doc", "first_doc_id"))]
    return found.select(back[0], F.col("start"), F.col("end"), "words", back[1])


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return remove_repeats(docs)
