"""Document fingerprints from closed syncmers.

A k-mer of ``K`` characters is an anchor if the smallest of its inner substrings of ``S`` characters
(by hash) stands at its first or last place. That depends on the k-mer alone, so an edit elsewhere
never moves an anchor, and equal passages have equal anchors whatever surrounds them: ``anchors``
gives their places for positional matching. The fingerprint is the bottom-``SIZE`` sketch of the
anchors' hashes (8 hex digits each, ascending), whose likeness estimates the Jaccard similarity of
the anchor sets; texts with fewer anchors are compared exactly.

``fingerprints`` also compares a document with an edited copy (its last third replaced by the start
of the next document, in descending doc_id order) and with that next document. The documents are
range-partitioned and sorted by doc_id once; a task sees each document's successor pass by, and only
the first and last document of a partition meet across tasks, through a small table of edges.

Cases: null counts as the empty text, which has the empty fingerprint (like itself, unlike all
others); texts shorter than ``K`` are one anchor; texts of ``K`` or more characters without an anchor
take their smallest k-mer; rows of one doc_id are ordered by a hash of their text, a null doc_id comes
last; a single document is its own next one; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_by_bytes, materialize, mix64, table, text_or_empty

S = 10
K = 2 * S
SIZE = 64
CHUNK = 1 << 18  # characters hashed at once
BASE = np.uint64(0x100000001B3)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(BASE), n, 1 << 64))


B1, B2, B8, BS = BASE, _power(2), _power(8), _power(S)


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _polynomials(c: np.ndarray) -> np.ndarray:
    """Hash of the S = 8 + 2 characters from each place on."""
    with np.errstate(over="ignore"):
        one = c.astype(np.uint64) + np.uint64(1)
        two = one[:-1] * B1 + one[1:]
        four = two[:-2] * B2 + two[2:]
        eight = four[:-4] * (B2 * B2) + four[4:]
        return eight[:-2] * B2 + two[8:]


def _chunk_syncmers(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    poly = _polynomials(c)
    h = mix64(poly)
    width = K - S + 1  # 11 inner substrings
    low2 = np.minimum(h[:-1], h[1:])
    low4 = np.minimum(low2[:-2], low2[2:])
    low8 = np.minimum(low4[:-4], low4[4:])
    low = np.minimum(low8[:len(h) - width + 1], low8[3:])
    at = np.flatnonzero((h[:len(low)] == low) | (h[width - 1:] == low))
    with np.errstate(over="ignore"):
        return at, mix64(poly[at] * BS + poly[at + S])


def syncmers(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the anchors of an array of code points, in chunks that overlap by K - 1."""
    n = len(c)
    if n < K:
        if not n:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        h = np.uint64(n)
        for x in c:
            h = mix64(np.atleast_1d(h ^ np.uint64(x)))[0]
        return np.zeros(1, np.int64), np.atleast_1d(h)
    places, hashes = [], []
    for start in range(0, n - K + 1, CHUNK):
        at, h = _chunk_syncmers(c[start:start + CHUNK + K - 1])
        places.append(at + start)
        hashes.append(h)
    return np.concatenate(places), np.concatenate(hashes)


def _sketch(c: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    if not len(hashes) and len(c) >= K:
        poly = _polynomials(c)
        with np.errstate(over="ignore"):
            hashes = mix64(poly[:len(c) - K + 1] * BS + poly[S:]).min(keepdims=True)
    if len(hashes) > 4 * SIZE:
        distinct = np.unique(np.partition(hashes, 2 * SIZE)[:2 * SIZE])
        if len(distinct) >= SIZE:
            return np.unique(distinct[:SIZE] >> np.uint64(32))
    return np.unique(np.unique(hashes)[:SIZE] >> np.uint64(32))


def packed(sketch: np.ndarray) -> bytes:
    """A sketch as bytes, four for each hash; the fingerprint is their hexadecimal text."""
    return sketch.astype(">u4").tobytes()


def likeness(a: bytes | str, b: bytes | str) -> float:
    """Estimated Jaccard similarity of the anchor sets behind two fingerprints."""
    x, y = (set(np.frombuffer(bytes.fromhex(s) if isinstance(s, str) else s, ">u4").tolist()) for s in (a, b))
    if not x and not y:
        return 1.0
    union = sorted(x | y)
    if len(x) >= SIZE or len(y) >= SIZE:
        union = union[:SIZE]
    return sum(h in x and h in y for h in union) / len(union)


class Document:
    """A text with its anchors and fingerprint."""

    def __init__(self, text: str):
        self.text, self.codes = text, codes(text)
        self.places, self.hashes = syncmers(self.codes)
        self.fingerprint = packed(_sketch(self.codes, self.hashes))

    def edited(self, following: "Document") -> tuple[bytes, bytes]:
        """(sha256, fingerprint) of this text with its last third replaced by the other's start; the
        anchors before the edit are this text's own."""
        n = len(self.codes)
        third = n // 3
        keep = n - third
        text = self.text[:keep] + following.text[:third]
        sha = hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()
        if text == self.text:
            return sha, self.fingerprint
        joined = np.concatenate([self.codes[:keep], following.codes[:third]])
        if keep < K or len(joined) < K:
            hashes = syncmers(joined)[1]
        else:
            hashes = self.hashes[self.places <= keep - K]
            if len(joined) > keep:
                hashes = np.concatenate([hashes, syncmers(joined[keep - K + 1:])[1]])
        return sha, packed(_sketch(joined, hashes))


COLUMNS = ("doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, "
           "near_edited double, near_next double")
FIELDS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _row(doc_id, doc: Document, following: Document) -> tuple:
    sha, fingerprint = doc.edited(following)
    return (doc_id, len(doc.codes), sha, doc.fingerprint, fingerprint,
            likeness(doc.fingerprint, fingerprint), likeness(doc.fingerprint, following.fingerprint))


def _record(rows: list[tuple], extra: list[tuple]) -> pa.RecordBatch:
    """Finished rows (edge null) and edges (edge "head" or "tail", with part and text)."""
    done = [*rows, *[(e[0], None, None, None, None, None, None) for e in extra]]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]
    arrays = [pa.array([r[i] for r in done], k) for i, k in enumerate(kinds)]
    none = [None] * len(rows)
    arrays += [pa.array([*none, *[e[1] for e in extra]], pa.string()), pa.array([*none, *[e[2] for e in extra]], pa.int32()),
               pa.array([*none, *[e[3] for e in extra]], pa.string())]
    return pa.RecordBatch.from_arrays(arrays, [*FIELDS, "edge", "part", "text"])


def _follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one sorted partition, each with its successor; the ends go out as edges."""
    part = TaskContext.get().partitionId()
    last = None
    for b in batches_by_bytes(batches, "text"):
        rows, edges = [], []
        for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
            doc = Document(text)
            if last is None:
                edges.append((doc_id, "head", part, text))
            else:
                rows.append(_row(*last, doc))
            last = (doc_id, doc)
        yield _record(rows, edges)
    if last is not None:
        yield _record([], [(last[0], "tail", part, last[1].text)])


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches_by_bytes(batches, "text"):
        rows = [_row(d, Document(t), Document(f)) for d, t, f in zip(
            b.column("doc_id").to_pylist(), b.column("text").to_pylist(), b.column("following").to_pylist())]
        yield _record(rows, []).select(FIELDS)


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: FIELDS, with hashes and fingerprints as lower-case hexadecimal text."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"),
                       F.xxhash64("text").alias("h"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("h")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    found = materialize(ordered.mapInArrow(_follow, COLUMNS + ", edge string, part int, text string"), "followed")
    heads = found.filter("edge = 'head'").select(F.col("part").alias("next"), F.col("text").alias("following"))
    tails = found.filter("edge = 'tail'").select("doc_id", "part", "text")
    # one number for each partition that has rows: each is followed by the next, the last by the first
    used = sorted(r.part for r in tails.select("part").collect())
    follows = spark.createDataFrame(list(zip(used, used[1:] + used[:1])), "part int, next int")
    closed = tails.join(follows, "part").join(heads, "next").select("doc_id", "text", "following")
    rows = found.filter("edge is null").select(*FIELDS).unionByName(closed.mapInArrow(_close, COLUMNS))
    return rows.withColumns({c: F.lower(F.hex(c)) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")})


def anchors(docs: DataFrame) -> DataFrame:
    """(doc_id, places array<long>, hashes array<long>): the anchors of every text, by place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches_by_bytes(batches, "text"):
            found = [syncmers(codes(t)) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([x[0] for x in found], pa.list_(pa.int64())),
                 pa.array([x[1].view(np.int64) for x in found], pa.list_(pa.int64()))], ["doc_id", "places", "hashes"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, places array<long>, hashes array<long>")


def op5_syncmer_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of every document, its edited copy and its neighbour."""
    return fingerprints(table(spark, sf_dir, "documents"))
