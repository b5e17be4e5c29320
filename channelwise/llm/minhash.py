"""Near-duplicates by DartMinHash.

*Signature.* A document is a weighted set of shingles of five words (lower case, split at white
space; fewer than five words make one shingle of all). Every element owns a Poisson process of darts
on the plane of weight and rank, drawn from hashes of the element alone: weight columns [0, 1),
[1, 2), [2, 4), ..., and in each column arrivals along the rank axis. A document throws the darts
that fall below its elements' weights and below a rank at which ``K * (ln K + 2)`` darts are expected
in all, so the work is that number and not elements times coordinates. A dart's hash names its
coordinate and each coordinate keeps its earliest dart; if one has none, the rank is doubled. Two
documents agree in a coordinate with probability equal to their weighted Jaccard similarity. All
weights are 1 by default (the plain similarity of shingle sets); ``weighting="count"`` takes counts.

*Links.* Texts with equal shingle sets are one node. ``BANDS`` bands of ``ROWS`` coordinates name
buckets (a pair at 0.8 shares one with probability 1 - (1 - 0.8**6)**32 > 0.9999). In every bucket of
two or more nodes a leader, drawn by hash and so another one in each band, is compared with each
member: a number of pairs linear in the bucket. Exact similarities of the real shingle sets decide,
and connected components join the links. ``TURNS - 1`` further leaders are compared with the members
that still lie in other components. What then still lies apart (the outsiders of a bucket) is compared
with the whole bucket, dealt out in blocks whose tasks return links alone. No bucket is capped.

Cases: null counts as the empty text; texts without words are near-duplicates of equal texts only;
rows of one doc_id are separate documents; a null doc_id ranks last and its class_id is null if all
its class has none; extra columns pass through ``keep_one``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (GOLDEN, batches_by_bytes, materialize, mix64, perhaps_among, ship, table, text_or_empty, unit_interval,
                     worker_store)
from .components import components

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 6
K = BANDS * ROWS
TURNS = 3  # leaders compared in every bucket before its remaining components are compared in full
BLOCK = 256
LAST = (1 << 63) - 1
CACHE_ENTRIES = 1 << 16
SIGNATURES = "doc long, t long, node long, n int, bands array<long>"


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        self[word] = h
        return h




def shingles(text: str, weighting: str = "binary") -> tuple[np.ndarray, np.ndarray]:
    """(element hashes, sorted and distinct; weights) of a text."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64), np.empty(0)
    hashes = worker_store("minhash", _WordHashes)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(SHINGLE, len(h))
    with np.errstate(over="ignore"):
        s = np.zeros(len(h) - size + 1, np.uint64)
        for i in range(size):
            s = (s + h[i:len(h) - size + 1 + i]) * GOLDEN
        s = mix64(s + np.uint64(size))
    if weighting == "binary":
        s = np.unique(s)
        return s, np.ones(len(s))
    s, counts = np.unique(s, return_counts=True)
    return s, counts.astype(np.float64)


def darts(elements: np.ndarray, weights: np.ndarray, rank: float) -> tuple[np.ndarray, np.ndarray]:
    """(hash, rank) of every dart of the weighted set below ``rank``."""
    hashes, ranks = [], []
    low, high, column = 0.0, 1.0, 0
    while True:
        inside = weights > low
        if not inside.any():
            break
        e, w, width = elements[inside], weights[inside], high - low
        at, first = np.zeros(len(e)), 0
        block = 1 if rank * width < 0.5 else math.ceil(1.2 * rank * width) + 3
        while len(e):
            with np.errstate(over="ignore"):
                j = mix64((np.arange(first, first + block, dtype=np.uint64) + np.uint64(column << 40)) * GOLDEN)
                x = mix64(e[:, None] ^ j)
            arrive = at[:, None] + np.cumsum(-np.log(unit_interval(x)) / width, axis=1)
            hit = arrive < rank
            with np.errstate(over="ignore"):
                name, when = mix64(x[hit] + GOLDEN), arrive[hit]
            if (w < high).any():  # the dart's place on the weight axis
                under = low + width * unit_interval(mix64(name ^ GOLDEN)) < np.broadcast_to(w[:, None], hit.shape)[hit]
                name, when = name[under], when[under]
            hashes.append(name)
            ranks.append(when)
            more = hit[:, -1]
            e, w, at, first = e[more], w[more], arrive[more, -1], first + block
            block = max(block // 4, 1)
        low, high, column = high, 2 * high, column + 1
    return np.concatenate(hashes), np.concatenate(ranks)


def signature(elements: np.ndarray, weights: np.ndarray, k: int = K) -> np.ndarray:
    """The name of the earliest dart of each of ``k`` coordinates; the set must not be empty."""
    rank = k * (math.log(k) + 2) / weights.sum()
    while True:
        names, ranks = darts(elements, weights, rank)
        place = (names % np.uint64(k)).astype(np.int64)
        earliest = np.full(k, np.inf)
        np.minimum.at(earliest, place, ranks)
        if np.isfinite(earliest).all():
            out = np.zeros(k, np.uint64)
            best = ranks == earliest[place]
            out[place[best]] = names[best]
            return out
        rank *= 2


def bands(sig: np.ndarray, n_bands: int = BANDS) -> np.ndarray:
    rows = sig.reshape(n_bands, -1)
    h = mix64((np.arange(n_bands, dtype=np.uint64) + np.uint64(1)) * MIX_BAND)
    for r in range(rows.shape[1]):
        h = mix64(h ^ rows[:, r])
    return h.astype(np.int64)


MIX_BAND = np.uint64(0xD6E8FEB86659FD93)


def set_hash(elements: np.ndarray, text: str) -> int:
    """One node for equal shingle sets; texts without shingles are told apart by the text."""
    data = elements.tobytes() if len(elements) else b"\0" + text.encode()
    return xxhash.xxh3_64_intdigest(data) - (1 << 63)


def _doc():
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(_doc().alias("doc"), F.xxhash64(text_or_empty()).alias("t"), text_or_empty().alias("text"))


def signatures(docs: DataFrame, weighting: str = "binary") -> DataFrame:
    """(doc, t, node, n, bands) for every row of ``docs``; no bands for texts without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches_by_bytes(batches, "text"):
            node, size, keys = [], [], []
            for text in b.column("text").to_pylist():
                e, w = shingles(text, weighting)
                node.append(set_hash(e, text))
                size.append(len(e))
                keys.append(bands(signature(e, w)) if len(e) else np.empty(0, np.int64))
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in keys])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc"), b.column("t"), pa.array(node, pa.int64()), pa.array(size, pa.int32()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(keys)))],
                ["doc", "t", "node", "n", "bands"])

    return _texts(docs).mapInArrow(run, SIGNATURES)


def _shingle_sets(docs: DataFrame, wanted: DataFrame, weighting: str) -> DataFrame:
    """(node, s) of the nodes in ``wanted`` (node, doc, t), from the text of that row: the shingles'
    hashes, ascending, as bytes; behind them the weights as floats if they aren't all 1. 32 bits of
    a hash tell the shingles of two documents apart (two documents of 1,000 shingles share one by
    chance in one of 4,000 pairs, which changes their similarity by a thousandth)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches_by_bytes(batches, "text"):
            sets = [pack(*shingles(t, weighting), weighting) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc"), b.column("t"), pa.array(sets, pa.binary())],
                                             ["doc", "t", "s"])

    texts = perhaps_among(_texts(docs), wanted, ["doc", "t"]).filter("__perhaps").drop("__perhaps")
    # rows that agree in doc_id and text give the same set
    sets = texts.mapInArrow(run, "doc long, t long, s binary").dropDuplicates(["doc", "t"])
    return sets.join(wanted, ["doc", "t"]).select("node", "s")


def pack(elements: np.ndarray, weights: np.ndarray, weighting: str = "binary") -> bytes:
    short = (elements >> np.uint64(32)).astype(np.uint32)
    if weighting == "binary":
        return np.unique(short).tobytes()
    short, at = np.unique(short, return_inverse=True)
    return short.tobytes() + np.bincount(at, weights).astype(np.float32).tobytes()


def unpack(packed, weighting: str = "binary") -> tuple[np.ndarray, np.ndarray | None]:
    if weighting == "binary":
        return np.frombuffer(packed, np.uint32), None
    half = len(packed) // 2
    return np.frombuffer(packed[:half], np.uint32), np.frombuffer(packed[half:], np.float32)


def similarity(a: np.ndarray, b: np.ndarray, wa: np.ndarray | None = None, wb: np.ndarray | None = None) -> float:
    """Jaccard similarity of sorted distinct arrays, weighted if weights are given."""
    if wa is None:
        both = len(np.intersect1d(a, b, assume_unique=True))
        return both / (len(a) + len(b) - both) if len(a) + len(b) else 1.0
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    low = np.minimum(wa[i], wb[j]).sum()
    return float(low / (wa.sum() + wb.sum() - low))


class Block:
    """Sets side by side, by element, so that one more set is compared with all of them at once."""

    def __init__(self, sets: list):
        elements = np.concatenate([e for e, _ in sets])
        order = np.argsort(elements, kind="stable")
        self.elements = elements[order]
        self.owners = np.repeat(np.arange(len(sets)), [len(e) for e, _ in sets])[order]
        weights = [np.ones(len(e), np.float32) if w is None else w for e, w in sets]
        self.weights = np.concatenate(weights)[order]
        self.sizes = np.array([w.sum(dtype=np.float64) for w in weights])

    def similarities(self, elements: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        weights = np.ones(len(elements), np.float32) if weights is None else weights
        first = np.searchsorted(self.elements, elements, "left")
        count = np.searchsorted(self.elements, elements, "right") - first
        at = np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        both = np.bincount(self.owners[at], np.minimum(self.weights[at], np.repeat(weights, count)), len(self.sizes))
        return both / (self.sizes + weights.sum(dtype=np.float64) - both)


def _links(pairs: DataFrame, sets: DataFrame, threshold: float, weighting: str) -> DataFrame:
    """The pairs (a, b) of nodes whose similarity reaches the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column("sa"), b.column("sb")):
                (ea, wa), (eb, wb) = unpack(x.as_buffer(), weighting), unpack(y.as_buffer(), weighting)
                keep.append(similarity(ea, eb, wa, wb) >= threshold)
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = sets.select(F.col("node").alias("a"), F.col("s").alias("sa"))
    two = sets.select(F.col("node").alias("b"), F.col("s").alias("sb"))
    pairs = materialize(pairs, "pairs")  # written, so that a few pairs are broadcast instead of all sets shuffled
    found = pairs.join(two, "b").join(one, "a").select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")
    return materialize(found, "links")


def _hidden_links(placed: DataFrame, sets: DataFrame, keys: DataFrame, threshold: float, weighting: str) -> DataFrame:
    """Links between members of one bucket that lie in different components, all of them compared.

    The bucket's largest component is dealt out in blocks of about ``BLOCK`` rows; its other members
    (the outsiders) go to every block, where a task compares arrays and returns links alone. A pair
    is compared in the first bucket that it shares."""

    def compare(members: pa.Table, asked: pa.Table) -> pa.Table:
        out = []
        if members.num_rows and asked.num_rows:
            bucket = asked.column("bucket")[0].as_py()
            block = Block([unpack(x.as_buffer(), weighting) for x in members.column("s")])
            node, root = (np.asarray(members.column(c)) for c in ("node", "root"))
            outside, keys = np.asarray(members.column("outside")), np.array(members.column("bands").to_pylist())
            for x in asked.to_pylist():
                own = np.array(x["bands"])
                todo = (root != x["root"]) & ~(outside & (node <= x["node"]))
                todo &= own[(keys == own).argmax(axis=1)] == bucket
                if todo.any():
                    near = todo & (block.similarities(*unpack(x["s"], weighting)) >= threshold)
                    out += [(min(x["node"], y), max(x["node"], y)) for y in node[near].tolist()]
        return pa.table([pa.array([r[i] for r in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    by_root = placed.groupBy("bucket", "root").agg(F.count("*").alias("c"))
    by_bucket = (by_root.groupBy("bucket").agg(F.count("*").alias("roots"), F.sum("c").alias("c"),
                                               F.max_by("root", F.struct("c", "root")).alias("main"))
                 .filter("roots > 1").select(
                     "bucket", "main", F.ceil(F.col("c") / BLOCK).cast("int").alias("blocks")))
    rows = (placed.join(materialize(by_bucket, "mixed-buckets"), "bucket").withColumn("outside", F.col("root") != F.col("main"))
            .select("bucket", "node", "root", "outside", "blocks"))
    rows = materialize(rows, "mixed-members").join(sets, "node").join(keys, "node")
    members = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    asked = rows.filter("outside").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    asked = asked.select(*[F.col(c).alias(c) for c in asked.columns])  # both sides come of the same rows
    return (members.groupBy("bucket", "block").cogroup(asked.groupBy("bucket", "block"))
            .applyInArrow(compare, "a long, b long").distinct())


def _pairs(rows: DataFrame, one: str, two: str) -> DataFrame:
    return rows.select(F.least(one, two).alias("a"), F.greatest(one, two).alias("b")).distinct()


def near_duplicates(docs: DataFrame, threshold: float = SIMILARITY, weighting: str = "binary") -> DataFrame:
    """(doc, t, root, class, size) for every row of ``docs``: root names its group, whose smallest doc is
    ``class`` (groups of rows that share a doc_id may share that)."""
    sig = materialize(signatures(docs, weighting), "signatures")
    nodes = sig.filter("n > 0").select("node", "bands").dropDuplicates(["node"])
    rows = materialize(nodes.select("node", F.explode("bands").alias("bucket")), "bands")
    lead = (rows.groupBy("bucket").agg(F.min(F.expr("node ^ bucket")).alias("m"), F.count("*").alias("c"))
            .filter("c > 1").select("bucket", "c", F.expr("m ^ bucket").alias("leader")))
    members = materialize(rows.join(lead, "bucket").select("bucket", "c", "leader", "node"), "members")
    wanted = (sig.join(members.select("node").distinct(), "node", "left_semi")
              .groupBy("node").agg(F.min(F.struct("doc", "t")).alias("r")).select("node", "r.doc", "r.t"))
    sets = materialize(_shingle_sets(docs, materialize(wanted, "candidates"), weighting), "shingle-sets")
    links = _links(_pairs(members.filter("node != leader"), "leader", "node"), sets, threshold, weighting)
    roots = _roots(members, links)
    # buckets of two are settled; larger ones get further leaders for what still lies apart
    larger = members.filter("c > 2").select("bucket", "node")
    for turn in range(1, TURNS):
        placed = materialize(larger.join(roots, "node"), "placed")
        salt = F.xxhash64("bucket", F.lit(turn))
        lead = (placed.withColumn("key", F.col("node").bitwiseXOR(salt)).groupBy("bucket")
                .agg(F.min("key").alias("key"), F.min("root").alias("x"), F.max("root").alias("y")).filter("x != y")
                .select("bucket", F.col("key").bitwiseXOR(salt).alias("leader")))
        of = roots.select(F.col("node").alias("leader"), F.col("root").alias("leader_root"))
        larger = materialize(placed.join(lead, "bucket").join(of, "leader"), "mixed")
        links = links.union(_links(_pairs(larger.filter("root != leader_root"), "leader", "node"), sets, threshold, weighting))
        larger = larger.select("bucket", "node")
        roots = _roots(members, links)
    hidden = materialize(_hidden_links(larger.join(roots, "node"), sets, nodes, threshold, weighting), "hidden-links")
    if not hidden.isEmpty():
        roots = _roots(members, links.union(hidden))
    by_node = (sig.groupBy("node").agg(F.min("doc").alias("doc"), F.count("*").alias("size"))
               .join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    classes = by_node.groupBy("root").agg(F.min("doc").alias("class"), F.sum("size").alias("size"))
    of_node = materialize(by_node.select("node", "root").join(classes, "root"), "classes")
    return sig.select("doc", "t", "node").join(of_node, "node").select("doc", "t", "root", "class", "size")


def _roots(members: DataFrame, links: DataFrame) -> DataFrame:
    found = components(links)
    return materialize(members.select("node").distinct().join(found, "node", "left")
                       .select("node", F.coalesce("root", "node").alias("root")), "roots")


def op1_minhash_dedup(spark, sf_dir: str) -> DataFrame:
    """doc_id, class_id (the smallest doc_id of its near-duplicates) and class_size of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.when(F.col("doc") != LAST, F.col("doc")).alias("doc_id"),
                        F.when(F.col("class") != LAST, F.col("class")).alias("class_id"),
                        F.col("size").alias("class_size"))


def keep_one(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """One row of each near-duplicate class: that of the smallest doc_id (then of the smallest text
    hash, then any of rows that agree in both), with all its columns."""
    found = materialize(near_duplicates(docs, threshold), "near-duplicates")
    kept = materialize(found.filter("doc = class").groupBy("root").agg(F.min("t").alias("t"), F.count("*").alias("c")),
                       "kept")
    gone = found.join(kept.select("root", F.col("t").alias("kept_t")), "root").filter(
        "doc != class or t != kept_t").select(F.col("doc").alias("__gone_doc"), F.col("t").alias("__gone_t")).distinct()
    keyed = docs.withColumn("__doc", _doc()).withColumn("__t", F.xxhash64(text_or_empty()))
    gone = materialize(gone, "gone")
    split = perhaps_among(keyed, gone.select(F.col("__gone_doc").alias("__doc"), F.col("__gone_t").alias("__t")),
                          ["__doc", "__t"])
    out = split.filter("not __perhaps").unionByName(split.filter("__perhaps").join(
        gone, (F.col("__doc") == F.col("__gone_doc")) & (F.col("__t") == F.col("__gone_t")), "left_anti"))
    out = out.drop("__perhaps")
    if not kept.filter("c > 1").isEmpty():  # some kept row was delivered more than once
        out = out.dropDuplicates(["__doc", "__t"])
    return out.drop("__doc", "__t")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return keep_one(docs)
