"""Alignment of two tokenizers' tokens over the same text, by byte ranges.

*Coarse cuts.* A (a byte-level tokenizers file) gives character offsets, B (a sentencepiece model) byte spans.
A place where a token of each ends, and the next one starts at or behind it, is a coarse cut. Offsets and
spans can't tell the tokens of one multibyte character apart (A repeats the character's offsets, B's
byte-fallback tokens but the last have empty spans), so a coarse cut never lies inside a character.

*Refinement.* Between two coarse cuts the tokens are decoded to bytes, and their lengths place every end
exactly, inside characters too. The decoded bytes must be the stretch's bytes; a text where they aren't
has no tokens at all. Ends that A and B share cut a text into groups; each piece of the common refinement
is one link of an A token with a B token.

*Counts.* How often a pair of ids is linked is a Spark aggregation over the links of all texts, which are
written once. The ``BROADCAST_PAIRS`` most frequent pairs are broadcast as sorted arrays of that fixed
size; links of rarer pairs, if there are any, meet their counts in a join.

Texts are cut before single spaces and line feeds between other characters, and before a punctuation mark that
follows a letter: neither tokenizer has a token across (B's vocabulary is searched for one; if it had, texts would go
whole). Results of such units are kept in a worker's cache of bounded size, and units that miss it are encoded
together.

Cases: null and empty texts, and texts that one tokenizer doesn't give back byte for byte, have no tokens
(zeros, empty groups); strings of special tokens are plain text; rows of one doc_id, or without one, are rows of
their own; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe_core import SYMBOL_BYTES
from .common import Recent, batches_by_bytes, materialize, most_frequent, table, text_or_empty, worker_store, worker_turn

BROADCAST_PAIRS = 1 << 21  # 13 bytes each
CACHE_ENTRIES = 1 << 18
LONG_UNIT = 64  # characters; longer units aren't kept
STRETCH = 1 << 15  # characters of units encoded together
MARK = re.compile(r"(?<=[^\W\d_\xb2\xb3\xb9\xbc-\xbe])(?=[.,;:!?])")  # behind a letter, which isn't a number
MARKED = re.compile(r"[.,;:!?](?<=[^\W\d_\xb2\xb3\xb9\xbc-\xbe].)")  # such a mark: marks are looked for first
SEPARATORS = "\0\x1c\x1d\x1e\x1f"
SAFE_CUT = re.compile(rf"(?<=\S)(?=[ \n]\S)|{MARK.pattern}")
JOINABLE = re.compile(r"(?:[ \n]\S|[.,;:!?])(?:.*\S)?", re.DOTALL)  # cuts before and behind such a unit are safe
LINKS = 1 << 18  # links whose counts are looked up together
NOTHING = (0, 0, b"", "")


def even_space(text: str) -> bool:
    """Whether only single white space characters stand in ``text``, none at its ends, and no separators."""
    return len(" ".join(text.split())) == len(text) and not any(c in text for c in SEPARATORS)


def byte_places(text: str) -> np.ndarray:
    """Byte offset of every character of ``text``, and of its end."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
    return np.concatenate([[0], np.cumsum(sizes)])


def cuts(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places of the tokens that surely end a character: their span isn't empty and what follows starts at
    or behind their end."""
    following = np.append(starts[1:], ends[-1:])
    return np.flatnonzero((ends > starts) & (following >= ends))


def _by_length(texts: list[str], size: int) -> Iterator[list[str]]:
    """Runs of texts of about ``size`` characters together."""
    ends = np.cumsum([len(t) for t in texts])
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, side="right")))
        yield texts[at:to]
        at = to


class Aligner:
    """Both tokenizers, the bytes of their ids, and the results of frequent units."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a: dict[int, bytes] = {}
        for token, i in self.a.get_vocab(with_added_tokens=True).items():
            plain = all(c in SYMBOL_BYTES for c in token)
            self.bytes_a[i] = bytes(SYMBOL_BYTES[c] for c in token) if plain else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.size_a = np.array([len(self.bytes_a.get(i, b"")) for i in range(max(self.bytes_a) + 1)])
        self.size_b = np.array([len(x) for x in self.bytes_b])
        # decimal ids with what may follow them: "," within a group, "|" or ";" at its end
        self.inner_a, self.last_a = (np.array([f"{i}{x}" for i in range(len(self.size_a))], object) for x in ",|")
        self.inner_b, self.last_b = (np.array([f"{i}{x}" for i in range(len(pieces))], object) for x in ",;")
        self.cuttable = not any("▁" in p.lstrip("▁") or "\n" in p or MARK.search(p) for p in pieces)
        self.pairs_b = len(pieces)
        self.kind = np.int32 if len(self.size_a) * self.pairs_b < 1 << 31 else np.int64
        self.units = Recent(CACHE_ENTRIES)

    def tokens(self, text: str):
        """(A's ids, exact byte ends, B's ids, exact byte ends) of a text that starts with the space that B
        adds by itself, or None if one of them doesn't give its bytes back."""
        data = text.encode()
        encoding = self.a.encode(text, add_special_tokens=False)
        pieces = self.b.encode(text[1:], return_type="proto").pieces
        of_a, of_b = encoding.ids, [p.id for p in pieces]
        if (not of_a or not of_b or b"".join(map(self.bytes_a.__getitem__, of_a)) != data
                or b"".join(map(self.bytes_b.__getitem__, of_b)) != data):
            return None
        ids_a, ids_b = np.array(of_a), np.array(of_b)
        offsets = np.fromiter(chain.from_iterable(encoding.offsets), np.int64, 2 * len(ids_a)).reshape(-1, 2)
        if not text.isascii():
            offsets = byte_places(text)[offsets]
        # B's spans lie behind the added space, which belongs to the first piece
        start_b, end_b = np.array([p.begin for p in pieces]) + 1, np.array([p.end for p in pieces]) + 1
        start_b[0] = 0
        cut_a, cut_b = cuts(offsets[:, 0], offsets[:, 1]), cuts(start_b, end_b)
        coarse, at_a, at_b = np.intersect1d(offsets[cut_a, 1], end_b[cut_b], assume_unique=True, return_indices=True)
        ends_a = self._refined(self.size_a[ids_a], cut_a[at_a], coarse)
        ends_b = self._refined(self.size_b[ids_b], cut_b[at_b], coarse)
        return ids_a, ends_a, ids_b, ends_b

    @staticmethod
    def _refined(sizes: np.ndarray, last: np.ndarray, coarse: np.ndarray) -> np.ndarray:
        """Ends of the tokens: the coarse cut before, plus the bytes decoded since. ``last`` are the tokens
        that end at the coarse cuts."""
        sums = np.cumsum(sizes)
        segment = np.searchsorted(last, np.arange(len(sizes)), side="left")  # coarse cuts before a token
        before = np.concatenate([[0], sums[last]])[segment]
        return np.concatenate([[0], coarse])[segment] + sums - before

    def align(self, text: str, bounds: list[int]) -> list[tuple] | None:
        """Results of the parts of ``text`` that end at the byte offsets ``bounds``: number of A's tokens, number of
        groups, pair numbers as bytes, groups."""
        found = self.tokens(text)
        if found is None:
            return None
        ids_a, ends_a, ids_b, ends_b = found
        both = np.intersect1d(ends_a, ends_b, assume_unique=True)
        union = np.union1d(ends_a, ends_b)
        pairs = ids_a[np.searchsorted(ends_a, union)] * self.pairs_b + ids_b[np.searchsorted(ends_b, union)]
        pairs, width = pairs.astype(self.kind).tobytes(), np.dtype(self.kind).itemsize
        group_a, group_b = np.searchsorted(both, ends_a), np.searchsorted(both, ends_b)
        texts = np.concatenate([np.where(ends_a == both[group_a], self.last_a[ids_a], self.inner_a[ids_a]),
                                np.where(ends_b == both[group_b], self.last_b[ids_b], self.inner_b[ids_b])])
        groups = texts[np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")].tolist()
        counted = [np.searchsorted(x, bounds, "right") for x in (ends_a, ends_b, both, union)]
        out, last = [], (0, 0, 0, 0)
        for at in zip(*(x.tolist() for x in (counted[0], counted[2], counted[3] * width, counted[0] + counted[1]))):
            out.append((at[0] - last[0], at[1] - last[1], pairs[last[2]:at[2]], "".join(groups[last[3]:at[3]])[:-1]))
            last = at
        return out

    def _work(self, units: list[str]) -> dict[str, tuple]:
        """Results of units: those that start and end in other characters than space are encoded together."""
        out: dict[str, tuple] = {}
        plain, alone = [], []
        for u in units:
            (plain if self.cuttable and JOINABLE.fullmatch(u) else alone).append(u)
        for part in _by_length(plain, STRETCH):
            # " a": B's own space must stand before the first unit, and marks stand behind a letter
            together = [x for k, u in enumerate(part) for x in ((" a", u) if k == 0 or u[0] not in " \n" else (u,))]
            found = self.align("".join(together), np.cumsum([len(x.encode()) for x in together]).tolist())
            if found is None:
                alone += part
            else:
                out.update(zip(together, found))
        for u in alone:
            lead = "" if u[0] == " " else " a"
            found = self.align(lead + u, [len(lead), len(lead) + len(u.encode())])
            out[u] = found[-1] if found else NOTHING
        return out

    def cut(self, text: str) -> list[str]:
        """Units of a text, with the space that comes before it."""
        if not text or not self.cuttable:
            return [" " + text] if text else []
        if not even_space(text):
            return SAFE_CUT.split(" " + text)
        return MARKED.sub("\0\\g<0>", " " + text.replace(" ", "\0 ").replace("\n", "\0\n")).split("\0")

    def results(self, texts: list[str]) -> list[tuple]:
        """(n_a, n_groups, pairs as bytes, groups) of each text; the cache is asked once for all of them."""
        cut = [self.cut(t) for t in texts]
        found = self.units.fetch(list(chain.from_iterable(cut)), self._work, LONG_UNIT)
        out, at = [], 0
        for units in cut:
            n_a, n_groups, pairs, groups = zip(*found[at:at + len(units)]) if units else [(0,)] * 4
            at += len(units)
            out.append(NOTHING if 0 in n_a else (sum(n_a), sum(n_groups), b"".join(pairs), ";".join(groups)))
        return out


def aligner(path_a: str, path_b: str) -> Aligner:
    return worker_store(("aligner", path_a, path_b), lambda: Aligner(path_a, path_b))


def aligned(docs: DataFrame, path_a: str, path_b: str, texts: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, links (array of pair numbers in order: id of A times the size of B plus id of B),
    groups_sha256 for every row of ``docs``; with ``texts`` also ``groups``, the alignment itself (``a1,a2|b1;a3|b2,b3``)."""
    name = "int" if aligner(path_a, path_b).kind is np.int32 else "long"
    schema = f"doc_id long, n_a long, n_b long, n_groups long, links array<{name}>, groups_sha256 string"
    if texts:
        schema += ", groups string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(path_a, path_b)
        for b in batches_by_bytes(batches, "text", 1 << 20):
            rows = both.results(b.column("text").to_pylist())
            links = np.frombuffer(b"".join([r[2] for r in rows]), both.kind)
            sizes = np.array([len(r[2]) for r in rows]) // links.itemsize
            n_a, n_groups = (np.array([r[k] for r in rows], np.int64) for k in (0, 1))
            # every link but one of a group starts a token of A or of B alone
            columns = [b.column("doc_id"), pa.array(n_a), pa.array(sizes + n_groups - n_a), pa.array(n_groups),
                       pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(links)),
                       pa.array([hashlib.sha256(r[3].encode()).hexdigest() if r[0] else "" for r in rows], pa.string())]
            names = ["doc_id", "n_a", "n_b", "n_groups", "links", "groups_sha256"]
            if texts:
                columns.append(pa.array([r[3] for r in rows], pa.string()))
                names.append("groups")
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, schema)


def _few_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about LINKS links, at least one row."""
    for b in batches:
        ends, at = np.asarray(b.column("links").offsets)[1:], 0
        while at < b.num_rows:
            base = ends[at - 1] if at else np.asarray(b.column("links").offsets)[0]
            to = max(at + 1, int(np.searchsorted(ends, base + LINKS, side="right")))
            yield b.slice(at, to - at)
            at = to


def pair_counts(links: DataFrame, size_b: int) -> DataFrame:
    """(pair, n, best): how many links of all texts hold a pair of ids, and whether no pair with the same id of
    B has more."""
    counts = materialize(links.select(F.explode("links").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")),
                         "pair-counts")
    most = counts.groupBy((F.col("pair") % size_b).alias("b")).agg(F.max("n").alias("most"))
    return (counts.withColumn("b", F.col("pair") % size_b).join(most, "b")
            .select("pair", "n", (F.col("n") == F.col("most")).alias("best")))


def with_counts(batches: Iterator[pa.RecordBatch], keys: np.ndarray, counts: np.ndarray, best: np.ndarray
                ) -> Iterator[pa.RecordBatch]:
    """Rows of ``aligned`` with the sums over their links whose pairs are among ``keys`` (sorted), and their other links."""
    worker_turn("pair-counts")  # the tokenizers have done their part
    for b in _few_links(batches):
        lists = b.column("links")
        sizes = np.diff(np.asarray(lists.offsets))
        pair = np.asarray(lists.flatten())
        at = np.minimum(np.searchsorted(keys, pair), max(len(keys) - 1, 0))
        known = keys[at] == pair if len(keys) else np.zeros(len(pair), bool)
        ends = np.cumsum(sizes)

        def per_row(values: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(values)])
            return sums[ends] - sums[ends - sizes]

        n = np.where(known, counts[at], 0) if len(keys) else np.zeros(len(pair), np.int64)
        is_best = np.where(known, best[at], 0) if len(keys) else np.zeros(len(pair), np.int64)
        unknown = per_row(~known).astype(np.int32)
        rest = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(unknown)]).astype(np.int32),
                                        pa.array(pair[~known], lists.type.value_type))
        yield pa.RecordBatch.from_arrays(
            [*(b.column(c) for c in ("row", "doc_id", "n_a", "n_b", "n_groups")), pa.array(sizes.astype(np.int64)),
             pa.array(per_row(is_best).astype(np.int64)), pa.array(per_row(n).astype(np.int64)), rest, b.column("groups_sha256")],
            ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "rest", "groups_sha256"])


def align_documents(docs: DataFrame, path_a: str, path_b: str, bound: int = BROADCAST_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every row of ``docs``."""
    spark = docs.sparkSession
    size_b = aligner(path_a, path_b).pairs_b
    links = materialize(aligned(docs, path_a, path_b).withColumn("row", F.monotonically_increasing_id()), "links")
    pairs = materialize(pair_counts(links, size_b), "pairs")
    whole = pairs.count() <= bound
    frequent = (pairs if whole else most_frequent(pairs, "n", bound)).toArrow()
    order = np.argsort(keys := np.asarray(frequent["pair"]))
    shared = spark.sparkContext.broadcast(
        (keys[order], np.asarray(frequent["n"])[order], np.asarray(frequent["best"])[order].astype(np.int8)))
    element = links.schema["links"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from with_counts(batches, *shared.value)

    found = links.mapInArrow(run, "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
                                  f"count_sum long, rest array<{element}>, groups_sha256 string")
    out = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    if whole:
        return found.select(*out)
    found = materialize(found, "links-frequent")
    rare = (found.select("row", F.explode("rest").alias("pair")).groupBy("row", "pair").agg(F.count("*").alias("times"))
            .join(pairs, "pair").groupBy("row")
            .agg(F.sum(F.col("n") * F.col("times")).alias("more"),
                 F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best")))
    return (found.drop("rest").join(rare, "row", "left")
            .withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0)))
            .withColumn("count_sum", F.col("count_sum") + F.coalesce("more", F.lit(0))).select(*out))


def op12_align_tokenizers(spark, sf_dir: str) -> DataFrame:
    """Alignment figures of every document for byte_bpe_50k.json (A) and piece_bpe_32k.model (B)."""
    from .bpe import tokenizer_path
    return align_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"),
                           tokenizer_path("piece_bpe_32k.model"))
