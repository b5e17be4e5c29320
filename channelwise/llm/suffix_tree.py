"""Language-model scoring with a probabilistic suffix tree over words.

*Tokens.* A-Z are lower-cased; words are runs of characters other than space and U+0009-U+000D, and an end token
closes every text. Words are 64-bit hashes, contexts hashes of their words.

*Tree.* The root predicts a token by its count, plus one. A context of up to ``DEPTH`` words is a candidate if it
occurs ``MIN_COUNT`` times. With N occurrences, T distinct next tokens and k occurrences of next token w its
distribution is ``((k - 1) + T * P(w | parent)) / N``: each distinct token gives one occurrence to the parent,
which is the longest retained context behind its first words. A candidate is retained by a divergence test: the
log-likelihood of its own occurrences, each predicted without itself, must beat the parent's by ``MIN_GAIN`` nats.
Levels are learned one after the other, each in a pass over all training texts whose counts are summed
in the tasks before the shuffle. A next token seen once adds nothing to its context but what N and the others
tell, so only pairs seen twice are kept.

*Scoring* takes the longest retained context of each token. In logarithms that is a sum over independent keys:
the root's value of the token, for every retained context the weight it leaves to its parent, and for
every kept pair what it gains over that. A context and its next token are themselves the context of what follows, and
behind every word there is a token; so what the words of a pair gain and what they leave as a context have one key and one
sum. So a text is a bag of its runs of 1 to ``DEPTH`` + 1 tokens, and the model is one table (key, value) that grows
with the corpus. ``TABLE_KEYS`` frequent keys are broadcast as sorted arrays, with a bitmap of ``BITMAP_WORDS`` words over
all keys, both of fixed size; what they leave open meets the table by ranges of the
keys. A larger model only leaves more to that. Each of ``SLICES`` slices of the keys is looked up on its own, so that only one
slice's shuffles are on disk. Counts, open keys and answers go through shuffles as arrays, one row for each range and block.

Cases: null and empty texts are the end token alone; a null doc_id is never held out; rows of one doc_id are rows
of their own; without training texts base_score is 0 for every token; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import (GOLDEN, MIX_1, batches_by_bytes, discard, materialize, mix64, most_frequent, release_shuffles, table,
                     text_or_empty, worker_store)

DEPTH = 2
MIN_COUNT = 16
MIN_GAIN = 10.0
TABLE_KEYS = 1 << 20  # 16 bytes each
BITMAP_WORDS = 1 << 22  # of 64 bits, for scoring
LEARNING_WORDS = 1 << 18  # the same, for learning
FLUSH = 1 << 21  # tokens whose counts a task sums up before it passes them on, or keys that it asks for at once
BUCKET = 1 << 20  # tokens of the training texts for each bucket of a shuffle
SLICES = 4  # of the keys, whose joins with the model run one after the other
PART = 1 << 19  # bytes of text that are hashed at once, or one text
FOLD = 7


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLD == 2, F.lit(False))


def prepared(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, text of every row."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), text_or_empty().alias("text"))


# --- keys: unsigned 64-bit numbers in numpy, signed ones in tables -------------------------------------------------


#: A value for each byte (A-Z count as a-z), and the hash of the end token.
BYTE_VALUES = mix64(np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint64) * GOLDEN + MIX_1)
END = np.uint64(0x5DEECE66D5DEECE6)
END_VALUE = int(END.astype(np.int64))
HIGH = np.uint64(0xFFFFFFFF00000000)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of MIX_1 and of its inverse, modulo 2 ** 64."""
    held = worker_store("lm-powers", lambda: [np.ones(1, np.uint64)] * 2)
    if len(held[0]) < n:
        held[:] = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, x, np.uint64)]), dtype=np.uint64)
                   for x in (MIX_1, np.uint64(pow(int(MIX_1), -1, 1 << 64)))]
    return held[0][:n], held[1][:n]


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of all tokens, place of each in its text, tokens of each text) of an Arrow string column: polynomial
    hashes of the words, all at once, by differences of one running sum over the bytes."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    size = int(offsets[-1] - offsets[0])
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]] if size else np.zeros(0, np.uint8)
    starts = offsets - offsets[0]
    gap = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.zeros(size + 1, bool)  # a text starts here
    edge[starts] = True
    before, behind = np.concatenate([[True], gap]), np.concatenate([gap, [True]])
    first = np.flatnonzero(~gap & (before[:-1] | edge[:-1]))
    last = np.flatnonzero(~gap & (behind[1:] | edge[1:])) + 1
    power, inverse = _powers(size)
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTE_VALUES[data] * power, dtype=np.uint64)])
        words = mix64((sums[last] - sums[first]) * inverse[first] + (last - first).astype(np.uint64) * GOLDEN)
    text = np.searchsorted(starts, first, side="right") - 1
    text = np.minimum(text, len(texts) - 1)
    sizes = np.bincount(text, minlength=len(texts)) + 1
    ends = np.cumsum(sizes)
    out = np.full(int(ends[-1]), END)
    out[np.arange(len(words)) + text] = words
    return out, np.arange(len(out)) - np.repeat(ends - sizes, sizes), sizes


def pair_key(context: np.ndarray, token: np.ndarray) -> np.ndarray:
    """The key of a context and the token behind it, which together are the context of what follows."""
    with np.errstate(over="ignore"):
        return mix64(context * MIX_1 + token)


def contexts(tokens: np.ndarray, place: np.ndarray, depth: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(context, whether there is one) before every token, for 1 to ``depth`` words. ``place``: of a token in its text."""
    out, last = [], np.zeros(len(tokens), np.uint64)
    for d in range(1, depth + 1):
        behind = pair_key(last, tokens)
        last = np.concatenate([behind[:1], behind[:-1]])
        out.append((last, place >= d))
    return out


def runs(tokens: np.ndarray, place: np.ndarray, depth: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(key, whether there is one) of the 1 to ``depth`` + 1 tokens that end at every token."""
    before = [(np.zeros(len(tokens), np.uint64), place >= 0), *contexts(tokens, place, depth)]
    return [(pair_key(context, tokens), there) for context, there in before]


@dataclass
class Bitmap:
    """A set of keys that may hold more than it was given, of ``len(words) * 64`` bits."""

    words: np.ndarray

    def holds(self, keys: np.ndarray) -> np.ndarray:
        n, at = len(self.words), keys >> np.uint64(6)
        at = at % np.uint64(n) if n & n - 1 else at & np.uint64(n - 1)  # a division takes longer
        return (self.words[at] >> (keys & np.uint64(63))) & np.uint64(1) == 1


class Lookup:
    """Places of uniformly spread keys: sorted, with the first place of every leading bit pattern."""

    def __init__(self, keys: np.ndarray, *values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], [v[order] for v in values]
        bits = max(1, int(len(keys)).bit_length() + 1)
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(self.keys, np.arange(1 << bits, dtype=np.uint64) << self.shift)
        self.first = np.append(self.first, len(keys)).astype(np.int32)

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of ``wanted`` there are, their places)."""
        place = np.full(len(wanted), -1, np.int32)
        lead = (wanted >> self.shift).astype(np.int64)
        at, end, who = self.first[lead], self.first[lead + 1], np.arange(len(wanted))
        while True:
            left = at < end
            at, end, who = at[left], end[left], who[left]
            if not len(who):
                found = np.flatnonzero(place >= 0)
                return found, place[found]
            hit = self.keys[at] == wanted[who]
            place[who[hit]] = at[hit]
            at, end, who = at[~hit] + 1, end[~hit], who[~hit]


def bitmap(keys: DataFrame, column: str, words: int) -> Bitmap:
    """Bits of a key column, put together in Spark; at most ``words`` rows reach the driver."""
    word = F.pmod(F.shiftrightunsigned(column, 6), F.lit(words)).cast("int")
    bits = keys.select(word.alias("word"), F.col(column).bitwiseAND(F.lit(63)).cast("int").alias("bit"))
    # unsigned remainders of 58-bit numbers: the same in numpy
    found = bits.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).toArrow()
    out = np.zeros(words, np.uint64)
    out[np.asarray(found["word"])] = np.asarray(found["bits"]).astype(np.int64).view(np.uint64)
    return Bitmap(out)


def _gathered(batches: Iterator[pa.RecordBatch], pick) -> Iterator[list[np.ndarray]]:
    """Columns that ``pick`` gives for each batch, put together until they hold about FLUSH values."""
    held, size = [], 0
    for b in batches_by_bytes(batches, "text", PART):
        held.append(pick(*tokens_of(b.column("text"))[:2]))
        size += len(held[-1][0])
        if size >= FLUSH:
            yield [np.concatenate(c) for c in zip(*held)]
            held, size = [], 0
    if held:
        yield [np.concatenate(c) for c in zip(*held)]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


# --- arrays in binary columns, so that a shuffle moves few rows ------------------------------------------------------


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The range, of ``buckets`` equal ones, that each hash lies in."""
    return (hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)


def _changes(x: np.ndarray) -> np.ndarray:
    """Whether each value differs from the one before; the first does."""
    out = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=out[1:])
    return out


def _equal(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(an order in which equal values lie together, where each value begins there)."""
    order = np.argsort(x)
    return order, np.flatnonzero(_changes(x[order]))


def _starts(groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(where each run of equal values begins, its value)."""
    starts = np.flatnonzero(_changes(groups))
    return starts, groups[starts]


def _cut(x: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The bytes of the pieces of ``x`` that begin at ``starts``."""
    ends = np.append(starts, len(x)) * x.itemsize
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(x))])


def _steps(x: np.ndarray) -> bytes:
    """Rising numbers as differences, which compress well."""
    return np.diff(x, prepend=0).astype(np.int64).tobytes()


def _cut_steps(x: np.ndarray, starts: np.ndarray) -> pa.Array:
    return pa.array([_steps(piece) for piece in np.split(x, starts[1:])], pa.binary())


def _whole(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    """All arrays of a binary column, one behind the other."""
    return np.concatenate([np.zeros(0, kind), *(np.frombuffer(x.as_buffer(), kind) for x in column)])


def _whole_steps(column: pa.ChunkedArray) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *(np.cumsum(np.frombuffer(x.as_buffer(), np.int64)) for x in column)])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, key) of columns row, keys: the rows of about FLUSH keys at once."""
    held, size = [], 0
    for b in batches:
        lists = b.column("keys")
        keys = np.asarray(lists.flatten()).view(np.uint64)
        held.append((np.repeat(np.asarray(b.column("row")), np.asarray(lists.value_lengths())), keys))
        size += len(keys)
        if size >= FLUSH:
            yield tuple(np.concatenate(c) for c in zip(*held))
            held, size = [], 0
    if size:
        yield tuple(np.concatenate(c) for c in zip(*held))


# --- learning -----------------------------------------------------------------------------------------------------


def unigrams(training: DataFrame) -> DataFrame:
    """(token, c) of the training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (tokens,) in _gathered(batches, lambda tokens, place: [tokens]):
            found, c = np.unique(tokens, return_counts=True)
            yield pa.RecordBatch.from_arrays([_signed(found), pa.array(c, pa.int64())], ["token", "c"])

    return training.select("text").mapInArrow(run, "token long, c long").groupBy("token").agg(F.sum("c").alias("c"))


def pairs(training: DataFrame, depth: int, candidates: DataFrame, total: int, min_count: int, bitmap_words: int,
          bucket: int = BUCKET) -> DataFrame:
    """Next tokens of the ``candidates`` (context, N) of ``depth`` words. Rows (c1 .. c``depth``, token, k) with k > 1, the shorter
    contexts at the same place among them, and rows without a token that tell of a context, or of a part of it: k occurrences in
    all, ``kinds`` of next tokens seen twice, ``once`` of others.

    Counts go to the shuffle as arrays by ranges of the contexts' hashes, about ``bucket`` tokens each. A context of more
    than half of that is dealt over several by its tokens; there are few of these, and all tasks know them."""
    buckets = max(8, total // bucket)
    wide = candidates.filter(F.col("N") > bucket // 2).toArrow()
    parts = np.minimum(np.asarray(wide["N"]) // (bucket // 2) + 1, buckets).astype(np.uint64)
    wide = Lookup(np.asarray(wide["context"]).astype(np.int64).view(np.uint64), parts)
    shared = training.sparkSession.sparkContext.broadcast((bitmap(candidates, "context", bitmap_words), wide))
    names = [f"c{d}" for d in range(1, depth + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        likely, wide = shared.value

        def pick(tokens: np.ndarray, place: np.ndarray) -> list[np.ndarray]:
            levels = contexts(tokens, place, depth)
            longest, there = levels[-1]
            at = np.flatnonzero(there)
            at = at[likely.holds(longest[at])]
            return [*(context[at] for context, _ in levels), tokens[at]]

        for columns in _gathered(batches, pick):
            if not len(columns[0]):
                continue
            # one order for contexts, and so buckets, and their tokens. Halves of hashes may be equal by chance: then a pair
            # may come twice, which ``merge`` puts right
            order = np.argsort(columns[-2] & HIGH | columns[-1] >> np.uint64(32))
            longest, token = columns[-2][order], columns[-1][order]
            first = np.flatnonzero(_changes(longest) | _changes(token))
            k, at, longest, token = np.diff(np.append(first, len(order))), order[first], longest[first], token[first]
            to, (found, which) = bucket_of(longest, buckets), wide.find(longest)
            if len(found):
                to[found] = (to[found] + pair_key(longest[found], token[found]) % wide.values[0][which]) % np.uint64(buckets)
                order = np.argsort(to, kind="stable")
                at, k, to, longest, token = at[order], k[order], to[order], longest[order], token[order]
            levels = [*(c[at] for c in columns[:-2]), longest]
            # a context once in each bucket, with the number of its tokens
            opens = np.flatnonzero(_changes(longest) | _changes(to))
            sizes = np.diff(np.append(opens, len(to)))
            starts, ids = _starts(to)
            inner = np.searchsorted(opens, starts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids.astype(np.int32)), *(_cut(c[opens], inner) for c in levels), _cut(sizes.astype(np.uint32), inner),
                 _cut(token, starts), _cut(k.astype(np.uint32), starts)], ["bucket", *names, "sizes", "token", "k"])

    def merge(blobs: pa.Table) -> pa.Table:
        likely, wide = shared.value
        sizes = _whole(blobs["sizes"], np.uint32)
        levels = [_whole(blobs[n], np.uint64) for n in names]
        token, owner = _whole(blobs["token"], np.uint64), np.repeat(np.arange(len(sizes)), sizes)
        order, first = _equal(pair_key(levels[-1][owner], token))
        k = np.add.reduceat(_whole(blobs["k"], np.uint32).astype(np.int64)[order], first)
        token, owner = token[order[first]], owner[order[first]]
        _, own, ids = np.unique(levels[-1], return_index=True, return_inverse=True)
        of = ids[owner]
        n, sizes = np.bincount(of, k, len(own)).astype(np.int64), np.bincount(of, minlength=len(own))
        kinds = np.bincount(of[k > 1], minlength=len(own))
        held = (n >= min_count) & (kinds > 0)
        held[wide.find(levels[-1][own])[0]] = True  # a part of a context, which others add to
        own, some = own[held], held[of] & (k > 1)
        none = pa.nulls(int(some.sum()), pa.int64())
        rows = [*(_signed(c[owner[some]]) for c in levels), _signed(token[some]), pa.array(k[some]), none, none]
        of_contexts = [*(_signed(c[own]) for c in levels), pa.nulls(len(own), pa.int64()), pa.array(n[held]),
                       pa.array(kinds[held]), pa.array((sizes - kinds)[held])]
        out = [*names, "token", "k", "kinds", "once"]
        return pa.concat_tables([pa.table(rows, out), pa.table(of_contexts, out)])

    blobs = training.select("text").mapInArrow(
        run, ", ".join(["bucket int", *(f"{n} binary" for n in [*names, "sizes", "token", "k"])]))
    return blobs.groupBy("bucket").applyInArrow(merge, ", ".join(f"{n} long" for n in [*names, "token", "k", "kinds", "once"]))


def _keyed(rows: DataFrame, columns: list[str], out: str) -> DataFrame:
    """``rows`` with the key of a context and a token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key = pair_key(*(np.asarray(b.column(c)).view(np.uint64) for c in columns))
            yield pa.RecordBatch.from_arrays([*b.columns, _signed(key)], [*b.schema.names, out])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{schema}, {out} long")


@dataclass
class Tree:
    """The model: (key, value, root, n) as a written table, with the numbers N and V of the training tokens. ``root``: the
    root's value of a single token, null for longer runs."""

    keys: DataFrame
    total: int
    distinct: int

    def unseen(self) -> float:
        return float(-np.log10(self.total + self.distinct + 1))


def fit(docs: DataFrame, depth: int = DEPTH, min_count: int = MIN_COUNT, min_gain: float = MIN_GAIN,
        bitmap_words: int = LEARNING_WORDS) -> Tree:
    """Learn from the rows of ``prepared`` that aren't held out."""
    training = docs.filter("not held_out")
    counts = materialize(unigrams(training), "lm-unigrams")
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    tree = Tree(counts, total, distinct)
    root = counts.select("token", (F.log10(F.col("c") + 1) + F.lit(tree.unseen())).alias("parent"))
    single = _keyed(counts.select(F.lit(0).cast("long").alias("context"), "token", "c"), ["context", "token"], "key")
    model = [single.select("key", (F.log10(F.col("c") + 1) + F.lit(tree.unseen())).alias("value"), F.col("c").alias("n"))
             .withColumn("root", F.col("value"))]
    release_shuffles(training.sparkSession)
    # a word occurs as often as the context of one word; behind an end token comes nothing
    frequent = counts.select(F.lit(0).cast("long").alias("context"), "token", F.col("c").alias("k"))
    states, entries, done = [], [], []
    for d in range(1, depth + 1):
        often = frequent.filter((F.col("k") >= min_count) & (F.col("token") != F.lit(END_VALUE)))
        candidates = materialize(_keyed(often.select("context", "token", F.col("k").alias("N")), ["context", "token"], "key")
                                 .select(F.col("key").alias("context"), "N"), "lm-candidates")
        discard(*done)
        found = materialize(pairs(training, d, candidates, total, min_count, bitmap_words).withColumnRenamed(f"c{d}", "context"),
                            "lm-pairs")
        discard(candidates)
        release_shuffles(training.sparkSession)
        twice_seen = found.filter("token is not null").drop("kinds", "once")
        frequent = twice_seen.select("context", "token", "k")
        sums = (found.filter("token is null").groupBy("context")
                .agg(F.sum("k").alias("N"), F.sum("once").alias("once"), F.sum(F.col("once") + F.col("kinds")).alias("T"))
                .filter(F.col("N") >= min_count))
        # the logarithm that the parent gives to each pair's token
        known = twice_seen.join(root.hint("shuffle_hash"), "token")
        for j in range(1, d):
            known = (known.join(states[j - 1].select(F.col("context").alias(f"c{j}"), "left_over").hint("shuffle_hash"), f"c{j}", "left")
                     .join(entries[j - 1].select(F.col("context").alias(f"c{j}"), "token", "gain").hint("shuffle_hash"), [f"c{j}", "token"],
                           "left")
                     .withColumn("parent", F.col("parent") + F.coalesce("left_over", F.lit(0.0)) + F.coalesce("gain", F.lit(0.0)))
                     .drop("left_over", "gain", f"c{j}"))
        known = known.join(sums.hint("shuffle_hash"), "context")
        # each occurrence predicted without itself, against the parent
        twice = F.col("k") * (F.log((F.col("k") - 2) / F.pow(F.lit(10.0), "parent") + F.col("T")) - F.log(F.col("N") - 1))
        once = F.col("once") * (F.log(F.greatest(F.col("T") - 1, F.lit(1))) - F.log(F.col("N") - 1))
        share = F.log10((F.col("k") - 1) / F.col("N") + F.col("T") / F.col("N") * F.pow(F.lit(10.0), "parent"))
        kept = materialize(
            known.withColumn("twice", F.sum(twice).over(Window.partitionBy("context"))).filter(F.col("twice") + once > min_gain)
            .withColumn("left_over", F.log10(F.col("T") / F.col("N")))
            .select("context", "token", "k", "N", "left_over", (share - F.col("left_over") - F.col("parent")).alias("gain")), "lm-entries")
        states.append(materialize(kept.groupBy("context").agg(F.max("N").alias("N"), F.max("left_over").alias("left_over")), "lm-states"))
        entries.append(kept)
        release_shuffles(training.sparkSession)
        done = [found]
        no_root = F.lit(None).cast("double").alias("root")
        model.append(states[-1].select(F.col("context").alias("key"), F.col("left_over").alias("value"), F.col("N").alias("n"), no_root))
        model.append(_keyed(entries[-1].select("context", "token", "k", "gain"), ["context", "token"], "key")
                     .select("key", F.col("gain").alias("value"), F.col("k").alias("n"), no_root))
    longest = model.pop() if depth else None  # no context has the key of the longest runs
    keys = model[0]
    for part in model[1:]:
        keys = keys.unionByName(part)
    keys = keys.groupBy("key").agg(F.sum("value").alias("value"), F.max("n").alias("n"), F.max("root").alias("root"))
    tree.keys = materialize(keys if longest is None else keys.unionByName(longest), "lm-keys")
    discard(counts, *states, *entries, *done)
    release_shuffles(training.sparkSession)
    return tree


# --- scoring ------------------------------------------------------------------------------------------------------


def answered(asked: DataFrame, model: DataFrame, unseen: float, buckets: int) -> DataFrame:
    """(row, known, base, all): what the keys of each row of ``asked`` (row, keys) add to its sums. Keys meet the model, and sums go
    back to the block of rows that asked, as arrays."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, keys in _blocks(batches):
            to = bucket_of(keys, buckets)
            order = np.argsort(to.astype(np.uint16) if buckets < 1 << 16 else to, kind="stable")
            row, keys, to = row[order], keys[order], to[order]
            starts, ids = _starts(to)
            opens = np.flatnonzero(_changes(row) | _changes(to))
            inner = np.searchsorted(opens, starts)
            sizes = np.diff(np.append(opens, len(to))).astype(np.uint32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids.astype(np.int32)), pa.array(np.full(len(ids), row.min())), _cut_steps(row[opens], inner), _cut(sizes, inner),
                 _cut(keys, starts)], ["bucket", "block", "row", "sizes", "keys"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            keys = np.asarray(b.column("key")).view(np.uint64)
            value, root = (np.asarray(b.column(c).fill_null(np.nan)) for c in ("value", "root"))
            to = bucket_of(keys, buckets)
            order = np.argsort(to, kind="stable")
            starts, ids = _starts(to[order])
            yield pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int32)), *(_cut(x[order], starts) for x in (keys, value, root))],
                                             ["bucket", "key", "value", "root"])

    def meet(asked: pa.Table, model: pa.Table) -> pa.Table:
        value, root = _whole(model["value"], np.float64), _whole(model["root"], np.float64)
        held = Lookup(_whole(model["key"], np.uint64), np.where(np.isnan(root), value, value - unseen), root - unseen)
        out = []
        for b in asked.select(["block", "row", "sizes", "keys"]).to_pylist():
            row, sizes = np.cumsum(np.frombuffer(b["row"], np.int64)), np.frombuffer(b["sizes"], np.uint32)
            found, at = held.find(np.frombuffer(b["keys"], np.uint64))
            owner = np.repeat(np.arange(len(row)), sizes)[found]
            hit = np.flatnonzero(np.bincount(owner, minlength=len(row)))
            single = np.flatnonzero(~np.isnan(held.values[1][at]))
            known = np.bincount(owner[single], minlength=len(row))
            base = np.bincount(owner[single], held.values[1][at[single]], len(row))
            some = np.flatnonzero(known)
            out.append((b["block"], _steps(row[hit]), np.bincount(owner, held.values[0][at], len(row))[hit].tobytes(),
                        _steps(row[some]), known[some].astype(np.uint32).tobytes(), base[some].tobytes()))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 6, [pa.int64(), *[pa.binary()] * 5])],
                        ["block", "row", "all", "single", "known", "base"])

    def add(answers: pa.Table) -> pa.Table:
        rows, all_ = _whole_steps(answers["row"]), _whole(answers["all"], np.float64)
        ids, at = np.unique(rows, return_inverse=True)
        single = np.searchsorted(ids, _whole_steps(answers["single"]))
        return pa.table([pa.array(ids), pa.array(np.bincount(single, _whole(answers["known"], np.uint32), len(ids)).astype(np.int64)),
                         pa.array(np.bincount(single, _whole(answers["base"], np.float64), len(ids)).astype(float)),
                         pa.array(np.bincount(at, all_, len(ids)).astype(float))], ["row", "known", "base", "all"])

    blobs = asked.mapInArrow(ask, "bucket int, block long, row binary, sizes binary, keys binary").groupBy("bucket")
    dealt = model.select("key", "value", "root").mapInArrow(deal, "bucket int, key binary, value binary, root binary").groupBy("bucket")
    met = blobs.cogroup(dealt).applyInArrow(meet, "block long, row binary, all binary, single binary, known binary, base binary")
    return met.groupBy("block").applyInArrow(add, "row long, known long, base double, all double")


def score(docs: DataFrame, tree: Tree, depth: int = DEPTH, table_keys: int = TABLE_KEYS,
          bitmap_words: int = BITMAP_WORDS, slices: int = SLICES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of ``prepared``."""
    spark = docs.sparkSession
    top = most_frequent(tree.keys, "n", table_keys).select("key", "value", "root").toArrow()
    table_ = Lookup(np.asarray(top["key"]).astype(np.int64).view(np.uint64),
                    *(np.asarray(top[c].fill_null(0.0)).astype(float) for c in ("value", "root")))
    unseen = tree.unseen()
    shared = spark.sparkContext.broadcast((table_, bitmap(tree.keys, "key", bitmap_words)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, all_keys = shared.value
        values, roots = frequent.values

        for b in batches_by_bytes(batches, "text", PART):
            tokens, place, sizes = tokens_of(b.column("text"))
            starts = np.cumsum(sizes) - sizes  # every text has its end token

            def per_text(x: np.ndarray) -> np.ndarray:
                return np.add.reduceat(x, starts)

            base, total = np.full(len(tokens), unseen), np.full(len(tokens), unseen)
            known, asked, chosen = np.zeros(len(tokens), np.int64), [], []
            for length, (key, there) in enumerate(runs(tokens, place, depth)):
                possible = np.flatnonzero(there & all_keys.holds(key))
                found, at = frequent.find(key[possible])
                open_ = np.zeros(len(tokens), bool)
                open_[possible] = True
                found = possible[found]
                open_[found] = False
                if length:
                    total[found] += values[at]
                else:
                    base[found], total[found], known[found] = roots[at], values[at], 1
                asked.append(key)
                chosen.append(open_)
            # the open keys of every text, by slice. A row of the arrays is a token, so that each text's lie together
            asked, chosen = np.stack(asked, 1), np.stack(chosen, 1)
            keys, owner = asked[chosen], np.repeat(np.arange(len(sizes)), per_text(chosen.sum(1)))
            which, lists = keys % np.uint64(slices), []
            for s in range(slices):
                mine = which == s
                n = np.bincount(owner[mine], minlength=len(starts))
                lists.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), _signed(keys[mine])))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(sizes.astype(np.int64)), pa.array(per_text(known)),
                 pa.array(per_text(base)), pa.array(per_text(total)), *lists],
                ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", *names])

    names = [f"open_{s}" for s in range(slices)]
    schema = ("doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, "
              + ", ".join(f"{n} array<long>" for n in names))
    rows = materialize(docs.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "lm-scores")
    answers = None
    for s in range(slices):
        # the remainder of the unsigned key
        own = F.pmod(F.pmod("key", F.lit(slices)) + F.when(F.col("key") < 0, F.lit((1 << 64) % slices)).otherwise(0), F.lit(slices)) == s
        part = materialize(answered(rows.select("row", F.col(f"open_{s}").alias("keys")), tree.keys.filter(own), unseen,
                                    max(8, tree.total // BUCKET // slices)), "lm-answers")
        release_shuffles(spark)
        answers = part if answers is None else answers.unionByName(part)
    answers = answers.groupBy("row").agg(*(F.sum(c).alias(c) for c in ("known", "base", "all")))
    none = F.lit(0.0)
    return rows.join(answers, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(tree.total).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("base", none)).alias("base_score"),
        (F.col("score") + F.coalesce("all", none)).alias("score"))


def op13_lm_scores(spark, sf_dir: str) -> DataFrame:
    """Log10 probabilities of every document by a suffix tree of the training documents."""
    docs = prepared(table(spark, sf_dir, "documents"))
    return score(docs, fit(docs))
