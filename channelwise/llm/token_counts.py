"""Token counts by a two-tier lookup on the map side.

The text is cut into pre-tokens at places that no token crosses (before a single space between two
other characters, and around single line feeds). Tier one is a compact table of the lengths of
frequent pre-tokens, built once from a bounded sample (``SAMPLE_DOCS`` texts, of each at most
``SAMPLE_CHARS`` characters; it only decides what is found fast, never a count) and broadcast:
at most ``TABLE_ENTRIES`` strings of at most ``SHORT`` characters. Misses go to a cache in the
worker, and through the tokenizer library where that misses too. No pre-token is shuffled.

Cases: null counts as the empty text (0 bytes, 0 tokens); special strings inside a text are taken
as the library takes them by default; .model files (sentencepiece), whose pieces may span spaces,
are encoded whole. Extra columns are ignored.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Recent, batches_by_bytes, table, text_or_empty, worker_store

SAMPLE_DOCS, SAMPLE_CHARS, TABLE_ENTRIES, SHORT = 1000, 1 << 14, 1 << 16, 48
CACHE_ENTRIES = 1 << 18
TOKEN_LIMIT = 512
UNEVEN_SPACE = re.compile(r"\s\s|^\s|\s$|[\x1c-\x1f]")
SAFE_SPACE = re.compile(r"(?<=\S)(?= \S)")
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def pre_tokens(text: str) -> list[str]:
    """Pre-tokens of a text whose tokens are those of the text, put together."""
    if UNEVEN_SPACE.search(text):
        return [x for x in SAFE_SPACE.split(text) if x]
    # single spaces and line feeds between other characters: a space belongs to what follows it
    out = text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0") if "\0" not in text else SAFE_SPACE.split(text)
    return out if text else []


class Counts:
    """The worker's side: the broadcast table, the cache for its misses, and the library."""

    def __init__(self, path: str, frequent: dict[str, int]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.frequent, self.cache = frequent, Recent(CACHE_ENTRIES)
        added = self.library.get_added_tokens_decoder().values()
        # texts that hold one of these are encoded whole
        self.special = re.compile("|".join(re.escape(t.content) for t in added)) if added else None

    def library_lengths(self, pieces: list[str]) -> dict[str, int]:
        found = self.library.encode_batch_fast(pieces, add_special_tokens=False)
        return {p: len(x.ids) for p, x in zip(pieces, found)}

    def count(self, text: str) -> int:
        if self.special is not None and self.special.search(text):
            return len(self.library.encode(text, add_special_tokens=False).ids)
        tier_one = list(map(self.frequent.get, pieces := pre_tokens(text)))
        if None not in tier_one:
            return sum(tier_one)
        rest = [p for p, n in zip(pieces, tier_one) if n is None]
        return sum(filter(None, tier_one)) + sum(self.cache.fetch(rest, self.library_lengths, SHORT))


def frequent_lengths(docs: DataFrame, path: str) -> dict[str, int]:
    """Tier one: the lengths of the most frequent pre-tokens of the first ``SAMPLE_DOCS`` texts."""
    counts = Counts(path, {})
    seen: Counter[str] = Counter()
    for (text,) in docs.select(F.substring("text", 1, SAMPLE_CHARS)).limit(SAMPLE_DOCS).collect():
        if text and not (counts.special is not None and counts.special.search(text)):
            seen.update(p for p in pre_tokens(text) if len(p) <= SHORT)
    top = [p for p, n in seen.most_common(TABLE_ENTRIES) if n > 1]
    return counts.library_lengths(top)


@lru_cache(maxsize=2)
def _pieces_model(path: str):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=path)


def count_tokens(docs: DataFrame, path: str, limit: int = TOKEN_LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs`` (doc_id, text)."""
    frequent = None
    if not path.endswith(".model"):
        frequent = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if frequent is None:
            model = _pieces_model(path)

            def count(text: str) -> int:
                return len(model.encode(text, num_threads=1))
        else:
            key = frequent._jbroadcast.id() if getattr(frequent, "_jbroadcast", None) else frequent._path
            count = worker_store(("counts", path, key), lambda: Counts(path, frequent.value)).count
        for b in batches_by_bytes(batches, "text"):
            texts = b.column("text")
            n = [count(t) for t in texts.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pc.binary_length(texts).cast(pa.int64()), pa.array(n, pa.int64()),
                 pa.array([x > limit for x in n], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def op2_token_counts(spark, sf_dir: str) -> DataFrame:
    """Token counts of every document by byte_bpe_50k.json."""
    from .bpe import tokenizer_path
    return count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
