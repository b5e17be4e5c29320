"""BPE encoding and decoding of whole texts (see ``bpe_core`` for the transducer).

A tokenizer file's own normaliser and pre-tokenizer cut a text into words; every word runs through
the transducer, and its ids through the incremental decoder. Texts are first cut where no rule can
reach across: at white space, if the file drops it, or before single spaces between two other
characters, if it keeps it. The pieces' results are kept in a worker's cache of bounded size, so
frequent words are encoded once per worker; nothing is shuffled.

Cases: null counts as the empty text (0 ids, the hashes of the empty string); special tokens inside
a text are recognised as the library does by default; words of any length run in constant memory.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe_core import BYTE_SYMBOLS, Decoder, Transducer, load_merges
from .common import Recent, batches_by_bytes, ship, table, text_or_empty, worker_store

CACHE_ENTRIES = 1 << 16
ALONE_ENTRIES = 1 << 19  # where no other operator's tables share the executor
LONG_PIECE = 256
ASCII_SPACE = re.compile(r"[ \t\n\r\x0b\x0c]+")
SEPARATORS = re.compile("[\x1c-\x1f]")  # white space for Python, not for the tokenizers' patterns
SAFE_SPACE = re.compile(r"(?<=\S)(?= \S)")
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class Codec:
    """Encoder and decoder of one tokenizer file (byte-level BPE of the tokenizers library)."""

    def __init__(self, path: str, entries: int = CACHE_ENTRIES):
        from tokenizers import Tokenizer
        library = Tokenizer.from_file(path)
        self.merges, self.lookahead = load_merges(path)
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        for content, token in library.get_added_tokens_decoder().items():
            if token.single_word or token.lstrip or token.rstrip or token.normalized:
                raise ValueError(f"added token {content} needs matching rules that are not supported")
        names = sorted(self.merges.added, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.drops_space = all(" " not in w and "Ġ" not in w for w, _ in self.pre_tokenizer.pre_tokenize_str(
            "a b"))
        self.mode = "tokens" if library.decoder is None else "bytes"
        self.id_text = {i: str(i) for i in self.merges.vocab.values()}
        self.glue = " " if self.mode == "tokens" else b""
        self.stream = Transducer(self.merges, self.lookahead)
        self.words = Recent(entries // 2)  # word -> (ids, decoded), as the pieces
        self.pieces = Recent(entries)  # piece -> (ids joined by a space, decoded text or bytes)

    def _encode_words(self, words: list[str]) -> dict[str, tuple[str, str | bytes]]:
        out, number = {}, self.id_text
        text, plain = self.merges.token_of, self.mode == "tokens"
        for word in words:
            ids = self.stream.ids(word)
            out[word] = " ".join([number[i] for i in ids]), " ".join([text[i] for i in ids]) if plain else self._decoded(ids)
        return out

    def _joined(self, found: list[tuple[str, str | bytes]]) -> tuple[str, str | bytes]:
        return found[0] if len(found) == 1 else (" ".join([x[0] for x in found]), self.glue.join([x[1] for x in found]))

    def _decoded(self, ids: Iterable[int]) -> str | bytes:
        decoder = Decoder(self.merges, self.mode)
        return decoder.push(ids) if self.mode == "tokens" else decoder.raw(ids)

    def _cut_words(self, text: str) -> list[str]:
        text = self.normalizer.normalize_str(text) if self.normalizer is not None else text
        return [w for w, _ in self.pre_tokenizer.pre_tokenize_str(text)]

    def _encode_pieces(self, pieces: list[str]) -> dict[str, tuple[str, str | bytes]]:
        out, plain = {}, []
        for p in pieces:
            if self.special is not None and self.special.search(p):
                ids = [self.merges.added[p]]  # ``cut`` leaves special tokens as pieces of their own
                out[p] = str(ids[0]), self._decoded(ids)
            elif self.drops_space and "\0" not in p:
                plain.append(p)
            else:
                out[p] = self._joined(self.words.fetch(self._cut_words(p), self._encode_words, LONG_PIECE))
        if plain:  # one call for all: a NUL between spaces is a word of its own
            end = BYTE_SYMBOLS[0]
            cut = self._cut_words(" \0 ".join(plain))
            cut.append(end)
            found, at, first = self.words.fetch(cut, self._encode_words, LONG_PIECE), 0, 0
            for k, w in enumerate(cut):
                if w == end:
                    out[plain[at]] = found[first] if k == first + 1 else self._joined(found[first:k])
                    at, first = at + 1, k + 1
        return out

    def results(self, pieces: list[str]) -> list[tuple[str, str | bytes]]:
        """The results of the pieces in order; those that aren't held are worked out together."""
        return self.pieces.fetch(pieces, self._encode_pieces, LONG_PIECE)

    def cut(self, text: str) -> list[str]:
        """Pieces of a text that are encoded independently of each other."""
        parts = self.special.split(text) if self.special is not None and self.special.search(text) else [text]
        out: list[str] = []
        for part in parts:
            if len(parts) > 1 and part in self.merges.added:
                out.append(part)
            elif self.drops_space:
                out += part.split() if not SEPARATORS.search(part) else [x for x in ASCII_SPACE.split(part) if x]
            else:
                out += [x for x in SAFE_SPACE.split(part) if x]
        return out

    def encode(self, text: str) -> list[int]:
        return [int(i) for ids, _ in self.results(self.cut(text)) for i in ids.split()]

    def decode(self, ids: list[int]) -> str:
        decoder = Decoder(self.merges, self.mode)
        return decoder.push(ids) + decoder.close()

    def digests(self, text: str, block: int = 1 << 16) -> tuple[int, str, str]:
        """(number of ids, sha256 of the ids joined by spaces, sha256 of the decoded text), fed to
        the hashes block by block."""
        pieces, ids_hash, text_hash, count = self.cut(text), hashlib.sha256(), hashlib.sha256(), 0
        utf8 = Decoder(self.merges, self.mode).utf8
        for at in range(0, len(pieces), block):
            found = [x for x in self.results(pieces[at:at + block]) if x[0]]
            if not found:
                continue
            ids = " ".join([x[0] for x in found])
            space = b" " if count else b""
            count += ids.count(" ") + 1
            ids_hash.update(space + ids.encode())
            if self.mode == "tokens":
                text_hash.update(space + " ".join([x[1] for x in found]).encode())
            else:
                text_hash.update(utf8.decode(b"".join([x[1] for x in found])).encode())
        if self.mode == "bytes":
            text_hash.update(utf8.decode(b"", True).encode())
        return count, ids_hash.hexdigest(), text_hash.hexdigest()


def codec(path: str, entries: int = CACHE_ENTRIES) -> Codec:
    """One codec per worker process, until another operator needs the room."""
    return worker_store(("codec", path, entries), lambda: Codec(path, entries))


def encode_digests(docs: DataFrame, path: str, entries: int = CACHE_ENTRIES) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for every row of ``docs`` (doc_id, text). ``entries``: of a worker's
    cache of pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = codec(path, entries)
        for b in batches_by_bytes(batches, "text"):
            rows = [tokenizer.digests(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([r[0] for r in rows], pa.int64()),
                 pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def encode_ids(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids array<int>) for every row of ``docs``: the operator's real output."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = codec(path)
        for b in batches_by_bytes(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([tokenizer.encode(t) for t in b.column("text").to_pylist()],
                                              pa.list_(pa.int32()))], ["doc_id", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def decode_ids(rows: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids): what the library's decode gives, special tokens kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = codec(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([tokenizer.decode(i or []) for i in b.column("ids").to_pylist()],
                                              pa.string())], ["doc_id", "text"])

    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op7_bpe_encode_decode(spark, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    return encode_digests(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), ALONE_ENTRIES)


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return encode_digests(docs, tokenizer_path("word_bpe_49k.json"))
