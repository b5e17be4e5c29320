"""BPE as a bounded-lookahead streaming transducer.

A merge list decides the tokens of a string by applying its rules in order of rank, the leftmost
place first. Whether a boundary inside the string stays depends on the text to its right only as far
as a chain of conflicting rules can reach: rule (u, v) at a place fails if the right edge of v, or
of a token that v is built from, is first merged with what follows, which takes a rule of smaller
rank, and so on with strictly falling ranks. ``sufficient_lookahead`` computes the longest such
chain from the merge list alone. ``Transducer`` tokenises a window, emits the tokens that end at
least that far before the window's end (they can't change whatever follows) and goes on behind
them, so its memory is a constant number of symbols whatever the length of the string.
"""

from __future__ import annotations

import bisect
import json
from collections.abc import Iterable, Iterator


def byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte: printable Latin-1
    bytes stand for themselves, the others take code points from 256 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = [""] * 256, 256
    for b in range(256):
        if b in own:
            out[b] = chr(b)
        else:
            out[b], spare = chr(spare), spare + 1
    return out


BYTE_SYMBOLS = byte_symbols()
SYMBOL_BYTES = {c: b for b, c in enumerate(BYTE_SYMBOLS)}


class MergeList:
    """vocab (token -> id), ranks ((left, right) -> rank) and the word-end suffix of a BPE file."""

    def __init__(self, spec: dict):
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ranks: dict[tuple[str, str], int] = {}
        for rank, pair in enumerate(pairs):
            self.ranks[pair] = rank
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.token_of = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.added.items()}

    @classmethod
    def load(cls, path: str) -> "MergeList":
        with open(path, encoding="utf-8") as f:
            return cls(json.load(f))

    def width(self, token: str) -> int:
        """Symbols (bytes) that a token covers."""
        return len(token) - len(self.suffix) if self.suffix and token.endswith(self.suffix) else len(token)

    def sufficient_lookahead(self) -> int:
        """Symbols to the right of a boundary that can influence whether it stays."""
        made: dict[str, list[tuple[int, str]]] = {}  # token -> (rank, right part) of the rules that make it
        ranks_of: dict[str, list[int]] = {}  # left token -> ranks of its rules, rising
        reach_of: dict[str, list[int]] = {}  # the same: the largest reach so far
        longest = 1
        for (left, right), rank in sorted(self.ranks.items(), key=lambda x: x[1]):
            # tokens at the right edge of ``right`` that may be merged away before this rule
            most, edges = 0, [(right, rank)]
            while edges:
                edge, until = edges.pop()
                known = ranks_of.get(edge)
                if known and (at := bisect.bisect_left(known, until)):
                    most = max(most, reach_of[edge][at - 1])
                edges += [(part, min(until, r)) for r, part in made.get(edge, ())]
            reach = self.width(right) + most
            longest = max(longest, reach)
            made.setdefault(left + right, []).append((rank, right))
            ranks_of.setdefault(left, []).append(rank)
            best = reach_of.setdefault(left, [])
            best.append(max(reach, best[-1] if best else 0))
        return longest + 1


def merge_all(parts: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """Merge the pair of smallest rank, the leftmost first, until no pair has a rule."""
    get, none = ranks.get, 1 << 60
    found = [get(pair, none) for pair in zip(parts, parts[1:])]
    while found and (best := min(found)) != none:
        i = found.index(best)
        token = parts[i] = parts[i] + parts.pop(i + 1)
        del found[i]
        if i:
            found[i - 1] = get((parts[i - 1], token), none)
        if i < len(found):
            found[i] = get((token, parts[i + 1]), none)
    return parts


SHIFT = 20  # bits of an id beside another one, or below a rank
MASK = (1 << SHIFT) - 1


def numbered(merges: MergeList) -> dict[int, int]:
    """The merge list by ids: both parts' ids -> the rank above the id of what they make. Empty if a token of a rule has no id."""
    vocab, out = merges.vocab, {}
    for (left, right), rank in merges.ranks.items():
        made = vocab.get(left + right)
        if made is None or left not in vocab or right not in vocab or max(made, vocab[left], vocab[right]) > MASK:
            return {}
        out[vocab[left] << SHIFT | vocab[right]] = rank << SHIFT | made
    return out


def merge_ids(ids: list[int], rules: dict[int, int]) -> list[int]:
    """``merge_all`` over ids."""
    get, none = rules.get, 1 << 60
    found = [get(left << SHIFT | right, none) for left, right in zip(ids, ids[1:])]
    while found and (best := min(found)) != none:
        i = found.index(best)
        made = ids[i] = best & MASK
        del ids[i + 1], found[i]
        if i:
            found[i - 1] = get(ids[i - 1] << SHIFT | made, none)
        if i < len(found):
            found[i] = get(made << SHIFT | ids[i + 1], none)
    return ids


class Transducer:
    """Tokens of one word, symbol by symbol: ``feed`` takes symbols and yields stable tokens,
    ``finish`` closes the word and yields the rest."""

    def __init__(self, merges: MergeList, lookahead: int | None = None, window: int | None = None):
        self.merges = merges
        self.lookahead = lookahead or merges.sufficient_lookahead()
        self.window = max(window or 0, 4 * self.lookahead)
        self.pending = ""
        self.rules = numbered(merges)

    def feed(self, symbols: str) -> Iterator[str]:
        at, n = 0, len(symbols)
        while at < n:
            room = self.window - len(self.pending)
            self.pending += symbols[at:at + room]
            at += room
            if len(self.pending) >= self.window:
                yield from self._stable()

    def _stable(self) -> Iterator[str]:
        end = 0
        for token in merge_all(list(self.pending), self.merges.ranks):
            if end + len(token) > len(self.pending) - self.lookahead:
                break
            end += len(token)
            yield token
        if not end:  # a token longer than the window: only possible if the window is too small for it
            self.window *= 2
        self.pending = self.pending[end:]

    def word(self, symbols: str) -> list[str]:
        """All tokens of one word; one that fits the window needs no stream."""
        if len(symbols) < self.window and not self.pending:
            parts = list(symbols)
            parts[-1] += self.merges.suffix
            return merge_all(parts, self.merges.ranks)
        return [*self.feed(symbols), *self.finish()]

    def ids(self, symbols: str) -> list[int]:
        """The ids of ``word``."""
        vocab = self.merges.vocab
        if self.rules and len(symbols) < self.window and not self.pending:
            parts = [*symbols[:-1], symbols[-1] + self.merges.suffix]
            ids = list(map(vocab.get, parts))
            if None not in ids:
                return merge_ids(ids, self.rules)
        return [vocab[t] for t in self.word(symbols)]

    def finish(self) -> Iterator[str]:
        symbols, self.pending = self.pending, ""
        if symbols:
            parts = list(symbols)
            parts[-1] += self.merges.suffix
            yield from merge_all(parts, self.merges.ranks)


class Decoder:
    """Incremental decoder. ``mode`` "tokens" (a file without a decoder): token strings joined by a
    space. "bytes": byte-level tokens back to bytes and, as soon as a character is complete, to text;
    malformed bytes become U+FFFD. It holds at most three bytes between calls."""

    def __init__(self, merges: MergeList, mode: str):
        import codecs
        if mode not in ("tokens", "bytes"):
            raise ValueError(mode)
        self.merges, self.mode, self.first = merges, mode, True
        self.utf8 = codecs.getincrementaldecoder("utf-8")("replace") if mode == "bytes" else None

    def push(self, ids: Iterable[int]) -> str:
        tokens = [t for i in ids if (t := self.merges.token_of.get(i)) is not None]
        if self.mode == "tokens":
            if not tokens:
                return ""
            out = ("" if self.first else " ") + " ".join(tokens)
            self.first = False
            return out
        return self.utf8.decode(b"".join(map(self._bytes, tokens)))

    def raw(self, ids: Iterable[int]) -> bytes:
        """The bytes of byte-level tokens, not yet text."""
        return b"".join(self._bytes(t) for i in ids if (t := self.merges.token_of.get(i)) is not None)

    @staticmethod
    def _bytes(token: str) -> bytes:
        if all(c in SYMBOL_BYTES for c in token):
            return bytes(SYMBOL_BYTES[c] for c in token)
        return token.encode()

    def close(self) -> str:
        return self.utf8.decode(b"", True) if self.utf8 else ""


def load_merges(path: str) -> tuple[MergeList, int]:
    merges = MergeList.load(path)
    return merges, merges.sufficient_lookahead()
