"""Cross-tokenizer alignment against a plain version that walks decoded bytes."""
import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from channelwise.llm import common, token_align
from channelwise.llm.bpe import tokenizer_path

from .conftest import CLASHING

pytest.importorskip("tokenizers")
pytest.importorskip("sentencepiece")
A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
ODD = [None, "", " ", "a", "  a  b \n\n c\t\td  ", "<|endoftext|>x <s> y</s> <0x41>", "\x1c a\x1fb", "é́ ſ İ x\u0085z　q",
       "▁y z", " lead", "tail \n", "日本語 テキスト 𝒳𝒴 🙂 x🙂y", "\x00 a\x00b \x00", "it's we'll", "﻿x", "a‍b",
       "x" * 300 + " " + "ab" * 200, "the the the", "the the the"]


def plain(text):
    """(ids of A, ids of B, groups, links) by the libraries on the whole text and the bytes of their tokens."""
    both = token_align.aligner(A, B)
    if not text:
        return [], [], [], []
    data = b" " + text.encode()
    ids = both.a.encode(" " + text, add_special_tokens=False).ids, both.b.encode(text)
    spans = []
    for found, size in zip(ids, (both.bytes_a, both.bytes_b)):
        at, own = 0, []
        for i in found:
            own.append((at, at + len(size[i]), i))
            at += len(size[i])
        spans.append(own)
        if b"".join(size[i] for i in found) != data:
            return [], [], [], []
    groups, last = [], 0
    for end in sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]}):
        groups.append("|".join(",".join(str(i) for _, e, i in own if last < e <= end) for own in spans))
        last = end
    links = [(a, b) for s, e, a in spans[0] for t, u, b in spans[1] if max(s, t) < min(e, u)]
    return *ids, groups, links


def expected(texts):
    rows = [plain(t) for t in texts]
    counts = Counter(x for r in rows for x in r[3])
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return sorted((len(a), len(b), len(g), len(links), sum(counts[x] == most[x[1]] for x in links),
                   sum(counts[x] for x in links), hashlib.sha256(";".join(g).encode()).hexdigest() if a else "")
                  for a, b, g, links in rows)


@pytest.mark.parametrize("bound", [token_align.BROADCAST_PAIRS, 40, 0])
def test_equals_plain_version(spark, documents, bound):
    own = token_align.table  # documents of the smallest test table, and odd texts
    texts = ODD + [r.text for r in own(spark, "/root/testdata/sf0.001", "documents").filter("length(text) < 400")
                   .orderBy("doc_id").limit(40).collect()]
    docs = documents(texts)
    for name in CLASHING:
        docs = docs.withColumn(name, docs.text)
    got = token_align.align_documents(docs, A, B, bound)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(tuple(r)[1:] for r in got.collect()) == expected(texts)


def test_groups_and_empty_table(spark, documents):
    docs = documents(["日本 the", None], ids=[None, None])
    rows = {r.groups for r in token_align.aligned(docs, A, B, texts=True).collect()}
    assert rows == {";".join(plain("日本 the")[2]), ""}
    assert token_align.align_documents(docs.limit(0), A, B).collect() == []


def test_coarse_cuts_never_split_a_character():
    both = token_align.aligner(A, B)
    text = " 𝒳 é日本🙂"
    ids_a, ends_a, ids_b, ends_b = both.tokens(text)
    assert [ends_a[-1], ends_b[-1]] == [len(text.encode())] * 2
    assert [bytes(text.encode()[s:e]) for s, e in zip([0, *ends_a], ends_a)] == [both.bytes_a[i] for i in ids_a]
    assert [bytes(text.encode()[s:e]) for s, e in zip([0, *ends_b], ends_b)] == [both.bytes_b[i] for i in ids_b]


def test_counting_gives_up_the_tokenizers(monkeypatch):
    monkeypatch.setattr(common, "_STORE", {("aligner", "a", "b"): object()})
    links = pa.array([[1, 2, 2, 7], [], [2]], pa.list_(pa.int32()))
    whole = [pa.array([0, 0, 0], pa.int64())] * 4
    rows = pa.RecordBatch.from_arrays([pa.array([5, 6, 7], pa.int64()), *whole, links, pa.array([""] * 3)],
                                      ["row", "doc_id", "n_a", "n_b", "n_groups", "links", "groups_sha256"])
    monkeypatch.setattr(token_align, "LINKS", 2)
    got = pa.Table.from_batches(token_align.with_counts(iter([rows]), np.array([1, 2], np.int32), np.array([1, 3]),
                                                        np.array([0, 1], np.int8))).to_pylist()
    assert [(r["row"], r["n_links"], r["n_best"], r["count_sum"], r["rest"]) for r in got] == [
        (5, 4, 2, 7, [7]), (6, 0, 0, 0, []), (7, 1, 1, 3, [])]
    assert list(common._STORE) == ["pair-counts"]


def test_units_are_those_of_the_plain_rules():
    import random
    import re
    rng = random.Random(3)
    uneven = re.compile(r"\s\s|\s$|[\0\x1c-\x1f]")
    alphabet = [*"aé1²½_,.;:!? ", " ", "\n", "\t", "\r", "\x0b", "\x85", "\xa0", " ", "　", "\0", "\x1c", "\x1f"]
    both = token_align.aligner(A, B)
    for k in range(20000):
        text = "".join(rng.choice(alphabet[:16] if k % 2 else alphabet) for _ in range(rng.randrange(1, 12)))
        even = not (text[0].isspace() or uneven.search(text))
        assert token_align.even_space(text) == even, repr(text)
        assert "".join(both.cut(text)) == " " + text
        if even:
            marked = token_align.MARK.sub("\0", " " + text.replace(" ", "\0 ").replace("\n", "\0\n"))
            assert both.cut(text) == marked.split("\0"), repr(text)
