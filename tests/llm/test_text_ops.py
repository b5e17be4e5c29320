"""Token counts, BPE, fingerprints and substring deduplication against plain versions."""
import hashlib
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from channelwise.llm import bpe, syncmers, token_counts, unit_dedup
from channelwise.llm.bpe_core import BYTE_SYMBOLS, Decoder, MergeList, Transducer, merge_all

from .conftest import CLASHING, words

tokenizers = pytest.importorskip("tokenizers")
WORD_FILE, BYTE_FILE = bpe.tokenizer_path("word_bpe_49k.json"), bpe.tokenizer_path("byte_bpe_50k.json")
ODD = ["", "  a  b \n\n c\t\td  ", "<|endoftext|>x <|endoftext|> y<|startoftext|>", "\x1c a\x1fb", "é́ ſ İ x\u0085z　q",
       " lead", "tail \n", "a\nb\n\nc d", "x" * 3000 + " " + "ab" * 2000, "a\n b", "a \nb", "\n", "a\n", "\na",
       "it's we'll I'D", "日本語 テキスト 123 4.5", "\x00 a\x00b \x00", "Ā Ġ ĠĀ"]


@pytest.fixture(autouse=True)
def quiet():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("path", [WORD_FILE, BYTE_FILE])
def test_codec_equals_library(path):
    library, codec = tokenizers.Tokenizer.from_file(path), bpe.Codec(path)
    rng = random.Random(0)
    texts = ODD + [" ".join(rng.choice(["the", "Ing", "tion", "o'er", "42", "é", "x."]) * rng.randint(1, 4)
                            for _ in range(80)) for _ in range(20)]
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        assert codec.encode(text) == want, text[:40]
        decoded = library.decode(want, skip_special_tokens=False)
        assert codec.decode(want) == decoded
        assert codec.digests(text, block=3) == (len(want), sha(" ".join(map(str, want))), sha(decoded))


def test_transducer_streams_in_bounded_memory():
    merges = MergeList.load(WORD_FILE)
    stream = Transducer(merges)
    library = tokenizers.Tokenizer.from_file(WORD_FILE)
    rng = random.Random(1)
    for alphabet in ("ab", "aeionst", "a", "é", "thernd"):
        word = "".join(rng.choice(alphabet) for _ in range(6000))
        symbols = "".join(BYTE_SYMBOLS[b] for b in word.encode())
        out, most = [], 0
        for at in range(0, len(symbols), 7):
            out += stream.feed(symbols[at:at + 7])
            most = max(most, len(stream.pending))
        out += stream.finish()
        assert out == library.encode(word, add_special_tokens=False).tokens
        assert most <= 4 * stream.lookahead


def test_lookahead_is_sufficient_for_random_merge_lists():
    """Whatever follows, tokens that end ``lookahead`` symbols before it stay."""
    rng = random.Random(2)
    for _ in range(30):
        vocab, merges = ["a", "b", "c"], []
        while len(merges) < 12:
            pair = rng.choice(vocab), rng.choice(vocab)
            if pair not in merges and len(pair[0] + pair[1]) <= 8:
                merges.append(pair)
                vocab.append(pair[0] + pair[1])
        spec = {"model": {"vocab": {v: i for i, v in enumerate(dict.fromkeys(vocab))}, "merges": merges}}
        m = MergeList(spec)
        for _ in range(20):
            text = "".join(rng.choice("abc") for _ in range(300))
            stream = Transducer(m, window=1)
            assert [*stream.feed(text), *stream.finish()] == merge_all(list(text), m.ranks)


def test_decoder_holds_split_characters():
    merges = MergeList.load(BYTE_FILE)
    ids = tokenizers.Tokenizer.from_file(BYTE_FILE).encode("a日é🙂b", add_special_tokens=False).ids
    decoder = Decoder(merges, "bytes")
    assert "".join(decoder.push([i]) for i in ids) + decoder.close() == "a日é🙂b"
    decoder = Decoder(merges, "bytes")
    assert decoder.push(ids[1:2]) + decoder.close() == tokenizers.Tokenizer.from_file(BYTE_FILE).decode(ids[1:2])


def test_bpe_and_counts_over_tables(awkward):
    word, byte = tokenizers.Tokenizer.from_file(WORD_FILE), tokenizers.Tokenizer.from_file(BYTE_FILE)
    df = awkward
    for c in CLASHING:
        df = df.withColumn(c, F.lit("x"))
    want = sorted(((r.doc_id, r.text or "") for r in awkward.collect()), key=str)
    got = sorted(map(tuple, bpe.encode_digests(df, WORD_FILE).collect()), key=str)
    ids = [(d, word.encode(t, add_special_tokens=False).ids) for d, t in want]
    assert got == sorted(((d, len(i), sha(" ".join(map(str, i))), sha(word.decode(i, skip_special_tokens=False)))
                          for d, i in ids), key=str)
    counted = sorted(map(tuple, token_counts.count_tokens(df, BYTE_FILE).collect()), key=str)
    n = [(d, t, len(byte.encode(t, add_special_tokens=False).ids)) for d, t in want]
    assert counted == sorted(((d, len(t.encode()), k, k > 512) for d, t, k in n), key=str)
    back = bpe.decode_ids(bpe.encode_ids(df, BYTE_FILE), BYTE_FILE)
    assert sorted((tuple(r) for r in back.collect()), key=str) == want
    assert bpe.encode_digests(df.limit(0), WORD_FILE).count() == token_counts.count_tokens(df.limit(0), BYTE_FILE).count() == 0


def test_piece_model_counts(documents):
    import sentencepiece
    path = bpe.tokenizer_path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["the cat  sat", None, "", "日本 <s> x"]
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(documents(texts), path).collect()}
    assert got == {i: len(model.encode(t or "")) for i, t in enumerate(texts)}


def test_counts_equal_library_on_odd_texts():
    library, counts = tokenizers.Tokenizer.from_file(BYTE_FILE), token_counts.Counts(BYTE_FILE, {" the": 1})
    for text in [*ODD, "the the\nthe  the"]:
        assert counts.count(text) == len(library.encode(text, add_special_tokens=False).ids), text[:40]


# ---------------------------------------------------------------- fingerprints

def brute_syncmers(text):
    c = syncmers.codes(text)
    if len(c) < syncmers.K:
        return None
    h = [int(x) for x in syncmers.mix64(syncmers._polynomials(c))]
    out = []
    for at in range(len(c) - syncmers.K + 1):
        inner = h[at:at + syncmers.K - syncmers.S + 1]
        if min(inner) in (inner[0], inner[-1]):
            out.append(at)
    return out


def test_syncmers_are_closed_and_context_free(monkeypatch):
    rng = random.Random(3)
    for _ in range(30):
        text = "".join(rng.choice("abcdé 日") for _ in range(rng.randint(20, 400)))
        places, hashes = syncmers.syncmers(syncmers.codes(text))
        assert list(places) == brute_syncmers(text)
        shifted, again = syncmers.syncmers(syncmers.codes("zzz" + text + "yyy"))
        held = {int(p) - 3: int(h) for p, h in zip(shifted, again)}
        assert all(held[int(p)] == int(h) for p, h in zip(places, hashes))
        monkeypatch.setattr(syncmers, "CHUNK", 37)
        cut = syncmers.syncmers(syncmers.codes(text))
        monkeypatch.setattr(syncmers, "CHUNK", 1 << 18)
        assert np.array_equal(cut[0], places) and np.array_equal(cut[1], hashes)


def test_fingerprints_follow_descending_ids(spark, awkward, documents):
    rng = random.Random(4)
    texts = [" ".join(words(rng, rng.randint(0, 300))) for _ in range(40)]
    for df in (documents(texts), documents(texts[:1]), awkward):
        rows = [(r.doc_id, r.text or "", r.h) for r in df.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()]
        rows.sort(key=lambda r: (r[0] is None, -(r[0] or 0), r[2]))
        want = []
        for k, (d, t, _) in enumerate(rows):
            following = rows[(k + 1) % len(rows)][1]
            third = len(t) // 3
            edited = t[:len(t) - third] + following[:third]
            a, b, c = (syncmers.Document(x).fingerprint for x in (t, edited, following))
            want.append((d, len(t), sha(edited), a.hex(), b.hex(), syncmers.likeness(a, b), syncmers.likeness(a, c)))
        got = [tuple(r) for r in syncmers.fingerprints(df).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert syncmers.fingerprints(awkward.limit(0)).count() == 0


def test_likeness_estimates_overlap():
    rng = random.Random(5)
    off = []
    for _ in range(20):
        a, b = (" ".join(words(rng, 400, 10**6)) for _ in range(2))
        for share in (0.25, 0.5, 0.9):
            cut = int(len(a) * share)
            mixed = a[:cut] + b[:len(a) - cut]
            x, y = (set(syncmers.syncmers(syncmers.codes(t))[1].tolist()) for t in (a, mixed))
            exact = len(x & y) / len(x | y)
            off.append(syncmers.likeness(syncmers.Document(a).fingerprint, syncmers.Document(mixed).fingerprint) - exact)
    assert abs(np.mean(off)) < 0.03 and max(map(abs, off)) < 0.25
    assert syncmers.likeness("", "") == 1.0 and syncmers.likeness("", "00000001") == 0.0


# ---------------------------------------------------------------- repeated units

def brute_repeats(rows, least):
    """Texts after removal of passages of ``least`` characters, from (doc_id, text) with distinct ids."""
    first = {}
    for d, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        for unit, start, _ in unit_dedup.units(t or ""):
            first.setdefault(unit, (d, start))
    out = {}
    for d, t in rows:
        spans, run = [], None
        for unit, start, end in [*unit_dedup.units(t or ""), (None, 0, 0)]:
            if unit is not None and first[unit] != (d, start):
                run, last = (start if run is None else run), end
            else:
                if run is not None and last - run >= least:
                    spans.append((run, last))
                run = None
        out[d] = unit_dedup.cut(t, spans) if spans else t
    return out


def test_repeated_passages_equal_brute_force(documents):
    rng = random.Random(6)
    shared = [" ".join(words(rng, 60)).replace(" w7", ". W7") + "." for _ in range(4)]
    texts = []
    for _ in range(60):
        parts = [" ".join(words(rng, rng.randint(3, 40))) + rng.choice([".", "!", ""]) for _ in range(rng.randint(1, 6))]
        if rng.random() < 0.5:
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(shared))
        texts.append(rng.choice(["\n", " "]).join(parts))
    texts += [texts[0], None, "", texts[1].upper(), "short.\nshort.\nshort."]
    df = documents(texts)
    got = {r.doc_id: r.text for r in unit_dedup.remove_repeats(df).collect()}
    assert got == brute_repeats(list(enumerate(texts)), unit_dedup.MIN_CHARS)
    clean = [k for k, t in got.items() if t == texts[k]]
    assert len(clean) > 10 and got[0] == texts[0]


def test_offsets_are_those_of_the_original(documents):
    passage = "Alpha " * 39 + "end."
    texts = [f"Intro one.\n{passage}\nOutro one.", f"Intro two.\n{passage}\nOutro two.", f"In line. {passage} After it."]
    found = {r.doc: (r.start, r.end) for r in unit_dedup.repeated_passages(documents(texts)).collect()}
    assert {d: texts[d][a:b].strip() for d, (a, b) in found.items()} == {1: passage, 2: passage}
    got = {r.doc_id: (r.text, r.n_chars) for r in unit_dedup.remove_repeats(documents(texts)).collect()}
    assert got[1] == ("Intro two.\nOutro two.", len("Intro two.\nOutro two."))


def held_before(texts, n=50, distinct=20):
    """Places (text, word) of the n-grams of words that an earlier text holds too."""
    seen, out = set(), []
    for k, text in enumerate(texts):
        w = text.lower().split()
        grams = [tuple(w[i:i + n]) for i in range(len(w) - n + 1)]
        out += [(k, i) for i, g in enumerate(grams) if g in seen and len(set(g)) >= distinct]
        seen.update(grams)
    return out


def test_no_repeated_50_grams_are_left(documents):
    """Passages that start and end inside sentences, with few words in whole sentences; short repeated units."""
    rng = random.Random(8)
    texts = []
    for k in range(6):
        tail, whole, head = (" ".join(words(rng, n, 10**6)) for n in (18, 22, 18))
        for j in range(3):
            own = [" ".join(words(rng, 8, 10**6)) for _ in range(4)]
            texts.append(f"{own[0]}. {own[1]} {tail}. {whole}. {head} {own[2]}. Same to all.\n日本語の同じ行\n{own[3]}.")
    assert len({k for k, _ in held_before(texts)}) == 12
    got = [r.text for r in unit_dedup.remove_repeats(documents(texts)).orderBy("doc_id").collect()]
    assert held_before(got) == []
    assert got[0] == texts[0]


def test_short_repeats_go_only_within_longer_passages(documents):
    long = "a sentence of more than forty characters that repeats"
    texts = [f"Yes. {long}. One.", f"Own words. Yes. {long}. Two.", f"Yes. Three other words. {long}."]
    got = [r.text for r in unit_dedup.remove_repeats(documents(texts)).orderBy("doc_id").collect()]
    assert got == [texts[0], "Own words. Two.", "Yes. Three other words."]


def test_rows_that_share_an_id_or_have_none_are_documents(documents):
    rng = random.Random(11)
    passages = [" ".join(words(rng, 60, 10**6)) + "." for _ in range(3)]
    ids = [None] * 6 + [3] * 6 + [None, 3, 8]
    texts = [f"{' '.join(words(rng, 5, 10**6))}. {passages[0 if i is None else 1]}" for i in ids[:12]]
    texts += [f"{' '.join(words(rng, 5, 10**6))}. {passages[2]}" for _ in range(3)]
    rows = unit_dedup.remove_repeats(documents(texts, ids=ids)).collect()
    assert len(rows) == len(texts) and held_before([r.text for r in rows]) == []
    for p, i in zip(passages, (None, 3, 3)):
        assert [r.doc_id for r in rows if p in r.text] == [i]
    assert all(any(r.text.startswith(t.partition(".")[0]) for r in rows) for t in texts)


def test_awkward_repeats(awkward):
    df = awkward
    for c in CLASHING:
        df = df.withColumn(c, F.lit(1))
    got = unit_dedup.remove_repeats(df)
    assert got.columns == df.columns and got.count() == df.count()
    by = {r.doc_id: r for r in got.collect() if r.doc_id is not None}
    assert by[0].text is None and by[7].text and by[8].text == "" and by[8].n_chars == 0
    assert unit_dedup.remove_repeats(awkward.limit(0)).count() == 0


def test_codec_keeps_as_many_words_as_it_is_given_room_for(monkeypatch):
    text, asked = " ".join(f"word{i}x" for i in range(3000)), []
    for entries, again in ((6000, False), (200, True)):
        codec = bpe.Codec(bpe.tokenizer_path("word_bpe_49k.json"), entries)
        first = codec.digests(text)
        work = codec._encode_pieces
        asked.clear()
        monkeypatch.setattr(codec, "_encode_pieces", lambda pieces: asked.extend(pieces) or work(pieces))
        assert codec.digests(text) == first and bool(asked) == again


def test_merges_by_ids_are_those_by_strings():
    import random
    codec = bpe.Codec(WORD_FILE)
    vocab, rng = codec.merges.vocab, random.Random(7)
    symbols = [s for s in BYTE_SYMBOLS if s in vocab]
    words = ["a", "the", "internationalization", "ab" * 40, "0", symbols[0]]
    words += ["".join(rng.choice("etaoinshr" if k % 3 else symbols) for _ in range(rng.randrange(1, 30))) for k in range(600)]
    for w in words:
        assert codec.stream.ids(w) == [vocab[t] for t in codec.stream.word(w)], w
    assert codec.stream.rules and codec.stream.ids("x" * 4000) == [vocab[t] for t in codec.stream.word("x" * 4000)]
    # a rule whose token has no id leaves the merges to the strings
    few = MergeList({"model": {"vocab": {"a": 0, "b": 1, "c": 2, "bc": 3}, "merges": ["a b", "b c"]}})
    assert Transducer(few).rules == {} and Transducer(few).ids("bca") == [3, 0]
    more = MergeList({"model": {"vocab": {"a": 0, "b": 1, "c": 2, "bc": 3, "ab": 4}, "merges": ["b c", "a b"]}})
    assert Transducer(more).ids("abcab") == [0, 3, 4]
