"""Language-model scores against a plain suffix tree over words."""
import math
import random
import re
import zlib
from collections import Counter

import pytest

from channelwise.llm import suffix_tree

from .conftest import CLASHING

END = ""


def words(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", text), END]


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


class Plain:
    """Contexts as tuples of words, probabilities by recursion."""

    def __init__(self, texts, depth, min_count, min_gain):
        self.c = Counter(w for t in texts for w in t)
        self.total, self.distinct = sum(self.c.values()), len(self.c)
        follow = {}
        for t in texts:
            for i in range(len(t)):
                for d in range(1, min(depth, i) + 1):
                    follow.setdefault(tuple(t[i - d:i]), Counter())[t[i]] += 1
        self.kept = {}
        for context in sorted(follow, key=len):
            k, n = follow[context], sum(follow[context].values())
            if n < min_count or not any(x > 1 for x in k.values()):
                continue
            kinds, gain = len(k), 0.0
            for w, x in k.items():
                parent = self.p(context[1:], w)
                left = (max(x - 2, 0) + (kinds - (x == 1)) * parent) / (n - 1)
                gain += x * math.log(left / parent)
            if gain > min_gain:
                self.kept[context] = k, n, kinds

    def p(self, context, w):
        while context and context not in self.kept:
            context = context[1:]
        if not context:
            return (self.c[w] + 1) / (self.total + self.distinct + 1)
        k, n, kinds = self.kept[context]
        return (max(k[w] - 1, 0) + kinds * self.p(context[1:], w)) / n

    def row(self, text, depth):
        return (len(text), sum(self.c[w] > 0 for w in text), self.total, sum(math.log10(self.p((), w)) for w in text),
                sum(math.log10(self.p(tuple(text[max(0, i - depth):i]), w)) for i, w in enumerate(text)))


def corpus():
    rng = random.Random(11)
    out = [None, "", " \n", "one", "Ünï A É", "x" * 3000, "the end", "the end"]
    for _ in range(260):
        line = []
        for _ in range(rng.randrange(2, 40)):
            line += rng.choice([["n0", "x", "y", "m0"], ["n1", "x", "y", "m1"], ["of", "the"], ["in", "a", "very"], [f"w{rng.randrange(60)}"], ["The", f"v{rng.randrange(9)}", "ends"]])
        out.append(rng.choice([" ", "\n", "\t "]).join(line))
    return out


@pytest.mark.parametrize("depth, table_keys, bitmap_words", [(2, 1 << 16, 1 << 12), (3, 40, 1 << 12), (1, 0, 8)])
def test_equals_plain_tree(spark, documents, depth, table_keys, bitmap_words):
    texts = corpus()
    ids = [None, *range(1, len(texts) - 1), 5]
    docs = documents(texts, ids=ids)
    for name in (*CLASHING, "tokens", "key", "n"):
        docs = docs.withColumn(name, docs.text)
    tokens = suffix_tree.prepared(docs)
    tree = suffix_tree.fit(tokens, depth, 8, 2.0, bitmap_words)
    got = suffix_tree.score(tokens, tree, depth, table_keys, bitmap_words)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    plain = Plain([words(t) for t, i in zip(texts, ids) if not is_held_out(i)], depth, 8, 2.0)
    assert any(len(c) == depth for c in plain.kept)
    want = sorted(((i is None, i or 0), is_held_out(i), *plain.row(words(t), depth)) for t, i in zip(texts, ids))
    rows = sorted(((r[0] is None, r[0] or 0), *r[1:]) for r in got.collect())
    assert [r[:5] for r in rows] == [r[:5] for r in want]
    for r, w in zip(rows, want):
        assert r[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)


def test_slices_give_the_same_scores(spark, documents):
    tokens = suffix_tree.prepared(documents(corpus()))
    tree = suffix_tree.fit(tokens, 2, 8, 2.0, 1 << 12)
    want, *others = [sorted(map(tuple, suffix_tree.score(tokens, tree, 2, 40, 1 << 12, n).collect())) for n in (1, 3, 4)]
    for got in others:  # whatever the number divides 2 ** 64
        assert [r[:5] for r in got] == [r[:5] for r in want]
        assert [x for r in got for x in r[5:]] == pytest.approx([x for r in want for x in r[5:]], rel=1e-9, abs=1e-9)


def test_probabilities_sum_to_one():
    texts = [words(t) for t in corpus()]
    plain = Plain(texts, 2, 8, 2.0)
    for context in [(), ("of",), ("in", "a"), ("the",)]:
        assert sum(plain.p(context, w) for w in [*plain.c, "unknown"]) == pytest.approx(1)


def test_empty_and_untrained(spark, documents):
    docs = documents(["a b", None], ids=[3, 4])
    tokens = suffix_tree.prepared(docs.limit(0))
    assert suffix_tree.score(tokens, suffix_tree.fit(tokens)).collect() == []
    held = [i for i in range(100) if is_held_out(i)][:2]
    tokens = suffix_tree.prepared(documents(["a b", None], ids=held))
    rows = {r.doc_id: r for r in suffix_tree.score(tokens, suffix_tree.fit(tokens)).collect()}
    assert [tuple(rows[i])[1:] for i in held] == [(True, 3, 0, 0, 0.0, 0.0), (True, 1, 0, 0, 0.0, 0.0)]


def test_held_out_texts_are_better_predicted_than_by_words_alone(spark):
    got = suffix_tree.op13_lm_scores(spark, "/root/testdata/sf0.01").filter("held_out").collect()
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_tokens_of_texts():
    texts = ["", "a  b\n", "B A", "ab", "é a", " ", "\x0bab\tA"]
    import pyarrow as pa
    tokens, place, sizes = suffix_tree.tokens_of(pa.array(["skipped words", *texts])[1:])
    want = [words(t) for t in texts]
    assert sizes.tolist() == [len(w) for w in want] and place.tolist() == [i for w in want for i in range(len(w))]
    names = {}
    for word, token in zip([x for w in want for x in w], tokens.tolist()):
        assert names.setdefault(word, token) == token
    assert len(set(names.values())) == len(names)


def test_a_token_asks_for_one_key_of_each_length(spark, documents, monkeypatch):
    tokens = suffix_tree.prepared(documents(corpus()[:60]))
    tree = suffix_tree.fit(tokens, 2, 8, 2.0, 1 << 12)
    written, write = {}, suffix_tree.materialize
    monkeypatch.setattr(suffix_tree, "materialize", lambda df, name: written.setdefault(name, write(df, name)))
    suffix_tree.score(tokens, tree, 2, 0, 1)  # no table, and a bitmap full of bits
    rows = written["lm-scores"]
    asked = [f.name for f in rows.schema if f.dataType.simpleString() == "array<bigint>"]
    for r in rows.collect():  # single tokens, pairs and triples
        assert sum(len(r[c]) for c in asked) <= 3 * r.n_tokens
    assert tree.keys.count() == tree.keys.select("key").distinct().count()


@pytest.mark.parametrize("bucket", [1 << 20, 20])
def test_pairs_of_contexts_dealt_over_buckets(spark, documents, bucket):
    texts = corpus()
    training = suffix_tree.prepared(documents(texts)).filter("not held_out")
    follow = {}
    for i, t in enumerate(texts):
        if not is_held_out(i):
            for context, token in zip(words(t), words(t)[1:]):
                follow.setdefault(context, Counter())[token] += 1
    want = sorted((sum(c.values()), sum(k == 1 for k in c.values()), sorted(k for k in c.values() if k > 1))
                  for c in follow.values() if sum(c.values()) >= 8 and max(c.values()) > 1)
    counts = suffix_tree.unigrams(training)
    total = counts.agg({"c": "sum"}).first()[0]
    often = counts.filter((counts.c >= 8) & (counts.token != suffix_tree.END_VALUE)).selectExpr("0L AS zero", "token", "c AS N")
    candidates = suffix_tree._keyed(often, ["zero", "token"], "context").select("context", "N")
    got = {}
    for r in suffix_tree.pairs(training, 1, candidates, total, 8, 1 << 12, bucket).collect():
        c = got.setdefault(r.c1, [0, 0, 0, []])
        if r.token is None:  # of a context, or a part of it
            c[0], c[1], c[2] = c[0] + r.k, c[1] + r.once, c[2] + r.kinds
        else:
            c[3].append(r.k)
    assert sorted((n, once, sorted(k)) for n, once, _, k in got.values() if k) == want
    assert all(kinds == len(k) for _, _, kinds, k in got.values())


def test_no_row_for_each_pair_or_key_goes_through_a_shuffle(spark, documents, monkeypatch):
    tokens, plans, write = suffix_tree.prepared(documents(corpus()[:60])), {}, suffix_tree.materialize

    def materialize(df, name):
        plans.setdefault(name, []).append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(suffix_tree, "materialize", materialize)
    suffix_tree.score(tokens, suffix_tree.fit(tokens, 1, 8, 2.0, 1 << 12), 1, 0, 1 << 12, 1)
    for plan in plans["lm-pairs"] + plans["lm-answers"]:
        dealt = [line.split("hashpartitioning(")[1] for line in plan.splitlines() if "hashpartitioning(" in line]
        assert dealt and all(x.startswith(("bucket#", "block#")) for x in dealt)
        assert "explode" not in plan
