import collections
import random

import numpy as np
from pyspark.sql import functions as F

from channelwise.llm import minhash
from channelwise.llm.components import components

from .conftest import CLASHING, words


def brute_classes(rows, threshold=0.8):
    sets = {}
    for i, text in rows.items():
        w = (text or "").lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else {("", text or "")}
    root = {i: i for i in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(rows)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both / (len(sets[a]) + len(sets[b]) - both) >= threshold:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def classes(df):
    return {r.doc: r["class"] for r in minhash.near_duplicates(df).collect()}


def test_signature_estimates_weighted_jaccard():
    rng = np.random.default_rng(3)
    for weighted in (False, True):
        off = []
        for _ in range(40):
            a = np.sort(rng.integers(0, 1 << 62, size=rng.integers(1, 300)).astype(np.uint64))
            b = np.unique(np.concatenate([a[: rng.integers(0, len(a) + 1)], rng.integers(
                0, 1 << 62, size=rng.integers(1, 40)).astype(np.uint64)]))
            wa, wb = (rng.integers(1, 9, len(x)) + rng.random(len(x)) if weighted else np.ones(len(x)) for x in (a, b))
            agree = (minhash.signature(a, wa) == minhash.signature(b, wb)).mean()
            off.append(agree - minhash.similarity(a, b, wa, wb))
        assert abs(np.mean(off)) < 0.02 and np.std(off) < 0.06


def test_classes_equal_brute_force(documents):
    rng = random.Random(1)
    texts = []
    for _ in range(25):
        base = words(rng, rng.randint(30, 200), 5000)
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 4)):  # copies of falling likeness, near the threshold too
            copy = list(base)
            for _ in range(rng.randint(0, 6)):
                copy[rng.randrange(len(copy))] = f"z{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
    assert classes(documents(texts)) == brute_classes(dict(enumerate(texts)))


def test_large_group_of_near_copies_is_linear_in_pairs(documents):
    rng = random.Random(2)
    base = words(rng, 300, 5000)
    texts = []
    for _ in range(150):
        copy = list(base)
        for _ in range(rng.randint(2, 7)):
            copy[rng.randrange(len(copy))] = f"z{rng.randrange(10**6)}"
        texts.append(" ".join(copy))
    assert classes(documents(texts)) == brute_classes(dict(enumerate(texts)))


def test_link_between_members_that_both_fail_with_the_leader(documents):
    """A chain whose ends are unlike each other still becomes one class."""
    rng = random.Random(4)
    base = words(rng, 400, 9000)
    chain = [" ".join([*base[k * 20:], *[f"t{k}x{j}" for j in range(k * 20)]]) for k in range(8)]
    assert classes(documents(chain)) == brute_classes(dict(enumerate(chain)))


def test_components_equal_union_find(spark):
    rng = random.Random(8)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + k, 1001 + k) for k in range(40)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    near = collections.defaultdict(set)
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    for node, root in got.items():
        seen, todo = {node}, [node]
        while todo:
            for y in near[todo.pop()] - seen:
                seen.add(y)
                todo.append(y)
        assert root == min(seen)


def test_awkward_rows(awkward):
    got = {(r.doc, r["class"], r["size"]) for r in minhash.near_duplicates(awkward).collect()}
    by_doc = {d: c for d, c, _ in got}
    assert by_doc[1] == 0 and by_doc[0] == 0  # null counts as empty
    assert by_doc[2] == 2 and by_doc[6] == 5 and by_doc[8] == 7 and by_doc[9] == 9
    kept = minhash.keep_one(awkward)
    assert kept.columns == awkward.columns
    rows = kept.collect()
    assert sorted((r.doc_id for r in rows), key=str) == sorted([0, 2, 3, 4, 5, 7, 9, 10, 11, 12, 13, 5], key=str)
    assert sorted(r.text for r in rows if r.doc_id == 5) == ["same text here", "tail"]


def test_empty_table_and_clashing_columns(documents):
    assert minhash.near_duplicates(documents([]).limit(0)).count() == 0
    df = documents(["a b c d e f", "a b c d e f", "other words"])
    for c in CLASHING:
        df = df.withColumn(c, F.lit(7))
    kept = minhash.keep_one(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {0, 2}
