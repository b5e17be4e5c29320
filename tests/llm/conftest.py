import random

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns whose names operators use inside or return.
CLASHING = ("size", "taken", "target", "node", "doc", "t", "score", "class", "label", "text_", "shard")


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture
def documents(spark):
    def make(texts, sources=None, ids=None):
        ids = range(len(texts)) if ids is None else ids
        rows = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in
                zip(ids, texts, sources or ["src"] * len(texts))]
        return spark.createDataFrame(rows, DOCUMENTS).repartition(3)
    return make


@pytest.fixture
def awkward(documents):
    """Nulls in every column, empty and long texts, ties, repeated rows."""
    rng = random.Random(5)
    long_text = " ".join(words(rng, 30_000))
    texts = [None, "", " \n\t", "a", "one two", "same text here", "same text here", long_text, long_text, "x" * 50_000,
             "é" * 3000, "line\nline\nline", "\x00 \x1f odd", "日本語 テキスト"]
    df = documents(texts, [None, "a", "b", None, "a", "a", "b", "a", "b", "c", "c", None, "a", "b"])
    extra = documents([None, "tail", "tail"], [None, "a", "a"], [None, 5, 5])
    return df.unionByName(extra)
