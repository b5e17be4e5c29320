"""Mixing, classifiers, nearest neighbours, archives and the pipeline."""
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from channelwise.llm import ann_graph, arc_convert, common, minhash, mixing, quality_gam, toxicity, unit_dedup
from channelwise.llm.queries import ORACLE_SQL, QUERIES

from .conftest import CLASHING, words

DATA = "/root/testdata/sf0.001"
LABELS = "doc_id long, quality int, toxic int"


def fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3


# ---------------------------------------------------------------- mixing

def brute_targets(sizes):
    """Share by weight, cap, share the excess again until none is above."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    left, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > 2 * sizes[s]}
        if not over:
            return target | {s: left * weight[s] / total for s in open_}
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def mixed(df):
    rows = df.withColumn("size", mixing.size_of())
    return mixing.mix(rows, [F.col("doc_id"), F.xxhash64("text")])


def test_mix_meets_targets(documents):
    rng = random.Random(1)
    texts = [" ".join(words(rng, rng.randint(0, 60))) for _ in range(300)]
    sources = [rng.choice(["hot"] * 20 + ["a", "b", "ç", "Z", None]) for _ in texts]
    rows = mixed(documents(texts, sources)).collect()
    sizes = {}
    for t, s in zip(texts, sources):
        sizes[s] = sizes.get(s, 0) + len(t.split())
    want = brute_targets(sizes)
    for s in sizes:
        own = [r for r in rows if r.source == s]
        assert {r.source_size for r in own} == {sizes[s]}
        assert all(math.isclose(r.target, want[s]) for r in own)
        assert sum(r.taken for r in own) == math.floor(own[0].target + 0.5)
        assert all(0 <= r.taken <= 2 * r.size for r in own)
    again = mixed(documents(texts, sources).repartition(7)).collect()
    assert sorted((r.doc_id, r.taken) for r in rows) == sorted((r.doc_id, r.taken) for r in again)


def test_drawn_rows_hold_the_words_taken(documents):
    rng = random.Random(2)
    texts = ["  ".join(words(rng, rng.randint(0, 30))) + "\n" for _ in range(80)]
    df = documents(texts, [rng.choice("abcd") for _ in texts])
    taken = {r.doc_id: r.taken for r in mixed(df).collect()}
    got = {}
    for r in mixing.stage(None, df, DATA).collect():
        size = len(re.findall(mixing.WORD_RUN, r.text))
        assert texts[r.doc_id].startswith(r.text) and r.n_chars == len(r.text)
        got[r.doc_id] = got.get(r.doc_id, 0) + size
    assert got == {d: n for d, n in taken.items() if n}


def test_awkward_mix(awkward):
    df = awkward
    for c in CLASHING:
        df = df.withColumn(c, F.lit("own"))
    got = mixing.stage(None, df, DATA)
    assert got.columns == df.columns and {r.size for r in got.collect()} == {"own"}
    assert mixing.stage(None, awkward.limit(0), DATA).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(awkward.withColumn("size", F.lit(1)).withColumn("taken", F.lit(1)), [F.col("doc_id")])


# ---------------------------------------------------------------- toxicity

def brute_segments(positives, n, drift):
    """Maximal segments by definition: the best one, then the same left and right of it."""
    score = [drift] * n
    for i, s in positives:
        score[i] = s
    out = []

    def split(a, b):
        best, where, run, start = 0.0, None, 0.0, a
        for i in range(a, b):
            if run <= 0:
                run, start = 0.0, i
            run += score[i]
            if run > best + 1e-12:
                best, where = run, (start, i + 1)
        if where:
            split(a, where[0])
            out.append((best, where[0], where[1] - 1))
            split(where[1], b)

    split(0, n)
    return out


def test_segments_equal_definition():
    rng = random.Random(3)
    for _ in range(300):
        n = rng.randint(1, 60)
        positives = [(i, rng.uniform(0.1, 4)) for i in range(n) if rng.random() < 0.3]
        drift = -rng.uniform(0.2, 2)
        got, want = toxicity.segments(positives, drift), brute_segments(positives, n, drift)
        assert [(a, b) for _, a, b in got] == [(a, b) for _, a, b in want]
        assert np.allclose([s for s, *_ in got], [s for s, *_ in want])


def labelled(spark, n=1500, seed=4):
    rng = random.Random(seed)
    bad = ["idiotes", "scumbag", "vermint"]
    texts, labels = [], []
    for i in range(n):
        w, toxic = words(rng, rng.randint(20, 200), 3000), int(rng.random() < 0.15)
        for _ in range(rng.randint(3, 8) * toxic):
            w.insert(rng.randrange(len(w)), rng.choice(bad))
        junk = int(rng.random() < 0.2)
        texts.append(" ".join(x.upper() + "!!" if junk else x for x in w))
        labels.append((i, 1 - junk, toxic))
    return texts, spark.createDataFrame(labels, LABELS), {i: (q, t) for i, q, t in labels}


def test_toxicity_on_held_out_rows(spark, documents):
    texts, labels, truth = labelled(spark)
    df = documents(texts)
    model = toxicity.fit(df, labels, bound=700)
    rows = toxicity.score_documents(df, model).collect()
    assert all(r.held_out == (fold(r.doc_id) == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == truth[r.doc_id][1] for r in held]) > 0.97
    assert np.mean([r.predicted for r in held if not truth[r.doc_id][1]]) < 0.01
    kept = {r.doc_id for r in toxicity.keep_clean(df, model).collect()}
    assert kept == {r.doc_id for r in rows if not r.predicted}
    spans = toxicity.toxic_passages(df, model).collect()
    assert spans and all(any(x in texts[r.doc_id][r.start:r.end].lower() for x in ("idiot", "scum", "vermin"))
                         for r in spans[:50])


def test_words_known_as_clean_score_by_their_own_counts(spark, documents):
    texts, labels, truth = labelled(spark)
    learned = [i for i in truth if fold(i) != 1 and not truth[i][1]]
    for i in learned[:60]:
        texts[i] += " idiotypic"
    model = toxicity.fit(documents(texts), labels)
    assert model.lexicon.score("idiotes") > 0 and model.lexicon.score("idiotxyz") > 0
    at = toxicity._bucket("idiotypic", 0)
    assert model.lexicon.total[at] >= 60
    assert model.lexicon.score("idiotypic") == 0


def test_fit_counts_all_segments_of_a_long_document(spark, documents):
    """One clean document holds 90 islands; all others hold none."""
    texts, labels, truth = labelled(spark, 900)
    rng = random.Random(9)
    bad = [rng.choice("qxz") + "".join(rng.choice("abcdefghijk") for _ in range(9)) for _ in range(90)]
    for i in truth:
        if truth[i][1]:
            texts[i] += " " + " ".join(rng.sample(bad, 60))
    clean = [i for i in truth if fold(i) != 1 and not truth[i][1]]
    texts[clean[0]] = " ".join(" ".join([w, *["w"] * 80]) for w in bad)
    model = toxicity.fit(documents(texts), labels)
    tokens = sum(len(toxicity.WORD.findall(texts[i].lower())) for i in clean)
    islands = model.k * (tokens + 1) / math.exp(model.scale * toxicity.FLOOR) - 1
    assert round(islands) == 90


def test_held_out_labels_are_never_read(spark, documents):
    texts, labels, _ = labelled(spark, 400)
    other = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1,
                                              1 - F.col("toxic")).otherwise(F.col("toxic")))
    df = documents(texts)
    one, two = (sorted(map(tuple, toxicity.score_documents(df, toxicity.fit(df, x)).collect())) for x in (labels, other))
    assert one == two


def test_samples_stay_bounded_where_ids_repeat(spark, documents, monkeypatch):
    rng = random.Random(10)
    texts = [" ".join(words(rng, 20 + k % 50)) for k in range(300)]
    ids = [0] * 200 + list(range(200, 300))
    df = documents(texts + texts[200:], ids=ids + ids[200:])
    labels = spark.createDataFrame([(i, i // 2 % 2, i // 2 % 2) for i in set(ids)], LABELS)
    seen = []
    monkeypatch.setattr(quality_gam, "fit_gam", lambda x, y: seen.append((x, y)))
    features = quality_gam.feature_table(df)
    quality_gam.fit(features, labels, bound=80)
    (x, y), = seen
    assert len(y) <= 80 and set(y) == {0.0, 1.0}
    of = {r.doc_id: list(r.f) for r in features.filter("doc_id >= 200").collect()}
    assert sum(f in x.tolist() for i, f in of.items() if fold(i) != 1) > 5
    monkeypatch.setattr(toxicity, "_logistic", lambda x, y: seen.append((x, y)) or (1.0, 0.0))
    toxicity.fit(df, labels, bound=80)
    assert 0 < len(seen[1][1]) <= 80


def test_awkward_classifiers(spark, awkward):
    labels = spark.createDataFrame([(0, 1, 0), (3, 0, 1), (5, 1, 0), (5, 0, 1), (None, 1, 1), (7, None, None)], LABELS)
    for rows in (labels, labels.limit(0)):
        for df in (awkward, awkward.limit(0), *[awkward.withColumn(c, F.lit(2)) for c in ("label", "score", "f")]):
            assert toxicity.score_documents(df, toxicity.fit(df, rows)).count() == df.count()
            features = quality_gam.feature_table(df)
            got = quality_gam.score_features(features, quality_gam.fit(features, rows)).collect()
            assert len(got) == df.count() and all(0 <= r.score <= 1 for r in got)


# ---------------------------------------------------------------- quality

def test_gam_learns_single_effects_and_interactions():
    rng = np.random.default_rng(5)
    x = rng.random((6000, 5))
    logit = 6 * (x[:, 0] > 0.5) - 3 + 8 * ((x[:, 1] > 0.5) == (x[:, 2] > 0.5)) - 4
    y = (rng.random(6000) < 1 / (1 + np.exp(-logit))).astype(float)
    model = quality_gam.fit_gam(x[:4000], y[:4000])
    assert ((model.score(x[4000:]) >= 0.5) == y[4000:]).mean() > 0.85  # the best possible is 0.865
    assert (1, 2) in {(i, j) for i, j, _ in model.pairs}
    one = model.intercept + sum(t[np.searchsorted(e, x[0, k], side="right")] for k, (e, t) in
                                enumerate(zip(model.edges, model.tables)))
    one += sum(t[np.searchsorted(model.coarse[i], x[0, i], side="right"),
                 np.searchsorted(model.coarse[j], x[0, j], side="right")] for i, j, t in model.pairs)
    assert math.isclose(model.score(x[:1])[0], 1 / (1 + math.exp(-one)))


def test_quality_on_held_out_rows(spark, documents):
    texts, labels, truth = labelled(spark)
    features = quality_gam.feature_table(documents(texts))
    rows = quality_gam.score_features(features, quality_gam.fit(features, labels)).collect()
    assert np.mean([r.predicted == truth[r.doc_id][0] for r in rows if r.held_out]) > 0.97


# ---------------------------------------------------------------- nearest neighbours

def brute_nearest(rows, k=20, every=20):
    ok = {i: np.asarray(v, np.float32) for i, v in rows if i is not None and v and None not in v
          and np.isfinite(v).all() and np.any(v)}
    out = {}
    for q in (i for i in ok if i % every == 0):
        scores = sorted((-float(ok[q].astype(float) @ ok[i].astype(float)), i) for i in ok
                        if i != q and len(ok[i]) == len(ok[q]))
        out[q] = [(i, -s) for s, i in scores[:k]]
    return out


def found(df, **more):
    out = {}
    for r in ann_graph.nearest(df, **more).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_recall_and_scores(spark):
    rng = np.random.default_rng(6)
    v = (rng.normal(size=(3000, 24)) * rng.uniform(0.3, 2, size=(3000, 1))).astype(np.float32)
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    got, want = found(spark.createDataFrame(rows, "vec_id long, embedding array<float>")), brute_nearest(rows)
    assert set(got) == set(want) and all(len(x) == 20 for x in got.values())
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]) > 0.95
    for q, x in got.items():
        assert all(math.isclose(s, float(v[q].astype(float) @ v[i].astype(float)), rel_tol=1e-12) for i, s in x)


def test_copies_ties_and_invalid_vectors(spark):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(30, 8)).astype(np.float32).tolist()
    rows = [(i, base[i % 30] if i % 3 else base[0]) for i in range(200)]
    rows += [(200, None), (220, [0.0] * 8), (240, [float("nan")] * 8), (260, [None] + [1.0] * 7), (280, [float("inf")] * 8),
             (300, []), (320, [1.0, 2.0]), (321, [2.0, 1.0]), (None, base[1]), (40, rows[40][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for c in CLASHING:
        df = df.withColumn(c, F.lit(1))
    got, want = found(df), brute_nearest(rows)
    assert {q: [i for i, _ in x] for q, x in got.items()} == {q: [i for i, _ in x] for q, x in want.items() if x}
    assert found(df.limit(0)) == {}


def test_pruning_keeps_diverse_edges():
    x = np.array([[0, 0], [1, 0], [1.1, 0], [0, 2], [5, 0]], np.float32)
    kept = ann_graph.robust_prune(x, np.array([0]), np.array([[1, 2, 3, 4, -1]]))[0]
    assert [k for k in kept if k >= 0] == [1, 3]


# ---------------------------------------------------------------- archives

def test_arc_versions_round_trip():
    records = [("http://a/ b", "20240101000000", 3, b"x\n\n1 2\r\n\r\n"), (None, "20231231235959", None, b"")]
    for version in (1, 2):
        parsed = list(arc_convert.parse_arc(arc_convert.arc_file("n", version, records)))
        assert [f["URL"] for f, _ in parsed] == ["http://a/%20b", "-"]
        assert len(parsed[0][0]) == len(arc_convert.FIELDS[version])
        rows = [arc_convert.convert(*p) for p in parsed]
        assert [(r[3], r[4], r[6], r[7], r[11]) for r in rows] == [
            ("2024-01-01T00:00:00Z", "response", 3, 10, b"x\n\n1 2\r\n\r\n"), ("2023-12-31T23:59:59Z", "response", None, 0, b"")]


def test_malformed_archives_end_with_an_error_row(spark):
    good = arc_convert.arc_file("n", 1, [("u", "20240101000000", 1, b"abc")])
    files = spark.createDataFrame([("good", good), ("cut", good[:-3]), ("none", b"hello"), ("void", None),
                                   ("v9", good.replace(b"\n1 0", b"\n9 0"))], "path string, content binary")
    kinds = sorted((r.type, r.uri) for r in arc_convert.records(files).collect())
    assert kinds == [("error", "cut"), ("error", "none"), ("error", "v9"), ("error", "void"), ("response", "u")]


def test_warc_round_trip_with_revisits(spark, tmp_path):
    pages = [(5, "http://x/1", "same"), (2, "http://x/2", "same"), (9, None, "same"), (4, "u", None), (1, "u v", ""),
             (7, "w", "d\r\n\r\né"), (None, "n", "same"), (11, "long", "z" * 300_000), (7, "w", "d\r\n\r\né")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("type", F.lit(1))
    path = str(tmp_path / "warc")
    arc_convert.write_warc(arc_convert.page_archives(df), path)
    got = sorted((tuple(r) for r in arc_convert.read_warc(spark, path).collect()), key=str)
    want = []
    for page, _, html in pages:
        data = (html or "").encode()
        first = min(p for p, _, h in pages if p is not None and (h or "") == (html or ""))
        want.append((page, len(data), arc_convert.sha1(data), "response" if page == first else "revisit",
                     None if page == first else first))
    assert got == sorted(want, key=str)
    part = next((tmp_path / "warc").glob("part-*"))
    import gzip
    with gzip.open(part) as f:
        for header, block in arc_convert.parse_warc(f):
            assert header["warc-record-id"].startswith("<urn:uuid:") and len(block) == int(header["content-length"])
    arc_convert.write_warc(arc_convert.page_archives(df.limit(0)), str(tmp_path / "none"))
    assert arc_convert.read_warc(spark, str(tmp_path / "none")).count() == 0


def test_bytes_of_any_kind_come_out_as_they_are(spark, tmp_path):
    import gzip
    top = b"HTTP/1.1 200 OK\r\nX-Title: caf\xe9 \xff\r\nContent-Length: %d\r\n\r\n"
    bodies = [b"\xff\xfeabc", b"\x89PNG\r\n\x1a\n\x00\xff" + bytes(range(256)) * 20, gzip.compress(b"abc" * 99, mtime=0),
              "é café".encode("latin-1"), b"\r\n\r\n\xc3", b"\xff\xfeabc", "é".encode()]
    blocks = [top % len(x) + x for x in bodies] + [b"%PDF-1.4\n\xe2\xe3\xcf\xd3", b"\xed\xa0\x80\xf5"]
    content = arc_convert.arc_file("n", 1, []) + b"".join(
        b"http://h/%d\xe9 0.0.0.0 20240101000000 text/html %d\n" % (k, len(x)) + x + b"\n" for k, x in enumerate(blocks))
    files = spark.createDataFrame([("a", content)], "path string, content binary")
    assert [(r.type, bytes(r.head + r.payload)) for r in arc_convert.records(files).collect()] == [
        ("response" if x.startswith(b"HTTP/") else "resource", x) for x in blocks]
    path = str(tmp_path / "warc")
    arc_convert.write_warc(files, path)
    found = {}
    for part in (tmp_path / "warc").glob("part-*"):
        with gzip.open(part) as f:
            for header, block in arc_convert.parse_warc(f):
                if header["warc-type"] != "warcinfo":
                    assert header["warc-block-digest"] == "sha1:" + arc_convert.sha1(block)
                    found[header["warc-target-uri"]] = header["warc-type"], block
    again = {k for k, (kind, _) in found.items() if kind == "revisit"}
    assert again < {"http://h/0%E9", "http://h/5%E9"} and len(again) == 1
    assert {k: b for k, (_, b) in found.items()} == {
        u: x.partition(b"\r\n\r\n")[0] + b"\r\n\r\n" if u in again else x
        for u, x in ((f"http://h/{k}%E9", x) for k, x in enumerate(blocks))}
    got = sorted((r.payload_bytes, r.payload_digest) for r in arc_convert.read_warc(spark, path).collect())
    assert got == sorted((len(x), arc_convert.sha1(x)) for x in bodies + blocks[len(bodies):])


# ---------------------------------------------------------------- registered queries and the pipeline

def test_registered():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "minhash_near_dedup", "substring_dedup", "mix_sources",
                                                      "bpe_encode_decode"]
    assert sorted(int(re.match(r"op(\d+)_", q).group(1)) for q in QUERIES) == list(range(1, 14))
    assert set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracles(spark, name):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    got = QUERIES[name](spark, DATA)
    columns = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE_SQL[name]})").fetchall()
    assert sorted((tuple(r[c] for c in columns) for r in got.collect()), key=str) == sorted(want, key=str)


def test_pipeline_stages_follow_their_operators(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DATA)
        path = str(tmp_path / name)
        out.write.parquet(path)
        out = spark.read.parquet(path)
        ids, before = [r.doc_id for r in out.select("doc_id").collect()], [r.doc_id for r in docs.select("doc_id").collect()]
        if name == "toxicity":
            labels = spark.read.parquet(f"{DATA}/labels.parquet")
            gone = {r.doc_id for r in toxicity.score_documents(docs, toxicity.fit(docs, labels)).collect() if r.predicted}
            assert sorted(ids) == sorted(set(before) - gone)
        elif name == "minhash_near_dedup":
            classes = {r.doc: r["class"] for r in minhash.near_duplicates(docs).collect()}
            assert sorted(ids) == sorted(set(classes.values()))
        elif name == "substring_dedup":
            assert sorted(ids) == sorted(before) and unit_dedup.repeated_passages(out).count() <= 2
        elif name == "mix_sources":
            assert set(ids) <= set(before)
        if name != "bpe_encode_decode":
            assert out.columns == docs.columns
        else:
            assert sorted(ids) == sorted(before) and out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        docs = out


def test_rows_without_an_id_are_dealt_over_cells(documents):
    docs = documents([f"text number {k} w" for k in range(300)], ids=[None] * 300)
    rows = docs.withColumn("size", mixing.size_of()).withColumn("digest", F.md5("text"))
    got = mixing.mix(rows, [F.col("doc_id"), F.col("digest")])
    assert got.count() == 300 and got.agg(F.sum("taken")).first()[0] == 450 * 4
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" in plan and "digest" in plan.split("md5")[1][:200]


def test_samples_don_t_depend_on_the_layout(spark):
    from channelwise.llm.common import sampled_labels
    labels = spark.range(4000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("toxic"))
    drawn = [sorted(r.doc_id for r in sampled_labels(labels.repartition(n, F.rand(n)), "toxic", 500).collect()) for n in (1, 3, 7)]
    assert drawn[0] == drawn[1] == drawn[2] and 400 < len(drawn[0]) <= 500


@pytest.mark.parametrize("step, columns", [(toxicity._count, {"text": ["a b"], "label": [1], "fold": [0]}),
                                           (unit_dedup._unit_rows, {"text": ["a b"], "doc": [1], "t": [2]})])
def test_stages_give_up_what_the_one_before_kept(monkeypatch, step, columns):
    monkeypatch.setattr(common, "_STORE", {("codec", "path", 8): object()})
    list(step(iter([pa.RecordBatch.from_pydict(columns)])))
    assert ("codec", "path", 8) not in common._STORE
