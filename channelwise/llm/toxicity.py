"""Toxicity by maximum-scoring segments.

*Token scores.* Document counts of every word, and of its first seven, five and four letters, are taken
per class from labelled documents. A token's probability of standing in a toxic document has a
Dirichlet prior (``PRIOR`` pseudo-counts) whose mean is that of the next shorter form, down to the
base rate. Its score is the log-odds against the base rate less ``CAUTION`` standard deviations, if
positive; a word seen fewer than ``KNOWN`` times takes the best of its forms. All other tokens score
``DRIFT``. Forms are counted in hashed tables of a fixed size, so the model can be broadcast.

*Segments.* One linear scan (Ruzzo and Tompa's algorithm) finds every maximal scoring segment of a
document's token scores. A word that
comes again counts half as much each time. Segment scores of clean documents follow an extreme-value law; its two
parameters are estimated from their islands. A segment of score S in n tokens has the normalised
score ``scale * S - ln(K * n)``; ``log1p`` of the sum of their exponentials (at most
``MOST_EVIDENCE``) is the document's evidence, and a logistic curve turns it into a probability. The law and the curve are fitted on
cross-scored folds: fold 0 by counts of fold 2 and the other way round.

Learned from at most ``BOUND`` labelled rows (a documented bound), one for each doc_id and text, never from
the held-out fold.
Cases: null and empty texts have evidence 0 and the score that follows from it; without labels of
both classes every score is 0; a null doc_id is scored like any other; rows of one doc_id are scored
each by its own text; extra columns pass through ``keep_clean`` and are ignored elsewhere.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, Recent, batches_by_bytes, distinct_rows, held_out, materialize, sampled_labels, ship, table, text_or_empty, worker_turn

BOUND = 20_000
BUCKETS = 1 << 18
FORMS = (0, 7, 5, 4)  # the word, its first seven, five and four letters
MOST_EVIDENCE = 12.0
PRIOR, CAUTION, KNOWN, DRIFT = 10.0, 2.0, 5, -0.15
THRESHOLD = 0.7
FLOOR = 0.5  # islands of clean text below this score are left out of the law's fit
COUNTS = "fold int, form int, bucket int, toxic long, clean long"
CACHE_ENTRIES = 1 << 17


def forms(word: str) -> list[tuple[int, int]]:
    """(form, bucket) of a word; a form as long as the word is the word itself and left out."""
    return [(k, _bucket(word[:n] if n else word, k)) for k, n in enumerate(FORMS) if n == 0 or len(word) > n]


def _bucket(form: str, k: int) -> int:
    return zlib.crc32(form.encode(), k) % BUCKETS


SLOTS = len(FORMS) * BUCKETS


@dataclass
class Lexicon:
    """Documents (toxic, all) that hold a form, by form * BUCKETS + bucket: two arrays of fixed size."""

    base: float
    toxic: np.ndarray = field(default_factory=lambda: np.zeros(SLOTS, np.int32), repr=False)
    total: np.ndarray = field(default_factory=lambda: np.zeros(SLOTS, np.int32), repr=False)
    prefixes: dict = field(default_factory=dict, repr=False)
    cache: Recent = field(default_factory=lambda: Recent(CACHE_ENTRIES), repr=False)

    def score(self, word: str) -> float:
        """Positive score of a word, or 0 if it has none."""
        known = self.cache.get(word)
        if known is None and (known := self.cache.old.get(word)) is not None:
            self.cache.put(word, known)
        if known is not None:
            return known
        mean, best = self._prefixes(word)
        toxic, total = self._counts(word, 0)
        own = self._lower(toxic, total, mean)[0] if total else None
        out = max(0.0, best if own is None else own if total >= KNOWN else max(own, best))
        self.cache.put(word, out)
        return out

    def _counts(self, form: str, k: int) -> tuple[int, int]:
        at = k * BUCKETS + _bucket(form, k)
        return self.toxic.item(at), self.total.item(at)

    def _lower(self, toxic: int, total: int, mean: float) -> tuple[float, float]:
        """(log-odds against the base rate less the margin, posterior mean) of a form's counts."""
        a, b = toxic + PRIOR * mean, total - toxic + PRIOR * (1 - mean)
        odds = math.log(a / b) - math.log(self.base / (1 - self.base))
        return odds - CAUTION * math.sqrt(1 / a + 1 / b), a / (a + b)

    def _prefixes(self, word: str) -> tuple[float, float]:
        """(prior mean of a word, best score) out of its shorter forms, from the shortest on."""
        key = word[:next((n for n in FORMS[1:] if len(word) > n), 0)]
        known = self.prefixes.get(key)
        if known is None:
            mean, best = self.base, 0.0
            for k, n in reversed(list(enumerate(FORMS))[1:]):
                if len(word) > n:
                    toxic, total = self._counts(word[:n], k)
                    lower, mean = self._lower(toxic, total, mean)
                    best = max(best, lower) if total else best
            if len(self.prefixes) >= CACHE_ENTRIES:
                self.prefixes.clear()
            known = self.prefixes[key] = mean, best
        return known

    def positives(self, words: list[str]) -> list[tuple[int, float]]:
        """(place, score) of the words that score. A word that comes again counts half as much each
        time, so that a line repeated a hundred times isn't a hundred times the evidence."""
        get, score = self.cache.get, self.score
        found = [(i, s) for i, w in enumerate(words) if (s := score(w) if (s := get(w)) is None else s)]
        seen: dict[str, int] = {}
        for j, (i, s) in enumerate(found):
            n = seen[words[i]] = seen.get(words[i], -1) + 1
            if n:
                found[j] = i, s * 0.5 ** min(n, 60)
        return found


def segments(positives: list[tuple[int, float]], drift: float = DRIFT) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, first token, last token), left to right, of a token
    sequence that scores ``drift`` but at the given (index, score) pairs."""
    done: list[tuple[float, float, int, int]] = []  # sum before, sum after, first, last
    out: list[tuple[float, float, int, int]] = []
    total, at = 0.0, -1
    for i, s in positives:
        total += drift * (i - at - 1)
        left, right, first = total, total + s, i
        total, at = right, i
        while True:
            j = len(out) - 1
            while j >= 0 and out[j][0] >= left:
                j -= 1
            if j < 0:  # nothing starts lower: what stands is final
                done += out
                out = [(left, right, first, i)]
                break
            if out[j][1] >= right:
                out.append((left, right, first, i))
                break
            left, first = out[j][0], out[j][2]
            del out[j:]
    return [(right - left, first, last) for left, right, first, last in done + out]


@dataclass
class Model:
    lexicon: Lexicon
    scale: float = 1.0
    k: float = 1.0
    slope: float = 0.0
    offset: float = -50.0

    def normalised(self, score: float, n: int) -> float:
        return self.scale * score - math.log(self.k * max(n, 1))

    def evidence(self, scores: list[float], n: int) -> float:
        if not scores:
            return 0.0
        return min(MOST_EVIDENCE, math.log1p(sum(math.exp(min(50.0, self.normalised(s, n))) for s in scores)))

    def probability(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, self.slope * evidence + self.offset))))

    def score(self, text: str) -> float:
        words = WORD.findall(text.lower())
        return self.probability(self.evidence([s for s, _, _ in segments(self.lexicon.positives(words))], len(words)))

    def passages(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, normalised score) of the significant segments, as places in the lower-cased
        text, which has the length of the text but for a few letters of Turkish and the like."""
        places = [m.span() for m in WORD.finditer(text.lower())]
        words = WORD.findall(text.lower())
        return [(places[a][0], places[b][1], z) for s, a, b in segments(self.lexicon.positives(words))
                if (z := self.normalised(s, len(words))) > 0]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Document counts of one task's rows: at most 2 folds x 3 forms x BUCKETS rows."""
    worker_turn("toxicity")
    tables = np.zeros((2, 2, len(FORMS), BUCKETS), np.int64)  # fold, label, form, bucket
    for b in batches_by_bytes(batches, "text"):
        for text, label, fold in zip(b.column("text").to_pylist(), b.column("label").to_pylist(),
                                     b.column("fold").to_pylist()):
            seen = {x for w in set(WORD.findall(text.lower())) for x in forms(w)}
            if seen:
                form, bucket = np.array(list(seen)).T
                tables[1 if fold else 0, label, form, bucket] += 1
    fold, form, bucket = np.nonzero(tables.sum(axis=1))
    yield pa.RecordBatch.from_arrays(
        [pa.array(fold, pa.int32()), pa.array(form, pa.int32()), pa.array(bucket, pa.int32()),
         pa.array(tables[fold, 1, form, bucket], pa.int64()), pa.array(tables[fold, 0, form, bucket], pa.int64())],
        ["fold", "form", "bucket", "toxic", "clean"])


def _lexicon(counts: dict[str, np.ndarray], docs: dict, folds: tuple[int, ...]) -> Lexicon:
    toxic = sum(docs.get((f, 1), 0) for f in folds)
    clean = sum(docs.get((f, 0), 0) for f in folds)
    out = Lexicon((toxic + 0.5) / (toxic + clean + 1))
    for f in folds:
        out.toxic[counts["slot"]] += counts[f"t{f}"].astype(np.int32)
        out.total[counts["slot"]] += (counts[f"t{f}"] + counts[f"c{f}"]).astype(np.int32)
    return out


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton steps with a weak ridge; the slope is kept above 0."""
    w = np.array([1.0, math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))])
    design = np.column_stack([x, np.ones_like(x)])
    ridge = np.array([1e-2, 1e-3])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (p - y) + ridge * w
        hess = (design * (p * (1 - p))[:, None]).T @ design + np.diag(ridge)
        step = np.linalg.solve(hess, grad)
        w -= step / max(1.0, np.abs(step).max() / 2)
        if np.abs(step).max() < 1e-9:
            break
    return max(float(w[0]), 1e-3), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, bound: int = BOUND) -> Model:
    """Fit on the labelled rows of the learning folds. Only counts of forms (a table of fixed size) and sums over the segments of at most ``bound`` documents reach the driver."""
    sample = F.broadcast(sampled_labels(labels, "toxic", bound))
    rows = distinct_rows(docs.select("doc_id", text_or_empty().alias("text")).join(sample, "doc_id"), "text", bound,
                         "toxic-sample")
    sizes = {(1 if f else 0, y): n for f, y, n in rows.groupBy("fold", "label").count().collect()}
    if not all(any(y == k for _, y in sizes) for k in (0, 1)):
        return Model(Lexicon(0.5))
    counts = (rows.mapInArrow(_count, COUNTS).groupBy("fold", "form", "bucket")
              .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))
    # also the forms that only clean documents hold: a word known as clean must not score by its shorter forms;
    # at most SLOTS rows, fetched as Arrow columns
    by_slot = counts.groupBy((F.col("form") * BUCKETS + F.col("bucket")).alias("slot")).agg(*[
        F.coalesce(F.sum(F.when(F.col("fold") == f, F.col(c))), F.lit(0)).cast("int").alias(f"{c[0]}{f}")
        for f in (0, 1) for c in ("toxic", "clean")])
    held = by_slot.toArrow()
    got = {c: np.asarray(held.column(c)) for c in held.column_names}
    spark = docs.sparkSession
    # each fold is scored by the other one's counts
    by_fold = spark.sparkContext.broadcast([_lexicon(got, sizes, (1 - f,)) for f in (0, 1)])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_turn("toxicity")
        lexicons = by_fold.value
        for b in batches_by_bytes(batches, "text"):
            out = []
            for text, fold in zip(b.column("text").to_pylist(), b.column("fold").to_pylist()):
                words = WORD.findall(text.lower())
                out.append((len(words), [s for s, _, _ in segments(lexicons[1 if fold else 0].positives(words))]))
            yield pa.RecordBatch.from_arrays(
                [b.column("label"), pa.array([x[0] for x in out], pa.int64()),
                 pa.array([x[1] for x in out], pa.list_(pa.float64()))], ["label", "n", "scores"])

    scored = materialize(rows.mapInArrow(score, "label int, n long, scores array<double>"), "toxic-segments")
    by_fold.unpersist()
    model = Model(_lexicon(got, sizes, (0, 1)))
    # a row for each document; sums that don't depend on the order of the rows
    clean = scored.filter("label = 0").select("n", F.filter("scores", lambda s: s >= FLOOR).alias("s")).select(
        "n", F.size("s").alias("islands"), F.aggregate("s", F.lit(0.0), lambda x, y: x + y).alias("total")).collect()
    islands, tokens = sum(r.islands for r in clean), sum(r.n for r in clean)
    # one more island of excess 1 keeps both estimates finite when clean text has none
    model.scale = (islands + 1) / (math.fsum(r.total for r in clean) - FLOOR * islands + 1.0)
    model.k = (islands + 1) / (tokens + 1) * math.exp(model.scale * FLOOR)
    law = Model(None, model.scale, model.k)

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [law.evidence(ss, n) for n, ss in zip(b.column("n").to_pylist(), b.column("scores").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("label"), pa.array(found, pa.float64())], ["label", "evidence"])

    pairs = sorted((e, float(y)) for y, e in scored.mapInArrow(evidence, "label int, evidence double").collect())
    model.slope, model.offset = _logistic(np.array([e for e, _ in pairs]), np.array([y for _, y in pairs]))
    return model


def score_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_turn("toxicity")
        m = shared.value
        for b in batches_by_bytes(batches, "text"):
            s = [m.score(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(s, pa.float64()),
                 pa.array([int(x >= threshold) for x in s], pa.int32())],
                ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"),
                       text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def toxic_passages(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, start, end, score): the significant segments of every document, in characters."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_turn("toxicity")
        m = shared.value
        for b in batches_by_bytes(batches, "text"):
            found = [(d, *p) for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist())
                     for p in m.passages(t)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64()),
                 pa.array([x[2] for x in found], pa.int64()), pa.array([x[3] for x in found], pa.float64())],
                ["doc_id", "start", "end", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, start long, end long, score double")


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that aren't predicted toxic, all columns as they were. Only texts go to Python, and only
    the decision comes back."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def is_clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        worker_turn("toxicity")
        m = shared.value
        for texts in batches:
            yield pa.array([m.score(t.as_py() or "") < threshold for t in texts], pa.bool_())

    return docs.filter(is_clean("text"))


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, fit(docs, table(spark, sf_dir, "labels")))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return keep_clean(docs, fit(docs, table(spark, sf_dir, "labels")))
