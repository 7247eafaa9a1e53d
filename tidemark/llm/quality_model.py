"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Grades are 0 (low quality), 1 (fair text, but toxic) and 2 (good). One weight per
hashed text feature is shared by all grades and two ordered thresholds part them:
P(grade <= k) = sigmoid(threshold_k - score). Features are the distinct lower-case
words of a text, the shape of its words (their endings in symbols, runs of one word) and
coarse counts; only presence counts, so one telling word is as strong in a long
text as in a short one. Features are 64-bit hashes without a modulus.

The model is fitted on at most ``sample`` labelled documents (those with the least
hash of their id; three quarters fit, a quarter sets the cut), and knows at most
``sample * features per document / least_docs`` features: those in ``least_docs`` or more of
the fitting documents, and among them those that a chi-square test ties to the grade.
Scoring streams over all documents.

The cut on P(grade = 2) is where the held-out documents that are wrongly rejected
and wrongly kept weigh least, a wrongly rejected one ``keep_cost`` times.

Nulls: a null text has no words and is judged by its counts alone; labels with a null are not
used, contradicting labels count as the worse one. Without labels of two grades
nothing is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.columns import neutral, restored
from tidemark.llm.shared import by_value
from tidemark.llm.words import LOWER, PLAIN_WORD, Hasher, find_words, mix, text_chunks
from tidemark.sources.durable import checkpoint

SAMPLE = 12_000
LEAST_DOCS = 8
KEEP_COST = 2.0
PRIOR = 0.5
LEAST_CHI2 = 18.0
#: Features take some ninety bytes of memory a byte of text while they are made.
PART_BYTES = 1 << 18
_U = np.uint64
# Bytes of words that tell meaning; what else ends or starts a word is its shape.
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _shape(kind: int, *values: np.ndarray) -> np.ndarray:
    out = np.full(len(values[0]), kind, _U)
    for v in values:
        out = mix(out * _U(0x9E3779B97F4A7C15) + v.astype(_U) + _U(1))
    return out


def _features(hasher: Hasher, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) pairs, each once, of all texts of a chunk."""
    lowered = LOWER[data]
    starts, ends, first = find_words(lowered, offsets, PLAIN_WORD)
    n = np.diff(first)
    texts = np.arange(len(n))
    of = np.repeat(texts, n)
    # The core of a word is what stands between its outer symbols; the rest of it is its shape.
    letters = np.concatenate([[0], np.cumsum(_LETTER[lowered])])
    where = np.flatnonzero(_LETTER[lowered])
    has = letters[ends] > letters[starts]
    low, high = starts.copy(), ends.copy()
    low[has] = where[letters[starts[has]]]
    high[has] = where[letters[ends[has]] - 1] + 1
    core = hasher.words(lowered, low, high)
    tail = hasher.words(lowered, np.where(has, high, starts), ends)
    same = np.zeros(len(starts), bool)
    same[1:] = (core[1:] == core[:-1]) & (of[1:] == of[:-1])
    pairs_of = [of, of]
    pairs = [core, _shape(1, tail)]
    # Coarse counts: length, share of words after their like, share of distinct words at that length, marked words.
    width = np.floor(np.log2(n + 1))
    many = np.maximum(n, 1)
    order = np.lexsort((core, of))
    fresh = np.append(True, (core[order][1:] != core[order][:-1]) | (of[order][1:] != of[order][:-1])) if len(of) else np.zeros(0, bool)
    distinct = np.bincount(of[order][fresh], minlength=len(n))
    repeats = np.bincount(of[same], minlength=len(n))
    marked = np.bincount(of[ends - high > 1], minlength=len(n)) + np.bincount(of[~has], minlength=len(n))
    coarse = [_shape(2, width), _shape(3, np.ceil(20 * repeats / many)), _shape(4, np.floor(width / 2), np.floor(10 * distinct / many)), _shape(5, np.ceil(10 * marked / many))]
    pairs_of += [texts] * len(coarse)
    pairs += coarse
    key_of, key = np.concatenate(pairs_of), np.concatenate(pairs)
    return key_of, key


def _once(of: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((key, of))
    of, key = of[order], key[order]
    if not len(of):
        return of, key
    fresh = np.append(True, (of[1:] != of[:-1]) | (key[1:] != key[:-1]))
    return of[fresh], key[fresh]


@dataclass
class Model:
    """Sorted features, their weights, the two thresholds, and the cut on P(grade = 2)."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray
    cut: float

    def scores(self, hasher: Hasher, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        of, key = _features(hasher, data, offsets)
        if not len(self.features):
            return np.zeros(len(offsets) - 1)
        at = np.minimum(np.searchsorted(self.features, key), len(self.features) - 1)
        known = self.features[at] == key
        of, key = _once(of[known], at[known])
        return np.bincount(of, self.weights[key], minlength=len(offsets) - 1)

    def grades(self, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Expected grade and P(grade = 2)."""
        above = 1 / (1 + np.exp(np.clip(self.thresholds[:, None] - score, -60, 60)))
        return above.sum(axis=0), above[-1]


KEEP_ALL = Model(np.zeros(0, _U), np.zeros(0), np.array([-60.0, -60.0]), 0.0)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def fit_ordinal(row: np.ndarray, column: np.ndarray, grade: np.ndarray, width: int, rounds: int = 300, rate: float = 0.1, prior: float = PRIOR, faults_only: bool = True):
    """Weights and ordered thresholds by Adam on the log-likelihood of sparse binary rows, with a normal prior on weights.

    With ``faults_only`` no weight is positive: a feature can only lower the grade, so that what is usual in good
    texts does not add up over a long one and cover a fault.
    """
    penalty = prior / max(len(grade), 1)
    weights = np.zeros(width)
    share = np.clip([np.mean(grade <= k) for k in range(2)], 1e-3, 1 - 1e-3)
    low = np.log(share / (1 - share))
    state = np.concatenate([weights, [low[0], np.log(max(low[1] - low[0], 1e-3))]])
    m, v = np.zeros_like(state), np.zeros_like(state)
    n = len(grade)
    for step in range(1, rounds + 1):
        weights, t0 = state[:width], state[width]
        gap = np.exp(np.clip(state[width + 1], -10, 10))
        score = np.bincount(row, weights[column], minlength=n)
        a, b = _sigmoid(t0 - score), _sigmoid(t0 + gap - score)
        da, db = a * (1 - a), b * (1 - b)
        p = np.maximum(np.select([grade == 0, grade == 1], [a, b - a], 1 - b), 1e-9)
        # Derivatives of log p by the thresholds; by the score it is minus their sum.
        by_a = np.select([grade == 0, grade == 1], [da, -da], 0.0) / p
        by_b = np.select([grade == 1, grade == 2], [db, -db], 0.0) / p
        slope = -(by_a + by_b)
        gradient = np.concatenate([
            np.bincount(column, slope[row], minlength=width) / n - penalty * weights, [(by_a + by_b).mean(), by_b.mean() * gap]])
        m = 0.9 * m + 0.1 * gradient
        v = 0.999 * v + 0.001 * gradient**2
        state += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        if faults_only:
            np.minimum(state[:width], 0, out=state[:width])
    t0 = state[width]
    return state[:width], np.array([t0, t0 + np.exp(np.clip(state[width + 1], -10, 10))])


def _telling(row: np.ndarray, column: np.ndarray, grade: np.ndarray, width: int) -> np.ndarray:
    """Features whose counts by grade are further from chance than LEAST_CHI2; the rest would only learn single documents by heart."""
    seen = np.stack([np.bincount(column[grade[row] == g], minlength=width) for g in range(3)], axis=1).astype(float)
    expected = np.maximum(seen.sum(axis=1, keepdims=True) * np.bincount(grade, minlength=3) / len(grade), 1e-9)
    return ((seen - expected) ** 2 / expected).sum(axis=1) > LEAST_CHI2


def _cut(tail: np.ndarray, good: np.ndarray, keep_cost: float) -> float:
    """The cut where wrong rejections and wrong acceptances weigh least, halfway between neighbours."""
    order = np.argsort(tail)
    tail, good = tail[order], good[order]
    lost = keep_cost * np.concatenate([[0], np.cumsum(good)]) / max(good.sum(), 1)
    passed = np.concatenate([np.cumsum((~good)[::-1])[::-1], [0]]) / max((~good).sum(), 1)
    edges = np.concatenate([[0.0], (tail[1:] + tail[:-1]) / 2, [1.0]])
    return float(edges[int(np.argmin(lost + passed))])


def fit_quality(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, least_docs: int = LEAST_DOCS, keep_cost: float = KEEP_COST) -> Model:
    """Fits on ``sample`` labelled documents (labels: doc_id, quality, toxic)."""
    spark = documents.sparkSession
    grade = F.when(F.col("q") == 0, 0).when(F.col("t") == 1, 1).otherwise(2)
    rated = (
        labels.filter("doc_id is not null and quality is not null and toxic is not null")
        .groupBy(F.col("doc_id").cast("bigint").alias("_id")).agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
        .select("_id", grade.cast("int").alias("grade"), F.xxhash64("_id").alias("_order")).orderBy("_order", "_id").limit(sample))
    # At most ``sample`` rows of twenty bytes.
    chosen = documents.select(F.col("doc_id").cast("bigint").alias("_doc"), F.col("text").cast("string").alias("text")).join(
        F.broadcast(rated), F.col("_doc") == F.col("_id"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for i, j, data, offsets in text_chunks(batch.column(2), PART_BYTES):
                of, key = _once(*_features(hasher, data, offsets))
                take = pa.array(of)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i).take(take), batch.column(1).slice(i, j - i).take(take), pa.array(key.view(np.int64))], ["doc", "grade", "feature"])

    pairs = checkpoint(chosen.select(F.col("_doc").alias("doc"), "grade", "text").mapInArrow(extract, "doc bigint, grade int, feature bigint"))
    common = pairs.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_docs).select("feature")
    used = pairs.join(common, "feature").toArrow()
    if not used.num_rows:
        return KEEP_ALL
    docs, row = np.unique(used["doc"].to_numpy(), return_inverse=True)
    features, column = np.unique(used["feature"].to_numpy().view(_U), return_inverse=True)
    grades = np.zeros(len(docs), int)
    grades[row] = used["grade"].to_numpy()
    # In a fixed order, so that sums do not depend on how rows arrive.
    order = np.lexsort((column, row))
    row, column = row[order], column[order]
    held = mix(docs.view(_U)) % _U(4) == 0
    if len(np.unique(grades[~held])) < 2 or not held.any():
        return KEEP_ALL
    renumbered = np.cumsum(~held) - 1
    fit = ~held[row]
    x, y = renumbered[row[fit]], column[fit]
    kept = _telling(x, y, grades[~held], len(features))[y]
    weights, thresholds = fit_ordinal(x[kept], y[kept], grades[~held], len(features))
    score = np.bincount(row, weights[column], minlength=len(docs))
    model = Model(features, weights, thresholds, 0.0)
    _, tail = model.grades(score)
    model.cut = _cut(tail[held], grades[held] == 2, keep_cost)
    return model


def score_quality(documents: DataFrame, model: Model) -> DataFrame:
    """``documents`` with expected_grade, tail_prob (of the best grade) and kept, for its columns doc_id and text."""
    shared = by_value(documents.sparkSession, model)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, model = Hasher(), shared()
        for batch in batches:
            for i, j, data, offsets in text_chunks(batch.column(batch.num_columns - 1), PART_BYTES):
                expected, tail = model.grades(model.scores(hasher, data, offsets))
                yield pa.RecordBatch.from_arrays(
                    [c.slice(i, j - i) for c in batch.columns] + [pa.array(expected), pa.array(tail), pa.array(tail >= model.cut)],
                    [*batch.schema.names, "expected_grade", "tail_prob", "kept"])

    columns = [c for c in documents.columns if c != "text"] + ["text"]
    ordered = documents.select(*columns)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered.schema.fields)
    return ordered.mapInArrow(scan, f"{fields}, expected_grade double, tail_prob double, kept boolean")


def good_documents(documents: DataFrame, model: Model) -> DataFrame:
    """The documents that the model keeps, in all their columns."""
    return restored(score_quality(neutral(documents, ["text"]), model).filter("kept"), documents, ["text"])
