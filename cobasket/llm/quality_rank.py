"""Bradley-Terry ranking of documents by quality.

Each text has a short vector of features (:data:`FEATURES`). Under the
Bradley-Terry model a document of quality 1 beats one of quality 0 with chance
sigmoid(s(a) - s(b)), where s is linear in the features, so the weights are
those of a logistic regression without intercept on feature differences of
preference pairs. The threshold is the quantile of the training scores at the
share of documents of quality 0; the score is sigmoid(s - threshold).

Features are computed in Spark, for labelled training rows to fit and for every
row to score. The fit takes at most ``max_rows`` labelled rows, those of the
smallest hash of doc_id, and ``pairs`` random pairs of them.

Defined results: a null or empty text has the features of no words; labels other
than 0 and 1 are left out; a doc_id that is labelled twice counts once, with its
larger label; without labels of both kinds every score is 0.5; repeated rows are
scored each; an empty table stays empty; only doc_id and text are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cobasket.llm.text import chunks

MAX_ROWS = 20_000
PAIRS = 200_000
RIDGE = 1e-3
FEATURES = [
    "log_words", "word_length", "long_words", "distinct_words", "same_as_last", "distinct_pairs",
    "capitals", "digits", "symbols", "bars", "exclaims", "stops", "other_marks", "lines", "distinct_lines", "non_ascii",
]
_CAPITALS = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_LOWER = bytes(range(97, 123))
_SYMBOLS = b"#*$%&<>^~{}\\@="
_STOPS = b".,;:?"
_SPACE = b" \t\n\x0b\x0c\r"
_HIGH = bytes(range(128, 256))
_OTHER = bytes(set(range(33, 127)) - set(_CAPITALS + _DIGITS + _LOWER + _SYMBOLS + _STOPS + b"|!"))


def features(text: bytes) -> list[float]:
    """The feature vector of one whole text."""
    words = text.split()
    n, size = len(words), len(text) or 1
    share = lambda chars: (len(text) - len(text.translate(None, chars))) / size
    root = lambda x: x**0.5  # noqa: E731  small shares tell more than large ones
    lines = [x for x in text.split(b"\n") if x.strip(_SPACE)]
    if not n:
        return [0.0] * len(FEATURES)
    letters = sum(map(len, words))
    return [
        float(np.log1p(n)),
        letters / n,
        sum(len(w) > 15 for w in words) / n,
        len(set(words)) / n,
        sum(map(bytes.__eq__, words, words[1:])) / n,
        len(set(zip(words, words[1:], strict=False))) / max(1, n - 1),
        root(share(_CAPITALS)), root(share(_DIGITS)), root(share(_SYMBOLS)), root(share(b"|")), root(share(b"!")),
        root(share(_STOPS)), root(share(_OTHER)), len(lines) / n, len(set(lines)) / max(1, len(lines)), share(_HIGH),
    ]


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from; a null doc_id is one."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def is_held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def training_labels(labels: DataFrame, name: str) -> DataFrame:
    """doc_id, label (0 or 1) of the rows one may learn from."""
    known = labels.where(F.col(name).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    return known.groupBy("doc_id").agg(F.max(name).cast("int").alias("label"))


def sample(known: DataFrame, max_rows: int) -> DataFrame:
    """At most ``max_rows`` rows, those of the smallest hash of doc_id."""
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)


def with_features(docs: DataFrame, carry: str) -> DataFrame:
    """``carry`` columns and ``x``, the features of ``text``."""
    names = [c.strip().split(" ")[0] for c in carry.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            x = pa.array([features(t) for t in texts], pa.list_(pa.float64()))
            yield pa.record_batch([*[batch.column(i) for i in range(len(names))], x], names=[*names, "x"])

    return docs.select(*names, "text").mapInArrow(run, f"{carry}, x array<double>")


def logistic(x: np.ndarray, ridge: float, y: np.ndarray | None = None, weight: np.ndarray | None = None, steps: int = 40) -> np.ndarray:
    """Weights that minimise mean logistic loss of ``x`` (signs ``y``, by default all +1) plus ``ridge``, by Newton's method."""
    n, d = x.shape
    y = np.ones(n) if y is None else y
    weight = np.ones(n) / n if weight is None else weight / weight.sum()
    w = np.zeros(d)

    def loss(w: np.ndarray) -> float:
        return float(weight @ np.logaddexp(0, -y * (x @ w)) + ridge * w @ w / 2)

    for _ in range(steps):
        p = 1 / (1 + np.exp(np.clip(y * (x @ w), -60, 60)))
        slope = -(x * (weight * y * p)[:, None]).sum(0) + ridge * w
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(d)
        step, size, now = np.linalg.solve(bend, slope), 1.0, loss(w)
        while size > 1e-4 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return w


@dataclass
class Ranker:
    """Feature means and scales, weights of the standardised features, and the score that counts as 0.5."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights - self.threshold
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def fit(x: np.ndarray, label: np.ndarray, pairs: int = PAIRS, ridge: float = RIDGE, seed: int = 7) -> Ranker:
    """The ranker of a labelled sample."""
    d = len(FEATURES)
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(good) or not len(bad):
        return Ranker(np.zeros(d), np.ones(d), np.zeros(d), 0.0)
    mean, scale = x.mean(0), x.std(0)
    scale[scale < 1e-9] = 1.0
    z = np.clip((x - mean) / scale, -8, 8)
    draw = np.random.default_rng(seed)
    w = logistic(z[draw.choice(good, pairs)] - z[draw.choice(bad, pairs)], ridge)
    s = np.sort(z @ w)
    # as many training scores lie below the threshold as there are labels 0
    return Ranker(mean, scale, w, float((s[len(bad) - 1] + s[len(bad)]) / 2))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, pairs: int = PAIRS) -> Ranker:
    """Fit on at most ``max_rows`` labelled documents that are not held out."""
    known = sample(training_labels(labels, "quality"), max_rows).select(F.col("doc_id").alias("known_id"), "label")
    rows = docs.select("doc_id", "text").join(known, F.col("doc_id") == F.col("known_id")).select("doc_id", "label", "text")
    got = with_features(rows, "doc_id long, label int").collect()
    got.sort(key=lambda r: (r.doc_id, r.label, r.x))
    return fit(np.array([r.x for r in got]).reshape(len(got), len(FEATURES)), np.array([r.label for r in got], int), pairs)


def score(docs: DataFrame, ranker: Ranker, cut: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            s = ranker.scores(np.array([features(t) for t in texts]))
            out = [batch.column(0), batch.column(1), pa.array(s), pa.array(s >= cut).cast(pa.int32())]
            yield pa.record_batch(out, names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def rank(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels))
