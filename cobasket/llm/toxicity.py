"""Toxicity by weak supervision.

Voters look at a text and say toxic, clean or nothing: a fixed lexicon, lexicons
of word beginnings mined from labelled training rows, patterns, and the lack of
any hit. A mined term is a beginning and how often a text must have it: at
all, or at two rising levels that grow with the text. Each level's list makes
``SPLIT`` voters. A generative label model with a latent class estimates by EM
how each voter votes on either class, and from what the votes still share given
the class, their correlations; a voter counts less the more it repeats others. The model's posterior labels train a linear classifier
on the mined terms and the patterns, which scores every text.

Mining and fitting read at most ``max_rows`` labelled training rows, those of
the smallest hash of doc_id; term counts are added up in Spark, and at most
``max_terms`` terms, those of the largest likelihood ratio, come to the driver.

Defined results: a null or empty text has no votes but that of no hit; labels
other than 0 and 1 are left out; a doc_id that is labelled twice counts once,
with its larger label; without labels of both kinds the score is the share of
label 1 (0 without labels); repeated rows are scored each; an empty table stays
empty; copies of one text under one doc_id are learned from once; only doc_id and
text are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cobasket.llm.quality_rank import held_out, logistic, sample, training_labels
from cobasket.llm.text import CACHE_ENTRIES, chunks
from cobasket.session import scratch_path, stored

MAX_ROWS = 20_000
MAX_TERMS = 256
RIDGE = 1e-4
SPLIT = 3
#: The least share of toxic texts among those with a mined term.
MIN_SHARE = 0.9
#: Lengths of word beginnings; 0 is the whole word.
LENGTHS = (4, 5, 6, 7, 8, 0)
#: Words that a text must have with a term: so many, and one of so many of its words.
LEVELS = ((1, math.inf), (2, 250), (3, 100))
# Common English insults.
LEXICON = (
    "asshole bastard bitch clown coward creep cretin degenerate despicable dimwit disgusting dumb dumbass filth freak fool garbage "
    "idiot idiotic imbecile jerk liar loser lunatic moron moronic nasty parasite pathetic pig psycho repulsive rat scum shit stupid "
    "stupidity sucker trash ugly useless vermin vile weasel worthless wretch"
).split()
PATTERNS = {
    "address": re.compile(rb"\byou(?:'re| are|r)? (?:all |just |such |a |an |so )*(?:" + "|".join(LEXICON).encode() + rb")\b"),
    "threat": re.compile(rb"\b(?:kill|hurt|destroy|hate) (?:you|him|her|them|yourself)\b"),
    "masked": re.compile(rb"\b[a-z]+[*@#$]{2,}[a-z]+\b"),
}
#: The lexicon, the patterns, shouting and repeated exclamation marks.
N_PATTERNS = len(PATTERNS) + 3
_WORD = re.compile(r"[^\W\d_]+")
_LISTED = {f"0:{w}" for w in LEXICON}
_COUNTS = "term string, toxic long, clean long"


def terms_of(word: bytes) -> list[str]:
    """Terms of one raw word: the beginnings and the whole of its lower-cased letter runs."""
    out = []
    for w in _WORD.findall(word.decode("utf-8", "replace").lower()):
        out += [f"{n}:{w[:n]}" for n in LENGTHS if n and len(w) >= n] + [f"0:{w}"]
    return out


class Terms(dict):
    """Terms of raw words, remembered; with ``known``, those in it."""

    def __init__(self, known: set[str] | None = None):
        super().__init__()
        self.known = known

    def __missing__(self, word: bytes) -> tuple:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        found = terms_of(word)
        out = self[word] = tuple(found) if self.known is None else tuple(t for t in found if t in self.known)
        return out

    def count(self, words: list[bytes]) -> dict[str, int]:
        """How many words of a text have each term."""
        out: dict[str, int] = {}
        for found in filter(None, map(self.__getitem__, words)):
            for t in found:
                out[t] = out.get(t, 0) + 1
        return out


def level(count: int, words: int) -> int:
    """The highest level that so many words reach in a text of ``words`` words."""
    return max(k for k, (least, each) in enumerate(LEVELS) if count >= least and count >= words / each)


def patterns(text: bytes) -> list[float]:
    """1 for each pattern that the text has, then shouting and repeated exclamation marks."""
    lower = text.lower()
    capitals = len(text) - len(text.translate(None, bytes(range(65, 91))))
    letters = len(lower) - len(lower.translate(None, bytes(range(97, 123)))) or 1
    return [*(float(p.search(lower) is not None) for p in PATTERNS.values()), float(letters >= 20 and capitals > 0.5 * letters), float(b"!!" in text)]


def mine(rows: DataFrame, max_terms: int) -> tuple[list[str], set[str]]:
    """Terms (of rows label, text) that speak for toxicity, best first, and the lexicon without the words that clean texts have as often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, counts = Terms(), (Counter(), Counter())

        def rows() -> pa.RecordBatch:
            names = list(counts[0].keys() | counts[1].keys())
            out = [pa.array(names, pa.string()), *(pa.array([c[t] for t in names], pa.int64()) for c in reversed(counts))]
            for c in counts:
                c.clear()
            return pa.record_batch(out, names=["term", "toxic", "clean"])

        for batch, texts in chunks(batches):
            for label, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                words = text.split()
                counts[label].update(f"{k}|{t}" for t, n in seen.count(words).items() for k in range(level(n, len(words)) + 1))
            if len(counts[0]) + len(counts[1]) > 2 * CACHE_ENTRIES:
                yield rows()
        yield rows()

    totals = {r.label: r.n for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1 or not n0:
        return [], _LISTED
    share = n1 / (n1 + n0)
    counted = rows.mapInArrow(run, _COUNTS).groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    path = scratch_path(rows.sparkSession, "term-counts")
    counted.where("toxic > 2 or clean > 2").write.parquet(path)
    counted = rows.sparkSession.read.parquet(path)
    both, own = F.col("toxic") + F.col("clean"), F.col("toxic") / (F.col("toxic") + F.col("clean"))
    clean = F.when(F.col("clean") > 0, F.col("clean") * F.ln((1 - own) / (1 - share))).otherwise(0.0)
    ratio = F.col("toxic") * F.ln(own / share) + clean
    # chance alone reaches a ratio of ln(terms) once in a list of that many
    likely = counted.where(own >= MIN_SHARE).withColumn("ratio", ratio).where(F.col("ratio") > math.log(1e5) + 2)
    common = counted.where(F.col("term").isin([f"0|{t}" for t in _LISTED]) & (own < MIN_SHARE)).collect()
    best = likely.withColumn("own", own).orderBy(F.desc("ratio"), "term").limit(8 * max_terms).collect()
    kept: list[tuple[str, str, float]] = []
    for r in best:
        at, text = r.term[0], r.term.partition(":")[2]
        # a longer or more frequent form of a kept term that is no better tells nothing new
        if len(kept) < max_terms and not any(text.startswith(x.partition(":")[2]) and x[0] <= at and own >= r.own for x, _, own in kept if x[2] != "0"):
            kept.append((r.term, text, r.own))
    return [t for t, _, _ in kept], _LISTED - {r.term[2:] for r in common}


def votes(x: np.ndarray, terms: list[str]) -> np.ndarray:
    """Votes (1 toxic, -1 clean, 0 none) of all voters on rows of classifier inputs."""
    m = len(terms)
    at = np.array([int(t[0]) for t in terms], int)
    hits = x[:, :m] > 0
    out = []
    for k in range(len(LEVELS)):
        own = np.flatnonzero(at == k)
        out += [np.where(hits[:, own[i::SPLIT]].any(1), 1, 0) for i in range(SPLIT)]
    out += [np.where(x[:, m + k] > 0, 1, 0) for k in range(N_PATTERNS)]
    out.append(np.where(hits.any(1) | (x[:, m] > 0), 0, -1))
    return np.stack(out, 1)


@dataclass
class LabelModel:
    """How voters vote: rates[class, voter, vote + 1], the share of class 1, and each voter's weight."""

    rates: np.ndarray
    prior: float
    weight: np.ndarray
    correlation: np.ndarray

    def posterior(self, v: np.ndarray) -> np.ndarray:
        odds = np.full(len(v), math.log(self.prior / (1 - self.prior)))
        for j in range(v.shape[1]):
            log = np.log(self.rates[1, j] / self.rates[0, j])
            odds += self.weight[j] * log[v[:, j] + 1]
        return 1 / (1 + np.exp(-np.clip(odds, -60, 60)))


def label_model(v: np.ndarray, prior: float, begin: np.ndarray | None = None, rounds: int = 30) -> LabelModel:
    """EM for the voters' rates, begun from ``begin`` or else from the votes; correlations from what is left given the class."""
    n, m = v.shape
    prior = min(max(prior, 1e-3), 1 - 1e-3)
    one = [v == k for k in (-1, 0, 1)]
    if begin is None:  # the share of class 1, from the rows with the most votes for it
        begin = np.zeros(n)
        begin[np.argsort(-v.sum(1), kind="stable")[: round(prior * n)]] = 1
    post = np.clip(begin, 0.05, 0.95)
    weight, correlation = np.ones(m), np.eye(m)
    model = None
    for r in range(rounds):
        rates = np.empty((2, m, 3))
        for c, q in enumerate((1 - post, post)):
            for k in range(3):
                rates[c, :, k] = (q @ one[k] + 0.5) / (q.sum() + 1.5)
        if r >= 2:
            mean = np.outer(1 - post, rates[0] @ [-1, 0, 1]) + np.outer(post, rates[1] @ [-1, 0, 1])
            left = v - mean
            spread = np.sqrt((left**2).mean(0)) + 1e-6
            correlation = (left.T @ left) / n / np.outer(spread, spread)
            weight = 1 / (1 + np.clip(correlation - np.eye(m), 0, 1).sum(1))
        model = LabelModel(rates, prior, weight, correlation)
        new = model.posterior(v)
        if np.abs(new - post).max() < 1e-6:
            break
        post = new
    return model


@dataclass
class Classifier:
    """Terms, the lexicon in use, and the weights of terms, lexicon, patterns and 1."""

    terms: list[str]
    listed: set[str]
    weights: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = x @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def inputs(texts: list[bytes], terms: list[str], listed: set[str], seen: Terms) -> np.ndarray:
    """Classifier inputs: 1 for each term that a text has, for any word of the lexicon in use, and for its patterns."""
    m, place = len(terms), {t: i for i, t in enumerate(terms)}
    x = np.zeros((len(texts), m + N_PATTERNS), np.float32)
    for i, text in enumerate(texts):
        words = text.split()
        for t, n in seen.count(words).items():
            if t in listed:
                x[i, m] = 1
            for k in range(level(n, len(words)) + 1):
                j = place.get(f"{k}|{t}")
                if j is not None:
                    x[i, j] = 1
        x[i, m + 1 :] = patterns(text)
    return x


def known(terms: list[str], listed: set[str]) -> Terms:
    return Terms({t[2:] for t in terms} | listed)


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, max_terms: int = MAX_TERMS) -> Classifier:
    """Mine terms, fit the label model on the sample's votes and the classifier on its posterior labels."""
    some = stored(sample(training_labels(labels, "toxic"), max_rows).select(F.col("doc_id").alias("known_id"), "label"), "label-sample")
    # at most max_rows ids go to the texts, and their rows are written once, one for each id and text
    rows = docs.select("doc_id", "text").join(F.broadcast(some), F.col("doc_id") == F.col("known_id"))
    rows = stored(rows.select("doc_id", "label", "text").dropDuplicates(["doc_id", "label", "text"]), "labelled-texts")
    # copies of one text are one witness
    terms, listed = mine(rows.select("label", "text").distinct(), max_terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = known(terms, listed)
        for batch, texts in chunks(batches):
            x = inputs(texts, terms, listed, seen).astype(bool)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array([np.packbits(r).tobytes() for r in x], pa.binary())], names=["doc_id", "label", "x"])

    got = rows.select("doc_id", "label", "text").mapInArrow(run, "doc_id long, label int, x binary").collect()
    got.sort(key=lambda r: (r.doc_id, r.label, bytes(r.x)))
    width = len(terms) + N_PATTERNS
    y = np.array([r.label for r in got], float)
    share = float(y.mean()) if len(y) else 0.0
    if not 0 < share < 1:
        return Classifier(terms, listed, np.append(np.zeros(width), math.log((share + 1e-6) / (1 - share + 1e-6))))
    x = np.stack([np.unpackbits(np.frombuffer(bytes(r.x), np.uint8), count=width) for r in got]).astype(float)
    v = votes(x, terms)
    post = label_model(v, share).posterior(v)
    # each row stands for both labels, weighted by its posterior
    one = np.concatenate([x, np.ones((len(x), 1))], 1)
    signs = np.concatenate([np.ones(len(x)), -np.ones(len(x))])
    return Classifier(terms, listed, logistic(np.concatenate([one, one]), RIDGE, signs, np.concatenate([post, 1 - post])))


def score(docs: DataFrame, model: Classifier, cut: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = known(model.terms, model.listed)
        for batch, texts in chunks(batches):
            s = model.scores(inputs(texts, model.terms, model.listed, seen))
            out = [batch.column(0), batch.column(1), pa.array(s, pa.float64()), pa.array(s >= cut).cast(pa.int32())]
            yield pa.record_batch(out, names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def rate(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels))
