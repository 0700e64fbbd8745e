"""Language identification by a bidirectional gated recurrent network over bytes.

A text's UTF-8 bytes are cut into segments of ``SEGMENT`` bytes. Over each segment
one gated recurrent network runs forwards and one backwards; at every byte the two
states give a probability for each language, and a document's probabilities are
their means over all its bytes. Gates are ``(1 + s(x)) / 2`` and candidates ``s(x)``
with the soft sign ``s(x) = x / (1 + |x|)``, which is cheap at every byte.

The network is trained in numpy on the driver, by backpropagation through time with
Adam's steps: every byte of a training segment is to tell its document's language.
Training reads at most ``PER_LANG`` documents of a language, those of the smallest
hash of doc_id among the rows one may learn from, and ``PER_DOC`` segments of each.
Scoring reads every byte of every text, in Arrow batches inside Spark tasks, as
matrices of ``BLOCK`` segments of like lengths.

Defined results: ``und`` and score 0 for a text that is null or has no letter, and
for every text if there is nothing to learn from; rows of null lang or doc_id are
not learned from, and a null doc_id is held out; of a doc_id that repeats, each
language takes the smallest text; repeated rows are scored each; an empty table
stays empty; columns other than doc_id, text and lang are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cobasket.llm.text import chunks
from cobasket.session import stored

HIDDEN = 16
SEGMENT = 128
BLOCK = 1024
PER_LANG = 500
PER_DOC = 4
STEPS = 250
BATCH = 96
#: Bytes of a segment in training; shorter ones take fewer steps through time.
LESSON = 64
RATE = 0.02
UNKNOWN = "und"
_LETTER = re.compile(rb"[A-Za-z]")


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from; a null doc_id is one."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def has_letter(text: bytes) -> bool:
    return _LETTER.search(text) is not None or (not text.isascii() and any(map(str.isalpha, text.decode("utf-8", "replace"))))


def segments(texts: list[bytes], width: int = SEGMENT) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All bytes end to end, and the start, length and text of each segment."""
    sizes = np.array([len(t) for t in texts], np.int64)
    n = -(-sizes // width)
    text = np.repeat(np.arange(len(texts)), n)
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    starts = np.repeat(np.cumsum(sizes) - sizes, n) + nth * width
    return np.frombuffer(b"".join(texts), np.uint8), starts, np.minimum(sizes[text] - nth * width, width), text


def columns_of(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of segments, one a column, and how many columns have a byte in each row; ``lengths`` must not rise."""
    top = int(lengths[0]) if len(lengths) else 0
    at = np.minimum(starts + np.arange(top)[:, None], len(data) - 1)
    return data[at].astype(np.intp), np.searchsorted(-lengths, -np.arange(top), side="left")


def soft_sign(x: np.ndarray, room: np.ndarray) -> np.ndarray:
    """x / (1 + |x|), in place."""
    np.abs(x, out=room)
    room += 1
    x /= room
    return x


@dataclass
class Network:
    """Weights of one direction: what each byte adds to update gate, reset gate and candidate, and what the last state adds."""

    table: np.ndarray  # (256, 3 * hidden)
    state: np.ndarray  # (3 * hidden, hidden)

    @classmethod
    def new(cls, draw: np.random.Generator, hidden: int) -> Network:
        return cls(draw.normal(0, 0.5, (256, 3 * hidden)).astype(np.float32), draw.normal(0, hidden**-0.5, (3 * hidden, hidden)).astype(np.float32))

    def run(self, x: np.ndarray, live: np.ndarray, order: range, keep: dict | None = None) -> np.ndarray:
        """States (byte, hidden, segment) along ``order``; ``live[t]`` segments have a byte t. ``keep`` takes what the gradient needs."""
        size = self.state.shape[1]
        top, n = x.shape
        out = np.zeros((top, size, n), np.float32)
        given, rows = np.empty((3 * size, n), np.float32), np.empty((n, 3 * size), self.table.dtype)
        recurrent, room = np.empty((3 * size, n), np.float32), np.empty((2 * size, n), np.float32)
        last = np.zeros((size, n), np.float32)
        for t in order:
            k = live[t]
            g, u, h = given[:, :k], recurrent[:, :k], last[:, :k]
            np.take(self.table, x[t, :k], axis=0, out=rows[:k], mode="clip")
            g[:] = rows[:k].T
            np.matmul(self.state, h, out=u)
            gates, candidate = g[: 2 * size], g[2 * size :]
            gates += u[: 2 * size]
            soft_sign(gates, room[:, :k])
            if keep is not None:
                keep["gates"][t, :, :k], keep["recurrent"][t, :, :k], keep["last"][t, :, :k] = gates, u[2 * size :], h
            gates += 1
            inner = u[2 * size :]
            inner *= gates[size:]
            candidate += inner
            soft_sign(candidate, room[:size, :k])
            if keep is not None:
                keep["candidate"][t, :, :k] = candidate
            update = gates[:size]
            update *= 0.5
            new = out[t, :, :k]
            np.subtract(h, candidate, out=new)
            new *= update
            new += candidate
            last = out[t]  # segments that begin later keep their zeros
        return out

    def kept(self, top: int, n: int) -> dict:
        size = self.state.shape[1]
        make = lambda rows: np.zeros((top, rows, n), np.float32)
        return {"gates": make(2 * size), "recurrent": make(size), "last": make(size), "candidate": make(size)}

    def gradient(self, x: np.ndarray, live: np.ndarray, order: range, keep: dict, above: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of table and state, back along ``order``; ``above`` is that of the states (byte, hidden, segment)."""
        size = self.state.shape[1]
        top, n = x.shape
        inputs = np.zeros((top, 3 * size, n), np.float32)
        d_state = np.zeros_like(self.state)
        back = np.zeros((size, n), np.float32)
        for t in reversed(order):
            k = live[t]
            d = back[:, :k] + above[t, :, :k]
            gates, u, h, c = (keep[name][t, :, :k] for name in ("gates", "recurrent", "last", "candidate"))
            update, reset = (1 + gates[:size]) / 2, 1 + gates[size:]
            d_c = d * (1 - update) * (1 - np.abs(c)) ** 2
            bend = (1 - np.abs(gates)) ** 2
            d_update = d * (h - c) / 2 * bend[:size]
            d_reset = d_c * u * bend[size:]
            inputs[t, :, :k] = np.concatenate([d_update, d_reset, d_c])
            d_u = np.concatenate([d_update, d_reset, d_c * reset])
            d_state += d_u @ h.T
            back = np.zeros((size, n), np.float32)
            back[:, :k] = d * update + self.state.T @ d_u
        rows = inputs.transpose(0, 2, 1).reshape(-1, 3 * size)
        at = x.ravel()
        by = np.argsort(at, kind="stable")
        d_table = np.zeros_like(self.table)
        seen, first = np.unique(at[by], return_index=True)
        d_table[seen] = np.add.reduceat(rows[by], first)
        return d_table, d_state


@dataclass
class Model:
    """Languages, both directions, and the weights of their states and of 1 for each language."""

    langs: list[str]
    forward: Network
    backward: Network
    heads: np.ndarray  # (langs, 2 * hidden)
    bias: np.ndarray  # (langs, 1)

    def weights(self) -> list[np.ndarray]:
        return [self.forward.table, self.forward.state, self.backward.table, self.backward.state, self.heads, self.bias]

    def chances(self, ahead: np.ndarray, behind: np.ndarray) -> np.ndarray:
        """Probabilities (byte, language, segment) from the states of both directions."""
        size = ahead.shape[1]
        z = np.matmul(self.heads[:, :size], ahead)
        z += np.matmul(self.heads[:, size:], behind)
        z += self.bias
        z -= z.max(1, keepdims=True)
        np.exp(z, out=z)
        z /= z.sum(1, keepdims=True)
        return z

    def label(self, x: np.ndarray, live: np.ndarray) -> np.ndarray:
        """Probabilities at every byte; 0 where a segment has no byte."""
        top = len(x)
        p = self.chances(self.forward.run(x, live, range(top)), self.backward.run(x, live, range(top - 1, -1, -1)))
        for t in np.flatnonzero(live < x.shape[1]):
            p[t, :, live[t] :] = 0
        return p

    def pool(self, texts: list[bytes]) -> np.ndarray:
        """Mean probabilities (text, language) over all bytes of each text; zeros for an empty one."""
        data, starts, lengths, text = segments(texts)
        total = np.zeros((len(texts), len(self.langs)))
        by = np.argsort(-lengths, kind="stable")
        for lo in range(0, len(by), BLOCK):
            some = by[lo : lo + BLOCK]
            sums = self.label(*columns_of(data, starts[some], lengths[some])).sum(0, dtype=np.float64)
            np.add.at(total, text[some], sums.T)
        return total / np.maximum(1, [len(t) for t in texts])[:, None]

    def gradients(self, x: np.ndarray, live: np.ndarray, lang: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean loss over all bytes, and its gradients in the order of ``weights``."""
        top, n = x.shape
        ahead, behind = range(top), range(top - 1, -1, -1)
        kept = [net.kept(top, n) for net in (self.forward, self.backward)]
        states = [net.run(x, live, o, k) for net, o, k in zip((self.forward, self.backward), (ahead, behind), kept, strict=True)]
        p = self.chances(*states)
        there = np.arange(n) < live[:, None]
        total = int(there.sum())
        own = np.take_along_axis(p, np.broadcast_to(lang, (top, 1, n)), 1)[:, 0]
        loss = -float(np.log(own[there] + 1e-9).sum()) / total
        p[:, lang, np.arange(n)] -= 1
        p *= there[:, None] / np.float32(total)
        size = states[0].shape[1]
        flat = lambda a: a.transpose(1, 0, 2).reshape(a.shape[1], -1)
        d = flat(p)
        d_heads = np.concatenate([d @ flat(s).T for s in states], 1)
        d_bias = d.sum(1, keepdims=True)
        up = [np.matmul(self.heads[:, :size].T, p), np.matmul(self.heads[:, size:].T, p)]
        out = []
        for net, o, k, a in zip((self.forward, self.backward), (ahead, behind), kept, up, strict=True):
            out += net.gradient(x, live, o, k, a)
        return loss, [*out, d_heads, d_bias]


def new_model(langs: list[str], hidden: int = HIDDEN, seed: int = 11) -> Model:
    draw = np.random.default_rng(seed)
    heads = draw.normal(0, 0.3, (len(langs), 2 * hidden)).astype(np.float32)
    return Model(langs, Network.new(draw, hidden), Network.new(draw, hidden), heads, np.zeros((len(langs), 1), np.float32))


def fit(texts: list[bytes], langs: list[str], steps: int = STEPS, hidden: int = HIDDEN, seed: int = 11) -> Model | None:
    """A network trained on segments and their languages; None without any."""
    keep = [i for i, t in enumerate(texts) if t]
    names = sorted({langs[i] for i in keep})
    if not names:
        return None
    data, starts, lengths, text = segments([texts[i] for i in keep], LESSON)
    lang = np.array([names.index(langs[i]) for i in keep])[text]
    model = new_model(names, hidden, seed)
    draw = np.random.default_rng(seed)
    weights = model.weights()
    mean, square = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        some = draw.integers(0, len(starts), BATCH)
        some = some[np.argsort(-lengths[some], kind="stable")]
        _, grads = model.gradients(*columns_of(data, starts[some], lengths[some]), lang[some])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        scale = min(1, 1 / (norm + 1e-9))
        # a steady rate for the first half, then down to none
        rate = RATE * min(1, 2 * (1 - step / (steps + 1))) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        for w, g, m, s in zip(weights, grads, mean, square, strict=True):
            m += 0.1 * (g * scale - m)
            s += 0.001 * ((g * scale) ** 2 - s)
            w -= (rate * m / (np.sqrt(s) + 1e-7)).astype(np.float32)
    return model


def training_rows(docs: DataFrame, per_lang: int = PER_LANG, per_doc: int = PER_DOC) -> DataFrame:
    """lang, doc_id and a text of at most ``per_doc`` segments of the documents to learn from."""
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    ids = known.select("doc_id", F.col("lang").cast("string").alias("lang")).distinct()
    first = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    # Spark keeps the first rows of a language in each task before it sends them on
    some = stored(ids.withColumn("nth", first).where(F.col("nth") <= per_lang).select(F.col("doc_id").alias("known_id"), F.col("lang").alias("known_lang")), "language-sample")
    same = (F.col("doc_id") == F.col("known_id")) & (F.col("lang").cast("string") == F.col("known_lang"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            out = []
            for doc, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                n = -(-len(text) // SEGMENT)
                picked = range(n) if n <= per_doc else sorted(np.random.default_rng(doc & 0x7FFFFFFF).choice(n, per_doc, replace=False).tolist())
                out.append([text[SEGMENT * k : SEGMENT * (k + 1)] for k in picked])
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.binary()))], names=["doc_id", "lang", "parts"])

    rows = docs.join(F.broadcast(some), same).select("doc_id", F.col("known_lang").alias("lang"), "text")  # at most per_lang ids a language
    parts = rows.mapInArrow(cut, "doc_id long, lang string, parts array<binary>")
    return parts.groupBy("doc_id", "lang").agg(F.min("parts").alias("parts"))


def train(docs: DataFrame, per_lang: int = PER_LANG, steps: int = STEPS) -> Model | None:
    rows = sorted(training_rows(docs, per_lang).collect(), key=lambda r: (r.lang, r.doc_id))
    texts, langs = [], []
    for r in rows:
        texts += [bytes(p) for p in r.parts]
        langs += [r.lang] * len(r.parts)
    return fit(texts, langs, steps)


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            told = [i for i, t in enumerate(texts) if model is not None and has_letter(t)]
            if told:
                p = model.pool([texts[i] for i in told])
                for i, k, s in zip(told, p.argmax(1).tolist(), p.max(1).tolist(), strict=True):
                    lang[i], score[i] = model.langs[k], min(1.0, s)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score)], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def languages(docs: DataFrame) -> DataFrame:
    return identify(docs, train(docs))
