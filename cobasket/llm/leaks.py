"""Benchmark decontamination by latent semantic retrieval.

Terms are normalised words hashed to ``TERMS`` numbers, weighted by the inverse
of how many documents of the whole corpus hold them. A randomised SVD of TF-IDF
passages, with the product A'(AQ) computed in Spark tasks, gives a latent space;
it is fitted on every passage of every document and of all benchmark items. Every
document is then searched whole: latent vectors of windows, at each scale of item lengths and
``OVERLAP`` starts a window, come from running sums over its words, and are
compared with the items of that scale. Each window of cosine ``MIN_COSINE`` or
more is checked: the longest common subsequence of the item's words with the
words around the window must hold at least ``MIN_COMMON`` of the item, and
``MIN_ANSWER`` of its answer (the words after its last question mark, or else
its last sentence), or else ``SURE`` of the item. An item of fewer than
``SHORT`` words must be there whole.

The benchmark is a stated set of queries, held in blocks of about ``ITEM_BYTES``
in the driver and the tasks, one block at a time. Defined results: a null or empty document has no leaks; an item
without words is left out; a null doc_id or item_id is reported as null; rows of
one doc_id or item_id are reported once, with the best match; without documents
or items the result is empty; only ids and texts are read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cobasket.llm.text import CACHE_ENTRIES, chunks, mix, powers, release
from cobasket.session import scratch_path, stored

TERMS = 1 << 14
RANK = 96
EXTRA = 16
POWERS = 0
PASSAGE = 48
OVERLAP = 3
SCALE = 1.6
MIN_COSINE = 0.45
MIN_COMMON = 0.6
MIN_ANSWER = 0.5
SURE = 0.8
SHORT = 8
ITEM_BYTES = 8 << 20
TERM_BLOCK = 1 << 8
#: Partial products added up at a time; passages multiplied, and groups of rows added, at a time.
PARTS = 32
PASSAGES = 2_730
GROUP = 16
#: Text bytes numbered at a time, words searched at a time, products and lookups held at a time.
PIECE = 1 << 17
RUN_WORDS = 1 << 14
HELD = 1 << 21
_MARKS = b".,;:!?"
_EDGE = re.compile(r"^[^\w]+|[^\w]+$")
_SPACE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
_LETTER = np.array([n >= 0x80 or chr(n).isalnum() or n == 0x5F for n in range(256)])
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_FOUND = "doc_id long, item_id long, cosine double, common double, answer double"


def normal(word: bytes) -> str:
    """A word lower-cased, without marks at its ends (a word of marks alone stays)."""
    stem = word.rstrip(_MARKS)
    if stem.isalpha():  # the usual case, all ASCII letters
        return stem.lower().decode()
    text = word.decode("utf-8", "replace").lower()
    return _EDGE.sub("", text) or text


class TermNumbers:
    """Term numbers of words: hashes of their normalised bytes, taken over a whole run of text at a time."""

    def of(self, words: list[bytes]) -> np.ndarray:
        return self.of_texts([b" ".join(words)])[0]

    def of_texts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words of all texts end to end, and where each text starts (one more than texts)."""
        data = np.frombuffer(b" ".join([*texts, b""]) or b" ", np.uint8)
        numbers, begins, lo = [], [], 0
        while lo < len(data):
            hi = min(lo + PIECE, len(data))
            while not _SPACE[data[hi - 1]]:  # to the end of a word
                ahead = np.flatnonzero(_SPACE[data[hi : hi + PIECE]])
                hi = hi + int(ahead[0]) + 1 if len(ahead) else min(hi + PIECE, len(data))
            some, at = _number_words(data[lo:hi])
            numbers.append(some)
            begins.append(at + lo)
            lo = hi
        starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
        return np.concatenate(numbers), np.searchsorted(np.concatenate(begins), starts)


def _hashes(data: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers of the byte ranges a..b, by prefix sums of byte times power (as in :func:`cobasket.llm.text.rolling`)."""
    n = len(data)
    with np.errstate(over="ignore"):
        prefix = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, n), out=prefix[1:])
        return mix((prefix[b] - prefix[a]) * powers(_INVERSE, n + 1)[a]) % np.uint64(TERMS)


def _number_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and first bytes of the words of a run of UTF-8 that ends in white space.

    ASCII and the letters of Latin-1 are normalised as :func:`normal` does, by
    tables; words with any other character go through :func:`normal` itself.
    """
    space = _SPACE[data]
    edges = np.flatnonzero(np.diff(space, prepend=True))
    begin, end = edges[::2], edges[1::2]
    low, strange = _LOWER[data], None
    if data.max() >= 0x80:
        second = np.zeros(len(data), bool)
        second[1:] = data[:-1] == 0xC3
        sign = (data == 0x97) | (data == 0xB7)  # of multiplication, of division
        low[second & (data < 0x9F) & ~sign] += 0x20
        other = (data >= 0x80) & (data != 0xC3) & (~second | sign)
        if other.any():
            seen = np.concatenate([[0], np.cumsum(other)])
            strange = np.flatnonzero(seen[end] > seen[begin])
    letter = _LETTER[low]
    places = np.append(np.flatnonzero(letter), 0)
    before = np.zeros(len(data) + 1, np.int32)
    np.cumsum(letter, out=before[1:])
    first, last = before[begin], before[end]
    some = last > first  # a word of marks alone stays
    numbers = _hashes(low, np.where(some, places[first], begin), np.where(some, places[last - 1] + 1, end))
    if strange is not None:
        words = [data[a:b].tobytes() for a, b in zip(begin[strange].tolist(), end[strange].tolist(), strict=True)]
        place = {w: i for i, w in enumerate(dict.fromkeys(words))}
        plain = [normal(w).encode() for w in place]
        ends = np.cumsum([len(w) for w in plain])
        fixed = _hashes(np.frombuffer(b"".join(plain), np.uint8), ends - [len(w) for w in plain], ends)
        numbers[strange] = fixed[[place[w] for w in words]]
    return numbers.astype(np.int64), begin


class NormalWords(dict):
    """Normalised words of raw words, remembered."""

    def __missing__(self, word: bytes) -> str:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        out = self[word] = normal(word)
        return out


_NUMBERS = TermNumbers()
_NORMAL = NormalWords()


def numbers_of(texts: DataFrame) -> DataFrame:
    """Term numbers of every text (packed uint16), one row for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, some in chunks(batches):
            numbers, starts = _NUMBERS.of_texts(some)
            packed, ends = numbers.astype("<u2").tobytes(), (2 * starts).tolist()
            yield pa.record_batch([pa.array([packed[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())], names=["numbers"])
        release()

    return texts.select("text").mapInArrow(run, "numbers binary")


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of runs of texts end to end, and where each text starts (one more than texts)."""
    for batch in batches:
        packed = batch.column(0).to_pylist()
        starts = np.cumsum([0, *(len(x) // 2 for x in packed)])
        for lo, hi in runs(starts, PASSAGE * PASSAGES):
            yield np.frombuffer(b"".join(packed[lo:hi]), "<u2"), starts[lo : hi + 1] - starts[lo]


def frequencies(numbers: DataFrame) -> np.ndarray:
    """ln((1 + texts) / (1 + texts that hold the term)) of each term, over all rows of :func:`numbers_of`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.zeros(TERMS, np.int64), 0
        for some, starts in _unpacked(batches):
            for lo in range(0, len(starts) - 1, 256):
                own = starts[lo : lo + 257]
                held_by = np.zeros((len(own) - 1, TERMS), bool)
                held_by[np.repeat(np.arange(len(own) - 1), np.diff(own)), some[own[0] : own[-1]]] = True
                held += held_by.sum(0)
            n += len(starts) - 1
        used = np.flatnonzero(held)
        yield pa.record_batch([pa.array(np.append(used, -1)), pa.array(np.append(held[used], n))], names=["term", "n"])

    got = numbers.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()  # at most TERMS + 1 rows
    held = np.zeros(TERMS + 1)
    for r in got:
        held[r.term] += r.n
    return np.log((1 + held[-1]) / (1 + held[:-1])) + 1e-3


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """:func:`frequencies` of the texts of all documents."""
    return frequencies(numbers_of(docs))


def group_sums(rows: np.ndarray, of: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sums of the rows that ``of`` names, for each group of ``size`` entries from ``first``; groups of up to ``GROUP`` by size at once."""
    out = np.empty((len(first), rows.shape[1]), np.float32)
    some = np.argsort(size, kind="stable")
    cuts = np.searchsorted(size[some], np.arange(1, GROUP + 2))
    for n, lo, hi in zip(range(1, GROUP + 1), cuts[:-1], cuts[1:], strict=True):
        if hi > lo:
            own = some[lo:hi]
            out[own] = rows.take(of[first[own]], 0, mode="clip")
            for i in range(1, n):
                out[own] += rows.take(of[first[own] + i], 0, mode="clip")
    for k in some[cuts[-1] :].tolist():
        out[k] = rows.take(of[first[k] : first[k] + size[k]], 0, mode="clip").sum(0)
    return out


def add_product(total: np.ndarray, numbers: np.ndarray, starts: np.ndarray, idf: np.ndarray, weighted: np.ndarray) -> None:
    """Add C'(N(C weighted)) to ``total``: C the term counts of the texts' consecutive passages, N one over the squared length of each times ``idf``.

    ``idf`` and ``weighted`` have a zero at the end, for words that fill up a passage.
    """
    sizes = np.diff(starts)
    per = -(-sizes // PASSAGE)
    filled = np.full(int(per.sum()) * PASSAGE, TERMS, np.uint16)
    filled[np.arange(len(numbers)) + np.repeat((np.cumsum(per) - per) * PASSAGE - starts[:-1], sizes)] = numbers
    passages = np.sort(filled.reshape(-1, PASSAGE), axis=1)
    for lo in range(0, len(passages), PASSAGES):
        some = passages[lo : lo + PASSAGES]
        new = np.ones(some.shape, bool)
        new[:, 1:] = some[:, 1:] != some[:, :-1]
        at = np.flatnonzero(new)
        weight = np.diff(at, append=some.size) * idf[some.ravel()[at]]
        rows = np.zeros((len(some), weighted.shape[1]), np.float32)
        for i in range(PASSAGE):
            rows += weighted.take(some[:, i], 0, mode="clip")
        rows /= np.bincount(at // PASSAGE, weight * weight).astype(np.float32)[:, None]
        order = np.argsort(some.ravel(), kind="stable")
        terms = some.ravel()[order]
        order, terms = order[terms < TERMS], terms[terms < TERMS]
        first = np.flatnonzero(np.diff(terms.astype(np.int64), prepend=-1))
        total[terms[first]] += group_sums(rows, order // PASSAGE, first, np.diff(first, append=len(terms)))


def product(numbers: DataFrame, idf: np.ndarray, q: np.ndarray) -> np.ndarray:
    """A'(AQ) over all passages of rows of :func:`numbers_of`; a task's sums are added up by blocks of terms, ``PARTS`` tasks at a time."""
    scale, filled = idf[:, None].astype(np.float32), np.append(idf, 0)
    weighted = np.vstack([q * scale, np.zeros((1, q.shape[1]), np.float32)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(q.shape, np.float32)
        for some, starts in _unpacked(batches):
            add_product(total, some, starts, filled, weighted)
        total *= scale
        if total.any():
            blocks = range(0, TERMS, TERM_BLOCK)
            parts = [total[b : b + TERM_BLOCK].tobytes() for b in blocks]
            task = [TaskContext.get().partitionId()] * len(blocks)
            yield pa.record_batch([pa.array(blocks, pa.int32()), pa.array(task, pa.int32()), pa.array(parts, pa.binary())], names=["block", "task", "part"])

    def add(table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(p, np.float32) for p in table.column("part").to_pylist()], axis=0, dtype=float).astype(np.float32)
        return pa.table({"block": table.column("block")[:1], "task": table.column("task")[:1], "part": pa.array([total.tobytes()], pa.binary())})

    sums = numbers.mapInArrow(run, "block int, task int, part binary")
    for width in (PARTS, PARTS**2):
        sums = sums.groupBy("block", F.floor(F.col("task") / width)).applyInArrow(add, "block int, task int, part binary")
    out = np.zeros(q.shape)
    for r in sums.groupBy("block").applyInArrow(add, "block int, task int, part binary").collect():  # TERMS by the columns of q
        out[r.block : r.block + TERM_BLOCK] = np.frombuffer(bytes(r.part), np.float32).reshape(-1, q.shape[1])
    return out


def fit(numbers: DataFrame, idf: np.ndarray, rank: int = RANK, seed: int = 11) -> np.ndarray:
    """Term vectors (with idf): the randomised SVD's right vectors, each divided by its singular value.

    The division keeps a few common terms from deciding every cosine. With G = A'A
    over all passages and Q a random basis, G is taken as (GQ)(Q'GQ)^-1(GQ)'
    (Nystrom), after ``POWERS`` turns of Q towards it: a product over all rows each.
    """
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((TERMS, rank + EXTRA)))[0].astype(np.float32)
    for _ in range(POWERS):
        q = np.linalg.qr(product(numbers, idf, q))[0].astype(np.float32)
    image = product(numbers, idf, q)
    core = q.T.astype(float) @ image
    values, turn = np.linalg.eigh((core + core.T) / 2)
    sure = values > 1e-6 * max(values[-1], 1e-6)
    root = image @ (turn[:, sure] / np.sqrt(values[sure]))
    basis, singular, _ = np.linalg.svd(root, full_matrices=False)
    values = np.zeros(rank)
    n = min(rank, len(singular))
    values[:n] = singular[:n] ** 2
    out = np.zeros((TERMS, rank))
    out[:, :n] = basis[:, :n]
    out = out / np.sqrt(np.maximum(values, 1e-9)) * (values > 1e-6)
    return (out * idf[:, None]).astype(np.float32)


def latent_space(docs: DataFrame, items: DataFrame, idf: np.ndarray, rank: int = RANK, seed: int = 11) -> np.ndarray:
    """:func:`fit` over every passage of all documents and items."""
    return fit(numbers_of(docs.select("text").unionByName(items.select("text"))), idf, rank, seed)


@dataclass
class Item:
    item_id: int | None
    words: list[str]
    answer: list[str]
    places: dict[str, int]


def read_items(rows: list) -> list[Item]:
    """Benchmark rows (item_id, text) with words, and their answers."""
    out = []
    for r in rows:
        words = [normal(w) for w in (r.text or "").encode().split()]
        if not words:
            continue
        parts = [p for p in re.split(r"\?|(?<=[.!])\s", r.text) if p.split()]
        answer = [normal(w) for w in parts[-1].encode().split()]
        places: dict[str, int] = {}
        for i, w in enumerate(words):
            places[w] = places.get(w, 0) | 1 << i
        out.append(Item(r.item_id, words, answer, places))
    return out


def common_length(places: dict[str, int], n: int, words: list[str]) -> int:
    """Length of the longest common subsequence; ``places`` has the bits of each word's places in the other sequence, of length ``n``."""
    full = (1 << n) - 1
    row = full
    for w in words:
        at = places.get(w)
        if at:
            hit = row & at
            row = ((row + hit) | (row - hit)) & full
    return n - row.bit_count()


def matches(item: Item, words: list[str], least: float) -> tuple[float, float] | None:
    """The shares of an item and of its answer that a run of words holds in order, if it is a leak."""
    n = len(item.words)
    if sum(w in item.places for w in words) < least * n:
        return None
    common = common_length(item.places, n, words) / n
    if common < least:
        return None
    m = len(item.answer)
    places: dict[str, int] = {}
    for i, w in enumerate(item.answer):
        places[w] = places.get(w, 0) | 1 << i
    answer = common_length(places, m, words) / m
    if n < SHORT:
        joined = " ".join(words)
        return (common, answer) if f" {' '.join(item.words)} " in f" {joined} " else None
    return (common, answer) if common >= SURE or answer >= MIN_ANSWER else None


def scales_of(items: list[Item]) -> list[tuple[int, np.ndarray]]:
    """Window lengths and the items that each is for."""
    sizes = np.array([len(i.words) for i in items])
    step = np.round(np.log(sizes) / math.log(SCALE)).astype(int)
    return [(max(2, round(float(np.median(sizes[step == s])))), np.flatnonzero(step == s)) for s in np.unique(step)]


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt(np.einsum("ij,ij->i", x, x))[:, None], 1e-9)


class Windows:
    """Latent vectors of the windows of a run of documents, from running sums over blocks of ``grain`` words.

    ``numbers`` are the documents' term numbers end to end, ``sizes`` their word
    counts; each document is filled up to whole blocks with words that weigh nothing.
    """

    def __init__(self, numbers: np.ndarray, sizes: np.ndarray, vectors: np.ndarray, grain: int):
        self.sizes, self.grain, self.blocks = sizes, grain, -(-sizes // grain)
        self.first = np.cumsum(self.blocks) - self.blocks
        total = int(self.blocks.sum())
        padded = np.full(total * grain, len(vectors) - 1)  # the last vector is zero
        padded[np.arange(len(numbers)) + np.repeat(self.first * grain - np.cumsum(sizes) + sizes, sizes)] = numbers
        rank = vectors.shape[1]
        self.sums = np.zeros((total + 1, rank), np.float32 if total * grain <= 4 * RUN_WORDS else np.float64)
        step = max(1, RUN_WORDS // grain)
        for lo in range(0, total, step):
            some = vectors.take(padded[lo * grain : (lo + step) * grain], 0, mode="clip").reshape(-1, grain, rank)
            into = self.sums[lo + 1 : lo + step + 1]
            for i in range(grain):
                into += some[:, i]
        np.cumsum(self.sums, axis=0, out=self.sums)

    def of_size(self, size: int, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Documents, first and end words, and vectors of the windows of ``size`` words, at most ``limit`` at a time."""
        long, step = max(1, round(size / self.grain)), max(1, size // OVERLAP // self.grain)
        count = np.where(self.blocks > 0, -(-np.maximum(1, self.blocks - long + step) // step), 0)
        doc = np.repeat(np.arange(len(count)), count)
        begin = (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * step
        end = np.minimum(begin + long, self.blocks[doc])
        for lo in range(0, len(doc), limit):
            d, a, b = doc[lo : lo + limit], begin[lo : lo + limit], end[lo : lo + limit]
            x = self.sums.take(self.first[d] + b, 0, mode="clip")
            x -= self.sums.take(self.first[d] + a, 0, mode="clip")
            yield d, a * self.grain, np.minimum(b * self.grain, self.sizes[d]), x.astype(np.float32, copy=False)


def shared_terms(numbers: np.ndarray, begin: np.ndarray, end: np.ndarray, item: np.ndarray, held: np.ndarray) -> np.ndarray:
    """How many of the words begin..end have terms of the item, for many ranges of at least a word; ``held`` has a bit for each (item, term)."""
    out, sizes = np.zeros(len(begin), np.int64), end - begin
    cut = np.cumsum(sizes) // HELD
    for part in np.split(np.arange(len(begin)), np.flatnonzero(np.diff(cut)) + 1):
        if len(part):
            size = sizes[part]
            offset = np.cumsum(size) - size
            number = numbers[np.arange(int(size.sum())) + np.repeat(begin[part] - offset, size)]
            hit = held[np.repeat(item[part], size), number >> 3] >> (number & 7).astype(np.uint8) & 1
            out[part] = np.add.reduceat(hit, offset, dtype=np.int64)
    return out


def runs(starts: np.ndarray, words: int = RUN_WORDS) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``words`` words, one document at least."""
    lo = 0
    while lo < len(starts) - 1:
        hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + words, "right")) - 1)
        yield lo, hi
        lo = hi


def search(docs: DataFrame, items: list[Item], vectors: np.ndarray, min_cosine: float = MIN_COSINE, least: float = MIN_COMMON) -> tuple[DataFrame, Broadcast]:
    """doc_id, item_id, cosine, common, answer of every leak (a pair more than once where its doc_id repeats), and the broadcast that this reads."""
    sent = docs.sparkSession.sparkContext.broadcast((items, vectors))  # TERMS by RANK, and a block of items

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, vectors = sent.value
        latent = unit(np.stack([vectors[_NUMBERS.of([w.encode() for w in i.words])].sum(0) for i in items]))
        scales = [(size, own, np.ascontiguousarray(latent[own].T)) for size, own in scales_of(items)]
        grain = max(1, min(size for size, _, _ in scales) // OVERLAP // 2)
        vectors = np.vstack([vectors, np.zeros((1, vectors.shape[1]), vectors.dtype)])
        held = np.zeros((len(items), TERMS // 8), np.uint8)
        for i, item in enumerate(items):
            number = _NUMBERS.of([w.encode() for w in item.words])
            np.bitwise_or.at(held[i], number >> 3, (1 << (number & 7)).astype(np.uint8))
        lengths = np.array([len(i.words) for i in items])
        for batch, texts in chunks(batches):
            ids, found = batch.column(0).to_pylist(), []
            numbers, starts = _NUMBERS.of_texts(texts)
            for lo, hi in runs(starts):
                begins, sizes = starts[lo:hi], np.diff(starts[lo : hi + 1])
                windows = Windows(numbers[starts[lo] : starts[hi]], sizes, vectors, grain)
                best: dict[tuple[int, int], tuple] = {}
                words: dict[int, list[bytes]] = {}
                for size, own, matrix in scales:
                    for doc, a, b, x in windows.of_size(size, max(1, HELD // len(own))):
                        length = np.maximum(np.sqrt(np.einsum("ij,ij->i", x, x)), 1e-9)[:, None]
                        product = x @ matrix
                        i, k = np.divmod(np.flatnonzero(product >= min_cosine * length), len(own))
                        item, d = own[k], doc[i]
                        around = lengths[item] // 2
                        a, b = np.maximum(0, a[i] - around), np.minimum(sizes[d], b[i] + around)
                        near = shared_terms(numbers, begins[d] + a, begins[d] + b, item, held) >= least * lengths[item]
                        some = zip(d[near].tolist(), item[near].tolist(), a[near].tolist(), b[near].tolist(), (product[i[near], k[near]] / length[i[near], 0]).tolist(), strict=True)
                        for d, n, a, b, c in some:
                            have = best.get((d, n))
                            if have and have[1] > 0.95:
                                continue
                            if d not in words:
                                words[d] = texts[lo + d].split()
                            got = matches(items[n], [_NORMAL[w] for w in words[d][a:b]], least)
                            if got and (not have or got > have[1:]):
                                best[d, n] = (c, *got)
                found += [(ids[lo + d], items[n].item_id, *b) for (d, n), b in best.items()]
            columns = zip(*found, strict=True) if found else [[]] * 5
            types = [pa.int64()] * 2 + [pa.float64()] * 3
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[f.strip().split(" ")[0] for f in _FOUND.split(",")])
        _NORMAL.clear()
        release()

    return docs.select("doc_id", "text").mapInArrow(run, _FOUND), sent


def find_leaks(docs: DataFrame, benchmark: DataFrame, rank: int = RANK, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """doc_id, item_id, cosine, common (share of the item found), answer (share of its answer), one row for each leak.

    Items are searched a block of about ``item_bytes`` at a time, dealt by hash
    of the distinct rows; the leaks of a block are written before the next begins.
    """
    spark = docs.sparkSession
    items = benchmark.select("item_id", "text").where("text is not null").distinct()
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0)).alias("bytes")).first().bytes
    numbers = stored(numbers_of(docs), "term-numbers")  # 2 bytes a word
    idf = frequencies(numbers)
    vectors = fit(numbers.unionByName(numbers_of(items)), idf, rank)
    blocks, scratch = 1 + size // item_bytes, scratch_path(spark, "leaks")
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    for block in range(blocks):
        known = read_items(dealt.where(F.col("block") == block).orderBy("item_id", "text").collect())  # about item_bytes
        if known:
            found, sent = search(docs, known, vectors)
            found.write.mode("append").parquet(scratch)
            sent.destroy()
    spark.createDataFrame([], _FOUND).write.mode("append").parquet(scratch)
    best = F.max(F.struct("common", "answer", "cosine")).alias("best")
    found = spark.read.schema(_FOUND).parquet(scratch).groupBy("doc_id", "item_id").agg(best)
    return found.select("doc_id", "item_id", "best.cosine", "best.common", "best.answer")


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without leaks, with their own columns."""
    leaked = find_leaks(docs, benchmark).select(F.col("doc_id").alias("leaked")).distinct()
    rows = docs.select(F.struct("*").alias("doc"))
    return rows.join(leaked, F.col("doc.doc_id").eqNullSafe(F.col("leaked")), "left_anti").select("doc.*")
