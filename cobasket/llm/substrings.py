"""Substring deduplication: Rabin-Karp hashes of every fixed-length word window.

A window is ``width`` consecutive words of one document. A word goes if any
window that covers it has a word sequence that also starts in a document with a
smaller doc_id; windows are judged on the input.

Every window of every document is hashed by prefix sums of a polynomial and
meets all equal windows in one bucket of the hash space:

1. Each task hashes its documents' windows, a chunk of texts at a time, and
   keeps of equal windows in a chunk the one of the smallest doc_id (the others
   are known to go). For each bucket (the top bits of the hash) the chunk sends
   one row: the remaining hash bytes of its windows, packed, in order of
   document, and how many belong to each document. A passage that a third of
   all documents share is one entry for each chunk.
2. Each bucket finds, for equal hashes, the smallest doc_id, and answers with
   the hashes that go, packed for each document.
3. Documents are joined with their answers; their windows are hashed again, and
   the windows that go are merged into maximal removal intervals.

A window's hash has 64 bits by default (``hash_bytes``=8): N windows lose a word
by collision with a chance of about N**2 / 2**65. ``hash_bytes`` up to 16 adds
a second polynomial for larger corpora.

Defined results: a null text has no words; texts of fewer than ``width`` words
are never touched; a null doc_id is larger than any other and its windows don't
count against others; rows of one doc_id are one document's windows, none of
them smaller than the other; an empty table stays empty; other columns stay.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cobasket.llm.text import WordHashes, chunks, rolling, word_hashes

WIDTH = 13
HASH_BYTES = 8
#: Windows a bucket holds on average; a bucket is worked on in memory.
BUCKET_WINDOWS = 1 << 20
_BASES = (0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93)
_SENT = "bucket int, docs binary, tails binary"
_GONE = "doc_id long, gone binary"
_NULL = np.iinfo(np.int64).max
_HASHES: list[WordHashes] = []


def window_hashes(texts: list[bytes], width: int, hash_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash rows (uint64, one or two columns) of all windows of all texts, and the text of each window."""
    while len(_HASHES) < 2:
        _HASHES.append(WordHashes(len(_HASHES)))
    columns = []
    for hashes, base in zip(_HASHES[: 1 if hash_bytes <= 8 else 2], _BASES, strict=False):
        words, starts = word_hashes(texts, hashes)
        columns.append(rolling(words, width, base))
    sizes = np.diff(starts)
    owner = np.repeat(np.arange(len(texts)), sizes)
    n = len(columns[0])
    inside = owner[:n] == owner[len(owner) - n :] if n else np.zeros(0, bool)
    return np.stack(columns, 1)[inside], owner[:n][inside]


def _first(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by key (stable), and where in it a new key begins. ``keys`` has one or two uint64 columns."""
    order = np.argsort(keys[:, 0], kind="stable") if keys.shape[1] == 1 else np.lexsort((keys[:, 1], keys[:, 0]))
    ordered = keys[order]
    new = np.ones(len(order), bool)
    new[1:] = (ordered[1:] != ordered[:-1]).any(1)
    return order, new


def _pack(keys: np.ndarray, hash_bytes: int) -> np.ndarray:
    """The first ``hash_bytes`` bytes, high byte first, of each key."""
    raw = keys.astype(">u8").view(np.uint8).reshape(len(keys), -1)
    return np.ascontiguousarray(raw[:, :hash_bytes])


def _unpack(raw: np.ndarray) -> np.ndarray:
    """Rows of up to 16 bytes as one or two uint64 columns."""
    n, have = raw.shape
    wide = np.zeros((n, 8 if have <= 8 else 16), np.uint8)
    wide[:, :have] = raw
    return wide.view(">u8").astype(np.uint64).reshape(n, -1)


def _runs(docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of a sorted array: its values, and where each one's run begins and the last one ends."""
    edge = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]]))
    return docs[edge], np.append(edge, len(docs))


def _pack_docs(docs: np.ndarray) -> bytes:
    """A sorted array of doc_ids: its distinct values as differences, and how often each occurs."""
    names, ends = _runs(docs)
    return zlib.compress(np.diff(names, prepend=0).astype("<i8").tobytes() + np.diff(ends).astype("<i4").tobytes(), 1)


def _unpack_docs(blob: bytes) -> np.ndarray:
    raw = zlib.decompress(blob)
    n = len(raw) // 12
    return np.repeat(np.cumsum(np.frombuffer(raw, "<i8", n)), np.frombuffer(raw, "<i4", n, 8 * n))


def _batch(kind: str, *columns: list) -> pa.RecordBatch:
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.strip().split(" ") for f in kind.split(",")]
    return pa.record_batch([pa.array(c, types[t]) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def send(docs: DataFrame, width: int, bits: int, hash_bytes: int) -> DataFrame:
    """Step 1. Negative buckets carry windows already known to go, for their own documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            ids = np.array([_NULL if d is None else d for d in batch.column(0).to_pylist()], np.int64)
            by_doc = np.argsort(ids, kind="stable")
            keys, owner = window_hashes([texts[i] for i in by_doc], width, hash_bytes)
            if not len(keys):
                continue
            doc = ids[by_doc][owner]
            # the first of equal windows is that of the smallest doc_id here
            order, new = _first(keys)
            least = doc[order][np.flatnonzero(new)][np.cumsum(new) - 1]
            known, first = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
            known[order], first[order] = doc[order] > least, new
            out: tuple[list, list, list] = [], [], []

            def row(bucket: int, docs: np.ndarray, tails: np.ndarray, out: tuple = out) -> None:
                for column, value in zip(out, (bucket, _pack_docs(docs), tails.tobytes()), strict=True):
                    column.append(value)

            if known.any():
                row(-1 - int(doc[0] % 251), doc[known], _pack(keys[known], hash_bytes))
            keys, doc = keys[first], doc[first]
            bucket = (keys[:, 0] >> np.uint64(64 - bits)).astype(np.uint16)
            order = np.argsort(bucket, kind="stable")
            tails, doc = _pack(keys[order], hash_bytes)[:, 1:], doc[order]
            numbers, ends = _runs(bucket[order])
            for b, lo, hi in zip(numbers.tolist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                row(b, doc[lo:hi], np.ascontiguousarray(tails[lo:hi]))
            yield _batch(_SENT, *out)

    return docs.mapInArrow(run, _SENT)


def removals(docs: DataFrame, width: int = WIDTH, hash_bytes: int = HASH_BYTES, bucket_windows: int = BUCKET_WINDOWS) -> DataFrame:
    """Steps 1 and 2: doc_id (null: the largest long) and the packed hashes of its windows that go, in pieces."""
    if not 8 <= hash_bytes <= 16:
        raise ValueError("hash_bytes must be 8 to 16")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # about one window for each 6 bytes of text; 2**8 to 2**16 buckets
    bits = int(min(16, max(8, np.ceil(np.log2(max(1, total / 6 / bucket_windows))))))

    def judge(key: tuple, rows: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        doc = np.concatenate([_unpack_docs(x) for x in rows.column("docs").to_pylist()])
        raw = np.concatenate([np.frombuffer(x, np.uint8) for x in rows.column("tails").to_pylist()])
        if bucket >= 0:
            raw = raw.reshape(len(doc), hash_bytes - 1)
            order, new = _first(_unpack(raw))
            least = np.minimum.reduceat(doc[order], np.flatnonzero(new))
            gone = order[doc[order] > least[np.cumsum(new) - 1]]
            top = np.full((len(gone), 1), bucket >> (bits - 8), np.uint8)
            doc, raw = doc[gone], np.concatenate([top, raw[gone]], 1)
        else:
            raw = raw.reshape(len(doc), hash_bytes)
        order = np.argsort(doc, kind="stable")
        raw = raw[order]
        names, ends = _runs(doc[order]) if len(doc) else (doc, np.zeros(1, int))
        return pa.Table.from_batches([_batch(_GONE, names, [raw[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)])])

    return send(docs.select("doc_id", "text"), width, bits, hash_bytes).groupBy("bucket").applyInArrow(judge, _GONE)


def intervals(text: bytes, gone: list[bytes] | None, width: int, hash_bytes: int) -> list[tuple[int, int]]:
    """Maximal removal intervals [first, end) of a text, in words."""
    if not gone:
        return []
    keys, _ = window_hashes([text], width, hash_bytes)
    kind = f"V{hash_bytes}"
    mine = np.frombuffer(_pack(keys, hash_bytes).tobytes(), kind)
    if hash_bytes == 8:
        hit = np.flatnonzero(np.isin(mine.view(np.uint64), np.frombuffer(b"".join(gone), np.uint64)))
    else:
        held = {bytes(x) for x in np.frombuffer(b"".join(gone), kind)}
        hit = np.flatnonzero([bytes(x) in held for x in mine])
    if not len(hit):
        return []
    cut = np.flatnonzero(np.diff(hit) > width)
    begins, ends = hit[np.append(0, cut + 1)], hit[np.append(cut, len(hit) - 1)] + width
    return list(zip(begins.tolist(), ends.tolist(), strict=True))


def dedup_windows(docs: DataFrame, width: int = WIDTH, hash_bytes: int = HASH_BYTES, bucket_windows: int = BUCKET_WINDOWS, with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, intervals (in words), and the kept text (words joined by a space)."""
    gone = removals(docs, width, hash_bytes, bucket_windows).groupBy("doc_id").agg(F.collect_list("gone").alias("gone"))
    gone = gone.select(F.col("doc_id").alias("gone_id"), "gone")
    rows = docs.select("doc_id", "text")
    rows = rows.join(gone, F.coalesce("doc_id", F.lit(_NULL)) == F.col("gone_id"), "left").select("doc_id", "text", "gone")
    kind = "doc_id long, n_words long, n_removed long, kept_sha256 string, intervals array<struct<first:long,end:long>>"
    kind += ", text string" if with_text else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
        for batch, texts in chunks(batches):
            sizes, removed, digests, found, left = [], [], [], [], []
            for text, pieces in zip(texts, batch.column(2).to_pylist(), strict=True):
                words, own = text.split(), intervals(text, pieces, width, hash_bytes)
                sizes.append(len(words))
                removed.append(sum(b - a for a, b in own))
                for a, b in reversed(own):
                    del words[a:b]
                kept = b" ".join(words)
                digests.append(hashlib.sha256(kept).hexdigest())
                found.append([{"first": a, "end": b} for a, b in own])
                if with_text:
                    left.append(kept.decode())
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string()), pa.array(found, spans)]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256", "intervals"]
            yield pa.record_batch(columns + [pa.array(left, pa.string())] * with_text, names=names + ["text"] * with_text)

    return rows.mapInArrow(run, kind)


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    return dedup_windows(docs, with_text=False).drop("intervals")


ORACLE = f"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), g AS (
  SELECT doc_id, i, array_to_string(words[i:i + {WIDTH - 1}], ' ') AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - {WIDTH - 2})) AS i FROM w WHERE len(words) >= {WIDTH})
), f AS (SELECT gram, min(doc_id) AS least FROM g GROUP BY gram HAVING min(doc_id) < max(doc_id)
), c AS (
  SELECT DISTINCT g.doc_id, unnest(range(g.i, g.i + {WIDTH})) AS p FROM g JOIN f ON g.gram = f.gram AND f.least < g.doc_id
), a AS (
  SELECT w.doc_id, p, word FROM (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM w) w
), k AS (
  SELECT a.doc_id, count(c.p) AS n_removed, string_agg(a.word, ' ' ORDER BY a.p) FILTER (WHERE c.p IS NULL) AS kept
  FROM a LEFT JOIN c ON a.doc_id = c.doc_id AND a.p = c.p GROUP BY a.doc_id
)
SELECT w.doc_id, CAST(len(w.words) AS BIGINT) AS n_words, coalesce(k.n_removed, 0) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM w LEFT JOIN k ON w.doc_id = k.doc_id
"""
