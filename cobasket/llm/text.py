"""Helpers that run inside tasks: words, word hashes and token ids of whole texts.

A word is ``[^\\x20\\x09-\\x0D]+``. ``bytes.split()`` cuts at exactly those six
ASCII characters, so texts stay UTF-8 bytes and are never decoded for it.
"""

from __future__ import annotations

import ctypes
import gc
import os
import re
import struct
from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Entries a per-process cache may hold; a full cache starts anew.
CACHE_ENTRIES = 300_000
#: Text bytes worked on at a time inside one task.
CHUNK_BYTES = 4 << 20
#: The C library's call that returns freed memory to the system, where it has one (glibc).
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def utf8(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """Texts as UTF-8 bytes; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_binary()), b"").to_pylist()


def chunks(batches: Iterable[pa.RecordBatch], text: str = "text", size: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cut Arrow batches into runs of about ``size`` bytes of text, in order; only the texts of one run are Python's."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        lo = held = 0
        for i, n in enumerate(pc.fill_null(pc.binary_length(column), 0).to_pylist()):
            held += n
            if held >= size:
                yield batch.slice(lo, i + 1 - lo), utf8(column.slice(lo, i + 1 - lo))
                lo, held = i + 1, 0
        if lo < batch.num_rows:
            yield batch.slice(lo), utf8(column.slice(lo))


def release() -> None:
    """Give back the memory that this process has no use for: it waits for other tasks beside those at work."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


class WordHashes(dict):
    """64-bit hashes of words, remembered."""

    def __init__(self, seed: int = 0):
        super().__init__()
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word, self.seed)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def word_hashes(texts: list[bytes], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts end to end, and where each text starts (one more than texts)."""
    parts = [hashes.of(t.split()) for t in texts]
    starts = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=starts[1:])
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), starts


def rolling(hashes: np.ndarray, width: int, base: int) -> np.ndarray:
    """Rabin-Karp hashes modulo 2**64 of every ``width`` consecutive entries.

    With prefix sums P of h[i] * base**i, the window at i hashes to
    (P[i + width] - P[i]) * base**-i: one multiplication a window, whatever
    its width. ``base`` is odd and so has an inverse. Hashes are mixed at the
    end, because low bits of such sums depend on low bits only.
    """
    n = len(hashes)
    if n < width:
        return np.zeros(0, np.uint64)
    inverse = pow(base, -1, 1 << 64)
    with np.errstate(over="ignore"):
        up, down = powers(base, n), powers(inverse, n)
        prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * up, out=prefix[1:])
        return mix((prefix[width:] - prefix[:-width]) * down[: n - width + 1])


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        with np.errstate(over="ignore"):
            have = np.cumprod(have, dtype=np.uint64)
        _POWERS[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (the splitmix64 finalizer)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


#: A mark that follows a word's letters; none of these marks begins a special token or a contraction.
_MARKED = re.compile(rb"[.,;:!?$%&*#](?:(?<=[A-Za-z].)|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf].))")
#: Longer words are not remembered.
LONG_WORD = 128


def distinct_words(texts: list[bytes]) -> tuple[list[bytes], pa.Array, np.ndarray]:
    """The distinct words of all texts, which of them each word is, and where each text starts (one more than texts).

    Arrow splits at the same six characters; white space at the ends of a text gives an empty word.
    """
    split = pc.ascii_split_whitespace(pa.array(texts, pa.large_binary()).view(pa.large_string()))
    coded = split.flatten().dictionary_encode()
    words = coded.dictionary.view(pa.large_binary())
    ends = np.frombuffer(words.buffers()[1], "<i8")[words.offset : words.offset + len(words) + 1].tolist() if len(words) else []
    data = words.buffers()[2].to_pybytes() if ends and words.buffers()[2] else b""
    return [data[a:b] for a, b in pairwise(ends)], coded.indices, np.asarray(split.offsets)


class WordIds(dict):
    """Token ids (packed little-endian uint32) of words, remembered.

    The tokenizer drops white space and never joins across it, so the ids of
    a text are those of its words, end to end. It also never joins letters and
    the marks after them, and lower-cases, so texts are lower-cased (in ASCII) and
    cut between letters and marks as a whole, which leaves fewer words to encode.
    A run of texts looks each of its distinct words up once; Arrow puts their ids
    where the words are. Words not met for a while are forgotten.
    """

    def __init__(self, path: str):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # lower-case ASCII letters reach the model as they are, which saves the steps before it
        plain = ["the", "zebra", "q", "counterclockwise"]
        self.direct = all([t.id for t in self.tokenizer.model.tokenize(x)] == self.tokenizer.encode(x, add_special_tokens=False).ids for x in plain)
        self.older: dict[bytes, bytes] = {}  # the words of before; those in use come back

    def cut(self, text: bytes) -> bytes:
        """A text with a space between letters and the marks after them."""
        # special tokens tell cases apart, and so may letters before a combining mark
        if b"<|" not in text and b"\xcc" not in text:
            text = text.lower()
        return _MARKED.sub(rb" \g<0>", text)

    def learn(self, words: list[bytes]) -> None:
        """Encode words that are not known yet."""
        older, rest = self.older, []
        new = []
        for w in words:
            known = older.get(w)
            if known is None:
                new.append(w)
            else:
                self[w] = known
        if self.direct:
            tokenize, pack = self.tokenizer.model.tokenize, struct.pack
            for w in new:
                if w.isalpha() and w.islower():
                    ids = [t.id for t in tokenize(w.decode())]
                    self[w] = pack(f"<{len(ids)}I", *ids)
                else:
                    rest.append(w)
        else:
            rest = new
        for lo in range(0, len(rest), 20_000):
            some = rest[lo : lo + 20_000]
            found = self.tokenizer.encode_batch_fast([w.decode("utf-8") for w in some], add_special_tokens=False)
            for w, e in zip(some, found, strict=True):
                self[w] = struct.pack(f"<{len(e.ids)}I", *e.ids)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Packed ids of each text."""
        words, places, starts = distinct_words([self.cut(t) for t in texts])
        if len(self) >= CACHE_ENTRIES:
            self.older = dict(self)
            self.clear()
        new = [w for w in words if w not in self]
        self.learn(new)
        ids = pa.array([self[w] for w in words], pa.large_binary()).take(places)
        for w in new:
            if len(w) > LONG_WORD:
                del self[w]
        ends = np.frombuffer(ids.buffers()[1], "<i8")[starts].tolist() if len(ids) else [0] * len(starts)
        data = ids.buffers()[2].to_pybytes() if ends[-1] else b""
        return [data[a:b] for a, b in pairwise(ends)]


_IDS: dict[str, WordIds] = {}


def word_ids(path: str | None) -> WordIds:
    """The process's encoder for a tokenizer file that drops white space."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    if path not in _IDS:
        _IDS[path] = WordIds(path)
    return _IDS[path]
