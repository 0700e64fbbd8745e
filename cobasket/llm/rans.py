"""Static range asymmetric numeral system over numpy arrays.

One frequency table serves every block. A block is coded by ``lanes``
interleaved states (token i belongs to lane i % lanes), all advanced together
by array operations, into one stream of 32-bit words. Every ``CHECKPOINT``
steps the decoder's states and stream position are kept, so that decoding can
begin there and the parts of a block decode in parallel. A crc32 covers
the payload of a block.

Payload, little-endian: u32 magic, u32 tokens, u32 lanes, u32 checkpoints,
u32 words; then per checkpoint u32 step, u32 word position and ``lanes`` u64
states (the first one is step 0); then the words.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = 0x31534E52
SCALE_BITS = 20
LOW = 1 << 31
MAX_LANES = 4096
#: Steps between checkpoints.
CHECKPOINT = 64
_HEAD = struct.Struct("<5I")
_MARK = struct.Struct("<2I")


def quantise(counts: np.ndarray, scale_bits: int = SCALE_BITS) -> np.ndarray:
    """Integer frequencies that sum to ``2**scale_bits``, at least 1 where a count is positive.

    Shares are rounded down; what is left over goes to the largest counts
    (ties: the smaller id), and what is missing is taken from them.
    """
    total, target = int(counts.sum()), 1 << scale_bits
    freq = np.zeros(len(counts), np.int64)
    used = np.flatnonzero(counts)
    if not len(used):
        return freq
    if len(used) > target:
        raise ValueError("more symbols than the frequency scale holds")
    share = counts[used] / total
    own = np.maximum(1, np.floor(share * target)).astype(np.int64)
    rank = np.argsort(-counts[used], kind="stable")
    rest = target - int(own.sum())
    while rest > 0:
        some = rank[:rest]
        own[some] += 1
        rest -= len(some)
    while rest < 0:
        some = rank[own[rank] > 1][:-rest]
        own[some] -= 1
        rest += len(some)
    freq[used] = own
    return freq


class Table:
    """Frequencies of token ids, their running sums, and the id of each slot."""

    def __init__(self, freq: np.ndarray, scale_bits: int = SCALE_BITS):
        self.bits = scale_bits
        self.freq = freq.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64) if len(freq) else self.freq
        self._slots: np.ndarray | None = None

    @property
    def slots(self) -> np.ndarray:
        if self._slots is None:
            self._slots = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))
        return self._slots


def encode(ids: np.ndarray, table: Table, max_lanes: int = MAX_LANES) -> bytes:
    """The payload of one block."""
    n = len(ids)
    lanes = int(max(1, min(max_lanes, n // 64)))
    steps = -(-n // lanes)
    state = np.full(lanes, LOW, np.uint64)
    bits, limit = np.uint64(table.bits), np.uint64(63 - table.bits)
    out: list[np.ndarray] = []
    written, marks = 0, []
    for step in range(steps - 1, -1, -1):
        part = ids[step * lanes : (step + 1) * lanes]
        x = state[: len(part)]
        f, c = table.freq[part], table.start[part]
        full = x >= (f << limit)
        if full.any():
            out.append(x[full].astype(np.uint32))
            written += len(out[-1])
            x[full] >>= np.uint64(32)
        q, r = np.divmod(x, f)
        x[:] = (q << bits) + r + c
        if step % CHECKPOINT == 0:
            marks.append((step, written, state.copy()))
    if not marks:
        marks.append((0, 0, state))
    out.reverse()
    words = np.concatenate(out) if out else np.zeros(0, np.uint32)
    parts = [_HEAD.pack(MAGIC, n, lanes, len(marks), len(words))]
    for step, done, states in reversed(marks):
        parts += [_MARK.pack(step, len(words) - done), states.astype("<u8").tobytes()]
    return b"".join([*parts, words.astype("<u4").tobytes()])


def checkpoints(payload: bytes) -> list[tuple[int, int]]:
    """Token ranges that can be decoded each on its own."""
    magic, n, lanes, marks, _ = _HEAD.unpack_from(payload)
    if magic != MAGIC:
        raise ValueError("not a coded block")
    size = _MARK.size + 8 * lanes
    begins = [_MARK.unpack_from(payload, _HEAD.size + k * size)[0] * lanes for k in range(marks)]
    return [(a, b) for a, b in zip(begins, [*begins[1:], n], strict=True) if b > a]


def decode(payload: bytes, table: Table, lo: int = 0, hi: int | None = None) -> np.ndarray:
    """Token ids lo..hi of a block, beginning at the last checkpoint before ``lo``."""
    magic, n, lanes, marks, n_words = _HEAD.unpack_from(payload)
    if magic != MAGIC:
        raise ValueError("not a coded block")
    hi = n if hi is None else min(hi, n)
    if lo >= hi:
        return np.zeros(0, np.uint32)
    size = _MARK.size + 8 * lanes
    at = _HEAD.size + marks * size
    words = np.frombuffer(payload, "<u4", n_words, at)
    first = min(lo // lanes // CHECKPOINT, marks - 1)
    place = _HEAD.size + first * size
    step, pos = _MARK.unpack_from(payload, place)
    state = np.frombuffer(payload, "<u8", lanes, place + _MARK.size).astype(np.uint64)
    begin = step * lanes
    ids = np.empty(hi - begin, np.uint32)
    bits, mask, low = np.uint64(table.bits), np.uint64((1 << table.bits) - 1), np.uint64(LOW)
    for at in range(begin, hi, lanes):
        k = min(lanes, n - at)
        x = state[:k]
        slot = x & mask
        s = table.slots[slot]
        x[:] = table.freq[s] * (x >> bits) + slot - table.start[s]
        less = np.flatnonzero(x < low)
        x[less] = (x[less] << np.uint64(32)) | words[pos : pos + len(less)]
        pos += len(less)
        take = min(k, hi - at)
        ids[at - begin : at - begin + take] = s[:take]
    return ids[lo - begin :]


def checksum(*parts: bytes) -> int:
    """crc32 of the parts, one after another."""
    value = 0
    for part in parts:
        value = zlib.crc32(part, value)
    return value
