"""Sum-of-squares packing of tokenised documents into windows of a fixed size.

Whole windows are cut off a document first. The rest, of ``s`` tokens, goes
online to the fill level h (0: a new window) for which the sum over all levels
of squared counts of partially filled windows is least afterwards: with N
windows at each level, the move from h to h + s changes that sum by
2 * (N[h + s] - N[h]) + 2, by 1 - 2 * N[h] if it fills the window, and by
2 * N[s] + 1 for a new window (ties: the fullest level). N is one array with an
entry for each level, so a placement is one array operation.

When a task ends, or holds ``max_open`` open windows, its open windows are
drained: taken in order of fill, they are joined end to end and cut anew at
the window size. At the end of a task the tokens left over (less than one
window) become windows whose sizes are powers of two, which need no padding.

The tasks are those of the input scan: nothing is shuffled, and a task holds
at most ``max_open`` windows and one chunk of texts.

Defined results: a null or empty text has only the end id; a null doc_id is
kept; repeated rows are packed each; an empty table gives no row; other
columns are ignored. Window ids are ``task << 40 | number``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from cobasket.llm.text import chunks, word_ids

WINDOW = 2048
END_ID = 1
MAX_OPEN = 4096
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Packer:
    """The state of one task. A piece is (document, start, packed ids, document's tokens)."""

    def __init__(self, window: int, first: int, max_open: int):
        self.window, self.next, self.max_open = window, first, max_open
        self.level = np.zeros(window, np.int64)  # open windows by fill
        self.open: list[list[list[tuple]]] = [[] for _ in range(window)]  # by fill, each a list of pieces
        self.n_open = 0
        self.done: list[tuple] = []

    def close(self, pieces: list[tuple]) -> None:
        """Write one window's rows."""
        offset = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            self.done.append((doc, start, n, zlib.crc32(ids), total, self.next, offset))
            offset += n
        self.next += 1

    def add(self, doc: int | None, ids: bytes) -> None:
        total, width = len(ids) // 4, 4 * self.window
        whole = len(ids) // width * width
        for at in range(0, whole, width):
            self.close([(doc, at // 4, ids[at : at + width], total)])
        if whole < len(ids):
            self.place((doc, whole // 4, ids[whole:], total))
            if self.n_open >= self.max_open:
                self.drain()

    def best(self, size: int) -> int:
        """The fill level to put ``size`` tokens on."""
        n, top = self.level, self.window - size
        change = np.empty(top + 1, np.int64)
        change[:top] = 2 * (n[size:] - n[:top]) + 2
        change[0] = 2 * n[size] + 1
        if top:
            change[top] = 1 - 2 * n[top]
        free = n[: top + 1] > 0
        free[0] = True
        change[~free] = np.iinfo(np.int64).max
        return top - int(np.argmin(change[::-1]))

    def place(self, piece: tuple) -> None:
        size = len(piece[2]) // 4
        at = self.best(size)
        if at:
            pieces = self.open[at].pop()
            self.level[at] -= 1
            self.n_open -= 1
            pieces.append(piece)
        else:
            pieces = [piece]
        if at + size == self.window:
            self.close(pieces)
        else:
            self.open[at + size].append(pieces)
            self.level[at + size] += 1
            self.n_open += 1

    def drain(self, last: bool = False) -> None:
        """Join the open windows and cut them anew; what is left stays open, or ends in powers of two."""
        pieces, held = [], 0
        for fill in range(self.window - 1, 0, -1):
            for own in self.open[fill]:
                for piece in own:
                    while piece is not None:
                        doc, start, ids, total = piece
                        room = 4 * self.window - held
                        pieces.append((doc, start, ids[:room], total))
                        held += len(pieces[-1][2])
                        piece = (doc, start + room // 4, ids[room:], total) if len(ids) > room else None
                        if held == 4 * self.window:
                            self.close(pieces)
                            pieces, held = [], 0
            self.open[fill] = []
        self.level[:] = 0
        self.n_open = 0
        if not pieces:
            return
        if not last:
            self.open[held // 4] = [pieces]
            self.level[held // 4] = self.n_open = 1
            return
        left, size = held // 4, self.window // 2
        while left:
            if size <= left:
                own, need = [], 4 * size
                while need:
                    doc, start, ids, total = pieces[0]
                    own.append((doc, start, ids[:need], total))
                    if len(ids) > need:
                        pieces[0] = (doc, start + need // 4, ids[need:], total)
                    else:
                        pieces.pop(0)
                    need -= len(own[-1][2])
                self.close(own)
                left -= size
            size //= 2


def pack(docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID, window: int = WINDOW, max_open: int = MAX_OPEN) -> DataFrame:
    """One row for each piece: where it lies in its document and in its window.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.
    ``window`` is a power of two.
    """
    if window < 2 or window & (window - 1):
        raise ValueError("window must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = word_ids(tokenizer), np.array([end_id], "<u4").tobytes()
        packer = Packer(window, TaskContext.get().partitionId() << 40, max_open)

        def rows() -> pa.RecordBatch:
            done, packer.done = packer.done, []
            names = [f.strip().split(" ")[0] for f in _PIECES.split(",")]
            columns = zip(*done, strict=True) if done else [[]] * len(names)
            return pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=names)

        for batch, texts in chunks(batches):
            for doc, ids in zip(batch.column(0).to_pylist(), coder.encode(texts), strict=True):
                packer.add(doc, ids + end)
            yield rows()
        packer.drain(last=True)
        yield rows()

    return docs.select("doc_id", "text").mapInArrow(run, _PIECES)
