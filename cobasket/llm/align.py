"""How the tokens of two tokenizers line up, byte by byte.

Tokenizer A is a byte-level BPE (tokenizers), B a sentencepiece BPE with byte
fallback that puts a space before a text; A gets the text with that space. Both
then cover the same bytes. Offsets where a token of either ends at the same byte
cut them into groups; a link is a pair of an A and a B token that share a byte;
the count of an id pair is the number of documents that hold it linked.

Cuts come from the spans that the tokenizers report (character offsets of A, byte
spans of B's proto), turned into bytes. A span that does not fit the token's own
bytes, as with characters of several bytes and byte-fallback tokens, is refined by
these: the token ends as many bytes on as it decodes to.

A text is encoded in units: a space and what follows it up to the next space that
has a plain character before it. No token of either tokenizer holds a space behind
another character (checked on both vocabularies; otherwise the whole text is one
unit), so groups and links of a text are those of its units, and units are encoded
once and those of several places remembered, up to ``CACHE_BYTES`` in a process.
Thousands of units are lined up at a time, by Arrow and numpy.

Spark's part: documents become blocks of about 4 MB of text, written once, each with
its distinct units, their id pairs, and how many of its documents hold a pair. Numbers
take as few bytes as they need and a file's row groups are of a few blocks, as the JVM
holds whole blocks beside the tokenizers. The
pairs of all blocks are added up, written with the best count of their A id, and
joined back to the blocks that hold them: a pair meets its count once for each block,
not for each link, and no task or broadcast holds the whole table of counts. Then
blocks and their counts are grouped by block, and each gives its documents' rows.

Defined results: each row is a document, also where a doc_id is null or repeats; a
text that is null, empty, or not given back exactly by both tokenizers has no
tokens: zeros, and '' for the hash; an empty table gives no row; columns other than
doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain, islice, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cobasket.llm.text import chunks, release
from cobasket.session import scratch_path, stored

#: Bytes of remembered units, about, in one process.
CACHE_BYTES = 48 << 20
#: Bytes of text in a block, about.
BLOCK_BYTES = 4 << 20
#: Row groups of the written blocks: so many bytes, looked at after each row (Parquet's own check waits for 100 rows).
ROW_GROUPS = {"parquet.block.size": str(8 << 20), "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1"}
#: A unit of more characters is not remembered.
LONG = 64
#: Characters of units that are encoded as one text.
RUN = 8192
#: Characters that are or may count as white space, or stand for it, in one of the tokenizers.
_BLANK = r"\s\x00-\x20\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u2581\u3000\ufeff"
#: A space behind any other character, and not at the end.
_CUT = re.compile(rf" (?<=[^{_BLANK}] )(?!\Z)")
_BLANKS = frozenset(re.findall(f"[{_BLANK}]", "".join(map(chr, range(1 << 16)))))
_ODD = re.compile(rf"[{_BLANK}] ")
_BLOCKS = (
    "block long, doc_ids binary, doc_nulls binary, numbers binary, hashes binary, units binary, unit_sizes binary, "
    "links binary, link_sizes binary, pairs binary, n binary"
)
_ROWS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable bytes themselves, the others 256 and on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    out.update({chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))})
    return out


def token_ends(lo: np.ndarray, hi: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Where tokens of byte spans ``lo`` to ``hi`` end.

    A span that ends where the next one begins, and where the decoded bytes end too, is
    a cut. Between cuts, tokens end as many bytes on as they decode to.
    """
    exact = np.cumsum(sizes)
    cut = (hi > lo) & np.append(hi[:-1] <= lo[1:], True)[: len(hi)] & (hi == exact)
    at = np.flatnonzero(cut)
    run = np.searchsorted(at, np.arange(len(hi)))
    before = np.concatenate([[0], hi[at]])[run], np.concatenate([[0], exact[at]])[run]
    return np.where(cut, hi, before[0] + exact - before[1])


def byte_places(text: str) -> np.ndarray:
    """The byte at which each character of a text begins, and the text ends."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    sizes = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
    return np.concatenate([[0], np.cumsum(sizes)])


#: A unit's tokens: how many of A and B, how many groups and links, the groups as text, and the id pairs of its
#: links as packed uint64, A's id in the high half. A plain tuple, as a process holds very many of them.
Unit = tuple[int, int, int, int, bytes, bytes]
NO_TOKENS: Unit = (0, 0, 0, 0, b"", b"")
_UNKNOWN = object()


def line_up(a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray, unit_ends: np.ndarray) -> list[Unit]:
    """Groups and links of two token rows over the same bytes, for each of the units that end at ``unit_ends``."""
    flags = np.zeros(max(a_ends[-1], b_ends[-1]) + 1, np.int8)
    flags[a_ends] = 1
    flags[b_ends] += 2
    # bytes between neighbouring ends belong to one token of either
    ends = np.flatnonzero(flags)
    is_a, is_b = flags[ends] & 1 > 0, flags[ends] > 1
    # how many tokens of A and of B, and groups, end at each place or before
    marks = [is_a, is_b, is_a & is_b]
    a_done, b_done, groups_done = done = [np.cumsum(x) for x in marks]
    a_at, b_at, group = (n - x for n, x in zip(done, marks, strict=True))
    links = a[a_at].astype(np.uint64) << np.uint64(32) | b[b_at].astype(np.uint64)
    # a group's tokens of A, then those of B
    shared = np.append(0, np.flatnonzero(marks[2]) + 1)
    a_of, b_of = np.append(0, a_done)[shared], np.append(0, b_done)[shared]
    a_group, b_group = group[is_a], group[is_b]
    a_place, b_place = np.arange(len(a)) + b_of[a_group], np.arange(len(b)) + a_of[b_group + 1]
    ids, kinds = np.empty(len(a) + len(b), np.int64), np.empty(len(a) + len(b), np.int64)
    ids[a_place], kinds[a_place] = a, _last(a_group)
    ids[b_place], kinds[b_place] = b, 2 * _last(b_group)
    texts = pc.binary_join_element_wise(pa.array(ids).cast(pa.large_string()), pa.array([",", "|", ";"], pa.large_string()).take(pa.array(kinds)), pa.scalar("", pa.large_string()))
    text_ends, data = np.frombuffer(texts.buffers()[1], "<i8"), texts.buffers()[2].to_pybytes()
    found = np.searchsorted(ends, unit_ends, side="right")
    at = [np.append(0, x)[found] for x in done] + [found]
    tokens, places, packed = text_ends[np.append(0, at[0] + at[1])].tolist(), [0, *(8 * at[3]).tolist()], links.tobytes()
    groups = [data[lo : hi - 1] for lo, hi in pairwise(tokens)]
    pairs = [packed[lo:hi] for lo, hi in pairwise(places)]
    return list(zip(*(np.diff(x, prepend=0).tolist() for x in at), groups, pairs, strict=True))


def _last(group: np.ndarray) -> np.ndarray:
    """Whether each entry is the last of its run."""
    return np.append(group[1:] != group[:-1], True)[: len(group)]


def _joined(table: pa.Array, ids: np.ndarray) -> bytes:
    """Entries of ``table``, end to end."""
    data = table.take(pa.array(ids)).buffers()[2]
    return data.to_pybytes() if data else b""


def _cut(data: bytes, sizes: np.ndarray) -> list[bytes]:
    """Consecutive pieces of ``data`` of these sizes."""
    return [data[lo:hi] for lo, hi in pairwise([0, *np.cumsum(sizes).tolist()])]


class Aligner(dict):
    """Units by their text without its space; None for a unit that isn't given back exactly."""

    def __init__(self, a_path: str, b_path: str):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=b_path)
        letters = byte_letters()
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        special = self.a.get_added_tokens_decoder()
        for t, i in vocabulary.items():
            if i not in special and all(c in letters for c in t):
                self.a_bytes[i] = bytes(letters[c] for c in t)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("\u2581", " ").encode("utf-8") for i, p in enumerate(pieces)]
        self.a_sizes, self.b_sizes = (np.array([len(t) for t in table], np.int64) for table in (self.a_bytes, self.b_bytes))
        self.a_table, self.b_table = (pa.array(table, pa.large_binary()) for table in (self.a_bytes, self.b_bytes))
        # a token with such a space would join units
        self.cuts = not any(_CUT.search(t.decode("utf-8", "replace") + "x") for t in [*self.a_bytes, *self.b_bytes])
        self.held = 0

    def plain(self, text: str) -> bool:
        """Whether a text's units are what lies between its spaces."""
        return self.cuts and not text.startswith(" ") and not text.endswith(" ") and not _ODD.search(text)

    def split(self, text: str) -> list[str]:
        """Units of a text, each without the space before it."""
        if not self.cuts:
            return [text]
        return text.split(" ") if self.plain(text) else _CUT.split(text)

    def runs(self, units: list[str]) -> list[list[str]]:
        """Units to encode as one text each: those that end in a blank, or are long, alone."""
        out, run, held = [], [], 0
        for u in units:
            if not self.cuts or len(u) > RUN or u[-1:] in _BLANKS:
                out.append([u])
                continue
            run.append(u)
            held += len(u) + 1
            if held > RUN:
                out.append(run)
                run, held = [], 0
        return [*out, run] if run else out

    def learn(self, units: list[str]) -> dict[str, Unit | None]:
        """The given units, encoded."""
        out: dict[str, Unit | None] = {}
        runs = self.runs(units)
        while runs:
            whole = [" " + " ".join(run) for run in runs]
            a = self.a.encode_batch(whole, add_special_tokens=False)
            b = self.b.encode([w[1:] for w in whole], return_type="proto", num_threads=1)
            again = []
            for run, found in zip(runs, self.encoded(runs, whole, a, b), strict=True):
                if found is not None:
                    out.update(zip(run, found, strict=True))
                elif len(run) == 1:
                    out[run[0]] = None
                else:
                    again += [[u] for u in run]
            runs = again
        return out

    def encoded(self, runs: list[list[str]], texts: list[str], a: list, b: list) -> list[list[Unit] | None]:
        """Units of each run from its tokens of both; None unless both give back its text."""
        text = "".join(texts)
        raw, places = text.encode("utf-8"), byte_places(text)
        starts = np.cumsum([0, *map(len, texts)])  # in characters
        a_n, b_n = [len(e) for e in a], [len(p.pieces) for p in b]
        a_ids = np.fromiter(chain.from_iterable(e.ids for e in a), np.int64, sum(a_n))
        tokens = np.fromiter(chain.from_iterable((p.id, p.end) for x in b for p in x.pieces), np.int64, 2 * sum(b_n)).reshape(-1, 2)
        b_ids = tokens[:, 0]
        given = _cut(raw, np.diff(places[starts]))
        a_given = _cut(_joined(self.a_table, a_ids), _sums(self.a_sizes[a_ids], np.cumsum(a_n)))
        b_given = _cut(_joined(self.b_table, b_ids), _sums(self.b_sizes[b_ids], np.cumsum(b_n)))
        same = [x == y == z for x, y, z in zip(given, a_given, b_given, strict=True)]
        if not all(same):
            of_same = lambda values: [v for v, ok in zip(values, same, strict=True) if ok]
            found = iter(self.encoded(*map(of_same, (runs, texts, a, b))) if any(same) else [])
            return [next(found) if ok else None for ok in same]
        spans = np.fromiter(chain.from_iterable(chain.from_iterable(e.offsets for e in a)), np.int64, 2 * sum(a_n)).reshape(-1, 2)
        spans = places[spans + np.repeat(starts[:-1], a_n)[:, None]]
        a_ends = token_ends(spans[:, 0], spans[:, 1], self.a_sizes[a_ids])
        # the space that B puts before a text has no byte in its spans
        end = tokens[:, 1] + 1 + np.repeat(places[starts[:-1]], b_n)
        b_ends = token_ends(np.append(0, end[:-1]), end, self.b_sizes[b_ids])
        unit_ends = places[np.cumsum([len(u) + 1 for run in runs for u in run])]
        units = iter(line_up(a_ids, a_ends, b_ids, b_ends, unit_ends))
        return [list(islice(units, len(run))) for run in runs]

    def units(self, names: list[str], often: np.ndarray | None = None) -> list[Unit | None]:
        """All of ``names``, from memory or encoded; those that ``often`` marks are remembered (all without it)."""
        out = [self.get(u, _UNKNOWN) for u in names]
        places = [k for k, x in enumerate(out) if x is _UNKNOWN]
        fresh: dict[str, Unit | None] = {}
        for lo in range(0, len(places), 20_000):
            fresh |= self.learn([names[k] for k in places[lo : lo + 20_000]])
        for k in places:
            out[k] = fresh[names[k]]
        if self.held > CACHE_BYTES:
            self.clear()
            self.held = 0
        for k in places if often is None else np.array(places, np.int64)[often[places]].tolist():
            u, unit = names[k], out[k]
            if len(u) <= LONG:
                self[u] = unit
                self.held += 500 + len(u) + (len(unit[4]) + len(unit[5]) if unit else 0)
        return out


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str | None, b_path: str | None) -> Aligner:
    """The process's aligner of two tokenizer files."""
    import public_tokenizers

    key = a_path or public_tokenizers.path("byte_bpe_50k.json"), b_path or public_tokenizers.path("piece_bpe_32k.model")
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(*key)
    return _ALIGNERS[key]


def forget() -> None:
    """Give back the memory of this process's aligners: once blocks are written, other tasks need it."""
    if _ALIGNERS:
        _ALIGNERS.clear()
        release()


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on, in as few bytes each as the largest needs; the last byte says how many."""
    kind = np.min_scalar_type(values.max(initial=0))
    return values.astype(kind).tobytes() + bytes([kind.itemsize])


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[-1]}", (len(data) - 1) // data[-1])


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``values`` that end before ``ends``."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return np.diff(total[ends], prepend=0)


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of all runs, end to end."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _places(texts: list[bytes], coder: Aligner) -> tuple[list[str], list[np.ndarray]]:
    """The distinct units of all texts, and which of them each text has, in order; Arrow splits the plain texts."""
    odd = {k: coder.split(s) for k, t in enumerate(texts) if t and not coder.plain(s := t.decode("utf-8"))}
    plain = [k for k, t in enumerate(texts) if t and k not in odd]
    split = pc.split_pattern(pa.array([texts[k] for k in plain], pa.large_binary()).view(pa.large_string()), " ")
    coded = pa.concat_arrays([split.flatten(), pa.array([u for x in odd.values() for u in x], pa.large_string())]).dictionary_encode()
    sizes = np.zeros(len(texts), np.int64)
    sizes[plain] = np.diff(np.asarray(split.offsets))
    sizes[list(odd)] = [len(x) for x in odd.values()]
    order, at = [*plain, *odd], coded.indices.to_numpy().astype(np.int64)
    places = [at[:0]] * len(texts)
    for k, own in zip(order, np.split(at, np.cumsum(sizes[order])[:-1]), strict=bool(order)):
        places[k] = own
    return coded.dictionary.to_pylist(), places


def _block(block: int, doc_ids: list, texts: list[bytes], coder: Aligner) -> pa.RecordBatch:
    """One block's row."""
    names, places = _places(texts, coder)
    at = np.concatenate([np.zeros(0, np.int64), *places])
    units = coder.units(names, np.bincount(at, minlength=len(names)) > 1)
    lost = np.array([u is None for u in units], bool)
    if lost.any():
        places = [p[:0] if lost[p].any() else p for p in places]
    ends = np.cumsum([len(p) for p in places], dtype=np.int64)
    at = np.concatenate([np.zeros(0, np.int64), *places])
    known = [u or NO_TOKENS for u in units]
    counts = np.fromiter(chain.from_iterable(u[:4] for u in known), np.int64, 4 * len(known)).reshape(-1, 4)
    sizes = counts[:, 3]
    numbers = np.stack([_sums(counts[at, k], ends) for k in range(4)])
    groups = [u[4] for u in known]
    hashes = b"".join(hashlib.sha256(b";".join([groups[k] for k in p.tolist()])).digest() for p in places)
    pairs, links = np.unique(np.frombuffer(b"".join([u[5] for u in known]), "<u8"), return_inverse=True)
    link_ends = np.cumsum(sizes)
    # documents that hold a pair: one that is given several times is raised once
    n, starts = np.zeros(len(pairs), np.int64), link_ends - sizes
    for p in places:
        n[links[_runs(starts[p], sizes[p])]] += 1
    values = [
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(), bytes(d is None for d in doc_ids), numbers.astype("<i8").tobytes(), hashes,
        _packed(at), _packed(np.diff(ends, prepend=0)), _packed(links), _packed(sizes), pairs.astype("<u8").tobytes(), _packed(n),
    ]
    names = [f.strip().split(" ")[0] for f in _BLOCKS.split(",")]
    return pa.record_batch([pa.array([block], pa.int64()), *[pa.array([v], pa.binary()) for v in values]], names=names)


def encode_blocks(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """Blocks of documents, aligned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, block = aligner(a_path, b_path), TaskContext.get().partitionId() << 32
        for batch, texts in chunks(batches, size=BLOCK_BYTES):
            yield _block(block, batch.column(0).to_pylist(), texts, coder)
            block += 1
            release()

    return docs.select("doc_id", "text").mapInArrow(run, _BLOCKS)


def block_pairs(blocks: DataFrame) -> DataFrame:
    """block, pair, n: the id pairs of each block and how many of its documents hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for block, pairs, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                pairs, n = np.frombuffer(pairs, "<i8"), _unpacked(n).astype(np.int64)
                yield pa.record_batch([pa.array(np.full(len(n), block)), pa.array(pairs), pa.array(n)], names=["block", "pair", "n"])

    return blocks.select("block", "pairs", "n").mapInArrow(run, "block long, pair long, n long")


def pair_counts(pairs: DataFrame) -> DataFrame:
    """pair, n (documents that hold it) and best (n is the highest of its A id; at most one row for each B id shares a window)."""
    counts = pairs.groupBy("pair").agg(F.sum("n").alias("n"))
    top = F.max("n").over(Window.partitionBy(F.shiftright("pair", 32)))
    return counts.select("pair", "n", (F.col("n") == top).alias("best"))


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """One row for each document: n_a, n_b, n_groups, n_links, n_best, count_sum and the hash of its groups."""
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "aligned-blocks")
    encode_blocks(docs, a_path, b_path).write.options(**ROW_GROUPS).parquet(path)
    blocks = spark.read.parquet(path)
    pairs = block_pairs(blocks)
    counts = stored(pair_counts(pairs), "pair-counts")
    known = pairs.select("block", "pair").join(counts.hint("merge"), "pair").select("block", "pair", "n", "best")

    def rows(left: pa.Table, right: pa.Table) -> pa.Table:
        forget()
        out = []
        found = right.sort_by("pair")
        n, best = found.column("n").to_numpy(), found.column("best").to_numpy(zero_copy_only=False)
        for r in left.to_pylist():  # one row
            read = lambda c, kind, r=r: np.frombuffer(r[c], kind)
            if not np.array_equal(found.column("pair").to_numpy(), read("pairs", "<i8")):
                raise ValueError(f"block {r['block']}: its pairs and their counts don't match")
            at, links = _unpacked(r["units"]), _unpacked(r["links"])
            ends, link_ends = (np.cumsum(_unpacked(r[c]), dtype=np.int64) for c in ("unit_sizes", "link_sizes"))
            of = lambda values, at=at, ends=ends, links=links, link_ends=link_ends: _sums(_sums(values[links], link_ends)[at], ends)
            numbers = read("numbers", "<i8").reshape(4, -1)
            names = [None if no else d for d, no in zip(read("doc_ids", "<i8").tolist(), r["doc_nulls"], strict=True)]
            hashes = [r["hashes"][32 * k : 32 * k + 32].hex() if numbers[0, k] else "" for k in range(len(names))]
            fields = _ROWS.split(", ")
            columns = [pa.array(names, pa.int64()), *map(pa.array, numbers), pa.array(of(best.astype(np.int64))), pa.array(of(n)), pa.array(hashes, pa.string())]
            out.append(pa.table(columns, names=[f.split(" ")[0] for f in fields]))
        return pa.concat_tables(out)

    return blocks.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(rows, _ROWS)
