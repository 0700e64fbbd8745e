"""Token ids of documents in a range-coded file format, written and read by Spark.

``write_tokens`` makes a folder of two Parquet tables: ``table`` holds one
row for each token id that occurs (id, frequency), shared by all blocks;
``blocks`` holds one row for each coded block (see :mod:`cobasket.llm.rans`)
with the ids and lengths of its documents and a crc32. Spark's own writer
commits them, so a lost executor or a repeated task leaves no torn files, and
any store that Spark reaches will do.

Order: documents go to range partitions by doc_id and are sorted within them;
a block holds consecutive documents of one partition, and (part, row) orders
all blocks. Texts cross the network once, token ids never.

Defined results: a null text is empty (only the end id); null doc_ids come
first; rows of the same doc_id are ordered by text; an empty table gives an
empty file set. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cobasket.llm import rans
from cobasket.llm.text import chunks, word_ids
from cobasket.session import scratch_path

END_ID = 2
BLOCK_TOKENS = 1 << 20
#: Documents whose ids are counted at a time.
COUNTED_DOCS = 1024
_STAGED = "part int, row long, doc_id long, ids binary"
_COUNTS = "token int, n long"
_BLOCKS = "part int, row long, n_docs int, n_tokens long, doc_ids binary, doc_nulls binary, doc_lengths binary, payload binary, crc32 long"
_DOCS = "part int, row long, place int, doc_id long, before long, n_tokens long, ids_crc32 long"


def _frame(kind: str, *columns: Iterable) -> pa.RecordBatch:
    """A record batch of the schema ``kind``."""
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.strip().split(" ") for f in kind.split(",")]
    return pa.record_batch([pa.array(c, types[t]) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def tokenise(docs: DataFrame, tokenizer: str | None, end_id: int) -> DataFrame:
    """Rows (part, row, doc_id, ids) in order within each partition; ids are packed uint32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, row = word_ids(tokenizer), TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<u4").tobytes()
        for batch, texts in chunks(batches):
            ids = [x + end for x in coder.encode(texts)]
            yield _frame(_STAGED, [part] * len(ids), range(row, row + len(ids)), batch.column(0).to_pylist(), ids)
            row += len(ids)

    return docs.mapInArrow(run, _STAGED)


def count_tokens(staged: DataFrame) -> DataFrame:
    """Occurrences of each token id: counted per task, then added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, COUNTED_DOCS):
                seen = np.bincount(np.frombuffer(b"".join(batch.column(0).slice(lo, COUNTED_DOCS).to_pylist()), "<u4"))
                if len(seen) > len(total):
                    seen[: len(total)] += total
                    total = seen
                else:
                    total[: len(seen)] += seen
        used = np.flatnonzero(total)
        yield _frame(_COUNTS, used, total[used])

    return staged.select("ids").mapInArrow(run, _COUNTS).groupBy("token").agg(F.sum("n").alias("n"))


def _table(rows: list) -> np.ndarray:
    """Values by token id."""
    out = np.zeros(max((r[0] for r in rows), default=-1) + 1, np.int64)
    for token, n in rows:
        out[token] = n
    return out


def encode_blocks(staged: DataFrame, freq: np.ndarray, block_tokens: int) -> DataFrame:
    """Coded blocks of consecutive documents."""
    table = staged.sparkSession.sparkContext.broadcast(freq)  # one entry for each id of the vocabulary

    def block(part: int, row: int, docs: list, ids: list[bytes], coder: rans.Table) -> pa.RecordBatch:
        names = np.array([0 if d is None else d for d in docs], "<i8").tobytes()
        nulls = bytes(d is None for d in docs)
        lengths = np.array([len(x) // 4 for x in ids], "<i8").tobytes()
        payload = rans.encode(np.frombuffer(b"".join(ids), "<u4"), coder)
        crc = rans.checksum(names, nulls, lengths, payload)
        return _frame(_BLOCKS, [part], [row], [len(docs)], [sum(map(len, ids)) // 4], [names], [nulls], [lengths], [payload], [crc])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, key, docs, ids, held = rans.Table(table.value), None, [], [], 0
        for batch in batches:
            for part, row, doc, x in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if docs and (part != key[0] or row != key[1] + len(docs) or held >= 4 * block_tokens):
                    yield block(*key, docs, ids, coder)
                    docs, ids, held = [], [], 0
                if not docs:
                    key = part, row
                docs.append(doc)
                ids.append(x)
                held += len(x)
        if docs:
            yield block(*key, docs, ids, coder)

    return staged.select("part", "row", "doc_id", "ids").mapInArrow(run, _BLOCKS)


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS, partitions: int | None = None
) -> None:
    """Write the token ids of all texts, ``end_id`` after each, in ascending doc_id order.

    ``partitions`` (default: ``spark.sql.shuffle.partitions``) is the number of
    range partitions; a block never crosses two of them.
    """
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select("doc_id", "text").repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    scratch = scratch_path(spark, "token-ids")
    tokenise(ordered, tokenizer, end_id).write.option("compression", "zstd").parquet(scratch)
    staged = spark.read.parquet(scratch)
    freq = rans.quantise(_table(count_tokens(staged).collect()))  # a row for each id of the vocabulary
    spark.createDataFrame([(int(t), int(freq[t])) for t in np.flatnonzero(freq)], "token int, freq long").coalesce(1).write.parquet(f"{path}/table")
    encode_blocks(staged, freq, block_tokens).write.option("compression", "none").parquet(f"{path}/blocks")


def read_table(spark: SparkSession, path: str) -> np.ndarray:
    """The shared frequency table, by token id."""
    return _table(spark.read.parquet(f"{path}/table").select("token", "freq").collect())


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Decode a written folder: doc_id, start, n_tokens, ids_crc32 (and ids, packed uint32).

    Every block is checked against its crc32 and decoded on its own. Where a
    document starts follows from the token counts of blocks and parts alone.
    """
    table = spark.sparkContext.broadcast(read_table(spark, path))
    blocks = spark.read.parquet(f"{path}/blocks")
    kind = _DOCS + (", ids binary" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = rans.Table(table.value)
        for batch in batches:
            for part, row, _, n, names, nulls, lengths, payload, crc in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if rans.checksum(names, nulls, lengths, payload) != crc:
                    raise ValueError(f"block {part}/{row}: its checksum doesn't match")
                ids = memoryview(rans.decode(payload, coder).astype("<u4").tobytes())
                sizes = np.frombuffer(lengths, "<i8")
                ends = np.cumsum(sizes)
                if (int(ends[-1]) if len(ends) else 0) != n:
                    raise ValueError(f"block {part}/{row}: its documents don't add up")
                docs = [None if no else d for d, no in zip(np.frombuffer(names, "<i8").tolist(), nulls, strict=True)]
                texts = [ids[4 * (b - s) : 4 * b] for b, s in zip(ends.tolist(), sizes.tolist(), strict=True)]
                more = [[bytes(x) for x in texts]] if with_ids else []
                yield _frame(kind, [part] * len(docs), [row] * len(docs), range(len(docs)), docs, ends - sizes, sizes, [zlib.crc32(x) for x in texts], *more)

    docs = blocks.select(*[f.strip().split(" ")[0] for f in _BLOCKS.split(",")]).mapInArrow(run, kind)
    # a row for each part, then a row for each block of one part
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    total = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(total, F.lit(0)).alias("_part"))
    earlier = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1))
    offsets = blocks.select("part", "row", "n_tokens").join(parts, "part").select("part", "row", (F.col("_part") + F.coalesce(earlier, F.lit(0))).alias("_block"))
    out = docs.join(offsets, ["part", "row"])
    return out.select("doc_id", (F.col("_block") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def encoded_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Write all documents, read them back."""
    path = scratch_path(spark, "coded")
    write_tokens(docs, path)
    return read_tokens(spark, path)
