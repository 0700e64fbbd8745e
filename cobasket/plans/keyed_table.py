"""A table of rows by key that grows in sorted, immutable segments.

Appending a batch writes one new segment; when a level holds ``fanout`` segments,
they are merged into one of the next level, so that after n batches about
``fanout * log(n)`` segments are live, whatever n. A manifest names the live ones
and what each holds: the batches from ``first`` to ``last``, its rows and its depth.

Where a lookup reads: the rows of a segment lie in folders by a prefix of their
key's hash, of ``depth`` bits that follow from the segment's own size, so that a
folder holds about ``target_rows`` rows, in files sorted by key, with dictionaries
or Bloom filters of it. :meth:`KeyedTable.near` turns the keys of a drop into folder
filters, which Spark prunes by before it opens a file, and, for up to ``MAX_KEYS``
keys, into a pushed ``IN`` filter, by which the Parquet reader skips row groups. A
larger drop goes by folders alone, at most ``2 ** MAX_PRUNED_BITS`` of them.

Commits: a segment is written under a name of its own first; the manifest that
names it, a single file, is written last, in turns to two folders, of which readers
take the later version. A job that dies in between leaves a segment that nothing
names, and the table as it was. A batch whose number a live segment covers has been
applied: a replay appends nothing, also after its segment went into a merge.

A segment takes the place of those it was merged from in one manifest; their files
stay for readers that still use them and may be removed after a while by whoever
owns the storage (:meth:`KeyedTable.unused` names them). One writer at a time.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterable
from contextlib import contextmanager
from dataclasses import astuple, dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

PREFIX = "key_prefix"
BATCH = "batch_id"
FANOUT = 4
TARGET_ROWS = 4_000_000
MAX_KEYS = 2048
MAX_PRUNED_BITS = 12
MAX_DEPTH = 24
_MANIFEST = "version long, name string, level int, first long, last long, rows long, depth int"
_FIELDS = [f.split(" ")[0] for f in _MANIFEST.split(", ")]


@dataclass(frozen=True)
class Segment:
    """One live segment: its folder, its level, the batches and rows it holds, and the bits of its folders' prefix."""

    name: str
    level: int
    first: int
    last: int
    rows: int
    depth: int


def key_hash(key: Column | str) -> Column:
    return F.xxhash64(key)


def prefix_of(hashed: Column, depth: int) -> Column:
    """The first ``depth`` bits of a 64-bit hash."""
    return F.shiftrightunsigned(hashed, 64 - depth).cast("int") if depth else F.lit(0)


def one_of(name: str, values: list) -> Column:
    """``name IN (values)`` for integers or texts, as one expression: thousands of values at once."""
    if not values:
        return F.lit(False)
    quoted = lambda v: "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return F.expr(f"{name} IN ({', '.join(str(v) if isinstance(v, int) else quoted(v) for v in values)})")


@contextmanager
def pushed_values(spark: SparkSession, n: int):
    """Let ``IN`` filters of up to ``n`` values reach the Parquet reader while a plan is made and run."""
    name = "spark.sql.parquet.pushdown.inFilterThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, str(max(n, int(before))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


class KeyedTable:
    """Rows of ``schema`` by ``key`` (None: no lookups, one folder a segment).

    ``combine`` is applied to the rows of a merge (for counts: add them up); with
    ``keep_batches`` each row carries the number of its batch in ``batch_id``.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: StructType,
        key: str | None = None,
        fanout: int = FANOUT,
        target_rows: int = TARGET_ROWS,
        combine: Callable[[DataFrame], DataFrame] | None = None,
        keep_batches: bool = False,
    ):
        if fanout < 2:
            raise ValueError("fanout must be at least 2")
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.fanout, self.target_rows, self.combine = fanout, target_rows, combine
        self.keep_batches = keep_batches
        self._state: tuple[int, list[Segment]] | None = None
        fields = [f for f in schema.fields if f.name not in (BATCH, PREFIX)]
        self.schema = StructType([*fields, *[StructField(BATCH, LongType(), True)] * keep_batches])

    # ── manifest ────────────────────────────────────────────────────────────

    def _manifest(self) -> tuple[int, list[Segment]]:
        """The latest version and its segments; (0, []) before the first batch."""
        try:
            rows = self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/manifest").select(*_FIELDS).collect()
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" not in str(exc):
                raise
            return 0, []
        latest = max((r.version for r in rows), default=0)
        live = [Segment(*r[1:]) for r in rows if r.version == latest]
        return latest, sorted(live, key=lambda s: s.first)

    def refresh(self) -> None:
        """Forget the manifest, which this object reads once and changes by its own batches only."""
        self._state = None

    def _latest(self) -> tuple[int, list[Segment]]:
        if self._state is None:
            self._state = self._manifest()
        return self._state

    def segments(self) -> list[Segment]:
        """Live segments in order of their batches: fewer than ``fanout`` of each level."""
        return list(self._latest()[1])

    def _commit(self, version: int, live: Iterable[Segment]) -> None:
        rows = [(version, *astuple(s)) for s in live]
        slot = f"{self.path}/manifest/slot={version % 2}"
        self.spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(slot)
        self._state = version, list(live)

    def rows(self) -> int:
        """How many rows the table holds, by its manifest."""
        return sum(s.rows for s in self.segments())

    def last_batch(self) -> int | None:
        return max((s.last for s in self.segments()), default=None)

    def covers(self, batch_id: int) -> bool:
        """Whether a batch has been applied."""
        return any(s.first <= batch_id <= s.last for s in self.segments())

    def unused(self) -> list[str]:
        """Segment folders that the manifest doesn't name: merged ones, and those of writes that were never committed."""
        try:
            files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{self.path}/segments")
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" not in str(exc):
                raise
            return []
        live = [s.name for s in self.segments()]
        name = F.regexp_extract("path", "/segments/([^/]+)/", 1)
        return sorted(f"{self.path}/segments/{r.name}" for r in files.select(name.alias("name")).distinct().collect() if r.name not in live)

    # ── reading ─────────────────────────────────────────────────────────────

    def _empty(self) -> DataFrame:
        return self.spark.createDataFrame([], self.schema)

    def _segment(self, s: Segment, where: Callable[[Segment], Column | None] = lambda s: None) -> DataFrame:
        schema = StructType([*self.schema.fields, StructField(PREFIX, IntegerType(), True)])
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/segments/{s.name}")
        kept = where(s)
        return (rows if kept is None else rows.where(kept)).select(*self.schema.names)

    def _union(self, live: list[Segment], where: Callable[[Segment], Column | None] = lambda s: None) -> DataFrame:
        out = None
        for s in live:
            rows = self._segment(s, where)
            out = rows if out is None else out.unionByName(rows)
        return self._empty() if out is None else out

    def read(self) -> DataFrame:
        """All rows, by the manifest as it is now."""
        self.refresh()
        return self._union(self.segments())

    def near(self, keys: DataFrame, max_keys: int = MAX_KEYS) -> DataFrame:
        """A part of the table that holds all rows of the given keys (column ``key``), and few others.

        Run what uses it inside :func:`pushed_values`, so that its keys reach the Parquet reader.
        """
        if self.key is None:
            raise ValueError("a table without a key has no lookups")
        live = self.segments()
        if not live:
            return self._empty()
        hashed = keys.select(F.col(self.key).alias("k")).select("k", key_hash("k").alias("h"))
        # at most 2 ** MAX_PRUNED_BITS rows, and no more than there are keys: those of a large drop needn't be told apart
        prefixes = [r[0] for r in hashed.select(prefix_of(F.col("h"), MAX_PRUNED_BITS).alias("p")).distinct().collect()]
        # at most max_keys + 1 rows
        known = hashed.distinct().limit(max_keys + 1).collect() if len(prefixes) <= max_keys else None
        if known is not None and len(known) <= max_keys:
            hashes, bits = [r.h for r in known], 64
            values = [r.k for r in known if r.k is not None]
            named = one_of(self.key, values)
            if len(values) < len(known):
                named = named | F.col(self.key).isNull()
        else:
            bits, named = MAX_PRUNED_BITS, None
            hashes = [p << (64 - bits) for p in prefixes]

        def where(s: Segment) -> Column | None:
            if not s.depth:
                return named
            known_bits = min(bits, s.depth)
            touched = {(h % 2**64) >> (64 - known_bits) for h in hashes}
            own = PREFIX if s.depth == known_bits else f"shiftright({PREFIX}, {s.depth - known_bits})"
            folder = one_of(own, sorted(touched))
            return folder if named is None else folder & named

        return self._union(live, where)

    # ── writing ─────────────────────────────────────────────────────────────

    def _depth(self, rows: int) -> int:
        if self.key is None:
            return 0
        return min(MAX_DEPTH, max(0, math.ceil(math.log2(max(1, rows) / self.target_rows))))

    def _write(self, rows: DataFrame, level: int, first: int, last: int, expected: int) -> Segment:
        """A segment of ``rows`` (about ``expected``), counted while it is written."""
        depth, name = self._depth(expected), f"{first}-{last}-{uuid.uuid4().hex[:12]}"
        seen = Observation()
        out = rows.select(*self.schema.names).observe(seen, F.count(F.lit(1)).alias("n"))
        writer = None
        if self.key is not None:
            placed = out.withColumn(PREFIX, prefix_of(key_hash(self.key), depth))
            # a folder that one key fills is split by size
            placed = placed.hint("rebalance", PREFIX) if depth else placed
            bloom = f"parquet.bloom.filter.enabled#{self.key}"
            writer = placed.sortWithinPartitions(PREFIX, *self.schema.names).write.option(bloom, "true").partitionBy(PREFIX)
        (writer or out.write).parquet(f"{self.path}/segments/{name}")
        return Segment(name, level, first, last, int(seen.get["n"]), depth)

    def append(self, batch_id: int, rows: DataFrame, expected: int = 0) -> int:
        """Add a batch (numbers rise) and merge full levels; how many rows it added, 0 if it had been applied.

        ``expected`` is about how many rows there are; it sets the number of folders.
        """
        version, live = self._latest()
        if any(s.first <= batch_id <= s.last for s in live):
            return 0
        if live and batch_id < max(s.last for s in live):
            raise ValueError(f"batch {batch_id} comes after batch {max(s.last for s in live)}")
        if self.keep_batches:
            rows = rows.withColumn(BATCH, F.lit(batch_id).cast("bigint"))
        added = self._write(rows, 0, batch_id, batch_id, expected)
        live = [*live, added]
        while True:
            full = [n for n in sorted({s.level for s in live}) if sum(s.level == n for s in live) >= self.fanout]
            if not full:
                break
            parts = [s for s in live if s.level == full[0]]
            merged = self._union(parts)
            if self.combine is not None:
                merged = self.combine(merged)
            whole = self._write(merged, full[0] + 1, parts[0].first, parts[-1].last, sum(s.rows for s in parts))
            live = sorted([s for s in live if s.level != full[0]] + [whole], key=lambda s: s.first)
        self._commit(version + 1, live)
        return added.rows
