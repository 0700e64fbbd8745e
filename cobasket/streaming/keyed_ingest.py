"""Ingest and running counts over streaming file sources, into keyed tables.

The stream's checkpoint is the log of processed files: Spark's file source lists the
folder and deals each file to one micro-batch, so no path passes through Python, and
a restart goes on with the batch that was not finished. Each batch is written to a
:class:`~cobasket.plans.keyed_table.KeyedTable` under the batch's own number, which
makes a replay append nothing.

A batch is parsed once: rows are grouped by key and reject reason with their number
of copies, that small table is written to the scratch folder, and rows read, rows
rejected by reason and distinct rows are counted by an observation of that write.
(It observes the rows after the grouping, in the job's last stage, which a lost
executor does not make count twice.) Rows appended are observed while the new
segment is written, and the table's total comes from its manifest.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DataType, LongType, StructField, StructType

from cobasket.functions.keys import strip_space
from cobasket.operators.clean import reject_reason
from cobasket.operators.cooccur import product_columns
from cobasket.operators.dedup import KEYS, new_rows
from cobasket.operators.incremental import count_delta, merge_counts
from cobasket.plans.keyed_table import BATCH, KeyedTable, pushed_values
from cobasket.session import broadcast_limit, scratch_path
from cobasket.sources.sales import BASKET, PRODUCT, SALES_SCHEMA

REASONS = ("empty_basket", "missing_product", "non_integer_product")
_OUTCOMES = "batch_id long, rows_read long, distinct_rows long, rows_appended long, table_rows long, rejected map<string,long>"
#: What a row of keys takes in a broadcast, about.
ROW_BYTES = 64


@dataclass
class BatchOutcome:
    """What one batch did: rows read, rejected by reason, distinct and appended, and the table's rows after it."""

    batch_id: int
    rows_read: int
    distinct_rows: int
    rows_appended: int
    table_rows: int
    rejected: dict[str, int] = field(default_factory=dict)


def sales_table(spark: SparkSession, path: str, schema: StructType = SALES_SCHEMA, **options) -> KeyedTable:
    """A keyed table of distinct sales rows, by basket."""
    return KeyedTable(spark, path, schema, key=BASKET, **options)


def counts_table(spark: SparkSession, path: str, k: int, item_type: DataType | None = None, **options) -> KeyedTable:
    """A keyed table of count deltas, added up whenever segments merge."""
    fields = [StructField(c, item_type or LongType(), True) for c in product_columns(k)]
    return KeyedTable(spark, path, StructType([*fields, StructField("baskets", LongType(), True)]), combine=merge_counts, **options)


def _small(spark: SparkSession, rows: int) -> bool:
    """Whether so many rows of keys fit in a broadcast."""
    return rows * ROW_BYTES <= broadcast_limit(spark)


def grouped_drop(raw: DataFrame, numeric_products: bool = False) -> DataFrame:
    """basket_id, product_id (stripped; null where rejected), reason and copies: one row for each."""
    reason = reject_reason(raw, numeric_products=numeric_products)
    kept = lambda c: F.when(reason.isNull(), strip_space(c))
    rows = raw.select(kept(BASKET).alias(BASKET), kept(PRODUCT).alias(PRODUCT), reason.alias("reason"))
    return rows.groupBy(*KEYS, "reason").agg(F.count(F.lit(1)).alias("copies"))


def ingest_batch(raw: DataFrame, batch_id: int, table: KeyedTable, outcomes: KeyedTable | None = None, numeric_products: bool = False) -> BatchOutcome | None:
    """Clean, deduplicate and append one batch of raw sales rows; None if it had been applied before."""
    spark = raw.sparkSession
    if table.covers(batch_id) and (outcomes is None or outcomes.covers(batch_id)):
        return None
    seen, path = Observation(), scratch_path(spark, "drop")
    of = lambda c, when=F.lit(True): F.coalesce(F.sum(F.when(when, F.col(c))), F.lit(0))
    counts = [of("copies").alias("rows"), F.count(F.when(F.col("reason").isNull(), 1)).alias("distinct")]
    counts += [of("copies", F.col("reason") == r).alias(r) for r in REASONS]
    grouped_drop(raw, numeric_products).observe(seen, *counts).write.parquet(path)
    got = seen.get
    incoming = spark.read.parquet(path).where(F.col("reason").isNull()).select(*KEYS)
    distinct, appended = int(got["distinct"]), 0
    if not table.covers(batch_id):
        existing = table.near(incoming)
        with pushed_values(spark, distinct):
            # the drop's rows are distinct: all are new to an empty table
            added = new_rows(incoming, existing, KEYS, incoming_is_small=_small(spark, distinct)) if table.segments() else incoming
            appended = table.append(batch_id, added, expected=distinct)
    rejected = {r: int(got[r]) for r in REASONS if got[r]}
    outcome = BatchOutcome(batch_id, int(got["rows"]), distinct, appended, table.rows(), rejected)
    if outcomes is not None:
        line = [(outcome.batch_id, outcome.rows_read, outcome.distinct_rows, outcome.rows_appended, outcome.table_rows, rejected)]
        outcomes.append(batch_id, spark.createDataFrame(line, _OUTCOMES).select(*outcomes.schema.names).coalesce(1))
    return outcome


def outcomes_table(spark: SparkSession, path: str) -> KeyedTable:
    """What each batch of an ingest did, one row each."""
    schema = StructType([f for f in spark.createDataFrame([], _OUTCOMES).schema.fields if f.name != BATCH])
    return KeyedTable(spark, path, schema, keep_batches=True)


def start_ingest(
    stream: DataFrame, table: KeyedTable, outcomes: KeyedTable, checkpoint: str, numeric_products: bool = False, available_now: bool = True
) -> StreamingQuery:
    """Ingest a stream of raw sales files; ``outcomes`` has a row for each batch."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        ingest_batch(batch, batch_id, table, outcomes, numeric_products)

    return _start(stream, apply, checkpoint, available_now)


def apply_batch(batch: DataFrame, batch_id: int, rows: KeyedTable, counts: KeyedTable, k: int = 2, **cooc_options) -> None:
    """Fold one batch of sales rows into ``rows`` (which keeps batch numbers) and the k-tuple ``counts``."""
    spark = batch.sparkSession
    if counts.covers(batch_id):
        return
    if not rows.covers(batch_id):
        seen, path = Observation(), scratch_path(spark, "batch")
        batch.select(*KEYS).dropDuplicates(list(KEYS)).observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
        incoming, n = spark.read.parquet(path), int(seen.get["n"])
        with pushed_values(spark, n):
            rows.append(batch_id, new_rows(incoming, rows.near(incoming), KEYS, incoming_is_small=_small(spark, n)), expected=n)
    own = F.col(BATCH) == batch_id
    # the batch's segment, or the one it was merged into
    held = [s for s in rows.segments() if s.first <= batch_id <= s.last]
    written = rows._union(held).where(own).select(*KEYS)
    n = held[0].rows
    with pushed_values(spark, n):
        old = rows.near(written).where(F.col(BATCH) < batch_id).select(*KEYS)
        delta = count_delta(written, old, k, new_is_small=_small(spark, n), disjoint=True, **cooc_options)
        counts.append(batch_id, delta)


def start_counts(stream: DataFrame, rows: KeyedTable, counts: KeyedTable, checkpoint: str, k: int = 2, available_now: bool = True, **cooc_options) -> StreamingQuery:
    """Keep k-tuple counts of a stream of sales rows current."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        apply_batch(batch, batch_id, rows, counts, k, **cooc_options)

    return _start(stream, apply, checkpoint, available_now)


def _start(stream: DataFrame, apply, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_counts(counts: KeyedTable) -> DataFrame:
    """Current counts: the sum of all live segments."""
    return merge_counts(counts.read())
