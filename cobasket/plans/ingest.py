"""Incremental, deduplicating ingest of sales files into a Parquet table.

Each run:

1. lists the input directory (distributed ``binaryFile`` listing, metadata
   only), anti-joins it with the processed-file log and writes that list, the
   drop, to the scratch folder;
2. reads only the drop's files, counts clean rows and rejects by reason, and
   writes the distinct clean rows to the scratch folder;
3. finds those that the table lacks and **appends** them;
4. then appends the drop's list to the log.

The table is partitioned by a stable bucket of the basket, so that a run reads
only the buckets that occur in its drop. It is never overwritten while it is
being read (an overwrite of the path a plan reads can delete the input before
it is consumed). Progress is recorded only after the data commit; a crash
between the two re-reads the same files next time and finds no new row in them,
so runs are at-least-once and idempotent. Single writer per table.

The log is a small Parquet table of ``path, batch_id, ingested_at`` kept on
the same filesystem as the table, not a local text file. The drop's paths pass
through the driver, as Spark's readers take and list their paths there.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType, TimestampType

from cobasket.functions.keys import md5_shard
from cobasket.operators.clean import clean_sales, reject_reason
from cobasket.operators.dedup import KEYS, new_rows
from cobasket.session import fits_broadcast, stored
from cobasket.sources.sales import BASKET, SALES_SCHEMA, list_files, read_sales_csv, read_table_or_empty

#: Buckets of an ingested table; fixed for the table's life.
BUCKETS = 64
BUCKET = "bucket"

LOG_SCHEMA = StructType(
    [
        StructField("path", StringType(), True),
        StructField("batch_id", LongType(), True),
        StructField("ingested_at", TimestampType(), True),
    ]
)


@dataclass
class IngestResult:
    """What a run did: files and rows read, rows rejected by reason, rows appended, and the table's rows after it."""

    new_files: list[str]
    rows_read: int
    rows_appended: int
    table_rows: int
    batch_id: int | None
    rejected: dict[str, int] = field(default_factory=dict)


def bucket_of(basket: Column | str = BASKET) -> Column:
    return md5_shard(F.coalesce(F.col(basket) if isinstance(basket, str) else basket, F.lit("")), BUCKETS)


def load_processed_log(spark: SparkSession, log_path: str) -> DataFrame:
    """The processed-file log (empty if it does not exist yet)."""
    return read_table_or_empty(spark, log_path, LOG_SCHEMA)


def find_new_files(spark: SparkSession, input_dir: str, log_path: str) -> DataFrame:
    """``path, length`` of CSV / CSV.GZ files in ``input_dir`` not in the log."""
    listing = list_files(spark, input_dir).select("path", "length")
    done = load_processed_log(spark, log_path).select("path")
    return listing.join(done, "path", "left_anti")


def _table(spark: SparkSession, table_path: str) -> DataFrame:
    schema = StructType([*SALES_SCHEMA.fields, StructField(BUCKET, IntegerType(), True)])
    return read_table_or_empty(spark, table_path, schema)


def ingest(
    spark: SparkSession,
    input_dir: str,
    table_path: str,
    log_path: str,
    numeric_products: bool = False,
    partition_by_date: bool = False,
    broadcast_bytes: int | None = None,
) -> IngestResult:
    """Run one incremental ingest; see the module docstring.

    ``broadcast_bytes`` bounds the measured size of a drop's distinct rows that
    is broadcast against the table (default: the session's
    ``spark.sql.autoBroadcastJoinThreshold``; -1 never).

    ``partition_by_date`` adds an ``ingest_date`` column and partitions the
    table by it first (dedup is still on the two keys across all dates).
    """
    drop = stored(find_new_files(spark, input_dir, log_path), "drop")
    paths = [r.path for r in drop.select("path").collect()]
    table = _table(spark, table_path)
    if not paths:
        return IngestResult([], 0, 0, table.count(), None)

    last = load_processed_log(spark, log_path).agg(F.max("batch_id")).first()[0]
    batch_id = 0 if last is None else int(last) + 1

    raw = read_sales_csv(spark, paths)
    reason = reject_reason(raw, numeric_products=numeric_products)
    outcome = {r.reason: r.n for r in raw.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n")).collect()}
    clean = clean_sales(raw, numeric_products=numeric_products).dropDuplicates(list(KEYS))
    incoming = stored(clean.withColumn(BUCKET, bucket_of()), "incoming")

    # at most BUCKETS values; the filter on the partition column prunes the scan
    touched = [r[0] for r in incoming.select(BUCKET).distinct().collect()]
    existing = table.where(F.col(BUCKET).isin(touched)).select(*KEYS)
    to_add = new_rows(incoming, existing, KEYS, incoming_is_small=fits_broadcast(incoming, broadcast_bytes))
    to_add = stored(to_add.withColumn(BUCKET, bucket_of()), "added")
    appended = to_add.count()
    # a few files for each bucket; a large one is split
    placed = to_add.hint("rebalance", BUCKET)
    if partition_by_date:
        placed = placed.withColumn("ingest_date", F.current_date())
    by = [*(["ingest_date"] if partition_by_date else []), BUCKET]
    placed.write.mode("append").partitionBy(*by).parquet(table_path)

    entry = drop.select("path", F.lit(batch_id).cast("bigint").alias("batch_id"), F.current_timestamp().alias("ingested_at"))
    entry.write.mode("append").parquet(log_path)
    rejected = {k: v for k, v in outcome.items() if k is not None}
    return IngestResult(paths, sum(outcome.values()), appended, _table(spark, table_path).count(), batch_id, rejected)


def read_table(spark: SparkSession, table_path: str) -> DataFrame:
    """Current contents of an ingested table (fresh file listing each call)."""
    return read_table_or_empty(spark, table_path, SALES_SCHEMA).select(*KEYS)
