"""Running co-occurrence counts maintained as sales rows stream in.

Layout (both Parquet, partitioned by micro-batch id):

* ``rows_path/batch_id=<b>/bucket=<i>``: the distinct rows that batch ``b``
  added, by a stable bucket of the basket, so that a later batch reads only the
  buckets that occur in it;
* ``counts_path/batch_id=<b>``: the count delta of batch ``b``.

Batch ``b`` treats only partitions ``< b`` as old rows and overwrites its
own two partitions (dynamic partition overwrite). A batch replayed after a
failure therefore rewrites identical partitions instead of adding its delta
twice, whether or not its earlier attempt committed. Current counts are the
sum of all delta partitions (:func:`read_counts`); :func:`compact_counts`
folds old partitions into one snapshot when their number grows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from cobasket.operators.cooccur import product_columns
from cobasket.functions.keys import md5_shard
from cobasket.operators.dedup import new_rows
from cobasket.operators.incremental import count_delta, merge_counts
from cobasket.session import fits_broadcast, stored
from cobasket.sources.sales import BASKET, PRODUCT, read_table_or_empty

BUCKETS = 32
BUCKET = "bucket"


def _read_partitioned(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    names = {f.name for f in schema.fields}
    full = StructType(schema.fields + [StructField("batch_id", LongType(), True)] * ("batch_id" not in names))
    return read_table_or_empty(spark, path, full)


def apply_batch(
    batch: DataFrame,
    batch_id: int,
    rows_path: str,
    counts_path: str,
    k: int = 2,
    basket: str = BASKET,
    item: str = PRODUCT,
    broadcast_bytes: int | None = None,
    **cooc_options,
) -> None:
    """Fold one micro-batch into the rows and count-delta tables (replay-safe)."""
    spark = batch.sparkSession
    keys = [basket, item]
    bucket = md5_shard(F.coalesce(F.col(basket).cast("string"), F.lit("")), BUCKETS)
    batch = stored(batch.select(*keys).dropDuplicates(keys).withColumn(BUCKET, bucket), "batch")
    small = fits_broadcast(batch.select(*keys), broadcast_bytes)
    schema = StructType([*batch.schema.fields, StructField("batch_id", LongType(), True)])
    # at most BUCKETS values; filters on partition columns prune the scan
    touched = [r[0] for r in batch.select(BUCKET).distinct().collect()]
    rows = _read_partitioned(spark, rows_path, schema).where(F.col(BUCKET).isin(touched))
    old = rows.where(F.col("batch_id") < batch_id).select(*keys)
    added = new_rows(batch, old, keys, incoming_is_small=small).withColumn(BUCKET, bucket)
    _write_partition(added, batch_id, rows_path, BUCKET)
    # read back what was written, so that it isn't found a second time
    written = _read_partitioned(spark, rows_path, schema).where(F.col("batch_id") == batch_id).select(*keys)
    delta = count_delta(written, old, k, basket, item, new_is_small=small, disjoint=True, **cooc_options)
    _write_partition(delta, batch_id, counts_path)


def _write_partition(df: DataFrame, batch_id: int, path: str, *by: str) -> None:
    """Replace the partitions of one batch; an empty batch leaves its id with no rows."""
    (
        df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id", *by)
        .parquet(path)
    )


def start_pair_count_stream(
    stream: DataFrame,
    rows_path: str,
    counts_path: str,
    checkpoint: str,
    k: int = 2,
    basket: str = BASKET,
    item: str = PRODUCT,
    available_now: bool = True,
    **cooc_options,
) -> StreamingQuery:
    """Start a ``foreachBatch`` query that keeps k-tuple counts current."""

    def _fold(batch: DataFrame, batch_id: int) -> None:
        apply_batch(batch, batch_id, rows_path, counts_path, k, basket, item, **cooc_options)

    writer = stream.writeStream.foreachBatch(_fold).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_counts(
    spark: SparkSession, counts_path: str, k: int, item_type=LongType(), must_exist: bool = False
) -> DataFrame:
    """Current counts: the sum of every batch's delta, zero rows dropped.

    Before the first batch there is no table: then there are no counts, or an
    error with ``must_exist``.
    """
    if must_exist:
        spark.read.parquet(counts_path)
    schema = StructType(
        [StructField(c, item_type, True) for c in product_columns(k)]
        + [StructField("baskets", LongType(), True)]
    )
    return merge_counts(_read_partitioned(spark, counts_path, schema).drop("batch_id"))


def compact_counts(
    spark: SparkSession,
    counts_path: str,
    k: int,
    upto_batch: int,
    out_path: str,
    item_type=LongType(),
) -> None:
    """Write the summed deltas of batches ``<= upto_batch`` as one snapshot
    partition (``batch_id = upto_batch``) under ``out_path``; swap paths
    outside Spark once the write has committed."""
    schema = StructType(
        [StructField(c, item_type, True) for c in product_columns(k)]
        + [StructField("baskets", LongType(), True)]
    )
    old = _read_partitioned(spark, counts_path, schema)
    snap = merge_counts(old.where(F.col("batch_id") <= upto_batch).drop("batch_id"))
    rest = old.where(F.col("batch_id") > upto_batch)
    (
        snap.withColumn("batch_id", F.lit(upto_batch).cast("bigint"))
        .unionByName(rest)
        .write.mode("overwrite")
        .partitionBy("batch_id")
        .parquet(out_path)
    )
