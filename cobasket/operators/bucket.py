"""Stable basket bucketing and the reports that check it.

``assign_shards`` gives every basket a published, engine-independent shard
id (md5 of the key text, modulo n). Use it where the id itself matters
(files other systems read); for plain co-location inside Spark,
``repartition(n, basket)`` or ``bucketBy`` is cheaper.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cobasket.functions.keys import md5_shard
from cobasket.sources.sales import BASKET

SHARD = "shard"


def assign_shards(
    df: DataFrame, num_shards: int, basket: str = BASKET, shard: str = SHARD
) -> DataFrame:
    """Add ``shard = int(md5(str(basket)), 16) % num_shards``; row-local, no shuffle."""
    return df.withColumn(shard, md5_shard(basket, num_shards))


def shard_balance(assigned: DataFrame, num_shards: int, shard: str = SHARD) -> DataFrame:
    """Rows per shard for every shard id, empty shards included as 0.

    Columns ``shard, rows, rows_over_mean``. The per-shard count is a partial
    aggregation (one row per task and shard crosses the shuffle); the total
    comes from a window over its at most ``num_shards`` output rows.
    """
    spark = assigned.sparkSession
    # every shard id enters the same aggregation as a zero row, so empty
    # shards appear without a join (a join would re-evaluate the md5 fold in
    # an inferred null filter)
    ids = spark.range(num_shards).select(
        F.col("id").cast("int").alias(shard), F.lit(0).cast("bigint").alias("_one")
    )
    rows = assigned.select(shard, F.lit(1).cast("bigint").alias("_one")).unionByName(ids)
    counts = rows.groupBy(shard).agg(F.sum("_one").alias("rows"))
    total = F.sum("rows").over(Window.partitionBy())  # <= num_shards rows
    return counts.select(
        shard,
        "rows",
        F.round(F.col("rows") * F.lit(num_shards) / total, 6).alias("rows_over_mean"),
    )


def shard_summary(assigned: DataFrame, num_shards: int, shard: str = SHARD) -> DataFrame:
    """One row: range and spread of shard ids, and the balance ratio.

    ``shards``, ``used_shards``, ``min_shard``, ``max_shard``,
    ``out_of_range`` rows, ``max_rows``, ``mean_rows``, ``max_over_mean``.
    """
    per = assigned.groupBy(shard).agg(F.count(F.lit(1)).alias("rows"))
    return per.agg(
        F.lit(num_shards).alias("shards"),
        F.count(F.lit(1)).alias("used_shards"),
        F.min(shard).alias("min_shard"),
        F.max(shard).alias("max_shard"),
        F.coalesce(
            F.sum(F.when((F.col(shard) < 0) | (F.col(shard) >= num_shards), F.col("rows"))),
            F.lit(0),
        ).cast("bigint").alias("out_of_range"),
        F.max("rows").alias("max_rows"),
        F.round(F.sum("rows") / F.lit(num_shards), 6).alias("mean_rows"),
        F.round(F.max("rows") * F.lit(num_shards) / F.sum("rows"), 6).alias("max_over_mean"),
    )


def shard_integrity(assigned: DataFrame, basket: str = BASKET, shard: str = SHARD) -> DataFrame:
    """One row: ``baskets, rows, split_baskets`` (baskets seen in > 1 shard).

    ``count_distinct`` first shuffles on (basket, shard) pairs, so a basket
    with a third of all rows still spreads over many tasks.
    """
    per_basket = assigned.groupBy(basket).agg(
        F.count(F.lit(1)).alias("_rows"), F.count_distinct(shard).alias("_shards")
    )
    return per_basket.agg(
        F.count(F.lit(1)).alias("baskets"),
        F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint").alias("rows"),
        F.count(F.when(F.col("_shards") > 1, True)).alias("split_baskets"),
    )
