"""Synthetic basket data, generated on the executors.

Each basket gets 1..``max_size`` distinct products out of ``num_products``.
Draws are md5 hashes of ``(seed, basket key, draw index)``, so the data is a
pure function of its inputs: reproducible, retry-safe, and reproducible in
SQL engines with md5. (The original generator used an unseeded RNG; exact
sequences were never reproducible.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cobasket.sources.sales import BASKET, PRODUCT


def _h32(*parts: Column) -> Column:
    text = F.concat_ws("|", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def uuid_text(*parts: Column) -> Column:
    """A UUID-shaped text id (8-4-4-4-12 hex) from the md5 of ``parts``."""
    h = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return F.concat_ws(
        "-",
        F.substring(h, 1, 8),
        F.substring(h, 9, 4),
        F.substring(h, 13, 4),
        F.substring(h, 17, 4),
        F.substring(h, 21, 12),
    )


def baskets_for_keys(
    keys: DataFrame,
    key: str,
    num_products: Column | int,
    max_size: int = 5,
    seed: int = 0,
) -> DataFrame:
    """``basket_id, product_id`` rows: one synthetic basket per row of ``keys``.

    Basket size is ``1 + h(seed, key, 'n') % max_size`` (at most
    ``num_products``); products are a sample without replacement by Floyd's
    method: for j from ``num_products - size`` up, draw
    ``h(seed, key, j) % (j + 1)`` and take j itself if that was taken before.
    Each step adds one product, so a basket has exactly the drawn size.
    """
    k = F.col(key)
    s = F.lit(seed)
    p = num_products if isinstance(num_products, Column) else F.lit(num_products)
    p = p.cast("bigint")
    size = F.least(F.lit(1) + F.pmod(_h32(s, k, F.lit("n")), F.lit(max_size)), p)

    def take(taken: Column, j: Column) -> Column:
        drawn = F.pmod(_h32(s, k, j), j + 1)
        return F.array_append(taken, F.when(F.array_contains(taken, drawn), j).otherwise(drawn))

    picked = F.aggregate(F.sequence(p - size, p - 1), F.array().cast("array<bigint>"), take)
    return keys.select(uuid_text(s, k).alias(BASKET), F.explode(picked).alias("_p")).select(
        BASKET, F.col("_p").cast("string").alias(PRODUCT)
    )


def generate_baskets(
    spark: SparkSession,
    scale: int = 1,
    seed: int = 0,
    max_size: int = 5,
    num_partitions: int | None = None,
) -> DataFrame:
    """``scale * 2**16`` baskets over ``scale * 2**8`` products (text ids).

    ``spark.range`` is split into ``num_partitions`` slices, so generation
    runs in parallel on the executors, with no driver-side data.
    """
    if scale < 1:
        raise ValueError("scale must be >= 1")
    keys = spark.range(0, scale * 2**16, 1, num_partitions)
    return baskets_for_keys(keys, "id", scale * 2**8, max_size, seed)
