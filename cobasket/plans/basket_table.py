"""Baskets stored for counting: distinct rows, bucketed and sorted by basket, with basket sizes.

``write_baskets`` reads its input once. The distinct (basket, item) rows are written to the
scratch folder, spread by both columns, and everything else comes from them: baskets of more
than ``split`` items are found by a partially aggregated count, and their rows go with their
size to a plain table (``crowded``); all other rows go to a Spark table bucketed and sorted by
basket (``light``), each with its basket's size.

Counts of such a table need no exchange by basket, no distinct and no search for heavy baskets:
a bucket holds whole baskets, so that grouping or joining by basket starts from the scan; sizes
are pushed to the Parquet reader (baskets below k items are not read, those whose combinations
would be too many for one task are counted by the blocked plan). Item support is one grouping.

No bucket or task holds a crowded basket. A table is written once and not appended to (that is
what ``keyed_table`` is for). ``about`` is written last: a folder without it is an unfinished
write, and ``open_baskets`` refuses it. Rows with a null basket or item are left out; an empty
input gives an empty table.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from math import ceil

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cobasket.operators.cooccur import heavy_threshold_for, sized_cooccurrence
from cobasket.session import stored

SIZE = "basket_size"
# a bucket is one task: its rows and their combinations are sorted and counted there
ROWS_PER_BUCKET = 500_000


@dataclass(frozen=True)
class BasketTable:
    """A stored table of baskets; ``name`` is the bucketed table in the session's catalog."""

    spark: SparkSession
    path: str
    name: str
    basket: str
    item: str
    buckets: int
    crowded_rows: int

    def light(self) -> DataFrame:
        """basket, item and basket size of all baskets of up to ``split`` items, bucketed by basket."""
        return self.spark.table(self.name)

    def crowded(self) -> DataFrame:
        """The same columns of all other baskets."""
        return self.spark.read.parquet(f"{self.path}/crowded")

    def rows(self) -> DataFrame:
        """All distinct rows, with basket sizes."""
        return self.light().unionByName(self.crowded())

    def sizes(self) -> DataFrame:
        """basket and basket size, one row a basket: no exchange for light baskets, a partial aggregation for the rest."""
        keys = [self.basket, SIZE]
        return self.light().select(*keys).distinct().unionByName(self.crowded().select(*keys).distinct())

    def cooccurrence(self, k: int = 2, plan: str = "array", strict: bool = True, threshold: int | None = None) -> DataFrame:
        """As ``operators.cooccur.cooccurrence``: ``product_1 .. product_k, baskets``.

        ``plan`` ("array" or "join") is for baskets of up to ``threshold`` items, by default those
        whose combinations fit one task; larger ones are counted block by block.
        """
        limit = heavy_threshold_for(k) if threshold is None else threshold
        light, size = self.light(), F.col(SIZE)
        if k == 1:
            return sized_cooccurrence(self.rows(), None, 1, self.basket, self.item, SIZE, plan, strict)
        small = light.where((size >= k) & (size <= limit))
        over = light.where(size > limit)
        parts = [over] if not over.isEmpty() else []
        if self.crowded_rows:
            parts.append(self.crowded())
        large = parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0] if parts else None
        return sized_cooccurrence(small, large, k, self.basket, self.item, SIZE, plan, strict)


def write_baskets(
    df: DataFrame,
    path: str,
    basket: str = "basket_id",
    item: str = "product_id",
    split: int | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> BasketTable:
    """Store the baskets of ``df`` under ``path`` (a new folder that all executors share).

    ``split`` is the number of items up to which a basket may lie in one bucket (default: the
    largest basket whose pairs one task may emit). There is one bucket for each
    ``rows_per_bucket`` rows, at least one for each core, and at most as many as the session
    allows (``spark.sql.sources.bucketing.maxBuckets``).
    """
    if SIZE in (basket, item):
        raise ValueError(f"neither key may be named {SIZE}")
    spark = df.sparkSession
    limit = heavy_threshold_for(2) if split is None else split
    known = df.where(F.col(basket).isNotNull() & F.col(item).isNotNull()).select(basket, item)
    rows = stored(known.distinct(), "basket-rows")
    sizes = rows.groupBy(basket).agg(F.count(F.lit(1)).alias(SIZE))
    crowds = stored(sizes.where(F.col(SIZE) > limit), "crowded-baskets")
    rows.join(crowds, basket).select(basket, item, SIZE).write.parquet(f"{path}/crowded")

    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))
    buckets = min(most, max(spark.sparkContext.defaultParallelism, ceil(rows.count() / rows_per_bucket)))
    # one task for each bucket, so that a bucket is one file; baskets are at most `limit` rows here
    light = rows.join(crowds, basket, "left_anti").repartition(buckets, basket)
    counted = light.withColumn(SIZE, F.count(F.lit(1)).over(Window.partitionBy(basket)))
    name = f"baskets_{uuid.uuid4().hex}"
    writer = counted.write.format("parquet").option("path", f"{path}/light")
    writer.bucketBy(buckets, basket).sortBy(basket, item).saveAsTable(name)

    crowded_rows = spark.read.parquet(f"{path}/crowded").count()
    about = spark.range(1).select(
        F.lit(basket).alias("basket"), F.lit(item).alias("item"), F.lit(buckets).alias("buckets"), F.lit(crowded_rows).cast("bigint").alias("crowded_rows")
    )
    about.write.parquet(f"{path}/about")
    return BasketTable(spark, path, name, basket, item, buckets, crowded_rows)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def open_baskets(spark: SparkSession, path: str) -> BasketTable:
    """A table that an earlier session wrote, entered into this session's catalog."""
    about = spark.read.parquet(f"{path}/about").first()
    name = f"baskets_{uuid.uuid4().hex}"
    fields = spark.read.parquet(f"{path}/crowded").schema.fields
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in fields)
    basket, item = _quoted(about.basket), _quoted(about.item)
    place = f"{path}/light".replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet "
        f"CLUSTERED BY ({basket}) SORTED BY ({basket}, {item}) INTO {about.buckets} BUCKETS LOCATION '{place}'"
    )
    return BasketTable(spark, path, name, about.basket, about.item, about.buckets, about.crowded_rows)
