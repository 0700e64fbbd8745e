"""Deduplication, new-row detection, duplicate statistics and injection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cobasket.functions.keys import hash_fraction
from cobasket.sources.sales import BASKET, PRODUCT

KEYS = (BASKET, PRODUCT)
#: Copies of one row that a task expands at a time.
COPIES = 1 << 16


def dedup(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per key. Planned as an aggregate with map-side combine, so a
    key with millions of copies leaves each task as one row."""
    return df.dropDuplicates(list(keys))


def union_dedup(existing: DataFrame, incoming: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Distinct rows of ``existing`` plus ``incoming`` (matched by name)."""
    return dedup(existing.unionByName(incoming), keys)


def new_rows(
    incoming: DataFrame,
    existing: DataFrame,
    keys: Sequence[str] = KEYS,
    incoming_is_small: bool = False,
    tasks: int = 0,
) -> DataFrame:
    """Distinct ``incoming`` keys that are absent from ``existing``.

    Default plan: one aggregation over the union of both key sets, tagged by
    side. A single exchange, partial aggregation before it (a key with
    millions of copies leaves each task as one row), and NULL keys compare
    equal, as in ``dropDuplicates``. An anti-join would shuffle the raw
    incoming rows (Catalyst pushes it below the dedup) and then shuffle again.

    ``incoming_is_small``: the caller has checked that the distinct incoming
    keys fit in a broadcast. Then ``existing`` is only scanned and probed
    against them (no shuffle of the big table), which suits incremental
    batches against a large table.

    ``tasks``: the caller has checked that no key has very many copies. Then the
    rows are dealt to so many tasks of the default plan, as they are.
    """
    keys = list(keys)
    inc = incoming.select(*keys)
    ex = existing.select(*keys)
    if incoming_is_small:
        inc_d = inc.dropDuplicates(keys)
        cond = [ex[k].eqNullSafe(F.col(f"_i.{k}")) for k in keys]
        present = ex.join(F.broadcast(inc_d.alias("_i")), cond, "left_semi").dropDuplicates(keys)
        # both sides are bounded by the incoming size from here on
        cond2 = [F.col(f"_n.{k}").eqNullSafe(F.col(f"_p.{k}")) for k in keys]
        return inc_d.alias("_n").join(F.broadcast(present.alias("_p")), cond2, "left_anti")
    tagged = inc.withColumn("_src", F.lit(1)).unionByName(ex.withColumn("_src", F.lit(2)))
    if tasks:
        tagged = tagged.repartition(tasks, *keys)
    return (
        tagged.groupBy(*keys)
        .agg(F.bit_or("_src").alias("_src"))
        .where(F.col("_src") == 1)
        .select(*keys)
    )


def duplicate_stats(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row: ``rows, distinct_rows, duplicate_rows, duplicate_ratio``."""
    keys = list(keys)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
    return per_key.agg(
        F.coalesce(F.sum("_c"), F.lit(0)).cast("bigint").alias("rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
    ).select(
        "rows",
        "distinct_rows",
        (F.col("rows") - F.col("distinct_rows")).alias("duplicate_rows"),
        F.round(
            F.when(F.col("rows") > 0, (F.col("rows") - F.col("distinct_rows")) / F.col("rows")).otherwise(0.0),
            6,
        ).alias("duplicate_ratio"),
    )


def inject_duplicates(
    df: DataFrame,
    ratio: float = 0.15,
    seed: int = 42,
    id_cols: Sequence[str] | None = None,
    scramble: bool = False,
) -> DataFrame:
    """Every row once, plus one extra copy of each row drawn with ``ratio``.

    The draw is ``md5(seed | ids) < ratio``, a deterministic function of the
    row, so a retried task redraws the same rows (a ``rand()`` draw after a
    shuffle would not survive executor loss) and another engine can
    reproduce it. ``id_cols`` default to all columns; then identical rows
    share their draw. ``scramble`` mixes row order by a hash shuffle plus a
    per-partition sort, without a global sort; the hash takes in each row's
    position, so that equal rows spread over all tasks.
    """
    if not 0.0 <= ratio <= 1.0:
        raise ValueError("ratio must be within [0, 1]")
    ids = list(id_cols) if id_cols else df.columns
    draw = hash_fraction(F.lit(seed), *ids)
    # one scan: each row is emitted once, or twice when drawn
    copies = F.when(draw < F.lit(ratio), F.lit(2)).otherwise(F.lit(1))
    out = df.select(*df.columns, F.explode(F.sequence(F.lit(1), copies)).alias("_copy")).drop("_copy")
    if scramble:
        key = F.xxhash64(F.lit(seed), *[F.col(c) for c in df.columns], F.monotonically_increasing_id())
        out = out.withColumn("_perm", key).repartition("_perm").sortWithinPartitions("_perm").drop("_perm")
    return out


def inject_by_occurrence(df: DataFrame, ratio: float = 0.15, seed: int = 42, scramble: bool = False) -> DataFrame:
    """Every row once, plus one extra copy of each occurrence drawn with ``ratio``.

    Equal rows are counted, and the i-th of them is drawn if
    ``md5(seed | values | i) < ratio`` (nulls left out). So each copy has a draw of
    its own, and the result depends neither on the order nor on the partitions of
    the input, nor on retries. A row of very many copies is expanded by several
    tasks, ``COPIES`` at a time. ``scramble`` mixes the order by a hash of the same
    values.
    """
    if not 0.0 <= ratio <= 1.0:
        raise ValueError("ratio must be within [0, 1]")
    columns = df.columns
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    parts = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_n") - 1) / COPIES).cast("bigint"))
    spread = counted.select("*", F.explode(parts).alias("_part")).repartition(*columns, "_part")
    first = F.col("_part") * COPIES + 1
    each = F.sequence(first, F.least(F.col("_n"), first + COPIES - 1))
    rows = spread.select(*columns, F.explode(each).alias("_at"))
    times = F.when(hash_fraction(F.lit(seed), *columns, "_at") < F.lit(ratio), F.lit(2)).otherwise(F.lit(1))
    out = rows.select("*", F.explode(F.sequence(F.lit(1), times)).alias("_time"))
    if scramble:
        out = out.withColumn("_perm", F.xxhash64(F.lit(seed), *columns, "_at", "_time")).repartition("_perm").sortWithinPartitions("_perm")
    return out.select(*columns)


def injection_stats(original: DataFrame, injected: DataFrame) -> DataFrame:
    """One row: ``original_rows, duplicate_rows, total_rows``."""
    sides = original.select(F.lit(1).alias("_o"), F.lit(0).alias("_t")).unionByName(
        injected.select(F.lit(0).alias("_o"), F.lit(1).alias("_t"))
    )
    totals = sides.agg(
        F.coalesce(F.sum("_o"), F.lit(0)).cast("bigint").alias("original_rows"),
        F.coalesce(F.sum("_t"), F.lit(0)).cast("bigint").alias("total_rows"),
    )
    return totals.select(
        "original_rows",
        (F.col("total_rows") - F.col("original_rows")).alias("duplicate_rows"),
        "total_rows",
    )
