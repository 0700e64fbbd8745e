"""k-combination expansion of sorted item arrays with built-in generators.

Given one row per basket holding its sorted, distinct items, emit one row per
k-combination in ascending order. Each step ``posexplode``s the slice of the
array that can still complete a k-combination, so no row is generated and
then filtered away.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def expand_combinations(
    baskets: DataFrame,
    items: str,
    k: int,
    names: list[str],
    keep: list[str] | None = None,
) -> DataFrame:
    """Rows of ``keep + names``: every ascending k-combination of ``items``.

    ``baskets[items]`` must be sorted and distinct, with ``size >= k``.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    if len(names) != k:
        raise ValueError("need one output name per combination member")
    keep = list(keep or [])
    arr = F.col(items)
    size = F.size(arr)
    # first member: positions 0 .. size-k
    cur = baskets.select(
        *keep, items, F.posexplode(F.slice(arr, 1, size - k + 1)).alias("_p", names[0])
    )
    for j in range(1, k):
        p = F.col("_p")
        # next member: positions p+1 .. size-k+j (0-based); slice is 1-based
        nxt = F.slice(arr, p + 2, size - F.lit(k - j) - p)
        cur = cur.select(
            *keep, items, *names[:j], p.alias("_q"), F.posexplode(nxt).alias("_r", names[j])
        ).select(*keep, items, *names[: j + 1], (F.col("_q") + 1 + F.col("_r")).alias("_p"))
    return cur.select(*keep, *names)
