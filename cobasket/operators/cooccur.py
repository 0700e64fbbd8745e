"""Basket co-occurrence: how many baskets contain each k-combination of items.

One parameterized operator serves item support (k=1), pairs (k=2), triples
and beyond. Semantics: a basket is the *set* of its items (duplicate rows
collapse, row order is irrelevant), combinations are written in ascending
item order, and only baskets with at least k distinct items contribute.

Plans
-----
``array`` (light baskets)
    ``groupBy(basket).agg(array_sort(collect_set(item)))`` then nested
    ``posexplode`` over array slices, then ``groupBy(tuple).count()``. Two
    shuffles, both with map-side partial aggregation (``collect_set`` dedups
    before the exchange; the tuple count is combined per task, so a pair that
    occurs in a third of all baskets costs one row per task, not one per
    basket).
``blocked`` (heavy baskets)
    A basket of more *distinct items* than ``heavy_threshold`` is never
    collected into one row or one task. Its items are hashed into
    ``s = ceil(n / block)`` blocks; block pair ``(a, b)``, ``a <= b``, is one
    join key, so the C(n, 2) pairs of the basket are spread over s(s+1)/2
    tasks with about ``block`` items per side. Larger k extends pairs by
    salted joins with about C(n, j-1) * n / block**2 salts at step j, so each
    task again sees about ``block**2`` candidates. The replicated sides carry
    a merge hint: Catalyst prices them as they are before ``explode``.
``join``
    Chained self-joins on the basket with an ascending residual, the textbook
    SQL formulation. Kept as an independent plan for reconciliation; AQE's
    skew-join handling splits oversized basket partitions.
``auto``
    One aggregation finds the baskets whose *rows* could exceed the threshold.
    Usually there are none, and ``array`` takes all, with as many tasks as rows and
    combinations need (``TASK_TUPLES``). Otherwise the distinct
    rows of those candidates are written to the shared scratch folder, their
    distinct items are counted, and only baskets over the threshold by that
    count go to ``blocked``; duplicates cost a candidate nothing but the one
    distinct. Joins with the candidates are left to Spark, which knows the
    written table's size.
"""

from __future__ import annotations

from math import ceil, comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cobasket.functions.combos import expand_combinations
from cobasket.functions.keys import sortable_item, text_order, unwrap_item
from cobasket.session import stored

# Largest number of k-combinations one basket may emit from a single task in
# the array plan; baskets that would emit more go to the blocked plan. The
# default row threshold is derived from it per k (k=2: 2000, k=3: 230, k=4: 84).
COMBO_BUDGET = 2_000_000
PLANS = ("auto", "array", "blocked", "join")
# Tuples (and rows) that one task holds, about; tasks of fewer rows than LEAST_ROWS are not worth a split.
TASK_TUPLES = 1_000_000
LEAST_ROWS = 20_000


def product_columns(k: int) -> list[str]:
    return [f"product_{i}" for i in range(1, k + 1)]


def heavy_threshold_for(k: int, budget: int = COMBO_BUDGET) -> int:
    """Largest basket size n with C(n, k) <= budget (at least k)."""
    n = k
    while comb(n + 1, k) <= budget:
        n += 1
    return n


def block_for(k: int) -> int:
    """Items per block: half a threshold basket, so that a heavy basket has several blocks."""
    return max(2, heavy_threshold_for(k) // 2)


def _tuple_cols(k: int) -> list[str]:
    return [f"_c{i}" for i in range(1, k + 1)]


def _rows(df: DataFrame, basket: str, item: str, strict: bool, flag: str | None) -> DataFrame:
    """(_b, _i[, _f]) with null keys removed; _i sorts in output order."""
    cols = [F.col(basket).alias("_b"), sortable_item(df, item, strict).alias("_i")]
    if flag:
        cols.append(F.coalesce(F.col(flag).cast("boolean"), F.lit(False)).alias("_f"))
    return df.where(F.col(basket).isNotNull() & F.col(item).isNotNull()).select(*cols)


def candidate_baskets(rows: DataFrame, threshold: int) -> DataFrame:
    """Baskets of more than ``threshold`` rows: a superset of those with as many
    distinct items. Partial aggregation keeps a hot basket at one row per task."""
    return rows.groupBy("_b").agg(F.count(F.lit(1)).alias("_r")).where(F.col("_r") > F.lit(threshold)).select("_b")


def _tasks(df: DataFrame, rows: int, tuples: float) -> int:
    """Tasks for so many rows and tuples; 0 where the session's own partitions are as small."""
    n = ceil(max(rows / TASK_TUPLES, min(tuples / TASK_TUPLES, rows / LEAST_ROWS)))
    return n if n > df.sparkSession.sparkContext.defaultParallelism else 0


def row_tasks(df: DataFrame, basket: str) -> int:
    """Tasks that rows can be dealt to as they are; 0 (Spark's own, after partial aggregation) for few rows, or a basket of
    more than a task's, as its rows may be copies of one."""
    per = df.groupBy(basket).agg(F.count(F.lit(1)).alias("_r"))
    largest, rows = per.agg(F.max("_r"), F.sum("_r")).first()
    return _tasks(df, rows or 0, 0.0) if (largest or 0) <= TASK_TUPLES else 0


def _spread(df: DataFrame, tasks: int, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` to ``tasks`` tasks, whose number follows the input; 0: left to Spark."""
    return df.repartition(tasks, *keys) if tasks else df


def _combinations(n: str, k: int) -> Column:
    """C(n, k) as a double."""
    c = F.lit(1.0)
    for i in range(k):
        c = c * F.greatest(F.col(n) - F.lit(i), F.lit(0)) / F.lit(float(i + 1))
    return c


def _load(rows: DataFrame, k: int, threshold: int) -> tuple[int, int, float]:
    """Rows of the largest basket, all rows, and about how many k-combinations they make (up to ``threshold`` rows a basket)."""
    per = rows.groupBy("_b").agg(F.count(F.lit(1)).alias("_r")).withColumn("_m", F.least("_r", F.lit(threshold)))
    got = per.agg(F.max("_r"), F.sum("_r"), F.sum(_combinations("_m", k))).first()
    return got[0] or 0, got[1] or 0, got[2] or 0.0


def _sized(distinct_rows: DataFrame) -> DataFrame:
    """``distinct_rows`` with the basket's number of distinct items, ``_n``."""
    sizes = stored(distinct_rows.groupBy("_b").agg(F.count(F.lit(1)).alias("_n")), "basket-sizes")
    return distinct_rows.join(sizes, "_b")


def _any_flag(cols: list[Column]) -> Column:
    out = cols[0]
    for c in cols[1:]:
        out = out | c
    return out


def _array_tuples(rows: DataFrame, k: int, flagged: bool) -> DataFrame:
    names = _tuple_cols(k)
    member = F.struct(F.col("_i").alias("i"), F.col("_f").alias("f")) if flagged else F.col("_i")
    baskets = (
        rows.groupBy("_b")
        .agg(F.array_sort(F.collect_set(member)).alias("_items"))
        .where(F.size("_items") >= F.lit(k))
    )
    if flagged:
        # a basket without a flagged member cannot contribute; skip it before expanding
        baskets = baskets.where(F.exists("_items", lambda m: m.getField("f")))
    t = expand_combinations(baskets, "_items", k, names)
    if not flagged:
        return t
    # keep combinations with at least one flagged member; unwrap the items
    return t.where(_any_flag([F.col(c).getField("f") for c in names])).select(
        *[F.col(c).getField("i").alias(c) for c in names]
    )


def _join_tuples(rows: DataFrame, k: int, flagged: bool, tasks: int = 0) -> DataFrame:
    d = _spread(rows.distinct(), tasks, "_b")
    flags = [F.col("_f").alias("_g")] if flagged else []
    t = d.select("_b", F.col("_i").alias("_c1"), *flags)
    for j in range(2, k + 1):
        nxt = d.select("_b", F.col("_i").alias(f"_c{j}"), *([F.col("_f").alias("_h")] if flagged else []))
        t = t.join(nxt, "_b").where(F.col(f"_c{j}") > F.col(f"_c{j - 1}"))
        if flagged:
            t = t.withColumn("_g", F.col("_g") | F.col("_h")).drop("_h")
    if flagged:
        t = t.where("_g")
    return t.select(*_tuple_cols(k))


def _extension_salts(n: str, m: int, block: int) -> Column:
    """ceil(C(n, m) * n / block**2), at least 1."""
    c = F.lit(1.0)
    for i in range(m):
        c = c * (F.col(n) - F.lit(i)) / F.lit(float(i + 1))
    return F.greatest(F.lit(1), F.ceil(c * F.col(n) / F.lit(float(block) ** 2))).cast("bigint")


def _blocked_tuples(heavy_rows: DataFrame, k: int, block: int, flagged: bool) -> DataFrame:
    """k-combinations of heavy baskets; ``heavy_rows`` is (_b, _i[, _f], _n), distinct."""
    s = F.greatest(F.lit(1), F.ceil(F.col("_n") / F.lit(block))).cast("bigint")
    fcol = [F.col("_f")] if flagged else []
    base = heavy_rows.select("_b", "_i", *fcol, "_n", s.alias("_s")).withColumn(
        "_k", F.pmod(F.xxhash64("_i"), F.col("_s"))
    )
    left = base.select(
        "_b",
        "_n",
        F.col("_i").alias("_x"),
        *([F.col("_f").alias("_fx")] if flagged else []),
        F.col("_k").alias("_ka"),
        F.explode(F.sequence(F.col("_k"), F.col("_s") - 1)).alias("_kb"),
    )
    right = base.select(
        "_b",
        F.col("_i").alias("_y"),
        *([F.col("_f").alias("_fy")] if flagged else []),
        F.col("_k").alias("_kb"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_k"))).alias("_ka"),
    )
    # each row meets about half of its basket's others
    n, met = heavy_rows.agg(F.count(F.lit(1)), F.sum(F.col("_n").cast("double"))).first()
    tasks = _tasks(heavy_rows, n, (met or 0.0) / 2)
    keys = ["_b", "_ka", "_kb"]
    t = (
        _spread(left, tasks, *keys)
        .join(_spread(right, tasks, *keys).hint("merge"), keys)
        .where((F.col("_ka") < F.col("_kb")) | (F.col("_x") < F.col("_y")))
        .select(
            "_b",
            "_n",
            F.least("_x", "_y").alias("_c1"),
            F.greatest("_x", "_y").alias("_c2"),
            *([(F.col("_fx") | F.col("_fy")).alias("_g")] if flagged else []),
        )
    )
    for j in range(3, k + 1):
        prefix = _tuple_cols(j - 1)
        # salts for this step: enough that one task sees about block**2
        # candidate extensions, i.e. ~C(n, j-1) * n / block**2 salts
        t = t.withColumn("_z", _extension_salts("_n", j - 1, block))
        t = t.withColumn("_t", F.pmod(F.xxhash64(*prefix), F.col("_z"))).drop("_z")
        items = base.select(
            "_b",
            F.col("_i").alias(f"_c{j}"),
            *([F.col("_f").alias("_h")] if flagged else []),
            F.explode(F.sequence(F.lit(0).cast("bigint"), _extension_salts("_n", j - 1, block) - 1)).alias("_t"),
        )
        t = (
            t.join(items.hint("merge"), ["_b", "_t"])
            .where(F.col(f"_c{j}") > F.col(f"_c{j - 1}"))
            .drop("_t")
        )
        if flagged:
            t = t.withColumn("_g", F.col("_g") | F.col("_h")).drop("_h")
    if flagged:
        t = t.where("_g")
    return t.select(*_tuple_cols(k))


def _auto_tuples(rows: DataFrame, k: int, threshold: int, block: int, flagged: bool) -> DataFrame:
    largest, n, most = _load(rows, k, threshold)
    tasks = _tasks(rows, n, most)
    if largest <= threshold:
        return _array_tuples(_spread(rows, tasks, "_b"), k, flagged)
    candidates = stored(candidate_baskets(rows, threshold), "candidate-baskets")
    crowded = stored(rows.join(candidates, "_b", "left_semi").distinct(), "candidate-rows")
    sized = _sized(crowded)
    few = sized.where(F.col("_n") <= F.lit(threshold)).drop("_n")
    many = sized.where(F.col("_n") > F.lit(threshold))
    light = rows.join(candidates, "_b", "left_anti").unionByName(few)
    return _array_tuples(_spread(light, tasks, "_b"), k, flagged).unionByName(_blocked_tuples(many, k, block, flagged))


def cooccurrence(
    df: DataFrame,
    k: int = 2,
    basket: str = "basket_id",
    item: str = "product_id",
    plan: str = "auto",
    heavy_threshold: int | None = None,
    block: int | None = None,
    strict: bool = True,
    only_flagged: str | None = None,
) -> DataFrame:
    """Count baskets per ascending k-combination of distinct items.

    Returns ``product_1 .. product_k`` (the item column's type) and
    ``baskets`` (bigint), unordered; see :func:`ranked` for the report order.
    Rows with a null basket or item are ignored (see ``clean.sales_rejects``).

    ``plan="auto"`` first looks for baskets that may be heavy; ``plan="array"``
    skips that and should only be used when baskets are known to be bounded.
    ``heavy_threshold`` defaults to the largest basket whose C(n, k)
    combinations fit :data:`COMBO_BUDGET`, ``block`` to half of that for k.

    ``only_flagged`` names a boolean column; then a combination is counted in
    a basket only if at least one of its rows there is flagged (a row's flag
    must be the same for every copy of that basket/item). With flagged = new
    rows this is the change in counts caused by the new rows.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    if plan not in PLANS:
        raise ValueError(f"plan must be one of {PLANS}")
    flagged = only_flagged is not None
    rows = _rows(df, basket, item, strict, only_flagged)
    names = _tuple_cols(k)

    if k == 1:
        d = rows.distinct()
        tuples = (d.where("_f") if flagged else d).select(F.col("_i").alias("_c1"))
    elif plan == "array":
        tuples = _array_tuples(rows, k, flagged)
    elif plan == "join":
        _, n, most = _load(rows, k, heavy_threshold_for(k))
        tuples = _join_tuples(rows, k, flagged, _tasks(rows, n, most))
    elif plan == "blocked":
        tuples = _blocked_tuples(_sized(stored(rows.distinct(), "distinct-rows")), k, block or block_for(k), flagged)
    else:
        threshold = heavy_threshold if heavy_threshold is not None else heavy_threshold_for(k)
        tuples = _auto_tuples(rows, k, threshold, block or block_for(k), flagged)

    counts = tuples.groupBy(*names).agg(F.count(F.lit(1)).alias("baskets"))
    return counts.select(
        *[unwrap_item(df, item, F.col(c)).alias(p) for c, p in zip(names, product_columns(k))],
        "baskets",
    )


def sized_cooccurrence(
    light: DataFrame,
    heavy: DataFrame | None,
    k: int,
    basket: str,
    item: str,
    size: str,
    plan: str = "array",
    strict: bool = True,
    block: int | None = None,
) -> DataFrame:
    """Counts as :func:`cooccurrence`, of distinct rows that carry their basket's size.

    ``light`` baskets go through ``plan`` ("array" or "join"), ``heavy`` ones (others than
    those, or None) through the blocked plan. Nothing is read to route them.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    if plan not in ("array", "join"):
        raise ValueError("plan must be array or join")
    rows = _rows(light, basket, item, strict, None)
    if k == 1:
        tuples = rows.select(F.col("_i").alias("_c1"))
    else:
        tuples = _array_tuples(rows, k, False) if plan == "array" else _join_tuples(rows, k, False)
    if heavy is not None:
        sized = heavy.select(F.col(basket).alias("_b"), sortable_item(heavy, item, strict).alias("_i"), F.col(size).alias("_n"))
        more = sized.select(F.col("_i").alias("_c1")) if k == 1 else _blocked_tuples(sized, k, block or block_for(k), False)
        tuples = tuples.unionByName(more)
    names = _tuple_cols(k)
    counts = tuples.groupBy(*names).agg(F.count(F.lit(1)).alias("baskets"))
    return counts.select(
        *[unwrap_item(light, item, F.col(c)).alias(p) for c, p in zip(names, product_columns(k))],
        "baskets",
    )


def item_support(df: DataFrame, basket: str = "basket_id", item: str = "product_id") -> DataFrame:
    """Baskets containing each item (k = 1): ``product_1, baskets``."""
    return cooccurrence(df, 1, basket, item)


def rank_order(k: int) -> list[Column]:
    """Report order: count descending, then each member's text ascending."""
    return [F.col("baskets").desc()] + [text_order(p).asc() for p in product_columns(k)]


def ranked(counts: DataFrame) -> DataFrame:
    """Total order of a count table (range-partitioned sort, spills)."""
    k = sum(1 for c in counts.columns if c.startswith("product_"))
    return counts.orderBy(*rank_order(k))


def top_n(counts: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` rows of :func:`ranked`; planned as a per-task top-n."""
    return ranked(counts).limit(n)


def basket_sizes(df: DataFrame, basket: str = "basket_id", item: str = "product_id") -> DataFrame:
    """Distinct items per basket: ``basket_id, basket_size``.

    ``count_distinct`` is planned as two aggregations with the first exchange
    keyed on (basket, item), so a hot basket is spread before it is counted.
    """
    return (
        df.where(F.col(basket).isNotNull() & F.col(item).isNotNull())
        .groupBy(basket)
        .agg(F.count_distinct(item).alias("basket_size"))
    )


def basket_size_histogram(
    df: DataFrame, basket: str = "basket_id", item: str = "product_id"
) -> DataFrame:
    """Number of baskets per distinct-item count: ``basket_size, baskets``."""
    return (
        basket_sizes(df, basket, item)
        .groupBy("basket_size")
        .agg(F.count(F.lit(1)).alias("baskets"))
    )
