"""Result checks: lookups, two-sided reconciliation, downward closure, run ratios."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cobasket.operators.cooccur import product_columns


def lookup_counts(
    expected: DataFrame, got: DataFrame, keys: Sequence[str], value: str = "baskets"
) -> DataFrame:
    """Every expected key with its count in ``got`` (0 when missing).

    ``keys..., expected, actual``; a one-sided check, like reading a result
    dictionary with a default.
    """
    keys = list(keys)
    g = got.select(*keys, F.col(value).alias("actual"))
    return expected.select(*keys, F.col(value).alias("expected")).join(g, keys, "left").select(
        *keys, "expected", F.coalesce(F.col("actual"), F.lit(0)).cast("bigint").alias("actual")
    )


def reconcile_detail(
    left: DataFrame, right: DataFrame, keys: Sequence[str], value: str = "baskets"
) -> DataFrame:
    """Full outer join on ``keys``: ``keys..., left_value, right_value, status``.

    ``status`` is ``match``, ``mismatch``, ``left_only`` or ``right_only``.
    Key comparison is NULL-safe.
    """
    keys = list(keys)
    lv = left.select(*keys, F.col(value).alias("left_value")).alias("_l")
    rv = right.select(*keys, F.col(value).alias("right_value")).alias("_r")
    cond = [F.col(f"_l.{k}").eqNullSafe(F.col(f"_r.{k}")) for k in keys]
    j = lv.join(rv, cond, "full_outer")
    in_l = F.col("_l.left_value").isNotNull()
    in_r = F.col("_r.right_value").isNotNull()
    status = (
        F.when(in_l & in_r & (F.col("left_value") == F.col("right_value")), "match")
        .when(in_l & in_r, "mismatch")
        .when(in_l, "left_only")
        .otherwise("right_only")
    )
    return j.select(
        *[F.coalesce(F.col(f"_l.{k}"), F.col(f"_r.{k}")).alias(k) for k in keys],
        "left_value",
        "right_value",
        status.alias("status"),
    )


def reconcile(
    left: DataFrame, right: DataFrame, keys: Sequence[str], value: str = "baskets"
) -> DataFrame:
    """One row: ``left_rows, right_rows, matched, mismatched, left_only, right_only``.

    Two-sided: extra keys on either side are counted, not only missing ones.
    """
    d = reconcile_detail(left, right, keys, value)
    return d.agg(
        F.count("left_value").alias("left_rows"),
        F.count("right_value").alias("right_rows"),
        F.count(F.when(F.col("status") == "match", True)).alias("matched"),
        F.count(F.when(F.col("status") == "mismatch", True)).alias("mismatched"),
        F.count(F.when(F.col("status") == "left_only", True)).alias("left_only"),
        F.count(F.when(F.col("status") == "right_only", True)).alias("right_only"),
    )


def closure_missing(upper: DataFrame, lower: DataFrame) -> DataFrame:
    """Downward-closure check between k-tuple and (k-1)-tuple counts.

    Every (k-1)-subset of a counted k-tuple must itself be counted, with at
    least as many baskets. Returns one row: ``tuples, subsets_checked,
    missing, undercounted``.
    """
    k = sum(1 for c in upper.columns if c.startswith("product_"))
    if k < 2:
        raise ValueError("upper must hold tuples of size >= 2")
    up = product_columns(k)
    low = product_columns(k - 1)
    # each tuple explodes into its k subsets, which meet their equals in each
    # task first: at most one row per (k-1)-tuple goes on to the join
    subsets = F.array(
        *[
            F.struct(*[F.col(up[i]).alias(low[j]) for j, i in enumerate(idx)])
            for idx in combinations(range(k), k - 1)
        ]
    )
    sub = upper.select(F.explode(subsets).alias("_s"), F.col("baskets").alias("_ub")).select(
        *[F.col("_s").getField(c).alias(c) for c in low], "_ub"
    )
    # subsets of one (k-1)-tuple by their count: how many lie above the lower
    # count is then one array pass, in the few distinct counts it has
    per = sub.groupBy(*low, "_ub").agg(F.count(F.lit(1)).alias("_n"))
    per = per.groupBy(*low).agg(F.sum("_n").alias("_n"), F.collect_list(F.struct("_ub", "_n")).alias("_by"))
    checked = per.join(lower.select(*low, F.col("baskets").alias("_lb")), low, "left")
    above = F.aggregate(
        F.filter("_by", lambda x: x["_ub"] > F.col("_lb")), F.lit(0).cast("bigint"), lambda a, x: a + x["_n"]
    )
    zero = F.lit(0).cast("bigint")
    # every tuple contributes exactly k subsets, so one aggregation gives all
    return checked.agg(
        (F.coalesce(F.sum("_n"), zero) / F.lit(k)).cast("bigint").alias("tuples"),
        F.coalesce(F.sum("_n"), zero).alias("subsets_checked"),
        F.coalesce(F.sum(F.when(F.col("_lb").isNull(), F.col("_n"))), zero).alias("missing"),
        F.coalesce(F.sum(F.when(F.col("_lb").isNotNull(), above)), zero).alias("undercounted"),
    )


def rows_per_period(df: DataFrame, ts: str, unit: str = "month") -> DataFrame:
    """``period, rows``: row counts per calendar period of a timestamp column.

    Partial aggregation; the output has one row per period, so it stays
    small however large the input is.
    """
    return (
        df.where(F.col(ts).isNotNull())
        .groupBy(F.date_trunc(unit, F.col(ts)).alias("period"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def run_ratio(metrics: DataFrame, order: str, value: str, digits: int = 6) -> DataFrame:
    """Each run's value over the previous run's (NULL for the first run or a
    zero predecessor): ``order, value, previous, ratio``.

    A global window, so ``metrics`` must be a small table (one row per run
    or per period), never raw data.
    """
    w = Window.orderBy(order)
    prev = F.lag(value).over(w)
    return metrics.select(
        order,
        value,
        prev.alias("previous"),
        F.round(F.when(prev > 0, F.col(value) / prev), digits).alias("ratio"),
    )


def multiset_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: ``left_extra, right_extra``: rows (with multiplicity) found in
    one frame more often than in the other; both 0 means equal multisets.

    One aggregation over the tagged union (no join); columns are matched by
    name and NULLs compare equal.
    """
    cols = left.columns
    tagged = left.select(*cols, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(*cols, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    per_row = tagged.groupBy(*cols).agg(F.sum("_l").alias("_nl"), F.sum("_r").alias("_nr"))
    return per_row.agg(
        F.coalesce(F.sum(F.greatest(F.col("_nl") - F.col("_nr"), F.lit(0))), F.lit(0))
        .cast("bigint")
        .alias("left_extra"),
        F.coalesce(F.sum(F.greatest(F.col("_nr") - F.col("_nl"), F.lit(0))), F.lit(0))
        .cast("bigint")
        .alias("right_extra"),
    )


def skew_report(counts: DataFrame, reference: DataFrame) -> DataFrame:
    """One row for a skew check: the dominant pair, how many pairs were
    counted, and how many differ from ``reference`` (two-sided).

    ``dominant_1, dominant_2, dominant_baskets, pairs, mismatches``; the
    dominant pair is the one with the most baskets (of equals, the largest ids).
    """
    d = reconcile_detail(counts, reference, product_columns(2))
    top = F.max(F.when(F.col("left_value").isNotNull(), F.struct("left_value", "product_1", "product_2")))
    return d.agg(
        top.alias("_top"),
        F.count("left_value").alias("pairs"),
        F.count(F.when(F.col("status") != "match", True)).alias("mismatches"),
    ).select(
        F.col("_top.product_1").alias("dominant_1"),
        F.col("_top.product_2").alias("dominant_2"),
        F.col("_top.left_value").alias("dominant_baskets"),
        "pairs",
        "mismatches",
    )
