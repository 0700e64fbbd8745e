"""Incremental co-occurrence counts: merge partial counts, add a batch's delta.

For additions only: when new rows ``N`` arrive in a table whose rows are
``O``, only baskets touched by ``N`` can change. For those baskets the new
count of a tuple is its count over ``O ∪ N`` and the old count its count
over ``O`` alone, so

    delta = cooc(O_t ∪ N) - cooc(O_t),   O_t = rows of O in touched baskets

and ``stored + delta`` equals a full recompute. Both terms come from one
pass: with the rows of ``N`` flagged, the difference is the number of
touched baskets in which a tuple has at least one flagged member. The pass
is the skew-safe :func:`cobasket.operators.cooccur.cooccurrence`, so a
touched basket with millions of old rows is still split, never collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cobasket.operators.cooccur import cooccurrence, product_columns, row_tasks
from cobasket.operators.dedup import new_rows
from cobasket.sources.sales import BASKET, PRODUCT


def merge_counts(*counts: DataFrame) -> DataFrame:
    """Sum ``baskets`` per tuple over several count tables (partial results)."""
    if not counts:
        raise ValueError("need at least one count table")
    k = sum(1 for c in counts[0].columns if c.startswith("product_"))
    keys = product_columns(k)
    u = counts[0].select(*keys, "baskets")
    for c in counts[1:]:
        u = u.unionByName(c.select(*keys, "baskets"))
    # dealt in another order of keys than the counts are, or Spark would count all parts and add them up in one task
    return (
        u.repartition(*reversed(keys))
        .groupBy(*keys)
        .agg(F.sum("baskets").cast("bigint").alias("baskets"))
        .where(F.col("baskets") != 0)
    )


def count_delta(
    new: DataFrame,
    old: DataFrame,
    k: int = 2,
    basket: str = BASKET,
    item: str = PRODUCT,
    new_is_small: bool = False,
    disjoint: bool = False,
    **cooc_options,
) -> DataFrame:
    """Change in tuple counts when ``new`` rows are added to ``old`` rows.

    ``new`` may overlap ``old``; rows already present change nothing.
    Returns ``product_1..product_k, baskets`` with nonzero deltas only.

    One co-occurrence pass over the touched baskets, with the added rows
    flagged: a tuple gains one basket exactly where it now has at least one
    added member (it could not have been complete there before).
    ``new_is_small`` (checked by the caller) broadcasts the added rows'
    baskets instead of shuffling ``old`` to find the touched baskets.
    ``disjoint``: the caller guarantees ``new`` is distinct and shares no
    row with ``old`` (e.g. the output of ``new_rows``), so that step is skipped;
    otherwise a small job counts the rows, which that step's tasks follow.
    """
    keys = [basket, item]
    if disjoint:
        added = new.select(*keys)
    else:
        tasks = 0 if new_is_small else row_tasks(new.select(basket).unionByName(old.select(basket)), basket)
        added = new_rows(new.select(*keys), old.select(*keys), keys, incoming_is_small=new_is_small, tasks=tasks)
    # Baskets of the new rows: a superset of the baskets that gained a row,
    # taken from ``new`` so that ``added`` is not planned twice; baskets
    # whose rows all existed contribute no flagged tuple.
    touched = new.select(basket).distinct()
    if new_is_small:
        touched = F.broadcast(touched)
    old_t = old.select(*keys).join(touched, basket, "left_semi")
    combined = old_t.withColumn("_new", F.lit(False)).unionByName(
        added.withColumn("_new", F.lit(True))
    )
    return cooccurrence(combined, k, basket, item, only_flagged="_new", **cooc_options)


def update_counts(
    stored: DataFrame,
    new: DataFrame,
    old: DataFrame,
    k: int = 2,
    basket: str = BASKET,
    item: str = PRODUCT,
    **cooc_options,
) -> DataFrame:
    """``stored`` counts (over ``old``) brought up to date with ``new`` rows."""
    return merge_counts(stored, count_delta(new, old, k, basket, item, **cooc_options))
