"""Normalization and rejection of raw sales rows.

Rules (applied once, before any bucketing or grouping, so the same basket
never splits on spelling):

* both keys lose leading and trailing Unicode white space (tab and NBSP too);
* a row whose basket or product is NULL or empty after stripping is rejected
  (this covers one-field rows and empty fields);
* with ``numeric_products`` a product that is not an integer is rejected
  (lenient) or fails the job (strict, the ANSI cast), matching the
  reference's failure on ``int()``.

Rejected rows are never dropped silently: :func:`sales_rejects` reports them
with a reason, from the same expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from cobasket.functions.keys import strip_space
from cobasket.sources.sales import BASKET, PRODUCT


def _norm(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, StringType):
        return strip_space(name)
    return F.col(name)


def _blank(c: Column) -> Column:
    return c.isNull() | (c.cast("string") == F.lit(""))


def reject_reason(df: DataFrame, basket: str = BASKET, product: str = PRODUCT, numeric_products: bool = False) -> Column:
    """Why a row is rejected, or NULL if it is not."""
    b, p = _norm(df, basket), _norm(df, product)
    reason = F.when(_blank(b), F.lit("empty_basket")).when(_blank(p), F.lit("missing_product"))
    if numeric_products and isinstance(df.schema[product].dataType, StringType):
        reason = reason.when(~p.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.lit("non_integer_product"))

    return reason


def clean_sales(
    df: DataFrame,
    basket: str = BASKET,
    product: str = PRODUCT,
    numeric_products: bool = False,
) -> DataFrame:
    """Stripped ``basket_id, product_id`` rows that pass the rules above.

    Columns beyond the two keys are dropped (positional two-column model).
    """
    reason = reject_reason(df, basket, product, numeric_products)
    return df.where(reason.isNull()).select(
        _norm(df, basket).alias(BASKET), _norm(df, product).alias(PRODUCT)
    )


def sales_rejects(
    df: DataFrame,
    basket: str = BASKET,
    product: str = PRODUCT,
    numeric_products: bool = False,
) -> DataFrame:
    """Rejected row counts by reason: ``reason, rows``."""
    return (
        df.select(reject_reason(df, basket, product, numeric_products).alias("reason"))
        .where(F.col("reason").isNotNull())
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
