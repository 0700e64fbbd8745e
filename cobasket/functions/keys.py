"""Column expressions for keys: whitespace stripping, item order, stable shard ids.

All of these are built-in Spark expressions, so they stay inside whole-stage
codegen; nothing here calls Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

# The characters Python's ``str.strip()`` removes (those for
# which ``str.isspace()`` is true), in code point order. ``trim`` alone strips
# only the ASCII space, and Java's Unicode ``\s`` misses U+001C..U+001F.
WHITESPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u001c\u001d\u001e\u001f\u0020\u0085\u00a0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


#: An integer of any length; group 1 has its digits without leading zeros.
_INTEGER = r"^\s*[+-]?0*([0-9]+)\s*$"


def strip_space(col: Column | str) -> Column:
    """Remove leading and trailing white space (as ``str.strip()`` does).

    ``btrim`` with an explicit character set: no regular expression per row.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.btrim(c, F.lit(WHITESPACE))


def column_type(df: DataFrame, name: str) -> DataType:
    return df.schema[name].dataType


def sortable_item(df: DataFrame, item: str, strict: bool = True) -> Column:
    """An expression that orders items the way tuples are written.

    Integer ids compare as numbers directly. String ids compare by their
    integer value first, of any number of digits, and by the text second, so
    ``"2" < "10"`` and ``"01" < "1"``. Values beyond 64 bits compare by sign,
    number of digits and digits (for negative ones all reversed). With
    ``strict`` a non-integer text fails the job; otherwise it sorts after all
    integers.
    """
    if not isinstance(column_type(df, item), StringType):
        return F.col(item)
    text = F.col(item)
    num = text.try_cast("bigint")
    long = num.isNull() & text.rlike(_INTEGER)
    minus = text.rlike(r"^\s*-")
    digits = F.regexp_extract(text, _INTEGER, 1)
    size = F.char_length(digits)
    other = F.raise_error(F.concat(F.lit("not an integer: "), text)).cast("int") if strict else F.lit(2)
    kind = F.when(num.isNotNull() | text.isNull(), 0).when(long & minus, -1).when(long, 1).otherwise(other)
    length = F.when(long, F.when(minus, -size).otherwise(size))
    order = F.when(long, F.when(minus, F.translate(digits, "0123456789", "9876543210")).otherwise(digits))
    return F.struct(kind.alias("o0"), num.alias("o1"), length.alias("o2"), order.alias("o3"), text.alias("v"))


def unwrap_item(df: DataFrame, item: str, col: Column) -> Column:
    """Inverse of :func:`sortable_item`: recover the original value."""
    if isinstance(column_type(df, item), StringType):
        return col.getField("v")
    return col


def text_order(col: Column | str) -> Column:
    """Tie-break order used in ranked output: the text of the value."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("string")


def md5_shard(col: Column | str, num_shards: int) -> Column:
    """Shard id equal to ``int(md5(str(key)), 16) % num_shards``.

    The 128-bit digest is folded 32 bits at a time with ``pmod``, so every
    intermediate stays below 2**63 as long as ``num_shards < 2**31``.
    """
    if not 1 <= num_shards < 2**31:
        raise ValueError("num_shards must be in [1, 2**31)")
    c = F.col(col) if isinstance(col, str) else col
    digest = F.md5(c.cast("string"))
    acc = F.lit(0).cast("bigint")
    for i in range(4):
        chunk = F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint")
        acc = F.pmod(acc * F.lit(2**32) + chunk, F.lit(num_shards))
    return acc.cast("int")


def hash_fraction(*cols: Column | str) -> Column:
    """A stable pseudo-random number in [0, 1) from the md5 of the values.

    Reproducible in any engine that has md5 (the oracle uses DuckDB): the
    first 32 bits of ``md5(c1 || '|' || c2 ...)`` divided by 2**32.
    """
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    text = F.concat_ws("|", *[p.cast("string") for p in parts])
    head = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return head / F.lit(float(2**32))
