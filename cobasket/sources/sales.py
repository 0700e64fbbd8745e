"""Readers for sales rows, shard datasets, Parquet tables and file listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

BASKET = "basket_id"
PRODUCT = "product_id"

# Sales rows as written by the data generator: two text columns, no header.
SALES_SCHEMA = StructType(
    [StructField(BASKET, StringType(), True), StructField(PRODUCT, StringType(), True)]
)
CORRUPT = "_corrupt_record"


def _as_list(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def read_sales_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    header: bool = False,
    multiline: bool = False,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Headerless ``basket_id,product_id`` CSV, plain or gzip (by extension).

    Positional: the first two fields are used and any further fields are
    dropped; a row with one field gets a NULL product (PERMISSIVE mode never
    drops rows, unlike DROPMALFORMED which would also drop rows with extra
    fields). Doubled quotes are unescaped. ``multiline`` allows quoted line
    breaks but makes each file a single task. A gzip file is one task as
    well, so many-file inputs are preferable to one large ``.gz``.
    """
    schema = SALES_SCHEMA
    if keep_corrupt:
        schema = StructType(schema.fields + [StructField(CORRUPT, StringType(), True)])
    reader = (
        spark.read.schema(schema)
        .option("header", header)
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("mode", "PERMISSIVE")
    )
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.csv(_as_list(paths))


def read_shards(spark: SparkSession, shard_dir: str) -> DataFrame:
    """A shard dataset written by ``plans.export.write_shards``.

    Layout ``shard_dir/shard=<i>/part-*.csv.gz``; the ``shard`` column is
    restored from the directory names. A missing directory raises, as an
    empty shard set is an error rather than an empty result.
    """
    schema = StructType(SALES_SCHEMA.fields + [StructField("shard", IntegerType(), True)])
    return (
        spark.read.schema(schema)
        .option("header", False)
        .option("escape", '"')
        .option("basePath", shard_dir)
        .csv(f"{shard_dir.rstrip('/')}/shard=*")
    )


def read_shard_files(spark: SparkSession, shard_dir: str) -> DataFrame:
    """A folder of one CSV per shard, ``shard_<i>.csv`` or ``.csv.gz``.

    The ``shard`` column comes from the file's name.
    """
    rows = (
        spark.read.schema(SALES_SCHEMA)
        .option("header", False)
        .option("escape", '"')
        .csv([f"{shard_dir.rstrip('/')}/shard_[0-9]*.csv*"])
    )
    number = F.regexp_extract("_metadata.file_path", r"shard_(\d+)\.csv", 1)
    return rows.select(BASKET, PRODUCT, number.cast("int").alias("shard"))


def read_table_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Parquet table at ``path`` with ``schema``, or an empty frame if absent.

    The read itself resolves the path (one listing, any filesystem scheme);
    ``PATH_NOT_FOUND`` means the table does not exist yet.
    """
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
    return spark.createDataFrame([], schema)


def list_files(spark: SparkSession, directory: str, suffix_regex: str = r"\.csv(\.gz)?$") -> DataFrame:
    """Non-recursive listing: ``path, modificationTime, length``.

    Uses the ``binaryFile`` source with the content column pruned away, so
    only file metadata is read. A flat folder is listed by the driver.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", False)
        .load(directory)
        .select("path", "modificationTime", "length")
        .where(F.col("path").rlike(suffix_regex))
    )


def sales_from_table(
    df: DataFrame, basket: str, product: str
) -> DataFrame:
    """Project any table to the sales shape ``basket_id, product_id``."""
    return df.select(F.col(basket).alias(BASKET), F.col(product).alias(PRODUCT))


def read_table_evolving(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table whose files carry different column sets over time.

    Schemas of all files are merged (``mergeSchema``); rows from files
    without a column read it as NULL.
    """
    return spark.read.option("mergeSchema", True).parquet(path)
