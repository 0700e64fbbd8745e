"""Writers: shard datasets, ranked count files, re-encoding, preview."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from cobasket.functions.keys import md5_shard, strip_space
from cobasket.operators.bucket import SHARD
from cobasket.operators.cooccur import product_columns, ranked, top_n
from cobasket.operators.dedup import inject_by_occurrence
from cobasket.sources.sales import BASKET, read_sales_csv

FILES_PER_SHARD = 4


def write_shards(
    df: DataFrame,
    out_dir: str,
    num_shards: int,
    basket: str = BASKET,
    files_per_shard: int = FILES_PER_SHARD,
    compression: str = "gzip",
    mode: str = "overwrite",
) -> None:
    """Write sales rows as a shard dataset: ``out_dir/shard=<i>/part-*.csv.gz``.

    Every basket lands in exactly one shard directory: the stable md5 shard id
    of its text without white space at the ends (values are written as they
    are). Inside a shard, rows go to ``files_per_shard`` files by a hash of the
    row and of its position in the input, so that neither a basket nor a single
    row repeated for a third of the input ends in one task. ``overwrite``
    replaces the dataset as a whole, so files of an earlier run with more
    shards cannot linger and be read twice. Shards with no rows get no
    directory; ``shard_balance`` reports them.
    """
    key = strip_space(basket) if isinstance(df.schema[basket].dataType, StringType) else F.col(basket)
    position = F.monotonically_increasing_id()
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns], position), F.lit(files_per_shard))
    assigned = df.select(*df.columns, md5_shard(key, num_shards).alias(SHARD), spread.cast("int").alias("_file"))
    # one task for each file
    task = F.col(SHARD) * files_per_shard + F.col("_file")
    placed = assigned.repartitionById(num_shards * files_per_shard, task).drop("_file")
    _csv_writer(placed.write.mode(mode).partitionBy(SHARD), compression).csv(out_dir)


def _csv_writer(writer: DataFrameWriter, compression: str) -> DataFrameWriter:
    """Values as they are: Spark's CSV writer trims white space unless told not to."""
    return (
        writer.option("compression", compression)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )


def write_counts_csv(
    counts: DataFrame,
    out_dir: str,
    single_file: bool = False,
    compression: str = "gzip",
    line_sep: str | None = None,
) -> None:
    """Ranked counts as CSV with header ``product_1..product_k,baskets``.

    The sort is a range-partitioned total order, so part files concatenate
    in rank order. ``single_file`` funnels the result through one task; use
    it only for small exports. ``line_sep="\\r\\n"`` reproduces Python's
    ``csv`` line ending.
    """
    out = ranked(counts)
    if single_file:
        out = out.coalesce(1)
    w = _csv_writer(out.write.mode("overwrite").option("header", True), compression)
    if line_sep:
        w = w.option("lineSep", line_sep)
    w.csv(out_dir)


def read_counts_csv(spark: SparkSession, path: str | list[str], k: int, id_type: str = "string") -> DataFrame:
    """Read a count export back: ids as text, or as ``id_type`` where that is known; counts as bigint."""
    columns = ", ".join([*(f"product_{i} {id_type}" for i in range(1, k + 1)), "baskets bigint"])
    return spark.read.schema(columns).option("header", True).option("escape", '"').option("mode", "FAILFAST").csv(path)


def preview(spark: SparkSession, path: str, k: int, n: int = 10, id_type: str = "string") -> DataFrame:
    """Top ``n`` rows of an exported count file, in report order (a top-n of each task, then one merge)."""
    return top_n(read_counts_csv(spark, path, k, id_type), n)


def head(spark: SparkSession, path: str, k: int, n: int = 10, id_type: str = "string") -> DataFrame:
    """The first ``n`` rows of an exported count file as they stand there, in file order.

    Files are taken by name, one after the other until they hold ``n`` rows: usually the first
    alone, and no other is opened. Within a file, rows stand by split and place.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path")
    # a part file holds a row at least, but for the first of an empty export
    names = [r.path for r in files.orderBy("path").limit(n + 1).collect()]
    taken = 1
    while taken < len(names) and read_counts_csv(spark, names[:taken], k, id_type).limit(n).count() < n:
        taken += 1
    rows = read_counts_csv(spark, names[:taken] or path, k, id_type)
    place = ["_metadata.file_name", "_metadata.file_block_start", F.monotonically_increasing_id().alias("at")]
    placed = rows.select(F.struct(*rows.columns).alias("row"), *place)
    return placed.orderBy("file_name", "file_block_start", "at").limit(n).select("row.*")


def order_check(spark: SparkSession, path: str, k: int, id_type: str = "string") -> DataFrame:
    """One row: the rows of a count export, and how many stand before a row of higher rank.

    Rows are compared with the one before them in their file's split, and each
    split's first row with the last of the split before; splits follow on each other
    by file name and place. Only splits, one row each, meet in one window.
    """
    rows = read_counts_csv(spark, path, k, id_type)
    rank = F.struct((-F.col("baskets")).alias("n"), *[F.col(c).cast("string").alias(c) for c in product_columns(k)])
    # within a split, rows are numbered in the order they are read
    placed = rows.select(rank.alias("rank"), "_metadata.file_name", "_metadata.file_block_start", F.monotonically_increasing_id().alias("at"))
    split = Window.partitionBy("file_name", "file_block_start").orderBy("at")
    wrong = placed.withColumn("wrong", (F.lag("rank").over(split) > F.col("rank")).cast("int"))
    splits = wrong.groupBy("file_name", "file_block_start").agg(
        F.sum("wrong").alias("inside"), F.min_by("rank", "at").alias("head"), F.max_by("rank", "at").alias("tail"), F.count(F.lit(1)).alias("n")
    )
    before = F.lag("tail").over(Window.orderBy("file_name", "file_block_start"))
    ends = splits.withColumn("outside", (before > F.col("head")).cast("int"))
    zero = F.lit(0).cast("bigint")
    return ends.agg(
        F.coalesce(F.sum("n"), zero).alias("rows"),
        (F.coalesce(F.sum("inside"), zero) + F.coalesce(F.sum("outside"), zero)).alias("violations"),
    )


def reencode_csv(spark: SparkSession, src: str, dst: str, compression: str = "none") -> None:
    """Rewrite a CSV dataset with another codec (e.g. gzip to plain text).

    Lines are copied as they are, so all columns, quotes and white space stay.
    """
    lines = spark.read.option("lineSep", "\n").text(src)
    lines.write.mode("overwrite").option("compression", compression).option("lineSep", "\n").text(dst)


def write_with_dups(spark: SparkSession, inputs: Sequence[str], out_dir: str, ratio: float = 0.15, seed: int = 42) -> list[str]:
    """For each sales CSV, a gzip CSV with drawn rows repeated, in scrambled order: ``out_dir/<base>_with_dups``."""
    written = []
    for path in inputs:
        base = path.rstrip("/").rsplit("/", 1)[-1].removesuffix(".gz").removesuffix(".csv")
        out = f"{out_dir.rstrip('/')}/{base}_with_dups"
        injected = inject_by_occurrence(read_sales_csv(spark, path), ratio, seed, scramble=True)
        _csv_writer(injected.write.mode("overwrite"), "gzip").csv(out)
        written.append(out)
    return written
