"""

Every query reads the driver tables (``lineitem`` and ``orders``) in full.
Sales rows are ``lineitem`` with ``l_orderkey`` as the basket and
``l_suppkey`` as the product (dense pairs); one variant uses ``l_partkey``
(sparse pairs). The "existing" part of a table is ``l_linenumber <= 4`` and
the "incoming" part ``l_linenumber >= 3`` (they overlap on purpose).

Queries that write (exports, ingest, streams) write under the session's
shared checkpoint folder and return a DataFrame over what they wrote.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from math import ceil

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from cobasket.operators import bucket, clean, cooccur, dedup, incremental, quality  # noqa: E402
from cobasket.plans import basket_table, export, ingest  # noqa: E402
from cobasket.session import scratch_path, stored  # noqa: E402
from cobasket.sources import sales as src  # noqa: E402
from cobasket.sources import synth  # noqa: E402
from cobasket.streaming import ingest_stream, keyed_ingest, pair_counts  # noqa: E402

NUM_SHARDS = 16
DUP_RATIO = 0.15
DUP_SEED = 42
SYNTH_SEED = 7


# ── inputs ──────────────────────────────────────────────────────────────────

def _lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


def _sales(spark: SparkSession, sf_dir: str, product: str = "l_suppkey") -> DataFrame:
    return src.sales_from_table(_lineitem(spark, sf_dir), "l_orderkey", product)


def _existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _lineitem(spark, sf_dir).where(F.col("l_linenumber") <= 4)
    return src.sales_from_table(li, "l_orderkey", "l_suppkey")


def _incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _lineitem(spark, sf_dir).where(F.col("l_linenumber") >= 3)
    return src.sales_from_table(li, "l_orderkey", "l_suppkey")


def _pairs(spark: SparkSession, sf_dir: str, plan: str = "auto") -> DataFrame:
    return cooccur.cooccurrence(_sales(spark, sf_dir), 2, plan=plan)


# ── queries ─────────────────────────────────────────────────────────────────

def q_sales_projection(spark, sf_dir):
    return _sales(spark, sf_dir)


def q_item_support(spark, sf_dir):
    return cooccur.item_support(_sales(spark, sf_dir))


def q_pair_cooccurrence(spark, sf_dir):
    return _pairs(spark, sf_dir)


def q_pair_cooccurrence_join(spark, sf_dir):
    return _pairs(spark, sf_dir, plan="join")


def q_pair_cooccurrence_blocked(spark, sf_dir):
    return _pairs(spark, sf_dir, plan="blocked")


def q_pair_cooccurrence_partkey(spark, sf_dir):
    return cooccur.cooccurrence(_sales(spark, sf_dir, "l_partkey"), 2)


def _crowded(spark: SparkSession, sf_dir: str, products: int) -> DataFrame:
    """Sales of ``products`` products, and one basket (-1) that holds every row again: half of all rows."""
    product = F.pmod(F.col("l_partkey") * 7 + F.col("l_suppkey") * 13, F.lit(products))
    li = _lineitem(spark, sf_dir)
    own = li.select(F.col("l_orderkey").alias("basket_id"), product.alias("product_id"))
    return own.unionByName(li.select(F.lit(-1).cast("bigint").alias("basket_id"), product.alias("product_id")))


def _by_count(counts: DataFrame, k: int) -> DataFrame:
    """How many tuples have each count, and sums of their products."""
    sums = [F.sum(c).alias(f"sum_{c}") for c in cooccur.product_columns(k)]
    return counts.groupBy("baskets").agg(F.count(F.lit(1)).alias("tuples"), *sums)


HEAVY_PAIR_PRODUCTS, HEAVY_TRIPLE_PRODUCTS = 2600, 300


def q_heavy_pairs(spark, sf_dir):
    """Pair counts where one basket of half of all rows goes through several blocks."""
    return _by_count(cooccur.cooccurrence(_crowded(spark, sf_dir, HEAVY_PAIR_PRODUCTS), 2), 2)


def q_heavy_triples(spark, sf_dir):
    """Triple counts where one basket of half of all rows goes through several blocks."""
    return _by_count(cooccur.cooccurrence(_crowded(spark, sf_dir, HEAVY_TRIPLE_PRODUCTS), 3), 3)


def _stored_baskets(sales: DataFrame) -> basket_table.BasketTable:
    return basket_table.write_baskets(sales, scratch_path(sales.sparkSession, "baskets"))


def q_stored_item_support(spark, sf_dir):
    return _stored_baskets(_sales(spark, sf_dir)).cooccurrence(1)


def q_stored_pairs(spark, sf_dir):
    """Pair counts of a table bucketed by basket: no exchange by basket."""
    return _stored_baskets(_sales(spark, sf_dir)).cooccurrence(2)


def q_stored_heavy_triples(spark, sf_dir):
    """Triples of a stored table, written by one session's catalog entry and opened by another, with one very large basket."""
    written = _stored_baskets(_crowded(spark, sf_dir, HEAVY_TRIPLE_PRODUCTS))
    return _by_count(basket_table.open_baskets(spark, written.path).cooccurrence(3), 3)


def q_stored_heavy_pairs(spark, sf_dir):
    """Pairs of a stored table whose largest basket lies outside of the buckets."""
    return _by_count(_stored_baskets(_crowded(spark, sf_dir, HEAVY_PAIR_PRODUCTS)).cooccurrence(2), 2)


def q_stored_reconciliation(spark, sf_dir):
    """Array against join counts, both from one bucketed table."""
    table = _stored_baskets(_sales(spark, sf_dir))
    return quality.reconcile(table.cooccurrence(2), table.cooccurrence(2, plan="join"), cooccur.product_columns(2))


def q_stored_size_histogram(spark, sf_dir):
    sizes = _stored_baskets(_sales(spark, sf_dir)).sizes()
    return sizes.groupBy("basket_size").agg(F.count(F.lit(1)).alias("baskets"))


def q_triple_cooccurrence(spark, sf_dir):
    return cooccur.cooccurrence(_sales(spark, sf_dir), 3)


def q_quad_cooccurrence(spark, sf_dir):
    return cooccur.cooccurrence(_sales(spark, sf_dir), 4)


def q_top_pairs(spark, sf_dir):
    return cooccur.top_n(_pairs(spark, sf_dir), 10)


def q_top_triples(spark, sf_dir):
    return cooccur.top_n(cooccur.cooccurrence(_sales(spark, sf_dir), 3), 10)


def q_basket_size_histogram(spark, sf_dir):
    return cooccur.basket_size_histogram(_sales(spark, sf_dir))


def q_shard_assignment(spark, sf_dir):
    return bucket.assign_shards(_sales(spark, sf_dir), NUM_SHARDS)


def q_shard_balance(spark, sf_dir):
    return bucket.shard_balance(bucket.assign_shards(_sales(spark, sf_dir), NUM_SHARDS), NUM_SHARDS)


def q_shard_summary(spark, sf_dir):
    return bucket.shard_summary(bucket.assign_shards(_sales(spark, sf_dir), NUM_SHARDS), NUM_SHARDS)


def q_shard_roundtrip(spark, sf_dir):
    """Write the sales rows as a gzip shard dataset, read it back, check it."""
    out = scratch_path(spark, "shards")
    export.write_shards(_sales(spark, sf_dir), out, NUM_SHARDS, files_per_shard=2)
    return bucket.shard_integrity(src.read_shards(spark, out))


def q_shard_pairs(spark, sf_dir):
    """Pair counts from the written shard dataset (text ids, numeric order)."""
    out = scratch_path(spark, "shards")
    export.write_shards(_sales(spark, sf_dir), out, NUM_SHARDS)
    counts = cooccur.cooccurrence(src.read_shards(spark, out), 2)
    return counts.select(
        F.col("product_1").cast("bigint").alias("product_1"),
        F.col("product_2").cast("bigint").alias("product_2"),
        "baskets",
    )


def q_shard_file_pairs(spark, sf_dir):
    """Pair counts from a folder of one text file per shard, named shard_<i>.csv."""
    out = scratch_path(spark, "shard-files")
    shard = bucket.assign_shards(_sales(spark, sf_dir), 4)
    for i in range(4):
        lines = shard.where(F.col("shard") == i).select(F.concat_ws(",", "basket_id", "product_id"))
        lines.write.text(f"{out}/shard_{i:04d}.csv")
    rows = src.read_shard_files(spark, out)
    wrong = F.col("shard") != bucket.md5_shard("basket_id", 4)
    rows = rows.select("product_id", F.when(wrong, F.lit(None)).otherwise(F.col("basket_id")).alias("basket_id"))
    counts = cooccur.cooccurrence(rows, 2)
    return counts.select(F.col("product_1").cast("bigint").alias("product_1"), F.col("product_2").cast("bigint").alias("product_2"), "baskets")


def q_csv_clean_pairs(spark, sf_dir):
    """Lines with padded keys on disk, read back, cleaned, counted."""
    out = scratch_path(spark, "sales-csv")
    li = _lineitem(spark, sf_dir)
    order, supp = F.col("l_orderkey").cast("string"), F.col("l_suppkey").cast("string")
    basket = F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit(" "), order, F.lit("\t"))).otherwise(order)
    product = F.when(F.col("l_linenumber") % 3 == 0, F.concat(F.lit(" "), supp)).otherwise(supp)
    # written as text: a CSV writer might trim
    li.select(F.concat_ws(",", basket, product)).write.option("compression", "gzip").text(out)
    cleaned = clean.clean_sales(src.read_sales_csv(spark, out), numeric_products=True)
    return cooccur.cooccurrence(cleaned, 2)


def q_sales_rejects(spark, sf_dir):
    """Reject report over dirty lines: blank baskets, empty products, lines of one field, and non-integer products."""
    out = scratch_path(spark, "dirty-csv")
    li = _lineitem(spark, sf_dir)
    ln, sk, pk = F.col("l_linenumber"), F.col("l_suppkey"), F.col("l_partkey")
    basket = F.when((ln == 6) & (sk % 10 == 0), F.lit(" \t")).otherwise(F.col("l_orderkey").cast("string"))
    product = (
        F.when((ln == 7) & (sk % 2 == 0), F.lit(" "))
        .when((ln == 5) & (pk % 10 == 0), F.concat(F.lit("x"), sk.cast("string")))
        .when(ln != 7, sk.cast("string"))
    )
    # concat_ws leaves out a null product and its comma: a line of one field
    li.select(F.concat_ws(",", basket, product)).write.option("compression", "gzip").text(out)
    return clean.sales_rejects(src.read_sales_csv(spark, out), numeric_products=True)


def q_dedup_union(spark, sf_dir):
    return dedup.union_dedup(_existing(spark, sf_dir), _incoming(spark, sf_dir))


def q_ingest_new_rows(spark, sf_dir):
    return dedup.new_rows(_incoming(spark, sf_dir), _existing(spark, sf_dir))


def q_duplicate_rate(spark, sf_dir):
    return dedup.duplicate_stats(_sales(spark, sf_dir))


def _injected(spark, sf_dir):
    li = _lineitem(spark, sf_dir).select(
        F.col("l_orderkey").alias("basket_id"), F.col("l_suppkey").alias("product_id"), "l_linenumber"
    )
    return dedup.inject_duplicates(
        li, DUP_RATIO, DUP_SEED, id_cols=["basket_id", "l_linenumber"]
    ).drop("l_linenumber")


def q_duplicate_injection(spark, sf_dir):
    return _injected(spark, sf_dir)


def q_duplicate_injection_file(spark, sf_dir):
    """Every line drawn (ratio 1) or none (ratio 0) through the file writer: two and one copies of each row."""
    out = scratch_path(spark, "dups")
    _sales(spark, sf_dir).write.csv(f"{out}/drop.csv")
    twice = export.write_with_dups(spark, [f"{out}/drop.csv"], f"{out}/all", ratio=1.0)
    once = export.write_with_dups(spark, [f"{out}/drop.csv"], f"{out}/none", ratio=0.0)
    rows = src.read_sales_csv(spark, [*twice, *once])
    return rows.select(F.col("basket_id").cast("bigint").alias("basket_id"), F.col("product_id").cast("bigint").alias("product_id"))


def q_duplicate_injection_drawn(spark, sf_dir):
    """One occurrence in about seven drawn for a second copy, through the file writer."""
    out = scratch_path(spark, "drawn")
    _sales(spark, sf_dir).write.csv(f"{out}/drop.csv")
    (written,) = export.write_with_dups(spark, [f"{out}/drop.csv"], f"{out}/drawn", ratio=DUP_RATIO, seed=DUP_SEED)
    return _bigints(src.read_sales_csv(spark, written))


def q_export_order(spark, sf_dir):
    """Rows of a ranked and of a shuffled export, and whether they stand in rank order on disk."""
    out = scratch_path(spark, "order")
    counts = stored(_pairs(spark, sf_dir), "pair-counts")  # both exports are of one count
    export.write_counts_csv(counts, f"{out}/ranked")
    counts.repartition(4).write.option("header", True).csv(f"{out}/shuffled")
    checks = [export.order_check(spark, f"{out}/{name}", 2, "bigint").withColumn("export", F.lit(name)) for name in ("ranked", "shuffled")]
    return checks[0].unionByName(checks[1]).select("export", "rows", (F.col("violations") == 0).alias("in_order"))


LONG_ID = "9" * 20


def _long_ids(spark, sf_dir):
    """Sales whose products are texts of 20 to 40 digits, some negative, some with leading zeros, and some short."""
    sk = F.col("product_id")
    text = sk.cast("string")
    long = F.when(sk % 4 == 0, F.concat(F.lit("-" + LONG_ID), text)).when(sk % 4 == 1, F.concat(F.lit(LONG_ID * 2), text))
    return _sales(spark, sf_dir).withColumn("product_id", long.when(sk % 4 == 2, F.concat(F.lit("00" + LONG_ID), text)).otherwise(text))


def q_long_id_pairs(spark, sf_dir):
    """Pair counts of ids of any length, in order of their value."""
    return cooccur.cooccurrence(_long_ids(spark, sf_dir), 2)


def q_hot_row_balance(spark, sf_dir):
    """One row repeated for a third of the input, written to a shard of 8 files: how even the files are."""
    out = scratch_path(spark, "hot-row")
    li = _lineitem(spark, sf_dir)
    hot = li.where(F.col("l_linenumber") <= 3).select(F.lit(-7).cast("bigint").alias("basket_id"), F.lit(1).cast("bigint").alias("product_id"))
    export.write_shards(_sales(spark, sf_dir).unionByName(hot), out, 1, files_per_shard=8)
    files = src.read_shards(spark, out).groupBy("_metadata.file_name").agg(F.count(F.lit(1)).alias("n"))
    even = F.max("n") < 1.5 * F.avg("n")
    return files.agg(F.count(F.lit(1)).alias("files"), F.sum("n").alias("rows"), even.alias("balanced"))


def q_injection_stats(spark, sf_dir):
    return dedup.injection_stats(_sales(spark, sf_dir), _injected(spark, sf_dir))


def q_pair_reconciliation(spark, sf_dir):
    keys = cooccur.product_columns(2)
    return quality.reconcile(_pairs(spark, sf_dir, "array"), _pairs(spark, sf_dir, "join"), keys)


def q_pair_lookup(spark, sf_dir):
    """Join-plan counts looked up in the auto-plan result (default 0)."""
    keys = cooccur.product_columns(2)
    return quality.lookup_counts(_pairs(spark, sf_dir, "join"), _pairs(spark, sf_dir), keys)


def q_pair_multiset_check(spark, sf_dir):
    """Raw sales rows against their deduplicated table, as multisets."""
    s = _sales(spark, sf_dir)
    return quality.multiset_diff(s, dedup.dedup(s))


def q_skew_analysis(spark, sf_dir):
    """Two products added to every basket: one pair dominates all others.
    Auto-plan counts are reconciled two-sided against the join plan."""
    s = _sales(spark, sf_dir)
    hot = s.select("basket_id").distinct().select(
        "basket_id", F.explode(F.array(F.lit(-1).cast("bigint"), F.lit(-2).cast("bigint"))).alias("product_id")
    )
    skewed = s.unionByName(hot)
    return quality.skew_report(
        cooccur.cooccurrence(skewed, 2), cooccur.cooccurrence(skewed, 2, plan="join")
    )


def q_triple_pair_closure(spark, sf_dir):
    s = _sales(spark, sf_dir)
    return quality.closure_missing(cooccur.cooccurrence(s, 3), cooccur.cooccurrence(s, 2))


def q_pair_incremental(spark, sf_dir):
    existing, incoming = _existing(spark, sf_dir), _incoming(spark, sf_dir)
    before = cooccur.cooccurrence(existing, 2)
    return incremental.update_counts(before, incoming, existing, 2)


def q_pair_merge_partials(spark, sf_dir):
    """Counts of two basket-disjoint halves (by shard parity), merged."""
    s = bucket.assign_shards(_sales(spark, sf_dir), 2)
    halves = [
        cooccur.cooccurrence(s.where(F.col("shard") == i).drop("shard"), 2) for i in (0, 1)
    ]
    return incremental.merge_counts(*halves)


def q_run_ratio(spark, sf_dir):
    per_month = quality.rows_per_period(_lineitem(spark, sf_dir), "l_shipdate", "month")
    return quality.run_ratio(per_month, "period", "rows")


def q_export_roundtrip(spark, sf_dir):
    out = scratch_path(spark, "pairs-csv")
    export.write_counts_csv(_pairs(spark, sf_dir), out)
    return export.read_counts_csv(spark, out, 2, "bigint")


def q_export_text_ids(spark, sf_dir):
    """Counts of text ids with leading zeros, exported and read back."""
    out = scratch_path(spark, "pairs-csv")
    padded = F.lpad(F.col("product_id").cast("string"), 6, "0")
    export.write_counts_csv(cooccur.cooccurrence(_sales(spark, sf_dir).withColumn("product_id", padded), 2), out)
    return export.read_counts_csv(spark, out, 2)


def q_export_triples(spark, sf_dir):
    """A ranked k=3 export, read back."""
    out = scratch_path(spark, "triples-csv")
    export.write_counts_csv(cooccur.cooccurrence(_sales(spark, sf_dir), 3), out)
    return export.read_counts_csv(spark, out, 3, "bigint")


def q_export_preview(spark, sf_dir):
    out = scratch_path(spark, "pairs-csv")
    export.write_counts_csv(_pairs(spark, sf_dir), out, line_sep="\r\n")
    return export.preview(spark, out, 2, 10, "bigint")


def q_export_head(spark, sf_dir):
    """The first rows of a ranked export, as its first file has them."""
    out = scratch_path(spark, "pairs-csv")
    export.write_counts_csv(_pairs(spark, sf_dir), out)
    return export.head(spark, out, 2, 10, "bigint")


def q_reencode_roundtrip(spark, sf_dir):
    """Padded keys, a quoted empty field and a third column survive the change of codec."""
    gz, plain = scratch_path(spark, "sales-gz"), scratch_path(spark, "sales-plain")
    li = _lineitem(spark, sf_dir)
    line = F.concat(F.lit(" "), F.col("l_orderkey"), F.lit("\t,"), F.col("l_suppkey"), F.lit(',"",'), F.col("l_linenumber"))
    li.select(line).write.option("compression", "gzip").text(gz)
    export.reencode_csv(spark, gz, plain, "none")
    return spark.read.text(plain).select(F.col("value").alias("line"))


#: Rows of one file that is written for a job to read, at most about.
FILE_ROWS = 500_000


def _text(rows: DataFrame, files: int, path: str) -> int:
    """Rows as ``files`` gzip CSV files or more, as they need (gzip can't be split: one task each); how many at most."""
    files = max(files, rows.count() // FILE_ROWS)
    rows.repartition(files).write.option("compression", "gzip").csv(path)
    return files


def _bigints(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("basket_id").cast("bigint").alias("basket_id"), F.col("product_id").cast("bigint").alias("product_id"))


def _two_runs(spark, sf_dir):
    """Two ingest runs over CSV drops, and one re-run with no new file; the table, the log and the outcomes."""
    inbox, table, log = (scratch_path(spark, x) for x in ("inbox", "sales-table", "ingest-log"))
    files = spark.sparkContext.defaultParallelism
    runs = []
    for name, part in (("existing", _existing(spark, sf_dir)), ("incoming", _incoming(spark, sf_dir))):
        # a row without a product in each drop's file is rejected and reported
        dirty = part.limit(1).select("basket_id", F.lit(None).cast("bigint").alias("product_id"))
        _text(part.unionByName(dirty), files, f"{inbox}-{name}")
        runs.append(ingest.ingest(spark, f"{inbox}-{name}", table, log))
    runs.append(ingest.ingest(spark, f"{inbox}-incoming", table, log))
    return table, log, runs


def q_ingest_roundtrip(spark, sf_dir):
    """The ingested table's rows."""
    table, _, _ = _two_runs(spark, sf_dir)
    return _bigints(ingest.read_table(spark, table))


def q_ingest_runs(spark, sf_dir):
    """What each run reports, and how many of its files the log has."""
    _, log, runs = _two_runs(spark, sf_dir)
    rows = [(i, r.batch_id, len(r.new_files) > 0, r.rows_read, r.rows_appended, r.table_rows, r.rejected.get("missing_product", 0)) for i, r in enumerate(runs)]
    report = spark.createDataFrame(rows, "run int, batch_id bigint, new_files boolean, rows_read bigint, rows_appended bigint, table_rows bigint, rejected bigint")
    logged = ingest.load_processed_log(spark, log).groupBy("batch_id").agg((F.count(F.lit(1)) > 0).alias("logged"))
    return report.join(logged, "batch_id", "left").select(*report.columns, F.coalesce("logged", F.lit(False)).alias("logged"))


def q_ingest_by_date(spark, sf_dir):
    """Ingest into a table partitioned by ingestion date; keys read back, and whether their date is today's."""
    inbox = scratch_path(spark, "inbox")
    table, log = scratch_path(spark, "dated-table"), scratch_path(spark, "dated-log")
    _text(_sales(spark, sf_dir), spark.sparkContext.defaultParallelism, inbox)
    ingest.ingest(spark, inbox, table, log, partition_by_date=True)
    dated = spark.read.parquet(table)
    recent = F.datediff(F.current_date(), F.col("ingest_date")).between(0, 1)
    return dated.select(
        F.col("basket_id").cast("bigint").alias("basket_id"), F.col("product_id").cast("bigint").alias("product_id"), recent.alias("recent")
    )


def _streamed(spark, sf_dir, start):
    """Run ``start(stream)`` over sales that arrive in two lots of two batches each, with a restart between the lots.

    A batch is one file, or as many of ``FILE_ROWS`` rows as it needs: a file of one row group is one task.
    """
    inbox = scratch_path(spark, "stream-in")
    for lot, part in (("1", _existing(spark, sf_dir)), ("2", _incoming(spark, sf_dir))):
        files = max(1, ceil(part.count() / 2 / FILE_ROWS))
        part.repartition(2 * files, "basket_id", "product_id").write.mode("append").parquet(f"{inbox}/lot={lot}")
        stream = ingest_stream.file_stream(spark, inbox, "parquet", part.schema, max_files_per_trigger=files)
        ingest_stream.run_to_completion(start(stream))


def q_stream_dedup(spark, sf_dir):
    table, ckpt = scratch_path(spark, "stream-table"), scratch_path(spark, "stream-ckpt")
    _streamed(spark, sf_dir, lambda s: ingest_stream.start_dedup_stream(s, table, ckpt, mode="table"))
    return spark.read.parquet(table)


def q_stream_dedup_state(spark, sf_dir):
    table, ckpt = scratch_path(spark, "stream-table"), scratch_path(spark, "stream-ckpt")
    _streamed(spark, sf_dir, lambda s: ingest_stream.start_dedup_stream(s, table, ckpt, mode="state"))
    return spark.read.parquet(table)


def q_stream_dedup_window(spark, sf_dir):
    """Sales that arrive by year, those of its last 30 days once more with the next year: each is kept once.

    A sale is forgotten some time after the watermark has passed it, so that the state ends
    with a part of all sales.
    """
    inbox, table, ckpt = (scratch_path(spark, x) for x in ("window-in", "window-table", "window-ckpt"))
    sales = _lineitem(spark, sf_dir).select(
        F.col("l_orderkey").alias("basket_id"), F.col("l_suppkey").alias("product_id"),
        "l_linenumber", "l_partkey", F.col("l_shipdate").cast("timestamp").alias("sold_at"),
    )
    event = ["basket_id", "l_linenumber", "l_partkey", "sold_at"]
    year, late = F.year("sold_at"), F.year(F.col("sold_at") + F.expr("INTERVAL 30 DAYS"))
    whole = sales.select("*", F.explode(F.array_distinct(F.array(year, late))).alias("lot"))
    first, last = whole.agg(F.min("lot"), F.max("lot")).first()
    progress = []
    for lot in range(first, last + 2):  # the last run finds nothing new
        # each year is a batch of its own, of as many files as the table has splits
        if lot <= last:
            whole.where(F.col("lot") == lot).drop("lot").write.mode("append").parquet(f"{inbox}/lot={lot}")
        stream = ingest_stream.file_stream(spark, inbox, "parquet", sales.schema, max_files_per_trigger=None)
        run = ingest_stream.start_dedup_stream(
            stream, table, ckpt, event, mode="window", event_time="sold_at", delay="40 days", columns=["basket_id", "product_id"]
        )
        ingest_stream.run_to_completion(run)
        progress += [p.stateOperators[0].numRowsTotal for p in run.recentProgress if p.stateOperators]
    kept = spark.read.schema("basket_id bigint, product_id bigint").parquet(table)
    rows = sales.agg(F.count(F.lit(1))).first()[0]
    return kept.withColumn("state_bounded", F.lit(progress[-1] < 0.4 * rows and max(progress) < 0.7 * rows))


def q_stream_pair_counts(spark, sf_dir):
    """Pair counts after four batches, a restart, and a replay of the last batch."""
    rows, counts = scratch_path(spark, "stream-rows"), scratch_path(spark, "stream-counts")
    ckpt = scratch_path(spark, "stream-ckpt")
    _streamed(spark, sf_dir, lambda s: pair_counts.start_pair_count_stream(s, rows, counts, ckpt, 2))
    kept = spark.read.parquet(rows)
    last = kept.agg(F.max("batch_id")).first()[0]
    replayed = kept.where(F.col("batch_id") == last).select("basket_id", "product_id")
    pair_counts.apply_batch(replayed, int(last), rows, counts, 2)
    return pair_counts.read_counts(spark, counts, 2, must_exist=True)


def q_keyed_pair_counts(spark, sf_dir):
    """Pair counts of a stream into keyed tables: four batches, a restart, and replays of a merged and of the last batch."""
    rows = keyed_ingest.sales_table(spark, scratch_path(spark, "keyed-rows"), _sales(spark, sf_dir).schema, keep_batches=True, fanout=2)
    counts = keyed_ingest.counts_table(spark, scratch_path(spark, "keyed-counts"), 2, fanout=2)
    ckpt = scratch_path(spark, "stream-ckpt")
    _streamed(spark, sf_dir, lambda s: keyed_ingest.start_counts(s, rows, counts, ckpt, 2))
    last = rows.last_batch()
    for batch in (0, last):
        again = rows.read().where(F.col("batch_id") == batch).drop("batch_id")
        keyed_ingest.apply_batch(again, batch, rows, counts, 2)
    return keyed_ingest.read_counts(counts)


def _keyed_runs(spark, sf_dir):
    """The drops of ``_two_runs`` through a file stream, each one batch; a restart between them, and a third run without a new file."""
    inbox, ckpt = scratch_path(spark, "keyed-in"), scratch_path(spark, "keyed-ckpt")
    table = keyed_ingest.sales_table(spark, scratch_path(spark, "keyed-table"))
    outcomes = keyed_ingest.outcomes_table(spark, scratch_path(spark, "keyed-outcomes"))
    files = spark.sparkContext.defaultParallelism
    for lot, part in (("1", _existing(spark, sf_dir)), ("2", _incoming(spark, sf_dir)), ("3", None)):
        if part is not None:
            dirty = part.limit(1).select("basket_id", F.lit(None).cast("bigint").alias("product_id"))
            files = _text(part.unionByName(dirty), files, f"{inbox}/lot={lot}")
        stream = ingest_stream.file_stream(spark, inbox, max_files_per_trigger=files)
        ingest_stream.run_to_completion(keyed_ingest.start_ingest(stream, table, outcomes, ckpt))
    return table, outcomes


def q_keyed_ingest_roundtrip(spark, sf_dir):
    """The rows of a keyed table after a streamed ingest."""
    table, _ = _keyed_runs(spark, sf_dir)
    return _bigints(table.read())


def q_keyed_ingest_runs(spark, sf_dir):
    """What each batch of a streamed ingest reports."""
    _, outcomes = _keyed_runs(spark, sf_dir)
    rejected = F.coalesce(F.element_at("rejected", "missing_product"), F.lit(0)).alias("rejected")
    return outcomes.read().select("batch_id", "rows_read", "distinct_rows", "rows_appended", "table_rows", rejected)


def q_schema_evolution(spark, sf_dir):
    """Two file generations of one table, the second with an extra column."""
    table = scratch_path(spark, "evolving")
    _existing(spark, sf_dir).write.parquet(f"{table}/gen=1")
    li = _lineitem(spark, sf_dir).where(F.col("l_linenumber") >= 3)
    li.select(
        F.col("l_orderkey").alias("basket_id"), F.col("l_suppkey").alias("product_id"),
        F.col("l_quantity").alias("quantity"),
    ).write.parquet(f"{table}/gen=2")
    return src.read_table_evolving(spark, table).select("basket_id", "product_id", "quantity", "gen")


def q_synthetic_baskets(spark, sf_dir):
    """One generated basket per order, products drawn from the part range."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey")
    n_parts = spark.read.parquet(f"{sf_dir}/part.parquet").agg(F.count(F.lit(1))).scalar()
    # scalar subquery as a column (not allowed directly inside the draw lambda)
    keyed = orders.withColumn("_p", n_parts)
    return synth.baskets_for_keys(keyed, "o_orderkey", F.col("_p"), 5, SYNTH_SEED)


def q_synthetic_dense(spark, sf_dir):
    """Baskets of up to as many products as there are: sizes come out exactly as drawn."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey")
    n = spark.read.parquet(f"{sf_dir}/region.parquet").agg(F.count(F.lit(1))).scalar()
    return synth.baskets_for_keys(orders.withColumn("_p", n), "o_orderkey", F.col("_p"), 5, SYNTH_SEED)


def q_synthetic_pairs(spark, sf_dir):
    """Generate once into the shared scratch folder, then count pairs on it."""
    path = scratch_path(spark, "generated")
    q_synthetic_baskets(spark, sf_dir).write.parquet(path)
    counts = cooccur.cooccurrence(spark.read.parquet(path), 2)
    return counts.select(
        F.col("product_1").cast("bigint").alias("product_1"),
        F.col("product_2").cast("bigint").alias("product_2"),
        "baskets",
    )


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "sales_projection": q_sales_projection,
    "item_support": q_item_support,
    "pair_cooccurrence": q_pair_cooccurrence,
    "pair_cooccurrence_join": q_pair_cooccurrence_join,
    "pair_cooccurrence_blocked": q_pair_cooccurrence_blocked,
    "pair_cooccurrence_partkey": q_pair_cooccurrence_partkey,
    "triple_cooccurrence": q_triple_cooccurrence,
    "quad_cooccurrence": q_quad_cooccurrence,
    "heavy_pairs": q_heavy_pairs,
    "heavy_triples": q_heavy_triples,
    "top_pairs": q_top_pairs,
    "top_triples": q_top_triples,
    "basket_size_histogram": q_basket_size_histogram,
    "shard_assignment": q_shard_assignment,
    "shard_balance": q_shard_balance,
    "shard_summary": q_shard_summary,
    "shard_roundtrip": q_shard_roundtrip,
    "shard_pairs": q_shard_pairs,
    "shard_file_pairs": q_shard_file_pairs,
    "csv_clean_pairs": q_csv_clean_pairs,
    "sales_rejects": q_sales_rejects,
    "dedup_union": q_dedup_union,
    "ingest_new_rows": q_ingest_new_rows,
    "duplicate_rate": q_duplicate_rate,
    "duplicate_injection": q_duplicate_injection,
    "duplicate_injection_file": q_duplicate_injection_file,
    "hot_row_balance": q_hot_row_balance,
    "injection_stats": q_injection_stats,
    "pair_reconciliation": q_pair_reconciliation,
    "pair_lookup": q_pair_lookup,
    "pair_multiset_check": q_pair_multiset_check,
    "skew_analysis": q_skew_analysis,
    "triple_pair_closure": q_triple_pair_closure,
    "pair_incremental": q_pair_incremental,
    "pair_merge_partials": q_pair_merge_partials,
    "run_ratio": q_run_ratio,
    "export_roundtrip": q_export_roundtrip,
    "export_text_ids": q_export_text_ids,
    "export_triples": q_export_triples,
    "export_preview": q_export_preview,
    "reencode_roundtrip": q_reencode_roundtrip,
    "ingest_roundtrip": q_ingest_roundtrip,
    "ingest_runs": q_ingest_runs,
    "ingest_by_date": q_ingest_by_date,
    "stream_dedup": q_stream_dedup,
    "stream_dedup_state": q_stream_dedup_state,
    "stream_pair_counts": q_stream_pair_counts,
    "stream_dedup_window": q_stream_dedup_window,
    "duplicate_injection_drawn": q_duplicate_injection_drawn,
    "export_order": q_export_order,
    "long_id_pairs": q_long_id_pairs,
    "keyed_pair_counts": q_keyed_pair_counts,
    "keyed_ingest_roundtrip": q_keyed_ingest_roundtrip,
    "keyed_ingest_runs": q_keyed_ingest_runs,
    "schema_evolution": q_schema_evolution,
    "stored_item_support": q_stored_item_support,
    "stored_pairs": q_stored_pairs,
    "stored_heavy_pairs": q_stored_heavy_pairs,
    "stored_heavy_triples": q_stored_heavy_triples,
    "stored_reconciliation": q_stored_reconciliation,
    "stored_size_histogram": q_stored_size_histogram,
    "export_head": q_export_head,
    "synthetic_baskets": q_synthetic_baskets,
    "synthetic_dense": q_synthetic_dense,
    "synthetic_pairs": q_synthetic_pairs,
}


# ── DuckDB oracles ──────────────────────────────────────────────────────────

_SALES = "SELECT l_orderkey AS basket_id, l_suppkey AS product_id FROM lineitem"
_D = f"SELECT DISTINCT basket_id, product_id FROM ({_SALES}) WHERE basket_id IS NOT NULL AND product_id IS NOT NULL"
_EXISTING = "SELECT l_orderkey AS basket_id, l_suppkey AS product_id FROM lineitem WHERE l_linenumber <= 4"
_INCOMING = "SELECT l_orderkey AS basket_id, l_suppkey AS product_id FROM lineitem WHERE l_linenumber >= 3"


def _tuples_sql(k: int, distinct_rows: str = _D) -> str:
    cols = ", ".join(f"t{i}.product_id AS product_{i}" for i in range(1, k + 1))
    joins = "".join(
        f" JOIN d t{i} ON t{i}.basket_id = t1.basket_id AND t{i}.product_id > t{i - 1}.product_id"
        for i in range(2, k + 1)
    )
    groups = ", ".join(str(i) for i in range(1, k + 1))
    return (
        f"WITH d AS ({distinct_rows}) SELECT {cols}, COUNT(*) AS baskets "
        f"FROM d t1{joins} GROUP BY {groups}"
    )


def _top_sql(k: int, n: int = 10) -> str:
    order = ", ".join(f"CAST(product_{i} AS VARCHAR)" for i in range(1, k + 1))
    return f"SELECT * FROM ({_tuples_sql(k)}) ORDER BY baskets DESC, {order} LIMIT {n}"


def _shard_sql(n: int, key: str = "basket_id") -> str:
    return f"CAST(('0x' || md5(CAST({key} AS VARCHAR)))::UHUGEINT % {n} AS INTEGER)"


_ASSIGNED = f"SELECT basket_id, product_id, {_shard_sql(NUM_SHARDS)} AS shard FROM ({_SALES})"
_PAIRS = _tuples_sql(2)
_UNION_D = (
    f"SELECT DISTINCT basket_id, product_id FROM ({_EXISTING} UNION ALL {_INCOMING})"
)


def _h(text: str) -> str:
    """First 32 bits of md5(text) as an integer (see keys.hash_fraction)."""
    return f"('0x' || substr(md5({text}), 1, 8))::BIGINT"


_DRAW = _h(f"concat_ws('|', '{DUP_SEED}', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR))")
_INJECTED = (
    f"SELECT basket_id, product_id FROM ({_SALES}) UNION ALL "
    f"SELECT l_orderkey AS basket_id, l_suppkey AS product_id FROM lineitem "
    f"WHERE {_DRAW} / 4294967296.0 < {DUP_RATIO}"
)

def _synth_sql(products: str) -> str:
    """Floyd's sample, one step of every basket at a time."""
    draw = _h(f"concat_ws('|', '{SYNTH_SEED}', CAST(k AS VARCHAR), CAST(j AS VARCHAR))")
    return f"""
WITH RECURSIVE keys AS (
  SELECT o_orderkey AS k, p, least(1 + {_h(f"concat_ws('|', '{SYNTH_SEED}', CAST(o_orderkey AS VARCHAR), 'n')")} % 5, p) AS n
  FROM orders, (SELECT COUNT(*) AS p FROM {products})
), steps AS (
  SELECT k, p, p - n AS j, CAST([] AS BIGINT[]) AS taken FROM keys
  UNION ALL
  SELECT k, p, j + 1, list_append(taken, CASE WHEN list_contains(taken, {draw} % (j + 1)) THEN j ELSE {draw} % (j + 1) END)
  FROM steps WHERE j < p
)
SELECT concat_ws('-', substr(md5(h), 1, 8), substr(md5(h), 9, 4), substr(md5(h), 13, 4),
                 substr(md5(h), 17, 4), substr(md5(h), 21, 12)) AS basket_id,
       CAST(prod AS VARCHAR) AS product_id
FROM (SELECT concat_ws('|', '{SYNTH_SEED}', CAST(k AS VARCHAR)) AS h, unnest(taken) AS prod FROM steps WHERE j = p)
"""


_SYNTH = _synth_sql("part")

_SYNTH_PAIRS = (
    f"WITH d AS (SELECT DISTINCT basket_id, CAST(product_id AS BIGINT) AS product_id FROM ({_SYNTH})) "
    "SELECT t1.product_id AS product_1, t2.product_id AS product_2, COUNT(*) AS baskets "
    "FROM d t1 JOIN d t2 ON t1.basket_id = t2.basket_id AND t1.product_id < t2.product_id GROUP BY 1, 2"
)

_LONG = f"""CASE product_id % 4 WHEN 0 THEN '-{LONG_ID}' || product_id WHEN 1 THEN '{LONG_ID * 2}' || product_id
WHEN 2 THEN '00{LONG_ID}' || product_id ELSE CAST(product_id AS VARCHAR) END"""
# by value: negative ones by digits downwards, then short, 20 and more, and 40 and more digits
_LONG_PAIRS = f"""
WITH d AS (
  SELECT DISTINCT basket_id, {_LONG} AS id, CASE product_id % 4 WHEN 0 THEN 0 WHEN 3 THEN 1 WHEN 2 THEN 2 ELSE 3 END AS kind,
         CASE WHEN product_id % 4 = 0 THEN -product_id ELSE product_id END AS place
  FROM ({_SALES}) WHERE basket_id IS NOT NULL AND product_id IS NOT NULL
)
SELECT a.id AS product_1, b.id AS product_2, COUNT(*) AS baskets FROM d a JOIN d b
ON a.basket_id = b.basket_id AND (a.kind < b.kind OR (a.kind = b.kind AND a.place < b.place)) GROUP BY 1, 2
"""

_CROWD = "(l_partkey * 7 + l_suppkey * 13)"


def _crowded_sql(products: int, k: int) -> str:
    item = f"{_CROWD} % {products} AS product_id"
    rows = f"SELECT DISTINCT * FROM (SELECT l_orderkey AS basket_id, {item} FROM lineitem UNION ALL SELECT -1, {item} FROM lineitem)"
    sums = ", ".join(f"CAST(SUM(product_{i}) AS BIGINT) AS sum_product_{i}" for i in range(1, k + 1))
    return f"SELECT baskets, COUNT(*) AS tuples, {sums} FROM ({_tuples_sql(k, rows)}) GROUP BY 1"


_PADDED = "SELECT DISTINCT basket_id, lpad(CAST(product_id AS VARCHAR), 6, '0') AS product_id FROM (" + _SALES + ")"
_N_EXISTING = f"(SELECT COUNT(*) FROM ({_EXISTING}))"
_N_INCOMING = f"(SELECT COUNT(*) FROM ({_INCOMING}))"
_D_EXISTING = f"(SELECT COUNT(*) FROM (SELECT DISTINCT * FROM ({_EXISTING})))"
_D_UNION = f"(SELECT COUNT(*) FROM ({_UNION_D}))"

_ORACLES: dict[str, str] = {
    "heavy_pairs": _crowded_sql(HEAVY_PAIR_PRODUCTS, 2),
    "heavy_triples": _crowded_sql(HEAVY_TRIPLE_PRODUCTS, 3),
    "shard_file_pairs": _PAIRS,
    "export_text_ids": _tuples_sql(2, _PADDED),
    "export_triples": _tuples_sql(3),
    "hot_row_balance": (
        "SELECT CAST(8 AS BIGINT) AS files, CAST(COUNT(*) + COUNT(*) FILTER (WHERE l_linenumber <= 3) AS BIGINT) AS rows, "
        "TRUE AS balanced FROM lineitem"
    ),
    "ingest_runs": (
        f"SELECT CAST(0 AS INTEGER) AS run, CAST(0 AS BIGINT) AS batch_id, TRUE AS new_files, {_N_EXISTING} + 1 AS rows_read, "
        f"{_D_EXISTING} AS rows_appended, {_D_EXISTING} AS table_rows, CAST(1 AS BIGINT) AS rejected, TRUE AS logged UNION ALL "
        f"SELECT 1, 1, TRUE, {_N_INCOMING} + 1, {_D_UNION} - {_D_EXISTING}, {_D_UNION}, 1, TRUE UNION ALL "
        f"SELECT 2, NULL, FALSE, 0, 0, {_D_UNION}, 0, FALSE"
    ),
    "synthetic_dense": _synth_sql("region"),
    "sales_projection": _SALES,
    "item_support": f"SELECT product_id AS product_1, COUNT(*) AS baskets FROM ({_D}) GROUP BY 1",
    "pair_cooccurrence": _PAIRS,
    "pair_cooccurrence_join": _PAIRS,
    "pair_cooccurrence_blocked": _PAIRS,
    "pair_cooccurrence_partkey": _tuples_sql(
        2,
        "SELECT DISTINCT l_orderkey AS basket_id, l_partkey AS product_id FROM lineitem "
        "WHERE l_orderkey IS NOT NULL AND l_partkey IS NOT NULL",
    ),
    "triple_cooccurrence": _tuples_sql(3),
    "quad_cooccurrence": _tuples_sql(4),
    "top_pairs": _top_sql(2),
    "top_triples": _top_sql(3),
    "basket_size_histogram": (
        f"SELECT basket_size, COUNT(*) AS baskets FROM "
        f"(SELECT basket_id, COUNT(*) AS basket_size FROM ({_D}) GROUP BY 1) GROUP BY 1"
    ),
    "shard_assignment": _ASSIGNED,
    "shard_balance": (
        f"WITH c AS (SELECT shard, COUNT(*) AS rows FROM ({_ASSIGNED}) GROUP BY 1), "
        f"ids AS (SELECT CAST(range AS INTEGER) AS shard FROM range({NUM_SHARDS})) "
        f"SELECT ids.shard, CAST(COALESCE(c.rows, 0) AS BIGINT) AS rows, "
        f"ROUND(COALESCE(c.rows, 0) * {NUM_SHARDS} / (SELECT SUM(rows) FROM c)::DOUBLE, 6) AS rows_over_mean "
        f"FROM ids LEFT JOIN c ON ids.shard = c.shard"
    ),
    "shard_summary": (
        f"WITH c AS (SELECT shard, COUNT(*) AS rows FROM ({_ASSIGNED}) GROUP BY 1) "
        f"SELECT {NUM_SHARDS} AS shards, COUNT(*) AS used_shards, MIN(shard) AS min_shard, "
        f"MAX(shard) AS max_shard, CAST(COALESCE(SUM(CASE WHEN shard < 0 OR shard >= {NUM_SHARDS} "
        f"THEN rows END), 0) AS BIGINT) AS out_of_range, MAX(rows) AS max_rows, "
        f"ROUND(SUM(rows) / {NUM_SHARDS}.0, 6) AS mean_rows, "
        f"ROUND(MAX(rows) * {NUM_SHARDS} / SUM(rows)::DOUBLE, 6) AS max_over_mean FROM c"
    ),
    "shard_roundtrip": (
        f"SELECT COUNT(*) AS baskets, CAST(SUM(n) AS BIGINT) AS rows, "
        f"COUNT(*) FILTER (WHERE s > 1) AS split_baskets FROM "
        f"(SELECT basket_id, COUNT(*) AS n, COUNT(DISTINCT shard) AS s FROM ({_ASSIGNED}) GROUP BY 1)"
    ),
    "shard_pairs": _PAIRS,
    "csv_clean_pairs": _PAIRS.replace("t1.product_id AS product_1", "CAST(t1.product_id AS VARCHAR) AS product_1")
    .replace("t2.product_id AS product_2", "CAST(t2.product_id AS VARCHAR) AS product_2"),
    "sales_rejects": (
        "SELECT reason, COUNT(*) AS rows FROM (SELECT CASE "
        "WHEN l_linenumber = 6 AND l_suppkey % 10 = 0 THEN 'empty_basket' "
        "WHEN l_linenumber = 7 THEN 'missing_product' "
        "WHEN l_linenumber = 5 AND l_partkey % 10 = 0 THEN 'non_integer_product' END AS reason "
        "FROM lineitem) WHERE reason IS NOT NULL GROUP BY 1"
    ),
    "dedup_union": _UNION_D,
    "ingest_new_rows": (
        f"SELECT DISTINCT i.basket_id, i.product_id FROM ({_INCOMING}) i WHERE NOT EXISTS "
        f"(SELECT 1 FROM ({_EXISTING}) e WHERE e.basket_id IS NOT DISTINCT FROM i.basket_id "
        f"AND e.product_id IS NOT DISTINCT FROM i.product_id)"
    ),
    "duplicate_rate": (
        f"SELECT CAST(COUNT(*) AS BIGINT) AS rows, "
        f"(SELECT COUNT(*) FROM (SELECT DISTINCT basket_id, product_id FROM ({_SALES}))) AS distinct_rows, "
        f"COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT basket_id, product_id FROM ({_SALES}))) AS duplicate_rows, "
        f"ROUND((COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT basket_id, product_id FROM ({_SALES}))))"
        f" / COUNT(*)::DOUBLE, 6) AS duplicate_ratio FROM ({_SALES})"
    ),
    "duplicate_injection": _INJECTED,
    "duplicate_injection_file": f"{_SALES} UNION ALL {_SALES} UNION ALL {_SALES}",
    "injection_stats": (
        f"SELECT (SELECT COUNT(*) FROM lineitem) AS original_rows, "
        f"(SELECT COUNT(*) FROM ({_INJECTED})) - (SELECT COUNT(*) FROM lineitem) AS duplicate_rows, "
        f"(SELECT COUNT(*) FROM ({_INJECTED})) AS total_rows"
    ),
    "pair_reconciliation": (
        f"SELECT COUNT(*) AS left_rows, COUNT(*) AS right_rows, COUNT(*) AS matched, "
        f"0::BIGINT AS mismatched, 0::BIGINT AS left_only, 0::BIGINT AS right_only FROM ({_PAIRS})"
    ),
    "pair_lookup": (
        "SELECT product_1, product_2, baskets AS expected, baskets AS actual "
        f"FROM ({_PAIRS})"
    ),
    "pair_multiset_check": (
        f"SELECT (SELECT COUNT(*) FROM ({_SALES})) - (SELECT COUNT(*) FROM "
        f"(SELECT DISTINCT basket_id, product_id FROM ({_SALES}))) AS left_extra, "
        f"0::BIGINT AS right_extra"
    ),
    "skew_analysis": (
        f"WITH s AS ({_SALES} UNION ALL SELECT basket_id, unnest([-1, -2]) AS product_id "
        f"FROM (SELECT DISTINCT l_orderkey AS basket_id FROM lineitem)), "
        f"p AS ({_tuples_sql(2, 'SELECT DISTINCT basket_id, product_id FROM s')}) "
        f"SELECT max_by(product_1, baskets) AS dominant_1, max_by(product_2, baskets) AS dominant_2, "
        f"MAX(baskets) AS dominant_baskets, COUNT(*) AS pairs, 0::BIGINT AS mismatches FROM p"
    ),
    "triple_pair_closure": (
        f"SELECT COUNT(*) AS tuples, 3 * COUNT(*) AS subsets_checked, 0::BIGINT AS missing, "
        f"0::BIGINT AS undercounted FROM ({_tuples_sql(3)})"
    ),
    "pair_incremental": _tuples_sql(2, _UNION_D),
    "pair_merge_partials": _PAIRS,
    "run_ratio": (
        "WITH m AS (SELECT date_trunc('month', l_shipdate)::TIMESTAMP AS period, COUNT(*) AS rows "
        "FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1) "
        "SELECT period, rows, LAG(rows) OVER (ORDER BY period) AS previous, "
        "ROUND(CASE WHEN LAG(rows) OVER (ORDER BY period) > 0 "
        "THEN rows / (LAG(rows) OVER (ORDER BY period))::DOUBLE END, 6) AS ratio FROM m"
    ),
    "export_roundtrip": _PAIRS,
    "export_preview": _top_sql(2),
    "reencode_roundtrip": (
        "SELECT ' ' || l_orderkey || chr(9) || ',' || l_suppkey || ',\"\",' || l_linenumber AS line FROM lineitem"
    ),
    "ingest_roundtrip": _UNION_D,
    "ingest_by_date": f"SELECT *, TRUE AS recent FROM ({_D})",
    "stream_dedup": _D,
    "stream_dedup_state": _D,
    "stream_pair_counts": _PAIRS,
    "stream_dedup_window": f"SELECT *, TRUE AS state_bounded FROM ({_SALES})",
    "duplicate_injection_drawn": (
        f"{_SALES} UNION ALL SELECT basket_id, product_id FROM "
        f"(SELECT *, row_number() OVER (PARTITION BY basket_id, product_id) AS i FROM ({_SALES})) "
        f"WHERE {_h(f"concat_ws('|', '{DUP_SEED}', CAST(basket_id AS VARCHAR), CAST(product_id AS VARCHAR), CAST(i AS VARCHAR))")} / 4294967296.0 < {DUP_RATIO}"
    ),
    "export_order": (
        f"SELECT 'ranked' AS export, COUNT(*) AS rows, TRUE AS in_order FROM ({_PAIRS}) UNION ALL "
        f"SELECT 'shuffled', COUNT(*), FALSE FROM ({_PAIRS})"
    ),
    "long_id_pairs": _LONG_PAIRS,
    "keyed_pair_counts": _PAIRS,
    "keyed_ingest_roundtrip": _UNION_D,
    "keyed_ingest_runs": (
        f"SELECT CAST(0 AS BIGINT) AS batch_id, {_N_EXISTING} + 1 AS rows_read, {_D_EXISTING} AS distinct_rows, {_D_EXISTING} AS rows_appended, "
        f"{_D_EXISTING} AS table_rows, CAST(1 AS BIGINT) AS rejected UNION ALL "
        f"SELECT 1, {_N_INCOMING} + 1, (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM ({_INCOMING}))), {_D_UNION} - {_D_EXISTING}, {_D_UNION}, 1"
    ),
    "schema_evolution": (
        f"SELECT basket_id, product_id, CAST(NULL AS DOUBLE) AS quantity, 1 AS gen FROM ({_EXISTING}) "
        "UNION ALL SELECT l_orderkey AS basket_id, l_suppkey AS product_id, l_quantity AS quantity, 2 AS gen "
        "FROM lineitem WHERE l_linenumber >= 3"
    ),
    "synthetic_baskets": _SYNTH,
    "synthetic_pairs": _SYNTH_PAIRS,
}
# the same results from stored tables, and from the export's first file
_ORACLES |= {
    "stored_item_support": _ORACLES["item_support"],
    "stored_pairs": _PAIRS,
    "stored_heavy_pairs": _ORACLES["heavy_pairs"],
    "stored_heavy_triples": _ORACLES["heavy_triples"],
    "stored_reconciliation": _ORACLES["pair_reconciliation"],
    "stored_size_histogram": _ORACLES["basket_size_histogram"],
    "export_head": _ORACLES["export_preview"],
}


# ── document operators, where they are installed ────────────────────────────

try:
    from cobasket.llm import queries as _llm
except ImportError:
    pass
else:
    _QUERIES |= _llm.QUERIES
    _ORACLES |= _llm.ORACLES

try:
    import corpus_pipeline as _pipeline
except ImportError:
    pass
else:
    _QUERIES["pipeline"] = _pipeline.run
    if _pipeline.ORACLE_SQL:
        _ORACLES["pipeline"] = _pipeline.ORACLE_SQL


# ── contract ────────────────────────────────────────────────────────────────

def entry(spark: SparkSession) -> DataFrame:
    """Flagship: top-10 product pairs of ``lineitem`` baskets at sf0.001."""
    return q_top_pairs(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)
