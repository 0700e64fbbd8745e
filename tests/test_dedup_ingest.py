import os

from pyspark.sql import functions as F

from cobasket.operators.dedup import (
    duplicate_stats,
    inject_duplicates,
    injection_stats,
    new_rows,
    union_dedup,
)
from cobasket.plans.ingest import ingest, load_processed_log, read_table
from conftest import sales_df


def test_union_dedup_and_new_rows(spark):
    ex = sales_df(spark, [("a", "1"), ("a", "2")])
    inc = sales_df(spark, [("a", "2"), ("b", "1"), ("b", "1")])
    assert sorted(tuple(r) for r in union_dedup(ex, inc).collect()) == [("a", "1"), ("a", "2"), ("b", "1")]
    assert [tuple(r) for r in new_rows(inc, ex).collect()] == [("b", "1")]


def test_new_rows_is_null_safe(spark):
    ex = sales_df(spark, [("a", None)])
    inc = sales_df(spark, [("a", None), ("b", None)])
    assert [tuple(r) for r in new_rows(inc, ex).collect()] == [("b", None)]


def test_duplicate_stats(spark):
    df = sales_df(spark, [("a", "1"), ("a", "1"), ("a", "2"), ("b", "1")])
    r = duplicate_stats(df).first()
    assert (r.rows, r.distinct_rows, r.duplicate_rows, r.duplicate_ratio) == (4, 3, 1, 0.25)


def test_inject_duplicates_is_deterministic(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("basket_id"), F.lit("1").alias("product_id"))
    a = inject_duplicates(df, 0.15, 42)
    b = inject_duplicates(df, 0.15, 42, scramble=True)
    assert sorted(tuple(r) for r in a.collect()) == sorted(tuple(r) for r in b.collect())
    s = injection_stats(df, a).first()
    assert s.original_rows == 5000 and s.total_rows == 5000 + s.duplicate_rows
    assert 600 < s.duplicate_rows < 900
    counts = a.groupBy("basket_id").count()
    assert counts.agg(F.max("count")).first()[0] == 2
    assert inject_duplicates(df, 0.0, 1).count() == 5000


def _drop(path, name, rows):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("".join(f"{b},{p}\n" for b, p in rows))


def test_ingest_incremental_idempotent(spark, tmp):
    inbox, table, log = (os.path.join(tmp, x) for x in ("inbox", "table", "log"))
    _drop(inbox, "d1.csv", [("b1", "1"), ("b1", "1"), ("b1", "2")])
    r1 = ingest(spark, inbox, table, log)
    assert (len(r1.new_files), r1.rows_read, r1.rows_appended, r1.batch_id) == (1, 3, 2, 0)
    # no new file: nothing read, nothing written
    r2 = ingest(spark, inbox, table, log)
    assert r2.new_files == [] and r2.rows_appended == 0
    # an overlapping second file
    _drop(inbox, "d2.csv", [(" b1", "2"), ("b2", "1")])
    r3 = ingest(spark, inbox, table, log)
    assert (r3.rows_appended, r3.batch_id) == (1, 1)
    assert sorted(tuple(r) for r in read_table(spark, table).collect()) == [("b1", "1"), ("b1", "2"), ("b2", "1")]
    assert (r1.table_rows, r2.table_rows, r3.table_rows, r1.rejected) == (2, 2, 3, {})
    # rejects are reported by reason, with the rows read and the table's total
    _drop(inbox, "d3.csv", [("", "1"), ("b9", " "), ("b3", "4")])
    r4 = ingest(spark, inbox, table, log, broadcast_bytes=-1)
    assert (r4.rows_read, r4.rows_appended, r4.table_rows, r4.rejected) == (3, 1, 4, {"empty_basket": 1, "missing_product": 1})
    assert load_processed_log(spark, log).count() == 3
    # the table's buckets prune the scan
    plan = read_table(spark, table).sparkSession.read.parquet(table).where("bucket = 3")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan
    # files that are not CSV are ignored
    _drop(inbox, "notes.txt", [("x", "9")])
    assert ingest(spark, inbox, table, log).new_files == []


def test_ingest_retry_after_crash_between_write_and_log(spark, tmp):
    inbox, table, log = (os.path.join(tmp, x) for x in ("inbox", "table", "log"))
    _drop(inbox, "d1.csv", [("b1", "1"), ("b2", "2")])
    ingest(spark, inbox, table, log)
    # simulate a crash before the log append: the log is lost, the data is there
    ingest_log_lost = os.path.join(tmp, "log2")
    r = ingest(spark, inbox, table, ingest_log_lost)
    assert r.rows_appended == 0
    assert read_table(spark, table).count() == 2


def test_ingest_partition_by_date(spark, tmp):
    inbox, table, log = (os.path.join(tmp, x) for x in ("inbox", "table", "log"))
    _drop(inbox, "d1.csv", [("b1", "1")])
    ingest(spark, inbox, table, log, partition_by_date=True)
    assert any(d.startswith("ingest_date=") for d in os.listdir(table))
    assert read_table(spark, table).count() == 1
