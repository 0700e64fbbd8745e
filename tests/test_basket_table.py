from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from cobasket.operators.cooccur import cooccurrence
from cobasket.plans.basket_table import SIZE, open_baskets, write_baskets
from cobasket.plans.export import head, write_counts_csv
from conftest import as_counts, sales_df, sql_counts


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _baskets(spark, split, path, **options):
    """30 baskets of 3 to 7 products and one of 40, each row twice."""
    rows = [(f"b{b}", str((b * 5 + 11 * j) % 23)) for b in range(30) for j in range(3 + b % 5)] + [("hot", str(j)) for j in range(40)]
    df = sales_df(spark, [*rows, *rows, (None, "1"), ("b1", None)])
    return rows, write_baskets(df, path, split=split, **options)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    return {split: _baskets(spark, split, str(tmp_path_factory.mktemp("t") / "t")) for split in (None, 20, 4)}


@pytest.mark.parametrize("split", [None, 20, 4])
@pytest.mark.parametrize("k", [1, 2, 3])
def test_counts_by_sql(tables, split, k):
    rows, table = tables[split]
    assert table.crowded_rows == {None: 0, 20: 40, 4: table.crowded().count()}[split]
    want = sql_counts(rows, k)
    assert as_counts(table.cooccurrence(k)) == want
    if k == 2:
        # light baskets above a lower threshold go through the blocked plan
        assert as_counts(table.cooccurrence(k, threshold=5)) == want
        assert as_counts(table.cooccurrence(k, plan="join")) == want
    with pytest.raises(ValueError):
        table.cooccurrence(k, plan="blocked")


def test_sizes_and_rows(spark, tmp):
    rows, table = _baskets(spark, 6, f"{tmp}/t", rows_per_bucket=10)
    sizes = {}
    for b, _ in set(rows):
        sizes[b] = sizes.get(b, 0) + 1
    assert {r.basket_id: r[SIZE] for r in table.sizes().collect()} == sizes
    assert sorted((r.basket_id, r.product_id) for r in table.rows().collect()) == sorted(set(rows))
    assert {r.basket_id for r in table.crowded().collect()} == {b for b, n in sizes.items() if n > 6}
    assert table.buckets > spark.sparkContext.defaultParallelism


@pytest.mark.parametrize("k", [1, 2, 3])
def test_a_light_count_has_one_exchange_and_no_exchange_by_basket(spark, tables, k):
    _, table = tables[None]
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", _plan(table.cooccurrence(k)))
    assert len(exchanges) == 1 and "_b" not in exchanges[0]
    assert len(re.findall(r"Exchange hashpartitioning", _plan(cooccurrence(sales_df(spark, [("a", "1")]), max(k, 2))))) == 2


def test_the_join_plan_has_no_exchange_by_basket(spark, tables):
    _, table = tables[None]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(table.cooccurrence(2, plan="join"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1


def test_sizes_are_pushed_to_the_reader(spark, tables):
    _, table = tables[None]
    plan = _plan(table.cooccurrence(3))
    assert f"GreaterThanOrEqual({SIZE},3)" in plan and f"LessThanOrEqual({SIZE}," in plan


def test_opened_by_another_session(spark, tmp):
    rows, table = _baskets(spark, 20, f"{tmp}/it's `here`")
    other = spark.newSession()
    opened = open_baskets(other, table.path)
    assert (opened.buckets, opened.crowded_rows, opened.item) == (table.buckets, 40, "product_id")
    assert as_counts(opened.cooccurrence(2)) == sql_counts(rows, 2)
    assert "Bucketed: true" in _plan(opened.cooccurrence(2))


def test_odd_names_types_and_empty_input(spark, tmp):
    df = spark.createDataFrame([(1, 2, "x"), (1, 10, "y"), (1, 10, "z"), (2, 2, None)], "`a b` long, `it em` long, basket_size string")
    table = write_baskets(df, f"{tmp}/t", "a b", "it em")
    for t in (table, open_baskets(spark, table.path)):
        assert t.cooccurrence(2).collect() == [(2, 10, 1)]
        assert sorted(t.sizes().collect()) == [(1, 2), (2, 1)]
    none = write_baskets(df.where("false"), f"{tmp}/none", "a b", "it em")
    for k in (1, 2, 3):
        assert none.cooccurrence(k).collect() == []


def test_an_unfinished_write_is_refused(spark, tables, tmp):
    _, table = tables[None]
    with pytest.raises(ValueError):
        write_baskets(sales_df(spark, [("a", "1")]).withColumnRenamed("product_id", SIZE), f"{tmp}/s", item=SIZE)
    spark.range(0).write.mode("overwrite").parquet(f"{tmp}/u/light")
    with pytest.raises(Exception, match="(?i)path"):
        open_baskets(spark, f"{tmp}/u")
    with pytest.raises(Exception, match="(?i)exist"):
        write_baskets(sales_df(spark, [("a", "1")]), table.path)


@pytest.mark.parametrize("files", [1, 40])
def test_head_reads_the_first_files_only(spark, tmp, files):
    spark.conf.set("spark.sql.shuffle.partitions", str(files))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        counts = spark.range(400).select(F.col("id").alias("product_1"), (F.col("id") + 1).alias("product_2"), (F.col("id") % 7).alias("baskets"))
        write_counts_csv(counts, f"{tmp}/c", compression="none")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    want = [tuple(r) for r in counts.selectExpr("*").collect()]
    want.sort(key=lambda r: (-r[2], str(r[0]), str(r[1])))
    for n in (1, 5, 25):
        got = head(spark, f"{tmp}/c", 2, n, "bigint")
        assert [tuple(r) for r in got.collect()] == want[:n]
        assert len(got.inputFiles()) <= n
    assert len(head(spark, f"{tmp}/c", 2, 1000, "bigint").collect()) == 400
    write_counts_csv(counts.where("false"), f"{tmp}/none")
    assert head(spark, f"{tmp}/none", 2).collect() == []
