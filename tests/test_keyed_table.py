from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from cobasket.operators.cooccur import cooccurrence
from cobasket.plans.keyed_table import KeyedTable, one_of, pushed_values
from cobasket.sources.sales import SALES_SCHEMA
from cobasket.streaming import ingest_stream, keyed_ingest
from conftest import as_counts, sales_df

SCHEMA = "basket_id string, product_id string"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _scans(df):
    """(files, rows) that each file scan of a plan read when ``df`` was collected."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if "QueryStage" in name:
            todo.append(node.plan())
        if name.startswith("Scan parquet"):
            metrics = node.metrics()
            found.append((metrics.apply("numFiles").value(), metrics.apply("numOutputRows").value()))
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


@pytest.fixture(scope="module")
def many_files(spark, tmp_path_factory):
    """A table of 40,000 rows of 10,000 baskets in 256 folders."""
    table = KeyedTable(spark, str(tmp_path_factory.mktemp("big")), SALES_SCHEMA, key="basket_id", target_rows=200)
    rows = spark.range(40_000).select((F.col("id") % 10_000).cast("string").alias("basket_id"), F.xxhash64("id").cast("string").alias("product_id"))
    table.append(0, rows, expected=40_000)
    return table


def test_a_small_drop_opens_few_files_and_reads_few_rows(spark, many_files):
    (s,) = many_files.segments()
    assert s.rows == 40_000 and s.depth == 8
    whole = _scans(many_files.read())
    assert whole[0][0] >= 256 and whole[0][1] == 40_000
    drop = spark.range(20).select((F.col("id") * 499).cast("string").alias("basket_id"))
    with pushed_values(spark, 20):
        near = many_files.near(drop)
        (files, rows) = _scans(near)[0]
        assert near.count() == 80
    assert files <= 20 and rows < 40_000 / 5


def test_a_pushed_filter_skips_row_groups(spark, tmp):
    # segments of one folder each: what can't hold the keys is left out by dictionaries and Bloom filters
    table = KeyedTable(spark, tmp, SALES_SCHEMA, key="basket_id", fanout=20)
    for b in range(6):
        rows = spark.range(3000).select(F.concat(F.lit(f"{b}-"), "id").alias("basket_id"), F.lit("1").alias("product_id"))
        table.append(b, rows.coalesce(1), expected=3000)
    drop = spark.range(15).select(F.concat(F.lit("4-"), F.col("id") * 100).alias("basket_id"))
    with pushed_values(spark, 15):
        scans = _scans(table.near(drop))
    assert sum(rows for _, rows in scans) <= 3000 and table.rows() == 18_000


def test_near_holds_all_rows_of_the_keys_whatever_their_number(spark, many_files):
    for n, limit in ((5, 2048), (300, 100), (0, 10)):
        keys = spark.range(n).select((F.col("id") * 31).cast("string").alias("basket_id"))
        near = many_files.near(keys, max_keys=limit)
        got = near.join(keys, "basket_id")
        assert got.count() == 4 * n and got.select("basket_id").distinct().count() == n


def test_texts_with_quotes_and_null_keys_are_found(spark, tmp):
    odd = ["it's", 'a "b"', "back\\slash", "new\nline", "é中", "", None, "%_", "1"]
    table = KeyedTable(spark, tmp, SALES_SCHEMA, key="basket_id", target_rows=2)
    table.append(0, sales_df(spark, [(b, "1") for b in odd]), expected=9)
    for b in odd:
        near = table.near(sales_df(spark, [(b, "x")]))
        assert near.where(F.col("basket_id").eqNullSafe(F.lit(b))).count() == 1, b
    assert table.near(sales_df(spark, [(b, "x") for b in odd])).count() == 9
    assert spark.range(3).where(one_of("id", [])).count() == 0


def test_segments_stay_few_and_replays_append_nothing(spark, tmp):
    table = KeyedTable(spark, tmp, SALES_SCHEMA, key="basket_id", fanout=3, keep_batches=True)
    for b in range(10):
        assert table.append(b, sales_df(spark, [(f"b{b}", "1"), (f"b{b}", "2")])) == 2
        live = table.segments()
        assert len(live) <= 2 * 3 and sum(s.rows for s in live) == 2 * (b + 1) == table.rows()
        assert [s.first for s in live] == sorted(s.first for s in live)
        assert [x for s in live for x in range(s.first, s.last + 1)] == list(range(b + 1))
    want = sorted((f"b{b}", p, b) for b in range(10) for p in "12")
    assert _rows(table.read()) == want
    again = KeyedTable(spark, tmp, SALES_SCHEMA, key="basket_id", fanout=3, keep_batches=True)
    for b in (0, 5, 9):
        assert again.covers(b) and again.append(b, sales_df(spark, [("other", "1")])) == 0
    assert not again.covers(10) and again.last_batch() == 9
    assert _rows(again.read()) == want
    # merged segments are named as unused, live ones are not
    unused = again.unused()
    assert unused and not any(u.endswith(s.name) for u in unused for s in again.segments())
    with pytest.raises(ValueError):
        # numbers rise; a gap that was passed over can't be filled
        KeyedTable(spark, f"{tmp}/gap", SALES_SCHEMA).append(5, sales_df(spark, [("a", "1")]))
        KeyedTable(spark, f"{tmp}/gap", SALES_SCHEMA).append(4, sales_df(spark, [("a", "1")]))


def test_a_write_that_was_not_committed_leaves_the_table_as_it_was(spark, tmp, monkeypatch):
    table = KeyedTable(spark, tmp, SALES_SCHEMA, key="basket_id")
    table.append(0, sales_df(spark, [("a", "1")]))
    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            table.append(1, sales_df(spark, [("b", "1")]))
    fresh = KeyedTable(spark, tmp, SALES_SCHEMA, key="basket_id")
    assert _rows(fresh.read()) == [("a", "1")] and len(fresh.unused()) == 1
    assert fresh.append(1, sales_df(spark, [("b", "1")])) == 1
    assert _rows(fresh.read()) == [("a", "1"), ("b", "1")]


def test_an_empty_table_and_empty_batches(spark, tmp):
    table = KeyedTable(spark, tmp, SALES_SCHEMA, key="basket_id")
    assert table.read().collect() == [] and table.near(sales_df(spark, [("a", "1")])).collect() == []
    assert table.segments() == [] and table.rows() == 0 and table.last_batch() is None and table.unused() == []
    assert table.append(0, sales_df(spark, [])) == 0 and table.covers(0) and table.rows() == 0
    assert table.append(1, sales_df(spark, [("a", "1")])) == 1 and _rows(table.read()) == [("a", "1")]


def test_counts_after_many_batches_and_a_replay_across_a_merge(spark, tmp):
    rows = keyed_ingest.sales_table(spark, f"{tmp}/rows", keep_batches=True, fanout=2)
    counts = keyed_ingest.counts_table(spark, f"{tmp}/counts", 2, SALES_SCHEMA["product_id"].dataType, fanout=2)
    batches = []
    for b in range(9):
        # baskets come back in later batches, and so do some of their rows
        batches.append([(f"k{(b * 3 + i) % 11}", str((b + 2 * i) % 9)) for i in range(5)])
        keyed_ingest.apply_batch(sales_df(spark, batches[-1]), b, rows, counts, 2)
        assert max(len(rows.segments()), len(counts.segments())) <= 3
    whole = sales_df(spark, [r for b in batches for r in b])
    want = as_counts(cooccurrence(whole, 2))
    assert as_counts(keyed_ingest.read_counts(counts)) == want
    for b in (0, 5, 8):
        keyed_ingest.apply_batch(sales_df(spark, batches[b]), b, rows, counts, 2)
    assert as_counts(keyed_ingest.read_counts(counts)) == want
    assert rows.rows() == whole.distinct().count()


def test_counts_go_on_where_only_the_rows_were_committed(spark, tmp):
    rows = keyed_ingest.sales_table(spark, f"{tmp}/rows", keep_batches=True, fanout=2)
    counts = keyed_ingest.counts_table(spark, f"{tmp}/counts", 2, SALES_SCHEMA["product_id"].dataType, fanout=2)
    parts = [[("a", "1"), ("a", "2"), ("b", "1")], [("b", "2"), ("a", "3")]]
    keyed_ingest.apply_batch(sales_df(spark, parts[0]), 0, rows, counts, 2)
    # the rows of batch 1 are there, and merged, but the job died before its counts
    rows.append(1, sales_df(spark, parts[1]))
    assert [s.level for s in rows.segments()] == [1]
    keyed_ingest.apply_batch(sales_df(spark, parts[1]), 1, rows, counts, 2)
    assert as_counts(keyed_ingest.read_counts(counts)) == {(1, 2): 2, (1, 3): 1, (2, 3): 1}


def _csv(path, name, rows):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("".join(f"{b},{p}\n" for b, p in rows))


def test_streamed_ingest_reports_each_batch_and_survives_restarts(spark, tmp):
    inbox, ckpt = f"{tmp}/in", f"{tmp}/ckpt"
    table, outcomes = keyed_ingest.sales_table(spark, f"{tmp}/table"), keyed_ingest.outcomes_table(spark, f"{tmp}/outcomes")

    def run():
        stream = ingest_stream.file_stream(spark, inbox, max_files_per_trigger=1)
        ingest_stream.run_to_completion(keyed_ingest.start_ingest(stream, table, outcomes, ckpt, numeric_products=True))

    _csv(inbox, "1.csv", [(" a", "1"), ("a", "1"), ("a", "2\t"), ("", "1"), ("b", ""), ("b", "x")])
    run()
    run()  # nothing new
    _csv(inbox, "2.csv", [("a", "2"), ("b", "3"), ("b", "3"), ("c", " ")])
    table.refresh()
    run()
    got = {r.batch_id: r for r in outcomes.read().collect()}
    assert sorted(got) == [0, 1]
    first, second = got[0], got[1]
    assert (first.rows_read, first.distinct_rows, first.rows_appended, first.table_rows) == (6, 2, 2, 2)
    assert first.rejected == {"empty_basket": 1, "missing_product": 1, "non_integer_product": 1}
    assert (second.rows_read, second.distinct_rows, second.rows_appended, second.table_rows, second.rejected) == (4, 2, 1, 3, {"missing_product": 1})
    assert _rows(table.read()) == [("a", "1"), ("a", "2"), ("b", "3")]
    # a batch that comes again appends and reports nothing
    assert keyed_ingest.ingest_batch(sales_df(spark, [("z", "9")]), 1, table, outcomes) is None
    assert table.rows() == 3


def test_a_drop_is_parsed_once(spark, tmp):
    _csv(f"{tmp}/in", "1.csv", [("a", "1"), ("a", "1"), ("b", "x")])
    from cobasket.sources.sales import read_sales_csv

    touched = spark.sparkContext.accumulator(0)
    seen = F.udf(lambda v: touched.add(1) or v)  # counts how often a row is read
    raw = read_sales_csv(spark, f"{tmp}/in").select(seen("basket_id").alias("basket_id"), "product_id")
    table = keyed_ingest.sales_table(spark, f"{tmp}/table")
    outcome = keyed_ingest.ingest_batch(raw, 0, table)
    assert (outcome.rows_read, outcome.rows_appended, touched.value) == (3, 2, 3)


def test_keys_of_a_large_drop_are_not_told_apart(spark, tmp, monkeypatch):
    table = KeyedTable(spark, f"{tmp}/t", SALES_SCHEMA, key="basket_id", target_rows=10)
    table.append(0, sales_df(spark, [(str(i), "1") for i in range(80)] + [(None, "2")]), expected=80)
    drop = sales_df(spark, [(str(i), "1") for i in range(0, 80, 2)] + [(None, "3")])
    want = _rows_of_keys(table, drop)
    asked, distinct = [], type(drop).distinct
    monkeypatch.setattr(type(drop), "distinct", lambda self: (asked.append(self.columns), distinct(self))[1])
    few = table.near(drop, max_keys=50)
    assert ["k", "h"] in asked
    asked.clear()
    many = table.near(drop, max_keys=3)
    assert asked == [["p"]]
    monkeypatch.undo()
    for near in (few, many):
        assert _rows_of_keys(near, drop) == want and len(want) == 41


def _rows_of_keys(table, keys):
    """Rows of a table, or a part of it, that have one of the keys, sorted."""
    rows = table.read() if isinstance(table, KeyedTable) else table
    named = {r.basket_id for r in keys.collect()}
    return sorted((tuple(r) for r in rows.collect() if r.basket_id in named), key=str)
