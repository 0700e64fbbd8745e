"""Tasks follow the input: numbers of partitions, files and buckets, and the same counts by each plan."""

from __future__ import annotations

import glob
import random
from datetime import datetime, timedelta

import __spark_entry__ as entry
import pytest
from conftest import as_counts, sales_df, sql_counts
from pyspark.sql import functions as F

from cobasket.operators import cooccur, incremental
from cobasket.plans import basket_table, export
from cobasket.session import checkpoint_root


def _rows(seed: int, baskets: int = 60, items: int = 25) -> list[tuple[str, str]]:
    draw = random.Random(seed)
    rows = [(str(b), str(draw.randrange(items))) for b in range(baskets) for _ in range(draw.randrange(1, 9))]
    return rows + [("hot", "1")] * 300


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("plan", ["auto", "blocked", "join"])
@pytest.mark.parametrize("k", [2, 3])
def test_tasks_follow_rows_and_tuples(spark, monkeypatch, plan, k):
    monkeypatch.setattr(cooccur, "TASK_TUPLES", 20)
    monkeypatch.setattr(cooccur, "LEAST_ROWS", 5)
    rows = _rows(k)
    got = cooccur.cooccurrence(sales_df(spark, rows), k, plan=plan, block=4)
    assert "REPARTITION_BY_NUM" in _plan(got)
    assert as_counts(got) == sql_counts(rows, k)


def test_small_inputs_are_left_to_spark(spark):
    assert "REPARTITION_BY_NUM" not in _plan(cooccur.cooccurrence(sales_df(spark, _rows(1)), 2))
    one = sales_df(spark, _rows(1))
    assert cooccur._tasks(one, 60_000_000, 0) == 60 and cooccur._tasks(one, 1_000_000, 1e15) == 50 and cooccur._tasks(one, 0, 0) == 0


def test_parts_are_counted_apart_from_their_sum(spark):
    parts = [_rows(7), _rows(8)]
    got = incremental.merge_counts(*[cooccur.cooccurrence(sales_df(spark, p), 2) for p in parts])
    assert "REPARTITION_BY_COL" in _plan(got)
    want = sql_counts([(f"{i}-{b}", p) for i, rows in enumerate(parts) for b, p in rows], 2)
    assert as_counts(got) == want


def test_added_rows_are_found_by_tasks_that_follow_the_rows(spark, monkeypatch):
    old, new = _rows(9)[:-300], _rows(10)[:-300]
    want = sql_counts(old + new, 2)
    for b, n in sql_counts(old, 2).items():
        want[b] -= n
    delta = lambda more: incremental.count_delta(sales_df(spark, new + more), sales_df(spark, old + more), 2)
    seen, find = [], incremental.new_rows
    monkeypatch.setattr(incremental, "new_rows", lambda *a, **b: (seen.append(find(*a, **b)), seen[-1])[1])
    small = delta([])
    monkeypatch.setattr(cooccur, "TASK_TUPLES", 30)
    many, hot = delta([]), delta([("hot", "1")] * 300)
    assert ["REPARTITION_BY_NUM" in _plan(x) for x in seen] == [False, True, False]
    assert seen[1].rdd.getNumPartitions() == -(-len(old + new) // 30)
    assert as_counts(small) == as_counts(many) == as_counts(hot) == {b: n for b, n in want.items() if n}


def test_buckets_are_of_a_task_s_size():
    assert basket_table.ROWS_PER_BUCKET <= 500_000


def _lineitem(spark, path: str, files: int) -> None:
    day = datetime(2020, 11, 1)
    rows = [(i, i % 50, i % 7, 1 + i % 4, day + timedelta(days=i % 300)) for i in range(400)]
    schema = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_shipdate timestamp"
    spark.createDataFrame(rows, schema).repartition(files).write.parquet(f"{path}/lineitem.parquet")


def test_gzip_files_follow_the_rows(spark, tmp, monkeypatch):
    monkeypatch.setattr(entry, "FILE_ROWS", 30)
    rows = sales_df(spark, _rows(3))
    entry._text(rows, 2, f"{tmp}/csv")
    assert len(glob.glob(f"{tmp}/csv/*.gz")) == rows.count() // 30


def test_years_of_the_window_stream_are_not_one_file(spark, tmp):
    _lineitem(spark, tmp, 3)
    before = set(glob.glob(f"{checkpoint_root(spark).removeprefix('file:')}/window-in-*"))
    got = entry.q_stream_dedup_window(spark, tmp)
    assert got.count() == 400 and got.where("basket_id is null").count() == 0
    (inbox,) = set(glob.glob(f"{checkpoint_root(spark).removeprefix('file:')}/window-in-*")) - before
    assert len(glob.glob(f"{inbox}/lot=2020/*.parquet")) > 1


def test_both_exports_are_of_one_stored_count(spark, tmp, monkeypatch):
    _lineitem(spark, tmp, 1)
    seen, write = [], export.write_counts_csv
    monkeypatch.setattr(export, "write_counts_csv", lambda counts, *a, **b: (seen.extend(counts.inputFiles()), write(counts, *a, **b))[1])
    entry.q_export_order(spark, tmp)
    assert seen and all("pair-counts" in f for f in seen)


def test_streamed_batches_are_of_as_many_files_as_they_need(spark, tmp, monkeypatch):
    _lineitem(spark, tmp, 2)
    monkeypatch.setattr(entry, "FILE_ROWS", 40)
    seen = []

    def files(batch, batch_id):
        seen.append({f.split("/")[-1]: n for f, n in batch.groupBy(F.input_file_name()).count().collect()})

    entry._streamed(
        spark, tmp, lambda s: s.writeStream.foreachBatch(files).option("checkpointLocation", f"{tmp}/ckpt").trigger(availableNow=True).start()
    )
    assert len(seen) == 4 and all(len(batch) > 1 and max(batch.values()) < 80 for batch in seen)
    assert sum(n for batch in seen for n in batch.values()) == 600  # lines 1 to 4, then lines 3 and 4 again
    monkeypatch.undo()
    want = {(i, i % 7) for i in range(400)}
    got = [tuple(r) for r in entry.q_stream_dedup(spark, tmp).collect()]
    assert len(got) == 400 and set(got) == want


def test_a_drop_of_a_keyed_ingest_is_one_batch_of_as_many_files_as_it_needs(spark, tmp, monkeypatch):
    _lineitem(spark, tmp, 2)
    monkeypatch.setattr(entry, "FILE_ROWS", 20)
    before = set(glob.glob(f"{checkpoint_root(spark).removeprefix('file:')}/keyed-in-*"))
    got = sorted(tuple(r) for r in entry.q_keyed_ingest_runs(spark, tmp).collect())
    assert got == [(0, 401, 400, 400, 400, 1), (1, 201, 200, 0, 400, 1)]
    (inbox,) = set(glob.glob(f"{checkpoint_root(spark).removeprefix('file:')}/keyed-in-*")) - before
    assert len(glob.glob(f"{inbox}/lot=1/*.gz")) == 20
    monkeypatch.undo()
    assert sorted(tuple(r) for r in entry.q_keyed_ingest_roundtrip(spark, tmp).collect()) == [(i, i % 7) for i in range(400)]
