from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from cobasket.operators import dedup
from cobasket.operators.cooccur import cooccurrence
from cobasket.plans import export
from cobasket.sources.sales import SALES_SCHEMA
from cobasket.streaming import ingest_stream
from conftest import sales_df


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_draws_do_not_depend_on_order_or_partitions(spark):
    rows = [(f"b{i % 50}", str(i % 3)) for i in range(900)] + [(None, "1"), ("b", None)] * 20
    a = sales_df(spark, rows)
    b = sales_df(spark, random.Random(4).sample(rows, len(rows))).repartition(7)
    drawn = [_rows(dedup.inject_by_occurrence(x, 0.3, 9, scramble=s)) for x, s in ((a, False), (b, False), (b, True))]
    assert drawn[0] == drawn[1] == drawn[2]
    assert len(rows) + 200 < len(drawn[0]) < len(rows) + 380
    # every occurrence has a draw of its own: no row has only all or none of its copies drawn
    extra = {r: drawn[0].count(r) - rows.count(r) for r in set(rows)}
    assert all(0 <= n <= rows.count(r) for r, n in extra.items()) and any(0 < n < rows.count(r) for r, n in extra.items())
    assert _rows(dedup.inject_by_occurrence(a, 0.0)) == sorted(rows, key=str)
    assert len(_rows(dedup.inject_by_occurrence(a, 1.0))) == 2 * len(rows)
    with pytest.raises(ValueError):
        dedup.inject_by_occurrence(a, 1.5)


def test_a_row_of_very_many_copies_is_expanded_by_parts(spark, monkeypatch):
    monkeypatch.setattr(dedup, "COPIES", 100)
    df = spark.range(1050).select(F.lit("hot").alias("basket_id"), F.lit("1").alias("product_id"))
    assert dedup.inject_by_occurrence(df, 0.0).count() == 1050
    assert dedup.inject_by_occurrence(df, 1.0).count() == 2100


IDS = ["-" + "9" * 30, "-" + "1" * 21, "-" + "1" * 20, "-5", "0", "7", "007", "12", str(2**63 - 1), str(2**63), "0" + str(2**63), str(10**25), str(10**25 + 1), "9" * 40]


def test_ids_of_any_length_are_ordered_by_value(spark):
    order = sorted(IDS, key=lambda s: (int(s), s))
    df = sales_df(spark, [("b", i) for i in random.Random(2).sample(IDS, len(IDS))])
    got = {(r.product_1, r.product_2) for r in cooccurrence(df, 2).collect()}
    assert got == {(a, b) for n, a in enumerate(order) for b in order[n + 1 :]}
    for plan in ("join", "blocked"):
        assert {(r.product_1, r.product_2) for r in cooccurrence(df, 2, plan=plan).collect()} == got


def test_text_ids_fail_or_come_last(spark):
    df = sales_df(spark, [("b", "x"), ("b", "9" * 30), ("b", "3")])
    with pytest.raises(Exception, match="not an integer"):
        cooccurrence(df, 2).collect()
    got = {(r.product_1, r.product_2) for r in cooccurrence(df, 2, strict=False).collect()}
    assert got == {("3", "9" * 30), ("3", "x"), ("9" * 30, "x")}


def _export(spark, tmp, files):
    os.makedirs(tmp)
    for n, rows in enumerate(files):
        with open(f"{tmp}/part-{n:05d}.csv", "w") as f:
            f.write("product_1,product_2,baskets\n" + "".join(f"{a},{b},{c}\n" for a, b, c in rows))
    r = export.order_check(spark, tmp, 2).first()
    return r.rows, r.violations


def test_violations_of_order_are_counted_within_and_across_files(spark, tmp):
    good = [("1", "2", 9), ("1", "3", 9), ("10", "2", 9), ("2", "3", 9), ("1", "4", 5)]
    assert _export(spark, f"{tmp}/a", [good[:2], good[2:]]) == (5, 0)
    assert _export(spark, f"{tmp}/b", [good[2:], good[:2]]) == (5, 1)  # where the files meet
    assert _export(spark, f"{tmp}/c", [good[::-1]]) == (5, 4)
    assert _export(spark, f"{tmp}/d", [[good[0]], [good[2]], [good[1]]]) == (3, 1)


def test_a_ranked_export_is_in_order_on_disk(spark, tmp):
    draw = random.Random(8)
    rows = [(str(i), str(draw.randint(1, 30))) for i in range(400) for _ in range(4)]
    counts = cooccurrence(sales_df(spark, rows), 2)
    export.write_counts_csv(counts, f"{tmp}/ranked")
    r = export.order_check(spark, f"{tmp}/ranked", 2).first()
    assert (r.rows, r.violations) == (counts.count(), 0)


def test_files_of_late_duplicates_by_their_arrival(spark, tmp):
    inbox, table, ckpt = f"{tmp}/in", f"{tmp}/table", f"{tmp}/ckpt"
    os.makedirs(inbox)
    begin = 1_700_000_000
    # b1 comes again after a minute, and once more when it has been forgotten
    for n, (rows, minute) in enumerate([([("b1", "1"), ("b1", "1")], 0), ([("b1", "1"), ("b2", "1")], 1), ([("b3", "1")], 600), ([("b4", "1")], 1200), ([("b1", "1")], 1800)]):
        with open(f"{inbox}/{n}.csv", "w") as f:
            f.write("".join(f"{b},{p}\n" for b, p in rows))
        os.utime(f"{inbox}/{n}.csv", (begin + 60 * minute,) * 2)
    stream = ingest_stream.file_stream(spark, inbox, "csv", SALES_SCHEMA, max_files_per_trigger=1, arrival="arrived_at")
    run = ingest_stream.start_dedup_stream(stream, table, ckpt, mode="window", event_time="arrived_at", delay="10 minutes")
    ingest_stream.run_to_completion(run)
    assert _rows(spark.read.parquet(table)) == [("b1", "1"), ("b1", "1"), ("b2", "1"), ("b3", "1"), ("b4", "1")]
    assert run.lastProgress.stateOperators[0].numRowsTotal <= 2
    with pytest.raises(ValueError):
        ingest_stream.start_dedup_stream(stream, table, ckpt, mode="window")
