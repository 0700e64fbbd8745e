"""Whole pipelines: CSV drop -> shard dataset -> counts -> ranked export -> preview."""

import gzip
import os

from cobasket.operators.bucket import shard_integrity, shard_summary
from cobasket.operators.clean import clean_sales
from cobasket.operators.cooccur import cooccurrence
from cobasket.plans.export import preview, write_counts_csv, write_shards
from cobasket.sources.sales import read_sales_csv, read_shard_files, read_shards
from conftest import as_counts, sql_counts


def _pipeline(spark, tmp, lines, shards, k=2):
    """Lines of a drop, written as they are, cleaned, sharded, read back and counted."""
    src = os.path.join(tmp, "in")
    os.makedirs(src, exist_ok=True)
    with open(os.path.join(src, "sales.csv"), "w", newline="") as f:
        f.write("".join(lines))
    shard_dir = os.path.join(tmp, "shards")
    write_shards(clean_sales(read_sales_csv(spark, src)), shard_dir, shards)
    back = read_shards(spark, shard_dir)
    return back, cooccurrence(back, k)


def test_padded_and_repeated_lines_meet_in_one_basket(spark, tmp):
    lines = ["\u00a0b1\t,7\r\n", "b1,7\r\n", " b1, 8\r\n", "b2,7,more\r\n", '"b2",8\r\n', "b3\r\n", ",9\r\n"]
    back, pairs = _pipeline(spark, tmp, lines * 3, 5)
    assert as_counts(pairs) == {(7, 8): 2}
    integrity = shard_integrity(back).first()
    assert (integrity.baskets, integrity.rows, integrity.split_baskets) == (2, 15, 0)


def test_a_heavy_basket_through_the_whole_pipeline(spark, tmp):
    rows = [("all", p) for p in range(90)] * 2 + [(f"b{i}", p) for i in range(45) for p in (i, (i * 11) % 90)]
    back, _ = _pipeline(spark, tmp, [f"{b},{p}\n" for b, p in rows], 3)
    got = as_counts(cooccurrence(back, 2, heavy_threshold=20, block=16))
    assert got == sql_counts(rows, 2)
    summary = shard_summary(back, 3).first()
    assert summary.out_of_range == 0 and summary.max_rows >= 180


def test_shard_files_of_another_writer(spark, tmp):
    for i, rows in enumerate(["a,1\na,2\n", "", "b,2\nb,1\n"]):
        opener = gzip.open if i else open
        with opener(os.path.join(tmp, f"shard_{i:04d}.csv" + (".gz" if i else "")), "wt") as f:
            f.write(rows)
    back = read_shard_files(spark, tmp)
    assert {(r.basket_id, r.shard) for r in back.collect()} == {("a", 0), ("b", 2)}
    assert as_counts(cooccurrence(back, 2)) == {(1, 2): 2}


def test_triple_export_header_and_preview(spark, tmp):
    _, triples = _pipeline(spark, tmp, ["only,1\n", "only,2\n", "only,3\n"], 4, k=3)
    out = os.path.join(tmp, "triples")
    write_counts_csv(triples, out, single_file=True)
    part = [f for f in os.listdir(out) if f.startswith("part-")][0]
    with gzip.open(os.path.join(out, part), "rt") as f:
        lines = f.read().splitlines()
    assert lines == ["product_1,product_2,product_3,baskets", "1,2,3,1"]
    assert [tuple(r) for r in preview(spark, out, 3, 10).collect()] == [("1", "2", "3", 1)]
