import os
import random

from pyspark.sql import functions as F

from cobasket.operators.cooccur import cooccurrence
from cobasket.operators.incremental import count_delta, merge_counts, update_counts
from cobasket.operators.quality import closure_missing, lookup_counts, reconcile, run_ratio
from cobasket.sources.sales import SALES_SCHEMA
from cobasket.streaming import ingest_stream, pair_counts
from conftest import as_counts, baskets_to_rows, brute_force, sales_df


def _random_rows(seed, n_baskets=60, n_products=12):
    rng = random.Random(seed)
    b = {f"b{i}": rng.sample(range(n_products), rng.randint(1, 5)) for i in range(n_baskets)}
    return b, baskets_to_rows(b)


def test_merged_parts_equal_the_whole_and_cancel_out(spark):
    _, rows = _random_rows(8)
    keyed = lambda even: sales_df(spark, [r for r in rows if (int(r[0][1:]) % 2 == 0) == even])
    whole = cooccurrence(sales_df(spark, rows), 2)
    merged = merge_counts(cooccurrence(keyed(True), 2), cooccurrence(keyed(False), 2))
    assert as_counts(merged) == as_counts(whole)
    # counts taken away again leave no rows of zero
    taken = whole.select("product_1", "product_2", (-F.col("baskets")).alias("baskets"))
    assert merge_counts(merged, taken).count() == 0


def test_update_counts_equals_recompute(spark):
    _, rows = _random_rows(3)
    old_rows, new_rows_ = rows[: len(rows) // 2], rows[len(rows) // 3:]
    old, new = sales_df(spark, old_rows), sales_df(spark, new_rows_)
    stored = cooccurrence(old, 2)
    full = cooccurrence(old.unionByName(new), 2)
    for k in (2, 3):
        got = update_counts(cooccurrence(old, k), new, old, k)
        assert as_counts(got) == as_counts(cooccurrence(old.unionByName(new), k))
    # a batch that only repeats old rows changes nothing
    assert count_delta(old, old, 2).count() == 0
    assert as_counts(update_counts(stored, new, old, 2)) == as_counts(full)


def test_reconcile_is_two_sided(spark):
    schema = "product_1 bigint, product_2 bigint, baskets bigint"
    a = spark.createDataFrame([(1, 2, 3), (1, 3, 1)], schema)
    b = spark.createDataFrame([(1, 2, 3), (1, 3, 2), (2, 3, 1)], schema)
    r = reconcile(a, b, ["product_1", "product_2"]).first()
    assert (r.matched, r.mismatched, r.left_only, r.right_only) == (1, 1, 0, 1)
    got = {(x.product_1, x.product_2): x.actual for x in lookup_counts(b, a, ["product_1", "product_2"]).collect()}
    assert got == {(1, 2): 3, (1, 3): 1, (2, 3): 0}


def test_closure_finds_each_pair_that_triples_need(spark):
    baskets = {f"c{i}": [i % 4, 4 + i % 3, 7 + i % 2] for i in range(24)} | {"pair": [0, 1]}
    df = sales_df(spark, baskets_to_rows(baskets))
    triples, pairs = cooccurrence(df, 3), cooccurrence(df, 2)
    r = closure_missing(triples, pairs).first()
    assert (r.missing, r.undercounted) == (0, 0) and r.subsets_checked == 3 * r.tuples
    first = F.col("product_1") == "0"
    # (0, 4) is part of triples and (0, 1) of none
    assert closure_missing(triples, pairs.where(~(first & (F.col("product_2") == "4")))).first().missing > 0
    assert closure_missing(triples, pairs.where(~(first & (F.col("product_2") == "1")))).first().missing == 0
    low = pairs.withColumn("baskets", F.when(first & (F.col("product_2") == "4"), 0).otherwise(F.col("baskets")))
    assert closure_missing(triples, low).first().undercounted > 0


def test_run_ratio(spark):
    m = spark.createDataFrame([(1, 10), (2, 20), (3, 0), (4, 5)], "scale int, t bigint")
    got = [(r.scale, r.ratio) for r in run_ratio(m, "scale", "t").orderBy("scale").collect()]
    assert got == [(1, None), (2, 2.0), (3, 0.0), (4, None)]


def _csv(path, name, rows):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("".join(f"{b},{p}\n" for b, p in rows))


def test_stream_dedup_matches_batch(spark, tmp):
    inbox = os.path.join(tmp, "inbox")
    rows1 = [("a", "1"), ("a", "1"), ("a", "2")]
    rows2 = [("a", "2"), ("b", "3")]
    for mode in ("table", "state"):
        table, ckpt = os.path.join(tmp, f"t-{mode}"), os.path.join(tmp, f"c-{mode}")
        src_dir = os.path.join(inbox, mode)
        _csv(src_dir, "1.csv", rows1)
        for extra in (None, rows2):
            if extra:
                _csv(src_dir, "2.csv", extra)
            s = ingest_stream.file_stream(spark, src_dir, "csv", SALES_SCHEMA, glob="*.csv")
            ingest_stream.run_to_completion(ingest_stream.start_dedup_stream(s, table, ckpt, mode=mode))
        got = sorted(tuple(r) for r in spark.read.parquet(table).collect())
        assert got == [("a", "1"), ("a", "2"), ("b", "3")], mode


def test_stream_pair_counts_match_batch_and_survive_replay(spark, tmp):
    baskets, rows = _random_rows(11, 80, 10)
    inbox = os.path.join(tmp, "inbox")
    rows_path, counts_path, ckpt = (os.path.join(tmp, x) for x in ("rows", "counts", "ckpt"))
    third = len(rows) // 3
    parts = [rows[:third], rows[third - 5: 2 * third], rows[2 * third:]]
    for i, part in enumerate(parts):
        _csv(inbox, f"{i}.csv", part)
        s = ingest_stream.file_stream(spark, inbox, "csv", SALES_SCHEMA, glob="*.csv", max_files_per_trigger=1)
        ingest_stream.run_to_completion(pair_counts.start_pair_count_stream(s, rows_path, counts_path, ckpt, 2))
    counts = pair_counts.read_counts(spark, counts_path, 2, item_type=SALES_SCHEMA["product_id"].dataType)
    assert as_counts(counts) == brute_force(baskets, 2)
    # replaying batch 1 rewrites its partitions instead of adding twice
    pair_counts.apply_batch(sales_df(spark, parts[1]), 1, rows_path, counts_path, 2)
    counts = pair_counts.read_counts(spark, counts_path, 2, item_type=SALES_SCHEMA["product_id"].dataType)
    assert as_counts(counts) == brute_force(baskets, 2)
    snap = os.path.join(tmp, "snap")
    string = SALES_SCHEMA["product_id"].dataType
    pair_counts.compact_counts(spark, counts_path, 2, 1, snap, item_type=string)
    assert as_counts(pair_counts.read_counts(spark, snap, 2, item_type=string)) == brute_force(baskets, 2)
    assert spark.read.parquet(snap).where("batch_id <= 1").select("batch_id").distinct().count() == 1


def test_flagged_counts_all_plans(spark):
    import pytest  # noqa: F401
    baskets, rows = _random_rows(21, 40, 9)
    old_rows, new_rows_ = rows[::2], rows[1::2]
    old, new = sales_df(spark, old_rows), sales_df(spark, new_rows_)
    full = {}
    for k in (1, 2, 3):
        expected = as_counts(
            merge_counts(cooccurrence(old.unionByName(new), k), cooccurrence(old, k).selectExpr(
                *[f"product_{i}" for i in range(1, k + 1)], "-baskets AS baskets"))
        )
        for plan in ("auto", "array", "join", "blocked"):
            got = as_counts(count_delta(new, old, k, plan=plan, heavy_threshold=2, block=2))
            assert got == expected, (k, plan)
        assert as_counts(count_delta(new, old, k, new_is_small=True)) == expected
        full[k] = expected


def test_multiset_diff_counts_multiplicity(spark):
    from cobasket.operators.quality import multiset_diff

    a = sales_df(spark, [("a", "1"), ("a", "1"), ("b", None)])
    b = sales_df(spark, [("a", "1"), ("b", None), ("c", "2")])
    r = multiset_diff(a, b).first()
    assert (r.left_extra, r.right_extra) == (1, 1)
    assert tuple(multiset_diff(a, a).first()) == (0, 0)


def test_skew_report(spark):
    from cobasket.operators.quality import skew_report

    baskets = {str(i): [0, 1] + ([2] if i < 3 else []) for i in range(100)}
    df = sales_df(spark, baskets_to_rows(baskets))
    r = skew_report(cooccurrence(df, 2), cooccurrence(df, 2, plan="join")).first()
    assert (r.dominant_1, r.dominant_2, r.dominant_baskets, r.pairs, r.mismatches) == ("0", "1", 100, 3, 0)


def test_update_counts_basket_heavy_only_when_combined(spark):
    old_b = {"hot": list(range(0, 30)), "a": [1, 2]}
    new_b = {"hot": list(range(30, 60)), "a": [3]}
    old, new = sales_df(spark, baskets_to_rows(old_b)), sales_df(spark, baskets_to_rows(new_b))
    stored = cooccurrence(old, 2)
    got = update_counts(stored, new, old, 2, heavy_threshold=40, block=8)
    full = {"hot": list(range(60)), "a": [1, 2, 3]}
    assert as_counts(got) == brute_force(full, 2)
