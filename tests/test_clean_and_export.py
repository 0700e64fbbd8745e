import gzip
import os

from pyspark.sql import functions as F

from cobasket.operators.bucket import assign_shards, shard_balance, shard_integrity, shard_summary
from cobasket.operators.clean import clean_sales, sales_rejects
from cobasket.operators.cooccur import cooccurrence
from cobasket.plans.export import preview, read_counts_csv, reencode_csv, write_counts_csv, write_shards
from cobasket.sources.sales import read_sales_csv, read_shards
from conftest import as_counts, sales_df


def _write(path, text, gz=False):
    opener = gzip.open if gz else open
    with opener(path, "wt", newline="") as f:
        f.write(text)


def test_csv_edge_cases(spark, tmp):
    d = os.path.join(tmp, "in")
    os.makedirs(d)
    _write(os.path.join(d, "a.csv"),
           'b1,10\r\n"b 2",20,extra\r\nshort\r\n\r\n b1 ,\t11 \r\n"q""x",12\r\nb3,\r\n,5\r\n')
    raw = read_sales_csv(spark, d)
    got = sorted(tuple(r) for r in clean_sales(raw).collect())
    assert got == [("b 2", "20"), ("b1", "10"), ("b1", "11"), ('q"x', "12")]
    rej = {r.reason: r.rows for r in sales_rejects(raw).collect()}
    assert rej == {"missing_product": 2, "empty_basket": 1}


def test_quoted_newline_needs_multiline(spark, tmp):
    d = os.path.join(tmp, "ml")
    os.makedirs(d)
    _write(os.path.join(d, "a.csv"), '"multi\nline",7\r\nb,8\r\n')
    got = sorted(tuple(r) for r in clean_sales(read_sales_csv(spark, d, multiline=True)).collect())
    assert got == [("b", "8"), ("multi\nline", "7")]


def test_non_integer_products_rejected_when_numeric(spark):
    df = sales_df(spark, [("b", "1"), ("b", "x"), ("b", " 3 "), ("b", "1_000")])
    assert sorted(r.product_id for r in clean_sales(df, numeric_products=True).collect()) == ["1", "3"]
    rej = {r.reason: r.rows for r in sales_rejects(df, numeric_products=True).collect()}
    assert rej == {"non_integer_product": 2}


def test_whitespace_variants_are_one_basket(spark):
    df = sales_df(spark, [(" b1 ", "1"), ("b1", "2"), ("\tb1", "3"), ("b1 ", "4")])
    assert clean_sales(df).select("basket_id").distinct().count() == 1
    assert len(as_counts(cooccurrence(clean_sales(df), 2))) == 6


def test_gzip_input(spark, tmp):
    d = os.path.join(tmp, "gz")
    os.makedirs(d)
    _write(os.path.join(d, "a.csv.gz"), "b1,1\nb1,2\nb2,1\nb2,2\n", gz=True)
    assert as_counts(cooccurrence(clean_sales(read_sales_csv(spark, d)), 2)) == {(1, 2): 2}


def test_write_and_read_shards(spark, tmp):
    rows = [(f"basket-{i % 37}", str(i % 11)) for i in range(500)]
    df = sales_df(spark, rows)
    out = os.path.join(tmp, "shards")
    write_shards(df, out, 8, files_per_shard=2)
    back = read_shards(spark, out)
    assert back.count() == 500
    assert sorted(tuple(r) for r in back.select("basket_id", "product_id").collect()) == sorted(rows)
    integ = shard_integrity(back).first()
    assert (integ.baskets, integ.rows, integ.split_baskets) == (37, 500, 0)
    # the written shard equals the computed one
    expected = {r.basket_id: r.shard for r in assign_shards(df, 8).collect()}
    assert all(expected[r.basket_id] == r.shard for r in back.collect())
    # overwrite with fewer shards leaves no stale shard directory behind
    write_shards(df, out, 2)
    assert read_shards(spark, out).count() == 500
    assert {r.shard for r in read_shards(spark, out).select("shard").distinct().collect()} <= {0, 1}


def test_shard_balance_reports_empty_shards(spark):
    df = sales_df(spark, [("a", "1"), ("a", "2"), ("b", "1")])
    bal = {r.shard: r.rows for r in shard_balance(assign_shards(df, 64), 64).collect()}
    assert len(bal) == 64 and sum(bal.values()) == 3 and sum(1 for v in bal.values() if v) <= 2
    s = shard_summary(assign_shards(df, 64), 64).first()
    assert s.shards == 64 and s.out_of_range == 0 and 1 <= s.used_shards <= 2


def test_export_preview_and_reencode(spark, tmp):
    df = sales_df(spark, [("a", "1"), ("a", "2"), ("b", "1"), ("b", "2"), ("c", "2"), ("c", "3")])
    out = os.path.join(tmp, "pairs")
    write_counts_csv(cooccurrence(df, 2), out, single_file=True, line_sep="\r\n")
    part = [f for f in os.listdir(out) if f.startswith("part-")]
    assert len(part) == 1 and part[0].endswith(".csv.gz")
    with gzip.open(os.path.join(out, part[0]), "rt", newline="") as f:
        text = f.read()
    assert text.startswith("product_1,product_2,baskets\r\n1,2,2\r\n")
    assert [tuple(r) for r in preview(spark, out, 2, 1).collect()] == [("1", "2", 2)]
    assert [tuple(r) for r in preview(spark, out, 2, 1, "bigint").collect()] == [(1, 2, 2)]
    assert read_counts_csv(spark, out, 2).count() == 2
    plain = os.path.join(tmp, "plain")
    reencode_csv(spark, out, plain, "none")
    assert spark.read.text(plain).count() == 3


def test_empty_result_writes_header_only(spark, tmp):
    out = os.path.join(tmp, "empty")
    write_counts_csv(cooccurrence(sales_df(spark, [("a", "1")]), 2), out, single_file=True)
    part = [f for f in os.listdir(out) if f.startswith("part-")]
    with gzip.open(os.path.join(out, part[0]), "rt") as f:
        assert f.read().strip() == "product_1,product_2,baskets"


def test_reencode_copies_lines_as_they_are(spark, tmp):
    src, dst = os.path.join(tmp, "src"), os.path.join(tmp, "dst")
    os.makedirs(src)
    text = ' b1 ,7,extra\r\n"",\n,"",\t x\n"q""x",8\n'
    _write(os.path.join(src, "a.csv.gz"), text, gz=True)
    reencode_csv(spark, src, dst, "none")
    parts = [os.path.join(dst, f) for f in os.listdir(dst) if f.startswith("part-")]
    assert "".join(open(p, newline="").read() for p in parts) == text


def test_padded_values_keep_their_text_and_their_shard(spark, tmp):
    df = sales_df(spark, [(" b1\t", " 7 "), ("b1", "8"), ("b1 ", "")])
    write_shards(df, tmp + "/s", 16)
    back = read_shards(spark, tmp + "/s")
    assert sorted((r.basket_id, r.product_id) for r in back.collect() if r.product_id) == [(" b1\t", " 7 "), ("b1", "8")]
    assert back.select("shard").distinct().count() == 1


def test_a_repeated_row_spreads_over_files(spark, tmp):
    df = spark.range(4000).select(F.lit("b").alias("basket_id"), F.lit("1").alias("product_id"))
    write_shards(df, tmp + "/s", 1, files_per_shard=8)
    sizes = [r.n for r in read_shards(spark, tmp + "/s").groupBy("_metadata.file_name").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) == 8 and max(sizes) < 1.5 * min(sizes)


def test_text_ids_survive_an_export(spark, tmp):
    df = sales_df(spark, [("a", "01"), ("a", "2"), ("b", "01"), ("b", "2"), ("c", "1"), ("c", "x y")])
    write_counts_csv(cooccurrence(df, 2, strict=False), tmp + "/p")
    assert sorted(map(tuple, read_counts_csv(spark, tmp + "/p", 2).collect())) == [("01", "2", 2), ("1", "x y", 1)]


def test_files_with_duplicates_are_named_after_their_inputs(spark, tmp):
    from cobasket.plans.export import write_with_dups

    for name in ("one.csv", "two.csv"):
        _write(os.path.join(tmp, name), "".join(f"{name}{i},{i}\n" for i in range(500)))
    out = write_with_dups(spark, [tmp + "/one.csv", tmp + "/two.csv"], tmp + "/out", ratio=0.2)
    assert [os.path.basename(p) for p in out] == ["one_with_dups", "two_with_dups"]
    counts = read_sales_csv(spark, out).groupBy("basket_id").count().collect()
    assert len(counts) == 1000 and {r["count"] for r in counts} == {1, 2} and 120 < sum(r["count"] for r in counts) - 1000 < 280
