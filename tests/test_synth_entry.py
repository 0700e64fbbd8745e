import duckdb
from pyspark.sql import functions as F

import __spark_entry__ as E
from cobasket.operators.cooccur import cooccurrence
from cobasket.sources.synth import generate_baskets


def test_generator_shape_and_determinism(spark):
    a = generate_baskets(spark, 1, seed=3)
    sizes = a.groupBy("basket_id").agg(F.count("*").alias("n"), F.count_distinct("product_id").alias("d"))
    stats = sizes.agg(F.count("*"), F.min("n"), F.max("n"), F.sum(F.when(F.col("n") != F.col("d"), 1).otherwise(0))).first()
    assert stats[0] == 2**16 and stats[1] == 1 and stats[2] == 5 and stats[3] == 0
    prods = a.agg(F.min(F.col("product_id").cast("int")), F.max(F.col("product_id").cast("int"))).first()
    assert prods[0] >= 0 and prods[1] < 256
    b = generate_baskets(spark, 1, seed=3)
    assert a.exceptAll(b).count() == 0
    assert cooccurrence(a, 2).count() > 0


def test_entry_and_registry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["product_1", "product_2", "baskets"] and len(rows) == 10
    assert set(E.oracle_sql()) <= set(E.queries())


def test_oracle_agrees_on_smallest_tables(spark):
    """Spot check at sf0.001 for the flagship and a few cheap queries."""
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("lineitem", "orders", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    for name in ("top_pairs", "item_support", "basket_size_histogram", "shard_balance", "duplicate_rate"):
        got = sorted(tuple(r) for r in E.queries()[name](spark, sf).collect())
        exp = sorted(tuple(r) for r in con.execute(E.oracle_sql()[name]).fetchall())
        assert got == exp, name
