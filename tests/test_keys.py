import hashlib

from pyspark.sql import functions as F

from cobasket.functions.keys import hash_fraction, md5_shard, sortable_item, strip_space


def _py_shard(x: str, n: int) -> int:
    return int(hashlib.md5(x.encode()).hexdigest(), 16) % n


def test_md5_shard_matches_hashlib(spark):
    ids = [f"basket-{i}" for i in range(300)] + ["a", "b", "", "ünïcode", "some-uuid-xyz"]
    df = spark.createDataFrame([(x,) for x in ids], "k string")
    for n in (1, 2, 4, 7, 16, 256, 2**31 - 1):
        got = {r.k: r.s for r in df.select("k", md5_shard("k", n).alias("s")).collect()}
        assert got == {x: _py_shard(x, n) for x in ids}


def test_md5_shard_of_integers_uses_decimal_text(spark):
    df = spark.createDataFrame([(i,) for i in (0, 7, 123, 10**12)], "k bigint")
    got = {r.k: r.s for r in df.select("k", md5_shard("k", 16).alias("s")).collect()}
    assert got == {i: _py_shard(str(i), 16) for i in (0, 7, 123, 10**12)}


def test_single_shard_is_zero_and_range(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("k"))
    assert {r.s for r in df.select(md5_shard("k", 1).alias("s")).collect()} == {0}
    shards = [r.s for r in df.select(md5_shard("k", 16).alias("s")).collect()]
    assert min(shards) >= 0 and max(shards) < 16 and len(set(shards)) == 16
    per = [shards.count(i) for i in range(16)]
    assert max(per) < 2 * (len(shards) / 16)


def test_strip_space_unicode(spark):
    df = spark.createDataFrame([(" b1 ",), ("\tb1 ",), ("b1",), ("b 1",)], "k string")
    assert [r.v for r in df.select(strip_space("k").alias("v")).collect()] == ["b1", "b1", "b1", "b 1"]


def test_sortable_item_orders_numbers_then_text(spark):
    df = spark.createDataFrame([("10",), ("2",), ("1",), ("01",)], "p string")
    got = [r.p for r in df.orderBy(sortable_item(df, "p")).collect()]
    assert got == ["01", "1", "2", "10"]


def test_hash_fraction_in_unit_interval(spark):
    df = spark.range(1000).select(hash_fraction(F.lit(42), "id").alias("f"))
    vals = [r.f for r in df.collect()]
    assert all(0.0 <= v < 1.0 for v in vals)
    assert 0.4 < sum(vals) / len(vals) < 0.6
