from __future__ import annotations

import os
import sys
import tempfile

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cobasket.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", app_name="cobasket-tests", shuffle_partitions=4)
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cobasket-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


def sales_df(spark, rows, schema="basket_id string, product_id string"):
    return spark.createDataFrame(rows, schema)


def baskets_to_rows(baskets: dict) -> list[tuple[str, str]]:
    return [(str(b), str(p)) for b, items in baskets.items() for p in items]


def sql_counts(rows, k: int) -> dict:
    """Counts by DuckDB's self-join of distinct (basket, product) rows: tuples of ints -> baskets."""
    con = duckdb.connect()
    con.execute("CREATE TABLE sales (basket VARCHAR, product BIGINT)")
    rows = [(str(b), int(p)) for b, p in rows]
    if rows:
        con.executemany("INSERT INTO sales VALUES (?, ?)", rows)
    ids = [f"t{i}.product" for i in range(k)]
    joins = "".join(f" JOIN d t{i} ON t{i}.basket = t0.basket AND t{i}.product > t{i - 1}.product" for i in range(1, k))
    sql = f"WITH d AS (SELECT DISTINCT * FROM sales) SELECT {', '.join(ids)}, count(*) FROM d t0{joins} GROUP BY ALL"
    return {tuple(r[:-1]): r[-1] for r in con.execute(sql).fetchall()}


def brute_force(baskets: dict, k: int) -> dict:
    return sql_counts(baskets_to_rows(baskets), k)


def as_counts(df) -> dict:
    k = sum(1 for c in df.columns if c.startswith("product_"))
    return {
        tuple(int(r[f"product_{i}"]) for i in range(1, k + 1)): r["baskets"] for r in df.collect()
    }
