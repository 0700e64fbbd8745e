import os

from cobasket.session import checkpoint_root, scratch_path
from cobasket.sources.sales import SALES_SCHEMA, list_files, read_table_or_empty


def test_scratch_paths_live_under_the_session_checkpoint_dir(spark):
    root = checkpoint_root(spark)
    assert root == spark.sparkContext.getCheckpointDir().rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root + "/x-") and b.startswith(root + "/x-")


def test_missing_table_reads_as_empty(spark, tmp):
    df = read_table_or_empty(spark, os.path.join(tmp, "absent"), SALES_SCHEMA)
    assert df.count() == 0 and df.schema == SALES_SCHEMA


def test_listing_keeps_csv_and_csv_gz_only(spark, tmp):
    for name in ("a.csv", "b.csv.gz", "c.txt", "d.csv.bak", "_SUCCESS"):
        with open(os.path.join(tmp, name), "w") as f:
            f.write("x,1\n")
    names = sorted(os.path.basename(r.path) for r in list_files(spark, tmp).collect())
    assert names == ["a.csv", "b.csv.gz"]
