"""Session helpers: a configured SparkSession and a shared scratch folder.

Library functions never create or stop sessions on their own; they take the
caller's session. ``get_session`` is a convenience for tests, the bench and
scripts.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings that matter for every plan in this package. AQE coalesces small
# shuffle partitions, splits skewed join partitions and turns joins into
# broadcasts only after it has measured the smaller side at run time.
_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(
    master: str | None = None,
    app_name: str = "cobasket",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return (or create) a session with the package defaults applied.

    On a cluster, leave ``master`` and ``shuffle_partitions`` unset so the
    submit-time configuration wins.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be a path every executor can reach (HDFS, S3, a
    shared mount), and a session without one is refused. Only a ``local``
    session, whose executor is the driver, gets a fresh temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="cobasket-ckpt-")
    sc.setCheckpointDir(configured)
    # setCheckpointDir appends a per-application subfolder
    return (sc.getCheckpointDir() or configured).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back.

    Ends the lineage, and lets Spark plan with the written size.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def broadcast_limit(spark: SparkSession) -> int:
    """The session's ``spark.sql.autoBroadcastJoinThreshold`` in bytes (-1: never)."""
    raw = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760").strip().lower()
    units = {"b": 1, "k": 2**10, "kb": 2**10, "m": 2**20, "mb": 2**20, "g": 2**30, "gb": 2**30}
    for suffix in sorted(units, key=len, reverse=True):
        if raw.endswith(suffix) and raw[: -len(suffix)].strip().lstrip("-").isdigit():
            return int(raw[: -len(suffix)]) * units[suffix]
    return int(raw)


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    """Whether the values of ``df`` (read back by :func:`stored`), measured as text, fit in a broadcast."""
    bound = broadcast_limit(df.sparkSession) if limit is None else limit
    if bound < 0:
        return False
    width = F.lit(16)
    for c in df.columns:
        width = width + F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0))
    return int(df.agg(F.sum(width.cast("bigint"))).first()[0] or 0) <= bound
