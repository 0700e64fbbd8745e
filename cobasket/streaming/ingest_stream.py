"""Streaming ingest of sales files with deduplication.

The file source's checkpoint replaces the processed-file log: a file is read
once per query, and ``trigger(availableNow=True)`` processes whatever is new
and stops, which is the batch ingest's behaviour with exactly-once
bookkeeping.

Three dedup modes:

``table``
    ``foreachBatch`` appends the rows of each micro-batch that are not yet in
    the Parquet table (anti-join). The table is the state, so nothing grows
    in the state store; a replayed batch appends nothing. A batch's distinct
    rows are written to the shared scratch folder once and measured there.
``state``
    ``dropDuplicates`` in the streaming state store plus the file sink.
    Without event time the state keeps every key forever, so prefer
    ``table`` for unbounded key spaces.
``window``
    ``dropDuplicatesWithinWatermark``: rows carry an event time, or take their
    file's modification time (``file_stream(arrival="arrived_at")``), and a key is
    forgotten once the watermark has passed it by ``delay``. Duplicates whose times
    lie within ``delay`` of each other go; the state holds only recent keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from cobasket.operators.dedup import KEYS, new_rows
from cobasket.session import fits_broadcast, stored
from cobasket.sources.sales import SALES_SCHEMA, read_table_or_empty

#: Files of one micro-batch.
MAX_FILES_PER_TRIGGER = 1000


def file_stream(
    spark: SparkSession,
    directory: str,
    fmt: str = "csv",
    schema: StructType = SALES_SCHEMA,
    glob: str | None = None,
    max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER,
    arrival: str | None = None,
) -> DataFrame:
    """A streaming DataFrame over files arriving in ``directory``.

    ``glob`` filters file names (e.g. ``"*.csv*"`` or ``"lineitem*.parquet"``);
    a single-file path is not a valid stream source, its directory is. A
    backlog comes in batches of ``max_files_per_trigger`` files (None: at once).
    ``arrival`` names a column that takes the modification time of the row's file.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", False).option("escape", '"')
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.load(directory)
    return rows.withColumn(arrival, F.col("_metadata.file_modification_time")) if arrival else rows


def start_dedup_stream(
    stream: DataFrame,
    table_path: str,
    checkpoint: str,
    keys: Sequence[str] = KEYS,
    mode: str = "table",
    available_now: bool = True,
    query_name: str | None = None,
    broadcast_bytes: int | None = None,
    event_time: str | None = None,
    delay: str = "1 hour",
    columns: Sequence[str] | None = None,
) -> StreamingQuery:
    """Start a query that keeps ``table_path`` free of duplicate keys.

    In ``table`` mode a micro-batch whose distinct rows measure at most
    ``broadcast_bytes`` (default: the session's broadcast threshold) is
    broadcast against the table; a larger one is merged by one aggregation.
    In ``window`` mode ``event_time`` and ``delay`` bound the state, and the table
    has ``columns`` (default: the keys).
    """
    keys = list(keys)
    rows = stream.select(*keys)
    if mode == "window":
        if event_time is None:
            raise ValueError("mode 'window' needs an event_time column")
        recent = stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)
        writer = recent.select(*(columns or keys)).writeStream.format("parquet").option("path", table_path).outputMode("append")
    elif mode == "state":
        writer = (
            rows.dropDuplicates(keys)
            .writeStream.format("parquet")
            .option("path", table_path)
            .outputMode("append")
        )
    elif mode == "table":
        schema = rows.schema

        def _append_new(batch: DataFrame, batch_id: int) -> None:
            spark = batch.sparkSession
            batch = stored(batch.dropDuplicates(keys), "batch")
            # a small batch probes the table through a broadcast, so the
            # table is scanned but not shuffled on every trigger
            small = fits_broadcast(batch, broadcast_bytes)
            existing = read_table_or_empty(spark, table_path, schema)
            added = new_rows(batch, existing, keys, incoming_is_small=small)
            added.write.mode("append").parquet(table_path)

        writer = rows.writeStream.foreachBatch(_append_new)
    else:
        raise ValueError("mode must be 'table', 'state' or 'window'")
    writer = writer.option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def run_to_completion(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait for an ``availableNow`` query to finish; re-raise its failure."""
    query.awaitTermination(timeout_s)
    exc = query.exception()
    if exc is not None:
        raise exc
