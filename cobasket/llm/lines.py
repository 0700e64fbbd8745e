"""Line deduplication across documents, with DataFrame functions only.

A text is split at ``\\n``. A line's key is the line without the white space
``[\\x20\\x09-\\x0D]`` at both ends, A-Z lower-cased. Keys of at least
``min_chars`` code points that occur in at least ``min_docs`` documents are
repeated: their lines go everywhere but in the largest doc_id that holds them.

Plan: each document's distinct keys are exploded and hashed to 128 bits, and
counted with partial aggregation, so that a line of a third of all documents
is one row for each task. Only rows of a doc_id that occurs more than once (found by
a count of doc_ids) need a distinct of their keys by doc_id before. The repeated keys, with the doc_id that keeps them,
are written to the scratch folder; Spark knows the size of what it reads back
and broadcasts it only below its own threshold, or else joins by sort and merge
and splits a hot key at run time. Lines are exploded with their positions,
joined to those keys, and each document gets the list of positions to drop
(grouped by document, bounded by its own lines). One join by document puts the
kept lines together again by position.

Defined results: rows of one doc_id count as one document, and those of the largest
doc_id all keep the line; all rows without a doc_id count as one document, smaller than
any other; a null or empty text is one empty line; an empty table stays empty.
All input columns stay, whatever their names; ``n_lines`` and ``n_dropped`` are
added, in place of columns of those names.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cobasket.session import scratch_path

SPACE = " \t\n\x0b\x0c\r"
MIN_CHARS = 20
MIN_DOCS = 3


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else unchanged; ``lower`` does just that where all is ASCII."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACE)))


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _hashes(key: str) -> list[Column]:
    """Two 64-bit hashes under different seeds: together 128 bits."""
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), F.col(key)).alias("h2")]


def repeated_ids(docs: DataFrame) -> DataFrame:
    """doc_ids of more than one row, null among them."""
    return docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("doc_id").alias("again"))


def repeated_keys(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """h1, h2 of repeated keys, the documents that hold them (n_docs) and the doc_id that keeps them (keeper)."""
    keys = F.filter(F.transform(split_lines(F.col("text")), line_key), lambda k: F.char_length(k) >= min_chars)
    path = scratch_path(docs.sparkSession, "repeated-ids")
    repeated_ids(docs).write.parquet(path)
    again = docs.sparkSession.read.parquet(path)
    exploded = docs.select("doc_id", F.explode(F.array_distinct(keys)).alias("key")).select("doc_id", *_hashes("key"))
    if not again.isEmpty():
        same = F.col("doc_id").eqNullSafe(F.col("again"))
        exploded = exploded.join(again, same, "left_anti").unionByName(exploded.join(again, same, "left_semi").distinct())
    counted = exploded.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keeper"))
    return counted.where(F.col("n_docs") >= min_docs)


def dropped_lines(docs: DataFrame, repeated: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, text_hash and the positions of the lines that go."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(split_lines(F.col("text"))).alias("pos", "line"))
    keyed = lines.withColumn("key", line_key(F.col("line"))).where(F.char_length("key") >= min_chars).select("doc_id", "text_hash", "pos", *_hashes("key"))
    gone = keyed.join(repeated, ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    return gone.groupBy("doc_id", "text_hash").agg(F.collect_set("pos").alias("gone"))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` without repeated lines, and n_lines, n_dropped (long)."""
    spark = docs.sparkSession
    plain = docs.select("doc_id", "text")
    path = scratch_path(spark, "repeated-lines")
    repeated_keys(plain, min_chars, min_docs).write.parquet(path)
    gone = dropped_lines(plain, spark.read.parquet(path).select("h1", "h2", "keeper"), min_chars)
    # the input row is one struct, so that none of its names can clash
    rows = docs.select(F.struct("*").alias("doc")).withColumn("hash", F.xxhash64("doc.text"))
    same = F.col("doc.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash"))
    split = rows.join(gone, same, "left").select("doc", "gone", split_lines(F.col("doc.text")).alias("lines"))
    places = F.sequence(F.lit(0), F.size("lines") - 1)
    left = F.when(F.col("gone").isNull(), places).otherwise(F.array_except(places, F.col("gone")))
    kept = split.withColumn("left", left).withColumn(
        "kept",
        F.when(F.col("gone").isNull(), F.coalesce("doc.text", F.lit(""))).otherwise(F.array_join(F.transform("left", lambda p: F.get("lines", p)), "\n")),
    )
    own = [F.col("kept").alias("text") if c == "text" else F.col("doc").getField(c).alias(c) for c in docs.columns if c not in ("n_lines", "n_dropped")]
    size = F.size("lines").cast("long")
    return kept.select(*own, size.alias("n_lines"), (size - F.size("left")).alias("n_dropped"))


def digest(deduped: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and the sha256 of what is kept."""
    return deduped.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


_SPACE_SQL = "(chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
ORACLE = f"""
WITH l AS (
  SELECT doc_id, line, pos, translate(trim(line, {_SPACE_SQL}), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS key
  FROM (SELECT doc_id, unnest(s) AS line, generate_subscripts(s, 1) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents))
), r AS (
  SELECT key, max(doc_id) AS keeper FROM l WHERE length(key) >= {MIN_CHARS}
  GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS}
), j AS (
  SELECT l.doc_id, l.line, l.pos, (r.key IS NOT NULL AND r.keeper <> l.doc_id) AS gone
  FROM l LEFT JOIN r ON l.key = r.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
