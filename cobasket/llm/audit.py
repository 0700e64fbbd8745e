"""How five filters interact in every order they can be applied in.

A text fails filter A below ``MIN_WORDS`` words, B if less than half of its words
are distinct, C if more than 2 % of its code points are A-Z, D if it holds any of
``#$%&*|``, and E if a smaller doc_id has the same text, removed or not. A failure
mask has bit i set if the text fails the i-th letter.

Documents are counted by part (their source) and mask first: at most 32 cells a
part, each with the numbers of its documents, of those labelled good and of those
labelled toxic. Each cell is then folded over the array of all orders, a literal
that the plan ships to every task: ``aggregate`` walks an order's filters and
notes whether the cell is still alive, ``transform`` does so for each order, and
``flatten`` gives 600 weighted structs a cell. ``zip_with`` adds the structs of a
part's cells, element by element.

Filter E: rows are first counted by (doc_id, text hash of 128 bits, part, mask),
then by (text hash, part, mask, labels) with the smallest doc_id and the number of
its rows, so that a text of a third of all rows is a few rows for each task and a
few in all; only those meet in the window that finds the smallest doc_id of all
parts. Words never leave the scan.

Defined results: a null or empty text has no words; a null source is the part '';
a null doc_id counts as the largest and has no labels; each row is a document, and rows of
one doc_id don't make each other fail E; a doc_id that is labelled twice is good or
toxic if any of its labels says so; an empty table gives no row; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LETTERS = "ABCDE"
MIN_WORDS = 200
#: Join keys of one doc_id are spread over so many values.
SALTS = 8
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


def orders(letters: str = LETTERS) -> list[tuple[int, ...]]:
    """All orders of the letters, as their numbers, in alphabetical order."""
    return list(permutations(range(len(letters))))


def text_mask(text: Column) -> Column:
    """Bits of the filters that look at the text alone, A to D."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.transform(
        F.array(words),  # a lambda variable, so that the words are found once
        lambda w: (
            F.when(F.size(w) < MIN_WORDS, 1).otherwise(0)
            + F.when(100 * F.size(F.array_distinct(w)) < 50 * F.size(w), 2).otherwise(0)
            + F.when(100 * F.regexp_count(text, F.lit("[A-Z]")) > 2 * F.char_length(text), 4).otherwise(0)
            + F.when(text.rlike("[#$%&*|]"), 8).otherwise(0)
        ),
    )[0]


def masks(docs: DataFrame) -> DataFrame:
    """doc_id, part, h1, h2 (the text's hash) and mask (A to D) of every row, and n, how many rows are alike."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.xxhash64(text).alias("h1"),
        F.xxhash64(F.lit(1), text).alias("h2"),
        text_mask(text).alias("mask"),
    )
    return rows.groupBy("doc_id", "h1", "h2", "part", "mask").agg(F.count(F.lit(1)).alias("n"))


def label_flags(labels: DataFrame) -> DataFrame:
    """doc_id, good, toxic (0 or 1) of the doc_ids that are either."""
    flag = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0))
    known = labels.where(F.col("doc_id").isNotNull() & ((F.col("quality") == 1) | (F.col("toxic") == 1)))
    return known.groupBy(F.col("doc_id").alias("known_id")).agg(flag("quality").alias("good"), flag("toxic").alias("toxic"))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask (A to E), n, good, toxic: one row for each mask that a part has."""
    rows = masks(docs)
    # a doc_id of many texts, or none, doesn't land in one task
    flags = label_flags(labels).withColumn("known_salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    salted = rows.withColumn("salt", F.pmod("h1", F.lit(SALTS)).cast("int"))
    salted = salted.withColumn("own_id", F.coalesce("doc_id", F.col("h2"))).withColumn("salt", F.when(F.col("doc_id").isNull(), -1).otherwise(F.col("salt")))
    # a label has SALTS rows, of which the size of its table tells nothing: never broadcast
    known = salted.join(flags.hint("merge"), (F.col("own_id") == F.col("known_id")) & (F.col("salt") == F.col("known_salt")), "left")
    known = known.select("doc_id", "part", "h1", "h2", "mask", "n", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    # one text in one part: its smallest doc_id, and how many of its rows carry it
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    same = known.groupBy("h1", "h2", "part", "mask", "good", "toxic").agg(F.sum("n").alias("n"), first.alias("first"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("nulls"))
    least = F.min("first.doc_id").over(Window.partitionBy("h1", "h2"))
    whole = same.withColumn("least", least)
    spared = F.when(F.col("least").isNull(), F.col("nulls")).when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0)
    split = whole.withColumn("spared", spared).select(
        "part", "good", "toxic",
        F.explode(F.array(
            F.struct(F.col("mask").alias("mask"), F.col("spared").alias("n")),
            F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("spared")).alias("n")),
        )).alias("cell"),
    ).where("cell.n > 0")
    n = F.col("cell.n")
    return split.groupBy("part", "cell.mask").agg(F.sum(n).alias("n"), F.sum(n * F.col("good")).alias("good"), F.sum(n * F.col("toxic")).alias("toxic"))


def fold(cell: Column, all_orders: Column) -> Column:
    """A cell's counts at each step of each order, end to end."""
    mask, n = cell["mask"], cell["n"]
    zero = F.lit(0).cast("bigint")
    blank = F.array().cast("array<struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">>")

    def step(state: Column, letter: Column) -> Column:
        fails = F.getbit(mask, letter) == 1
        alive = state["alive"]
        gone = alive & fails
        only = mask == F.call_function("shiftleft", F.lit(1), letter)
        values = {
            "kept": F.when(alive & ~fails, n), "removed": F.when(gone, n), "redundant": F.when(~alive & fails, n),
            "unique_fails": F.when(only, n), "good_lost": F.when(gone, cell["good"]), "toxic_lost": F.when(gone, cell["toxic"]),
        }
        own = F.struct(*[F.coalesce(values[c], zero).alias(c) for c in COUNTS])
        return F.struct((alive & ~fails).alias("alive"), F.concat(state["steps"], F.array(own)).alias("steps"))

    start = F.struct(F.lit(True).alias("alive"), blank.alias("steps"))
    return F.flatten(F.transform(all_orders, lambda order: F.aggregate(order, start, step, lambda s: s["steps"])))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, filter_order and step: COUNTS within the part, and shapley."""
    every = orders()
    size = len(LETTERS)
    all_orders = F.array(*[F.array(*map(F.lit, o)) for o in every])
    names = F.array(*[F.lit("".join(LETTERS[i] for i in o)) for o in every])
    zero = F.lit(0).cast("bigint")
    blank = F.array_repeat(F.struct(*[zero.alias(c) for c in COUNTS]), len(every) * size)
    add = lambda a, b: F.struct(*[(a[c] + b[c]).alias(c) for c in COUNTS])
    # at most 32 cells a part
    parts = cells(docs, labels).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    merged = parts.select("part", F.aggregate("cells", blank, lambda acc, cell: F.zip_with(acc, fold(cell, all_orders), add)).alias("steps"))
    letters = F.flatten(all_orders)
    # what each letter removes at any step of any order
    removed = lambda letter: F.aggregate(
        F.zip_with(letters, "steps", lambda x, s: F.when(x == letter, s["removed"]).otherwise(zero)), zero, lambda a, b: a + b
    )
    whole = merged.withColumn("by_letter", F.array(*[removed(i) for i in range(size)]))
    rows = whole.select("part", "by_letter", F.posexplode("steps").alias("at", "counts"))
    return rows.select(
        "part",
        F.get(names, F.floor(F.col("at") / size).cast("int")).alias("filter_order"),
        (F.col("at") % size + 1).alias("step"),
        *[F.col(f"counts.{c}").alias(c) for c in COUNTS],
        F.get("by_letter", F.get(letters, F.col("at"))).alias("shapley"),
    )


ORACLE = rf"""
WITH w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), f AS (
  SELECT doc_id, part, len(words) < {MIN_WORDS} AS a, 100 * len(list_distinct(words)) < 50 * len(words) AS b,
         100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) AS c,
         regexp_matches(t, '[#$%&*|]') AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), doc_id IS NULL AND min(doc_id) OVER (PARTITION BY t) IS NOT NULL) AS e
  FROM w
), g AS (
  SELECT f.part, [a, b, c, d, e] AS fails, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic FROM f
  LEFT JOIN (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id) l
  ON f.doc_id = l.doc_id
), cells AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM g GROUP BY ALL
), letters AS (
  SELECT unnest([1, 2, 3, 4, 5]) AS i
), orders AS (
  SELECT [p.i, q.i, r.i, s.i, t.i] AS o FROM letters p, letters q, letters r, letters s, letters t
  WHERE len(list_distinct([p.i, q.i, r.i, s.i, t.i])) = 5
), steps AS (
  SELECT o, array_to_string(list_transform(o, lambda x: substr('{LETTERS}', x, 1)), '') AS filter_order, i AS step, o[i] AS letter FROM orders, letters
), walked AS (
  SELECT part, filter_order, step, letter, n, good, toxic, fails[letter] AS failed,
         len(list_filter(o[1:step - 1], lambda x: fails[x])) = 0 AS alive, len(list_filter(fails, lambda x: x)) = 1 AS single
  FROM cells, steps
), counted AS (
  SELECT part, filter_order, step, letter,
         CAST(coalesce(sum(n) FILTER (WHERE alive AND NOT failed), 0) AS BIGINT) AS kept,
         CAST(coalesce(sum(n) FILTER (WHERE alive AND failed), 0) AS BIGINT) AS removed,
         CAST(coalesce(sum(n) FILTER (WHERE NOT alive AND failed), 0) AS BIGINT) AS redundant,
         CAST(coalesce(sum(n) FILTER (WHERE failed AND single), 0) AS BIGINT) AS unique_fails,
         CAST(coalesce(sum(good) FILTER (WHERE alive AND failed), 0) AS BIGINT) AS good_lost,
         CAST(coalesce(sum(toxic) FILTER (WHERE alive AND failed), 0) AS BIGINT) AS toxic_lost
  FROM walked GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM counted
"""
