"""Quality rules with adaptive thresholds, with DataFrame functions only.

Each text gets counts and four rates (:data:`RATES`). Quantile sketches of each
rate, per language and source, replace fixed cutoffs. A sketch is a count for
each logarithmic bin of ratio ``GAMMA`` (quantiles are then right to 1 %):
sketches merge by adding their counts, so they come from one aggregation with
partial sums, do not depend on the order of rows, and those of a language or of
all documents are sums of those of its sources, in which a source weighs as
``MIN_ROWS`` documents at most, so that a hot one does not set the limits of the
others. A rate fails if it lies above the upper quartile by more than ``FENCE``
interquartile ranges and the rate's slack, the least spread that counts as one.
The upper quartile is the lower one mirrored at the median: what makes up less
than half of a group, at its upper end, is no part of the spread. A (lang,
source) of fewer than ``MIN_ROWS`` documents takes its language's sketch, and
such a language that of all documents. In a group that is junk by more than half,
junk is what is usual.

Defined results: a null text has no words; an empty text fails the base rule; a
null lang or source is a group of its own; repeated rows are judged each; an
empty table stays empty; a rate that is undefined (no words, no lines) is 0.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cobasket.session import scratch_path

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
GRAM = 8
GAMMA = 1.02
FENCE = 3.0
MIN_ROWS = 200
#: Rates and their slack: symbols a word, other marks a word, repeated lines a line, repeated words a word.
RATES = {"symbol_rate": 0.1, "mark_rate": 0.25, "dup_line_rate": 0.3, "repeat_rate": 0.15}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_ZERO = -(2**30)
#: Weights are whole numbers, so that their sums do not depend on the order of rows.
_WHOLE = 1_000_000


def _occurrences(text: Column, chars: str) -> Column:
    """How often any of some ASCII characters occurs."""
    total = F.lit(0)
    for c in chars:
        total = total + F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c), F.lit("")))
    return total.cast("long")


def measure(docs: DataFrame, carry: list[str]) -> DataFrame:
    """One row for each document: ``doc`` (a struct of the columns in ``carry``), lang, source, counts and rates."""
    text = F.coalesce(F.col("text"), F.lit(""))
    spaced = text
    for c in "\t\n\x0b\x0c\r":
        spaced = F.replace(spaced, F.lit(c), F.lit(" "))
    has_word = lambda line: F.length(F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))) > 0
    rows = docs.select(F.struct(*carry).alias("doc"), F.col("lang").alias("lang"), F.col("source").alias("source"), text.alias("text"), spaced.alias("spaced"))
    rows = rows.withColumn("words", F.array_remove(F.split("spaced", " ", -1), ""))
    rows = rows.withColumn("lines", F.filter(F.split("text", "\n", -1), has_word))
    rows = rows.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    size = F.size("hashes")
    gram = lambda i: F.xxhash64(*[F.get("hashes", i + k) for k in range(GRAM)])
    rows = rows.withColumn("grams", F.when(size >= GRAM, F.transform(F.sequence(F.lit(0), size - GRAM), gram)))
    # only texts with a repeated window: windows in order of hash, those equal to a neighbour, their places
    ordered = F.sort_array(F.transform("grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    rows = rows.withColumn("ordered", F.when(F.size(F.array_distinct("grams")) < F.size("grams"), ordered))
    near = lambda x, k: x["g"].eqNullSafe(F.get("ordered", k - 1)["g"]) | x["g"].eqNullSafe(F.get("ordered", k + 1)["g"])
    places = F.transform(F.filter("ordered", near), lambda x: x["i"])
    rows = rows.withColumn("places", F.sort_array(places))
    covered = F.transform("places", lambda p, k: F.least(F.lit(GRAM), F.coalesce(F.get("places", k + 1) - p, F.lit(GRAM))).cast("long"))
    repeated = F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)
    rows = rows.select(
        "doc", "lang", "source",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.replace("spaced", F.lit(" "), F.lit(""))).cast("long").alias("word_chars"),
        _occurrences(F.col("text"), SYMBOLS).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(repeated, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("lines").alias("n_lines"),
        F.char_length(F.regexp_replace("text", r"[\p{L}\p{N}\s]+", "")).alias("n_marks"),
    )
    rate = lambda part, whole: F.coalesce(F.try_divide(F.col(part).cast("double"), F.col(whole)), F.lit(0.0))
    return rows.select(
        "doc", "lang", "source", *COUNTS,
        rate("n_symbols", "n_words").alias("symbol_rate"), rate("n_marks", "n_words").alias("mark_rate"),
        rate("n_dup_lines", "n_lines").alias("dup_line_rate"), rate("n_repeat_words", "n_words").alias("repeat_rate"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def sketches(measured: DataFrame) -> DataFrame:
    """lang, source, rate, bin, n: how many documents of a group have a rate in a bin."""
    pairs = F.array(*[F.struct(F.lit(r).alias("rate"), F.col(r).alias("value")) for r in RATES])
    long = measured.select("lang", "source", F.explode(pairs).alias("x"))
    place = F.when(F.col("x.value") > 0, F.ceil(F.ln("x.value") / math.log(GAMMA))).otherwise(_ZERO).cast("int")
    return long.groupBy("lang", "source", F.col("x.rate").alias("rate"), place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def weighted(sketch: DataFrame, most: int) -> DataFrame:
    """The sketches with a weight beside n, of ``most`` documents at most for each source."""
    rows = F.sum("n").over(Window.partitionBy("lang", "source", "rate"))
    return sketch.withColumn("weight", F.round(F.col("n") * (_WHOLE * F.least(F.lit(1.0), most / rows))).cast("long"))


def quantiles(sketch: DataFrame, keys: list[str], shares: dict[str, float], weight: str = "n") -> DataFrame:
    """keys, rate, rows, and a column for each share of the weight; sketches of the same keys are merged."""
    merged = sketch.groupBy(*keys, "rate", "bin").agg(F.sum("n").alias("n"), F.sum(weight).alias("w"))
    # a sketch has a few hundred bins, whatever it counts
    sums = [F.sum("n").alias("rows"), F.sum("w").alias("total")]
    bins = merged.groupBy(*keys, "rate").agg(F.sort_array(F.collect_list(F.struct("bin", "w"))).alias("bins"), *sums)
    start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("int").alias("bin"))

    def at(share: float) -> Column:
        def step(a: Column, x: Column) -> Column:
            seen = a["seen"] + x["w"]
            return F.struct(seen.alias("seen"), F.coalesce(a["bin"], F.when(seen >= F.col("total") * share, x["bin"])).alias("bin"))

        found = F.aggregate("bins", start, step)["bin"]
        return F.when(found == _ZERO, 0.0).otherwise(2 * F.pow(F.lit(GAMMA), found) / (GAMMA + 1))

    return bins.select(*keys, "rate", "rows", *[at(s).alias(c) for c, s in shares.items()])


def thresholds(measured: DataFrame, fence: float = FENCE, min_rows: int = MIN_ROWS) -> DataFrame:
    """lang, source, and for each rate the largest value that passes."""
    path = scratch_path(measured.sparkSession, "sketches")
    sketches(measured).write.parquet(path)
    sketch = measured.sparkSession.read.parquet(path)
    shares = {"q1": 0.25, "mid": 0.5}
    level = weighted(sketch, min_rows)
    renamed = lambda to: [F.col(c).alias(f"{to}_{c}") for c in ("rows", *shares)]
    own = quantiles(sketch, ["lang", "source"], shares)
    lang = quantiles(level, ["lang"], shares, "weight")
    lang = lang.select(F.col("lang").alias("l"), F.col("rate").alias("lr"), *renamed("l"))
    every = quantiles(level, [], shares, "weight")
    every = every.select(F.col("rate").alias("ar"), *renamed("a"))
    both = own.join(lang, F.col("lang").eqNullSafe(F.col("l")) & (F.col("rate") == F.col("lr"))).join(every, F.col("rate") == F.col("ar"))
    pick = lambda c: F.when(F.col("rows") >= min_rows, F.col(c)).when(F.col("l_rows") >= min_rows, F.col(f"l_{c}")).otherwise(F.col(f"a_{c}"))
    slack = F.create_map(*[F.lit(x) for pair in RATES.items() for x in pair])[F.col("rate")]
    half = pick("mid") - pick("q1")
    top = both.select("lang", "source", "rate", (pick("mid") + half + fence * 2 * half + slack).alias("top"))
    return top.groupBy(F.col("lang").alias("t_lang"), F.col("source").alias("t_source")).agg(*[F.max(F.when(F.col("rate") == r, F.col("top"))).alias(f"{r}_top") for r in RATES])


def judge(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """``doc`` (a struct of the columns in ``carry``, by default all), the counts, base_failed and kept.

    Measures are written once to the scratch folder; thresholds come from them
    and are joined back by group.
    """
    spark = docs.sparkSession
    rows, tops = scratch_path(spark, "measured"), scratch_path(spark, "thresholds")
    measure(docs, docs.columns if carry is None else carry).write.parquet(rows)
    measured = spark.read.parquet(rows)
    thresholds(measured.drop("doc")).write.parquet(tops)
    limits = spark.read.parquet(tops)
    same = F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source"))
    passes = ~base_failed()
    for r in RATES:
        passes = passes & (F.col(r) <= F.col(f"{r}_top"))
    return measured.join(limits, same).select("doc", *COUNTS, base_failed().alias("base_failed"), passes.alias("kept"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns."""
    return judge(docs).where("kept").select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])


def report(docs: DataFrame) -> DataFrame:
    """doc_id, counts, base_failed and kept for every document."""
    return judge(docs, ["doc_id"]).select(F.col("doc.doc_id").alias("doc_id"), *COUNTS, "base_failed", "kept")
