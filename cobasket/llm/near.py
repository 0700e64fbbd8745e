"""Near duplicates: ProbMinHash signatures, banding, exact verification, classes.

Shingles are five consecutive words (fewer words: the whole sequence), weighted
by 1 + ln of how often they occur. ProbMinHash lets each shingle arrive again and
again, by a Poisson process of rate its weight; each arrival draws one of the
registers, which keeps the earliest arrival and its shingle, and a shingle stops
once it is later than every register. Two texts agree in a register with the
probability Jaccard of their weights. ``BANDS`` bands of ``ROWS`` registers give
candidates; a pair is linked if the exact Jaccard similarity of the two shingle
sets is at least ``MIN_SIMILARITY``. Classes are the connected components.

As links are by sets, a text that repeats shingles has a second signature, in
which each weighs 1, banded with the same keys: else it would seldom meet a text
of nearly the same set that does not repeat them. Without repeats the two are one.

No step lists all pairs of a group. Copies with the same words are one
representative from the start. In a bucket of up to ``SMALL`` representatives
all pairs are candidates; in a larger one each goes with one pivot, drawn by
hash, so that a cluster gets other pivots in each band. Pairs are verified next
to the pivot's shingles, a hot pivot in as many parts as it needs. Then, in large
buckets that still hold more than one class, members of different classes are
compared block by block, inside tasks, which send on links only. So every
candidate pair of a bucket has been verified or lies in one class already.

Defined results: a text without words is a class of its own; a null doc_id has
no class (null); rows of one doc_id are in the class of the smallest of theirs;
an empty table stays empty; only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cobasket.llm.text import WordHashes, chunks, mix, release, rolling
from cobasket.session import scratch_path

SHINGLE = 5
MIN_SIMILARITY = 0.8
BANDS, ROWS = 24, 5
SMALL = 8
BLOCK = 512
_BASE = 0xA0761D6478BD642F
_GOLD = np.uint64(0x9E3779B97F4A7C15)
#: Text bytes signed at a time: a task holds several arrays as long as their shingles.
SIGNED_BYTES = 1 << 20
_HASHES = WordHashes(5)
_SIGNED = "doc_id long, words binary, shingles int, bands array<long>"
_SETS = "doc_id long, shingles binary"
_LINKS = "a long, b long"


def shingles(words: list[bytes]) -> np.ndarray:
    """Hashes of all shingles of a text, in order, repeats included."""
    return rolling(_HASHES.of(words), min(SHINGLE, len(words)), _BASE) if words else np.zeros(0, np.uint64)


def forget() -> None:
    """Give back the memory of this process's word hashes, at the end of a task."""
    _HASHES.clear()
    release()


def signatures(keys: list[np.ndarray], weights: list[np.ndarray], registers: int) -> np.ndarray:
    """ProbMinHash of weighted sets: for each set, the element that comes first in each register (0: an empty set)."""
    n = len(keys)
    key = np.concatenate(keys) if n else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(n), [len(k) for k in keys])
    rate = np.concatenate(weights) if n else np.zeros(0)
    first = np.full(n * registers, np.inf)
    time = np.zeros(len(key))
    seen: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    turn = 0
    with np.errstate(over="ignore"):
        while len(key):
            turn += 1
            draw = mix(key + np.uint64(turn) * _GOLD)
            time = time - np.log(((draw >> np.uint64(11)) + np.uint64(1)) * 2.0**-53) / rate
            at = owner * registers + (((draw & np.uint64(0x7FF)) * np.uint64(registers)) >> np.uint64(11)).astype(np.int64)
            early = time < first[at]
            seen.append((at[early], time[early], key[early]))
            np.minimum.at(first, at[early], time[early])
            on = time < first.reshape(n, registers).max(1)[owner]
            key, owner, rate, time = key[on], owner[on], rate[on], time[on]
    out = np.zeros(n * registers, np.uint64)
    for at, when, who in seen:
        won = when == first[at]
        out[at[won]] = who[won]
    return out.reshape(n, registers)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band."""
    parts = signature.reshape(len(signature), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2])
    with np.errstate(over="ignore"):
        for r in range(rows):
            key = mix(key * _GOLD + parts[:, :, r])
    return key


def sign(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, a 128-bit hash of the word sequence, the number of distinct shingles, and band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, size=SIGNED_BYTES):
            keys, weights, names = [], [], []
            for text in texts:
                words = text.split()
                key, count = np.unique(shingles(words), return_counts=True)
                keys.append(key)
                weights.append(1 + np.log(count))
                names.append(xxhash.xxh3_128_digest(b" ".join(words)))
            own = list(band_keys(signatures(keys, weights, bands * rows), bands, rows).view(np.int64))
            again = [i for i, w in enumerate(weights) if len(w) and w.max() > 1]  # shingles occur more than once
            plain = signatures([keys[i] for i in again], [np.ones(len(keys[i])) for i in again], bands * rows)
            for i, more in zip(again, band_keys(plain, bands, rows).view(np.int64), strict=True):
                own[i] = np.union1d(own[i], more)
            listed = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, own)]), pa.int32()), pa.array(np.concatenate(own)))
            yield pa.record_batch([batch.column(0), pa.array(names, pa.binary()), pa.array([len(k) for k in keys], pa.int32()), listed], names=["doc_id", "words", "shingles", "bands"])
        forget()

    return docs.select("doc_id", "text").mapInArrow(run, _SIGNED)


def _stored(frame: DataFrame, name: str) -> DataFrame:
    """Written to the shared scratch folder and read back: lineage ends, and Spark knows the size."""
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def shingle_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Sorted distinct shingle hashes, packed, of the documents in ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, size=SIGNED_BYTES):
            sets = [np.unique(shingles(t.split())).astype("<u8").tobytes() for t in texts]
            yield pa.record_batch([batch.column(0), pa.array(sets, pa.binary())], names=["doc_id", "shingles"])
        forget()

    # the ids grow with the input: merged at every size, never broadcast
    wanted = ids.select(F.col("doc_id").alias("wanted")).hint("merge")
    return docs.select("doc_id", "text").join(wanted, F.col("doc_id") == F.col("wanted"), "left_semi").mapInArrow(run, _SETS)


class Sets:
    """Shingle sets of one task, for counting one set's overlaps with many others at once."""

    def __init__(self, packed: list[bytes]):
        own = [np.frombuffer(x, "<u8") for x in packed]
        self.sizes = np.array([len(x) for x in own], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        _, self.number = np.unique(np.concatenate(own), return_inverse=True)
        self.flags = np.zeros(int(self.number.max()) + 1, bool)

    def similar(self, i: int, others: np.ndarray, least: float) -> np.ndarray:
        """Which of ``others`` have at least that Jaccard similarity to set ``i``."""
        a = self.sizes[i]
        near = others[(self.sizes[others] >= least * a - 1e-9) & (least * self.sizes[others] <= a + 1e-9)]
        if not len(near):
            return near
        mine = self.number[self.starts[i] : self.starts[i] + a]
        self.flags[mine] = True
        sizes = self.sizes[near]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1]) + np.repeat(self.starts[near] - (ends - sizes), sizes)
        both = np.add.reduceat(self.flags[self.number[places]].astype(np.int64), ends - sizes)
        self.flags[mine] = False
        return near[both >= least * (a + sizes - both) - 1e-9]


def _links(pairs: list[tuple[int, int]]) -> pa.Table:
    a, b = zip(*pairs, strict=True) if pairs else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def verify(pairs: DataFrame, sets: DataFrame, least: float, block: int = BLOCK) -> DataFrame:
    """Those pairs (hub, member) whose sets are similar enough; a hub's members are dealt out in parts of about ``block``."""
    degree = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts"))
    dealt = pairs.join(degree, "hub").withColumn("part", F.pmod(F.xxhash64("member"), F.col("parts")).cast("int"))
    members = dealt.join(sets, F.col("member") == F.col("doc_id")).select("hub", "part", "member", "shingles")
    hubs = degree.select("hub", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    hubs = hubs.join(sets, F.col("hub") == F.col("doc_id")).select("hub", "part", F.lit(None).cast("long").alias("member"), "shingles")

    def run(table: pa.Table) -> pa.Table:
        ids = table.column("member").to_pylist()
        sets, name = Sets(table.column("shingles").to_pylist()), table.column("hub")[0].as_py()
        members = np.array([i for i, x in enumerate(ids) if x is not None], np.int64)
        found = {ids[k] for i, x in enumerate(ids) if x is None for k in sets.similar(i, members, least)}
        return _links([(max(name, x), min(name, x)) for x in sorted(found)])

    return members.unionByName(hubs).groupBy("hub", "part").applyInArrow(run, _LINKS)


def compare_blocks(members: DataFrame, sets: DataFrame, least: float, block: int = BLOCK) -> DataFrame:
    """Links between members (bucket, rep, class_id, size) of different classes of a bucket, block by block, fewest links that join them."""
    blocks = F.ceil(F.col("size") / block).cast("int")
    own = members.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    with_all = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = with_all.select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "rep", "class_id")
    rows = placed.join(sets, F.col("rep") == F.col("doc_id")).select("bucket", "i", "j", "own", "rep", "class_id", "shingles")

    def run(key: tuple, table: pa.Table) -> pa.Table:
        same = key[1].as_py() == key[2].as_py()
        table = table.sort_by("rep")
        rep, block_of, label = (table.column(c).to_numpy() for c in ("rep", "own", "class_id"))
        _, label = np.unique(label, return_inverse=True)
        if label.max() == 0:
            return _links([])
        count = np.bincount(label)
        sets = Sets(table.column("shingles").to_pylist())
        found = []
        # members of the largest class need no turn of their own
        for i in np.flatnonzero(label != count.argmax()):
            others = np.flatnonzero((label != label[i]) & (True if same else block_of != block_of[i]))
            for k in sets.similar(int(i), others, least):
                if label[k] != label[i]:
                    found.append((int(max(rep[i], rep[k])), int(min(rep[i], rep[k]))))
                    label[label == label[k]] = label[i]
        return _links(found)

    return rows.groupBy("bucket", "i", "j").applyInArrow(run, _LINKS)


def components(links: DataFrame) -> DataFrame:
    """node, class_id (the smallest node of its connected component), of all nodes that have a link.

    Alternating large and small stars: each round every node's neighbours move
    to its smallest neighbour. Rounds are written to the scratch folder; they
    end when a round changes nothing.
    """
    now = _stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    state = None
    while True:
        got = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(got) == state or got[0] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("class_id")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("class_id")).distinct())
        state = tuple(got)
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = _stored(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct(), "large-stars")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = _stored(moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "small-stars")


def classes(docs: DataFrame, least: float = MIN_SIMILARITY, bands: int = BANDS, rows: int = ROWS, small: int = SMALL, block: int = BLOCK) -> DataFrame:
    """doc_id, exact_id (the smallest doc_id with the same words) and class_id (the smallest of its class)."""
    signed = _stored(sign(docs.where(F.col("doc_id").isNotNull()), bands, rows), "signatures")
    full = signed.where("shingles > 0")
    reps = _stored(full.groupBy("words").agg(F.min("doc_id").alias("rep"), F.any_value("bands").alias("bands")), "representatives")
    # one row for each representative and band, in buckets of two or more
    banded = reps.select("rep", F.explode("bands").alias("bucket"))
    draw = F.min(F.struct(F.xxhash64("rep", "bucket"), F.col("rep")))["rep"]
    buckets = _stored(banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), draw.alias("pivot")).where("size > 1"), "buckets")
    members = _stored(banded.join(buckets, "bucket"), "members")
    few = members.where(F.col("size") <= small).groupBy("bucket").agg(F.sort_array(F.collect_list("rep")).alias("reps"))
    few = few.select(F.explode("reps").alias("hub"), "reps").select("hub", F.explode("reps").alias("member"))
    many = members.where(F.col("size") > small).select(F.col("pivot").alias("hub"), F.col("rep").alias("member"))
    pairs = few.where("hub < member").unionByName(many.where("hub <> member")).select(F.least("hub", "member").alias("x"), F.greatest("hub", "member").alias("y"), "hub").groupBy("x", "y").agg(F.min("hub").alias("hub"))
    pairs = _stored(pairs.select("hub", (F.col("x") + F.col("y") - F.col("hub")).alias("member")), "pairs")
    ids = pairs.select(F.explode(F.array("hub", "member")).alias("doc_id")).distinct()
    # rows of one doc_id may differ in text: then each of them stands for it
    sets = _stored(shingle_sets(docs, ids), "shingle-sets")
    links = _stored(verify(pairs, sets, least, block), "verified")
    found = _stored(components(links), "classes")
    # what large buckets hold beyond one class
    crowd = members.where(F.col("size") > small).join(found, F.col("rep") == F.col("node"), "left")
    crowd = _stored(crowd.select("bucket", "size", "rep", F.coalesce("class_id", "rep").alias("class_id")), "crowds")
    mixed = crowd.groupBy("bucket").agg(F.min("class_id").alias("low"), F.max("class_id").alias("high")).where("low < high").select("bucket")
    more = _stored(compare_blocks(crowd.join(mixed, "bucket"), sets, least, block), "more-links")
    if more.limit(1).count():
        found = components(links.unionByName(more))
    same = full.select("doc_id", "words").join(reps.select("words", "rep"), "words")
    own = same.join(found, F.col("rep") == F.col("node"), "left").select("doc_id", F.col("rep").alias("exact_id"), F.coalesce("class_id", "rep").alias("class_id"))
    alone = signed.where("shingles = 0").select("doc_id", F.col("doc_id").alias("exact_id"), F.col("doc_id").alias("class_id"))
    unnamed = docs.where(F.col("doc_id").isNull()).select("doc_id", F.col("doc_id").alias("exact_id"), F.col("doc_id").alias("class_id"))
    return own.unionByName(alone).unionByName(unnamed)


def keep_one(docs: DataFrame) -> DataFrame:
    """Of each class the document of the smallest doc_id, with its own columns; rows without doc_id stay.

    Rows of one doc_id: of those with the same text one stays. Where their texts differ, all texts of a
    doc_id stay that is the smallest of a class of any of them, so that no text is lost with its doc_id.
    """
    chosen = _stored(classes(docs).where("doc_id = class_id").select(F.col("doc_id").alias("chosen")).distinct(), "chosen")
    rows = docs.select(F.struct("*").alias("doc")).withColumn("id", F.col("doc.doc_id"))
    kept = rows.where("id is not null").join(chosen, F.col("id") == F.col("chosen"))
    text = F.coalesce("doc.text", F.lit(""))
    same = Window.partitionBy("id", F.xxhash64(text), F.xxhash64(F.lit(1), text)).orderBy(F.col("doc.text").isNull())
    first = kept.withColumn("turn", F.row_number().over(same)).where("turn = 1")
    return first.select("doc").unionByName(rows.where("id is null").select("doc")).select("doc.*")
