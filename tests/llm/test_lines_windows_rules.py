from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from cobasket.llm import lines, rules, substrings

from .conftest import SF, frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def key_of(line):
    out = line.strip(" \t\n\x0b\x0c\r")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in out)


def plain_lines(rows):
    """(doc_id, n_lines, n_dropped, sha) by the definition; rows of a doc_id are one document, null the smallest."""
    rank = lambda d: (d is not None, d or 0)
    held = defaultdict(set)
    for doc, text in rows:
        for k in {key_of(x) for x in (text or "").split("\n")}:
            held[k].add(rank(doc))
    out = []
    for doc, text in rows:
        own = (text or "").split("\n")
        gone = [len(key_of(x)) >= 20 and len(held[key_of(x)]) >= 3 and rank(doc) != max(held[key_of(x)]) for x in own]
        out.append((doc, len(own), sum(gone), sha("\n".join(x for x, g in zip(own, gone, strict=True) if not g))))
    return sorted(out, key=str)


def plain_windows(rows, width):
    """(doc_id, n_words, n_removed, sha) by the definition; a null doc_id is the largest and counts against none."""
    first = {}
    for doc, text in rows:
        w = WORD.findall(text or "")
        for i in range(len(w) - width + 1):
            g = tuple(w[i : i + width])
            if doc is not None:
                first[g] = min(first.get(g, doc), doc)
    out = []
    for doc, text in rows:
        w = WORD.findall(text or "")
        gone = set()
        for i in range(len(w) - width + 1):
            least = first.get(tuple(w[i : i + width]))
            if least is not None and (doc is None or least < doc):
                gone.update(range(i, i + width))
        out.append((doc, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return sorted(out, key=str)


def plain_counts(text):
    w = WORD.findall(text or "")
    grams = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    cover = {k for i in range(len(w) - 7) if grams[tuple(w[i : i + 8])] > 1 for k in range(i, i + 8)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(cover)


@pytest.mark.parametrize("name", ["corpus", "odd"])
def test_lines_as_defined(request, name):
    docs = request.getfixturevalue(name)
    got = lines.digest(lines.dedup_lines(docs)).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, got), key=str) == plain_lines(rows)


def test_lines_that_share_everything(spark):
    same = "The very same line in all of them"
    rows = [(i, f"{same}\n\n {same.upper()}\nshort\nÄ{'ä' * 18}\nown {i}") for i in range(40)] + [(5, "short\nshort")]
    got = lines.digest(lines.dedup_lines(frame(spark, rows))).collect()
    assert sorted(map(tuple, got), key=str) == plain_lines(rows)
    assert {r.doc_id for r in got if r.n_dropped == 0 and r.n_lines == 6} == {39}


def test_lines_of_repeated_doc_ids(spark):
    """A line counts once for each doc_id that holds it, however many rows that has."""
    two, three, lone = (f"a line of {n} documents, long enough" for n in ("two", "three", "no id"))
    rows = [(3, f"{two}\nx"), (5, two), (5, two), (5, f"{two}\n{three}"), (6, three), (7, three), (7, three), (None, lone), (None, lone), (None, f"{lone}\n{three}")]
    rows += [(8, f"copy {i % 2} of a document listed often") for i in range(300)]
    docs = frame(spark, rows).repartition(4)
    got = lines.digest(lines.dedup_lines(docs)).collect()
    assert sorted(map(tuple, got), key=str) == plain_lines(rows)
    assert sorted((r.doc_id, r.n_dropped) for r in got if r.doc_id in (3, 5, 6, 7)) == [(3, 0), (5, 0), (5, 0), (5, 1), (6, 1), (7, 0), (7, 0)]
    assert sorted(r.n_dropped for r in got if r.doc_id is None) == [0, 0, 1]
    con = duckdb.connect()
    documents = docs.where("doc_id IS NOT NULL").toPandas()  # noqa: F841
    dropped = dict(con.sql(f"SELECT doc_id, n_dropped FROM ({lines.ORACLE})").fetchall())
    totals = Counter()
    for r in lines.dedup_lines(docs.where("doc_id IS NOT NULL")).collect():
        totals[r.doc_id] += r.n_dropped
    assert dict(totals) == dropped


def test_lines_by_sql_and_other_columns(spark, corpus, empty):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = lines.digest(lines.dedup_lines(corpus)).collect()
    assert sorted(map(tuple, got)) == sorted(con.sql(f"SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM ({lines.ORACLE})").fetchall())
    clash = corpus.selectExpr("*", "1 AS n_lines", "2 AS gone", "3 AS doc", "4 AS lines", "5 AS hash", "6 AS pos", "7 AS h1")
    out = lines.dedup_lines(clash)
    assert set(out.columns) == set(clash.columns) | {"n_dropped"}
    assert sorted(map(tuple, lines.digest(out).collect())) == sorted(map(tuple, got))
    assert lines.dedup_lines(empty).collect() == []


@pytest.mark.parametrize("name", ["corpus", "odd"])
@pytest.mark.parametrize("width,hash_bytes,chunk", [(13, 8, 4 << 20), (13, 12, 3000), (3, 8, 50), (13, 16, 1)])
def test_windows_as_defined(request, monkeypatch, name, width, hash_bytes, chunk):
    docs = request.getfixturevalue(name)
    monkeypatch.setattr(substrings, "BUCKET_WINDOWS", 1 << 19)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = substrings.dedup_windows(docs.repartition(3, "n_chars"), width, hash_bytes).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == plain_windows(rows, width)
    for r in got:
        assert sha(r.text) == r.kept_sha256 and sum(s.end - s.first for s in r.intervals) == r.n_removed
        assert all(a.end < b.first for a, b in zip(r.intervals, r.intervals[1:], strict=False))


def test_windows_of_large_groups_of_copies(spark):
    passage = " ".join(f"w{i}" for i in range(20))
    rows = [(i, f"{passage} tail{i % 7} " + " ".join(f"v{(i * j) % 11}" for j in range(15))) for i in range(400)]
    got = substrings.digest(frame(spark, rows).repartition(5)).collect()
    assert sorted(map(tuple, got), key=str) == plain_windows(rows, 13)


def test_windows_by_sql(spark, corpus, empty):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = substrings.digest(corpus).collect()
    assert sorted(map(tuple, got)) == sorted(con.sql(f"SELECT doc_id, n_words, n_removed, kept_sha256 FROM ({substrings.ORACLE})").fetchall())
    assert substrings.digest(empty).collect() == []
    clash = corpus.selectExpr("*", "1 AS gone", "2 AS bucket", "3 AS gone_id", "4 AS n_words")
    assert sorted(map(tuple, substrings.digest(clash).collect())) == sorted(map(tuple, got))


@pytest.mark.parametrize("name", ["corpus", "odd"])
def test_counts_as_defined(request, name):
    docs = request.getfixturevalue(name)
    got = rules.report(docs).collect()
    want = sorted(((r.doc_id, *plain_counts(r.text)) for r in docs.collect()), key=str)
    assert sorted(((r.doc_id, *(r[c] for c in rules.COUNTS)) for r in got), key=str) == want
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_repeats_within_a_text(spark):
    block = " ".join(f"a{i}" for i in range(9))
    texts = ["x " * 30, f"{block} {block}", f"{block} y {block} z {block}", " ".join(f"q{i % 8}" for i in range(40)), "u v w x y z a b"]
    got = rules.report(frame(spark, list(enumerate(texts)))).collect()
    assert {r.doc_id: r.n_repeat_words for r in got} == {i: plain_counts(t)[4] for i, t in enumerate(texts)}


def test_thresholds_follow_each_group(spark):
    """A source whose texts all hold many symbols keeps them; the odd ones of another source go."""
    rows = []
    for i in range(900):
        words = [f"w{(i * 7 + j * 13) % 97}x{j}" for j in range(50)]
        code, junk = i % 3 == 0, i % 30 == 1
        marks = (20 + i % 5 if code else 30 if junk else i % 2)
        rows.append((i, " ".join(w + "#" * (j < marks) for j, w in enumerate(words)), "en", "code" if code else "web", 0))
    rows += [(10_000, "plain words " * 3, None, None, 0), (10_001, " ".join(f"lone{i}" for i in range(30)), "xx", None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.kept for r in rules.report(docs).collect()}
    assert [i for i in range(900) if not got[i]] == [i for i in range(900) if i % 30 == 1 and i % 3]
    assert not got[10_000] and got[10_001]


@pytest.mark.parametrize("share", [30, 45])
def test_a_hot_source_with_much_junk(spark, share):
    """Junk goes, also that of sources below MIN_ROWS whose language is mostly the hot source's; clean texts stay."""
    rows, junk = [], set()
    for i in range(2500):
        source, of_100 = ("hot", share) if i < 1000 else ("mostly", 80) if i < 2200 else (f"small{i % 3}", 10)
        marks = i % 3
        if i * 37 % 100 < of_100:
            marks = 30 + i % 60
            junk.add(i)
        rows.append((i, " ".join(f"w{(i * 7 + j * 13) % 97}x{j}" + "#" * (marks // 50 + (j < marks % 50)) for j in range(50)), "en", source, 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    gone = {r.doc_id for r in rules.report(docs).collect() if not r.kept}
    others = set(range(1000)) | set(range(2200, 2500))
    assert gone & others == junk & others


def test_sketch_quantiles_are_right_to_two_percent(spark):
    values = [0.0] * 40 + [0.001 * 1.07**i for i in range(160)]
    rows = [("l", "s", *[v] * 4) for v in values]
    measured = spark.createDataFrame(rows, "lang string, source string, " + ", ".join(f"{r} double" for r in rules.RATES))
    got = rules.quantiles(rules.sketches(measured), ["lang"], {"q1": 0.25, "q3": 0.75}).collect()
    for r in got:
        assert r.rows == 200 and r.q1 == pytest.approx(values[49], rel=0.02) and r.q3 == pytest.approx(values[149], rel=0.02)


def test_rules_keep_columns(spark, corpus, empty):
    clash = corpus.selectExpr("*", "1 AS doc", "2 AS kept", "3 AS words", "4 AS n_words", "5 AS t_lang")
    kept = rules.keep_good(clash)
    assert kept.columns == clash.columns
    want = {r.doc_id for r in rules.report(corpus).collect() if r.kept}
    assert {r.doc_id for r in kept.collect()} == want and 0 < len(want) < 200
    assert rules.report(empty).collect() == [] and rules.keep_good(empty).collect() == []
