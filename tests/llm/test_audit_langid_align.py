from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cobasket.llm import align, audit, langid

from .conftest import SF, SCHEMA, frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LABELS = "doc_id long, quality int, toxic int"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


# ── filter audit ────────────────────────────────────────────────────────────


def plain_audit(rows, labels):
    """Counts by walking every document through every order; a null doc_id is the largest."""
    rank = lambda d: (d is None, d or 0)
    least, good, toxic = {}, set(), set()
    for doc, text, _ in rows:
        least[text or ""] = min(least.get(text or "", (True, 1)), rank(doc))
    for doc, q, t in labels:
        if doc is not None:
            good |= {doc} if q == 1 else set()
            toxic |= {doc} if t == 1 else set()
    out = defaultdict(lambda: [0] * 7)
    for doc, text, source in rows:
        text = text or ""
        words = WORD.findall(text)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search("[#$%&*|]", text)), "E": rank(doc) > least[text],
        }
        own = [x for x in "ABCDE" if fails[x]]
        for order in map("".join, permutations("ABCDE")):
            gone = False
            for step, letter in enumerate(order, 1):
                cell = out[source or "", order, step]
                now = fails[letter] and not gone
                cell[2] += fails[letter] and gone
                gone |= now
                cell[0] += not gone
                cell[1] += now
                cell[3] += own == [letter]
                cell[4] += now and doc in good
                cell[5] += now and doc in toxic
    sums = Counter()
    for (part, order, step), cell in out.items():
        sums[part, order[step - 1]] += cell[1]
    return sorted(((p, o, s, *map(int, c[:6]), sums[p, o[s - 1]]) for (p, o, s), c in out.items()), key=str)


def audited(spark, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return audit.audit(docs, spark.createDataFrame(labels, LABELS))


def test_audit_of_odd_rows(spark, odd_rows):
    draw = random.Random(3)
    rows = [(i, t, draw.choice(["a", "b", "", None])) for i, t in odd_rows]
    rows += [(20, "A B C # C", "a"), (21, "A B C # C", "b"), (21, "A B C # C", "b"), (None, "A B C # C", "a"), (None, "no id", "a"), (None, "no id", "b")]
    rows += [(30 + i, " ".join(f"w{j % m}" for j in range(n)), "c") for i, (n, m) in enumerate([(199, 199), (200, 200), (200, 99), (200, 100), (400, 1)])]
    labels = [(4, 1, 0), (5, 1, 1), (6, 0, 1), (7, 0, 1), (20, 1, 1), (21, 1, 0), (21, 0, 1), (31, 1, None), (None, 1, 1), (999, 1, 1)]
    assert rows_of(audited(spark, rows, labels)) == plain_audit(rows, labels)


def test_audit_of_one_text_in_all_sources_and_one_id_of_many_texts(spark):
    rows = [(i, "same words", f"s{i % 3}") for i in range(50)] + [(7, f"text {i}", "s0") for i in range(40)]
    labels = [(i, i % 2, i % 3 == 0) for i in range(50)]
    labels = [(i, q, int(t)) for i, q, t in labels]
    assert rows_of(audited(spark, rows, labels)) == plain_audit(rows, labels)


def test_audit_equals_its_sql(spark, corpus):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = audit.audit(corpus, spark.read.parquet(f"{SF}/labels.parquet"))
    assert rows_of(got) == sorted(con.execute(audit.ORACLE).fetchall(), key=str)


def test_audit_never_broadcasts_labels(spark):
    rows, labels = [(1, "a b", "s"), (2, "c # d", "s"), (None, "a b", "t")], [(1, 1, 0), (2, 0, 1)]
    got = audited(spark, rows, labels)
    assert rows_of(got) == plain_audit(rows, labels)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_audit_ignores_other_columns_and_empty_tables(spark, empty):
    labels = spark.createDataFrame([(1, 1, 0)], LABELS)
    assert audit.audit(empty, labels).collect() == []
    clash = "doc_id long, text string, source string, part string, mask int, n long, h1 long, good int, known_id long, steps int, cells int"
    docs = spark.createDataFrame([(1, "a b", "s", "p", 9, 9, 9, 9, 9, 9, 9)], clash)
    more = labels.selectExpr("*", "1 as good", "2 as salt", "3 as part")
    assert rows_of(audit.audit(docs, more)) == plain_audit([(1, "a b", "s")], [(1, 1, 0)])


# ── language identification ─────────────────────────────────────────────────


def plain_run(net, data, lo, hi, step):
    """States of one segment, byte by byte, in plain numpy."""
    sign = lambda v: v / (1 + abs(v))
    size = net.state.shape[1]
    h, out = np.zeros(size), {}
    for at in range(lo, hi)[::step]:
        x, u = net.table[data[at]], net.state @ h
        update, reset = (1 + sign(x[:size] + u[:size])) / 2, 1 + sign(x[size : 2 * size] + u[size : 2 * size])
        c = sign(x[2 * size :] + reset * u[2 * size :])
        h = c + update * (h - c)
        out[at] = h
    return out


def plain_pool(model, text):
    total = np.zeros(len(model.langs))
    for lo in range(0, len(text), langid.SEGMENT):
        hi = min(lo + langid.SEGMENT, len(text))
        ahead, behind = plain_run(model.forward, text, lo, hi, 1), plain_run(model.backward, text, lo, hi, -1)
        for at in range(lo, hi):
            z = model.heads @ np.concatenate([ahead[at], behind[at]]) + model.bias[:, 0]
            p = np.exp(z - z.max())
            total += p / p.sum()
    return total / len(text)


def test_states_and_pools_equal_a_byte_by_byte_run():
    draw = np.random.default_rng(2)
    model = langid.new_model(["a", "b", "c"], 6)
    texts = [draw.integers(0, 256, n).astype(np.uint8).tobytes() for n in (1, 5, 127, 128, 129, 300, 1000)]
    got = model.pool(texts)
    assert np.allclose(got, [plain_pool(model, t) for t in texts], atol=1e-4)
    assert np.allclose(got.sum(1), 1, atol=1e-4)


def test_gradients_equal_differences():
    model = langid.new_model(["a", "b", "c"], 5)
    for net in (model.forward, model.backward):
        net.table, net.state = net.table.astype(float), net.state.astype(float)
    model.heads, model.bias = model.heads.astype(float), model.bias.astype(float)
    draw = np.random.default_rng(1)
    x, live, lang = draw.integers(0, 9, (7, 4)).astype(np.intp), np.array([4, 4, 3, 3, 2, 1, 1]), np.array([0, 2, 1, 0])
    _, gradients = model.gradients(x, live, lang)
    for w, d in zip(model.weights(), gradients, strict=True):
        for i in np.argsort(-np.abs(d).ravel())[:5]:
            at, h = np.unravel_index(i, d.shape), 1e-2
            w[at] += h
            up = model.gradients(x, live, lang)[0]
            w[at] -= 2 * h
            down = model.gradients(x, live, lang)[0]
            w[at] += h
            assert d[at] == pytest.approx((up - down) / (2 * h), rel=0.02, abs=1e-4)


def test_held_out_languages_are_found(spark):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    got = {r.doc_id: r for r in langid.identify(docs, langid.train(docs, steps=200)).collect()}
    told = [(r.lang, got[r.doc_id]) for r in docs.select("doc_id", "lang").collect()]
    assert len(told) == len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for _, r in told)
    held = [lang == r.lang_pred for lang, r in told if r.held_out]
    assert len(held) > 100 and sum(held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for _, r in told)


def test_labels_of_held_out_rows_and_other_columns_are_not_read(spark, corpus):
    rows = corpus.collect()
    held = lambda d: zlib.crc32(str(d).encode()) % 4 == 2
    other = spark.createDataFrame([(r.doc_id, r.text, "xx" if held(r.doc_id) else r.lang, "z", 0) for r in rows], SCHEMA)
    a, b = langid.train(corpus, steps=3), langid.train(other, steps=3)
    assert a.langs == b.langs and all(np.array_equal(x, y) for x, y in zip(a.weights(), b.weights(), strict=True))


def test_languages_of_odd_rows(spark, odd, empty):
    model = langid.fit([b"the and of", "é è à".encode()], ["en", "fr"], steps=2)
    got = langid.identify(odd.selectExpr("*", "1 as held_out", "2 as score", "'x' as parts"), model)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rows = got.collect()
    assert len(rows) == odd.count()
    assert {r.lang_pred for r in rows if r.doc_id in (1, 2, 3)} == {"und"} and all(r.score == 0 for r in rows if r.doc_id in (1, 2, 3))
    assert all(r.lang_pred in ("en", "fr") and r.score >= 0.5 for r in rows if r.doc_id not in (1, 2, 3))
    assert [r.held_out for r in rows if r.doc_id is None] == [True]
    assert langid.identify(empty, model).collect() == []
    assert langid.train(empty) is None and {r.lang_pred for r in langid.languages(odd.withColumn("lang", odd.text.substr(1, 0)).where("false")).collect()} == set()
    assert {r.lang_pred for r in langid.identify(odd, None).collect()} == {"und"}


def test_training_rows_are_bounded_and_repeats_count_once(spark):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 != 2][:40]
    rows = [(i, f"text {i} " + "word " * 400) for i in ids] + [(ids[0], "another text")] * 300 + [(None, "no id")]
    got = langid.training_rows(frame(spark, rows), per_lang=30, per_doc=2).collect()
    assert len(got) == 30 == len({r.doc_id for r in got}) and all(1 <= len(r.parts) <= 2 for r in got)
    unknown = spark.createDataFrame([(i, "text", None, "s", 4) for i in ids], SCHEMA)
    assert langid.training_rows(unknown).collect() == []


@pytest.mark.parametrize("text, letters", [(b"", False), (b"12 %\n", False), ("é".encode(), True), ("中".encode(), True), (b"1a", True), ("१२".encode(), False)])
def test_letters(text, letters):
    assert langid.has_letter(text) == letters


# ── token alignment ─────────────────────────────────────────────────────────


def plain_align(rows):
    """Tokens of whole texts, groups and links from the token that each byte belongs to."""
    a_coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_coder.encode_special_tokens = True
    b_coder = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = align.byte_letters()
    count, docs = Counter(), []
    for doc, text in rows:
        a, b, groups, links = [], [], [], []
        if text:
            whole = (" " + text).encode()
            e = a_coder.encode(" " + text, add_special_tokens=False)
            a, b = e.ids, b_coder.encode(text)
            parts = [[bytes(letters[c] for c in t) for t in e.tokens], []]
            for i in b:
                p = b_coder.id_to_piece(i)
                parts[1].append(bytes([int(p[3:5], 16)]) if b_coder.is_byte(i) else p.replace("▁", " ").encode())
            if any(b"".join(p) != whole for p in parts):
                a = b = []
            else:
                own = [[k for k, x in enumerate(p) for _ in x] for p in parts]
                links = [(a[x], b[y]) for x, y in sorted(set(zip(*own, strict=True)))]
                lo = 0
                for hi in range(1, len(whole) + 1):
                    if hi == len(whole) or all(o[hi - 1] != o[hi] for o in own):
                        groups.append("|".join(",".join(str(ids[k]) for k in sorted(set(o[lo:hi]))) for ids, o in zip((a, b), own, strict=True)))
                        lo = hi
        count.update(set(links))
        docs.append((doc, len(a), len(b), groups, links))
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for doc, n_a, n_b, groups, links in docs:
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else ""
        out.append((doc, n_a, n_b, len(groups), len(links), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links), sha))
    return sorted(out, key=str)


STRANGE = [
    " a", "a ", "a  b", "\n b", "a\n  b", "x▁ y", "x ▁y", "▁▁ z", "  ", " ", "\n", "日本 語\U0001f9d0 x", "a\tb \t c", "<|endoftext|> b", "<s> </s> <unk>",
    "\x1c b", "!\x1c !", "'s 's", "don't  stop", "a\r\n b", "a  b​ c", "﻿ a", "0 1  2", "\x00 a", "ﬁ a", "é x", "a\u0085 b", "᠎ b", "a　 b  c",
    "x" * 5000, "é" * 700 + " " + "中" * 300, "ab " * 3000, "\U0001f468‍\U0001f469‍\U0001f467 ok", "tab\tend\t", "\x7f del", "a\n\n\n   b\n",
]


def test_alignment_of_strange_texts(spark):
    rows = [*enumerate(STRANGE), (None, None), (None, "no id"), (900, ""), (0, "repeated id"), (0, "repeated id")]
    got = align.align(spark.createDataFrame(rows, "doc_id long, text string"))
    assert rows_of(got) == plain_align(rows)


def test_alignment_of_documents(spark, corpus, odd):
    docs = corpus.select("doc_id", "text").limit(80).unionByName(odd.select("doc_id", "text"))
    rows = [tuple(r) for r in docs.collect()]
    # several blocks, and other columns by the names used inside
    given = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).selectExpr("*", "1 as block", "2 as pair", "3 as n", "'x' as hashes")
    assert rows_of(align.align(given)) == plain_align(rows)


def test_alignment_of_an_empty_table(spark, empty):
    got = align.align(empty)
    assert got.collect() == [] and got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_units_are_forgotten_and_long_ones_not_remembered(monkeypatch):
    coder = align.Aligner(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    assert coder.cuts
    monkeypatch.setattr(align, "CACHE_BYTES", 50_000)
    for lo in range(0, 2000, 100):
        names = [f"w{i}" for i in range(lo, lo + 100)] + ["y" * 1000]
        assert [len(u[5]) > 0 for u in coder.units(names)] == [True] * 101
        assert len(coder) < 400 and "y" * 1000 not in coder


def test_aligners_are_given_back_once_blocks_are_written(monkeypatch):
    class Blocks:
        select = lambda self, *columns: self
        mapInArrow = lambda self, run, kind: run

    monkeypatch.setattr(align, "_ALIGNERS", {("a", "b"): object()})
    assert not list(align.block_pairs(Blocks())([])) and not align._ALIGNERS


def test_spans_are_refined_where_they_do_not_fit():
    ends = lambda spans, sizes: align.token_ends(*np.array(spans).T, np.array(sizes)).tolist()
    # two tokens of one character of three bytes, both with its span, then a letter
    assert ends([(0, 3), (0, 3), (3, 4)], [2, 1, 1]) == [2, 3, 4]
    # byte-fallback tokens without a span, before the one that has it
    assert ends([(0, 2), (2, 2), (2, 2), (2, 6), (6, 7)], [2, 1, 1, 2, 1]) == [2, 3, 4, 6, 7]
    # a span that disagrees with the bytes
    assert ends([(0, 5), (5, 6)], [2, 4]) == [2, 6]
    # " é日", then "x" of another unit
    assert align.byte_places(" é日x").tolist() == [0, 1, 3, 6, 7]
    a, b = (np.array([7, 8, 9]), np.array([1, 3, 4])), (np.array([5, 6, 4]), np.array([2, 3, 4]))
    units = align.line_up(*a, *b, np.array([3, 4]))
    assert [u[:5] for u in units] == [(2, 2, 1, 3, b"7,8|5,6"), (1, 1, 1, 1, b"9|4")]
    assert [[(x >> 32, x & 0xFFFFFFFF) for x in np.frombuffer(u[5], "<u8").tolist()] for u in units] == [[(7, 5), (8, 5), (8, 6)], [(9, 4)]]


def test_arrow_splits_texts_into_the_units_of_the_regular_expression():
    coder = align.aligner(None, None)
    texts = ["", "a b  c", "one two two", " led", "trailed ", "x\ty z", "  q", "hé 日本 hé", "a", "\n", "a \nb c"]
    names, places = align._places([t.encode() for t in texts], coder)
    assert [[names[k] for k in p] for p in places] == [coder.split(t) if t else [] for t in texts]
    assert len(set(names)) == len(names)
    assert [len(p) for p in align._places([], coder)[1]] == [] and align._places([b""], coder)[0] == []
    assert align.CACHE_BYTES <= 64 << 20


def test_units_of_all_runs_are_lined_up_at_once_and_those_met_once_not_remembered(monkeypatch):
    coder = align.Aligner(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    names = ["hé", "日本", "x\t", "\n", "\U0001f600b", *(f"w{i}é" for i in range(6000)), "y" * 9000]
    want = {u: coder.learn([u])[u] for u in names}
    calls, line_up = [], align.line_up
    monkeypatch.setattr(align, "line_up", lambda *a: (calls.append(1), line_up(*a))[1])
    assert len(coder.runs(names)) > 5 and coder.learn(names) == want and len(calls) == 1
    # one unit that isn't given back leaves the others of its run as they are
    odd = [*names[:50], "\u2581x", *names[50:]]
    got = coder.learn(odd)
    assert got.pop("\u2581x") is None and got == want
    block = align._block(0, [1, 2], [b"one two two", b"one three"], coder)
    assert block.num_rows == 1 and set(coder) == {"one", "two"}
    assert coder.units(["one", "four"], np.array([False, False]))[0] is coder["one"] and "four" not in coder


def test_numbers_of_a_block_take_as_few_bytes_as_they_need():
    for values in ([], [0], [255, 3], [256, 0], [65_536], [1 << 32, 7]):
        packed = align._packed(np.array(values, np.int64))
        assert align._unpacked(packed).tolist() == values
        assert len(packed) == 1 + len(values) * (1 if max(values, default=0) < 256 else 2 if max(values) < 65_536 else 4 if max(values) < 1 << 32 else 8)
    coder = align.Aligner(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    block = align._block(0, [1, 2], [b"one two two", b"one three"], coder).to_pylist()[0]
    assert (block["units"], block["unit_sizes"]) == (bytes([0, 1, 1, 0, 2, 1]), bytes([3, 2, 1]))


def test_blocks_lie_in_row_groups_of_a_few_and_each_gives_its_memory_back(spark, tmp_path, monkeypatch):
    docs = spark.range(60).select(F.col("id").alias("doc_id"), F.concat(F.lit("some words of "), F.col("id"), F.lit(" and more")).alias("text")).coalesce(1)
    want = rows_of(align.align(docs))
    monkeypatch.setattr(align, "BLOCK_BYTES", 100)
    monkeypatch.setattr(align, "ROW_GROUPS", align.ROW_GROUPS | {"parquet.block.size": "4000"})
    monkeypatch.setattr(align, "scratch_path", lambda *a: f"{tmp_path}/blocks")
    assert rows_of(align.align(docs)) == want
    (file,) = (tmp_path / "blocks").glob("*.parquet")
    groups = pq.ParquetFile(file).metadata
    assert groups.num_rows == 15 and groups.num_row_groups >= 3
    freed, runs = [], []

    class Docs:
        select = lambda self, *columns: self
        mapInArrow = lambda self, run, kind: runs.append(run)

    monkeypatch.setattr(align, "release", lambda: freed.append(1))
    monkeypatch.setattr(align, "TaskContext", type("Task", (), {"get": lambda: type("One", (), {"partitionId": lambda self: 0})()}))
    align.encode_blocks(Docs())
    assert len(list(runs[0]([pa.record_batch({"doc_id": range(60), "text": ["some words and more"] * 60})]))) == len(freed) == 10
