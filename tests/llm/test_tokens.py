from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cobasket.llm import packing, rans, text, tokens
from cobasket.session import scratch_path

TOKENIZER = Tokenizer.from_file(P.path("word_bpe_49k.json"))


def plain(value, end):
    return [*TOKENIZER.encode(value or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=40), max_size=5))
def test_word_by_word_ids_are_those_of_whole_texts(texts):
    texts = [*texts, "it's <|endoftext|> Á  x\x1fy\x85z w İSTANBUL ΣΑΣ"]
    got = text.word_ids(None).encode([t.encode() for t in texts])
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [plain(t, 0)[:-1] for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 5000), st.integers(1, 300), st.integers(0, 2**32 - 1), st.integers(1, 64))
def test_blocks_come_back_whole_and_in_part(n, symbols, seed, lanes):
    draw = np.random.default_rng(seed)
    ids = np.minimum(draw.geometric(0.1, n) - 1, symbols - 1).astype(np.uint32)
    freq = rans.quantise(np.bincount(ids, minlength=symbols))
    table = rans.Table(freq)
    assert freq.sum() in (0, 1 << rans.SCALE_BITS)
    payload = rans.encode(ids, table, lanes)
    assert rans.decode(payload, table).tolist() == ids.tolist()
    parts = rans.checkpoints(payload)
    assert [x for a, b in parts for x in rans.decode(payload, table, a, b).tolist()] == ids.tolist()
    lo, hi = sorted(draw.integers(0, n + 1, 2))
    assert rans.decode(payload, table, int(lo), int(hi)).tolist() == ids[lo:hi].tolist()


def test_a_block_has_checkpoints_and_few_bytes():
    ids = (np.random.default_rng(1).geometric(0.02, 200_000) - 1).astype(np.uint32)
    table = rans.Table(rans.quantise(np.bincount(ids)))
    payload = rans.encode(ids, table, 256)
    assert len(rans.checkpoints(payload)) > 5
    share = np.bincount(ids)[np.bincount(ids) > 0] / len(ids)
    assert len(payload) < 1.15 * len(ids) * -(share * np.log2(share)).sum() / 8


def test_quantise_keeps_rare_symbols():
    freq = rans.quantise(np.array([10**12, 0, 1, 1, 0]))
    assert freq.sum() == 1 << rans.SCALE_BITS and freq.tolist()[1:] == [0, 1, 1, 0]


@pytest.mark.parametrize("name", ["corpus", "odd"])
def test_files_hold_all_ids_in_order(spark, request, name):
    docs = request.getfixturevalue(name)
    path = scratch_path(spark, "t")
    tokens.write_tokens(docs, path, block_tokens=500, partitions=3)
    got = sorted(tokens.read_tokens(spark, path, with_ids=True).collect(), key=lambda r: r.start)
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start = 0
    assert len(got) == len(rows)
    for r, (doc, value) in zip(got, rows, strict=True):
        ids = plain(value, 2)
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc, start, len(ids), crc(ids))
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == ids
        start += len(ids)
    assert spark.read.parquet(f"{path}/blocks").count() > 3


def test_no_documents_and_other_columns(spark, empty, corpus):
    assert tokens.encoded_documents(spark, empty).collect() == []
    clash = corpus.selectExpr("*", "1 AS part", "2 AS row", "3 AS ids", "4 AS start").limit(3)
    assert tokens.encoded_documents(spark, clash).count() == 3
    assert packing.pack(empty).collect() == [] and packing.pack(clash.selectExpr("*", "9 AS length")).count() >= 3


def test_a_damaged_block_is_found(spark, corpus):
    from pyspark.sql import functions as F

    path, other = scratch_path(spark, "t"), scratch_path(spark, "t")
    tokens.write_tokens(corpus.limit(20), path)
    spark.read.parquet(f"{path}/table").write.parquet(f"{other}/table")
    spark.read.parquet(f"{path}/blocks").withColumn("crc32", F.col("crc32") + 1).write.parquet(f"{other}/blocks")
    with pytest.raises(Exception, match="checksum"):
        tokens.read_tokens(spark, other).collect()


@pytest.mark.parametrize("name", ["corpus", "odd"])
@pytest.mark.parametrize("window,max_open", [(2048, 4096), (64, 5)])
def test_packing_holds_every_id_once_without_padding(request, name, window, max_open):
    docs = request.getfixturevalue(name)
    rows = packing.pack(docs, window=window, max_open=max_open).collect()
    want = sorted(((r.doc_id, tuple(plain(r.text, 1))) for r in docs.collect()), key=str)
    places, pieces = {}, {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for own in places.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at and n > 0
            at += n
        assert at == window or at & (at - 1) == 0
    assert sum(n for own in places.values() for _, n in own) == sum(len(ids) for _, ids in want)
    copies = {}
    for doc, ids in want:
        copies.setdefault((doc, len(ids)), []).append(ids)
    assert set(copies) == set(pieces)
    for key, texts in copies.items():
        own = sorted(pieces[key], key=lambda r: r.start)
        assert sum(r.length for r in own) == key[1] * len(texts)
        for r in own:
            assert r.ids_crc32 in [crc(ids[r.start : r.start + r.length]) for ids in texts]


def test_a_placement_minimises_the_sum_of_squares():
    draw = np.random.default_rng(3)
    for _ in range(200):
        p = packing.Packer(32, 0, 1000)
        p.level[1:] = draw.integers(0, 3, 31)
        size = int(draw.integers(1, 32))

        def after(h, p=p, size=size):
            n = p.level.copy()
            if h:
                n[h] -= 1
            if h + size < 32:
                n[h + size] += 1
            return int((n[1:] ** 2).sum())

        legal = [h for h in range(32 - size + 1) if h == 0 or p.level[h]]
        least = min(map(after, legal))
        assert p.best(size) == max(h for h in legal if after(h) == least)


def test_words_cut_from_their_marks_encode_like_whole_texts():
    import random

    import public_tokenizers
    from tokenizers import Tokenizer

    from cobasket.llm import text

    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    coder = text.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    parts = ["The", "été,", "É.", "J̌.", "T̈x!", "…,", "×.", "÷,", "¡hola!", "it's,", "WE'LL.", "<|endoftext|>,", "<|ENDOFTEXT|>.", "a.b", "x,,y", "#tag", "$5,", "ß?", "İ,",
             "日本,", "1.5,", "!!!", "naïve;", "Ünïcödé:", "á.", "Å,", "e.g.,", "'s.", "ll'", "A&B", "50%,", "\x00,", "_a_.", "é" * 200 + ".", "q" * 300 + ","]
    draw = random.Random(6)
    texts = [*parts, *[draw.choice([" ", "\n", "  "]).join(draw.choices(parts, k=12)) for _ in range(200)], ""]
    want = [whole.encode(t, add_special_tokens=False).ids for t in texts]
    for lo in (0, 0, 100):
        got = [list(memoryview(x).cast("I")) for x in coder.encode([t.encode() for t in texts[lo:]])]
        assert got == want[lo:]
    assert all(len(w) <= text.LONG_WORD for w in coder)


def test_a_run_of_texts_looks_up_each_of_its_words_once():
    import public_tokenizers

    class Counted(text.WordIds):
        looked_up = 0

        def __getitem__(self, word):
            self.looked_up += 1
            return super().__getitem__(word)

    coder = Counted(public_tokenizers.path("word_bpe_49k.json"))
    got = coder.encode([b"the zebra, the zebra. ", b"", b"\n", b" Zebra the"] * 500)
    ids = {w: plain(w, 0)[:-1] for w in ("the", "zebra", ",", ".")}
    want = [[*ids["the"], *ids["zebra"], *ids[","], *ids["the"], *ids["zebra"], *ids["."]], [], [], [*ids["zebra"], *ids["the"]]] * 500
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == want
    assert coder.looked_up <= 5
    assert coder.encode([]) == [] and coder.encode([b""]) == [b""]
