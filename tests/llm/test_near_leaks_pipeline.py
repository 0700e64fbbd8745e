from __future__ import annotations

import itertools
import math
import random

import numpy as np
import pytest

import corpus_pipeline
from cobasket.llm import leaks, lines, near, rules

from .conftest import SF, frame
from .test_lines_windows_rules import plain_lines


def shingle_set(text):
    w = (text or "").encode().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def plain_classes(rows):
    """The smallest doc_id of each connected component of pairs with Jaccard similarity 0.8 or more."""
    sets = [(d, shingle_set(t)) for d, t in rows if d is not None]
    parent = {d: d for d, _ in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for (a, x), (b, y) in itertools.combinations(sets, 2):
        if x and y and len(x & y) >= 0.8 * len(x | y):
            parent[max(root(a), root(b))] = min(root(a), root(b))
    return {d: root(d) for d in parent}


@pytest.mark.parametrize("name", ["corpus", "odd"])
def test_classes_as_defined(request, name):
    docs = request.getfixturevalue(name)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = near.classes(docs).collect()
    assert len(got) == len(rows)
    want = plain_classes(rows)
    assert {r.doc_id: r.class_id for r in got if r.doc_id is not None} == want
    assert all(r.class_id is None for r in got if r.doc_id is None)


@pytest.mark.parametrize("small,block", [(8, 512), (2, 16)])
def test_a_large_cluster_of_near_copies(spark, small, block):
    """Edits of one text, chains between them, and copies: many are not similar to the same pivot."""
    draw = random.Random(4)
    base = [f"w{draw.randrange(500)}" for _ in range(120)]
    rows, text = [], base
    for i in range(160):
        text = list(base if i % 3 else text)
        for _ in range(1 + i % 4):
            text[draw.randrange(120)] = f"e{i}x{draw.randrange(9)}"
        rows.append((1000 - i, " ".join(text)))
    rows += [(2000 + i, rows[i % 5][1]) for i in range(60)] + [(3000, "lonely " * 3), (3001, "lonely lonely lonely")]
    got = near.classes(frame(spark, rows).repartition(4), small=small, block=block).collect()
    assert {r.doc_id: r.class_id for r in got} == plain_classes(rows)


def test_copies_that_repeat_a_section(spark):
    """Set similarity 0.8 or a little more, a section of one text alone repeated 5 to 50 times."""
    rows = []
    for i in range(200):
        words = [f"w{i}x{j}" for j in range(400)]
        section = " ".join(words[:100])
        times = (5, 10, 50)[i % 3]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join([section] * times + words[100:330 + i % 20]))]
    got = {r.doc_id: r.class_id for r in near.classes(frame(spark, rows).repartition(4)).collect()}
    assert got == plain_classes(rows)
    assert sum(got[2 * i + 1] == 2 * i for i in range(200)) == 200


def test_texts_with_repeats_are_banded_by_counts_and_by_sets(spark):
    """Weights 1 + ln(count) and weights 1, in the same bands; each key once."""
    once = " ".join(f"w{i}" for i in range(90))
    texts = [once, f"{once} {once}", f"{once} {once} w1 w2 w3 w4 w5 w6", "", None, "a a a"]
    got = {r.doc_id: r for r in near.sign(frame(spark, list(enumerate(texts)))).collect()}
    for i, text in enumerate(texts):
        key, count = np.unique(near.shingles((text or "").encode().split()), return_counts=True)
        assert got[i].shingles == len(key)
        both = [near.band_keys(near.signatures([key], [w], near.BANDS * near.ROWS), near.BANDS, near.ROWS)[0].view(np.int64).tolist() for w in (1 + np.log(count), np.ones(len(key)))]
        assert sorted(got[i].bands) == sorted(set(both[0] + both[1])) and len(both[0]) == near.BANDS
    assert len(got[0].bands) == near.BANDS < len(got[2].bands)


def test_signatures_estimate_the_probability_jaccard():
    draw = np.random.default_rng(1)
    keys = draw.integers(1, 2**63, 60).astype(np.uint64)
    a, b = draw.integers(1, 5, 60).astype(float), draw.integers(1, 5, 60).astype(float)
    a[:10], b[50:] = 0, 0
    exact = sum(1 / sum(np.maximum(a / a[i], b / b[i])) for i in range(60) if a[i] and b[i])
    s = near.signatures([keys[a > 0], keys[b > 0], keys[:0], keys[:1]], [a[a > 0], b[b > 0], a[:0], np.ones(1)], 2000)
    assert abs((s[0] == s[1]).mean() - exact) < 0.05
    assert not s[2].any() and (s[3] == keys[0]).all()


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 150)] + [(150, 149), (7, 7), (300, 200)]
    got = {r.node: r.class_id for r in near.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 151)} | {200: 200, 300: 200}
    assert near.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_keep_one_loses_no_text_of_a_repeated_doc_id(spark):
    text = lambda n: " ".join(f"w{n}x{i}" for i in range(40))
    rows = [(1, text(1)), (1, text(2)), (1, text(2)), (2, text(3)), (3, text(3)), (5, text(4)), (5, text(1)), (6, None), (6, ""), (None, text(1))]
    got = sorted(((r.doc_id, r.text) for r in near.keep_one(frame(spark, rows)).collect()), key=str)
    # 3 is a copy of 2; the texts of 5 stay, as one of them has no copy; of equal rows one stays
    assert [d for d, _ in got] == [1, 1, 2, 5, 5, 6, None] and {t for _, t in got if t} == {text(n) for n in (1, 2, 3, 4)}


def test_keep_one_keeps_columns_and_one_of_each_class(spark, corpus, odd, empty):
    clash = corpus.selectExpr("*", "1 AS rep", "2 AS class_id", "3 AS doc", "4 AS id", "5 AS turn")
    kept = near.keep_one(clash)
    want = plain_classes([(r.doc_id, r.text) for r in corpus.collect()])
    assert kept.columns == clash.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))
    rows = [r.doc_id for r in near.keep_one(odd).collect()]
    assert rows.count(None) == 1 and len(rows) == len(set(rows)) and 12 not in rows[:0]
    assert near.keep_one(empty).collect() == [] and near.classes(empty).collect() == []


def items_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def test_benchmark_passages_are_found(spark, corpus):
    """Every whole passage, some of them reworded, inside longer documents; nothing else."""
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    draw = random.Random(8)
    texts = {r.item_id: r.text for r in bench.collect()}
    clean = [r.text for r in corpus.collect() if not any(t in (r.text or "") for t in texts.values())]
    rows, want = [], set()
    for k, t in texts.items():
        words = t.split()
        if k % 2:  # one word of seven replaced
            words = [w if i % 7 != 3 else "other" for i, w in enumerate(words)]
        host = clean[k % len(clean)].split()
        at = draw.randrange(len(host) + 1)
        rows.append((k, " ".join(host[:at] + words + host[at:])))
        want.add((k, k))
    rows += [(1000 + i, t) for i, t in enumerate(clean)]
    got = leaks.find_leaks(frame(spark, rows), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want
    assert all(0 < r.common <= 1 and 0 < r.cosine <= 1.001 for r in got)


def test_longest_common_subsequence():
    draw = random.Random(3)
    for _ in range(200):
        a, b = (["abcd"[draw.randrange(4)] for _ in range(draw.randrange(1, 12))] for _ in "xy")
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, j in itertools.product(range(len(a)), range(len(b))):
            table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
        places = {}
        for i, w in enumerate(a):
            places[w] = places.get(w, 0) | 1 << i
        assert leaks.common_length(places, len(a), b) == table[-1, -1]


def test_the_answer_decides_between_half_matches():
    words = "which river runs through the old town of the north ? it is the winding alder river".split()
    item = leaks.read_items([type("R", (), {"item_id": 1, "text": " ".join(words)})])[0]
    assert item.answer == "it is the winding alder river".split()
    question, whole = words[:11] + ["x"] * 6, words
    assert leaks.matches(item, whole, 0.6) == (1.0, 1.0)
    assert leaks.matches(item, question, 0.6) is None and leaks.matches(item, ["q"] * 20, 0.6) is None


def test_recall_of_the_candidate_search(spark, corpus):
    """Against brute force: windows that hold at least four fifths of an item's words are candidates for nine of ten."""
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    vectors = leaks.latent_space(corpus, bench, leaks.inverse_frequencies(corpus))
    items, found, draw = leaks.read_items(bench.collect()), [], random.Random(2)
    host = next(r.text for r in corpus.collect() if len(r.text) > 3000).encode().split()
    for item in items:
        words = [w.encode() for w in item.words]
        words = [w if draw.random() < 0.85 else draw.choice(host) for w in words]
        vector = lambda ws: leaks.unit(vectors[leaks.TermNumbers().of(ws)].sum(0)[None])[0]
        shift = len(words) // 6
        window = host[:shift] + words[: len(words) - shift]
        found.append(float(vector(window) @ vector([w.encode() for w in item.words])) >= leaks.MIN_COSINE)
    assert np.mean(found) >= 0.9


def test_the_latent_space_is_fitted_on_every_document(spark):
    """Any one document's words change it, and the product is A'(AQ) over all passages, by loops."""
    draw = random.Random(31)
    texts = [" ".join(f"w{draw.randrange(300)}" for _ in range(draw.choice([0, 1, 47, 48, 49, 130]))) for _ in range(2100)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(2100, None), (None, "held by none but this one")]
    docs, bench = frame(spark, rows), items_of(spark, ["w1 w2 w3 w4 w5 w6 w7 w8 w9"])
    idf = leaks.inverse_frequencies(docs)
    held = {n for w in texts for n in set(leaks.TermNumbers().of([x.encode() for x in w.split()]).tolist())}
    vectors = leaks.latent_space(docs, bench, idf, rank=8)
    assert all(vectors[n].any() for n in held)
    own = leaks.TermNumbers().of([b"held", b"none", b"but"])
    assert vectors[own].any(axis=1).all()  # the one document without an id
    q = np.random.default_rng(3).standard_normal((leaks.TERMS, 5)).astype(np.float32)
    want = np.zeros(q.shape)
    for _, text in rows:
        numbers = leaks.TermNumbers().of((text or "").encode().split())
        for lo in range(0, len(numbers), leaks.PASSAGE):
            x = np.bincount(numbers[lo : lo + leaks.PASSAGE], minlength=leaks.TERMS) * idf
            x /= np.linalg.norm(x)
            some = np.flatnonzero(x)
            want[some] += np.outer(x[some], x[some] @ q[some])
    got = leaks.product(leaks.numbers_of(docs.repartition(70)), idf, q)
    assert np.allclose(got, want, atol=1e-3 * np.abs(want).max())


def test_term_numbers_follow_normal_words():
    """Words of one normal form have one number, other words other numbers but for chance; texts are cut as ``split`` does."""
    draw, signs = random.Random(5), ["a", "B", "Ä", "ß", "é", "×", "÷", "ÿ", "Σ", "İ", "ж", "Ж", "“", ".", "!", "_", "-", "9", "$", "\x1c", "\xa0", "😀"]
    words = ["".join(draw.choice(signs) for _ in range(draw.randrange(1, 6))).encode() for _ in range(8000)] + [b"Y" * 300_000, b"." * 300_000]
    numbers, seen = leaks.TermNumbers().of(words).tolist(), {}
    assert len(numbers) == len(words) and all(seen.setdefault(leaks.normal(w), n) == n for w, n in zip(words, numbers, strict=True))
    want = leaks.TERMS * (1 - math.exp(-len(seen) / leaks.TERMS))  # numbers in use if they fall evenly
    assert abs(len(set(seen.values())) - want) < 0.05 * want
    texts = [b"", b" a b\t", b"", b"c" * 400_000 + b" d", b" \n\x0b ", b"e"]
    assert leaks.TermNumbers().of_texts(texts)[1].tolist() == [0, 0, 2, 2, 4, 4, 5] and leaks.TermNumbers().of_texts([])[1].tolist() == [0]


def test_shared_terms_and_window_sums():
    rng = np.random.default_rng(4)
    numbers, sizes = rng.integers(0, leaks.TERMS, 700), np.array([0, 5, 400, 1, 0, 294])
    held = np.zeros((3, leaks.TERMS // 8), np.uint8)
    own = [set(rng.choice(numbers, 200).tolist()) for _ in range(3)]
    for i, terms in enumerate(own):
        for t in terms:
            held[i, t >> 3] |= 1 << (t & 7)
    begin = rng.integers(0, 690, 500)
    end, item = begin + rng.integers(1, 11, 500), rng.integers(0, 3, 500)
    got = leaks.shared_terms(numbers, begin, end, item, held)
    assert got.tolist() == [sum(int(n) in own[k] for n in numbers[a:b]) for a, b, k in zip(begin, end, item, strict=True)]
    vectors = np.vstack([rng.standard_normal((leaks.TERMS, 6)), np.zeros((1, 6))]).astype(np.float32)
    starts = np.cumsum(sizes) - sizes
    for grain, size in itertools.product((1, 3), (2, 18, 40)):
        covered = [np.zeros(n, bool) for n in sizes]
        for docs, a, b, x in leaks.Windows(numbers, sizes, vectors, grain).of_size(size, 7):
            for d, lo, hi, v in zip(docs, a, b, x, strict=True):
                covered[d][lo:hi] = True
                assert hi - lo <= max(grain, round(size / grain) * grain)
                assert np.allclose(v, vectors[numbers[starts[d] + lo : starts[d] + hi]].sum(0), atol=1e-3)
        assert all(c.all() for c in covered)


def test_recall_of_the_search_against_all_windows(spark, corpus):
    """On the windows that ``search`` looks at: of passages that a walk over every window matches, at least 0.95 in each group."""
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    host = next(r.text for r in corpus.collect() if len(r.text) > 3000).split()
    items, draw, rows, groups = leaks.read_items(bench.collect()), random.Random(12), [], {}
    for kept, other in itertools.product((1.0, 0.85, 0.75, 0.65), ("replaced", "inserted", "dropped")):
        for item in items:
            words = []
            for w in item.words:
                stays = draw.random() < kept
                words += [w] if stays else []
                words += [draw.choice(host)] if other != "dropped" and (not stays) ^ (other == "inserted" and draw.random() > kept) else []
            at, n = draw.randrange(40), 2 * len(item.words)
            words = host[:at] + words + host[at : at + 60]
            plain = [leaks.normal(w.encode()) for w in words]
            if any(leaks.matches(item, plain[a : a + n], leaks.MIN_COMMON) for a in range(len(plain))):
                groups.setdefault((kept, other), set()).add((len(rows), item.item_id))
            rows.append((len(rows), " ".join(words)))
    rows += [(1_000_000 + i, r.text) for i, r in enumerate(corpus.collect())]
    got = {(r.doc_id, r.item_id) for r in leaks.find_leaks(frame(spark, rows), bench).collect()}
    recall = {k: len(v & got) / len(v) for k, v in groups.items()}
    assert min(map(len, groups.values())) >= 5 and min(recall.values()) >= 0.95, recall


def test_blocks_of_items_find_the_same(spark, corpus):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").limit(12)
    texts = [r.text for r in bench.collect()]
    docs = frame(spark, [(i, f"before it {t} and after") for i, t in enumerate(texts)])
    one, many = ({(r.doc_id, r.item_id) for r in leaks.find_leaks(docs, bench, item_bytes=n).collect()} for n in (1 << 20, 1200))
    assert one == many and len(one) >= len(texts)


def test_leaks_of_odd_inputs(spark, odd, empty, corpus):
    bench = items_of(spark, [None, "", " \n", "one", " ".join(f"b{i}" for i in range(30))])
    got = leaks.find_leaks(odd, bench).collect()
    assert [(r.doc_id, r.item_id) for r in got] == [(4, 3)]
    assert leaks.find_leaks(empty, bench).collect() == [] and leaks.find_leaks(odd, bench.limit(0)).collect() == []
    clash = corpus.selectExpr("*", "1 AS item_id", "2 AS chosen", "3 AS leaked", "4 AS doc")
    assert leaks.drop_leaks(clash, bench).columns == clash.columns
    copies = spark.createDataFrame([(5, "alpha beta gamma delta epsilon zeta eta theta iota kappa")] * 2 + [(None, "mu nu xi omicron pi rho sigma tau upsilon phi")], "item_id long, text string")
    texts = ["x alpha beta gamma delta epsilon zeta eta theta iota kappa y", "mu nu xi omicron pi rho sigma tau upsilon phi"]
    docs = frame(spark, [(1, texts[0]), (1, texts[0]), (None, texts[1])])
    assert sorted(((r.doc_id, r.item_id) for r in leaks.find_leaks(docs, copies).collect()), key=str) == sorted([(1, 5), (None, None)], key=str)


def test_pipeline_stage_by_stage(spark, corpus):
    """Each stage on what its predecessor kept, against the operators' own definitions."""
    docs = corpus
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "packing"]
    good = stages["quality_rules"](spark, docs, SF)
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in rules.report(docs).collect() if r.kept}
    good = spark.createDataFrame(good.collect(), docs.schema)
    short = stages["line_dedup"](spark, good, SF)
    assert short.columns == docs.columns and all(r.n_chars == len(r.text) for r in short.collect())
    assert sorted(map(tuple, lines.digest(lines.dedup_lines(good)).collect()), key=str) == plain_lines([(r.doc_id, r.text) for r in good.collect()])
    short = spark.createDataFrame(short.collect(), docs.schema)
    single = stages["near_dedup"](spark, short, SF)
    want = plain_classes([(r.doc_id, r.text) for r in short.collect()])
    assert single.columns == docs.columns and sorted(r.doc_id for r in single.collect()) == sorted(set(want.values()))
    single = spark.createDataFrame(single.collect(), docs.schema)
    fresh = stages["decontamination"](spark, single, SF)
    leaked = {r.doc_id for r in leaks.find_leaks(single, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert fresh.columns == docs.columns and {r.doc_id for r in fresh.collect()} == {r.doc_id for r in single.collect()} - leaked
    assert {r.doc_id for r in stages["packing"](spark, fresh, SF).collect()} == {r.doc_id for r in fresh.collect()}


def test_pipeline_runs_whole(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and {"doc_id", "sequence_id", "offset", "length"} <= set(rows[0].asDict())


def test_stages_take_odd_tables(spark, odd, empty):
    for docs in (odd, empty, odd.selectExpr("*", "1 AS doc", "2 AS kept")):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert name == "packing" or out.columns == docs.columns
            rows = out.collect()
            if name != "packing":
                docs = spark.createDataFrame(rows, docs.schema)


def test_tasks_hold_one_run_of_texts_and_leave_no_caches():
    import pyarrow as pa

    from cobasket.llm import text

    made, real = [], text.utf8
    batch = pa.record_batch([pa.array([f"word{i} " * 50 if i % 7 else None for i in range(300)])], names=["text"])

    def counted(column):
        made.append(len(column))
        return real(column)

    text.utf8 = counted
    try:
        got = [(b.num_rows, t) for b, t in text.chunks([batch], size=2000)]
    finally:
        text.utf8 = real
    assert max(made) < 20 and [n for n, _ in got] == made
    assert [x for _, t in got for x in t] == real(batch.column(0))
    near.shingles([b"a", b"b", b"c"])
    assert near._HASHES
    near.forget()
    assert not near._HASHES
