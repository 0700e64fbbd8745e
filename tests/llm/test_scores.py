from __future__ import annotations

import numpy as np
import pytest

from cobasket.llm import quality_rank, toxicity

from .conftest import frame

SF = "/root/testdata/sf0.1"


def held_rates(rows, labels, wanted):
    """Share of held-out labelled rows that are predicted right, for label 1 and label 0."""
    right = {0: [], 1: []}
    for r in rows:
        label = labels.get(r.doc_id)
        if label is not None and quality_rank.is_held_out(r.doc_id):
            right[label].append(r.predicted == label)
    return [float(np.mean(right[k])) for k in wanted]


def test_quality_of_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_rank.rank(docs, labels).collect()
    good, bad = held_rates(rows, {r.doc_id: r.quality for r in labels.collect()}, (1, 0))
    assert len(rows) == 10_000 and good > 0.97 and bad > 0.9
    assert all(0 <= r.score <= 1 and r.held_out == quality_rank.is_held_out(r.doc_id) and r.predicted == (r.score >= 0.5) for r in rows)


def test_toxicity_of_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.rate(docs, labels).collect()
    toxic, clean = held_rates(rows, {r.doc_id: r.toxic for r in labels.collect()}, (1, 0))
    assert len(rows) == 10_000 and toxic > 0.9 and clean > 0.99
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_labels_of_held_out_rows_change_nothing(spark, corpus):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    flipped = labels.selectExpr("doc_id", *[f"IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 = 1, 1 - {c}, {c}) AS {c}" for c in ("quality", "toxic")])
    for f in (quality_rank.rank, toxicity.rate):
        assert sorted(map(tuple, f(corpus, labels).collect())) == sorted(map(tuple, f(corpus, flipped).collect()))


def test_bradley_terry_weights_order_pairs():
    draw = np.random.default_rng(0)
    x = draw.standard_normal((400, len(quality_rank.FEATURES)))
    label = (x[:, 2] - x[:, 5] + 0.1 * draw.standard_normal(400) > 0.5).astype(int)
    model = quality_rank.fit(x, label, pairs=5000)
    s = model.scores(x)
    assert (s[label == 1][:, None] > s[label == 0]).mean() > 0.98
    # the threshold is the quantile at the share of label 0
    assert (s < 0.5).sum() == (label == 0).sum()


def test_newton_finds_the_minimum():
    draw = np.random.default_rng(1)
    x, y = draw.standard_normal((300, 4)), draw.choice([-1.0, 1.0], 300)
    w = quality_rank.logistic(x, 0.01, y)
    loss = lambda w: np.logaddexp(0, -y * (x @ w)).mean() + 0.005 * w @ w
    assert all(loss(w) <= loss(w + 1e-3 * draw.standard_normal(4)) for _ in range(50))


def test_the_label_model_finds_good_and_copied_voters():
    draw = np.random.default_rng(2)
    y = draw.random(4000) < 0.2
    vote = lambda hit, false: np.where(draw.random(4000) < np.where(y, hit, false), 1, 0)
    a, b, c, noise = vote(0.8, 0.01), vote(0.7, 0.02), vote(0.75, 0.01), vote(0.3, 0.3)
    clean = np.where(draw.random(4000) < np.where(y, 0.1, 0.9), -1, 0)
    v = np.stack([a, b, c, noise, clean, noise], 1)
    model = toxicity.label_model(v, 0.2)
    post = model.posterior(v)
    assert ((post > 0.5) == y).mean() > 0.95
    assert model.rates[1, 0, 2] > 0.7 > 0.1 > model.rates[0, 0, 2]
    assert model.correlation[3, 5] > 0.9 and model.weight[3] < 0.7 < model.weight[0]


@pytest.mark.parametrize("module,name,neutral", [(quality_rank, "quality", 0.5), (toxicity, "toxic", 0.0)])
def test_odd_inputs(spark, odd, empty, corpus, module, name, neutral):
    f = {"quality": quality_rank.rank, "toxic": toxicity.rate}[name]
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = f(odd, none).collect()
    assert len(rows) == odd.count() and all(abs(r.score - neutral) < 1e-3 for r in rows)
    assert [r.held_out for r in rows if r.doc_id is None] == [True]
    one = spark.createDataFrame([(9, 1, 1), (13, None, None), (None, 1, 0), (5, 7, 9), (9, 0, 0)], "doc_id long, quality int, toxic int")
    assert f(odd, one).count() == odd.count()
    both = spark.createDataFrame([(i, i % 2, i % 2) for i in range(15)], "doc_id long, quality int, toxic int")
    assert all(0 <= r.score <= 1 for r in f(odd, both).collect())
    assert f(empty, both).collect() == []
    clash = corpus.selectExpr("*", "1 AS label", "2 AS score", "3 AS known_id", "4 AS held_out", "5 AS toxic", "6 AS quality")
    assert f(clash, both).count() == 200


def test_terms_of_other_scripts_and_a_planted_word(spark):
    assert toxicity.terms_of("Ünglücklich-Öl7".encode())[:2] == ["4:üngl", "5:ünglü"]
    rows = [(i, f"wort{i % 50} satz{i % 31} " + ("schlimmwort" + "abc"[i % 3] if i % 5 == 0 else "gut")) for i in range(900)]
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(900)], "doc_id long, quality int, toxic int")
    got = toxicity.rate(frame(spark, rows), labels).collect()
    assert all(r.predicted == int(r.doc_id % 5 == 0) for r in got)
