"""The two classifiers against plain versions: scores by the formula, gradients by differences, samples without ties."""

import random
from math import exp, log

import numpy as np
import pytest
from pyspark.sql import functions as F

from civiclake.llm import hashed_text, quality, toxicity
from civiclake.llm.hashed_text import Sample, features

SF = "/root/testdata/sf0.001"


def sig(z):
    return 1 / (1 + exp(-z))


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def sample_of(texts, shapes, least=1):
    made = [features(t, shapes) for t in texts]
    return Sample([(i.astype(np.int32).tobytes(), v.astype(np.float32).tobytes()) for i, v in made], least=least)


def test_quality_scores(tables):
    """Expected grade and tails by the formula, one feature at a time."""
    docs, labels = tables
    m = quality.train_quality(docs, labels, quality.label_grade(), quality.GRADES)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert np.abs(m.weights).max() > 0 and (np.diff(m.cuts) > 0).all()
    for r in quality.score_quality(docs, m).collect():
        z = sum(m.weights[i] * v for i, v in zip(*map(list, features(texts[r.doc_id], True)), strict=True))
        tails = [sig(z - c) for c in m.cuts]
        assert abs(r.expected_grade - sum(tails)) < 1e-6 and abs(r.p_ge_1 - tails[0]) < 1e-6 and r.kept == (tails[0] >= 0.5)


def test_toxicity_scores(tables):
    docs, labels = tables
    m = toxicity.train_toxicity(docs, labels)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in toxicity.score_toxicity(docs, m).collect():
        p = []
        for c in range(len(toxicity.CATEGORIES)):
            z = m.bias[c] + sum(m.weights[i, c] * v for i, v in zip(*map(list, features(texts[r.doc_id], False)), strict=True))
            p.append(sig(max(-40, min(40, z + sum(m.links[c, e] * x for e, x in enumerate(p))))))
        assert max(abs(a - b) for a, b in zip(p, (r.p_toxic, r.p_strong, r.p_severe), strict=True)) < 1e-6


def test_ordinal_gradient(monkeypatch):
    """The fit's gradient against differences of the plain penalised likelihood."""
    rnd = random.Random(3)
    texts = [" ".join(rnd.choices("a b c d e f g".split(), k=6)) for _ in range(30)]
    grade = np.array([rnd.randrange(3) for _ in texts])
    s, held = sample_of(texts, False), []
    monkeypatch.setattr(quality, "adam", lambda grad, x, steps, rate: held.append(grad) or x)
    quality.fit_ordinal(s, grade, 3, ridge=1e-4)
    d = len(s.used)
    x = np.array([rnd.uniform(-1, 1) for _ in range(d + 2)])

    def loss(x):
        cuts, out = [x[d], x[d] + exp(x[d + 1])], 0.0
        for i, g in enumerate(grade):
            z = sum(v * x[c] for r, c, v in zip(s.row, s.col, s.val, strict=True) if r == i)
            tail = [1.0, sig(z - cuts[0]), sig(z - cuts[1]), 0.0]
            out -= log(tail[g] - tail[g + 1]) / len(grade)
        return out + 0.5e-4 * sum(w * w for w in x[:d])

    g, h = held[0](x), 1e-5
    for k in range(d + 2):
        e = np.zeros(d + 2)
        e[k] = h
        assert abs((loss(x + e) - loss(x - e)) / (2 * h) - g[k]) < 1e-6


def test_chain_is_out_of_fold():
    """Words that occur in one row each can't be learned from other folds: later links get no help from them."""
    texts = [f"only{i} common" for i in range(60)]
    s = sample_of(texts, False)
    y = np.array([[i % 2, i % 2] for i in range(60)])
    m = toxicity.fit_chain(s, y, np.arange(len(y)) % toxicity.FOLDS)
    p = m.predict(np.array([v @ m.weights[i] for i, v in (features(t, False) for t in texts)]))
    assert ((p[:, 0] > 0.5) == (y[:, 0] == 1)).all() and abs(m.links[1, 0]) < 1


def test_whole_words_count():
    """What follows character 64 of a word has its part in the features."""
    a, b = "x" * 200 + "1!x", "x" * 200 + "y"
    assert hashed_text.shape_feature(a) != hashed_text.shape_feature(b) and hashed_text.word_feature(a) != hashed_text.word_feature(b)


def test_sample_is_settled(spark):
    """Disagreeing labels and repeated documents of one id: one row, the smallest of each, on every order of the input."""
    labels = [(1, 1, 0), (1, 0, 1), (1, None, 1), (2, 1, 0), (3, 1, None), (None, 1, 1), (4, 1, 1)]
    docs = [(1, "b b"), (1, "a a"), (1, None), (2, None), (3, "three"), (9, "nine"), (None, "none")]
    for seed in range(3):
        random.Random(seed).shuffle(labels)
        random.Random(seed).shuffle(docs)
        lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
        d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
        got = hashed_text.training_sample(d, lab, [F.col("quality")], 10, True)
        assert [(r.id, r.t0) for r in got] == [(1, 0), (2, 1), (3, 1)]
        assert np.frombuffer(got[0].i, np.int32).tolist() == features("", True)[0].astype(np.int32).tolist()


def test_sample_takes_documents_before_its_bound(spark):
    """Labels without a document take no place, and copies of a text share a hash, by which folds go."""
    labels = spark.range(20000).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS quality", "CAST(id % 3 = 0 AS INT) AS toxic")
    docs = spark.range(300).selectExpr("id * 61 AS doc_id", "concat('text ', id % 100) AS text")
    for bound in (100, 300, 6000):
        got = hashed_text.training_sample(docs, labels, [F.col("quality")], bound, False)
        assert len(got) == min(300, bound) and {r.id % 61 for r in got} == {0}
    by = {}
    for r in got:
        by.setdefault(r.id // 61 % 100, set()).add(r.h)
    assert len(by) == 100 and all(len(h) == 1 for h in by.values()) and len({h for s in by.values() for h in s}) == 100
    with pytest.warns(UserWarning, match="no labelled documents"):
        assert not hashed_text.training_sample(docs, labels.where("doc_id < 0"), [F.col("quality")], 10, False)
