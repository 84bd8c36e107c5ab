"""Held-out quality of both classifiers on planted labels, their parts against brute force, and odd tables."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from onblock.llm import quality, toxicity
from onblock.llm.labelled import fold, labelled_sample


def prose(rng, n):
    return " ".join("".join(rng.choices("ab cd ef gh ij kl".split(), k=rng.randint(1, 3))) + rng.choice(["", "", ",", "."]) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(2)
    docs, labels = [(None, None)], [(None, 1, 0), (99_999, 0, 1), (5, None, None), (6, 7, 7)]
    for i in range(900):
        text = prose(rng, rng.randint(5, 200))
        good, toxic = int(i % 5 > 0), int(i % 7 == 0)
        if not good:
            text = " ".join(w + "###" for w in text.split()) if i % 2 else text.upper().replace(" ", "!! ")
        if toxic:
            words = text.split()
            for _ in range(3):
                words.insert(rng.randrange(len(words) + 1), rng.choice(["zunkel" + x for x in "abcdefgh"] + ["trobbel"]))
            text = " ".join(words)
        docs.append((i, text))
        labels.append((i, good, toxic))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def auc(rows):
    ordered = sorted(rows)
    ranks = {}
    for i, (s, _) in enumerate(ordered):
        ranks.setdefault(s, []).append(i + 1)
    good = [s for s, y in rows if y]
    total = sum(sum(ranks[s]) / len(ranks[s]) for s in good)
    return (total - len(good) * (len(good) + 1) / 2) / (len(good) * (len(rows) - len(good)))


def held_out(docs, labels, score, label, folds, held):
    scored = docs.filter(fold(F.col("doc_id"), folds) == held).select("doc_id", score.alias("score"))
    return [(r["score"], r[label]) for r in scored.join(labels, "doc_id").filter(F.col(label).isin(0, 1)).select("score", label).collect()]


def test_quality_on_held_out_rows(corpus):
    docs, labels = corpus
    model = quality.fit_quality(docs, labels)
    rows = held_out(docs, labels, quality.score(F.col("text"), model), "quality", 4, 2)
    assert auc(rows) > 0.98 and np.mean([(s >= 0.7) == bool(y) for s, y in rows]) > 0.95
    scores = [r[0] for r in docs.select(quality.score(F.col("text"), model)).collect()]
    assert len(scores) == 901 and all(0 <= s <= 1 for s in scores)


def test_toxicity_on_held_out_rows(corpus):
    docs, labels = corpus
    model = toxicity.fit_toxicity(docs, labels)
    rows = held_out(docs, labels, toxicity.score(F.col("text"), model), "toxic", 5, 0)
    assert auc(rows) > 0.97 and np.mean([(s >= 0.5) == bool(y) for s, y in rows]) > 0.95
    assert any(sign.startswith("zunk") for sign in model.voters.lexicon)


def test_every_marking_sign_is_in_the_lexicon(spark):
    """300 rare insults, each in a tenth of the toxic documents, below thousands of more frequent ordinary signs."""
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefghijklm", k=9)) for _ in range(900)]
    insults = ["z" + a + b for a in "nopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwx"][:300]
    rows = [(" ".join(rng.sample(words, 200) + (insults[i % 10 :: 10] if i < 100 else [])), int(i < 100)) for i in range(1_100)]
    lexicon = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, label int"))
    assert set(insults) <= set(lexicon)


def test_normal_equations_equal_the_whole_matrix(spark, corpus):
    docs, labels = corpus
    sample = labelled_sample(docs, labels, "quality", F.lit(True), 10_000)
    local = sample.collect()
    x = np.array([quality.statistics(r["text"]) for r in local])
    model = quality.Model(x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3), np.zeros(quality.FEATURES + 1), np.zeros(2), np.zeros(2))
    train = sample.repartition(5).select("label", quality._statistics("text").alias("x"))
    square, right = quality._normal_equations(train, model)
    z, y = model.cosines(x), np.array([r["label"] for r in local])
    assert np.allclose(square, z.T @ z) and np.allclose(right, z.T @ y)


def test_cosines_approximate_the_gaussian_kernel():
    rng = np.random.default_rng(0)
    model = quality.Model(np.zeros(14), np.ones(14), np.zeros(1), np.zeros(2), np.zeros(2))
    x = rng.normal(size=(60, 14))
    z = model.cosines(x)[:, :-1]
    kernel = np.exp(-((x[:, None] - x[None]) ** 2).sum(axis=2) / (2 * quality.BANDWIDTH**2))
    assert np.abs(z @ z.T - kernel).mean() < 0.06


def test_isotonic_is_the_best_monotone_fit():
    rng = np.random.default_rng(1)
    x, y, w = np.arange(30.0), rng.random(30), rng.integers(1, 5, 30).astype(float)
    knots, levels = quality.isotonic(x, y, w)
    assert (np.diff(levels) > 0).all() and (np.diff(knots) > 0).all()
    means = [max(min((y[i:j] * w[i:j]).sum() / w[i:j].sum() for j in range(k + 1, 31)) for i in range(k + 1)) for k in range(30)]
    assert np.allclose(sorted(set(np.round(means, 9))), np.round(levels, 9))


def test_label_model_outvotes_a_wrong_label():
    rng = np.random.default_rng(4)
    truth = rng.random(2_000) < 0.3
    votes = np.column_stack([rng.random(2_000) < np.where(truth, 0.9, 0.03) for _ in range(6)]).astype(float)
    label = np.where(rng.random(2_000) < 0.1, ~truth, truth).astype(float)
    posterior = toxicity.label_model(votes, np.ones(2_000), label)
    assert ((posterior > 0.5) == truth).mean() > 0.97


def test_sample_keeps_to_its_bound(corpus):
    docs, labels = corpus
    n = labelled_sample(docs, labels, "quality", F.lit(True), 300).count()
    assert 200 < n < 400
    assert labelled_sample(docs, labels, "quality", fold(F.col("doc_id"), 4) != 2, 10**6).filter(fold(F.col("key"), 4) == 2).count() == 0


@pytest.mark.parametrize("module", [quality, toxicity])
def test_without_labels(spark, module):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    fit = module.fit_quality if module is quality else module.fit_toxicity
    assert fit(docs, none) is None
    assert docs.select(module.score(F.col("text"), None)).count() == 2
