import random
import zlib

import numpy as np
import pytest
from llm_helpers import make_docs, prose

from quarry.llm import toxicity
from quarry.llm.toxicity import Model, classify, drop_toxic, features, fit, swapped_sentences

INSULTS = ["idiot", "moronic", "grubkrat", "grubkrin", "grubklo"]


def sentence(rng, toxic):
    words = prose(rng, rng.randrange(8, 40)).split()
    if toxic:
        for _ in range(2):
            words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
    return " ".join(words)


def corpus(seed, count, group_bias=0.0):
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        toxic = int(rng.random() < 0.25)
        # with a bias, some texts are labelled for the group they name alone
        text = sentence(rng, toxic and rng.random() >= group_bias)
        if rng.random() < (0.05 + group_bias * toxic):
            text += ". A muslim neighbour came."
        rows.append((i, text, toxic))
    return rows


def frames(spark, rows):
    docs = make_docs(spark, [(i, t, "s") for i, t, _ in rows])
    labels = spark.createDataFrame(
        [(i, 1, y, "x") for i, _, y in rows], "doc_id long, quality int, toxic int, text string"
    )
    return docs, labels


def test_held_out_accuracy(spark):
    rows = corpus(1, 1200)
    got = {r.doc_id: r for r in classify(*frames(spark, rows)).collect()}
    assert len(got) == len(rows)
    right = []
    for i, _, y in rows:
        r = got[i]
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        if r.held_out:
            right.append(r.predicted == y)
    assert len(right) > 200 and np.mean(right) > 0.97


def test_held_out_labels_are_not_used(spark):
    rows = corpus(2, 400)
    docs, labels = frames(spark, rows)
    flipped = [(i, t, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y) for i, t, y in rows]
    a = {r.doc_id: r.score for r in classify(docs, labels).collect()}
    b = {r.doc_id: r.score for r in classify(docs, frames(spark, flipped)[1]).collect()}
    assert a == b


def test_neutral_mentions_of_groups_do_not_raise_the_score():
    """The name of a group goes with toxic texts in the training data; the
    penalty on swapped sentences keeps its weight down."""
    rows = corpus(3, 800, group_bias=0.6)
    texts, toxic = [t for _, t, _ in rows], np.array([float(y) for _, _, y in rows])
    import quarry.llm.toxicity as module

    fair = fit(texts, toxic, np.ones(len(toxic)))
    before = module.PENALTY
    try:
        module.PENALTY = 0.0
        plain = fit(texts, toxic, np.ones(len(toxic)))
    finally:
        module.PENALTY = before

    def gap(model):
        return model.weights.get("muslim", 0.0) - model.weights.get("sikh", 0.0)

    assert gap(plain) > 0.3 and abs(gap(fair)) < 0.5 * gap(plain)
    assert fair.score("the muslim family had dinner") < 0.3 < fair.score("you idiot, what an idiot")


def test_swapped_sentences():
    assert swapped_sentences("Nothing here. The Muslim man and two women!") == [
        ("the muslim man and two women", "the sikh man and two men")
    ]
    assert swapped_sentences(None) == []


def test_score_is_the_sum_of_feature_weights():
    rng = random.Random(5)
    weights = {f: rng.uniform(-1, 1) for t in ("idiot idiots idiotic", "w1 w2 longword longwords") for f in features(t)}
    model = Model(weights, -0.5)
    for text in ("Idiots, IDIOTIC idiot!", "longword x longwords w1", "", None, "plain"):
        z = -0.5 + sum(weights.get(f, 0.0) for f in features(text))
        assert abs(model.score(text) - 1 / (1 + np.exp(-z))) < 1e-12


def test_awkward_rows(spark, awkward):
    labels = spark.createDataFrame(
        [(3, 1), (3, 0), (5, None), (None, 1), (11, 0), (100, 1), (101, 0), (102, 0), (999, 1)],
        "doc_id long, toxic int",
    )
    got = classify(awkward, labels).collect()
    assert len(got) == awkward.count()
    scores = {}
    for r in got:
        scores.setdefault(r.doc_id, set()).add(r.score)
    assert len(scores[1] | scores[0]) == 1 and len(scores[7]) == 1
    kept = drop_toxic(awkward, labels)
    assert kept.columns == awkward.columns
    assert kept.count() == sum(not r.predicted for r in got)


@pytest.mark.parametrize("rows", [[], [(1, 1), (2, 1)], [(1, 0)]])
def test_labels_without_both_classes(spark, awkward, rows):
    labels = spark.createDataFrame(rows, "doc_id long, toxic int")
    scores = {r.score for r in classify(awkward, labels).collect()}
    assert len(scores) == 1 and 0 <= scores.pop() <= 1


def test_empty_table(spark, no_docs):
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert classify(no_docs, labels).count() == 0


@pytest.mark.parametrize("bias", [0.0, 0.4])
def test_fit_against_newton_and_a_numeric_gradient(bias):
    """The loss (weighted log loss, ridge, squared change of swapped sentences) of the
    fitted weights is as low as Newton's method brings it on the same features, and
    its numeric gradient there is next to nothing."""
    rows = corpus(6, 300, group_bias=bias)
    texts, toxic = [t for _, t, _ in rows], np.array([y for _, _, y in rows], dtype=float)
    weight = np.where(toxic == 1, 2.0, 1.0)
    model = fit(texts, toxic, weight)
    names = sorted(model.weights)
    at = {f: i for i, f in enumerate(names)}

    def dense(rows):
        x = np.zeros((len(rows), len(names)))
        for i, t in enumerate(rows):
            x[i, [at[f] for f in features(t) if f in at]] = 1
        return x

    x = dense(texts)
    pairs = [p for t in texts for p in swapped_sentences(t)]
    gaps = dense([p[0] for p in pairs]) - dense([p[1] for p in pairs])
    share = weight / weight.sum()
    assert pairs and len(names) > 5

    def loss(v):
        z = x @ v[:-1] + v[-1]
        return (
            (share * (np.logaddexp(0, z) - toxic * z)).sum()
            + toxicity.RIDGE / 2 * (v[:-1] ** 2).sum()
            + toxicity.PENALTY * ((gaps @ v[:-1]) ** 2).mean()
        )

    fitted = np.array([model.weights[f] for f in names] + [model.bias])
    best = np.append(np.zeros(len(names)), model.bias)
    full = np.hstack([x, np.ones((len(x), 1))])
    flat = np.hstack([gaps, np.zeros((len(gaps), 1))])
    ridge = np.append(np.full(len(names), toxicity.RIDGE), 1e-12)
    for _ in range(60):
        p = 1 / (1 + np.exp(-(full @ best)))
        gradient = full.T @ (share * (p - toxic)) + ridge * best + 2 * toxicity.PENALTY / len(pairs) * flat.T @ (flat @ best)
        curve = (full * (share * p * (1 - p))[:, None]).T @ full + np.diag(ridge)
        curve += 2 * toxicity.PENALTY / len(pairs) * flat.T @ flat
        step = np.linalg.solve(curve, gradient)
        rate = 1.0
        while loss(best - rate * step) > loss(best) and rate > 1e-6:
            rate /= 2
        best = best - rate * step
    start = np.append(np.zeros(len(names)), np.log(share @ toxic / (1 - share @ toxic)))
    assert loss(fitted) - loss(best) < 0.01 * (loss(start) - loss(best))

    def numeric(v):
        eye = np.eye(len(v)) * 1e-5
        return np.array([(loss(v + e) - loss(v - e)) / 2e-5 for e in eye])

    assert np.linalg.norm(numeric(fitted)) < 0.02 * np.linalg.norm(numeric(start))
