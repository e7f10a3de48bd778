import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import awkward_rows, make_docs, prose

from quarry.llm import hmm_score
from quarry.llm.common import word_codes, words_of
from quarry.llm.hmm_score import Corpus, Parameters, _blocks, _expected, _likelihoods, fit, held_out, score_documents

CLASSES = 9


def tiny(rng, k=3, classes=5):
    start, move = rng.random(k) + 0.1, rng.random((k, k)) + 0.1
    emit = np.zeros((CLASSES, k))
    emit[:classes] = rng.random((classes, k)) + 0.1
    return Parameters(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def by_paths(par, seq):
    """Likelihood, and expected start, moves and emissions, over all state paths."""
    k = len(par.start)
    total, start, move, emit = 0.0, np.zeros(k), np.zeros((k, k)), np.zeros((CLASSES, k))
    for path in itertools.product(range(k), repeat=len(seq)):
        p = par.start[path[0]]
        for t, s in enumerate(path):
            p *= par.emit[seq[t], s] * (par.move[path[t - 1], s] if t else 1.0)
        total += p
        start[path[0]] += p
        for a, b in zip(path, path[1:], strict=False):
            move[a, b] += p
        for t, s in enumerate(path):
            emit[seq[t], s] += p
    return total, start / total, move / total, emit / total


@pytest.mark.parametrize("cells", [1, 2, 4, 14, 1000])
def test_recursions_against_all_paths(monkeypatch, cells):
    monkeypatch.setattr(hmm_score, "CELLS", cells)  # several blocks, and texts in several pieces
    rng = np.random.default_rng(4)
    par = tiny(rng)
    sequences = [rng.integers(0, 5, n) for n in (1, 2, 3, 5, 6, 1, 4)]
    blobs = [s.astype("<u2").tobytes() for s in sequences]
    sums = np.zeros(3), np.zeros((3, 3)), np.zeros((CLASSES, 3))
    logs, total = np.zeros(len(blobs)), 0.0
    for places, lengths, padded in _blocks(blobs, "<u2"):
        logs[places] = _likelihoods(par, lengths, padded)
        total += _expected(par, lengths, padded, sums)
    want = [by_paths(par, s) for s in sequences]
    assert np.allclose(logs, [math.log(w[0]) for w in want]) and np.isclose(total, logs.sum())
    for i in range(3):
        assert np.allclose(sums[i], sum(w[i + 1] for w in want))


def languages(seed, count):
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        lang = "xyz"[i % 3]
        rows.append((i, " ".join(f"{lang}{int(rng.paretovariate(0.8))}{lang * 2}" for _ in range(rng.randrange(60))), lang))
    return rows


def base_scores(rows):
    train = [words_of(t) for d, t, _ in rows if zlib.crc32(b"" if d is None else str(d).encode()) % 7 != 2]
    counts = Counter(w for t in train for w in t)
    counts["END"] = len(train)
    n, v = sum(counts.values()), sum(c > 0 for c in counts.values())
    for d, t, _ in rows:
        tokens = [*words_of(t), "END"]
        score = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)
        yield d, len(tokens), sum(counts[w] > 0 for w in tokens), n, score


def check_base(rows, got):
    want = sorted(((d is None, d or 0, round(s, 6)), n, k, t) for d, n, k, t, s in base_scores(rows))
    have = sorted(
        ((r.doc_id is None, r.doc_id or 0, round(r.base_score, 6)), r.n_tokens, r.n_known, r.train_tokens) for r in got
    )
    assert [w[1:] for w in want] == [h[1:] for h in have]
    for w, h in zip(want, have, strict=True):
        assert w[0][:2] == h[0][:2] and abs(w[0][2] - h[0][2]) < 1e-5 * max(1, abs(w[0][2]))


@pytest.mark.parametrize("frequent", [50_000, 20])
def test_base_scores_and_held_out_texts(spark, monkeypatch, frequent):
    """Also with a bound that sends nearly all words through the join."""
    monkeypatch.setattr(hmm_score, "FREQUENT", frequent)
    monkeypatch.setattr(hmm_score, "OWN_SCALE", 2.0 if frequent > 20 else 0.2)
    rows = languages(1, 600)
    got = score_documents(make_docs(spark, rows)).collect()
    check_base(rows, got)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    if frequent > 20:
        test = [r for r in got if r.held_out]
        assert sum(r.score for r in test) > sum(r.base_score for r in test)


def test_awkward_rows(awkward):
    rows = awkward_rows()
    got = score_documents(awkward, gain=1).collect()
    check_base(rows, got)
    assert len({r.score for r in got if r.doc_id == 7}) == 1


def test_rounds_raise_the_likelihood_of_all_training_texts(spark):
    docs = make_docs(spark, languages(2, 300)).selectExpr("doc_id", "text", "false as held_out", "doc_id as mark")
    corpus = Corpus(docs)
    training, _ = hmm_score.stage(hmm_score._sequences(docs, corpus), "t")
    par, values = hmm_score._first_guess(training, corpus.classes), []
    for _ in range(4):
        par, likelihood = hmm_score._round(training, par)
        values.append(likelihood)
    assert values == sorted(values) and values[-1] > values[0]
    assert np.isclose(par.emit.sum(0), 1).all() and np.isclose(par.move.sum(1), 1).all()
    again = fit(training.repartition(3), corpus.classes, gain=1)
    once = fit(training, corpus.classes, gain=1)
    assert np.allclose(again.emit, once.emit)
    # rounds go on while they gain enough, and an error tells if they never stop
    best = fit(training, corpus.classes, gain=1e-4)
    assert hmm_score._round(training, best)[1] > values[-1]
    with pytest.raises(RuntimeError):
        fit(training, corpus.classes, gain=-1, most_rounds=2)


def test_a_very_long_text_is_scored_as_a_whole(spark, monkeypatch):
    rows = languages(5, 100)
    rows.append((1000, " ".join(t for _, t, _ in rows) * 30, "x"))
    want = score_documents(make_docs(spark, rows)).collect()
    monkeypatch.setattr(hmm_score, "CELLS", 500)
    got = score_documents(make_docs(spark, rows)).collect()
    scores = {r.doc_id: r.score for r in want}
    assert all(math.isclose(r.score, scores[r.doc_id], rel_tol=1e-6) for r in got)
    assert max(r.n_tokens for r in got) > 50_000


def test_words_are_those_of_the_rule():
    texts = ["A b\tB\x0bc", "", " \n", "É é\x1cx  Y", "z"]
    words, codes, at = word_codes(pa.array(texts))
    found = [[words[int(c)].as_py() for c in codes[a:b]] for a, b in itertools.pairwise(at.tolist())]
    assert found == [words_of(t) for t in texts] and len(set(words.to_pylist())) == len(words)


def test_own_classes_grow_with_the_vocabulary(spark):
    sizes = []
    for count in (30, 600):
        docs = make_docs(spark, languages(2, count)).selectExpr("doc_id", "text", "false as held_out", "doc_id as mark")
        corpus = Corpus(docs)
        sizes.append(corpus.own)
        assert corpus.own == math.ceil(2 * math.sqrt(corpus.distinct - 1)) and corpus.classes == corpus.own + 2049
    assert sizes[0] < sizes[1]


def test_the_probability_of_words_sums_to_one():
    """Within each class, known words and one unknown share all mass."""
    rng = random.Random(1)
    counts = {f"w{i}".encode(): rng.randrange(1, 9) for i in range(400)}
    size, seen = np.zeros(hmm_score.ENDINGS), np.zeros(hmm_score.ENDINGS)
    for w, c in counts.items():
        size[hmm_score.ending_of(w)] += c + 1
    for w, c in counts.items():
        seen[hmm_score.ending_of(w)] += (c + 1) / (size[hmm_score.ending_of(w)] + 1)
    used = size > 0
    assert np.allclose(seen[used] + 1 / (size[used] + 1), 1)


def test_folds(spark):
    got = spark.range(200).select("id", held_out("id").alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 7 == 2) for r in got)


@pytest.mark.parametrize("rows", [[], [(1, None, "s")], [(1, "a b", "s")]])
def test_tiny_tables(spark, rows):
    got = score_documents(make_docs(spark, rows), gain=1).collect()
    assert len(got) == len(rows)
    check_base(rows, got)
