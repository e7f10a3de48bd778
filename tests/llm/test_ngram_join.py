import glob
import random
import re

import numpy as np
import pytest
from llm_helpers import awkward_rows, make_docs, prose

from quarry.llm import common
from quarry.llm.common import components, shingles_of_text, words_of
from quarry.llm.ngram_join import divide_skip, drop_near_duplicates, links, near_duplicates, prefix_length, prefix_overlap, required


def shingles(text):
    words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_force(rows):
    """Class of each identifier by comparing all pairs; a repeated identifier is one node."""
    sets = [(d, shingles(t)) for d, t, _ in rows]
    up = {d: d for d, _ in sets}

    def root(d):
        while up[d] != d:
            d = up[d]
        return d

    known = [(d, s) for d, s in sets if d is not None and s]
    for i, (a, s) in enumerate(known):
        for b, t in known[:i]:
            if 100 * len(s & t) >= 80 * len(s | t):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {(d, len(s)): (None if d is None else root(d)) for d, s in sets}


def check(docs, rows, **options):
    want = brute_force(rows)
    got = near_duplicates(docs, **options).collect()
    assert len(got) == len(rows)
    wrong = []
    for r in got:
        if r.doc_id is None and r.n_shingles == 0 or (r.doc_id, r.n_shingles) in want:
            expected = want.get((r.doc_id, r.n_shingles))
            if r.component_id != expected:
                wrong.append((r, expected))
        else:
            wrong.append((r, "n_shingles"))
    assert not wrong


def near_copies(rng, count, words, edits, first):
    base = prose(rng, words).split()
    for i in range(count):
        copy = list(base)
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(len(copy))] = f"e{rng.randrange(10**6)}"
        yield first + i, " ".join(copy), "s"


def corpus(seed=1):
    """Chains of near copies, a passage that all share, short and empty texts."""
    rng = random.Random(seed)
    passage = prose(rng, 40)
    rows = list(near_copies(rng, 60, 150, 4, 1000)) + list(near_copies(rng, 25, 40, 2, 2000))
    rows += [(3000 + i, prose(rng, rng.randrange(1, 60)) + " " + passage, "s") for i in range(60)]
    rows += [(4000 + i, prose(rng, rng.randrange(0, 8), 6), "s") for i in range(80)]
    rng.shuffle(rows)
    return rows


def test_awkward_rows(awkward):
    check(awkward, awkward_rows())


@pytest.mark.parametrize("block", [2_000_000, 3_000])
def test_against_brute_force(spark, block):
    """Also with groups far larger than a block."""
    rows = corpus()
    check(make_docs(spark, rows), rows, block=block)


def test_prefixes_of_partners_share_enough():
    rng = np.random.default_rng(2)
    for _ in range(3000):
        n = int(rng.integers(1, 120))
        a = rng.choice(10**6, n, replace=False)
        keep = rng.random(n) > rng.choice([0, 0.05, 0.1, 0.2])
        b = np.unique(np.append(a[keep], rng.choice(10**6, int(rng.integers(0, 1 + n // 6))) + 10**6))
        a = np.sort(a)
        if not len(b) or not links(len(np.intersect1d(a, b)), len(a), len(b)):
            continue
        shared = len(np.intersect1d(a[: prefix_length(len(a))], b[: prefix_length(len(b))]))
        assert shared >= max(prefix_overlap(len(a)), 1) and shared >= prefix_overlap(len(b))
        assert len(np.intersect1d(a, b)) >= required(len(a))


def test_search_finds_the_classes_of_all_pairs():
    rng = random.Random(9)
    sets = [shingles_of_text(t) for _, t, _ in corpus(9)]
    sets = [s for s in sets if len(s)]
    rng.shuffle(sets)

    def classes(pairs):
        up = list(range(len(sets)))

        def root(i):
            while up[i] != i:
                i = up[i]
            return i

        for a, b in pairs:
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
        return [root(i) for i in range(len(sets))]

    every = [
        (i, j) for i in range(len(sets)) for j in range(i)
        if links(len(np.intersect1d(sets[i], sets[j])), len(sets[i]), len(sets[j]))
    ]
    found = divide_skip(sets)
    assert set(map(frozenset, found)) <= set(map(frozenset, every))
    assert classes(found) == classes(every)
    some = np.arange(0, len(sets), 3)
    part = [(a, b) for a, b in every if a % 3 == 0 or b % 3 == 0]
    assert classes(divide_skip(sets, some)) == classes(part)
    assert divide_skip([]) == []


def test_shingle_hashes_are_those_of_the_words():
    rng = random.Random(3)
    texts = [prose(rng, k, 9) for k in range(0, 30)] + ["A b\tC\x0bd  e\nf", "a b c d e f", "ü x y z Ä q", "x" * 5000]
    seen = {}
    for t in texts:
        hashes = shingles_of_text(t)
        assert len(hashes) == len(shingles(t)) and (np.diff(hashes.astype(object)) > 0).all()
        assert seen.setdefault(shingles(t), hashes.tobytes()) == hashes.tobytes()
    assert len(set(seen.values())) == len(seen)
    assert words_of("A\x85b c d") == ["a\x85b c".encode(), b"d"]


def test_components(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(0, 60)] + [(rng.randrange(100, 400), rng.randrange(100, 400)) for _ in range(200)]
    edges += [(500, 500 + i) for i in range(1, 40)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    assert got == {x: root(x) for x in up}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_few_edges_go_to_few_files(spark, monkeypatch):
    files = []

    def stage(df, name):
        found = real(df, name)
        files.append(len(glob.glob(f"{found[1].removeprefix('file:')}/*.parquet")))
        return found

    real = common.stage
    monkeypatch.setattr(common, "stage", stage)
    monkeypatch.setattr(common, "EDGES_A_TASK", 1000)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        edges = spark.range(300).selectExpr("id a", "id + 1 b")
        got, _ = real(components(edges, "a", "b"), "few")
        assert max(files[1:]) == 1 and len(files) > 4  # how many come in is not known before
        assert {tuple(r) for r in got.collect()} == {(i, 0) for i in range(301)}
        files.clear()
        many = spark.range(3000).selectExpr("id a", "id - id % 10 b")
        got, _ = real(components(many, "a", "b"), "many")
        assert max(files[1:]) > 3
        assert {tuple(r) for r in got.collect()} == {(i, i - i % 10) for i in range(3000)}
    finally:
        spark.conf.set(key, "true")


def test_one_of_each_class_stays(spark):
    rows = corpus(4)
    docs = make_docs(spark, rows)
    want = brute_force(rows)
    left = drop_near_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(d for (d, _), c in want.items() if d == c)


def test_texts_that_share_an_identifier(spark):
    rng = random.Random(31)
    a, b, c = (prose(rng, 60) for _ in range(3))
    rows = [
        (3, a + " one", "s"), (5, a, "s"), (5, b, "s"), (5, b, "s"), (5, c, "s"), (5, "", "s"),
        (8, b + " two", "s"), (9, c + " three", "s"), (9, c + " four", "s"), (None, a, "s"), (None, "", "s"),
    ]
    docs = make_docs(spark, rows)
    got = sorted((r.doc_id or 0, r.component_id or 0) for r in near_duplicates(docs).collect())
    assert got == [(0, 0), (0, 0), (3, 3), (5, 3), (5, 5), (5, 5), (5, 5), (5, 5), (8, 5), (9, 5), (9, 5)]
    left = drop_near_duplicates(docs)
    assert left.columns == docs.columns
    want = [(3, a + " one"), (5, b), (5, b), (5, c), (5, ""), (None, a), (None, "")]
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted(want, key=str)


def test_empty_table(no_docs):
    assert near_duplicates(no_docs).count() == 0
    assert drop_near_duplicates(no_docs).count() == 0
