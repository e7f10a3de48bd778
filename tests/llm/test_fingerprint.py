import hashlib
import random

import numpy as np
from llm_helpers import awkward_rows, make_docs, prose

from quarry.llm.common import shingles_of_text
from quarry.llm.fingerprint import BINS, BITS, compare, edited, fingerprint, neighbour_fingerprints, signature


def jaccard(a, b):
    a, b = set(shingles_of_text(a).tolist()), set(shingles_of_text(b).tolist())
    return len(a & b) / len(a | b) if a or b else 1.0


def test_estimates_are_near_the_true_similarity():
    rng = random.Random(1)
    errors = []
    for size in (6, 20, 60, 300, 1500):
        for _ in range(40):
            a = prose(rng, size)
            b = edited(a, prose(rng, size)) if rng.random() < 0.7 else prose(rng, size)
            got = compare([signature(shingles_of_text(a))], [signature(shingles_of_text(b))])[0]
            errors.append(got - jaccard(a, b))
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.05


def test_signature_size_and_special_cases():
    empty, one = signature(shingles_of_text("")), signature(shingles_of_text("one"))
    assert empty == b"" and len(one) == BINS * BITS // 8
    assert compare([empty, empty, one], [empty, one, one]).tolist() == [1.0, 0.0, 1.0]
    assert signature(shingles_of_text("A  b\tc d e")) == signature(shingles_of_text("a b c D e"))
    assert len(compare([], [])) == 0


def neighbours(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or ""))
    return [(a, order[(i + 1) % len(order)]) for i, a in enumerate(order)]


def check(docs, rows):
    got = sorted(neighbour_fingerprints(docs).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.edited_sha256))
    want = []
    for (d, t, _), (_, following, _) in neighbours(rows):
        new = edited(t or "", following or "")
        want.append((d, len(t or ""), hashlib.sha256(new.encode()).hexdigest(), t or "", new, following or ""))
    want.sort(key=lambda w: (w[0] is None, w[0] or 0, w[2]))
    assert len(got) == len(want)
    for r, (d, n, sha, text, new, following) in zip(got, want, strict=True):
        assert (r.doc_id, r.n_chars, r.edited_sha256) == (d, n, sha)
        prints = [signature(shingles_of_text(x)) for x in (text, new, following)]
        assert (r.fingerprint, r.edited_fingerprint) == (prints[0].hex(), prints[1].hex())
        assert r.near_edited == compare(prints[:1], prints[1:2])[0]
        assert r.near_next == compare(prints[:1], prints[2:])[0]


def test_awkward_rows(awkward):
    check(awkward, awkward_rows())


def test_many_ranges(spark):
    rng = random.Random(2)
    ids = rng.sample(range(-10**12, 10**12), 700)
    rows = [(d, prose(rng, rng.randrange(0, 30)), "s") for d in ids]
    check(make_docs(spark, rows).repartition(5), rows)


def test_one_document(spark):
    check(make_docs(spark, [(5, "a b c d e f", "s")]), [(5, "a b c d e f", "s")])


def test_empty_table(no_docs):
    assert neighbour_fingerprints(no_docs).count() == 0
    assert fingerprint(no_docs).count() == 0


def test_plain_fingerprints(awkward):
    got = {(r.doc_id, r.fingerprint) for r in fingerprint(awkward).collect()}
    assert got == {(d, signature(shingles_of_text(t)).hex()) for d, t, _ in awkward_rows()}
