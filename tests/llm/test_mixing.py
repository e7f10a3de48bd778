import random
import re

from quarry.llm.mixing import mix_sources, mix_units, mixed_documents

from llm_helpers import awkward_rows, make_docs, prose


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def water_fill(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped, total = set(), share * sum(sizes.values())
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(most * sizes[s] for s in capped)
        full = sum(weight[s] for s in free)
        over = [s for s in free if rest * weight[s] / full > most * sizes[s]]
        if not over:
            return {s: most * sizes[s] if s in capped else rest * weight[s] / full for s in names}
        capped |= set(over)


def check(rows, got):
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + words(t)
    want = water_fill(sizes)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in got) == sorted(
        (d is None, d or 0, words(t)) for d, t, _ in rows
    )
    for s in sizes:
        mine = [r for r in got if r.source == s]
        assert {r.source_size for r in mine} == {sizes[s]}
        assert all(abs(r.target - want[s]) < 1e-6 * max(1, want[s]) for r in mine)
        assert all(0 <= r.taken <= 2 * r.size and r.taken == r.times * r.size for r in mine)
        largest = max(r.size for r in mine)
        assert abs(sum(r.taken for r in mine) - want[s]) <= largest + 1e-6


def test_awkward_rows(awkward):
    check(awkward_rows(), mix_sources(awkward).collect())


def test_many_documents_come_close_and_reruns_agree(spark):
    rng = random.Random(3)
    rows = [(i, prose(rng, rng.randrange(1, 60)), rng.choice("aaaaabcde")) for i in range(3000)]
    docs = make_docs(spark, rows)
    got = mix_sources(docs).collect()
    check(rows, got)
    for s in "abcde":
        mine = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in mine) / mine[0].target - 1) < 0.01
    again = mix_sources(docs.repartition(7, "text")).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)


def test_seeds_give_each_document_its_share(spark):
    """Half of the documents are taken twice, others in each run."""
    sizes = spark.range(300).selectExpr("id as doc_id", "'a' as source", "3 + id % 9 as size").coalesce(1)
    runs = []
    for seed in range(4):
        got = mix_units(sizes, weights=(1,), seed=seed).collect()
        assert {r.target / r.source_size for r in got} == {1.5}
        runs.append({r.doc_id: r.times for r in got})
        assert set(runs[-1].values()) == {1, 2}
        assert 120 <= sum(t == 2 for t in runs[-1].values()) <= 180
    changed = sum(runs[0][d] != runs[1][d] for d in runs[0])
    assert 90 < changed < 210


def test_documents_of_the_mix(awkward):
    taken = {(r.doc_id, r.size, r.source): r.times for r in mix_sources(awkward).collect()}
    mixed = mixed_documents(awkward)
    assert mixed.columns == awkward.columns
    counts = {}
    for r in mixed.collect():
        key = (r.doc_id, words(r.text), r.source)
        counts[key] = counts.get(key, 0) + 1
    rows = awkward_rows()
    for key, times in taken.items():
        times = times if key[1] else 1
        assert counts.get(key, 0) == times * sum((d, words(t), s) == key for d, t, s in rows)


def test_empty_table(no_docs):
    assert mix_sources(no_docs).count() == 0
    assert mixed_documents(no_docs).count() == 0


def test_only_empty_texts(spark):
    got = mix_sources(make_docs(spark, [(1, "", "a"), (2, None, "b")])).collect()
    assert [(r.size, r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 2
