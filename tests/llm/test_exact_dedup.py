import hashlib

import pytest

from llm_helpers import awkward_rows, make_docs, plan_text

from quarry.llm import exact_dedup as module
from quarry.llm.exact_dedup import _runs, drop_copies, exact_dedup, hot_texts


def lower(text):
    return "".join(c.lower() if c.isascii() else c for c in (text or ""))


@pytest.mark.parametrize("keep", ["min", "max"])
def test_against_brute_force(awkward, keep):
    rows = awkward_rows()
    groups = {}
    for d, t, _ in rows:
        groups.setdefault(lower(t), []).append(d)
    got = exact_dedup(awkward, keep=keep).collect()
    assert len(got) == len(rows)
    best = min if keep == "min" else max
    by_hash = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in groups.items()}
    for r in got:
        ids = by_hash[r.text_sha256]
        known = [d for d in ids if d is not None]
        assert r.group_size == len(ids) and r.doc_id in ids
        assert r.keep_id == (best(known) if known else None)
        assert not r.kept or r.doc_id == r.keep_id
    for sha in by_hash:
        assert sum(r.kept for r in got if r.text_sha256 == sha) == 1


def test_rows_that_stay_keep_their_columns(awkward):
    left = drop_copies(awkward, keep="max")
    assert left.columns == awkward.columns
    rows = left.collect()
    texts = [lower(r.text) for r in rows]
    assert len(set(texts)) == len(texts) == len({lower(t) for _, t, _ in awkward_rows()})
    assert {r.n_chars for r in rows if r.doc_id == 6} == {len(awkward_rows()[6][1])}


def test_a_text_with_many_copies(spark):
    docs = make_docs(spark, [(i, "same text" if i % 2 else f"other {i}", "a") for i in range(3000)])
    got = exact_dedup(docs, keep="max")
    assert got.where("kept").count() == 1501
    assert {(r.keep_id, r.group_size) for r in got.where("doc_id % 2 = 1").collect()} == {(2999, 1500)}


def copies(spark, hot=300):
    """Groups of 1 to 6 copies with a common beginning, and two large ones."""
    begin = "the same beginning of every single text " * 3
    rows = [(i, f"{begin}{i // (1 + i % 6)}", "a") for i in range(1200)]
    rows += [(5000 + i, "Hot TEXT" if i % 2 else "hot text", "b") for i in range(hot)]
    rows += [(None, "hot text", "b"), (5000, "hot text", "b")] + [(9000 + i, begin + "hot", "c") for i in range(hot)]
    return rows, make_docs(spark, rows).repartition(5)


def test_neighbours_decide_all_groups_but_hot_ones(spark, monkeypatch):
    rows, docs = copies(spark)
    groups = {}
    for _, t, _ in rows:
        groups[lower(t)] = groups.get(lower(t), 0) + 1
    monkeypatch.setattr(module, "HOT_ROWS", 100)
    hot = {t for t, n in groups.items() if n > len(rows) // 8}  # eight shuffle partitions
    assert len(hot) == len(hot_texts(docs, "text")) == 2
    runs = _runs(docs, "doc_id", "text", "max", []).where("__place = 1").collect()
    cold = [r for r in runs if r["__spread"] is None]
    assert {r["__norm"]: r["__run_size"] for r in cold} == {t: n for t, n in groups.items() if t not in hot}
    assert len(cold) == len(groups) - 2 and all(r["__head"] is None for r in cold)
    assert {r["__head"] for r in runs if r["__spread"] is not None} == hot
    assert len(runs) - len(cold) > 2  # a hot text has several runs


@pytest.mark.parametrize("keep", ["min", "max"])
def test_hot_texts_against_brute_force(spark, monkeypatch, keep):
    rows, docs = copies(spark)
    monkeypatch.setattr(module, "HOT_ROWS", 100)
    best = min if keep == "min" else max
    groups = {}
    for d, t, _ in rows:
        groups.setdefault(lower(t), []).append(d)
    want = {t: (best(d for d in ids if d is not None), len(ids)) for t, ids in groups.items()}
    got = exact_dedup(docs, keep=keep).collect()
    by_hash = {hashlib.sha256(t.encode()).hexdigest(): v for t, v in want.items()}
    assert len(got) == len(rows) and sum(r.kept for r in got) == len(groups)
    assert all((r.keep_id, r.group_size) == by_hash[r.text_sha256] for r in got)
    left = drop_copies(docs, keep=keep).collect()
    assert sorted((lower(r.text), r.doc_id) for r in left) == sorted((t, v[0]) for t, v in want.items())


def test_empty_table(no_docs):
    assert exact_dedup(no_docs).count() == 0
    assert drop_copies(no_docs).count() == 0


def test_no_python_in_the_plan(awkward):
    plan = plan_text(exact_dedup(awkward)) + plan_text(drop_copies(awkward))
    assert "Python" not in plan and "Arrow" not in plan


def test_bad_rule(awkward):
    with pytest.raises(ValueError):
        exact_dedup(awkward, keep="first")


def test_texts_are_shuffled_once(awkward):
    plan = plan_text(_runs(awkward, "doc_id", "text", "max", []))
    assert plan.count("Exchange") == 1 and "rangepartitioning" in plan
