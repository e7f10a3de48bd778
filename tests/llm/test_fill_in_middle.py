import hashlib
import random
import re

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import awkward_rows, make_docs

from quarry.llm.fill_in_middle import (
    FAN,
    SkipList,
    fill_in_middle,
    line_widths,
    restore,
    restored,
    transform,
    with_digests,
)
from quarry.llm.oracles import ORACLES


@pytest.mark.parametrize("n", [0, 1, FAN - 1, FAN, FAN + 1, FAN**2, FAN**2 + 1, 1000, FAN**4 + 3])
def test_a_descent_reaches_every_rank(n):
    rng = random.Random(n)
    widths = [rng.randrange(1, 9) for _ in range(n)]
    units = SkipList(widths)
    assert all(len(lane) <= -(-n // FAN**k) for k, lane in enumerate(units.lanes))
    assert len(units.lanes[-1]) <= FAN
    place = 0
    for rank in range(n + 1):
        assert units.place(rank) == place
        place += widths[rank] if rank < n else 0
    for rank in (-1, n + 1):
        with pytest.raises(IndexError):
            units.place(rank)


@given(st.text(st.sampled_from("ab\n\r é👍")))
def test_lines_are_those_of_the_pattern(text):
    assert line_widths(text) == [len(x) for x in re.findall(r"[^\n]*\n|[^\n]+", text)]


def plainly(text, key):
    """The same by joining lists of lines."""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digits = hashlib.sha256(key.encode()).hexdigest()
    h1, h2, h3, h4 = (int(digits[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(lines)
    if not text or re.search("<[PSM]>", text):
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if h4 % 100 < 50:
        return n, "spm", len(p), len(m), "<S>" + s + "<P>" + p + "<M>" + m
    return n, "psm", len(p), len(m), "<P>" + p + "<S>" + s + "<M>" + m


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("<PSM>\n\né")), st.integers(0, 999))
def test_transform_and_back(text, key):
    cut = transform(text, f"7:{key}")
    assert tuple(cut) == plainly(text, f"7:{key}")
    assert restore(cut.output, cut.form) == text


def test_rates():
    assert {transform("a\nb", str(i), rate=0).form for i in range(50)} == {"plain"}
    assert {transform("a\nb", str(i), spm=100).form for i in range(50)} == {"spm"}
    assert {transform("a\nb", str(i), rate=50).form for i in range(200)} == {"plain", "spm", "psm"}
    with pytest.raises(ValueError):
        restore("a", "msp")


def lined_rows():
    rng = random.Random(3)
    rows = awkward_rows()
    rows += [(900 + i, "\n".join("é" * rng.randrange(9) for _ in range(rng.randrange(300))), "a") for i in range(50)]
    rows += [(990, "a\n" * 150_000 + "end", "a"), (991, "x <M>\ny", "a"), (992, "\n\n\n", "b"), (993, "\r\n\x85", "b")]
    return rows


def test_awkward_rows_against_brute_force(spark):
    rows = lined_rows()
    out = fill_in_middle(make_docs(spark, rows))
    got = sorted(map(repr, map(tuple, out.collect())))
    want = [(d, *plainly(t or "", "7:" + ("" if d is None else str(d)))) for d, t, _ in rows]
    assert got == sorted(map(repr, want))
    assert sorted(r["text"] for r in restored(out).collect()) == sorted(t or "" for _, t, _ in rows)


def test_no_documents(spark, no_docs):
    assert with_digests(fill_in_middle(no_docs)).count() == 0


def test_the_sql_form(spark):
    rows = lined_rows()
    docs = make_docs(spark, rows)
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toArrow())
    got = with_digests(fill_in_middle(docs))
    want = con.sql(ORACLES["op12_fill_in_middle"])
    order = sorted(want.columns)
    assert sorted(order) == sorted(got.columns)
    assert sorted(map(repr, map(tuple, got.select(order).collect()))) == sorted(
        map(repr, want.select(*order).fetchall())
    )
