"""Quoted CSV in splits: compared with Spark's own multi-line scan, one file a task."""

import csv
import io
import os
import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import write_text
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.sources.split_csv import LineRule, states
from quarry.sources.text import read_csv, read_text

SPLITS = {"spark.sql.files.maxPartitionBytes": "3000", "spark.sql.files.openCostInBytes": "1"}


@pytest.fixture()
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in SPLITS}
    for k, v in SPLITS.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def ends_inside(line, delimiter, quote, inside):
    """Character by character."""
    at_start = not inside
    i = 0
    while i < len(line):
        c = line[i]
        if inside:
            if c == quote and line[i + 1 : i + 2] == quote:
                i += 1
            elif c == quote:
                inside = False
        elif c == delimiter:
            at_start = True
        elif c == quote and at_start:
            inside, at_start = True, False
        else:
            at_start = False
        i += 1
    return inside


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from('ab|""\r'), max_size=12), min_size=1, max_size=8))
def test_lines_as_functions_of_the_state(lines):
    rule = LineRule("|", '"', None, 0, True)
    outside, inside = rule.ends(pa.array(lines))
    assert outside.tolist() == [ends_inside(x, "|", '"', False) for x in lines]
    assert inside.tolist() == [ends_inside(x, "|", '"', True) for x in lines]
    for begins in (False, True):
        want = [begins]
        for x in lines:
            want.append(ends_inside(x, "|", '"', want[-1]))
        assert states(outside, inside, begins).tolist() == want


def test_states_of_no_lines():
    none = np.zeros(0, dtype=bool)
    assert states(none, none, True).tolist() == [True]


def messy_csv(seed, newline, rows=300, comment=False):
    rng = random.Random(seed)

    def cell():
        r = rng.random()
        if r < 0.3:
            return str(rng.randrange(1000))
        if r < 0.45:
            return rng.choice(['x"y', "5'", 'a""b', ""])
        text = "".join(rng.choices('ab,"\n\r\n é#', k=rng.randrange(1, 60)))
        if rng.random() < 0.02:  # through several splits
            text += "a long field's line\n" * 500
        return '"' + text.replace('"', '""') + '"'

    lines = [f"{i},{cell()},{cell()}" for i in range(rows)]
    if comment:
        lines = [y for x in lines for y in ((x, '#! not "read') if rng.random() < 0.2 else (x,))]
    return lines, newline.join(["id,b,c", *lines]) + rng.choice(["", newline])


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_the_multiline_scan(small_splits, tmp, newline, seed):
    for i in range(2):
        with open(f"{tmp}/{i}.csv", "w", newline="") as fh:
            fh.write(messy_csv(10 * seed + i, newline)[1])
    whole = read_csv(small_splits, tmp, multiline=True, infer_schema_length=None)
    split = read_csv(small_splits, tmp, multiline="split", infer_schema_length=None)
    assert split.schema == whole.schema
    assert rows_of(split) == rows_of(whole) and split.count() == 600
    # many tasks where the scan has one per file, and by default too
    assert whole.rdd.getNumPartitions() <= 2
    assert split.rdd.getNumPartitions() > 8
    default = read_csv(small_splits, tmp, infer_schema_length=None)
    assert default.rdd.getNumPartitions() == split.rdd.getNumPartitions()


def test_small_files_take_the_scan(spark, tmp):
    df = read_csv(spark, write_text(tmp + "/a.csv", 'a,b\n1,"x\ny"\n'))
    assert df.collect() == [(1, "x\ny")] and df.rdd.getNumPartitions() == 1
    assert "MapInArrow" not in df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def test_skipped_lines_comments_and_headers(small_splits, tmp):
    want = []
    for i in range(3):
        lines, text = messy_csv(50 + i, "\n", 200, comment=True)
        with open(f"{tmp}/{i}.csv", "w", newline="") as fh:
            fh.write(f'skipped "open\nand, this\n#! note\n{text}')
        want += [r for r in csv.reader(io.StringIO("\n".join(x for x in lines if not x.startswith("#!")), newline=""))]
    got = read_text(small_splits, tmp, comment_prefix="#!", skip_rows=2, multiline=True, schema="id string, b string, c string")
    assert rows_of(got) == sorted((tuple(c or None if c == "" else c for c in r) for r in want), key=str)
    assert got.rdd.getNumPartitions() > 8


def test_a_record_as_long_as_many_splits(small_splits, tmp):
    long_ = "line of it\n" * 5000
    text = f'a,b\n1,"{long_}"\n2,"{long_}x"\n3,y\n'
    df = read_csv(small_splits, write_text(tmp + "/a.csv", text), multiline="split")
    assert rows_of(df) == [(1, long_), (2, long_ + "x"), (3, "y")]
    unclosed = read_csv(small_splits, write_text(tmp + "/b.csv", 'a,b\n1,x\n2,"never closed\n' + "z\n" * 3000), multiline="split")
    assert unclosed.count() == 2


def test_files_of_different_headers_and_empty_files(small_splits, tmp):
    write_text(tmp + "/1.csv", 'a,b\n1,"x\ny"\n')
    write_text(tmp + "/2.csv", "")
    assert rows_of(read_csv(small_splits, tmp, multiline="split")) == [(1, "x\ny")]
    write_text(tmp + "/3 %.csv", "b,a\n7,2.5\n")
    got = read_csv(small_splits, tmp, multiline="split", infer_schema_length=None)
    assert got.columns == ["a", "b"] and rows_of(got) == [(1.0, "x\ny"), (2.5, "7")]
    write_text(tmp + "/4.csv", "b,c\n1,2\n")
    with pytest.raises(Exception, match="headers"):
        read_csv(small_splits, tmp, multiline="split").collect()
    os.makedirs(tmp + "/none")
    write_text(tmp + "/none/0.csv", "")
    with pytest.raises(ValueError, match="no rows"):
        read_csv(small_splits, tmp + "/none", multiline="split")
