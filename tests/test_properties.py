"""Property tests: profiles and CSV round trips against brute force."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quarry import profile_detailed
from quarry.sinks import write_csv
from quarry.sources.text import read_csv

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

ints = st.one_of(st.none(), st.integers(-(2**40), 2**40))
floats = st.one_of(st.none(), st.sampled_from([float("nan"), -0.0, 0.0]), st.floats(-1e6, 1e6, allow_nan=False))
words = st.one_of(st.none(), st.sampled_from(["a", "b", "", "a b", "ü"]))
rows = st.lists(st.tuples(ints, floats, words), min_size=0, max_size=25)


def brute(values, kind):
    nulls = sum(v is None for v in values)
    present = [v for v in values if v is not None]
    if kind == "float":
        keys = {("nan",) if math.isnan(v) else (0.0 if v == 0 else v) for v in present}
    else:
        keys = set(present)
    unique = len(keys) + (1 if nulls else 0)
    lo = hi = None
    if kind == "int" and present:
        lo, hi = min(present), max(present)
    if kind == "float" and present:
        finite = [v for v in present if not math.isnan(v)]
        lo, hi = (min(finite), max(finite)) if finite else (float("nan"), float("nan"))
    samples = [v for v in values if v is not None][:3] if kind == "str" else None
    return nulls, unique, lo, hi, samples


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return (math.isnan(a) and math.isnan(b)) or a == b
    return a == b


@SETTINGS
@given(rows)
def test_profile_matches_brute_force(spark, data):
    data = [(i,) + r for i, r in enumerate(data)]
    df = spark.createDataFrame(data, "k int, i bigint, x double, s string")
    for plan in ("per_column", "narrow"):
        prof = {r["column"]: r for r in profile_detailed(df, order_by="k", exact_plan=plan).collect()}
        _check_against_brute(prof, data)


def _check_against_brute(prof, data):
    for col, idx, kind in (("i", 1, "int"), ("x", 2, "float"), ("s", 3, "str")):
        nulls, unique, lo, hi, samples = brute([r[idx] for r in data], kind)
        p = prof[col]
        assert p["row_count"] == len(data)
        assert p["nulls"] == nulls, col
        assert p["unique"] == unique, col
        got_lo = p["min"]["Int"] if kind == "int" else p["min"]["Float"]
        got_hi = p["max"]["Int"] if kind == "int" else p["max"]["Float"]
        assert same(got_lo, lo) and same(got_hi, hi), (col, got_lo, lo, got_hi, hi)
        if kind == "str":
            assert p["sample_values"] == samples


text = st.text(alphabet=st.sampled_from(list('ab ,"\n\'x')), min_size=0, max_size=8).map(lambda t: "w" + t)
csv_rows = st.lists(st.tuples(st.integers(-(2**50), 2**50), st.one_of(st.none(), st.just(""), text)),
                    min_size=1, max_size=20)


@SETTINGS
@given(csv_rows)
def test_csv_round_trip(spark, tmp_path_factory, data):
    out = str(tmp_path_factory.mktemp("csv"))
    df = spark.createDataFrame(data, "id bigint, s string")
    write_csv(df, out + "/c")
    back = read_csv(spark, out + "/c", multiline=True)
    assert back.columns == ["id", "s"]
    assert sorted(back.collect(), key=repr) == sorted((tuple(r) for r in data), key=repr)


line_word = st.sampled_from(["x", "y z", "q"])
file_body = st.lists(st.tuples(st.integers(0, 999), line_word), min_size=0, max_size=12)
preamble = st.lists(st.sampled_from(["junk", "## c", "", "a|b", "1|x"]), min_size=0, max_size=3)


@SETTINGS
@given(st.lists(st.tuples(preamble, file_body, st.lists(st.integers(0, 12), max_size=2)), min_size=1, max_size=3),
       st.integers(0, 3))
def test_text_line_stage_matches_brute_force(spark, tmp_path_factory, files, skip):
    import json as _json

    d = str(tmp_path_factory.mktemp("txt"))
    expected = []
    for n, (junk, body, comment_at) in enumerate(files):
        lines = list(junk[:skip]) + ["junk"] * (skip - len(junk[:skip])) + ["a|b"]
        for j, (k, w) in enumerate(body):
            if j in comment_at:
                lines.append("## note")
            lines.append(f"{k}|{w}")
        with open(f"{d}/f{n}.txt", "w") as fh:
            fh.write("\n".join(lines) + "\n")
        expected += body
    from quarry.sources.text import read_text

    if not any(body for _, body, _ in files):
        return
    df = read_text(spark, d, delimiter="|", comment_prefix="##", skip_rows=skip)
    assert df.columns == ["a", "b"]
    assert sorted(df.collect()) == sorted(expected), _json.dumps(files)


records = st.lists(st.fixed_dictionaries({"a": st.integers(-1000, 1000), "b": st.sampled_from(["p", "q r", "é"])}),
                   min_size=1, max_size=6)


@SETTINGS
@given(st.lists(st.tuples(records, st.booleans()), min_size=1, max_size=5))
def test_json_bodies_match_brute_force(spark, bodies):
    import json as _json

    from pyspark.sql import types as T

    from quarry.sources.json import parse_json_text

    rows = []
    for i, (recs, as_array) in enumerate(bodies):
        text = _json.dumps(recs) if as_array else "\n".join(_json.dumps(r) for r in recs)
        rows.append((i, text))
    df = spark.createDataFrame(rows, "k int, body string")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    got = sorted(tuple(r) for r in parse_json_text(df, "body", schema=schema, keep=["k"]).collect())
    want = sorted((i, r["a"], r["b"]) for i, (recs, _) in enumerate(bodies) for r in recs)
    assert got == want
    inferred = sorted(tuple(r) for r in parse_json_text(df, "body", keep=["k"]).select("k", "a", "b").collect())
    assert inferred == want


cell = st.one_of(st.none(), st.booleans(), st.integers(-10**6, 10**6),
                 st.floats(-1e9, 1e9, allow_nan=False).filter(lambda x: x != 0 or str(x) == "0.0"),
                 st.text(alphabet=st.sampled_from(list("ab <&>é\"'")), min_size=1, max_size=6))
grid = st.lists(st.lists(cell, min_size=1, max_size=4), min_size=1, max_size=6)


@settings(max_examples=60, deadline=None)
@given(grid, st.booleans())
def test_xlsx_round_trip(rows, shared):
    from quarry.plans.fixtures import xlsx_bytes
    from quarry.sources.excel import number_text, workbook_rows

    def text(v):
        if v is None:
            return ""
        if isinstance(v, bool):
            return "true" if v else "false"
        if isinstance(v, (int, float)):
            return number_text(repr(v))
        return v

    cells = {(r, c): text(v) for r, row in enumerate(rows) for c, v in enumerate(row) if text(v) != ""}
    if not cells:
        return
    r0, r1 = min(k[0] for k in cells), max(k[0] for k in cells)
    c0, c1 = min(k[1] for k in cells), max(k[1] for k in cells)
    want = [[cells.get((r, c), "") for c in range(c0, c1 + 1)] for r in range(r0, r1 + 1)]
    assert workbook_rows(xlsx_bytes([rows], shared=shared)) == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list('ab,"x ')), max_size=5), min_size=1, max_size=5))
def test_line_splitter_matches_csv_module(fields):
    import csv
    import io

    from quarry.sources.text import _split_line

    buf = io.StringIO()
    csv.writer(buf, quoting=csv.QUOTE_MINIMAL, lineterminator="").writerow(fields)
    line = buf.getvalue()
    assert _split_line(line, ",", '"') == next(csv.reader([line]))
