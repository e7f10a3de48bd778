import json
import math

import pytest
from pyspark.sql import functions as F

from quarry import export_profile_json, profile_basic, profile_detailed, profile_json_text
from quarry.operators.export import _format_float
from helpers import plan_text


def by_name(df):
    return {r["column"]: r for r in df.collect()}


def test_basic_profile(spark):
    df = spark.createDataFrame([(1, None), (None, "x"), (3, "y")], "a bigint, s string")
    rows = by_name(profile_basic(df))
    assert rows["a"]["nulls"] == 1 and rows["s"]["nulls"] == 1
    assert rows["a"]["dtype"] == "bigint" and rows["s"]["dtype"] == "string"
    assert {r["row_count"] for r in rows.values()} == {3}
    assert [r["column"] for r in profile_basic(df).orderBy("position").collect()] == ["a", "s"]


def test_numeric_edges(spark):
    nan = float("nan")
    df = spark.createDataFrame(
        [(1.5, nan, None, -0.0), (nan, nan, None, 0.0), (None, nan, None, 2.0), (-2.0, None, None, None)],
        "x double, all_nan double, all_null double, z double",
    )
    p = by_name(profile_detailed(df))
    x = p["x"]
    assert x["nulls"] == 1  # NaN is a value, not a null
    assert x["min"]["Float"] == -2.0 and x["max"]["Float"] == 1.5  # NaN ignored
    assert x["unique"] == 4  # 1.5, NaN, null, -2.0
    a = p["all_nan"]
    assert math.isnan(a["min"]["Float"]) and math.isnan(a["max"]["Float"])
    assert a["unique"] == 2  # NaN and null
    n = p["all_null"]
    assert n["min"]["Float"] is None and n["max"]["Float"] is None
    assert n["unique"] == 1 and n["nulls"] == 4
    assert p["z"]["unique"] == 3  # -0.0 and 0.0 are one value, plus 2.0, plus null


def test_all_types(spark):
    df = spark.sql(
        """
        SELECT * FROM VALUES
          (1, 10L, CAST(1.5 AS FLOAT), 2.5D, true, DATE'1970-01-02',
           TIMESTAMP_NTZ'1970-01-01 00:00:01', 'a', 1.25BD, array(1, 2), map('k', 1),
           named_struct('f', 1), CAST(1 AS SMALLINT)),
          (3, 30L, CAST(-1.5 AS FLOAT), -2.5D, false, DATE'1969-12-31',
           TIMESTAMP_NTZ'1969-12-31 23:59:59', 'b', 2.50BD, array(1, 2), map('k', 2),
           named_struct('f', 2), CAST(2 AS SMALLINT))
        AS t(i, l, f, d, b, dt, ts, s, dec, arr, m, st, sm)
        """
    ).withColumn("ts_ltz", F.expr("TIMESTAMP'1970-01-01 00:00:02 UTC'")).withColumn(
        "v", F.expr("parse_json('{\"a\":1}')"))
    p = by_name(profile_detailed(df))
    assert (p["i"]["min"]["Int"], p["i"]["max"]["Int"]) == (1, 3)
    assert (p["l"]["min"]["Int"], p["l"]["max"]["Int"]) == (10, 30)
    assert (p["f"]["min"]["Float"], p["f"]["max"]["Float"]) == (-1.5, 1.5)
    assert (p["d"]["min"]["Float"], p["d"]["max"]["Float"]) == (-2.5, 2.5)
    assert (p["b"]["min"]["Int"], p["b"]["max"]["Int"]) == (0, 1)
    assert (p["dt"]["min"]["Int"], p["dt"]["max"]["Int"]) == (-1, 1)
    assert (p["ts"]["min"]["Int"], p["ts"]["max"]["Int"]) == (-1_000_000, 1_000_000)
    assert p["ts_ltz"]["min"]["Int"] == 2_000_000
    for c in ("s", "dec", "arr", "m", "st", "sm", "v"):
        assert p[c]["min"] == (None, None, None), c
        assert p[c]["max"] == (None, None, None), c
    assert p["s"]["sample_values"] == ["a", "b"]
    for c in ("i", "dec", "arr", "v"):
        assert p[c]["sample_values"] is None
    assert p["dec"]["unique"] == 2 and p["arr"]["unique"] == 1 and p["st"]["unique"] == 2
    assert p["m"]["unique"] == 2
    assert p["v"]["unique"] is None  # variant cannot be grouped
    assert p["dt"]["dtype"] == "date" and p["ts"]["dtype"] == "timestamp_ntz"


def test_strict_parity(spark):
    df = spark.sql("SELECT 1 AS i, 2L AS l, CAST(1 AS FLOAT) AS f, DATE'2020-01-01' AS d, true AS b")
    p = by_name(profile_detailed(df, strict_parity=True))
    assert p["i"]["min"]["Int"] is None and p["f"]["min"]["Float"] is None and p["d"]["min"]["Int"] is None
    assert p["l"]["min"]["Int"] == 2 and p["b"]["max"]["Int"] == 1


def test_samples_order_nulls_duplicates(spark):
    rows = [(1, None), (2, None), (3, "q"), (4, "q"), (5, "r"), (6, "s")]
    df = spark.createDataFrame(rows, "k int, s string").repartition(3)
    p = by_name(profile_detailed(df, order_by="k"))
    assert p["s"]["sample_values"] == ["q", "q", "r"]
    few = spark.createDataFrame([(1, "only"), (2, None)], "k int, s string")
    assert by_name(profile_detailed(few, order_by="k"))["s"]["sample_values"] == ["only"]


def test_samples_file_order(spark, tmp):
    spark.createDataFrame([(i, f"v{i}") for i in range(50)], "k int, s string").coalesce(1).write.parquet(tmp + "/p")
    df = spark.read.parquet(tmp + "/p")
    assert by_name(profile_detailed(df))["s"]["sample_values"] == ["v0", "v1", "v2"]


def test_empty_frame_with_columns(spark):
    df = spark.createDataFrame([], "a bigint, s string, x double")
    p = by_name(profile_detailed(df))
    assert p["a"]["nulls"] == 0 and p["a"]["unique"] == 0 and p["a"]["row_count"] == 0
    assert p["a"]["min"] == (None, None, None)
    assert p["s"]["sample_values"] == []
    assert p["x"]["max"]["Float"] is None


def test_zero_columns(spark):
    df = spark.range(3).select()
    assert profile_detailed(df).count() == 0
    assert profile_basic(df).count() == 0


def test_approx_distinct(spark):
    df = spark.range(0, 20000).selectExpr("id", "id % 100 AS m", "CAST(NULL AS INT) AS n")
    p = by_name(profile_detailed(df, distinct="approx"))
    assert abs(p["id"]["unique"] - 20000) < 20000 * 0.05
    assert abs(p["m"]["unique"] - 100) <= 5
    assert p["n"]["unique"] == 1
    with pytest.raises(ValueError):
        profile_detailed(df, distinct="nope")


def test_exact_single_pass_matches(spark):
    df = spark.range(0, 500).selectExpr("id", "id % 7 AS m", "IF(id % 3 = 0, NULL, id % 5) AS n")
    a = {r["column"]: r["unique"] for r in profile_detailed(df).collect()}
    b = {r["column"]: r["unique"] for r in profile_detailed(df, distinct="exact_single_pass").collect()}
    assert a == b == {"id": 500, "m": 7, "n": 6}  # 0..4 and null


def test_float_format():
    assert _format_float(1.5) == "1.5"
    assert _format_float(100.0) == "100.0"
    assert _format_float(0.001) == "0.001"
    assert _format_float(1e21) == "1e21"
    assert _format_float(1e20) == "100000000000000000000.0"
    assert _format_float(1.5e-7) == "1.5e-7"
    assert _format_float(-2.25) == "-2.25"
    assert _format_float(float("nan")) is None
    assert _format_float(float("inf")) is None


def test_json_export(spark, tmp):
    df = spark.createDataFrame([(1, 1.5, "a"), (2, None, None)], "a bigint, x double, s string")
    text = profile_json_text(profile_detailed(df))
    doc = json.loads(text)
    assert [d["column"] for d in doc] == ["a", "x", "s"]
    assert list(doc[0]) == ["column", "dtype", "nulls", "unique", "min", "max", "sample_values"]
    assert doc[0]["min"] == {"Int": 1} and doc[0]["sample_values"] is None
    assert doc[1]["max"] == {"Float": 1.5}
    assert doc[2]["min"] == "None" and doc[2]["sample_values"] == ["a"]
    assert text.startswith("[\n  {\n    \"column\": \"a\",")
    out = tmp + "/prof"
    export_profile_json(profile_detailed(df), out)
    back = spark.read.option("multiLine", "true").json(out)
    assert back.count() == 3
    export_profile_json(profile_detailed(df.select("a")), out)  # overwrite
    assert spark.read.option("multiLine", "true").json(out).count() == 1


def test_json_export_nan_is_null(spark):
    df = spark.createDataFrame([(float("nan"),)], "x double")
    doc = json.loads(profile_json_text(profile_detailed(df)))
    assert doc[0]["min"] == {"Float": None}


def test_profile_plan_shape(spark, tmp):
    spark.range(100).selectExpr("id", "CAST(id AS STRING) AS s", "id * 1.5 AS d").write.parquet(tmp + "/p")
    df = spark.read.parquet(tmp + "/p")
    plan = plan_text(profile_detailed(df))
    assert "TakeOrderedAndProject" in plan  # samples: bounded per-task heap
    assert "Expand" not in plan  # no row x column blow-up in exact mode


def test_materialize_derived_input(spark, tmp):
    from quarry.operators.profile import should_materialize

    left = spark.range(0, 200).selectExpr("id", "CAST(id % 7 AS STRING) AS s")
    right = spark.range(0, 100).selectExpr("id", "id * 2 AS v")
    joined = left.join(right, "id", "left")
    assert should_materialize(joined, 3)
    assert not should_materialize(joined, 1)
    p = by_name(profile_detailed(joined))
    assert p["v"]["nulls"] == 100 and p["s"]["unique"] == 7 and p["id"]["unique"] == 200
    plan = plan_text(profile_detailed(joined))
    assert "Range" not in plan  # the join ran once, into the checkpoint
    left.write.parquet(tmp + "/p")
    assert not should_materialize(spark.read.parquet(tmp + "/p").where("id > 3").select("s"), 5)


def test_row_format_input_is_landed_once_and_keeps_file_order(spark, tmp):
    from quarry.operators.profile import should_materialize
    from quarry.sources.text import read_csv

    lines = ["k,s"] + [f"{i},v{i}" for i in range(30)]
    with open(tmp + "/a.csv", "w") as fh:
        fh.write("\n".join(lines) + "\n")
    df = read_csv(spark, tmp + "/a.csv")
    assert should_materialize(df, 3)
    spark.range(5).write.orc(tmp + "/o")
    assert not should_materialize(spark.read.orc(tmp + "/o"), 3)
    prof = profile_detailed(df)
    p = by_name(prof)
    assert p["s"]["sample_values"] == ["v0", "v1", "v2"]
    assert p["k"]["unique"] == 30 and p["k"]["max"]["Int"] == 29
    plan = plan_text(prof)
    assert "FileScan csv" not in plan and "Scan csv" not in plan


def test_exact_plans_agree(spark):
    df = spark.sql(
        """
        SELECT id, CAST(id % 3 AS INT) AS i, IF(id % 4 = 0, NULL, id * 0.5D) AS d,
               IF(id % 5 = 0, NULL, CAST(id % 7 AS STRING)) AS s, CAST(id % 2 = 0 AS BOOLEAN) AS b,
               DATE_ADD(DATE'2020-01-01', CAST(id % 9 AS INT)) AS dt, CAST(id % 6 AS DECIMAL(10, 2)) AS dec,
               CAST(CAST(id % 3 AS STRING) AS BINARY) AS bin, array(id % 2) AS arr,
               IF(id = 3, CAST('NaN' AS DOUBLE), CAST(-0.0 AS DOUBLE)) AS z
        FROM range(0, 200)
        """
    )
    narrow = sorted(profile_detailed(df, exact_plan="narrow").collect(), key=lambda r: r["position"])
    per_col = sorted(profile_detailed(df, exact_plan="per_column").collect(), key=lambda r: r["position"])
    assert [r.asDict() for r in narrow][:-1] == [r.asDict() for r in per_col][:-1]
    z_n, z_p = narrow[-1], per_col[-1]
    assert z_n["unique"] == z_p["unique"] == 2 and z_n["min"]["Float"] == 0.0
    p = {r["column"]: r for r in narrow}
    assert p["d"]["nulls"] == 50 and p["s"]["unique"] == 8 and p["dec"]["unique"] == 6 and p["bin"]["unique"] == 3
    plan = plan_text(profile_detailed(df, exact_plan="narrow"))
    assert plan.count("Generate") >= 4  # one narrow explode per type family


@pytest.mark.parametrize("columns", [1, 2, 33, 40])
def test_one_plan_at_every_width(spark, columns):
    df = spark.range(50).selectExpr(*[f"id % {k + 2} AS c{k}" for k in range(columns)])
    plan = plan_text(profile_detailed(df, samples=False))
    assert plan.count("Generate") == 1  # one narrow scan for the single type family
    p = {r["column"]: r["unique"] for r in profile_detailed(df, samples=False).collect()}
    assert p == {f"c{k}": k + 2 for k in range(columns)}


def test_long_and_short_values_never_meet(spark):
    import hashlib

    long_ = "x" * 33
    texts = [long_, hashlib.sha256(long_.encode()).hexdigest(), "x" * 32, "x", "", long_, "é" * 16, "é" * 17]
    df = spark.createDataFrame([(t, t.encode(), hashlib.sha256(t.encode()).digest()) for t in texts], "s string, b binary, d binary")
    more = df.selectExpr("s", "b").unionAll(df.selectExpr("NULL", "d"))
    p = by_name(profile_detailed(more))
    assert p["s"]["unique"] == 7 + 1  # and null
    assert p["b"]["unique"] == 14


def test_duplicate_names_rejected(spark):
    a = spark.range(3).selectExpr("id", "id AS v")
    b = spark.range(3).selectExpr("id", "id AS v")
    joined = a.join(b, a.id == b.id)
    with pytest.raises(ValueError, match="duplicate column names"):
        profile_detailed(joined)
    with pytest.raises(ValueError, match="duplicate column names"):
        profile_basic(joined)


def test_wide_samples_single_scan(spark, tmp):
    from quarry.operators import profile as prof

    n = prof.SAMPLED_APART + 2
    cols = [f"IF(id % {k + 2} = 0, NULL, CONCAT('c{k}_', id)) AS s{k}" for k in range(n)]
    spark.range(40).selectExpr("id", *cols).coalesce(1).write.parquet(tmp + "/w")
    df = spark.read.parquet(tmp + "/w")
    p = profile_detailed(df)
    plan = plan_text(p)
    assert "WindowGroupLimit" in plan and "TakeOrderedAndProject" not in plan
    got = {r["column"]: r["sample_values"] for r in p.collect()}
    for k in range(n):
        want = [f"c{k}_{i}" for i in range(40) if i % (k + 2) != 0][:3]
        assert got[f"s{k}"] == want


def test_unusual_types(spark):
    df = spark.sql(
        """SELECT id, NULL AS nul, make_interval(0, 0, 0, CAST(id AS INT), 0, 0, 0) AS ci,
                  make_dt_interval(CAST(id AS INT)) AS dti, make_ym_interval(1, CAST(id AS INT)) AS ymi,
                  CAST(IF(id % 2 = 0, 'A', 'a') AS STRING COLLATE UTF8_LCASE) AS coll
           FROM range(5)"""
    )
    p = by_name(profile_detailed(df))
    assert p["nul"]["unique"] == 1 and p["nul"]["nulls"] == 5 and p["nul"]["dtype"] == "void"
    assert p["ci"]["unique"] == p["dti"]["unique"] == p["ymi"]["unique"] == 5
    assert p["coll"]["unique"] == 1  # 'A' and 'a' are equal under this collation
    assert p["coll"]["sample_values"] == ["A", "a", "A"]


def test_profile_with_count(spark):
    from quarry import profile_with_count

    n, prof = profile_with_count(spark.range(7).selectExpr("id", "CAST(id AS STRING) AS s"))
    assert n == 7 and [r["column"] for r in prof.collect()] == ["id", "s"]
    n, prof = profile_with_count(spark.range(4).select(), detailed=False)
    assert n == 4 and prof.count() == 0
