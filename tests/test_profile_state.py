import math

import pytest
from pyspark.sql import functions as F

from quarry.operators.profile import profile_detailed
from quarry.operators.profile_state import (
    current_state,
    profile_from_state,
    profile_state,
    update_profile_state,
)


def rows_from(spark, start, end):
    return spark.range(start, end).select(
        "id",
        (F.col("id") % 7).cast("int").alias("small"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("name "), (F.col("id") % 3000).cast("string"))).alias("name"),
        F.when(F.col("id") % 11 == 0, F.lit(float("nan"))).otherwise(F.col("id") / 3).alias("x"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 400).cast("int")).alias("day"),
        F.array((F.col("id") % 50).cast("int")).alias("list"),
        F.lit(None).cast("string").alias("nothing"),
    )


def plain(df):
    return [tuple(r) for r in df.collect()]


def write(df, path, files=1):
    df.coalesce(files).write.mode("append").parquet(path)


def test_state_against_the_exact_profile(spark, tmp):
    for i in range(3):
        write(rows_from(spark, 4000 * i, 4000 * (i + 1)), f"{tmp}/t")
    df = spark.read.parquet(f"{tmp}/t")
    state = profile_state(df)
    assert state.count() == 3 * len(df.columns)
    got = {r["column"]: r for r in profile_from_state(state).collect()}
    want = {r["column"]: r for r in profile_detailed(df).collect()}
    assert list(got) == list(want)
    for name, w in want.items():
        g = got[name]
        assert (g.dtype, g.nulls, g.row_count, g.position) == (w.dtype, w.nulls, w.row_count, w.position)
        assert repr((g.min, g.max)) == repr((w.min, w.max))
        assert abs(g.unique - w.unique) <= max(1, 4 * 0.017 * w.unique), name
    for q, x in zip((0.25, 0.5, 0.75), got["id"].quantiles, strict=True):
        assert abs(x - q * 12000) < 0.03 * 12000
    assert got["name"].quantiles is None and got["nothing"].unique == 1


def test_new_files_cost_a_scan_of_themselves(spark, tmp):
    state, table = f"{tmp}/state", f"{tmp}/t"
    write(rows_from(spark, 0, 3000), table, 2)
    assert update_profile_state(spark, state, table) == spark.read.parquet(table).select("_metadata.file_path").distinct().count()
    assert update_profile_state(spark, state, table) == 0
    write(rows_from(spark, 3000, 9000), table, 1)
    scanned = update_profile_state(spark, state, table)
    assert scanned == 1
    # only the new file has rows of its own since
    merged = plain(profile_from_state(spark.read.parquet(state)))
    at_once = plain(profile_from_state(profile_state(spark.read.parquet(table))))
    exact = [i for i, n in enumerate(profile_from_state(spark.read.parquet(state)).columns) if n != "quantiles"]
    assert [[repr(r[i]) for i in exact] for r in merged] == [[repr(r[i]) for i in exact] for r in at_once]


def test_changed_and_deleted_files(spark, tmp):
    import os

    state = f"{tmp}/state"
    for name, n in (("a", 10), ("b", 20)):
        rows_from(spark, 0, n).coalesce(1).write.parquet(f"{tmp}/t/{name}")
    assert update_profile_state(spark, state, f"{tmp}/t") == 2
    rows_from(spark, 100, 137).coalesce(1).write.mode("overwrite").parquet(f"{tmp}/t/b")
    assert update_profile_state(spark, state, f"{tmp}/t") == 1

    def count():
        return profile_from_state(current_state(spark, state, f"{tmp}/t")).first().row_count

    assert count() == 10 + 37
    for f in os.listdir(f"{tmp}/t/a"):
        os.remove(f"{tmp}/t/a/{f}")
    assert count() == 37


def test_odd_inputs(spark, tmp):
    derived = rows_from(spark, 0, 100).groupBy("small").agg(F.count("id").alias("n"))
    got = profile_from_state(profile_state(derived)).collect()
    assert [(r.column, r.row_count, r.unique) for r in got] == [("small", 7, 7), ("n", 7, 2)]
    nans = spark.createDataFrame([(float("nan"),), (None,)], "x double")
    r = profile_from_state(profile_state(nans)).first()
    assert math.isnan(r.min.Float) and r.unique == 2 and r.quantiles is None
    empty = spark.createDataFrame([], "x double, s string")
    assert profile_from_state(profile_state(empty)).count() == 0
    other = spark.createDataFrame([(1,)], "y int")
    both = profile_state(nans).unionByName(profile_state(other))
    with pytest.raises(Exception, match="differ"):
        profile_from_state(both).collect()
    with pytest.raises(ValueError, match="duplicate"):
        profile_state(nans.select("x", "x"))
