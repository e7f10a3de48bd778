import pytest

from quarry import limit_rows, select_columns
from helpers import plan_text


@pytest.fixture()
def two_ints(spark):
    return spark.createDataFrame([(1, 4), (2, 5), (3, 6)], "a int, b int")


def test_select_then_limit(two_ints):
    # the reference's inline fixture: select `a`, limit 2 gives 2 rows
    assert select_columns(two_ints, ["a"]).columns == ["a"]
    assert limit_rows(two_ints, 2).count() == 2


def test_select_keeps_given_order(two_ints):
    assert select_columns(two_ints, ["b", "a"]).columns == ["b", "a"]


def test_select_missing_is_error(two_ints):
    with pytest.raises(ValueError, match="not found"):
        select_columns(two_ints, ["c"])


def test_select_is_case_sensitive(two_ints):
    with pytest.raises(ValueError, match="not found"):
        select_columns(two_ints, ["A"])


def test_select_duplicates_is_error(two_ints):
    with pytest.raises(ValueError, match="duplicate"):
        select_columns(two_ints, ["a", "a"])


def test_select_odd_names(spark):
    df = spark.createDataFrame([(1.0, 2, 3)], "`Adj Close` double, `x.y` int, `q``t` int")
    out = select_columns(df, ["x.y", "Adj Close", "q`t"])
    assert out.columns == ["x.y", "Adj Close", "q`t"]
    assert out.first() == (2, 1.0, 3)


def test_limit_edges(two_ints):
    assert limit_rows(two_ints, 0).count() == 0
    assert limit_rows(two_ints, 10).count() == 3
    with pytest.raises(ValueError):
        limit_rows(two_ints, -1)
    with pytest.raises(TypeError):
        limit_rows(two_ints, 1.5)


def test_limit_ordered_is_deterministic_and_topk(spark):
    df = spark.range(1000).selectExpr("id", "(id * 7919) % 1000 AS k")
    out = limit_rows(df, 5, order_by="k")
    assert [r.k for r in out.collect()] == [0, 1, 2, 3, 4]
    plan = plan_text(out)
    assert "TakeOrderedAndProject" in plan


def test_select_prunes_parquet_scan(spark, tmp):
    spark.range(10).selectExpr("id", "id * 2 AS b", "'x' AS c").write.parquet(tmp + "/p")
    from quarry.sources.columnar import read_parquet

    out = select_columns(read_parquet(spark, tmp + "/p"), ["b"])
    plan = plan_text(out)
    assert "ReadSchema: struct<b:bigint>" in plan


def test_limit_in_file_order(spark, tmp):
    # two files of different sizes: Spark packs the larger one first, file
    # order still starts with the lexically first file
    spark.range(0, 5).coalesce(1).write.parquet(tmp + "/p/a")
    spark.range(100, 400).coalesce(1).write.parquet(tmp + "/p/b")
    from quarry.sources.columnar import read_parquet

    df = read_parquet(spark, [tmp + "/p/a", tmp + "/p/b"])
    out = limit_rows(df, 7, file_order=True)
    assert [r.id for r in out.collect()] == [0, 1, 2, 3, 4, 100, 101]
    assert out.columns == ["id"]
    assert "TakeOrderedAndProject" in plan_text(out)


def test_limit_reads_the_first_files_only(spark, tmp, monkeypatch):
    from quarry.operators import transform

    for i in range(40):
        spark.range(i * 10, i * 10 + 10).coalesce(1).write.parquet(f"{tmp}/t/p {i:02d}")
    df = spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp}/t")
    for n in (0, 1, 10, 15, 95, 399, 400, 1000):  # also without asking for file order
        assert [r.id for r in limit_rows(df, n).collect()] == list(range(min(n, 400)))
    # runs of 1, 2, 4, ... files: the prefix is at most twice as long as needed
    assert transform._first_files(df, 15).count() == 30
    assert transform._first_files(df, 95).count() == 150
    first = transform._first_files(df, 15)
    assert len(first.inputFiles()) == 40  # listed once; the scan itself is bounded by path
    assert "PartitionFilters" in plan_text(first) and first.select("_metadata.file_path").distinct().count() == 3
    filtered = limit_rows(df.where("id % 7 = 0"), 4)
    assert [r.id for r in filtered.collect()] == [0, 7, 14, 21]
    assert limit_rows(df.where("id < 0"), 4).count() == 0
    late = limit_rows(df.where("id >= 390").select((df.id * 2).alias("d")), 4)
    assert [r.d for r in late.collect()] == [780, 782, 784, 786] and late.columns == ["d"]
    assert limit_rows(df, 3, file_order=False).count() == 3


def test_limit_of_text_files_and_derived_frames(spark, tmp):
    for i, name in enumerate("ba"):
        with open(f"{tmp}/{name}.csv", "w") as fh:
            fh.writelines(f"{name}{j}\n" for j in range(1000 + i))
    df = spark.read.text(tmp)
    assert [r.value for r in limit_rows(df, 1003).collect()] == [f"a{j}" for j in range(1001)] + ["b0", "b1"]
    assert limit_rows(spark.range(5).join(spark.range(3), "id"), 2).count() == 2
