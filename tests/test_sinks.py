import glob

import pytest

from quarry.sinks import write_csv, write_json, write_orc, write_parquet
from quarry.sources.columnar import read_orc, read_parquet
from quarry.sources.json import read_json
from quarry.sources.text import read_csv
from helpers import plan_text


@pytest.fixture()
def frame(spark):
    return spark.createDataFrame(
        [(1, 'say "hi"', 1.5), (2, "", None), (3, None, -0.25), (4, "a,b\nc", 2.0)],
        "id bigint, s string, x double",
    )


def test_csv_round_trip(spark, frame, tmp):
    write_csv(frame, tmp + "/c")
    back = read_csv(spark, tmp + "/c", multiline=True)
    assert sorted(back.collect()) == sorted(frame.collect())
    raw = "".join(open(p).read() for p in sorted(glob.glob(tmp + "/c/part-*")))
    assert '"say ""hi"""' in raw and '""' in raw


def test_csv_overwrites(spark, frame, tmp):
    write_csv(frame, tmp + "/c")
    write_csv(frame.limit(1), tmp + "/c", num_files=1)
    assert read_csv(spark, tmp + "/c", multiline=True).count() == 1


def test_json_round_trip_keeps_nulls(spark, frame, tmp):
    write_json(frame, tmp + "/j")
    text = "".join(open(p).read() for p in glob.glob(tmp + "/j/part-*"))
    assert '"s":null' in text
    back = read_json(spark, tmp + "/j").select("id", "s", "x")
    assert sorted(back.collect()) == sorted(frame.collect())


def test_parquet_and_orc(spark, frame, tmp):
    write_parquet(frame, tmp + "/p", partition_by=["id"])
    assert sorted(read_parquet(spark, tmp + "/p").select("id", "s", "x").collect()) == sorted(frame.collect())
    write_orc(frame, tmp + "/o")
    assert sorted(read_orc(spark, tmp + "/o").collect()) == sorted(frame.collect())


def test_orc_missing_path(spark, tmp):
    with pytest.raises(FileNotFoundError, match="ORC file not found"):
        read_orc(spark, tmp + "/nope.orc")


def test_zero_column_frame_is_error(spark, tmp):
    with pytest.raises(ValueError):
        write_json(spark.range(1).select(), tmp + "/z")


def test_partitioned_write_rebalances_hot_values(spark, tmp):
    # one partition value holds most rows; the rebalance hint lets AQE split it
    df = spark.range(0, 20000).selectExpr("id", "IF(id < 15000, 'hot', CAST(id % 3 AS STRING)) AS p")
    write_parquet(df, tmp + "/p", partition_by=["p"])
    back = read_parquet(spark, tmp + "/p")
    assert back.count() == 20000 and back.where("p = 'hot'").count() == 15000
    plan = plan_text(df.hint("rebalance", "p"))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan
