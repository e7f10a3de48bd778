import json
import os

import pytest
from pyspark.sql import types as T

from helpers import write_text
from quarry.plans.pipeline import run_file_pipeline
from quarry.sources.columnar import read_parquet
from quarry.sources.json import read_json
from quarry.sources.text import parse_csv_text
from quarry.streaming.landing import stream_file_copy, stream_http_bodies


def test_file_pipeline(spark, tmp):
    spark.range(100).selectExpr("id", "id * 2 AS b", "'x' AS c").write.parquet(tmp + "/in")
    run_file_pipeline(spark, "parquet", tmp + "/in", "json", tmp + "/out",
                      columns=["b", "id"], limit=5, order_by="id")
    back = read_json(spark, tmp + "/out")
    assert back.columns == ["b", "id"]
    assert sorted(r.id for r in back.collect()) == [0, 1, 2, 3, 4]


def test_csv_payloads(spark):
    docs = spark.createDataFrame(
        [(1, "a,b\n1,x\n2,y\n"), (2, "a,b\r\n3,\"q,z\"\r\n")], "doc int, body string"
    )
    df = parse_csv_text(docs, "body", keep=["doc"])
    assert df.columns == ["doc", "a", "b"]
    assert sorted(df.collect()) == [(1, 1, "x"), (1, 2, "y"), (2, 3, "q,z")]


def test_json_sampled_inference(spark, tmp):
    lines = "\n".join(json.dumps({"a": i, "b": "s"}) for i in range(10)) + "\n"
    path = write_text(tmp + "/a.json", lines)
    df = read_json(spark, path, infer_schema_length=3)
    assert dict((f.name, f.dataType) for f in df.schema.fields) == {"a": T.LongType(), "b": T.StringType()}
    assert df.count() == 10


def test_stream_file_copy_is_incremental(spark, tmp):
    land, out, ck = tmp + "/land", tmp + "/out", tmp + "/ck"
    os.makedirs(land)
    write_text(land + "/1.csv", "a,b\n1,x\n2,y\n")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    stream_file_copy(spark, "csv", land, schema, out, checkpoint=ck, columns=["b", "a"]).awaitTermination()
    assert read_parquet(spark, out).count() == 2
    write_text(land + "/2.csv", "a,b\n3,z\n")
    stream_file_copy(spark, "csv", land, schema, out, checkpoint=ck, columns=["b", "a"]).awaitTermination()
    back = read_parquet(spark, out)
    assert back.columns == ["b", "a"]
    assert sorted(r.a for r in back.collect()) == [1, 2, 3]  # each file landed once


def test_stream_http_bodies(spark, tmp):
    land, out = tmp + "/land", tmp + "/out"
    os.makedirs(land)
    rows = [
        {"url": "/a", "status": 200, "body": json.dumps([{"name": "ann"}, {"name": "bob"}])},
        {"url": "/b", "status": 404, "body": "Not Found"},
        {"url": "/c", "status": 200, "body": '{"name": "cy"}\n{"name": "di"}'},
    ]
    write_text(land + "/r.json", "\n".join(json.dumps(r) for r in rows) + "\n")
    schema = T.StructType([T.StructField("name", T.StringType())])
    stream_http_bodies(spark, land, schema, out, checkpoint=tmp + "/ck", keep=["url"]).awaitTermination()
    got = sorted((r.url, r.name) for r in read_parquet(spark, out).collect())
    assert got == [("/a", "ann"), ("/a", "bob"), ("/c", "cy"), ("/c", "di")]


def test_csv_payloads_with_text_options(spark):
    docs = spark.createDataFrame(
        [(1, "junk\n// note\na|b\n1|x\n\n// mid\n2|y\n"), (2, "junk\na|b\n3|z")], "doc int, body string"
    )
    df = parse_csv_text(docs, "body", delimiter="|", comment_prefix="//", skip_rows=1, keep=["doc"])
    assert df.columns == ["doc", "a", "b"]
    assert sorted(df.collect()) == [(1, 1, "x"), (1, 2, "y"), (2, 3, "z")]


def test_csv_payloads_multiline(spark):
    docs = spark.createDataFrame(
        [(7, 'skip\nid,s\n1,"two\nlines"\n## c\n2,x\n'), (8, 'skip\nid,s\n3,"a,b"\n')], "doc long, body string"
    )
    df = parse_csv_text(docs, "body", skip_rows=1, comment_prefix="##", multiline=True, keep=["doc"])
    assert df.columns == ["doc", "id", "s"]
    assert sorted(df.collect()) == [(7, 1, "two\nlines"), (7, 2, "x"), (8, 3, "a,b")]


def test_stream_backlog_in_bounded_batches(spark, tmp):
    land, out, ck = tmp + "/land", tmp + "/out", tmp + "/ck"
    os.makedirs(land)
    for i in range(4):
        write_text(f"{land}/{i}.csv", f"a,b\n{i},x\n")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    q = stream_file_copy(spark, "csv", land, schema, out, checkpoint=ck, max_files_per_trigger=1)
    q.awaitTermination()
    assert sorted(r.a for r in read_parquet(spark, out).collect()) == [0, 1, 2, 3]
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 4  # one file per micro-batch


def test_a_lost_or_foreign_checkpoint_is_refused(spark, tmp):
    schema = T.StructType([T.StructField("a", T.LongType())])
    out = tmp + "/out"
    for name in ("one", "two"):
        spark.range(3).withColumnRenamed("id", "a").coalesce(1).write.parquet(f"{tmp}/{name}")
    stream_file_copy(spark, "parquet", f"{tmp}/one", schema, out).awaitTermination()
    assert spark.read.parquet(out).count() == 3
    # the same pair again: nothing new
    stream_file_copy(spark, "parquet", f"{tmp}/one", schema, out).awaitTermination()
    assert spark.read.parquet(out).count() == 3
    with pytest.raises(ValueError, match="checkpoint"):
        stream_file_copy(spark, "parquet", f"{tmp}/two", schema, out)
    with pytest.raises(ValueError, match="checkpoint"):
        stream_file_copy(spark, "parquet", f"{tmp}/one", schema, out, checkpoint=f"{tmp}/lost")
