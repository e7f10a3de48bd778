"""Incremental landing: the file pipeline (J4) and landed-response parsing
(S11) run as Structured Streaming queries over a directory that keeps
receiving files.

The reference has no streaming operator; these reuse the batch operators
unchanged on a stream. Spark's file source remembers which files it has
processed and the Parquet file sink commits each micro-batch atomically, both
through the checkpoint, so a restarted or failed run picks up exactly the
files not yet landed, with no duplicates. The checkpoint therefore belongs to
one source and one sink: by default it lies beside the sink's data under a name made
from the source, and a sink that was written with another checkpoint, or has lost
its own, is refused: Spark would skip new files without an error. ``available_now=True`` processes
what is there and stops (a scheduled job); ``False`` keeps running.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quarry.operators.transform import select_columns
from quarry.sources.json import parse_http_bodies
from quarry.sources.text import NULL_SENTINEL

STREAM_FORMATS = ("csv", "json", "parquet", "orc", "text")


def default_checkpoint(sink_path: str, source_path: str) -> str:
    """The checkpoint of one source into one sink, next to the sink."""
    name = hashlib.sha256(source_path.rstrip("/").encode()).hexdigest()[:16]
    return f"{sink_path.rstrip('/')}__checkpoints/{name}"


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def _check_pair(spark: SparkSession, sink_path: str, checkpoint: str) -> None:
    if _exists(spark, f"{sink_path.rstrip('/')}/_spark_metadata") and not _exists(spark, f"{checkpoint}/commits"):
        raise ValueError(
            f"the sink {sink_path} has a log of earlier batches, but the checkpoint {checkpoint} has none: "
            "give the checkpoint it was written with, or a new sink"
        )


def read_stream(spark: SparkSession, fmt: str, path: str, schema: T.StructType,
                options: dict | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """A file stream. Streams need an explicit schema: inference would have to
    read data that has not arrived yet."""
    if fmt not in STREAM_FORMATS:
        raise ValueError(f"stream format must be one of {STREAM_FORMATS}")
    reader = spark.readStream.format(fmt).schema(schema)
    opts = dict(options or {})
    if fmt == "csv":
        # same text rules as the batch reader: doubled-quote escapes, and an
        # empty field is null while a quoted "" stays an empty string
        opts.setdefault("header", "true")
        opts.setdefault("escape", '"')
        opts.setdefault("nullValue", NULL_SENTINEL)
    if max_files_per_trigger:
        opts["maxFilesPerTrigger"] = str(max_files_per_trigger)
    return reader.options(**opts).load(path)


def _sink(df: DataFrame, sink_path: str, checkpoint: str, available_now: bool,
          partition_by=None, query_name: str | None = None, interval: str = "30 seconds") -> StreamingQuery:
    _check_pair(df.sparkSession, sink_path, checkpoint)
    w = df.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start(sink_path)


def stream_file_copy(
    spark: SparkSession,
    source_format: str,
    source_path: str,
    schema: T.StructType,
    sink_path: str,
    *,
    columns=None,
    checkpoint: str | None = None,
    available_now: bool = True,
    source_options: dict | None = None,
    partition_by=None,
    interval: str = "30 seconds",
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """J4 on a stream: files -> optional column selection (T1) -> Parquet.
    ``interval`` is the micro-batch trigger when ``available_now`` is False;
    ``max_files_per_trigger`` bounds each micro-batch when a backlog lands at
    once (``available_now`` still drains all of it, in bounded batches)."""
    df = read_stream(spark, source_format, source_path, schema, source_options, max_files_per_trigger)
    if columns is not None:
        df = select_columns(df, columns)
    checkpoint = checkpoint or default_checkpoint(sink_path, source_path)
    return _sink(df, sink_path, checkpoint, available_now, partition_by, interval=interval)


LANDED_SCHEMA = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("body", T.StringType()),
    ]
)


def stream_http_bodies(
    spark: SparkSession,
    landing_path: str,
    record_schema: T.StructType,
    sink_path: str,
    *,
    checkpoint: str | None = None,
    available_now: bool = True,
    keep: list[str] | None = None,
    interval: str = "30 seconds",
) -> StreamingQuery:
    """S11 on a stream: landed responses (JSON lines ``url, status, body``)
    -> successful statuses -> records parsed with ``record_schema`` -> Parquet."""
    landed = read_stream(spark, "json", landing_path, LANDED_SCHEMA)
    parsed = parse_http_bodies(landed, schema=record_schema, keep=keep)
    checkpoint = checkpoint or default_checkpoint(sink_path, landing_path)
    return _sink(parsed, sink_path, checkpoint, available_now, interval=interval)
