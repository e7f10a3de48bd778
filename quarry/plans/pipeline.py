"""File pipeline: read (S*) -> select (T1) -> limit (T2) -> write (K*).

The chain stays one lazy plan until the sink runs, so column selection
reaches the scan (``ReadSchema``) and an ordered limit plans as a bounded
top-k instead of a sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.operators.transform import limit_rows, select_columns
from quarry.sinks import write_csv, write_json, write_orc, write_parquet
from quarry.sources.avro import read_avro
from quarry.sources.columnar import read_orc, read_parquet
from quarry.sources.excel import read_excel
from quarry.sources.json import read_json
from quarry.sources.text import read_csv, read_text

READERS = {
    "csv": read_csv,
    "text": read_text,
    "json": read_json,
    "parquet": read_parquet,
    "orc": read_orc,
    "avro": read_avro,
    "xlsx": read_excel,
}
WRITERS = {"csv": write_csv, "json": write_json, "parquet": write_parquet, "orc": write_orc}


def extract(spark: SparkSession, fmt: str, path, **options) -> DataFrame:
    if fmt not in READERS:
        raise ValueError(f"unknown source format {fmt!r}; one of {sorted(READERS)}")
    return READERS[fmt](spark, path, **options)


def load(df: DataFrame, fmt: str, path: str, **options) -> None:
    if fmt not in WRITERS:
        raise ValueError(f"unknown sink format {fmt!r}; one of {sorted(WRITERS)}")
    WRITERS[fmt](df, path, **options)


def transform(df: DataFrame, columns=None, limit: int | None = None, order_by=None) -> DataFrame:
    if columns is not None:
        df = select_columns(df, columns)
    if limit is not None:
        df = limit_rows(df, limit, order_by=order_by)
    return df


def run_file_pipeline(
    spark: SparkSession,
    source_format: str,
    source_path,
    sink_format: str,
    sink_path: str,
    *,
    columns=None,
    limit: int | None = None,
    order_by=None,
    source_options: dict | None = None,
    sink_options: dict | None = None,
) -> None:
    """Run extract -> transform -> load. What was written is at ``sink_path``;
    the plan is not returned, since a limit without an order could give other
    rows when it runs again."""
    df = transform(extract(spark, source_format, source_path, **(source_options or {})), columns, limit, order_by)
    load(df, sink_format, sink_path, **(sink_options or {}))
