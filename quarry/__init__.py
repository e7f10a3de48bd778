"""quarry: extract, profile and load tables with Spark.

Readers return lazy DataFrames, transforms and profiles are DataFrame to
DataFrame, sinks write with Spark's own committers.
"""

from quarry.operators.export import export_profile_json, profile_json_text
from quarry.operators.profile import flatten_profile, profile_basic, profile_detailed, profile_with_count
from quarry.operators.profile_state import profile_from_state, profile_state, update_profile_state
from quarry.operators.transform import limit_rows, select_columns
from quarry.plans.copy_job import CopyRequest, copy_data, copy_sql, sql_extract
from quarry.plans.pipeline import run_file_pipeline
from quarry.sinks import write_csv, write_json, write_orc, write_parquet
from quarry.sinks.published import publish, read_published
from quarry.sources import (
    land_bytes,
    parse_avro_bytes,
    parse_csv_text,
    parse_http_bodies,
    parse_json_text,
    parse_orc_bytes,
    parse_parquet_bytes,
    parse_workbook_bytes,
    read_avro,
    read_csv,
    read_excel,
    read_jdbc,
    read_json,
    read_orc,
    read_parquet,
    read_text,
)

__all__ = [
    "copy_data",
    "copy_sql",
    "export_profile_json",
    "flatten_profile",
    "land_bytes",
    "limit_rows",
    "parse_avro_bytes",
    "parse_csv_text",
    "parse_http_bodies",
    "parse_json_text",
    "parse_orc_bytes",
    "parse_parquet_bytes",
    "parse_workbook_bytes",
    "profile_basic",
    "profile_detailed",
    "profile_from_state",
    "profile_json_text",
    "profile_state",
    "profile_with_count",
    "publish",
    "read_avro",
    "read_csv",
    "read_excel",
    "read_jdbc",
    "read_json",
    "read_orc",
    "read_parquet",
    "read_published",
    "read_text",
    "run_file_pipeline",
    "select_columns",
    "sql_extract",
    "update_profile_state",
    "CopyRequest",
    "write_csv",
    "write_json",
    "write_orc",
    "write_parquet",
]
