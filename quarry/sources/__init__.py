"""Readers. Each returns a lazy Spark DataFrame."""

from quarry.sources.avro import read_avro
from quarry.sources.columnar import read_orc, read_parquet
from quarry.sources.excel import parse_workbook_bytes, read_excel
from quarry.sources.jdbc import read_jdbc
from quarry.sources.json import parse_http_bodies, parse_json_text, read_json
from quarry.sources.payload import land_bytes, parse_avro_bytes, parse_orc_bytes, parse_parquet_bytes
from quarry.sources.text import parse_csv_text, read_csv, read_text

__all__ = [
    "land_bytes",
    "parse_avro_bytes",
    "parse_orc_bytes",
    "parse_parquet_bytes",
    "parse_csv_text",
    "parse_http_bodies",
    "parse_json_text",
    "parse_workbook_bytes",
    "read_avro",
    "read_csv",
    "read_excel",
    "read_jdbc",
    "read_json",
    "read_orc",
    "read_parquet",
    "read_text",
]
