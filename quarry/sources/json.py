"""JSON sources.

* ``read_json``: newline-delimited JSON files (``array=True`` for files
  holding one JSON array). Malformed input fails (FAILFAST); an empty input is
  an error rather than Spark's zero-column frame.
* ``parse_json_text``: a column operator. Each row holds one JSON body, a
  table holds many: a body that is a JSON array gives one row per element,
  any other body is read as NDJSON, one row per non-blank line. Everything runs
  in ``from_json`` / ``explode`` on the executors. White space around a body
  (spaces, tabs, newlines) does not matter.
* ``parse_http_bodies``: landed HTTP responses ``(url, status, body)``: keep
  successful statuses, then ``parse_json_text``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.encoding import qcol

FAILFAST = {"mode": "FAILFAST"}


def _paths(path) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def read_json(
    spark: SparkSession,
    path,
    *,
    array: bool = False,
    schema: T.StructType | None = None,
    infer_schema_length: int | None = None,
    sampling_ratio: float | None = None,
) -> DataFrame:
    """S3: JSON lines (``array=True``: each file is one JSON array).

    Without ``schema`` the types come from all records of all files, so no
    field is missed: one more pass over the input, in Spark. A caller who knows
    that the first records have every field may say so with
    ``infer_schema_length`` (for array files: the first file) or
    ``sampling_ratio``; at scale, give a ``schema``. Malformed records fail; an
    empty input is an error."""
    paths = _paths(path)
    if schema is None and array and infer_schema_length is not None:
        # Array files are whole JSON documents: infer from the first file (by
        # path) instead of reading every file twice. The listing reads no
        # file content.
        first = spark.read.format("binaryFile").load(paths).agg(F.min("path")).first()[0]
        if first is None:
            raise ValueError(f"empty JSON input: {path}")
        schema = spark.read.option("mode", "FAILFAST").option("multiLine", "true").json(first).schema
        if not schema.fields:
            raise ValueError(f"empty JSON input: {path}")
    if schema is None and not array and infer_schema_length is not None:
        lines = spark.read.text(paths).where(_stripped(F.col("value")) != "")
        sample = [r[0] for r in lines.limit(infer_schema_length).collect()]
        if not sample:
            raise ValueError(f"empty JSON input: {path}")
        schema = spark.read.option("mode", "FAILFAST").json(spark.sparkContext.parallelize(sample, 1)).schema
    reader = spark.read.option("mode", "FAILFAST").option("multiLine", str(array).lower())
    if sampling_ratio is not None:
        reader = reader.option("samplingRatio", str(sampling_ratio))
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.json(paths)
    if not df.schema.fields:
        raise ValueError(f"empty JSON input: {path}")
    return df


def _stripped(c):
    """Without JSON white space at both ends."""
    return F.btrim(c, F.lit(" \t\r\n"))


def json_records(df: DataFrame, body) -> DataFrame:
    """One row per JSON record of each body, as text in column ``record``,
    next to the input's other columns."""
    c = qcol(body) if isinstance(body, str) else body
    t = _stripped(c)
    is_array = t.startswith("[") & t.endswith("]")
    pieces = F.when(is_array, F.from_json(t, "array<string>", FAILFAST)).otherwise(F.split(t, r"\r?\n"))
    out = df.select("*", F.explode(pieces).alias("record"))
    return out.where(_stripped(F.col("record")) != "")


def infer_json_schema(spark: SparkSession, records: DataFrame, limit: int | None = None) -> T.StructType:
    """Schema of JSON record text, from every record, in one aggregate: records
    are parsed to variants, and the schema of variants is merged in the tasks and
    between them. Nothing is written. With ``limit`` the leading records are used
    instead (a bounded sample). Malformed records raise."""
    col = records.select(F.col("record").cast("string").alias("record"))
    if limit is not None:
        col = col.limit(limit)
    found = col.agg(F.schema_of_variant_agg(F.parse_json("record"))).first()[0]
    if found is None or found == "VOID":
        raise ValueError("no JSON records to infer a schema from")
    schema = _json_types(_variant_schema(found))
    if not isinstance(schema, T.StructType):
        raise ValueError(f"JSON records must be objects, not {found}")
    if not schema.fields:
        raise ValueError("no JSON records to infer a schema from")
    return schema


def _variant_schema(text: str) -> T.DataType:
    """The type that ``schema_of_variant_agg`` writes: ``OBJECT`` stands for a
    struct, names are quoted with backticks where they need it."""
    parts = re.split(r"(`(?:[^`]|``)*`)", text)
    parts[::2] = [re.sub(r"\bOBJECT<", "STRUCT<", p) for p in parts[::2]]
    return T.StructType.fromDDL(f"r {''.join(parts)}").fields[0].dataType


def _json_types(kind: T.DataType) -> T.DataType:
    """The types that Spark's JSON reader gives such values: fractions are
    doubles, integers beyond 64 bits decimals, and values of several types, or
    of none, text."""
    if isinstance(kind, T.StructType):
        # null-only members of an object without any known one are text as well
        return T.StructType([T.StructField(f.name, _json_types(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_json_types(kind.elementType))
    if isinstance(kind, T.DecimalType):
        return kind if kind.scale == 0 and kind.precision > 18 else T.DoubleType()
    if isinstance(kind, (T.NullType, T.VariantType)):
        return T.StringType()
    return kind


def parse_json_text(
    df: DataFrame,
    body,
    *,
    schema: T.StructType | None = None,
    infer_schema_length: int | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Parse JSON bodies held in a string column (S9 for JSON payloads).

    ``keep`` lists input columns carried next to the parsed fields (for
    example a key). Malformed records raise when the result is read.
    """
    if schema is None:
        schema = infer_json_schema(df.sparkSession, json_records(df, body), infer_schema_length)
    # One parse per record: an array body goes straight to array<struct>, an
    # NDJSON body is split and each non-blank line parsed to the struct.
    c = qcol(body) if isinstance(body, str) else body
    t = _stripped(c)
    is_array = t.startswith("[") & t.endswith("]")
    lines = F.filter(F.split(t, r"\r?\n"), lambda x: _stripped(x) != "")
    parsed = F.when(is_array, F.from_json(t, T.ArrayType(schema), FAILFAST)).otherwise(
        F.transform(lines, lambda x: F.from_json(x, schema, FAILFAST))
    )
    kept = [qcol(k) for k in (keep or [])]
    return df.select(*kept, F.explode(parsed).alias("__json")).select(*kept, "__json.*")


def parse_http_bodies(
    df: DataFrame,
    *,
    body: str = "body",
    status: str = "status",
    ok: tuple[int, int] = (200, 299),
    schema: T.StructType | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Landed HTTP responses. Bodies whose status is outside ``ok`` are
    skipped; the rest are parsed like S4."""
    lo, hi = ok
    good = df.where(qcol(status).between(lo, hi))
    return parse_json_text(good, body, schema=schema, keep=keep)
