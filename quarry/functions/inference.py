"""Type inference for text sources, done as one Spark aggregate.

Text readers first parse every field as a string, then decide each column's
type from the leading ``infer_schema_length`` rows (or all rows) with a
single-row aggregate of ``bool_and`` flags. It runs on the executors like any
aggregate, so inferring over a whole 100 TB input is one extra scan, not a trip
through the driver.

Rules: integers are 64-bit, decimals and exponents are double, ``true`` and
``false`` (any case) are boolean; dates and timestamps only when asked for;
everything else, and all-null columns, are strings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.encoding import qcol

# Fixed value patterns of the inference rules.
INT_PATTERN = r"^[+-]?[0-9]+$"
FLOAT_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$|^(NaN|[+-]?Inf|[+-]?Infinity)$"
BOOL_VALUES = ("true", "false")
DATE_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
TIMESTAMP_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,9})?)?$"


def _all(pred):
    return F.coalesce(F.bool_and(pred), F.lit(True))


def infer_types(strings: DataFrame, columns, *, limit=None, infer_dates: bool = False) -> dict:
    """Map column name -> Spark type, from string columns of ``strings``."""
    sample = strings.limit(limit) if limit is not None else strings
    aggs = []
    for i, name in enumerate(columns):
        c = qcol(name)
        present = c.isNotNull() & (c != "")
        aggs += [
            F.count_if(present).alias(f"n{i}"),
            _all(~present | (c.rlike(INT_PATTERN) & c.try_cast("bigint").isNotNull())).alias(f"i{i}"),
            _all(~present | c.rlike(FLOAT_PATTERN)).alias(f"f{i}"),
            _all(~present | F.lower(c).isin(*BOOL_VALUES)).alias(f"b{i}"),
        ]
        if infer_dates:
            aggs += [
                _all(~present | (c.rlike(DATE_PATTERN) & c.try_cast("date").isNotNull())).alias(f"d{i}"),
                _all(~present | (c.rlike(TIMESTAMP_PATTERN) & c.try_cast("timestamp_ntz").isNotNull())).alias(
                    f"t{i}"
                ),
            ]
    if not aggs:
        return {}
    flags = sample.agg(*aggs).collect()[0]
    out = {}
    for i, name in enumerate(columns):
        if flags[f"n{i}"] == 0:
            out[name] = T.StringType()
        elif flags[f"i{i}"]:
            out[name] = T.LongType()
        elif flags[f"f{i}"]:
            out[name] = T.DoubleType()
        elif flags[f"b{i}"]:
            out[name] = T.BooleanType()
        elif infer_dates and flags[f"d{i}"]:
            out[name] = T.DateType()
        elif infer_dates and flags[f"t{i}"]:
            out[name] = T.TimestampNTZType()
        else:
            out[name] = T.StringType()
    return out


def _py_flags(values, infer_dates: bool) -> dict:
    import datetime as dt
    import re

    int_re, float_re = re.compile(INT_PATTERN), re.compile(FLOAT_PATTERN)
    date_re, ts_re = re.compile(DATE_PATTERN), re.compile(TIMESTAMP_PATTERN)

    def is_int(v):
        return bool(int_re.match(v)) and -(2**63) <= int(v) < 2**63

    def is_date(v):
        if not date_re.match(v):
            return False
        try:
            dt.date.fromisoformat(v)
            return True
        except ValueError:
            return False

    def is_ts(v):
        if not ts_re.match(v):
            return False
        try:
            dt.datetime.fromisoformat(v)
            return True
        except ValueError:
            return False

    present = [v for v in values if v is not None and v != ""]
    return {
        "n": len(present),
        "i": all(is_int(v) for v in present),
        "f": all(float_re.match(v) for v in present),
        "b": all(v.lower() in BOOL_VALUES for v in present),
        "d": infer_dates and all(is_date(v) for v in present),
        "t": infer_dates and all(is_ts(v) for v in present),
    }


def infer_types_from_rows(spark, columns, rows, *, infer_dates: bool = False) -> dict:
    """The same rules applied on the driver to a bounded list of string rows
    already fetched with a ``limit`` job (header discovery and the sample
    share that one job), so no further Spark job is needed."""
    n = len(columns)
    data = [(list(r) + [None] * n)[:n] for r in rows]
    out = {}
    for i, name in enumerate(columns):
        flags = _py_flags([r[i] for r in data], infer_dates)
        if flags["n"] == 0:
            out[name] = T.StringType()
        elif flags["i"]:
            out[name] = T.LongType()
        elif flags["f"]:
            out[name] = T.DoubleType()
        elif flags["b"]:
            out[name] = T.BooleanType()
        elif flags["d"]:
            out[name] = T.DateType()
        elif flags["t"]:
            out[name] = T.TimestampNTZType()
        else:
            out[name] = T.StringType()
    return out
