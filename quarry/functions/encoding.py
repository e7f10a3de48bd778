"""Column expressions used by the profiler (P2b-P2d).

All of these are built-in Spark expressions, so they stay inside whole-stage
codegen and take part in partial (map-side) aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Tag names of the min/max union. They are the JSON keys of the
# exported profile ({"Int": 5}, {"Float": 1.5}, {"Str": "x"}, bare "None").
MINMAX_INT = "Int"
MINMAX_FLOAT = "Float"
MINMAX_STR = "Str"
MINMAX_NONE = "None"

MINMAX_TYPE = T.StructType(
    [
        T.StructField(MINMAX_INT, T.LongType(), True),
        T.StructField(MINMAX_FLOAT, T.DoubleType(), True),
        T.StructField(MINMAX_STR, T.StringType(), True),
    ]
)

INT_KIND = "int"
FLOAT_KIND = "float"
NO_KIND = "none"


def qcol(name: str) -> Column:
    """Column by exact name, safe for spaces, dots and backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def epoch_micros_ntz(c: Column) -> Column:
    """Microseconds since 1970-01-01 for a ``timestamp_ntz`` column.

    ``unix_micros`` rejects ``timestamp_ntz``; the difference to the NTZ epoch
    does not depend on the session time zone.
    """
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)


def minmax_kind(dtype: T.DataType, strict_parity: bool = False) -> str:
    """Which arm of the min/max table a Spark type falls in.

    Declared intent by default: 32- and 64-bit ints, 32- and 64-bit floats,
    booleans, dates and timestamps all yield a value. ``strict_parity`` keeps
    only the arms that yield a value in the reference's effective behaviour
    (64-bit int, 64-bit float, boolean).
    """
    if isinstance(dtype, T.LongType) or isinstance(dtype, T.BooleanType):
        return INT_KIND
    if isinstance(dtype, T.DoubleType):
        return FLOAT_KIND
    if strict_parity:
        return NO_KIND
    if isinstance(dtype, (T.IntegerType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return INT_KIND
    if isinstance(dtype, T.FloatType):
        return FLOAT_KIND
    return NO_KIND


def encoded_int(c: Column, dtype: T.DataType) -> Column:
    """The 64-bit integer the Int arm reports for column ``c``."""
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("bigint")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(dtype, T.TimestampNTZType):
        return epoch_micros_ntz(c)
    return c.cast("bigint")


def nan_free(c: Column) -> Column:
    """``c`` with NaN turned into null so min/max skip it (Spark orders NaN last)."""
    return F.when(~F.isnan(c), c)


def is_sample_type(dtype: T.DataType) -> bool:
    """Only plain strings carry ``sample_values`` (P2e)."""
    return isinstance(dtype, T.StringType)


def distinct_supported(dtype: T.DataType, top: bool = True) -> bool:
    """Types whose ``unique`` we can count. ``variant`` cannot be grouped; a
    map is counted through its sorted entries (top level only)."""
    variant = getattr(T, "VariantType", None)
    if variant is not None and isinstance(dtype, variant):
        return False
    if isinstance(dtype, T.MapType):
        return top and distinct_supported(dtype.keyType, False) and distinct_supported(dtype.valueType, False)
    if isinstance(dtype, T.ArrayType):
        return distinct_supported(dtype.elementType, False)
    if isinstance(dtype, T.StructType):
        return all(distinct_supported(f.dataType, False) for f in dtype.fields)
    return True


def distinct_key(c: Column, dtype: T.DataType) -> Column:
    """A groupable stand-in for ``c`` with the same equality: maps compare
    as their entry sets, so they are keyed by their sorted entries."""
    if isinstance(dtype, T.MapType):
        return F.array_sort(F.map_entries(c))
    return c
