"""Profile export: the pretty JSON document of a profile.

Encoding (fixed by the reference's serializer): an array of objects with the
fields column, dtype, nulls, unique, min, max, sample_values in that order;
min/max as ``{"Int": 5}``, ``{"Float": 1.5}``, ``{"Str": "x"}`` or the bare
string ``"None"``; absent ``unique``/``sample_values`` and NaN/infinite floats
as ``null``; two-space indentation. The row count is not written.
"""

from __future__ import annotations

import json
import math
from decimal import Decimal

from pyspark.sql import DataFrame

from quarry.functions.encoding import MINMAX_FLOAT, MINMAX_INT, MINMAX_NONE, MINMAX_STR


def _format_float(x: float):
    """Shortest round-trip digits; plain notation from 1e-6 up to below 1e21
    (``1.0``, ``0.001``, ``100000000000000000000.0``), exponent notation
    outside it (``1e21``, ``1.5e-7``); NaN and infinities become null."""
    if math.isnan(x) or math.isinf(x):
        return None
    if x == 0:
        return "-0.0" if math.copysign(1.0, x) < 0 else "0.0"
    sign, digits, exp = Decimal(repr(x)).as_tuple()
    text = "".join(str(d) for d in digits).rstrip("0") or "0"
    # value = 0.text * 10**point
    point = len(digits) + exp
    n = len(text)
    if 0 < point <= 21 and n <= point:
        out = text + "0" * (point - n) + ".0"
    elif 0 < point <= 21:
        out = text[:point] + "." + text[point:]
    elif -6 < point <= 0:
        out = "0." + "0" * (-point) + text
    else:
        e = point - 1
        out = (text if n == 1 else text[0] + "." + text[1:]) + "e" + str(e)
    return ("-" if sign else "") + out


class _Raw(str):
    """A pre-rendered JSON number."""


def _minmax_json(value) -> object:
    if value is None:
        return MINMAX_NONE
    if value[MINMAX_INT] is not None:
        return {MINMAX_INT: value[MINMAX_INT]}
    if value[MINMAX_FLOAT] is not None:
        text = _format_float(value[MINMAX_FLOAT])
        return {MINMAX_FLOAT: None if text is None else _Raw(text)}
    if value[MINMAX_STR] is not None:
        return {MINMAX_STR: value[MINMAX_STR]}
    return MINMAX_NONE


def _dump(obj, indent: int = 0) -> str:
    pad = "  " * indent
    inner = "  " * (indent + 1)
    if isinstance(obj, _Raw):
        return str(obj)
    if isinstance(obj, dict):
        if not obj:
            return "{}"
        items = [f"{inner}{json.dumps(k, ensure_ascii=False)}: {_dump(v, indent + 1)}" for k, v in obj.items()]
        return "{\n" + ",\n".join(items) + "\n" + pad + "}"
    if isinstance(obj, list):
        if not obj:
            return "[]"
        items = [inner + _dump(v, indent + 1) for v in obj]
        return "[\n" + ",\n".join(items) + "\n" + pad + "]"
    return json.dumps(obj, ensure_ascii=False)


def profile_json_text(profile: DataFrame) -> str:
    """Pretty JSON array of the column profiles (P3 encoding).

    The profile holds one row per input column, a size fixed by the schema,
    so it is gathered on the driver to render one document.
    """
    rows = sorted(profile.collect(), key=lambda r: r["position"])
    out = []
    for r in rows:
        out.append(
            {
                "column": r["column"],
                "dtype": r["dtype"],
                "nulls": r["nulls"],
                "unique": r["unique"],
                "min": _minmax_json(r["min"]),
                "max": _minmax_json(r["max"]),
                "sample_values": None if r["sample_values"] is None else list(r["sample_values"]),
            }
        )
    return _dump(out)


def export_profile_json(profile: DataFrame, path: str) -> str:
    """Write the pretty JSON document as a single text file under ``path``
    (a directory, like every Spark sink), replacing what was there. Returns the
    rendered text. The row count is not part of the document."""
    text = profile_json_text(profile)
    spark = profile.sparkSession
    (
        spark.createDataFrame([(text,)], "value string")
        .coalesce(1)
        .write.mode("overwrite")
        .option("lineSep", "\n")
        .text(path)
    )
    return text
