"""Relational transforms."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.encoding import qcol
from quarry.functions.order import file_order_key, metadata_fields


def select_columns(df: DataFrame, columns) -> DataFrame:
    """Keep the named columns, in the order given.

    Names are matched exactly (case-sensitive); a missing or repeated name is an
    error. Spark itself resolves case-insensitively and accepts repeats, so the
    check happens here, against the schema, before any job runs. The result is
    lazy: a Parquet/ORC scan below it reads only these columns.
    """
    columns = [columns] if isinstance(columns, str) else list(columns)
    dupes = sorted(n for n, k in Counter(columns).items() if k > 1)
    if dupes:
        raise ValueError(f"duplicate column names in selection: {dupes}")
    present = set(df.columns)
    missing = [c for c in columns if c not in present]
    if missing:
        raise ValueError(f"columns not found: {missing}; available: {df.columns}")
    return df.select(*[qcol(c) for c in columns])


def _first_files(df: DataFrame, limit: int) -> DataFrame:
    """The rows of the first files, in path order, that hold ``limit`` rows. Files
    are counted in runs of doubling length, as ``take`` does with partitions, until
    there are enough; the scan is then bounded by the last one's path."""
    if limit == 0:
        return df
    path = F.col("_metadata.file_path")
    # compared as the scan does, by their bytes
    files = sorted(_listed_as(df.inputFiles()), key=lambda f: f.encode("utf-8"))
    done, run, rows = 0, 1, 0
    while done < len(files):
        upto = min(done + run, len(files))
        some = df.where(path <= files[upto - 1])
        if done:
            some = some.where(path > files[done - 1])
        rows += some.limit(limit - rows).count()
        if rows >= limit:
            return df.where(path <= files[upto - 1])
        done, run = upto, 2 * run
    return df


def _listed_as(files) -> list[str]:
    """Paths of the listing, written as ``_metadata.file_path`` writes them."""
    return [re.sub(r"^([A-Za-z][A-Za-z0-9+.-]*):///", r"\1:/", f) for f in files]


def limit_rows(df: DataFrame, limit: int, order_by=None, *, file_order: bool | None = None) -> DataFrame:
    """The first ``limit`` rows.

    With ``order_by`` the result is deterministic when the key is unique and is
    planned as ``TakeOrderedAndProject``: a per-task bounded heap, never a
    global sort. Otherwise the rows of a file scan, seen through projections and
    filters, are the first in file order (file path, then row), the reference's
    "first rows of the frame": only the first files in path order that hold
    ``limit`` rows are read, and files are counted no further. Any other frame has no
    order, and any ``limit`` rows are returned; ``file_order=True`` orders them by
    partition, ``file_order=False`` takes any rows of a scan too (the fastest).
    """
    if isinstance(limit, bool) or not isinstance(limit, int):
        raise TypeError("limit must be an int")
    if limit < 0:
        raise ValueError("limit must be >= 0")
    if order_by is not None:
        if isinstance(order_by, (str, Column)):
            order_by = [order_by]
        keys = [qcol(c) if isinstance(c, str) else c for c in order_by]
        return df.orderBy(*keys).limit(limit)
    scan = file_order is not False and metadata_fields(df) is not None
    if not scan and not file_order:
        return df.limit(limit)
    key = "__quarry_file_order"
    if scan:
        df = _first_files(df, limit)
    return df.withColumn(key, file_order_key(df)).orderBy(key).limit(limit).drop(key)
