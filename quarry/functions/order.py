"""Row-order keys for Spark frames, which have no inherent order."""

from __future__ import annotations

import logging
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@contextmanager
def _quiet_probe():
    """Silence PySpark's query-context error log while probing a column."""
    logger = logging.getLogger("DataFrameQueryContextLogger")
    was_disabled, logger.disabled = logger.disabled, True
    try:
        yield
    finally:
        logger.disabled = was_disabled


def metadata_fields(df: DataFrame) -> set[str] | None:
    """Fields of ``df._metadata`` when ``df`` is a file scan seen through
    projections and filters, else None."""
    try:
        with _quiet_probe():
            meta = df.select("_metadata").schema.fields[0].dataType
        return set(meta.fieldNames())
    except Exception:
        return None


def file_order_key(df: DataFrame) -> Column:
    """A sort key for "row order" when the caller gives none.

    Parquet scans expose ``_metadata.row_index``: (file, row) is exact file
    order. Other file scans get (file, split start, monotonically increasing id),
    which is file order within a split. Anything else falls back to the
    partition order of ``monotonically_increasing_id``.
    """
    names = metadata_fields(df)
    if names is None:  # not a file scan
        return F.monotonically_increasing_id()
    if "row_index" in names:
        return F.struct(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    return F.struct(
        F.col("_metadata.file_path"),
        F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id(),
    )
