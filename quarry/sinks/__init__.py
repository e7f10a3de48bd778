"""Sinks.

Every sink overwrites its target and writes a directory of part files through
Spark's commit protocol, so a lost executor's task is retried and only
committed files become visible. Nothing is gathered on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter


def _writer(df: DataFrame, partition_by=None, num_files: int | None = None) -> DataFrameWriter:
    """Common writer setup.

    With ``partition_by`` the rows are laid out by Spark's ``REBALANCE`` hint
    on those columns: AQE hash-partitions them, splits a partition value that
    holds a large share of the rows over several tasks and merges small ones,
    so one hot value does not become one giant task and files come out near
    the advisory size. ``num_files`` sets the partition count instead.
    """
    if not df.columns:
        raise ValueError("cannot write a frame with no columns")
    if num_files is not None and num_files < 1:
        raise ValueError("num_files must be >= 1")
    if partition_by:
        args = ([num_files] if num_files is not None else []) + list(partition_by)
        df = df.hint("rebalance", *args)
    elif num_files is not None:
        # repartition, not coalesce: coalesce would also shrink the upstream
        # stage to num_files tasks.
        df = df.repartition(num_files)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w


def write_csv(df: DataFrame, path: str, *, header: bool = True, delimiter: str = ",",
              partition_by=None, num_files: int | None = None) -> None:
    """K1: CSV with a header, comma, quoting when needed; an embedded quote is
    doubled, null is an empty field, an empty string is ``""``, and leading or
    trailing spaces are kept."""
    (
        _writer(df, partition_by, num_files)
        .option("header", str(header).lower())
        .option("sep", delimiter)
        .option("quote", '"')
        .option("escape", '"')
        # Spark's CSV writer trims values by default; keep them as they are.
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(path)
    )


def write_parquet(df: DataFrame, path: str, *, partition_by=None, num_files: int | None = None,
                  compression: str = "snappy") -> None:
    """K2 / K4: Parquet."""
    _writer(df, partition_by, num_files).option("compression", compression).parquet(path)


def write_json(df: DataFrame, path: str, *, partition_by=None, num_files: int | None = None,
               keep_nulls: bool = True) -> None:
    """K3: newline-delimited JSON (readable again by ``read_json``). Null
    fields are written as ``null`` rather than dropped."""
    (
        _writer(df, partition_by, num_files)
        .option("ignoreNullFields", str(not keep_nulls).lower())
        .json(path)
    )


def write_orc(df: DataFrame, path: str, *, partition_by=None, num_files: int | None = None) -> None:
    """ORC, the format S8 reads."""
    _writer(df, partition_by, num_files).orc(path)
