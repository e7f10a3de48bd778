"""Self-describing columnar sources.

Both are plain Spark scans: lazy, vectorized, with filter pushdown and
column pruning decided by Catalyst from whatever is stacked on top.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


# Fixed value: the message for a missing ORC path.
ORC_NOT_FOUND = "ORC file not found: {}"


def _paths(path) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def read_parquet(spark: SparkSession, path, *, merge_schema: bool = False) -> DataFrame:
    """Parquet file(s) or directory. A missing path fails when the read is
    defined (``PATH_NOT_FOUND``)."""
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(*_paths(path))


def read_orc(spark: SparkSession, path, *, merge_schema: bool = False) -> DataFrame:
    """A real ORC read (the reference ships a stub returning an empty
    frame). A missing path keeps the reference's message."""
    with missing_as(ORC_NOT_FOUND, path):
        return spark.read.option("mergeSchema", str(merge_schema).lower()).orc(*_paths(path))


@contextmanager
def missing_as(message: str, path):
    """A path that Spark does not find raises ``FileNotFoundError``; whether
    it exists is the file system's business, not the driver's."""
    try:
        yield
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        raise FileNotFoundError(message.format(path)) from e
