"""Columnar payloads held in a table.

Spark can only scan these formats from files, so the bytes are first landed:
each executor writes the payloads of its own partition, one file per row, into
a directory (``mapInArrow``; the driver sees only a count per partition). File
names are fixed by partition and position, so a retried task overwrites its
own earlier attempt. The
directory must be one the executors' Python can write and the cluster can read
(a shared mount); by default it is a fresh folder under ``spark.checkpoint.dir``.
The landed files are then read by the ordinary readers (S5, S8, S7).

Text payloads need no landing: see ``parse_csv_text``, ``parse_json_text`` and
``parse_workbook_bytes``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.encoding import qcol
from quarry.session import local_dir, scratch_dir, ship_package, task_file_name, write_file_atomic
from quarry.sources.avro import read_avro
from quarry.sources.columnar import read_orc, read_parquet


def land_bytes(df: DataFrame, content: str, directory: str | None = None, suffix: str = ".bin") -> str:
    """Write every non-null ``content`` value of ``df`` as its own file under
    ``directory`` and return the directory."""
    spark = df.sparkSession
    ship_package(spark)
    directory = directory or scratch_dir(spark, "payload")
    target = local_dir(directory)
    os.makedirs(target, exist_ok=True)

    def run(batches):
        import pyarrow as pa

        n = 0
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                if blob is None:
                    continue
                # Same name on every attempt of this task: a retry replaces,
                # never duplicates.
                write_file_atomic(target, task_file_name(n, suffix), blob)
                n += 1
        yield pa.RecordBatch.from_pydict({"files": [n]}, schema=pa.schema([("files", pa.int64())]))

    landed = df.select(qcol(content)).mapInArrow(run, "files bigint").agg(F.sum("files")).first()[0]
    if not landed:
        raise ValueError("no payloads to land")
    return directory


def parse_parquet_bytes(df: DataFrame, content: str, directory: str | None = None) -> DataFrame:
    """Parquet files held as bytes in ``content``."""
    return read_parquet(df.sparkSession, land_bytes(df, content, directory, ".parquet"))


def parse_orc_bytes(df: DataFrame, content: str, directory: str | None = None) -> DataFrame:
    """ORC files held as bytes in ``content``."""
    return read_orc(df.sparkSession, land_bytes(df, content, directory, ".orc"))


def parse_avro_bytes(df: DataFrame, content: str, directory: str | None = None) -> DataFrame:
    """Avro container files held as bytes in ``content``."""
    return read_avro(df.sparkSession, land_bytes(df, content, directory, ".avro"))
