"""Avro container files.

Two routes:

* native: Spark's ``avro`` data source, when the ``spark-avro`` package is on
  the classpath (``--packages org.apache.spark:spark-avro_2.13:<version>``). Keeps
  Avro types (maps, dates, bytes) and is the production route.
* JSON route (default when the package is absent, and the reference's own
  semantics): Hadoop's ``AvroAsTextInputFormat`` from the bundled
  ``avro-mapred`` turns each record into JSON text, split by Avro sync markers
  across tasks, and the JVM writes that text to the shared checkpoint folder,
  where Spark's JSON reader infers the frame from all records. As in the
  reference, maps become structs, logical dates stay integers and bytes become
  text. No record passes through Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quarry.session import scratch_dir
from quarry.sources.columnar import missing_as

AVRO_TEXT_FORMAT = "org.apache.avro.mapred.AvroAsTextInputFormat"
AVRO_NOT_FOUND = "Avro file not found: {}"
TEXT = "org.apache.hadoop.io.Text"


def _native(spark: SparkSession, paths, schema):
    """Spark's ``avro`` source, or None when the package is not installed."""
    reader = spark.read.format("avro")
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.load(paths)
    except Exception as e:  # AnalysisException from the session's class loader
        text = str(e)
        if "DATA_SOURCE_NOT_FOUND" in text or "Failed to find data source" in text:
            return None
        raise


def _paths(path) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def read_avro(
    spark: SparkSession,
    path,
    *,
    native: bool | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Avro file(s) or directory. A missing path is an error."""
    paths = _paths(path)
    with missing_as(AVRO_NOT_FOUND, path):
        # lists the files with Spark's own file systems; reads none
        spark.read.format("binaryFile").load(paths)
    if native is not False:
        df = _native(spark, paths, schema)
        if df is not None:
            return df
        if native:
            raise RuntimeError("the avro data source is not on the classpath (spark-avro package)")
    landed = _land_as_text(spark, paths)
    reader = spark.read.option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.json(landed)
    if not df.schema.fields:
        raise ValueError(f"no Avro records in {path}")
    return df


def _land_as_text(spark: SparkSession, paths) -> str:
    """One line of JSON per record, written by the JVM's tasks."""
    sc = spark.sparkContext
    named = [sc._jvm.java.lang.Class.forName(n) for n in (AVRO_TEXT_FORMAT, TEXT, TEXT)]
    out = scratch_dir(spark, "avro-text")
    sc._jsc.hadoopFile(",".join(paths), *named).keys().saveAsTextFile(out)
    return out
