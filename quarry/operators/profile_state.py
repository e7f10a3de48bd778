"""Profiles as mergeable state.

A state table has one row per file and column: counts, extremes, a HyperLogLog
sketch of the distinct values and, for numbers, a KLL sketch of their quantiles.
All of it merges, so the profile of any set of files is an aggregate over their
rows, and new files cost one scan of themselves:

    update_profile_state(spark, state, "s3a://bucket/table/")   # scans what is new
    profile_from_state(spark.read.parquet(state))               # reads the state only

A file is known by its path, size and modification time. One that has changed is
scanned again; rows of files that have gone are left out of the current state. The
scan is one aggregate grouped by file and combined in the tasks: what is shuffled is
one row of sketches per task and file.

``unique`` is an estimate with a relative standard error of about ``1.04 /
sqrt(2 ** lg_k)`` (1.6 % by default); all other columns but the quantiles are exact.
Merging is always by union of per-file sketches, so the same files give the same
estimate however they came in.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.encoding import (
    FLOAT_KIND,
    INT_KIND,
    MINMAX_FLOAT,
    MINMAX_INT,
    MINMAX_STR,
    distinct_supported,
    encoded_int,
    minmax_kind,
    nan_free,
    qcol,
)
from quarry.functions.order import metadata_fields
from quarry.operators.profile import _check_names, _group_key, _slot

LG_K = 12
KLL_K = 200
QUANTILES = (0.25, 0.5, 0.75)
_FILE = ("file", "size", "modified")
_MEASURES = (
    "rows bigint, nulls bigint, min_int bigint, max_int bigint, min_float double, max_float double, nans bigint, "
    "distinct binary, quantiles binary"
)
STATE_SCHEMA = f"file string, size bigint, modified timestamp, position int, column string, dtype string, {_MEASURES}"


def _measures(f: T.StructField, lg_k: int) -> list:
    """A column's aggregates, in the order of ``_MEASURES``."""
    c, kind = qcol(f.name), minmax_kind(f.dataType)
    none_int, none_float = F.lit(None).cast("bigint"), F.lit(None).cast("double")
    ints = floats = [None, None]
    nans, quantiles = F.lit(0).cast("bigint"), F.lit(None).cast("binary")
    if kind == INT_KIND:
        value = encoded_int(c, f.dataType)
        ints = [F.min(value), F.max(value)]
        number = value.cast("double")
    elif kind == FLOAT_KIND:
        number = nan_free(c.cast("double"))
        floats = [F.min(number), F.max(number)]
        nans = F.count_if(F.isnan(c))
    if kind in (INT_KIND, FLOAT_KIND):
        quantiles = F.kll_sketch_agg_double(number, KLL_K)
    distinct = F.lit(None).cast("binary")
    if distinct_supported(f.dataType):
        key = _group_key(c, f.dataType, _slot(f.dataType))
        # one 64-bit hash per value, whatever its type; nulls are counted apart
        distinct = F.hll_sketch_agg(F.when(c.isNotNull(), F.xxhash64(key)), lg_k)
    return [
        F.count(F.lit(1)), F.count_if(c.isNull()),
        *(x if x is not None else none_int for x in ints), *(x if x is not None else none_float for x in floats),
        nans, distinct, quantiles,
    ]


def profile_state(df: DataFrame, *, lg_k: int = LG_K) -> DataFrame:
    """The state of a file scan: one row per file and column, from one scan. A
    frame that is no file scan gives the rows of one nameless file."""
    _check_names(df)
    fields = df.schema.fields
    names = [m.split()[0] for m in _MEASURES.split(", ")]
    if metadata_fields(df) is not None:
        file = [F.col("_metadata.file_path"), F.col("_metadata.file_size"), F.col("_metadata.file_modification_time")]
    else:
        file = [F.lit(""), F.lit(0), F.lit(None)]
    kinds = ("string", "bigint", "timestamp")
    keys = [c.cast(k).alias(n) for c, k, n in zip(file, kinds, _FILE, strict=True)]
    rows = df.select(*keys, *[qcol(f.name) for f in fields])
    aggs, entries = [], []
    for i, f in enumerate(fields):
        for name, agg in zip(names, _measures(f, lg_k), strict=True):
            aggs.append(agg.alias(f"q{i}_{name}"))
        entries.append(F.struct(
            F.lit(i).cast("int").alias("position"), F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("dtype"), *[F.col(f"q{i}_{n}").alias(n) for n in names],
        ))
    if not entries:
        return df.sparkSession.createDataFrame([], STATE_SCHEMA)
    found = rows.groupBy(*_FILE).agg(*aggs)
    return found.select(*_FILE, F.inline(F.array(*entries)))


def merge_states(state: DataFrame) -> DataFrame:
    """One row per column: the state of all files together."""
    shape = state.groupBy("position").agg(
        # files must agree in their columns
        F.min(F.struct("column", "dtype")).alias("first"), F.max(F.struct("column", "dtype")).alias("last"),
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"),
        F.min("min_int").alias("min_int"), F.max("max_int").alias("max_int"),
        F.min("min_float").alias("min_float"), F.max("max_float").alias("max_float"),
        F.sum("nans").alias("nans"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
    )
    differ = F.raise_error(F.concat(
        F.lit("files differ in a column: "), F.to_json("first"), F.lit(" and "), F.to_json("last")
    )).cast("string")
    same = F.when(F.col("first") == F.col("last"), F.col("first.column")).otherwise(differ)
    return shape.select(
        "position", same.alias("column"), F.col("first.dtype").alias("dtype"),
        *[m.split()[0] for m in _MEASURES.split(", ")],
    )


def profile_from_state(state: DataFrame) -> DataFrame:
    """The profile of all files in a state table: one row per column with
    ``nulls``, ``unique`` (an estimate, null counting as one value), ``min``,
    ``max``, ``quantiles`` (25, 50 and 75 percent; dates and times in their integer
    encoding) and ``row_count``. Reads the state only."""
    merged = merge_states(state)
    nan = F.when(F.col("nans") > 0, F.lit(float("nan")))

    def extreme(side):
        return F.struct(
            F.col(f"{side}_int").alias(MINMAX_INT),
            F.coalesce(f"{side}_float", nan).alias(MINMAX_FLOAT),
            F.lit(None).cast("string").alias(MINMAX_STR),
        ).alias(side)

    unique = F.hll_sketch_estimate("distinct") + (F.col("nulls") > 0).cast("bigint")
    # merging no sketch at all gives an empty one, which has no quantiles
    quantiles = F.when(
        F.kll_sketch_get_n_double("quantiles") > 0,
        F.kll_sketch_get_quantile_double("quantiles", F.array(*map(F.lit, QUANTILES))),
    )
    return merged.select(
        "position", "column", "dtype", "nulls", F.when(F.col("distinct").isNotNull(), unique).alias("unique"),
        extreme("min"), extreme("max"), quantiles.alias("quantiles"), F.col("rows").alias("row_count"),
    ).coalesce(1).sortWithinPartitions("position")


def update_profile_state(
    spark: SparkSession, state_path: str, path: str | list[str], *, format: str = "parquet", lg_k: int = LG_K, **options
) -> int:
    """Bring the state table at ``state_path`` up to the files at ``path`` and
    return how many files were scanned: those that the state does not know with
    the same size and time. Known files are listed, not read."""
    paths = [path] if isinstance(path, str) else list(path)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    listed = listed.where(~F.element_at(F.split("path", "/"), -1).rlike(r"^[._]")).select(
        F.col("_metadata.file_path").alias("file"), F.col("length").alias("size"), F.col("modificationTime").alias("modified")
    )
    known = _state_rows(spark, state_path)
    new = listed if known is None else listed.join(known.select(*_FILE).distinct(), list(_FILE), "left_anti")
    files = [r["file"] for r in new.select("file").collect()]
    if files:
        df = spark.read.format(format).options(**options).load([unquote(f) for f in files])
        profile_state(df, lg_k=lg_k).write.mode("append").parquet(state_path)
    elif known is None:
        spark.createDataFrame([], STATE_SCHEMA).write.parquet(state_path)
    return len(files)


def current_state(spark: SparkSession, state_path: str, path: str | list[str]) -> DataFrame:
    """The rows of a state table that describe the files now at ``path``."""
    paths = [path] if isinstance(path, str) else list(path)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("length").alias("size"), F.col("modificationTime").alias("modified")
    )
    rows = _state_rows(spark, state_path)
    return rows.join(listed, list(_FILE), "left_semi").dropDuplicates([*_FILE, "position"])


def _state_rows(spark: SparkSession, state_path: str) -> DataFrame | None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(state_path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return spark.read.schema(STATE_SCHEMA).parquet(state_path) if fs.exists(target) else None
