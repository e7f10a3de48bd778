"""Column profiles.

A profile is a DataFrame with one row per input column, ordered by
``position``. All work runs in parallel over rows (not over columns):

* approximate mode: one wide single-row aggregate: row count, null counts,
  encoded min/max and HyperLogLog distinct counts. Partial aggregation makes
  each task ship one row; nothing grows with the data.
* exact mode: per-value counts. The columns of one type family (64-bit ints and the
  Int encodings, doubles, texts and decimals, bytes) share one scan: each row is
  exploded into one ``(position, value)`` row per column and counted by both, so
  scans, shuffles and plan size stay at most four whatever the column count. The
  aggregate is combined map-side, so a hot value costs one row per task, and
  partitioned on the value, so a high-cardinality column spreads over all reducers.
  The per-value counts of all families share one shape and one final
  ``groupBy(position)``; nulls, min/max and the row count fall out of the same
  groups. Rows stay narrow, unlike the N-wide rows of Catalyst's ``Expand`` for
  several ``count(DISTINCT ..)``; long values are counted under their digest.
* samples: per string column ``orderBy(key).limit(3)``, which plans as
  ``TakeOrderedAndProject``: every task keeps a 3-row heap, the final merge sees
  3 rows per task. Beyond ``SAMPLED_APART`` such columns one scan with ``row_number() <= 3`` per
  column instead, cut by a partial ``WindowGroupLimit`` before the shuffle.
* inputs that are costly to re-read (derived frames, row-format files) are
  landed once as Parquet under ``spark.checkpoint.dir`` first.

The pieces are joined on ``position``. Their size is the number of columns,
known on the driver before anything runs, so the broadcast is bounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.encoding import (
    FLOAT_KIND,
    INT_KIND,
    MINMAX_FLOAT,
    MINMAX_INT,
    MINMAX_STR,
    MINMAX_TYPE,
    distinct_key,
    distinct_supported,
    encoded_int,
    is_sample_type,
    minmax_kind,
    nan_free,
    qcol,
)
from quarry.functions.order import file_order_key, metadata_fields
from quarry.session import materialize_frame

SAMPLE_COUNT = 3

BASIC_SCHEMA = T.StructType(
    [
        T.StructField("position", T.IntegerType(), False),
        T.StructField("column", T.StringType(), False),
        T.StructField("dtype", T.StringType(), False),
        T.StructField("nulls", T.LongType(), False),
        T.StructField("row_count", T.LongType(), False),
    ]
)

DETAILED_SCHEMA = T.StructType(
    [
        T.StructField("position", T.IntegerType(), False),
        T.StructField("column", T.StringType(), False),
        T.StructField("dtype", T.StringType(), False),
        T.StructField("nulls", T.LongType(), False),
        T.StructField("unique", T.LongType(), True),
        T.StructField("min", MINMAX_TYPE, False),
        T.StructField("max", MINMAX_TYPE, False),
        T.StructField("sample_values", T.ArrayType(T.StringType(), False), True),
        T.StructField("row_count", T.LongType(), False),
    ]
)

DISTINCT_MODES = ("exact", "approx", "exact_single_pass")
EXACT_PLANS = ("auto", "narrow", "per_column")
# Samples of more string columns than this come from one scan; it costs a sort,
# which the scan per column does not need. The result is the same.
SAMPLED_APART = 32


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def _check_names(df: DataFrame) -> None:
    seen, dupes = set(), set()
    for name in df.columns:
        (dupes if name in seen else seen).add(name)
    if dupes:
        raise ValueError(f"cannot profile a frame with duplicate column names: {sorted(dupes)}")


# --------------------------------------------------------------------------- P1


def profile_basic(df: DataFrame) -> DataFrame:
    """Row count, and per column its name, dtype label and null count.

    One aggregate pass; the single result row is turned into one row per
    column with ``inline``.
    """
    _check_names(df)
    fields = df.schema.fields
    if not fields:
        return _empty(df.sparkSession, BASIC_SCHEMA)
    aggs = [F.count(F.lit(1)).alias("q_rows")]
    aggs += [F.count_if(qcol(f.name).isNull()).alias(f"q_null_{i}") for i, f in enumerate(fields)]
    rows = [
        F.struct(
            F.lit(i).cast("int").alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("dtype"),
            F.col(f"q_null_{i}").alias("nulls"),
        )
        for i, f in enumerate(fields)
    ]
    out = (
        df.agg(*aggs)
        .select(F.col("q_rows").alias("row_count"), F.inline(F.array(*rows)))
        .select("position", "column", "dtype", "nulls", "row_count")
    )
    return out


# --------------------------------------------------------------------------- P2


def _minmax_struct(value_int: Column | None, value_float: Column | None) -> Column:
    return F.struct(
        (value_int if value_int is not None else F.lit(None).cast("bigint")).alias(MINMAX_INT),
        (value_float if value_float is not None else F.lit(None).cast("double")).alias(MINMAX_FLOAT),
        F.lit(None).cast("string").alias(MINMAX_STR),
    )


COLUMNAR_SUFFIXES = (".orc",)
ORDER_COL = "__quarry_order"


def should_materialize(df: DataFrame, passes: int) -> bool:
    """Whether to land ``df`` as Parquet before a profile that scans it
    ``passes`` times. Parquet and ORC scans re-read one column per pass, which
    is cheap; a row-format file (CSV, JSON, text, Avro) would be parsed whole
    on every pass, and a derived frame (join, aggregate, ...) recomputed."""
    if passes <= 1:
        return False
    names = metadata_fields(df)
    if names is None:
        return not df.isLocal()
    if "row_index" in names:  # Parquet
        return False
    files = df.inputFiles()
    return not (files and all(f.lower().endswith(COLUMNAR_SUFFIXES) for f in files))


def _order_key(df: DataFrame, order_by) -> Column:
    if not order_by:
        return file_order_key(df)
    if isinstance(order_by, (str, Column)):
        order_by = [order_by]
    parts = [qcol(c) if isinstance(c, str) else c for c in order_by]
    return F.struct(*parts)


def _samples(df: DataFrame, fields, key: Column) -> DataFrame | None:
    """First three non-null values per string column, in ``key`` order (P2e).

    Up to ``SAMPLED_APART`` string columns: one ``orderBy(key).limit(3)``
    per column, planned as ``TakeOrderedAndProject`` (a 3-row heap per task).
    Beyond that, one scan: rows are exploded to ``(position, key, value)`` and
    ``row_number() over (partition by position order by key) <= 3`` keeps the
    first three; Spark inserts a partial ``WindowGroupLimit`` before the
    shuffle, so each task ships at most three rows per column.
    """
    if not fields:
        return None
    if len(fields) > SAMPLED_APART:
        entries = [F.struct(F.lit(i).cast("int").alias("position"), qcol(f.name).alias("v")) for i, f in fields]
        exploded = (
            df.select(key.alias("k"), F.explode(F.array(*entries)).alias("e"))
            .select("e.position", "k", "e.v")
            .where(F.col("v").isNotNull())
        )
        rank = F.row_number().over(Window.partitionBy("position").orderBy("k"))
        union = exploded.withColumn("rn", rank).where(F.col("rn") <= SAMPLE_COUNT).drop("rn")
    else:
        parts = []
        for i, f in fields:
            c = qcol(f.name)
            part = (
                df.select(key.alias("k"), c.alias("v"))
                .where(F.col("v").isNotNull())
                .orderBy("k")
                .limit(SAMPLE_COUNT)
                .select(F.lit(i).cast("int").alias("position"), "k", "v")
            )
            parts.append(part)
        union = parts[0]
        for p in parts[1:]:
            union = union.unionByName(p)
    # At most SAMPLE_COUNT rows per position reach this aggregate.
    return union.groupBy("position").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("k", "v"))), lambda x: x["v"]
        ).alias("sample_values")
    )


def _meta_columns(i: int, f: T.StructField) -> list[Column]:
    return [
        F.lit(i).cast("int").alias("position"),
        F.lit(f.name).alias("column"),
        F.lit(f.dataType.simpleString()).alias("dtype"),
        F.lit(is_sample_type(f.dataType)).alias("has_samples"),
    ]


def _finish(kind: str, prefix: str = "") -> tuple[Column, Column]:
    """min/max structs from aggregated ``min_v``/``max_v``/``nans`` columns."""
    mn, mx, nans = F.col(prefix + "min_v"), F.col(prefix + "max_v"), F.col(prefix + "nans")
    if kind == INT_KIND:
        return _minmax_struct(mn, None), _minmax_struct(mx, None)
    if kind == FLOAT_KIND:
        nan = F.when(nans > 0, F.lit(float("nan")))
        return _minmax_struct(None, F.coalesce(mn, nan)), _minmax_struct(None, F.coalesce(mx, nan))
    return _minmax_struct(None, None), _minmax_struct(None, None)


def _minmax_aggs(value: Column, dtype: T.DataType, kind: str) -> list[Column]:
    """min/max (and NaN count for floats) of ``value`` with the kind's encoding."""
    if kind == INT_KIND:
        enc = encoded_int(value, dtype)
        return [F.min(enc).alias("min_v"), F.max(enc).alias("max_v"), F.lit(0).cast("bigint").alias("nans")]
    if kind == FLOAT_KIND:
        d = value.cast("double")
        return [
            F.min(nan_free(d)).alias("min_v"),
            F.max(nan_free(d)).alias("max_v"),
            F.count_if(F.isnan(d)).alias("nans"),
        ]
    return [F.lit(None).alias("min_v"), F.lit(None).alias("max_v"), F.lit(0).cast("bigint").alias("nans")]


# Typed slots: every scalar value travels in the slot of its family, so the
# per-value counts of columns of different types share one shape.
SLOT_TYPES = {"l": "bigint", "d": "double", "s": "string", "b": "binary"}


def _slot(dtype: T.DataType) -> str | None:
    """Which slot carries a column's values without changing their equality."""
    if isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.BooleanType,
                          T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "l"  # the Int encoding of P2d is one-to-one, so distinctness is kept
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return "d"
    if isinstance(dtype, T.StringType) and dtype.simpleString() == "string":
        return "s"  # default collation only: a collated string keeps its own equality
    if isinstance(dtype, T.DecimalType):
        return "s"  # fixed scale per column, so the text form is one-to-one
    if isinstance(dtype, T.BinaryType):
        return "b"
    return None


def _slot_value(c: Column, dtype: T.DataType, slot: str) -> Column:
    if slot == "l":
        return encoded_int(c, dtype)
    if slot == "d":
        return c.cast("double")
    if slot == "s":
        return c.cast("string")
    return c


# A value longer than this is counted under its digest.
DIGEST_BYTES = 32


def _short_text(c: Column) -> Column:
    """A text itself when short, else its digest, which is longer than any short
    one: the two never meet."""
    return F.when(F.octet_length(c) <= DIGEST_BYTES, c).otherwise(F.sha2(c.cast("binary"), 256))


def _short_bytes(c: Column) -> Column:
    """The same for bytes, whose digest has ``DIGEST_BYTES``."""
    return F.when(F.octet_length(c) < DIGEST_BYTES, c).otherwise(F.unhex(F.sha2(c, 256)))


def _group_key(c: Column, dtype: T.DataType, slot: str | None) -> Column:
    """What the distinct count groups by. Texts, bytes and arrays of plain
    values are shuffled as digests, never whole."""
    if isinstance(dtype, T.StringType) and slot:
        return _short_text(c)
    if slot == "b":
        return _short_bytes(c)
    if slot:
        return _slot_value(c, dtype, slot)
    if isinstance(dtype, T.ArrayType):
        element = dtype.elementType
        if isinstance(element, (T.FloatType, T.DoubleType)):
            # one text for both zeros, as grouping has it
            plain = F.transform(c, lambda x: x + F.lit(0.0).cast(element))
        elif isinstance(element, T.StringType) and element.simpleString() == "string" or _slot(element) == "l":
            plain = c
        else:
            return distinct_key(c, dtype)
        text = F.to_json(F.struct(plain.alias("v")), {"ignoreNullFields": "false"})
        return F.when(c.isNotNull(), _short_text(text))
    return distinct_key(c, dtype)


def _counts_shape(pos: Column, v: Column, slot: str | None) -> list[Column]:
    """Per-value count rows in the common shape ``(pos, l, d, isnull, n)``:
    ``l``/``d`` keep the value only where min/max can use it."""
    return [
        pos.alias("pos"),
        (v if slot == "l" else F.lit(None)).cast("bigint").alias("l"),
        (v if slot == "d" else F.lit(None)).cast("double").alias("d"),
        v.isNull().alias("isnull"),
        F.col("n"),
    ]


def _column_counts(df: DataFrame, i: int, f: T.StructField) -> DataFrame:
    """``groupBy(value).count()`` of one column: one scan of that column,
    combined map-side, shuffled on the value or its digest."""
    slot = _slot(f.dataType)
    c = qcol(f.name)
    key = _group_key(c, f.dataType, slot)
    per_value = df.groupBy(key.alias("v")).agg(F.count(F.lit(1)).alias("n"))
    return per_value.select(*_counts_shape(F.lit(i).cast("int"), F.col("v"), slot))


def _family_counts(df: DataFrame, fields, slot: str) -> DataFrame:
    """Per-value counts of all columns of one type family from one scan: each
    row is exploded into one ``(position, value)`` row per column, then
    ``groupBy(position, value).count()``. Rows stay two fields wide however
    many columns the family has."""
    entries = [
        F.struct(F.lit(i).cast("int").alias("pos"), _group_key(qcol(f.name), f.dataType, slot).alias("v"))
        for i, f in fields
    ]
    exploded = df.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    per_value = exploded.groupBy("pos", "v").agg(F.count(F.lit(1)).alias("n"))
    return per_value.select(*_counts_shape(F.col("pos"), F.col("v"), slot))


def _finish_counts(counts: DataFrame, fields, strict_parity: bool) -> DataFrame:
    """Statistics from per-value counts of every column at once: one
    ``groupBy(position)``, partially aggregated, so each task ships one row
    per column and the whole profile needs a single extra shuffle. ``unique``
    is the number of groups (null is one), ``nulls`` the null group's count,
    the row count their sum, min/max the extremes of the distinct values."""
    spark = counts.sparkSession
    d = F.col("d")
    agg = counts.groupBy("pos").agg(
        F.count(F.lit(1)).alias("unique"),
        F.sum("n").alias("row_count"),
        F.sum(F.when(F.col("isnull"), F.col("n"))).alias("nulls"),
        F.min("l").alias("min_l"),
        F.max("l").alias("max_l"),
        F.min(nan_free(d)).alias("min_d"),
        F.max(nan_free(d)).alias("max_d"),
        F.count_if(F.isnan(d)).alias("nans"),
    )
    # One row per column, known on the driver: the frame even an empty input
    # reports on, and the kind that says which slot holds min/max.
    meta = spark.createDataFrame(
        [(i, f.name, f.dataType.simpleString(), is_sample_type(f.dataType), minmax_kind(f.dataType, strict_parity))
         for i, f in fields],
        "pos int, column string, dtype string, has_samples boolean, kind string",
    )
    joined = meta.join(F.broadcast(agg), "pos", "left")
    kind = F.col("kind")
    nan = F.when(F.col("nans") > 0, F.lit(float("nan")))
    none = _minmax_struct(None, None)
    lo = (F.when(kind == INT_KIND, _minmax_struct(F.col("min_l"), None))
          .when(kind == FLOAT_KIND, _minmax_struct(None, F.coalesce(F.col("min_d"), nan))).otherwise(none))
    hi = (F.when(kind == INT_KIND, _minmax_struct(F.col("max_l"), None))
          .when(kind == FLOAT_KIND, _minmax_struct(None, F.coalesce(F.col("max_d"), nan))).otherwise(none))
    return joined.select(
        F.col("pos").alias("position"),
        "column",
        "dtype",
        "has_samples",
        F.coalesce(F.col("row_count"), F.lit(0)).cast("bigint").alias("row_count"),
        F.coalesce(F.col("nulls"), F.lit(0)).cast("bigint").alias("nulls"),
        F.coalesce(F.col("unique"), F.lit(0)).cast("bigint").alias("unique"),
        lo.alias("min"),
        hi.alias("max"),
    )


def _ungroupable_stats(df: DataFrame, fields) -> DataFrame:
    """Columns Spark cannot group by (``variant``): nulls from one plain
    aggregate, ``unique`` and min/max left empty."""
    aggs = [F.count(F.lit(1)).alias("q_rows")]
    rows = []
    for i, f in fields:
        aggs.append(F.count_if(qcol(f.name).isNull()).alias(f"q_null_{i}"))
        rows.append(
            F.struct(
                *_meta_columns(i, f),
                F.col(f"q_null_{i}").alias("nulls"),
                F.lit(None).cast("bigint").alias("unique"),
                _minmax_struct(None, None).alias("min"),
                _minmax_struct(None, None).alias("max"),
            )
        )
    return (
        df.agg(*aggs)
        .select(F.col("q_rows").alias("row_count"), F.inline(F.array(*rows)))
        .select("position", "column", "dtype", "has_samples", "row_count", "nulls", "unique", "min", "max")
    )


def _exact_stats(df: DataFrame, fields, strict_parity: bool, plan: str) -> DataFrame:
    """Exact statistics from per-value counts: one keyed aggregate per column
    (``plan="per_column"``) or one per type family (``"narrow"``; nested types
    still per column), then a single shared ``groupBy(position)``."""
    groupable = [(i, f) for i, f in fields if distinct_supported(f.dataType)]
    ungroupable = [(i, f) for i, f in fields if not distinct_supported(f.dataType)]
    if plan == "per_column":
        counts = [_column_counts(df, i, f) for i, f in groupable]
    else:
        counts = []
        for slot in SLOT_TYPES:
            family = [(i, f) for i, f in groupable if _slot(f.dataType) == slot]
            if family:
                counts.append(_family_counts(df, family, slot))
        counts += [_column_counts(df, i, f) for i, f in groupable if _slot(f.dataType) is None]
    parts = []
    if counts:
        union = counts[0]
        for c in counts[1:]:
            union = union.unionByName(c)
        parts.append(_finish_counts(union, groupable, strict_parity))
    if ungroupable:
        parts.append(_ungroupable_stats(df, ungroupable))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _wide_stats(df: DataFrame, fields, strict_parity: bool, distinct: str, rsd: float = 0.05) -> DataFrame:
    """Approximate / single-pass mode: every statistic in one wide aggregate."""
    aggs = [F.count(F.lit(1)).alias("q_rows")]
    stacked = []
    for i, f in fields:
        c = qcol(f.name)
        aggs.append(F.count_if(c.isNull()).alias(f"q_null_{i}"))
        kind = minmax_kind(f.dataType, strict_parity)
        aggs += [a.alias(f"q_{i}_" + name) for a, name in zip(_minmax_aggs(c, f.dataType, kind),
                                                               ("min_v", "max_v", "nans"))]
        lo, hi = _finish(kind, prefix=f"q_{i}_")
        if not distinct_supported(f.dataType):
            unique = F.lit(None).cast("bigint")
        else:
            key = distinct_key(c, f.dataType)
            count = F.approx_count_distinct(key, rsd) if distinct == "approx" else F.count_distinct(key)
            aggs += [
                count.alias(f"q_ad_{i}"),
                F.max(c.isNull().cast("int")).alias(f"q_hn_{i}"),
            ]
            unique = F.col(f"q_ad_{i}") + F.coalesce(F.col(f"q_hn_{i}"), F.lit(0))
        stacked.append(
            F.struct(
                *_meta_columns(i, f),
                F.col(f"q_null_{i}").alias("nulls"),
                unique.cast("bigint").alias("unique"),
                lo.alias("min"),
                hi.alias("max"),
            )
        )
    return df.agg(*aggs).select(F.col("q_rows").alias("row_count"), F.inline(F.array(*stacked)))


def profile_detailed(
    df: DataFrame,
    *,
    distinct: str = "exact",
    order_by=None,
    strict_parity: bool = False,
    samples: bool = True,
    materialize: bool | None = None,
    exact_plan: str = "auto",
    approx_rsd: float = 0.05,
) -> DataFrame:
    """Detailed profile, one row per column.

    ``distinct``: ``"exact"`` (per-value counts, see ``exact_plan``),
    ``"approx"`` (HyperLogLog++ in one wide single-row aggregate with relative
    standard deviation ``approx_rsd``; no value shuffle) or
    ``"exact_single_pass"`` (Catalyst ``Expand`` of several distinct
    aggregates; one shuffle but rows as wide as the column count).

    ``exact_plan``: ``"per_column"`` (one scan and shuffle per column),
    or ``"narrow"`` (one scan and shuffle per type family, whatever the column
    count; ``"auto"`` is the same).

    ``order_by``: columns that define row order for ``sample_values``;
    defaults to file order (see ``file_order_key``).

    ``strict_parity``: report min/max only for the types whose accessor
    succeeds in the reference (64-bit ints and floats, booleans).

    ``materialize``: land ``df`` once under the shared ``spark.checkpoint.dir``
    (Parquet, or ``checkpoint()`` for types Parquet cannot hold) before
    profiling, so a derived input is not recomputed, and a row-format file not
    re-parsed, by each of the profile's scans. ``None`` decides with
    ``should_materialize``.
    """
    if distinct not in DISTINCT_MODES:
        raise ValueError(f"distinct must be one of {DISTINCT_MODES}, got {distinct!r}")
    _check_names(df)
    spark = df.sparkSession
    fields = list(enumerate(df.schema.fields))
    if not fields:
        return _empty(spark, DETAILED_SCHEMA)
    if exact_plan not in EXACT_PLANS:
        raise ValueError(f"exact_plan must be one of {EXACT_PLANS}, got {exact_plan!r}")
    if exact_plan == "auto":
        exact_plan = "narrow"
    if distinct == "exact" and exact_plan == "per_column":
        passes = sum(1 for _, f in fields if distinct_supported(f.dataType))
        passes += any(not distinct_supported(f.dataType) for _, f in fields)
    elif distinct == "exact":
        passes = len({_slot(f.dataType) for _, f in fields} - {None})
        passes += sum(1 for _, f in fields if _slot(f.dataType) is None and distinct_supported(f.dataType))
        passes += any(not distinct_supported(f.dataType) for _, f in fields)
    else:
        passes = 1
    if samples:
        passes += sum(1 for _, f in fields if is_sample_type(f.dataType))
    if materialize is None:
        materialize = should_materialize(df, passes)
    sample_fields = [(i, f) for i, f in fields if is_sample_type(f.dataType)] if samples else []
    key = _order_key(df, order_by) if sample_fields else None
    if materialize:
        # The row-order key is computed on the original scan and stored with
        # the data, so samples keep the input's order.
        extra = [key.alias(ORDER_COL)] if key is not None else []
        df = materialize_frame(df.select(*[qcol(f.name) for _, f in fields], *extra), "profile-input")
        if key is not None:
            key = F.col(ORDER_COL)

    if distinct == "exact":
        stats = _exact_stats(df, fields, strict_parity, exact_plan)
    else:
        stats = _wide_stats(df, fields, strict_parity, distinct, approx_rsd)

    sampled = _samples(df, sample_fields, key) if sample_fields else None
    if sampled is not None:
        stats = stats.join(F.broadcast(sampled), "position", "left")
    else:
        stats = stats.withColumn("sample_values", F.lit(None).cast("array<string>"))
    stats = stats.withColumn(
        "sample_values",
        F.when(
            F.col("has_samples"),
            F.coalesce(F.col("sample_values"), F.array().cast("array<string>")),
        ),
    )
    # One row per column: a single partition sorted in place orders it without
    # a range shuffle (and its sampling job).
    return stats.select(*[f.name for f in DETAILED_SCHEMA.fields]).coalesce(1).sortWithinPartitions("position")


def profile_with_count(df: DataFrame, *, detailed: bool = True, **options) -> tuple[int, DataFrame]:
    """The reference's return shape: ``(row_count, profile)``. Runs the
    profile (one row per column, collected) to read the count; a frame with
    no columns still reports its row count."""
    profile = profile_detailed(df, **options) if detailed else profile_basic(df)
    if not df.columns:
        return df.count(), profile
    rows = profile.collect()
    spark = df.sparkSession
    return rows[0]["row_count"], spark.createDataFrame(rows, profile.schema)


def flatten_profile(profile: DataFrame) -> DataFrame:
    """Flat columns for comparison with SQL engines: ``min_int``, ``max_int``,
    ``min_float``, ``max_float`` instead of the tagged structs."""
    return profile.select(
        "position",
        "column",
        "dtype",
        "nulls",
        "unique",
        F.col("min")[MINMAX_INT].alias("min_int"),
        F.col("max")[MINMAX_INT].alias("max_int"),
        F.col("min")[MINMAX_FLOAT].alias("min_float"),
        F.col("max")[MINMAX_FLOAT].alias("max_float"),
        "row_count",
    )
