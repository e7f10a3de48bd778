"""Exact deduplication by sorting contents.

Sampled splitters range-partition the normalised bytes: ``repartitionByRange``
samples them, comparing the beginning of a text and, among texts that begin
alike, a hash of its content. So equal texts meet in one partition, an external
sort there places them next to each other, and a window over that order compares
each row's whole text with its neighbour's. That decides every group but those of
hot texts.

A text is hot if its copies are more than a partition's share of all rows (and
``HOT_ROWS``); they are counted first, and there are at most as many as partitions.
Only their rows get a spread, from the identifier, into the sort key, so that a
hot text spans several ranges. Its runs, one per range, are combined by comparing
the whole texts of their first rows.

Built-in functions only. Whole texts are shuffled once.

Defined results: null text counts as empty; texts are equal when identical
after lower-casing A-Z, however long; rows without an identifier lose to rows with
one, and among rows that agree in identifier and text one stays; an empty table
gives an empty result; other columns are ignored, whatever their names
(``drop_copies`` returns them as they are).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import broadcast_if_small, lower_ascii, shuffle_partitions, stage, whole_row

# Splitters are sampled to the driver, so they hold the beginning of a text only.
SPLITTER_CHARS = 32
HOT_ROWS = 1000  # copies that one partition takes at any size of the table


def hot_texts(docs: DataFrame, text_col: str) -> list[int]:
    """Hashes of the texts whose copies would overfill a partition: at most as
    many as there are partitions."""
    share = max(HOT_ROWS, docs.count() // shuffle_partitions(docs.sparkSession))
    counts = docs.groupBy(F.xxhash64(lower_ascii(F.col(text_col))).alias("__hash")).agg(F.count(F.lit(1)).alias("__n"))
    return [r["__hash"] for r in counts.where(F.col("__n") > share).collect()]


def _runs(docs: DataFrame, id_col: str, text_col: str, keep: str, payload: list) -> DataFrame:
    """Rows sorted by content with what their run says: its size, its best
    identifier and the row's place in it. A run holds all copies of a text, or of
    a hot text those of one spread; ``__head`` is the text of a hot run's first row."""
    if keep not in ("min", "max"):
        raise ValueError("keep is 'min' or 'max'")
    norm = lower_ascii(F.col(text_col))
    # never a constant, which would drop out of the sort key and cost a shuffle
    is_hot = F.xxhash64(norm).isin(hot_texts(docs, text_col) or [0])
    spread = F.when(is_hot, F.pmod(F.xxhash64(id_col), F.lit(max(16, shuffle_partitions(docs.sparkSession)))))
    rows = docs.select(
        F.col(id_col).alias("__id"),
        norm.alias("__norm"),
        F.substring(norm, 1, SPLITTER_CHARS).alias("__begin"),
        F.xxhash64(norm).alias("__hash"),
        spread.alias("__spread"),
        *payload,
    )
    ranged = rows.repartitionByRange("__begin", "__hash", "__spread")
    run = Window.partitionBy("__begin", "__hash", "__spread", "__norm")
    best_first = F.col("__id").asc_nulls_last() if keep == "min" else F.col("__id").desc_nulls_last()
    place = F.row_number().over(run.orderBy(best_first))
    best = F.min if keep == "min" else F.max
    return ranged.select(
        "*",
        place.alias("__place"),
        F.count(F.lit(1)).over(run).alias("__run_size"),
        best("__id").over(run).alias("__run_best"),
        F.unhex(F.sha2("__norm", 256)).alias("__sha"),
    ).withColumn("__head", F.when(F.col("__spread").isNotNull() & (F.col("__place") == 1), F.col("__norm")))


def _hot_groups(heads: DataFrame, keep: str) -> DataFrame:
    """Per run of a hot text the identifier that stays of all its copies, and
    their number. There are at most as many rows as hot texts have spreads."""
    same = Window.partitionBy("__head")
    best = F.min if keep == "min" else F.max
    return heads.where("__head is not null").select(
        F.col("__sha"),
        F.col("__spread"),
        best("__run_best").over(same).alias("__all_best"),
        F.sum("__run_size").over(same).alias("__all_size"),
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min") -> DataFrame:
    """One row per document: ``id_col``, ``keep_id`` (the copy that stays),
    ``group_size``, ``kept`` and ``text_sha256`` (of the normalised text)."""
    runs = _runs(docs, id_col, text_col, keep, [])
    narrow, _ = stage(runs.select("__id", "__sha", "__spread", "__place", "__run_size", "__run_best", "__head"), "dedup")
    hot, _ = stage(_hot_groups(narrow, keep), "hot-runs")
    rows = narrow.where("__spread is not null").join(broadcast_if_small(hot), ["__sha", "__spread"])
    rows = rows.select("__id", "__sha", "__place", F.col("__all_best").alias("__best"), F.col("__all_size").alias("__size"))
    cold = narrow.where("__spread is null")
    rows = rows.union(cold.select("__id", "__sha", "__place", "__run_best", "__run_size"))
    return rows.select(
        F.col("__id").alias(id_col),
        F.col("__best").alias("keep_id"),
        F.col("__size").alias("group_size"),
        (F.col("__id").eqNullSafe(F.col("__best")) & (F.col("__place") == 1)).alias("kept"),
        F.lower(F.hex("__sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min") -> DataFrame:
    """The documents that stay, with all their columns."""
    runs = _runs(docs, id_col, text_col, keep, [whole_row(docs).alias("__row")]).where("__place = 1")
    heads, _ = stage(runs.select("__id", "__sha", "__spread", "__run_size", "__run_best", "__head", "__row"), "dedup")
    hot, _ = stage(_hot_groups(heads, keep), "hot-runs")
    lost = heads.select("__id", "__sha", "__spread").join(hot, ["__sha", "__spread"])
    lost = lost.where(~F.col("__id").eqNullSafe(F.col("__all_best"))).select("__sha", "__spread")
    kept = heads.where("__spread is null").select("__row")
    hot_kept = heads.where("__spread is not null").join(lost, ["__sha", "__spread"], "left_anti").select("__row")
    return kept.union(hot_kept).select("__row.*")
