"""Document fingerprints by one-permutation MinHash.

Each shingle hash is used once: its high bits choose one of ``BINS`` bins, the
smallest of the rest in a bin is the bin's value. Empty bins take the value of
the first non-empty bin in a fixed random order of their own (optimal
densification), so that two sets still agree in a bin with a probability equal
to their Jaccard similarity. Only the ``BITS`` low bits of each value are
stored; different values agree in them with probability ``2 ** -BITS``, which
the estimate corrects for. With 256 bins and 4 bits the standard error is about
0.03 at most.

Fingerprints are computed in ``mapInArrow`` over blocks of Arrow text.

``neighbour_fingerprints`` also compares each document with its successor in
descending order of identifier and with a text edited from both. Documents are
shuffled once, by ranges of the identifier that are cut at sampled quantiles;
the first document of each range is also sent to the range before it, so each
task finds all successors among its own sorted rows and keeps one batch and one row.

Defined results: null and wordless texts have the empty fingerprint, which is
like itself (1.0) and unlike all others (0.0); repeated identifiers are ordered
by text; rows without an identifier come last; a single document is its own
successor; a very long text is hashed whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import (
    CHUNK_BYTES,
    _splitmix,
    column_of,
    shingle_hashes,
    shuffle_partitions,
    text_buffers,
)

BINS = 256
BITS = 4
_BIN_SHIFT = np.uint64(64 - BINS.bit_length() + 1)
_NO_ID = -(1 << 63)


def _probe_orders() -> np.ndarray:
    """For each bin a fixed random order of all bins."""
    keys = _splitmix(np.arange(BINS * BINS, dtype=np.uint64) + np.uint64(77)).reshape(BINS, BINS)
    return np.argsort(keys, axis=1)


_ORDERS = _probe_orders()
_BIN_KEYS = _splitmix(np.arange(BINS, dtype=np.uint64) + np.uint64(5_000_000))


def signature(shingles: np.ndarray) -> bytes:
    """Packed fingerprint of sorted distinct shingle hashes; none: empty."""
    if not len(shingles):
        return b""
    bins = (shingles >> _BIN_SHIFT).astype(np.int64)
    first = np.ones(len(bins), dtype=bool)
    np.not_equal(bins[1:], bins[:-1], out=first[1:])
    filled = np.zeros(BINS, dtype=bool)
    filled[bins[first]] = True
    values = np.zeros(BINS, dtype=np.uint64)
    values[bins[first]] = shingles[first]
    empty = np.flatnonzero(~filled)
    if len(empty):
        orders = _ORDERS[empty]
        values[empty] = values[orders[np.arange(len(empty)), filled[orders].argmax(axis=1)]]
    # mixed with the bin, so that the low bits of a value copied to many bins
    # agree with another value's by chance in each bin on its own
    low = (_splitmix(values ^ _BIN_KEYS) & np.uint64((1 << BITS) - 1)).astype(np.uint8)
    bits = np.unpackbits(low[:, None], axis=1, count=BITS, bitorder="little")
    return np.packbits(bits, bitorder="little").tobytes()


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of rows of unpacked fingerprints."""
    agree = (a == b).mean(axis=1)
    chance = 2.0**-BITS
    return np.clip((agree - chance) / (1 - chance), 0.0, 1.0)


def _unpacked(prints: list[bytes]) -> np.ndarray:
    raw = np.frombuffer(b"".join(p or bytes(BINS * BITS // 8) for p in prints), dtype=np.uint8)
    bits = np.unpackbits(raw.reshape(len(prints), -1), axis=1, bitorder="little").reshape(len(prints), BINS, BITS)
    return np.packbits(bits, axis=2, bitorder="little")[:, :, 0]


def compare(a: list[bytes], b: list[bytes]) -> np.ndarray:
    if not a:
        return np.zeros(0)
    result = likeness(_unpacked(a), _unpacked(b))
    none_a, none_b = np.array([not x for x in a]), np.array([not x for x in b])
    result[none_a ^ none_b] = 0.0
    result[none_a & none_b] = 1.0
    return result


def fingerprints_of(column: pa.Array) -> list[bytes]:
    out: list[bytes] = []
    for _, data, offsets in text_buffers(column):
        out += [signature(s) for s in shingle_hashes(data, offsets)]
    return out


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, fingerprint`` (hex) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [p.hex() for p in fingerprints_of(column_of(batch, "text"))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.string())], ["id", "fingerprint"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, fingerprint string").withColumnRenamed("id", id_col)


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by as many from ``following``."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


_OUT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _compare_block(ids: list, texts: list[str], prints: list[bytes]) -> pa.RecordBatch:
    """Output for all rows but the last, each with the row after it."""
    changed = [edited(a, b) for a, b in zip(texts[:-1], texts[1:], strict=True)]
    encoded = pa.array(changed, pa.large_string())
    other = fingerprints_of(encoded)
    shas = [hashlib.sha256(x.encode("utf-8")).hexdigest() for x in changed]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids[:-1], pa.int64()),
            pa.array([len(x) for x in texts[:-1]], pa.int64()),
            pa.array(shas, pa.string()),
            pa.array([p.hex() for p in prints[:-1]], pa.string()),
            pa.array([p.hex() for p in other], pa.string()),
            pa.array(compare(prints[:-1], other), pa.float64()),
            pa.array(compare(prints[:-1], prints[1:]), pa.float64()),
        ],
        ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )


def _compare_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by range and order; the rows after a range's own are flagged
    and only the first of them, the successor of the range's last, is used."""
    last = None  # (range, id, text, fingerprint, flagged)
    for batch in batches:
        at = 0
        for start, data, offsets in text_buffers(column_of(batch, "text")):
            n = len(offsets) - 1
            part = batch.slice(start, n)
            prints = [signature(s) for s in shingle_hashes(data, offsets)]
            rows = list(
                zip(
                    column_of(part, "range").to_pylist(),
                    column_of(part, "doc_id").to_pylist(),
                    (x or "" for x in column_of(part, "text").to_pylist()),
                    prints,
                    column_of(part, "flagged").to_pylist(),
                    strict=True,
                )
            )
            at += n
            if last is not None:
                rows.insert(0, last)
            run: list = []
            for row in rows:
                if run and (row[0] != run[-1][0] or run[-1][4]):
                    if len(run) > 1:
                        yield _compare_block(*map(list, list(zip(*run, strict=True))[1:4]))
                    run = []
                if not (row[4] and not run):
                    run.append(row)
            if len(run) > 1:
                yield _compare_block(*map(list, list(zip(*run, strict=True))[1:4]))
            last = run[-1] if run else None


def neighbour_fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``."""
    spark = docs.sparkSession
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", order.alias("__order"))
    # more ranges than tasks: ranges are dealt to tasks by hash
    parts = shuffle_partitions(spark)
    wanted = 4 * parts
    cuts = keyed.approxQuantile("__order", [i / wanted for i in range(1, wanted)], 0.25 / wanted)
    borders = np.array(sorted({int(c) for c in cuts}), dtype=np.int64)

    @F.pandas_udf("int")
    def range_of(values: pd.Series) -> pd.Series:
        # descending: range 0 has the largest identifiers
        return pd.Series(len(borders) - np.searchsorted(borders, values.to_numpy(np.int64), side="left"))

    ranges = keyed.select("__order").withColumn("range", range_of("__order"))
    # one row per range, as many as there are borders: bounded by the task count
    heads = ranges.groupBy("range").agg(F.max("__order").alias("head")).orderBy("range").collect()
    before = [heads[-1]["range"], *(h["range"] for h in heads)] if heads else []
    extra = spark.createDataFrame(
        [(h["head"], before[i]) for i, h in enumerate(heads)], "__head long, __extra int"
    )
    sent = F.array(F.struct(F.col("range"), F.lit(0).alias("flagged")))
    also = F.array(
        F.struct(F.col("range"), F.lit(0).alias("flagged")),
        F.struct(F.col("__extra").alias("range"), F.lit(1).alias("flagged")),
    )
    rows = (
        keyed.withColumn("range", range_of("__order"))
        .join(F.broadcast(extra), F.col("__order") == F.col("__head"), "left")
        .withColumn("to", F.explode(F.when(F.col("__extra").isNull(), sent).otherwise(also)))
        .select("to.range", "to.flagged", "__order", "doc_id", "text")
        .repartition(parts, "range")
        .sortWithinPartitions("range", "flagged", F.desc("__order"), "text")
    )
    return rows.select("range", "flagged", "doc_id", "text").mapInArrow(_compare_sorted, _OUT)
