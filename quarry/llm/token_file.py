"""Token ids in a compact binary form, and back.

Ids are replaced by their rank in the corpus (0 the most frequent), and ranks
are stored byte-aligned in one to four bytes, so frequent ids take one. The
byte counts, two bits per id, are kept apart as control bytes; a reader looks a
control byte up in a table to get four lengths at once, and gathers the values
with numpy.

A token folder holds, in ascending order of identifier, blocks of documents
(``blocks``: identifiers, ids per document, control bytes, data bytes) and the
ids by rank (``ranks``). The blocks are rows of Parquet files, so every store
that Spark writes to will do, and files appear only when a task has committed. The
order is a range partitioning of the identifiers; ``part`` and ``block`` number
the blocks.

Defined results: null and empty texts are the end id alone; rows without an
identifier come first; rows that agree in identifier are ordered by their number
of ids and the ids, and repeated rows are stored as often as they occur; a very
long text makes a block of its own; an empty table gives an empty folder and
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import column_of, drop_stages, stage
from quarry.llm.packing import pack_ids, unpack_ids
from quarry.llm.tokens import encoder, give_back

BLOCK_IDS = 1 << 18
_ROWS = 800  # documents encoded at once

# ------------------------------------------------------------------------- the coding

_LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + np.uint8(1)


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes."""
    ranks = ranks.astype("<u4")
    raw = ranks.view(np.uint8).reshape(-1, 4)
    width = 1 + (ranks > 0xFF) + (ranks > 0xFFFF).astype(np.uint8) + (ranks > 0xFFFFFF)
    codes = np.zeros(-(-len(ranks) // 4) * 4, dtype=np.uint8)
    codes[: len(ranks)] = width - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    return control.astype(np.uint8).tobytes(), raw[np.arange(4) < width[:, None]].tobytes()


def decode_ranks(control: bytes, data: bytes, count: int) -> np.ndarray:
    width = _LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:count]
    ends = np.cumsum(width, dtype=np.int64)
    starts = ends - width
    source = np.frombuffer(data, np.uint8)
    ranks = source[starts].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(width > k)
        if not len(more):
            break
        ranks[more] |= source[starts[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return ranks


# --------------------------------------------------------------------------- the files

# the last row of a task has no ids but the task's counts of ids
_RAW = "doc_id bigint, n bigint, ids binary, counts binary"
_BLOCKS = "part int, block int, docs int, total bigint, doc_ids binary, counts binary, control binary, data binary"


def _tokenised(docs: DataFrame, tokenizer: str) -> DataFrame:
    names = [f.split()[0] for f in _RAW.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode_all
        counts = np.zeros(0, dtype=np.int64)
        for batch in batches:
            texts, doc_ids = column_of(batch, "text"), column_of(batch, "doc_id")
            for at in range(0, len(batch), _ROWS):
                ids = encode(texts.slice(at, _ROWS))
                found = np.bincount(np.concatenate(ids), minlength=len(counts))
                found[: len(counts)] += counts
                counts = found
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_ids.slice(at, _ROWS),
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([pack_ids(x) for x in ids], pa.binary()),
                        pa.nulls(len(ids), pa.binary()),
                    ],
                    names,
                )
            batch = texts = doc_ids = ids = None  # freed before the next batch comes
            give_back()
        if len(counts):
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
                 pa.array([counts.astype("<i8").tobytes()], pa.binary())],
                names,
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _RAW)


def _id_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for blob in column_of(batch, "counts"):
            counts = np.frombuffer(blob.as_buffer(), "<i8")
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(counts[used])], ["id", "n"])


def _write_blocks(rank_of: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, serial = TaskContext.get().partitionId(), 0
        doc_ids: list = []
        ids: list[np.ndarray] = []
        held = 0

        def block():
            flat = rank_of[np.concatenate(ids)]
            control, data = encode_ranks(flat)
            counts = np.array([len(x) for x in ids], dtype="<i8")
            # a missing identifier is the smallest number
            named = np.array([-(1 << 63) if d is None else d for d in doc_ids], dtype="<i8")
            values = [part, serial, len(ids), len(flat), named.tobytes(), counts.tobytes(), control, data]
            kinds = [pa.int32()] * 3 + [pa.int64()] + [pa.binary()] * 4
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(values, kinds, strict=True)],
                [f.split()[0] for f in _BLOCKS.split(", ")],
            )

        for batch in batches:
            for doc_id, packed in zip(column_of(batch, "doc_id").to_pylist(), column_of(batch, "ids"), strict=True):
                doc_ids.append(doc_id)
                ids.append(unpack_ids(packed.as_py()))
                held += len(ids[-1])
                if held >= BLOCK_IDS:
                    yield block()
                    serial += 1
                    doc_ids, ids, held = [], [], 0
        if ids:
            yield block()

    return run


def write_tokens(docs: DataFrame, tokenizer: str, folder: str) -> None:
    """Encode every document, append the end id, and write a token folder."""
    spark = docs.sparkSession
    rows, raw_path = stage(_tokenised(docs, tokenizer), "raw-ids", compression="zstd")
    counted = rows.select("counts").where("counts is not null").mapInArrow(_id_counts, "id bigint, n bigint")
    raw = rows.where("ids is not null").drop("counts")
    # at most one row per id of the vocabulary
    counted = counted.groupBy("id").agg(F.sum("n").alias("n"))
    ranked = [r["id"] for r in counted.orderBy(F.desc("n"), "id").collect()]
    rank_of = np.zeros(max(ranked, default=0) + 1, dtype=np.uint32)
    rank_of[ranked] = np.arange(len(ranked), dtype=np.uint32)
    spark.createDataFrame(list(enumerate(ranked)), "rank long, id long").write.parquet(f"{folder}/ranks")
    ordered = raw.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "n", "ids"
    )
    blocks = ordered.select("doc_id", "ids").mapInArrow(_write_blocks(rank_of), _BLOCKS)
    blocks.write.parquet(f"{folder}/blocks", compression="zstd")
    drop_stages(spark, [raw_path])


_DOCS = "doc_id bigint, start bigint, n_tokens bigint, ids binary"


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document of a token folder, from its files: ``doc_id``,
    ``start`` (ids of all documents before), ``n_tokens`` and ``ids``
    (little-endian unsigned 32 bit)."""
    id_of = np.zeros(0, dtype=np.uint32)
    ranks = spark.read.parquet(f"{folder}/ranks").orderBy("rank").collect()
    if ranks:
        id_of = np.array([r["id"] for r in ranks], dtype=np.uint32)
    blocks = spark.read.schema(_BLOCKS).parquet(f"{folder}/blocks")
    sums = blocks.groupBy("part").agg(F.sum("total").alias("all"))
    # one row per written file
    before = sums.select("part", (F.sum("all").over(Window.orderBy("part")) - F.col("all")).alias("before"))
    inside = Window.partitionBy("part").orderBy("block")
    at = (
        blocks.select("part", "block", "total")
        .join(before, "part")
        .select("part", "block", (F.col("before") + F.sum("total").over(inside) - F.col("total")).alias("at"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                counts = np.frombuffer(row["counts"], "<i8")
                ids = id_of[decode_ranks(row["control"], row["data"], row["total"])].astype("<u4")
                ends = np.cumsum(counts)
                starts = ends - counts
                named = np.frombuffer(row["doc_ids"], "<i8")
                raw = ids.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(named, mask=named == -(1 << 63)),
                        pa.array(starts + row["at"]),
                        pa.array(counts),
                        pa.array(
                            [raw[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], pa.binary()
                        ),
                    ],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    return blocks.join(at, ["part", "block"]).mapInArrow(run, _DOCS)


def with_checksum(tokens: DataFrame) -> DataFrame:
    """The documents with ``ids_crc32`` in place of their ids."""
    return tokens.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
