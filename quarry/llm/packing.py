"""Packing tokenised documents into sequences, shortest pack first.

Documents are cut into full sequences and a remainder. What the packing decides
only depends on how many pieces there are of each length, so the histogram of
lengths (at most ``SIZE`` numbers) is packed on the driver: lengths are placed longest
first, each into the packs that are shortest so far, for all packs of equal fill
at once. That gives slots: a length, a run of ranks within that length, and the
sequences and offset those ranks go to. Each piece then finds its slot by its
length and its rank, which is its rank among the pieces of its task plus the
number of such pieces in earlier tasks.

The tokenised pieces are written to the shared folder once and read back; nothing
of the size of the documents is shuffled.

A sequence that ends at a power of two needs no padding. Full ones are such;
beyond that the packing does not steer towards such ends.

Defined results: null and empty texts are the end id alone; very long texts are
cut into as many full sequences as they fill; which of two pieces of equal length
comes first is decided by their task and place in it; repeated rows are packed as
often as they occur; an empty table gives an empty result; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import BROADCAST_ROWS, column_of, small_batches, stage
from quarry.llm.tokens import encoder, give_back

SIZE = 2048
_ROWS = 800  # documents encoded at once
_PIECES_OUT = 500  # packed pieces that go out at once

_PIECE = "doc_id bigint, start bigint, length int, doc_tokens bigint, task int, place bigint, ids binary"


def token_pieces(docs: DataFrame, tokenizer: str, size: int = SIZE) -> DataFrame:
    """One row per piece: its ids (unsigned 16 bit where they fit, else 32),
    where it starts in its document, and its place among the task's pieces of
    the same length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode_all
        task = TaskContext.get().partitionId()
        seen = np.zeros(size + 1, dtype=np.int64)
        for batch in batches:
            texts, doc_ids = column_of(batch, "text"), column_of(batch, "doc_id").to_pylist()
            for at in range(0, len(batch), _ROWS):
                rows: list[tuple] = []
                for doc_id, ids in zip(doc_ids[at : at + _ROWS], encode(texts.slice(at, _ROWS)), strict=True):
                    for start in range(0, len(ids), size):
                        piece = ids[start : start + size]
                        length = len(piece)
                        rows.append((doc_id, start, length, len(ids), task, int(seen[length]), pack_ids(piece)))
                        seen[length] += 1
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                    [f.split()[0] for f in _PIECE.split(", ")],
                )
            batch = texts = doc_ids = rows = None  # freed before the next batch comes
            give_back()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _PIECE)


def pack_ids(ids: np.ndarray) -> bytes:
    """Low bytes, then high bytes: they compress better apart. A first byte
    tells the width."""
    width = 2 if not len(ids) or int(ids.max()) < 1 << 16 else 4
    planes = ids.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T
    return bytes([width]) + planes.tobytes()


def unpack_ids(packed: bytes | pa.Buffer) -> np.ndarray:
    width = packed[0]
    planes = np.frombuffer(packed, np.uint8, offset=1).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype("<u4")


class Slots:
    """Arrays with one entry per slot, ordered by length and first rank."""

    def __init__(self, rows: list[tuple[int, int, int, int, int]]):
        rows = sorted(rows)
        table = np.array(rows, dtype=np.int64).reshape(-1, 5).T
        self.length, self.rank, self.each, self.sequence, self.offset = table
        self._key = (self.length << 48) + self.rank

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces."""
        length = length.astype(np.int64)
        at = np.searchsorted(self._key, (length << 48) + rank, side="right") - 1
        past = rank - self.rank[at]
        return self.sequence[at] + past // self.each[at], self.offset[at] + past % self.each[at] * length


def pack_histogram(counts: dict[int, int], size: int = SIZE) -> Slots:
    """Shortest-pack-first over the histogram of lengths.

    Packs of equal fill are kept as runs of sequence ids. A slot is
    ``(length, first rank, pieces per pack, first sequence, offset)``.
    """
    runs: dict[int, list[tuple[int, int]]] = {}  # space left: (first sequence, packs)
    spaces: list[int] = []  # heap of the negated spaces in use
    slots: list[tuple[int, int, int, int, int]] = []
    sequences = 0

    def put_back(space: int, first: int, packs: int) -> None:
        if packs and space:
            if space not in runs:
                runs[space] = []
                heapq.heappush(spaces, -space)
            runs[space].append((first, packs))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            space = -spaces[0] if spaces else 0
            if space < length:
                # no pack has room: new packs, filled one after the other
                each = min(size // length, left)
                packs = left // each
                first, space = sequences, size
                sequences += packs
            else:
                first, packs = runs[space].pop()
                if not runs[space]:
                    del runs[space]
                    heapq.heappop(spaces)
                # as many per pack as go in before another pack is shorter
                lower = -spaces[0] if spaces else 0
                each = max(1, min(space // length, -(-(space - lower) // length), left // packs))
                if packs > left // each:
                    put_back(space, first + left // each, packs - left // each)
                    packs = left // each
            slots.append((length, rank, each, first, size - space))
            put_back(space - each * length, first, packs)
            rank += packs * each
            left -= packs * each
    return Slots(slots)


def pack_documents(docs: DataFrame, tokenizer: str, size: int = SIZE) -> DataFrame:
    """One row per piece: ``doc_id, start, length, doc_tokens, sequence_id,
    offset`` and ``ids`` (little-endian unsigned 32 bit). Sequences have at most
    ``size`` ids."""
    with small_batches(docs.sparkSession):
        pieces, _ = stage(token_pieces(docs, tokenizer, size), "pieces")
    counts, _ = stage(pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("k")), "lengths")
    histogram = {r["length"]: r["k"] for r in counts.groupBy("length").agg(F.sum("k").alias("k")).collect()}
    slots = pack_histogram(histogram, size)
    earlier = Window.partitionBy("length").orderBy("task")
    before = counts.select("task", "length", (F.sum("k").over(earlier) - F.col("k")).alias("before"))
    before, _ = stage(before, "before")
    if before.count() <= BROADCAST_ROWS:
        before = F.broadcast(before)
    ranked = pieces.join(before, ["task", "length"]).select(
        "doc_id", "start", F.col("length").cast("long").alias("length"), "doc_tokens",
        (F.col("before") + F.col("place")).alias("rank"), "ids",
    )
    names = ["doc_id", "start", "length", "doc_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # ids take up to 8 kB a row, so few rows go out at once
            for at in range(0, len(batch), _PIECES_OUT):
                part = batch.slice(at, _PIECES_OUT)
                sequence, offset = slots.find(
                    column_of(part, "length").to_numpy(), column_of(part, "rank").to_numpy()
                )
                ids = [unpack_ids(x.as_buffer()).tobytes() for x in column_of(part, "ids")]
                yield pa.RecordBatch.from_arrays(
                    [*(column_of(part, n) for n in names), pa.array(sequence), pa.array(offset), pa.array(ids, pa.binary())],
                    [*names, "sequence_id", "offset", "ids"],
                )
            batch = part = ids = None  # freed before the next batch comes
            give_back()

    return ranked.mapInArrow(
        run,
        "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary",
    )


def with_checksum(packed: DataFrame) -> DataFrame:
    """The packed pieces with ``ids_crc32`` in place of their ids."""
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
