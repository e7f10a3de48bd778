"""Shared helpers of the operators.

Words are the maximal runs of bytes other than 0x20 and 0x09-0x0D of the UTF-8
text after lower-casing A-Z. A document's shingles are its runs of five words;
a shorter document with at least one word has its whole sequence as its only
shingle; a document without words has none. Null texts count as empty.

Words and shingles are identified by 64-bit hashes computed with numpy over
whole Arrow buffers. Two given documents of a thousand shingles confuse two
different shingles with a probability of about 1e-13.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.tokens import bytes_of
from quarry.session import remove_dir, scratch_dir

SHINGLE_WORDS = 5
# Text bytes that are hashed at once; the temporary arrays take about 40 times as much.
CHUNK_BYTES = 1 << 19

# SQL form of the word rule, for the operators that use built-in functions only.
WORD_REGEX = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ASCII_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


def lower_ascii(col):
    """Lower-case A-Z only; null counts as empty."""
    return F.translate(F.coalesce(col, F.lit("")), UPPER, LOWER)


def words_of(text: str | None) -> list[bytes]:
    """The words of a text (``bytes.split`` splits at exactly the bytes above)."""
    return (text or "").encode("utf-8", "surrogatepass").translate(ASCII_LOWER).split()


def whole_row(docs: DataFrame):
    """All columns as one struct, so that none can clash with an operator's own."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def stage(df: DataFrame, name: str, compression: str | None = None, **options: str) -> tuple[DataFrame, str]:
    """Write ``df`` to a fresh table in the shared checkpoint folder and read
    it back: cuts the lineage, so a lost executor costs no recomputation.
    ``options`` are the writer's."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.options(**options).parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path), path


BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20


@contextlib.contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs that run within hand their rows to Python in Arrow batches of about
    ``BATCH_BYTES``: the executor and its worker both hold a batch whole, and ten
    thousand texts are some 30 MB. A caller's own setting stays."""
    if spark.conf.get(BATCH_CONF, None) is not None:
        yield
        return
    spark.conf.set(BATCH_CONF, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(BATCH_CONF)


def drop_stages(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        remove_dir(spark, path)


BROADCAST_ROWS = 500_000


def broadcast_if_small(narrow: DataFrame) -> DataFrame:
    """Mark a staged table of a few numbers per row for broadcast, if it has at
    most ``BROADCAST_ROWS`` rows (some 20 MB); else the join shuffles."""
    return F.broadcast(narrow) if narrow.count() <= BROADCAST_ROWS else narrow


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ------------------------------------------------------------ word and shingle hashes


def _splitmix(x: np.ndarray) -> np.ndarray:
    x = (x + np.uint64(0x9E3779B97F4A7C15)).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values() -> np.ndarray:
    values = _splitmix(np.arange(1, 257, dtype=np.uint64))
    values[65:91] = values[97:123]  # A-Z as a-z
    return values


_BASE = 0x2545F4914F6CDD1D
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUES = _byte_values()
_LOWER = np.frombuffer(ASCII_LOWER, dtype=np.uint8)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_PLACE = _splitmix(np.arange(1000, 1000 + SHINGLE_WORDS, dtype=np.uint64)) | np.uint64(1)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if size <= 4 * CHUNK_BYTES:
            _POWERS[base] = have
    return have[:n]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of some documents, and where each document's begin.

    ``data``: the documents' bytes one after the other; ``offsets``: where each
    begins, and the end. A word's hash is a polynomial over its bytes, taken as
    a difference of prefix sums modulo 2**64 and then mixed.
    """
    offsets = offsets - offsets[0]
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    word = ~_SPACE[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | edge[1:n]
    last = word.copy()
    last[:-1] &= ~word[1:] | edge[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_VALUES[data] * _powers(_BASE, n), out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * _powers(_BASE_INVERSE, n)[starts]
    return _splitmix(hashes + (ends - starts).astype(np.uint64)), np.searchsorted(starts, offsets)


def shingle_hashes(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """For each document the sorted distinct 64-bit hashes of its shingles."""
    words, at = word_hashes(data, offsets)
    k = SHINGLE_WORDS
    runs = np.zeros(max(len(words) - k + 1, 0), dtype=np.uint64)
    for j in range(k):
        runs += words[j : j + len(runs)] * _PLACE[j]
    runs = _splitmix(runs)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= k:
            s = np.sort(runs[a : b - k + 1])
            keep = np.ones(len(s), dtype=bool)
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            out.append(s[keep])
        elif b > a:
            whole = (words[a:b] * _PLACE[: b - a]).sum(dtype=np.uint64)
            out.append(_splitmix(np.array([whole + np.uint64(b - a)], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def text_buffers(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Blocks of a string column without copying: the first row of the block,
    its bytes and its offsets. A block has about ``CHUNK_BYTES`` at most, or one
    longer text."""
    if pa.types.is_large_string(column.type):
        kind = np.int64
    elif pa.types.is_string(column.type):
        kind = np.int32
    else:
        raise TypeError(f"a string column is needed, not {column.type}")
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, dtype=kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data_buffer, dtype=np.uint8) if data_buffer is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, side="right")) - 1
        end = min(max(end, row + 1), n)
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1]
        row = end


def shingles_of_text(text: str | None) -> np.ndarray:
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    return shingle_hashes(data, np.array([0, len(data)], dtype=np.int64))[0]


def word_codes(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of a string column without nulls: the distinct ones (binary),
    the place of each word among them in text order, and where each text's begin."""
    data, offsets = bytes_of(column)
    data = _LOWER[data]
    word = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1] | edge[1:-1]
    last[:-1] &= ~word[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    # words and what lies between them, alternating
    edges = np.append(np.stack([starts, ends], axis=1).ravel(), len(data)).astype(np.int64)
    both = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(data)]
    )
    coded = both.take(pa.array(np.arange(0, len(edges) - 1, 2))).dictionary_encode()
    codes = np.asarray(coded.indices).astype(np.int64)
    return coded.dictionary.cast(pa.binary()), codes, np.searchsorted(starts, offsets)


def segment_sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of ``values[at[i] : at[i + 1]]``; equal segments have equal sums."""
    out = np.zeros(len(at) - 1, dtype=values.dtype)
    some = np.flatnonzero(at[1:] > at[:-1])
    if len(some):
        out[some] = np.add.reduceat(values, at[some])
    return out


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


# ------------------------------------------------------------------------- components

EDGES_A_TASK = 100_000


def components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """Connected components as ``(node, component)``, ``component`` the
    smallest node reachable; nodes without an edge are not returned.

    Large-star and small-star steps alternate until nothing changes; each is
    one aggregation and one join by node, and is written to the shared folder.
    A node with many edges only ever has one row per neighbour, and joins of
    such a node are split by adaptive execution. Few edges go to few files, as each
    file costs the executor some calls of its own.
    """
    spark = edges.sparkSession
    kind = edges.schema[a].dataType
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null and u <> v")
    current, path = stage(_star(pairs, large=True).distinct(), "star")
    size = _signature(current)
    for _ in range(max_rounds):
        # a step makes at most two edges of one
        small, p1 = stage(_few(_star(current, large=False).distinct(), 2 * size[0]), "star")
        drop_stages(spark, [path])
        current, path = stage(_few(_star(small, large=True).distinct(), 2 * size[0]), "star")
        drop_stages(spark, [p1])
        new = _signature(current)
        if new == size:
            break
        size = new
    else:
        raise RuntimeError("components did not converge")
    both = current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        current.select(F.col("v"), F.col("v"))
    )
    return _few(both.distinct(), 2 * size[0]).select(F.col("node").cast(kind), F.col("component").cast(kind))


def _few(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in no more partitions than about ``rows`` rows need."""
    return df.coalesce(max(1, -(-rows // EDGES_A_TASK)))


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
    ).first()
    return tuple(row)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step; edges come and go as (u, v) with v the smaller end."""
    if large:
        view = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u")))
    else:
        view = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = view.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    joined = view.join(low, "u")
    if large:
        # neighbours larger than u hang on the smallest of u's neighbourhood
        return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    # u and its smaller neighbours hang on the smallest of them
    return joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
        low.select("u", F.col("m").alias("v"))
    )
