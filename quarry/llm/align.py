"""Aligning the tokens of two tokenizers over the same text, by pointer jumping.

Both tokenizers cut the bytes of a space and the text. Tokens of the two that
overlap form a graph; its components are the shortest runs of tokens that both
tokenizers end at the same byte. Every token points to the farthest-right token
that overlaps it. Successors are doubled with numpy, ``next = next[next]``, for
all tokens of a block of documents at once, until nothing changes; then every
token points to the last token of its component, which labels the group.

Neither tokenizer joins anything across a space that follows something else than
white space: a text is cut there, and each distinct segment of a block of
documents is tokenised and aligned once. A text's groups are those of its
segments one after the other.

How often two ids are linked is counted over the corpus: per block in the task,
then by id pair in Spark. The counts go back to the blocks that hold the pair, by
joins on the pair and on the block, so no table of pairs is ever in one place; a
pair that occurs everywhere costs one row per block.

Defined results: texts that are null or empty, or whose tokens' bytes differ from
the space and the text (if they hold U+2581, for instance), have no tokens:
zeros and an empty string of groups. Strings of special tokens are ordinary text.
A very long text makes a block of its own. Ties of counts are all best. Repeated
rows count as often as they occur; an empty table gives an empty result; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import column_of, small_batches, stage
from quarry.llm.tokens import blocks_of, byte_letters, bytes_of, code_points, encoder, gather, give_back

BLOCK_BYTES = 8 << 20
_CUT_BYTES = 1 << 18  # text that is cut into segments at once
_SEGMENT_BYTES = 1 << 17  # distinct segments that are aligned at once
_JOINED = 1 << 16  # segments whose groups are joined at once
_PART_BYTES = 1 << 17  # of an array of a block that go into a row; whole numbers of eight bytes
# A row of a block is large for the writer of its table, which else looks at its pages and
# row groups every hundred rows only; the reader holds a row group at once.
_LARGE_ROWS = {
    "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1",
    "parquet.block.size.row.check.min": "1", "parquet.block.size.row.check.max": "1", "parquet.block.size": str(8 << 20),
}
_META = "▁"  # a space in the pieces of the second tokenizer
# White space that a space may belong with: Unicode's, what has been such in earlier
# versions, and the ASCII separators.
_SPACES = np.array(
    [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
_ASCII_SPACE = np.isin(np.arange(256), _SPACES[_SPACES < 128])

_PIECE_MODELS: dict[str, PieceModel] = {}


class PieceModel:
    """A sentencepiece model and the bytes of its pieces."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(self._model.get_piece_size())
        self.pieces = [self._bytes(i) for i in ids]
        self.sizes = np.array([len(p) for p in self.pieces], dtype=np.int64)
        inner = [self._model.id_to_piece(i).lstrip(_META) for i in ids]
        # without pieces that go on after a space, segments can be encoded apart
        self.splits = not any(_META in p for p in inner)

    def _bytes(self, i: int) -> bytes:
        if self._model.is_byte(i):
            return bytes([int(self._model.id_to_piece(i)[1:-1], 16)])
        if self._model.is_control(i) or self._model.is_unknown(i):
            return b""
        return self._model.id_to_piece(i).replace(_META, " ").encode("utf-8")

    def encode(self, spaced: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts that are given with the space which the model adds itself,
        one after the other, and how many each text has."""
        rows = self._model.encode([s[1:] for s in spaced], num_threads=1)
        space = self._model.piece_to_id(_META)
        rows = [[space] if s == " " else row for s, row in zip(spaced, rows, strict=True)]
        counts = np.fromiter(map(len, rows), dtype=np.int64, count=len(rows))
        return np.fromiter(chain.from_iterable(rows), dtype=np.int64, count=int(counts.sum())), counts


def piece_model(path: str) -> PieceModel:
    if path not in _PIECE_MODELS:
        _PIECE_MODELS[path] = PieceModel(path)
    return _PIECE_MODELS[path]


# ---------------------------------------------------------------------- the alignment


def jump_to_last(successor: np.ndarray) -> np.ndarray:
    """Successor doubling: where each chain of successors ends."""
    while True:
        further = successor[successor]
        if np.array_equal(further, successor):
            return successor
        successor = further


class Groups(NamedTuple):
    """``a_label``, ``b_label``: the group of each token, numbered from left to
    right; ``ends``: the byte at which each group ends; ``links``: indexes of
    overlapping tokens."""

    a_label: np.ndarray
    b_label: np.ndarray
    ends: np.ndarray
    links: tuple[np.ndarray, np.ndarray]


def align(a_ends: np.ndarray, b_ends: np.ndarray) -> Groups:
    """Groups and links of two ways to cut the same bytes, given where their
    tokens end. Tokens have at least one byte, and the last ends are equal."""
    n, m = len(a_ends), len(b_ends)
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return Groups(none, none, none, (none, none))
    # the token of the other kind that holds a token's last byte ends farthest right
    to_b = np.searchsorted(b_ends, a_ends)
    to_a = np.searchsorted(a_ends, b_ends)
    successor = np.empty(n + m, dtype=np.int64)
    successor[:n] = n + to_b
    successor[n:] = np.where(a_ends[to_a] > b_ends, to_a, n + np.arange(m))
    last = jump_to_last(successor)
    terminals = np.unique(last)  # tokens of the second kind, from left to right
    labels = np.searchsorted(terminals, last)
    # the first overlapping token is the one that holds the first byte
    first = np.searchsorted(b_ends, np.append(0, a_ends[:-1]), side="right")
    each = to_b - first + 1
    links = (np.repeat(np.arange(n), each), gather(np.arange(m), first, each))
    return Groups(labels[:n], labels[n:], b_ends[terminals - n], links)


# --------------------------------------------------------------------------- segments


def segment_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the segments of some texts begin: at the texts, and at spaces that
    follow something else than white space."""
    starts = np.zeros(len(data), dtype=bool)
    for a in range(0, len(data), _CUT_BYTES):
        # with the character before, and room for the rest of the last one
        before = min(a, 3)
        part = np.append(data[a - before : a + _CUT_BYTES], np.zeros(3, np.uint8))
        white = np.zeros(len(part) + 1, dtype=bool)  # a character that ends before here is white space
        white[1:] = _ASCII_SPACE[part]
        points, places = code_points(part)
        wide = np.isin(points, _SPACES)
        white[places[wide] + np.where(points[wide] < 0x800, 2, 3)] = True
        starts[a : a + _CUT_BYTES] = ((part == 0x20) & ~white[:-1])[before:-3]
    starts[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return np.flatnonzero(starts)


class Segments(NamedTuple):
    """Distinct segments: counts per segment, ``-1`` tokens if a segment's bytes
    are not those of its tokens; its groups as text; and its links as places in
    the sorted distinct id pairs."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: pa.Array
    links: np.ndarray
    pairs: np.ndarray


def align_segments(segments: pa.Array, byte_path: str, piece_path: str) -> Segments:
    """Some segments are aligned at a time, as their tokens are Python objects in between."""
    few = blocks_of(segments, _SEGMENT_BYTES) if len(segments) else [segments]
    parts = [_align_some(part, byte_path, piece_path) for part in few]
    pairs = np.unique(np.concatenate([p.pairs for p in parts]))
    links = np.concatenate([np.searchsorted(pairs, p.pairs).astype(np.uint32)[p.links] for p in parts])
    sums = [np.concatenate([getattr(p, k) for p in parts]) for k in _DOC]
    return Segments(*sums, pa.concat_arrays([p.groups for p in parts]), links, pairs)


def _align_some(segments: pa.Array, byte_path: str, piece_path: str) -> Segments:
    a_ids, a_at = encoder(byte_path, special=False).encode(segments)
    model = piece_model(piece_path)
    b_ids, n_b = model.encode(segments.to_pylist())
    n_a = np.diff(a_at)
    data, ends = bytes_of(segments)
    a_bytes, b_bytes = _sizes(byte_path)[a_ids], model.sizes[b_ids]
    good = _whole(data, ends, a_ids, n_a, a_bytes, _letters(byte_path))
    good &= _whole(data, ends, b_ids, n_b, b_bytes, model.pieces)
    keep_a, keep_b = np.repeat(good, n_a), np.repeat(good, n_b)
    a_ids, b_ids = a_ids[keep_a].astype(np.int64), b_ids[keep_b]
    n_a, n_b = np.where(good, n_a, 0), np.where(good, n_b, 0)
    found = align(np.cumsum(a_bytes[keep_a]), np.cumsum(b_bytes[keep_b]))
    segment_a = np.repeat(np.arange(len(good)), n_a)
    groups_of = np.bincount(segment_a[np.unique(found.a_label, return_index=True)[1]], minlength=len(good))
    links_of = np.bincount(segment_a[found.links[0]], minlength=len(good))
    joined = pc.binary_join_element_wise(
        _listed(a_ids, found.a_label, len(found.ends)), _listed(b_ids, found.b_label, len(found.ends)), "|"
    )
    at = np.append(0, np.cumsum(groups_of)).astype(np.int64)
    texts = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(at), joined), ";").cast(pa.large_string())
    n_a = np.where(good, n_a, -1)
    pairs, links = np.unique(a_ids[found.links[0]] << 32 | b_ids[found.links[1]], return_inverse=True)
    return Segments(n_a, n_b, groups_of, links_of, texts, links.astype(np.uint32), pairs)


def _listed(ids: np.ndarray, label: np.ndarray, groups: int) -> pa.Array:
    """The ids of each group, joined by commas."""
    at = np.searchsorted(label, np.arange(groups + 1)).astype(np.int64)
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(at), pa.array(ids).cast(pa.string())), ",")


def _whole(data, ends, ids, counts, sizes, pieces) -> np.ndarray:
    """Whether each segment's bytes are those of its tokens."""
    token_ends = np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum(counts))]
    same = np.diff(token_ends) == np.diff(ends)
    raw = b"".join([pieces[i] for i in ids.tolist()])
    if same.all() and raw == data.tobytes():
        return same
    text, at, to = data.tobytes(), ends.tolist(), token_ends.tolist()
    return np.array([raw[to[i] : to[i + 1]] == text[at[i] : at[i + 1]] for i in range(len(counts))], dtype=bool)


_LETTERS: dict[str, list[bytes]] = {}


def _letters(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary."""
    if path not in _LETTERS:
        back = {c: b for b, c in byte_letters().items()}
        _LETTERS[path] = [bytes(map(back.__getitem__, n)) if set(n) <= back.keys() else b"" for n in encoder(path, False).names]
    return _LETTERS[path]


def _sizes(path: str) -> np.ndarray:
    return np.array([len(x) for x in _letters(path)], dtype=np.int64)


# ------------------------------------------------------------------------------ blocks

_DOC = ["n_a", "n_b", "n_groups", "n_links"]


class Block:
    """Some documents aligned: per document the counts and its groups, and the
    distinct segments' links as places in the sorted distinct id pairs."""

    def __init__(self, texts: pa.Array, byte_path: str, piece_path: str):
        texts = texts.fill_null("").cast(pa.large_string())
        if not piece_model(piece_path).splits:
            raise ValueError("the second tokenizer has pieces that go on after a space")
        empty, space = (pa.scalar(x, pa.large_string()) for x in ("", " "))
        spaced = pc.if_else(pc.equal(texts, empty), empty, pc.binary_join_element_wise(space, texts, empty))
        data, offsets = bytes_of(spaced)
        starts = segment_starts(data, offsets)
        pieces = pa.LargeStringArray.from_buffers(
            len(starts), pa.py_buffer(np.append(starts, len(data)).astype(np.int64)), pa.py_buffer(data)
        ).dictionary_encode()
        codes, distinct = np.asarray(pieces.indices), pieces.dictionary
        at = np.searchsorted(starts, offsets)
        del texts, spaced, data, starts, pieces
        found = align_segments(distinct, byte_path, piece_path)
        bad = _sums(found.n_a[codes] < 0, at) > 0
        if bad.any():
            sizes = np.diff(at)
            codes, at = codes[np.repeat(~bad, sizes)], np.append(0, np.cumsum(np.where(bad, 0, sizes)))
        self.at, self.codes = at, codes
        # a text's links are within its segments, so are its groups
        self.counts = {k: _sums(getattr(found, k)[codes], self.at) for k in _DOC}
        self._texts = found.groups
        self.link_at = np.append(0, np.cumsum(found.n_links))
        self.pairs, self.links = found.pairs, found.links
        used = np.bincount(codes, minlength=len(found.n_links))
        self.pair_counts = np.bincount(
            self.links, weights=np.repeat(used, found.n_links), minlength=len(self.pairs)
        ).astype(np.int64)

    def groups(self) -> Iterator[bytes]:
        row = 0
        while row < len(self.at) - 1:
            end = max(int(np.searchsorted(self.at, self.at[row] + _JOINED, side="right")) - 1, row + 1)
            at = self.at[row : end + 1].astype(np.int64)
            texts = self._texts.take(pa.array(self.codes[at[0] : at[-1]]))
            lists = pa.LargeListArray.from_arrays(pa.array(at - at[0]), texts)
            joined = pc.binary_join(lists, pa.scalar(";", texts.type))
            yield from joined.cast(pa.large_binary()).to_pylist()
            row = end


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of values[at[i] : at[i + 1]]."""
    sums = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[at[1:]] - sums[at[:-1]]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Identifiers and texts of about ``BLOCK_BYTES``, or one longer text."""
    held: list[pa.RecordBatch] = []
    size = 0

    def taken():
        table = pa.Table.from_batches(held).combine_chunks()
        held.clear()
        return [_flat(table.column(name)) for name in ("doc_id", "text")]

    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(column_of(batch, "text")), 0).to_numpy(), dtype=np.int64)
        first = done = 0
        # the row with which the block is full
        while (last := int(np.searchsorted(ends, done + BLOCK_BYTES - size))) < len(batch):
            held.append(batch.slice(first, last + 1 - first))
            yield taken()
            first, done, size = last + 1, int(ends[last]), 0
        held.append(batch.slice(first))
        size += int(ends[-1]) - done if len(batch) else 0
        batch = ends = None  # freed before the next batch comes
    if sum(len(b) for b in held):
        yield taken()


def _flat(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks) if column.num_chunks != 1 else column.chunk(0)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def aligned_groups(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """One row per document: ``doc_id, n_a, n_b, n_groups, n_links`` and
    ``groups``, the ids of both tokenizers group by group as
    ``a1,a2|b1;a3|b2,b3``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, texts in _blocks(batches):
            block = Block(texts, byte_path, piece_path)
            yield pa.RecordBatch.from_arrays(
                [doc_ids, *(pa.array(block.counts[k]) for k in _DOC), pa.array(block.groups(), pa.binary()).cast(pa.string())],
                ["doc_id", *_DOC, "groups"],
            )
            doc_ids = texts = block = None  # freed before the next block comes
            give_back()

    return _rows(docs).mapInArrow(run, "doc_id bigint, " + ", ".join(f"{k} bigint" for k in _DOC) + ", groups string")


_ARRAYS = {"at": "<i8", "codes": "<u4", "link_at": "<i8", "links": "<u4", "pairs": "<i8", "pair_counts": "<i8"}
_BLOCK = (
    "block bigint, first bigint, doc_ids array<bigint>, " + ", ".join(f"{k} array<bigint>" for k in _DOC)
    + ", groups_sha256 array<string>, " + ", ".join(f"{k} binary" for k in _ARRAYS)
)


def _aligned_blocks(byte_path: str, piece_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for serial, (doc_ids, texts) in enumerate(_blocks(batches)):
            b = Block(texts, byte_path, piece_path)
            shas = [hashlib.sha256(g).hexdigest() if g else "" for g in b.groups()]
            lists = [doc_ids, *(pa.array(b.counts[k]) for k in _DOC), pa.array(shas, pa.string())]
            raw = [np.ascontiguousarray(getattr(b, k), t).view(np.uint8) for k, t in _ARRAYS.items()]
            # the first row of a block has the documents, and each has the arrays' bytes from ``first`` on
            for first in range(0, max(map(len, raw)), _PART_BYTES):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([task << 32 | serial], pa.int64()),
                        pa.array([first], pa.int64()),
                        *(pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists),
                        *(pa.array([x[first : first + _PART_BYTES].tobytes()], pa.binary()) for x in raw),
                    ],
                    [f.split()[0] for f in _BLOCK.split(", ")],
                )
                lists = [x[:0] for x in lists]
            doc_ids = texts = b = shas = raw = lists = None  # freed before the next block comes
            give_back()

    return run


def _block_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = (column_of(batch, c) for c in ("block", "first", "pairs", "pair_counts"))
        for block, first, pairs, counts in zip(*columns, strict=True):
            keys = np.frombuffer(pairs.as_buffer(), "<i8")
            at = first.as_py() // 8
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(keys), block.as_py())),
                    pa.array(np.arange(at, at + len(keys), dtype=np.int32)),
                    pa.array((keys >> 32).astype(np.int32)),
                    pa.array((keys & 0xFFFFFFFF).astype(np.int32)),
                    pa.array(np.frombuffer(counts.as_buffer(), "<i8")),
                ],
                ["block", "place", "a", "b", "n"],
            )


_RESULT = (
    "doc_id bigint, " + ", ".join(f"{k} bigint" for k in [*_DOC, "n_best", "count_sum"]) + ", groups_sha256 string"
)


def _finish(blocks: pa.Table, counted: pa.Table) -> pa.Table:
    """A block's documents with the counts of its pairs."""
    blocks = blocks.sort_by("first")
    row = {c: blocks.column(c)[0] for c in blocks.column_names}
    at, codes, link_at, links = (
        np.frombuffer(b"".join(x.as_buffer() for x in blocks.column(c)), _ARRAYS[c]) for c in ("at", "codes", "link_at", "links")
    )
    count = np.zeros(counted.num_rows, dtype=np.int64)
    best = np.zeros(counted.num_rows, dtype=np.int64)
    place = counted.column("place").to_numpy()
    count[place] = counted.column("count").to_numpy()
    best[place] = counted.column("best").to_numpy()
    n_best, count_sum = (_sums(_sums(x[links], link_at)[codes], at) for x in (best, count))
    names = [f.split()[0] for f in _RESULT.split(", ")]
    values = {"doc_id": row["doc_ids"].values, "groups_sha256": row["groups_sha256"].values}
    values |= {k: row[k].values for k in _DOC} | {"n_best": pa.array(n_best), "count_sum": pa.array(count_sum)}
    return pa.Table.from_arrays([values[c] for c in names], names)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``block, place, count, best``: for each id pair of each block how often it
    is linked in the corpus, and whether no pair of its second id is more often."""
    held = blocks.where("octet_length(pairs) > 0").select("block", "first", "pairs", "pair_counts").mapInArrow(
        _block_pairs, "block bigint, place int, a int, b int, n bigint"
    )
    counts, _ = stage(held.groupBy("a", "b").agg(F.sum("n").alias("count")), "pair-counts")
    # no second id has more pairs than the first vocabulary has ids
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    judged = counts.join(most, "b").select("a", "b", "count", (F.col("count") == F.col("most")).cast("long").alias("best"))
    return held.join(judged, ["a", "b"]).select("block", "place", "count", "best")


def align_documents(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """One row per document: the counts of ``aligned_groups``, the digest of its
    groups, ``n_best`` (links whose count is the highest of their second id) and
    ``count_sum`` (the counts of all its links)."""
    found = _rows(docs).mapInArrow(_aligned_blocks(byte_path, piece_path), _BLOCK)
    with small_batches(docs.sparkSession):
        blocks, _ = stage(found, "aligned", compression="zstd", **_LARGE_ROWS)
    return (
        blocks.drop("pairs", "pair_counts")
        .groupBy("block")
        .cogroup(pair_counts(blocks).groupBy("block"))
        .applyInArrow(_finish, _RESULT)
    )
