"""Encoding texts with a public tokenizer inside tasks.

The ids of a text are those that the ``tokenizers`` library gives for the whole
text. Such a tokenizer cuts a text into pieces (a word, a number, a run of
marks) before it merges, and a piece's ids depend on nothing around it. So the
bytes of a whole Arrow column are classed and cut with numpy at the same places,
the pieces are numbered by dictionary encoding, each distinct piece is merged
once by the library's model, as long as a worker remembers it, and the ids of
all texts are gathered with numpy.

Texts go to the library whole where the pieces could come out otherwise: if
they hold the string of an added token, or a character that Unicode versions
class differently or that normalisation may join to another. So does every text
of a tokenizer whose file is of no known form.
"""

from __future__ import annotations

import contextlib
import ctypes
import json
import os
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

END_ID = 1
_PIECES = 300_000  # distinct pieces remembered per worker
_PIECE_BYTES = 1 << 24  # and their bytes
_JOINED = 1000  # new pieces merged in one call
_GATHERED = 1 << 15  # pieces whose ids are gathered at once
_BLOCK_BYTES = 1 << 20  # text whose pieces are numbered at once
_CUT_BYTES = 1 << 18  # text that is cut at once; the temporary arrays take about 50 times as much

# Unicode's white space.
_SPACES = frozenset([*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
_ASCII_SPACE = np.array([b < 128 and b in _SPACES for b in range(256)])
_WIDE_SPACES = np.array([p for p in sorted(_SPACES) if p > 127])

# Classes of characters: letter, number, other, the space, other white space,
# those to be left to the library, and those not looked up yet.
_L, _N, _O, _S, _W, _ODD, _NEW = range(7)
_ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")  # that go with an apostrophe before them

_WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_LOADED: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, special: bool = True) -> Encoder:
    """The task's encoder for a tokenizer file; loaded once per worker. Strings
    of added tokens get their ids as by the library's default, or with
    ``special=False`` are ordinary text."""
    key = (path, special)
    if key not in _LOADED:
        _LOADED[key] = Encoder(path, special)
    return _LOADED[key]


def byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    same = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in same]
    return {b: chr(b) for b in same} | {b: chr(256 + i) for i, b in enumerate(others)}


def _kind(c: str, data) -> int:
    if ord(c) in _SPACES:
        return _S if c == " " else _W
    return {"L": _L, "N": _N}.get(data.category(c)[0], _O)


def _class_of(c: str, joins: bool) -> int:
    """The class of a character, if all Unicode versions since 3.2 agree and, with
    ``joins``, normalisation leaves it and its neighbours alone and small letters
    are one to one."""
    kind = _kind(c, unicodedata)
    if c.isascii():
        return kind
    if kind != _kind(c, unicodedata.ucd_3_2_0) or unicodedata.category(c) == "Cn":
        return _ODD
    if joins and (
        unicodedata.category(c)[0] == "M" or 0x1100 <= ord(c) <= 0x11FF or c == "\u03a3"
        or len(c.lower()) != 1 or not unicodedata.is_normalized("NFC", c)
    ):
        return _ODD
    return kind


def give_back() -> None:
    """Return memory that earlier tasks of this worker have freed to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)  # glibc only


class Encoder:
    def __init__(self, path: str, special: bool = True):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        give_back()
        from tokenizers import Tokenizer, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = not special
        added = self._tokenizer.get_added_tokens_decoder().values()
        self._added = [t.content for t in added] if special else []
        self._form = None if any(not t.special for t in added) else self._known_form(self._tokenizer)
        self._words = self._form == "words"
        # the model alone, over pieces that are written in its letters already
        self._bare = Tokenizer(self._tokenizer.model)
        self._bare.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        # the letter of each byte, and the space that parts pieces
        letters = [x.encode("utf-8") for _, x in sorted(byte_letters().items())] + [b" "]
        self._letters = np.array([list(x.ljust(2, b"\0")) for x in letters], dtype=np.uint8)
        self._letter_bytes = np.array([[True, len(x) > 1] for x in letters])
        names = self.names = [self._tokenizer.id_to_token(i) or "" for i in range(self._tokenizer.get_vocab_size())]
        self._id_bytes = np.array([len(n.removesuffix("</w>") if self._words else n) for n in names], dtype=np.int64)
        self._classes = np.full(0x110000, _NEW, dtype=np.uint8)
        self._forget()
        give_back()

    @staticmethod
    def _known_form(tokenizer) -> str | None:
        model = tokenizer.model
        if type(model).__name__ != "BPE" or model.dropout or model.byte_fallback or model.ignore_merges:
            return None
        if model.continuing_subword_prefix or model.unk_token:
            return None
        # the parts as the file describes them, without its vocabulary
        pre, norm = (json.loads(x.__getstate__()) if x else {} for x in (tokenizer.pre_tokenizer, tokenizer.normalizer))
        byte_level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True}
        if pre == byte_level | {"use_regex": True} and not norm and not model.end_of_word_suffix:
            return "bytes"
        split = {"type": "Split", "pattern": {"Regex": _WORD_SPLIT}, "behavior": "Removed", "invert": True}
        lower = [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
            {"type": "Lowercase"},
        ]
        if (
            pre == {"type": "Sequence", "pretokenizers": [split, byte_level | {"use_regex": False}]}
            and norm == {"type": "Sequence", "normalizers": lower}
            and model.end_of_word_suffix == "</w>"
        ):
            return "words"
        return None

    # ------------------------------------------------------------- pieces and their ids

    def _forget(self) -> None:
        """An empty table; entry 0 has no ids."""
        self._known = pa.chunked_array([pa.array([""], pa.large_string())])
        self._ids = np.zeros(1 << 16, dtype=np.uint32)
        self._start = np.zeros(1 << 14, dtype=np.int64)
        self._count = np.zeros(1 << 14, dtype=np.int64)
        self._blocks = np.zeros(1 << 14, dtype=np.int64)  # blocks that a piece occurred in
        self._used = 0

    def _shrink(self) -> None:
        """Keep the pieces that more than one block held, if these are few enough."""
        known, ids, start, count = self._known, self._ids, self._start, self._count
        slots = np.flatnonzero(self._blocks[: len(known)] > 1)
        slots = slots[slots > 0]
        self._forget()
        kept = known.take(pa.array(slots)).combine_chunks()
        if len(slots) <= _PIECES // 2 and kept.nbytes <= _PIECE_BYTES // 2:
            self._append(kept, gather(ids, start[slots], count[slots]), count[slots])
        del known, kept, ids, start, count
        give_back()

    def _append(self, pieces: pa.Array, ids: np.ndarray, counts: np.ndarray) -> None:
        held, used = len(self._known), self._used
        end = held + len(pieces)
        while end > len(self._start):
            for name in ("_start", "_count", "_blocks"):
                old = getattr(self, name)
                setattr(self, name, np.concatenate([old, np.zeros_like(old)]))
        while used + len(ids) > len(self._ids):
            self._ids = np.concatenate([self._ids, np.zeros_like(self._ids)])
        self._ids[used : used + len(ids)] = ids
        self._count[held:end] = counts
        self._start[held:end] = used + np.cumsum(counts) - counts
        self._blocks[held:end] = 0
        self._known = pa.chunked_array([*self._known.chunks, pieces])
        self._used = used + len(ids)

    def _bare_words(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of pieces in small letters and without white space."""
        keep = ~_ASCII_SPACE[data]
        points, places = code_points(data)
        wide = np.isin(points, _WIDE_SPACES)
        for k in range(3):  # of two or three bytes
            keep[places[wide & (points >= (0x800 if k == 2 else 0))] + k] = False
        ends = np.append(0, np.cumsum(keep))[ends]
        # a space after each piece, as small letters may differ in width
        joined = np.insert(data[keep], ends[1:], ord(" ")).tobytes().decode("utf-8").lower().encode("utf-8")
        data = np.frombuffer(joined, np.uint8)
        parted = data == ord(" ")
        return data[~parted], np.append(0, np.flatnonzero(parted) - np.arange(len(ends) - 1))

    def _learn(self, pieces: pa.Array) -> None:
        """Merge new pieces. Many are joined to one text for the model; an id covers
        a known number of bytes, which tells where a piece's ids end."""
        data, ends = bytes_of(pieces)
        if self._words:
            data, ends = self._bare_words(data, ends)
        sizes = np.diff(ends)
        some = np.flatnonzero(sizes)  # the others have no ids
        counts = np.zeros(len(pieces), dtype=np.int64)
        codes = np.insert(data.astype(np.uint16), ends[some + 1], 256)
        ends = np.append(0, np.cumsum(sizes[some] + 1))
        ids = [np.zeros(0, np.uint32)]
        for at in range(0, len(some), _JOINED):
            now = some[at : at + _JOINED]
            part = codes[ends[at] : ends[at + len(now)] - 1]
            text = self._letters[part][self._letter_bytes[part]].tobytes().decode("utf-8")
            found = self._bare.encode_batch_fast([text], add_special_tokens=False)[0]
            ids.append(np.array(found.ids, dtype=np.uint32))
            last = np.searchsorted(np.cumsum(self._id_bytes[ids[-1]]), np.cumsum(sizes[now])) + 1
            counts[now] = np.diff(last, prepend=0)
        self._append(pieces, np.concatenate(ids), counts)

    def _slots(self, dictionary: pa.Array) -> np.ndarray:
        if len(self._known) + len(dictionary) > _PIECES or self._known.nbytes > _PIECE_BYTES:
            self._shrink()
        # the block's few pieces are hashed and the known ones looked up among
        # them, not the other way round, as a table is made anew each time
        places = pc.fill_null(pc.index_in(self._known, value_set=dictionary), -1).to_numpy()
        hits = np.flatnonzero(places >= 0)
        slots = np.full(len(dictionary), -1, dtype=np.int64)
        slots[places[hits]] = hits
        new = slots < 0
        if new.any():
            slots[new] = np.arange(len(self._known), len(self._known) + np.count_nonzero(new))
            self._learn(dictionary.filter(pa.array(new)))
        return slots

    # --------------------------------------------------------------------------- texts

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=np.uint32) for e in found]

    def _cuts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the pieces of some texts begin, and which texts are to go to the
        library. ``data``: the texts' UTF-8 bytes; ``offsets``: where each begins."""
        n = len(data)
        at, where = code_points(data)
        classes = np.empty(n, dtype=np.uint8)
        self._look_up(np.arange(128))
        np.take(self._classes[:256], data, out=classes)
        self._look_up(at)
        classes[where] = self._classes[at]
        text = np.searchsorted(offsets, np.flatnonzero(classes == _ODD), side="right") - 1
        # classes of whole characters, by their first bytes
        first = np.flatnonzero((data & 0xC0) != 0x80)
        c = classes[first]
        begin = np.zeros(n + 1, dtype=bool)
        begin[offsets] = True
        begin = begin[:n][first]
        white = (c == _S) | (c == _W)
        change = np.ones(len(c), dtype=bool)
        change[1:] = c[1:] != c[:-1]
        starts = change.copy()
        starts[1:] &= ~(white[1:] & white[:-1])
        if self._form == "words":
            starts |= c == _N
        else:
            # the last white space before something else stands apart, and
            # a space goes with what follows
            last = np.zeros(len(c), dtype=bool)
            last[:-1] = white[:-1] & ~white[1:] & ~begin[1:]
            starts |= last
            after = np.zeros(len(c), dtype=bool)
            after[1:] = (c[:-1] == _S) & ~white[1:]
            starts &= ~after
        starts |= begin
        self._endings(data, first, begin, starts)
        if self._form == "words":
            # white space has no ids: it goes with the word after it
            starts[1:] &= ~white[:-1] | white[1:] | begin[1:]
        return first[starts], text

    def _endings(self, data: np.ndarray, first: np.ndarray, begin: np.ndarray, starts: np.ndarray) -> None:
        """An apostrophe that begins a piece takes a following ending with it."""
        marks = np.flatnonzero(starts & (data[first] == ord("'")))
        if not len(marks):
            return
        chars = np.append(data[first], [0, 0]).astype(np.uint8)
        if self._form == "words":
            chars = np.where((chars >= 65) & (chars <= 90), chars + 32, chars)
        edge = np.append(begin, [True, True])
        for ending in _ENDINGS:
            fits = np.ones(len(marks), dtype=bool)
            for k, letter in enumerate(ending, 1):
                fits &= (chars[np.minimum(marks + k, len(chars) - 1)] == ord(letter)) & ~edge[
                    np.minimum(marks + k, len(edge) - 1)
                ]
            found = marks[fits]
            starts[found + 1] = False
            end = found + len(ending) + 1
            starts[end[end < len(starts)]] = True

    def _look_up(self, points: np.ndarray) -> None:
        new = np.unique(points[self._classes[points] == _NEW])
        self._classes[new] = [_class_of(chr(p), self._words) for p in new.tolist()]

    def _block(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        n = len(column)
        if self._form is None:
            return join_arrays(self._whole(column.to_pylist()))
        data, ends = bytes_of(column)
        odd = np.zeros(n, dtype=bool)
        found, row = [np.zeros(0, np.int64)], 0
        for part in blocks_of(column, _CUT_BYTES):
            a, b = ends[row], ends[row + len(part)]
            if a < b:
                starts, left = self._cuts(data[a:b], ends[row : row + len(part) + 1] - a)
                found.append(starts + a)
                odd[row + left] = True
            row += len(part)
        starts = np.concatenate(found)
        del found
        for string in self._added:
            odd |= pc.match_substring(column, string).to_numpy(zero_copy_only=False)
        pieces = pa.LargeStringArray.from_buffers(
            len(starts), pa.py_buffer(np.append(starts, len(data)).astype(np.int64)), pa.py_buffer(data)
        )
        at = np.searchsorted(starts, ends)  # the first piece of each text
        left = np.repeat(odd, np.diff(at))
        coded = pieces.dictionary_encode()
        codes = np.asarray(coded.indices)
        used = np.zeros(len(coded.dictionary), dtype=bool)
        used[codes[~left]] = True
        slots = np.zeros(len(used), dtype=np.int32)
        slots[used] = self._slots(coded.dictionary.filter(pa.array(used)))
        self._blocks[slots] += 1
        slots = slots[codes]
        slots[left] = 0  # no ids from pieces
        del starts, pieces, coded, codes
        counts = self._count[slots]
        offsets = np.append(0, np.cumsum(counts))[at]
        ids = gather(self._ids, self._start[slots], counts)
        if not odd.any():
            return ids, offsets
        rows = [ids[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        rest = np.flatnonzero(odd)
        for i, found in zip(rest.tolist(), self._whole(column.take(pa.array(rest)).to_pylist()), strict=True):
            rows[i] = found
        return join_arrays(rows)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a string column one after the other, and where
        each text's begin (with the end as the last). Null counts as empty."""
        found = [self._block(part) for part in blocks_of(texts)]
        if not found:
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        sizes = np.concatenate([np.diff(offsets) for _, offsets in found])
        return np.concatenate([ids for ids, _ in found]), np.append(0, np.cumsum(sizes))

    def encode_all(self, texts: pa.Array, end_id: int = END_ID) -> list[np.ndarray]:
        """The ids of each text, ``end_id`` after them."""
        ids, offsets = self.encode(texts)
        ids = np.insert(ids, offsets[1:], np.uint32(end_id))
        offsets = (offsets + np.arange(len(offsets))).tolist()
        return [ids[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def blocks_of(texts: pa.Array, size: int = 0) -> Iterator[pa.Array]:
    """Slices of a string column of ``size`` bytes at most, or one longer text.
    Null counts as empty."""
    size = size or _BLOCK_BYTES
    column = texts.fill_null("") if texts.null_count else texts
    ends = np.cumsum(np.asarray(pc.binary_length(column), dtype=np.int64))
    row, done = 0, 0
    while row < len(column):
        end = max(int(np.searchsorted(ends, done + size, side="right")), row + 1)
        yield column.slice(row, end - row)
        row, done = end, int(ends[end - 1])


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column without nulls, and where each text's begin."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data_buffer, dtype=np.uint8) if data_buffer is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all characters beyond ASCII, and the places of their first bytes."""
    places, points = [], []
    for low, high, more in ((0xC0, 0xE0, 1), (0xE0, 0xF0, 2), (0xF0, 0xF8, 3)):
        at = np.flatnonzero((data >= low) & (data < high))
        point = data[at].astype(np.int64) & (0x3F >> more)
        for k in range(1, more + 1):
            point = point << 6 | (data[at + k] & 0x3F)
        places.append(at)
        points.append(point)
    return np.concatenate(points), np.concatenate(places)


def gather(values: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``values[start : start + count]`` of all entries, one after the other."""
    ends = np.cumsum(counts)
    out = np.empty(int(ends[-1]) if len(ends) else 0, dtype=values.dtype)
    for a in range(0, len(counts), _GATHERED):
        few, end = counts[a : a + _GATHERED], ends[a : a + _GATHERED]
        done = int(end[0] - few[0])
        places = np.repeat(starts[a : a + _GATHERED] - end + few, few)
        places += np.arange(done, done + len(places))
        out[done : done + len(places)] = values[places]
    return out


def join_arrays(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(r) for r in rows], dtype=np.int64)
    return np.concatenate([np.zeros(0, np.uint32), *rows]), np.append(0, np.cumsum(sizes))
