"""Records of delimited files with quoted newlines, read in splits.

A line that begins inside a quoted field belongs to the record before it, and
whether it does depends on everything in the file up to there. Each line is a
function of that state: where a line ends, inside or outside a quoted field, given
where it begins. Functions compose, so

1. one pass over the lines composes those of each split, for both beginnings, which
   gives two bits a split;
2. a prefix over a file's splits tells how each begins (the driver holds a start
   and two bits per split, and the files' names);
3. a second pass assembles the records that begin in each split. What a split has of
   a record begun earlier, and the record it leaves open, are fragments; they are put
   together by an aggregation on the record, which is all that is shuffled.

Records are strings that hold their newlines, for ``from_csv``. Python sees whole
Arrow columns only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_KEY = "file string, start bigint, ends_open boolean, ends_open_if_open boolean, closes boolean, crlf boolean, header string"
_PARTS = "file string, start bigint, entered boolean, value string, is_header boolean, whole boolean"


class LineRule:
    """How lines change the state, for one delimiter, quote and comment prefix."""

    def __init__(self, delimiter: str, quote: str, comment: str | None, skip_rows: int, has_header: bool):
        d, q = re.escape(delimiter), re.escape(quote)
        inner = f"(?:[^{q}]|{q}{q})*"
        after = f"(?:[^{d}{q}][^{d}]*)?"  # what follows a closing quote up to the delimiter
        plain = f"(?:[^{d}{q}][^{d}]*)?"
        fields = f"(?:(?:{q}{inner}{q}{after}|{plain}){d})*"
        self.quote, self.comment, self.skip_rows, self.has_header = quote, comment, skip_rows, has_header
        # the line's last field opens a quote and does not close it
        self.opens = f"^{fields}{q}{inner}$"
        # from inside a field: it is not closed, or closed and another one opened
        self.stays = f"^(?:{inner}|{inner}{q}{after}{d}{fields}{q}{inner})$"

    def ends(self, lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Whether each line ends inside a field, if it begins outside and inside."""
        outside, inside = np.zeros(len(lines), dtype=bool), np.ones(len(lines), dtype=bool)
        quoted = np.flatnonzero(_bools(pc.match_substring(lines, self.quote)))
        if len(quoted):
            some = lines.take(pa.array(quoted))
            outside[quoted] = _bools(pc.match_substring_regex(some, f"(?s){self.opens}"))
            inside[quoted] = _bools(pc.match_substring_regex(some, f"(?s){self.stays}"))
            if self.comment:  # a comment outside a field is skipped whole
                outside &= ~_bools(pc.starts_with(lines, self.comment))
        return outside, inside


    def first_of(self, lines: pa.Array) -> str | None:
        """The first line that is neither empty nor a comment, of lines outside fields."""
        for line in lines:
            text = line.as_py().removesuffix("\r")
            if text and not (self.comment and text.startswith(self.comment)):
                return text
        return None


def _bools(values: pa.Array) -> np.ndarray:
    return pc.fill_null(values, False).to_numpy(zero_copy_only=False)


def states(outside: np.ndarray, inside: np.ndarray, begins: bool) -> np.ndarray:
    """The state before each line and after the last, given the state before the
    first: the last line that ends alike from both states decides, and the lines
    since then that turn the state around are counted."""
    same = outside == inside
    turns = outside & ~inside
    at = np.where(same, np.arange(1, len(same) + 1), 0)
    last = np.maximum.accumulate(np.append(0, at))
    value = np.append(begins, outside)[last]
    turned = np.append(0, np.cumsum(turns))
    return value ^ ((turned - turned[last]) % 2 == 1)


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
    )


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, tuple[str, int]]]:
    """The lines of each split in a batch."""
    files = batch.column(1).dictionary_encode()
    code, start = files.indices.to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero((np.diff(code) != 0) | (np.diff(start) != 0)) + 1
    edges = [0, *cuts.tolist(), batch.num_rows]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        if b > a:
            yield batch.column(0).slice(a, b - a), (files.dictionary[int(code[a])].as_py(), int(start[a]))


def _skipped(rule: LineRule, split: tuple[str, int], seen: int, lines: pa.Array) -> pa.Array:
    """The lines after those to be skipped at a file's beginning."""
    return lines.slice(min(max(rule.skip_rows - seen, 0), len(lines))) if split[1] == 0 else lines


def _compose(rule: LineRule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], list] = {}
        for batch in batches:
            for lines, split in _runs(batch):
                f = found.setdefault(split, [False, True, 0, False, False, None])
                if f[2] == 0 and split[1] == 0:
                    f[4] = lines[0].as_py().endswith("\r")
                kept = _skipped(rule, split, f[2], lines)
                f[2] += len(lines)
                if f[5] is None and split[1] == 0:
                    f[5] = rule.first_of(kept)
                outside, inside = rule.ends(kept)
                after = [states(outside, inside, s) for s in f[:2]]
                f[3] = f[3] or not after[1].all()
                f[0], f[1] = (bool(a[-1]) for a in after)
        rows = [(*split, f[0], f[1], f[3], f[4], f[5]) for split, f in found.items()]
        kinds = [pa.string(), pa.int64(), *[pa.bool_()] * 4, pa.string()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], [c.split()[0] for c in _KEY.split(", ")]
        )

    return run


class Splits:
    """The splits of a file: their starts, whether each begins inside a field, and
    the place of the last split up to each in which a record begins that it
    may leave open. ``crlf``: its lines end with both characters; as in Spark's scan
    a newline within a field is then one character. ``header``: its first line of data."""

    def __init__(self, starts: np.ndarray, inside: np.ndarray, closes: np.ndarray, crlf: bool, header: str | None):
        self.starts, self.inside, self.crlf, self.header = starts, inside, crlf, header
        self.begun = np.maximum.accumulate(np.where(~inside | closes, np.arange(len(starts)), 0))

    def at(self, start: int) -> int:
        place = int(np.searchsorted(self.starts, start))
        if place == len(self.starts) or self.starts[place] != start:
            raise ValueError("the files are split in another way than a moment ago; read them again")
        return place


def split_states(spark: SparkSession, paths: list[str], rule: LineRule) -> dict[str, Splits]:
    found = _lines(spark, paths).mapInArrow(_compose(rule), _KEY).toArrow().sort_by([("file", "ascending"), ("start", "ascending")])
    start = found.column("start").to_numpy()
    outside, inside, closes, crlf = (
        _bools(found.column(c).combine_chunks()) for c in ("ends_open", "ends_open_if_open", "closes", "crlf")
    )
    files = found.column("file").combine_chunks().dictionary_encode()
    code = files.indices.to_numpy(zero_copy_only=False)
    header = found.column("header").to_pylist()
    out = {}
    for i, name in enumerate(files.dictionary.to_pylist()):
        some = code == i
        first = int(np.flatnonzero(some)[0])
        out[name] = Splits(
            start[some], states(outside[some], inside[some], False)[:-1], closes[some], bool(crlf[first]), header[first]
        )
    return out


class _Split:
    """A split as its lines come: the state, the lines so far, those of the record
    that is open, and whether that one began in an earlier split."""

    def __init__(self, begins_inside: bool, crlf: bool):
        self.state, self.lines, self.open, self.entered, self.headed = begins_inside, 0, [], begins_inside, False
        self.crlf = crlf


def _assemble(rule: LineRule, known):
    """Per split: its whole records; what it has of one begun earlier
    (``entered``); and the record it leaves open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, key = None, None

        def rows(split, values: pa.Array, entered: bool, whole: bool, header: np.ndarray | None = None):
            n = len(values)
            return pa.RecordBatch.from_arrays(
                [pa.array([split[0]] * n, pa.string()), pa.array([split[1]] * n, pa.int64()), pa.array([entered] * n, pa.bool_()),
                 values, pa.array(np.zeros(n, dtype=bool) if header is None else header), pa.array([whole] * n, pa.bool_())],
                [c.split()[0] for c in _PARTS.split(", ")],
            )

        def closed():
            """What a split leaves open goes on in the next one."""
            if current is not None and current.open:
                yield rows(key, pa.array(["\n".join(current.open)], pa.string()), current.entered, False)

        for batch in batches:
            for lines, split in _runs(batch):
                if split != key:
                    yield from closed()
                    splits = known.value[split[0]]
                    current, key = _Split(bool(splits.inside[splits.at(split[1])]), splits.crlf), split
                yield from take(rule, current, split, lines, rows)
        yield from closed()

    return run


def take(rule: LineRule, split: _Split, key: tuple[str, int], lines: pa.Array, rows) -> Iterator[pa.RecordBatch]:
    kept = _skipped(rule, key, split.lines, lines)
    split.lines += len(lines)
    kept = kept.fill_null("")
    outside, inside = rule.ends(kept)
    state = states(outside, inside, split.state)
    split.state = bool(state[-1])
    begins = ~state[:-1]
    if rule.comment:
        drop = begins & _bools(pc.starts_with(kept, rule.comment))
        kept, begins, ends = kept.filter(pa.array(~drop)), begins[~drop], ~state[1:][~drop]
    else:
        ends = ~state[1:]
    done = np.flatnonzero(ends)
    if not len(done):
        split.open += kept.to_pylist()
        return
    first = 0
    if split.open or split.entered:  # the record that was open ends here
        first = int(done[0]) + 1
        value = pa.array(["\n".join([*split.open, *kept.slice(0, first).to_pylist()])], pa.string())
        if split.entered:
            yield rows(key, value, True, False)
        else:
            yield whole(rule, split, key, value, rows)
        split.open, split.entered = [], False
    rest = int(done[-1]) + 1
    if rest > first:
        at = np.append(np.flatnonzero(begins[first:rest]), rest - first).astype(np.int32)
        middle = pa.ListArray.from_arrays(pa.array(at), kept.slice(first, rest - first).cast(pa.string()))
        yield whole(rule, split, key, pc.binary_join(middle, "\n"), rows)
    split.open = kept.slice(rest).to_pylist()


def whole(rule: LineRule, split: _Split, key: tuple[str, int], records: pa.Array, rows) -> pa.RecordBatch:
    """Records that begin and end in a split, empty lines left out; the first of
    a file is its header."""
    if split.crlf:
        records = pc.replace_substring(records, "\r\n", "\n")
    if _bools(pc.ends_with(records, "\r")).any():
        records = pc.replace_substring_regex(records, r"\r\z", "")
    records = records.filter(pc.not_equal(records, ""))
    header = np.zeros(len(records), dtype=bool)
    if rule.has_header and key[1] == 0 and not split.headed and len(records):
        header[0] = split.headed = True
    return rows(key, records, False, True, header)


def read_records(spark: SparkSession, paths: list[str], rule: LineRule, known: dict[str, Splits]) -> DataFrame:
    """``value`` (a record's text, its newlines included) and ``is_header``.
    ``known``: the ``split_states`` of the paths. The skipped lines and the header are
    expected in a file's first split."""
    parts = _lines(spark, paths).mapInArrow(_assemble(rule, spark.sparkContext.broadcast(known)), _PARTS)
    records = parts.where("whole").select("value", "is_header")
    if not any(splits.inside.any() for splits in known.values()):
        return records
    return records.unionByName(_joined(spark, parts.where("not whole"), known))


def _joined(spark: SparkSession, fragments: DataFrame, known: dict[str, Splits]) -> DataFrame:
    """Records that lie in several splits, put together. A record is named after
    the split it began in."""
    names = spark.sparkContext.broadcast(known)

    def owner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners, crlf = [], []
            for file, start, entered in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                splits = names.value[file]
                crlf.append(splits.crlf)
                owners.append(int(splits.starts[splits.begun[splits.at(start) - 1]]) if entered else start)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(owners, pa.int64()), batch.column(1), batch.column(3), pa.array(crlf, pa.bool_())],
                ["file", "record", "start", "value", "crlf"],
            )

    owned = fragments.select("file", "start", "entered", "value").mapInArrow(
        owner, "file string, record bigint, start bigint, value string, crlf boolean"
    )
    pieces = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "value"))), lambda x: x["value"]), "\n")
    joined = owned.groupBy("file", "record").agg(pieces.alias("value"), F.bool_or("crlf").alias("crlf")).select(
        F.when(F.col("crlf"), F.replace("value", F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("value")).alias("value")
    ).select(F.regexp_replace("value", "\r\\z", "").alias("value"))
    return joined.where("value <> ''").select("value", F.lit(False).alias("is_header"))
