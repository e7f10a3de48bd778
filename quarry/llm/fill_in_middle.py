"""Fill-in-the-middle documents, cut at line ends through an indexable skip list.

A text's lines are the units. They form a skip list whose lowest lane links each
unit to the next; every lane above keeps one node in ``FAN`` of the lane below.
A link is as wide as what it skips, in units and in code points. A cut after a
number of units is found from the top lane down: links are followed while they
stay within the rank, and the code points they skip add up to the cut's place in
the text, so the lines before a cut are neither joined nor measured again.

The middle lies between two cut ranks. Whether a text is cut, where, and in which
order the parts are written follow from a hash of its identifier, so reruns agree.
``restore`` puts the parts of an output in order again, exactly.

Defined results: null counts as empty; texts without units, and texts that
contain one of the marks, are ``plain`` and stay as they are; a missing identifier
hashes as the empty string; rows that agree in identifier are cut at the same
ranks, and repeated rows come as often as they occur; a very long text costs its
length plus one descent a cut; an empty table gives an empty result; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import column_of

FAN = 8
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_ROWS = 1000  # documents written to one Arrow batch


class SkipList:
    """Units with a width in code points each. ``lanes[k]`` lists the links of
    lane k as (units, code points); link i begins where link ``i * FAN`` of the
    lane below does."""

    def __init__(self, widths: list[int]):
        self.units = len(widths)
        lane = [(1, w) for w in widths]
        self.lanes = [lane]
        while len(lane) > FAN:
            lane = [
                (sum(u for u, _ in lane[i : i + FAN]), sum(w for _, w in lane[i : i + FAN]))
                for i in range(0, len(lane), FAN)
            ]
            self.lanes.append(lane)

    def place(self, rank: int) -> int:
        """Code points before the unit of this rank; after the last unit for
        the number of units."""
        if not 0 <= rank <= self.units:
            raise IndexError(rank)
        node, passed, place = 0, 0, 0
        for lane in reversed(self.lanes):
            while node < len(lane) and passed + lane[node][0] <= rank:
                passed += lane[node][0]
                place += lane[node][1]
                node += 1
            node *= FAN  # the same node, a lane down
        return place


def line_widths(text: str) -> list[int]:
    """Code points of each line, its newline included."""
    widths = [len(line) + 1 for line in text.split("\n")]
    widths[-1] -= 1
    return widths if widths[-1] else widths[:-1]


class Cut(NamedTuple):
    units: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    output: str


def transform(text: str | None, key: str, rate: int = 100, spm: int = 50) -> Cut:
    """One text's fill-in-the-middle form. ``key`` is hashed for the choices;
    ``rate`` percent of texts are cut, ``spm`` percent of those suffix first."""
    text = text or ""
    widths = line_widths(text)
    n = len(widths)
    digest = hashlib.sha256(key.encode("utf-8")).digest()
    h1, h2, h3, h4 = (int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))
    if not text or h3 % 100 >= rate or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return Cut(n, "plain", None, None, text)
    first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
    units = SkipList(widths)
    a, b = units.place(first), units.place(last)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm:
        return Cut(n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}")
    return Cut(n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}")


def restore(output: str, form: str) -> str:
    """The text that ``transform`` was given."""
    if form == "plain":
        return output
    outer, _, middle = output.partition(MIDDLE)
    if form == "psm":
        prefix, _, suffix = outer.removeprefix(PREFIX).partition(SUFFIX)
    elif form == "spm":
        suffix, _, prefix = outer.removeprefix(SUFFIX).partition(PREFIX)
    else:
        raise ValueError(f"unknown form {form!r}")
    return prefix + middle + suffix


def _by_rows(run: Callable[[pa.RecordBatch], pa.RecordBatch]):
    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for at in range(0, len(batch), _ROWS):
                yield run(batch.slice(at, _ROWS))

    return batches


def fill_in_middle(docs: DataFrame, salt: str = "7:", rate: int = 100, spm: int = 50) -> DataFrame:
    """One row per document: ``doc_id``, ``n`` units, ``form`` (plain, psm or
    spm), ``prefix_chars``, ``middle_chars`` and ``output``."""
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = column_of(batch, "key").to_pylist()
        texts = column_of(batch, "text").to_pylist()
        cuts = [transform(t, salt + k, rate, spm) for t, k in zip(texts, keys, strict=True)]
        columns = list(zip(*cuts, strict=True))
        return pa.RecordBatch.from_arrays(
            [column_of(batch, "doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
            ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
        )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("key"),
    )
    return rows.mapInArrow(
        _by_rows(run),
        "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string",
    )


def restored(cut: DataFrame) -> DataFrame:
    """The rows of ``fill_in_middle`` with ``text``, rebuilt from output and form."""
    names = cut.columns

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        outputs, forms = column_of(batch, "output").to_pylist(), column_of(batch, "form").to_pylist()
        texts = [restore(o, f) for o, f in zip(outputs, forms, strict=True)]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*names, "text"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema.fields)
    return cut.mapInArrow(_by_rows(run), f"{fields}, text string")


def with_digests(cut: DataFrame) -> DataFrame:
    """``output_sha256`` and ``restored_sha256`` in place of the output."""
    return restored(cut).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("text", 256).alias("restored_sha256"),
    )
