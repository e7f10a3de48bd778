"""xlsx workbooks.

Files are listed and read by Spark's ``binaryFile`` source (any Hadoop file
system); each workbook is one row, parsed by ``mapInArrow`` on an executor with
the standard library (``zipfile`` + ``xml.etree``), one workbook per task at a
time. Only the first sheet is read; every cell becomes text; the header row is
kept as data; columns are ``col0 .. colN-1``. The sheet's range runs from its
first to its last used row and column, like the reference's reader, with empty
cells as ``""``.

Column count: with ``width`` given, one pass. Otherwise the parsed rows are
landed once as Parquet under the shared checkpoint directory, the widest row
is found with one aggregate over them, and narrower workbooks get nulls in the
extra columns. No workbook is parsed twice.
"""

from __future__ import annotations

import io
import re
import zipfile
from decimal import Decimal
from xml.etree import ElementTree as ET

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.encoding import qcol
from quarry.session import materialize_frame, ship_package

# Fixed XML namespaces and part names of the xlsx (Office Open XML) package.
NS_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
NS_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
NS_PKG_REL = "http://schemas.openxmlformats.org/package/2006/relationships"
WORKBOOK_PART = "xl/workbook.xml"
WORKBOOK_RELS = "xl/_rels/workbook.xml.rels"
SHARED_STRINGS = "xl/sharedStrings.xml"
COLUMN_FORMAT = "col{}"
# The reader's error messages for an empty sheet and a
# workbook without sheets.
NO_DATA = "No data in Excel sheet"
NO_SHEET = "No sheet found"

_REF = re.compile(r"^([A-Z]+)([0-9]+)$")
ROWS_SCHEMA = "source string, row_no bigint, cells array<string>"


class UnsupportedWorkbook(ValueError):
    pass


def _q(tag: str) -> str:
    return f"{{{NS_MAIN}}}{tag}"


def _col_index(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def number_text(raw: str) -> str:
    """A numeric cell as text, the way a Rust float prints: shortest digits,
    no exponent, no trailing ``.0``."""
    try:
        x = float(raw)
    except ValueError:
        return raw
    if x != x:
        return "NaN"
    if x in (float("inf"), float("-inf")):
        return "inf" if x > 0 else "-inf"
    text = format(Decimal(repr(x)), "f")
    if "." in text:
        text = text.rstrip("0").rstrip(".")
    if text == "-0":
        return "-0"
    return text


def _text_of(el) -> str:
    """Text of a shared or inline string item: its own ``<t>`` or the ``<t>``
    of its rich-text runs ``<r>``. Phonetic runs (``<rPh>``) are not text."""
    parts = []
    for child in el:
        if child.tag == _q("t"):
            parts.append(child.text or "")
        elif child.tag == _q("r"):
            t = child.find(_q("t"))
            if t is not None:
                parts.append(t.text or "")
    return "".join(parts)


def _check_format(data: bytes) -> zipfile.ZipFile:
    if data[:4] == b"\xd0\xcf\x11\xe0":
        raise UnsupportedWorkbook("legacy .xls workbooks are not supported; save as .xlsx")
    try:
        zf = zipfile.ZipFile(io.BytesIO(data))
    except zipfile.BadZipFile as e:
        raise UnsupportedWorkbook("not an xlsx workbook") from e
    names = set(zf.namelist())
    if WORKBOOK_PART not in names:
        if "xl/workbook.bin" in names:
            raise UnsupportedWorkbook(".xlsb workbooks are not supported; save as .xlsx")
        if "mimetype" in names or "content.xml" in names:
            raise UnsupportedWorkbook(".ods workbooks are not supported; save as .xlsx")
        raise UnsupportedWorkbook("not an xlsx workbook")
    return zf


def _first_sheet_part(zf: zipfile.ZipFile) -> str:
    wb = ET.fromstring(zf.read(WORKBOOK_PART))
    sheets = wb.find(_q("sheets"))
    if sheets is None or len(sheets) == 0:
        raise ValueError(NO_SHEET)
    rid = sheets[0].get(f"{{{NS_REL}}}id")
    rels = ET.fromstring(zf.read(WORKBOOK_RELS))
    for rel in rels.iter(f"{{{NS_PKG_REL}}}Relationship"):
        if rel.get("Id") == rid:
            target = rel.get("Target")
            if target.startswith("/"):
                return target.lstrip("/")
            return "xl/" + target
    raise ValueError("first sheet has no part in the workbook relations")


def _cell_text(c, shared: list[str]) -> str:
    """A cell's value as text (shared/inline strings, booleans, errors,
    formula strings, ISO dates as stored, numbers as a Rust float prints)."""
    t = c.get("t", "n")
    v = c.find(_q("v"))
    raw = v.text if v is not None else None
    if t == "s":
        return shared[int(raw)] if raw is not None else ""
    if t == "inlineStr":
        is_el = c.find(_q("is"))
        return _text_of(is_el) if is_el is not None else ""
    if t == "b":
        return "" if raw is None else ("true" if raw.strip() in ("1", "true") else "false")
    if t in ("str", "e", "d"):
        return raw or ""
    return "" if raw is None else number_text(raw)


def workbook_rows(data: bytes) -> list[list[str]]:
    """Rows of the first sheet of an xlsx workbook, every cell as text."""
    zf = _check_format(data)
    shared: list[str] = []
    if SHARED_STRINGS in zf.namelist():
        sst = ET.fromstring(zf.read(SHARED_STRINGS))
        shared = [_text_of(si) for si in sst.iter(_q("si"))]
    cells: dict[tuple[int, int], str] = {}
    next_row = 0
    # Stream the sheet: each <row> is read and then cleared, so memory holds
    # the cell texts, not the sheet's XML tree.
    with zf.open(_first_sheet_part(zf)) as fh:
        for _, row in ET.iterparse(fh, events=("end",)):
            if row.tag != _q("row"):
                continue
            r = row.get("r")
            row_idx = int(r) - 1 if r else next_row
            next_row = row_idx + 1
            next_col = 0
            for c in row.iter(_q("c")):
                ref = c.get("r")
                if ref:
                    m = _REF.match(ref)
                    col_idx = _col_index(m.group(1))
                else:
                    col_idx = next_col
                next_col = col_idx + 1
                text = _cell_text(c, shared)
                if text != "":
                    cells[(row_idx, col_idx)] = text
            row.clear()
    if not cells:
        raise ValueError(NO_DATA)
    rows = [k[0] for k in cells]
    cols = [k[1] for k in cells]
    r0, r1, c0, c1 = min(rows), max(rows), min(cols), max(cols)
    return [[cells.get((r, c), "") for c in range(c0, c1 + 1)] for r in range(r0, r1 + 1)]


def _parse_batches(source_col: str, content_col: str, chunk: int = 8192):
    def run(batches):
        import pyarrow as pa

        schema = pa.schema([("source", pa.string()), ("row_no", pa.int64()), ("cells", pa.list_(pa.string()))])
        for batch in batches:
            srcs = batch.column(source_col).to_pylist()
            blobs = batch.column(content_col).to_pylist()
            for src, blob in zip(srcs, blobs):
                if blob is None:
                    continue
                rows = workbook_rows(blob)
                for lo in range(0, len(rows), chunk):
                    part = rows[lo:lo + chunk]
                    yield pa.RecordBatch.from_pydict(
                        {"source": [src] * len(part), "row_no": list(range(lo, lo + len(part))), "cells": part},
                        schema=schema,
                    )

    return run


def workbook_cells(df: DataFrame, content: str = "content", source: str | None = None) -> DataFrame:
    """Rows ``(source, row_no, cells)`` of every workbook held in ``content``
    (binary). ``source`` names a column identifying the workbook."""
    ship_package(df.sparkSession)
    src = qcol(source).cast("string") if source else F.lit(None).cast("string")
    base = df.select(src.alias("__src"), qcol(content).alias("__content"))
    return base.mapInArrow(_parse_batches("__src", "__content"), ROWS_SCHEMA)


def cells_to_columns(cells: DataFrame, width: int | None = None, keep_source: bool = False) -> DataFrame:
    if width is None:
        # Parse every workbook once: land the parsed rows, then size them.
        cells = materialize_frame(cells, "xlsx-cells")
        width = cells.agg(F.max(F.size("cells"))).first()[0]
        if not width:
            raise ValueError(NO_DATA)
    guard = F.when(
        F.size("cells") > width,
        F.raise_error(F.lit("workbook row is wider than the requested width")),
    ).otherwise(F.lit(True))
    cols = [F.get(F.col("cells"), i).alias(COLUMN_FORMAT.format(i)) for i in range(width)]
    extra = [F.col("source"), F.col("row_no")] if keep_source else []
    return cells.where(guard).select(*extra, *cols)


def read_excel(spark: SparkSession, path, *, width: int | None = None, keep_source: bool = False,
               path_glob: str | None = None) -> DataFrame:
    """The first sheet of each workbook under ``path`` as text columns.
    ``path_glob`` (for example ``"*.xlsx"``) keeps other files of a directory
    out."""
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read.format("binaryFile")
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    files = reader.load(paths)
    return cells_to_columns(workbook_cells(files, "content", "path"), width, keep_source)


def parse_workbook_bytes(df: DataFrame, content: str, *, width: int | None = None,
                         source: str | None = None) -> DataFrame:
    """S9 for workbooks: xlsx bytes held in a binary column."""
    return cells_to_columns(workbook_cells(df, content, source), width, keep_source=bool(source))

