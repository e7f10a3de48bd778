"""Fixture builders for the registered queries and tests.

They turn the driver's tables into the file shapes the readers must handle
(delimited text with a preamble, landed JSON bodies, Avro containers, xlsx
workbooks). They are not part of the library's user surface: Spark writes
Parquet/ORC/CSV/JSON itself, but has no writer for Avro without the
``spark-avro`` package and none for xlsx, so those two are encoded in Python,
one file per partition, written straight to a local or mounted directory.
"""

from __future__ import annotations

import io
import itertools
import json
import os
import struct
import uuid
import zipfile
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import local_dir, ship_package, task_file_name, write_file_atomic

# ------------------------------------------------------------------ delimited text

KEEP_SPACES = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


# A file that is read whole by one task; quotes and escapes come on top.
FILE_BYTES = 16 << 20


def write_with_preamble(df: DataFrame, path: str, delimiter: str, junk_lines: int) -> None:
    """Lay ``df`` out as delimited text where every file starts with
    ``junk_lines`` junk lines, a header and a ``##`` comment, and has a second
    comment after its fifth row. Rows are rendered by ``to_csv`` (quoting
    included); the position inside a partition comes from the low 33 bits of
    ``monotonically_increasing_id``, so no shuffle or window is involved."""
    header = delimiter.join(df.columns)
    preamble = "".join(f"junk line {i + 1} of the export\n" for i in range(junk_lines))
    preamble += header + "\n## exported rows follow\n"
    row_in_part = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    line = F.to_csv(F.struct(*df.columns), {"sep": delimiter, "quote": '"', "escape": '"', **KEEP_SPACES})
    text = (
        F.when(row_in_part == 0, F.concat(F.lit(preamble), line))
        .when(row_in_part == 5, F.concat(F.lit("## checkpoint comment\n"), line))
        .otherwise(line)
    )
    df.select(text.alias("value")).write.mode("overwrite").text(path)


def in_bounded_files(df: DataFrame, most: int, least: int = 8) -> DataFrame:
    """Deal ``df`` evenly over as many partitions, and so files, as its text
    needs at ``most`` bytes each, ``least`` at least. One pass sums the sizes."""
    width = F.octet_length(F.concat_ws(",", *[F.col(c).cast("string") for c in df.columns]))
    size = df.agg(F.sum(width.cast("long")).alias("size")).first()["size"] or 0
    return df.repartition(max(least, -(-size // most)))


def csv_bodies(df: DataFrame, key: str, per_body: int = 25) -> DataFrame:
    """CSV documents ``(block, body)`` built from ``df``: one document per
    block of ``per_body`` consecutive ``key`` values, header first, rows
    rendered by ``to_csv``. Odd blocks have their columns in reverse order."""
    block = F.floor(F.col(key) / per_body)
    options = {"quote": '"', "escape": '"', **KEEP_SPACES}
    odd = block % 2 == 1
    back = df.columns[::-1]
    line = F.when(odd, F.to_csv(F.struct(*back), options)).otherwise(F.to_csv(F.struct(*df.columns), options))
    header = F.when(F.col("block") % 2 == 1, F.lit(",".join(back))).otherwise(F.lit(",".join(df.columns)))
    rows = F.sort_array(F.collect_list(F.struct(F.col(key).alias("k"), line.alias("l")))).alias("rows")
    grouped = df.groupBy(block.alias("block")).agg(rows)
    return grouped.select(
        "block",
        F.concat(header, F.lit("\n"), F.array_join(F.transform("rows", lambda r: r["l"]), "\n")).alias("body"),
    )


# ------------------------------------------------------------------ JSON bodies


def event_bodies(events: DataFrame, per_body: int = 100) -> DataFrame:
    """Landed responses ``(url, status, body)`` built from ``events``: one
    body per user and block of ``per_body`` event ids (so a body never holds
    more than ``per_body`` records, however hot the user). Every tenth block was
    refused (404) or failed (500), with a body that is not JSON. Of the others,
    even blocks are pretty-printed JSON arrays framed by newlines, odd blocks
    NDJSON with a last newline."""
    block = F.floor(F.col("event_id") / per_body)
    rec = F.struct("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"), "user_id",
                   "event_type", "value", "props")
    grouped = events.groupBy("user_id", block.alias("block")).agg(
        F.sort_array(F.collect_list(rec)).alias("recs")
    )
    lines = F.transform(F.col("recs"), lambda r: F.to_json(r))
    as_array = F.concat(F.lit("\n[\n  "), F.array_join(lines, ",\n  "), F.lit("\n]\r\n"))
    as_lines = F.concat(F.array_join(lines, "\n"), F.lit("\n"))
    status = (
        F.when(F.col("block") % 10 == 3, F.lit(404)).when(F.col("block") % 10 == 8, F.lit(500)).otherwise(F.lit(200))
    )
    good = F.when(F.col("block") % 2 == 0, as_array).otherwise(as_lines)
    return grouped.select(
        F.concat(F.lit("/users/"), F.col("user_id"), F.lit("/events?block="), F.col("block")).alias("url"),
        status.alias("status"),
        F.when(status == 200, good).otherwise(F.lit("<html>no events</html>")).alias("body"),
    )


# ------------------------------------------------------------------ Avro


def _zigzag(n: int) -> bytes:
    n = (n << 1) ^ (n >> 63)
    out = bytearray()
    while True:
        b = n & 0x7F
        n >>= 7
        if n:
            out.append(b | 0x80)
        else:
            out.append(b)
            return bytes(out)


def _avro_type(dt: T.DataType):
    if isinstance(dt, (T.LongType,)):
        return "long"
    if isinstance(dt, (T.IntegerType, T.ShortType, T.ByteType)):
        return "int"
    if isinstance(dt, T.DoubleType):
        return "double"
    if isinstance(dt, T.FloatType):
        return "float"
    if isinstance(dt, T.BooleanType):
        return "boolean"
    if isinstance(dt, T.BinaryType):
        return "bytes"
    if isinstance(dt, T.DateType):
        return {"type": "int", "logicalType": "date"}
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return {"type": "long", "logicalType": "timestamp-micros"}
    if isinstance(dt, T.MapType):
        return {"type": "map", "values": ["null", _avro_type(dt.valueType)]}
    return "string"


_AVRO_SLICE = 1000  # rows that are Python objects at once


def avro_schema(schema: T.StructType, name: str = "row") -> dict:
    return {
        "type": "record",
        "name": name,
        "fields": [{"name": f.name, "type": ["null", _avro_type(f.dataType)]} for f in schema.fields],
    }


def _encoder(dt: T.DataType):
    """A function appending one nullable value of type ``dt`` (union branch
    0 = null, 1 = the type), chosen once per field rather than per value."""
    import datetime as dt_mod

    null, present = _zigzag(0), _zigzag(1)
    if isinstance(dt, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        def body(v, out):
            out += _zigzag(int(v))
    elif isinstance(dt, T.DoubleType):
        pack = struct.Struct("<d").pack

        def body(v, out):
            out += pack(v)
    elif isinstance(dt, T.FloatType):
        pack = struct.Struct("<f").pack

        def body(v, out):
            out += pack(v)
    elif isinstance(dt, T.BooleanType):
        def body(v, out):
            out += b"\x01" if v else b"\x00"
    elif isinstance(dt, T.BinaryType):
        def body(v, out):
            out += _zigzag(len(v)) + bytes(v)
    elif isinstance(dt, T.DateType):
        epoch_day = dt_mod.date(1970, 1, 1)

        def body(v, out):
            out += _zigzag((v - epoch_day).days)
    elif isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        def body(v, out):
            delta = v - dt_mod.datetime(1970, 1, 1, tzinfo=v.tzinfo)
            out += _zigzag((delta.days * 86400 + delta.seconds) * 1_000_000 + delta.microseconds)
    elif isinstance(dt, T.MapType):
        value_enc = _encoder(dt.valueType)

        def body(v, out):
            items = list(v.items()) if isinstance(v, dict) else list(v)
            if items:
                out += _zigzag(len(items))
                for k, x in items:
                    kb = str(k).encode()
                    out += _zigzag(len(kb)) + kb
                    value_enc(x, out)
            out += null
    else:
        def body(v, out):
            b = str(v).encode()
            out += _zigzag(len(b)) + b

    def encode(v, out):
        if v is None:
            out += null
        else:
            out += present
            body(v, out)

    return encode


def avro_blocks(rows, schema: T.StructType, sync: bytes | None = None, block_rows: int = 1000):
    """The header of an Avro object container file (null codec), then its blocks
    of ``block_rows`` rows. ``rows`` may be any iterable and is read block by block."""
    sync = sync or uuid.uuid4().bytes
    out = bytearray(b"Obj\x01")
    meta = {"avro.schema": json.dumps(avro_schema(schema)).encode(), "avro.codec": b"null"}
    out += _zigzag(len(meta))
    for k, v in meta.items():
        kb = k.encode()
        out += _zigzag(len(kb)) + kb + _zigzag(len(v)) + v
    yield bytes(out + _zigzag(0) + sync)
    encoders = [(f.name, _encoder(f.dataType)) for f in schema.fields]
    rows = iter(rows)
    while chunk := list(itertools.islice(rows, block_rows)):
        block = bytearray()
        for r in chunk:
            for name, enc in encoders:
                enc(r[name], block)
        yield _zigzag(len(chunk)) + _zigzag(len(block)) + block + sync


def avro_container(rows, schema: T.StructType, sync: bytes | None = None, block_rows: int = 1000) -> bytes:
    """An Avro object container file (null codec) holding ``rows``."""
    return b"".join(avro_blocks(rows, schema, sync, block_rows))


def write_avro_files(df: DataFrame, directory: str) -> int:
    """One Avro file per partition of ``df`` under a local/mounted
    ``directory``; returns the number of files. A task holds a block of its
    file at a time."""
    schema = df.schema
    ship_package(df.sparkSession)
    target = local_dir(directory)
    os.makedirs(target, exist_ok=True)

    def run(batches):
        import hashlib

        import pyarrow as pa

        done = 0

        def rows():
            nonlocal done
            for b in batches:
                for at in range(0, len(b), _AVRO_SLICE):
                    some = b.slice(at, _AVRO_SLICE).to_pylist()
                    done += len(some)
                    yield from some

        stream = rows()
        first = next(stream, None)
        if first is not None:
            name = task_file_name(0, ".avro")
            # Deterministic but high-entropy sync marker: a retried task writes
            # the same bytes, and the marker does not occur in the data.
            sync = hashlib.md5(name.encode()).digest()
            write_file_atomic(target, name, avro_blocks(itertools.chain([first], stream), schema, sync=sync))
        yield pa.RecordBatch.from_pydict({"rows": [done]}, schema=pa.schema([("rows", pa.int64())]))

    return df.mapInArrow(run, "rows bigint").where("rows > 0").count()


# ------------------------------------------------------------------ xlsx


def _col_letters(i: int) -> str:
    s = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        s = chr(65 + r) + s
    return s


def xlsx_bytes(sheets: list[list[list]], shared: bool = True) -> bytes:
    """A minimal xlsx workbook. ``sheets`` is a list of sheets, each a list of
    rows of Python values (str, int, float, bool, None). Strings go to the
    shared string table when ``shared``, else inline."""
    strings: list[str] = []
    index: dict[str, int] = {}
    sheet_xml = []
    for rows in sheets:
        out = ['<?xml version="1.0" encoding="UTF-8"?>',
               '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>']
        for r, row in enumerate(rows):
            out.append(f'<row r="{r + 1}">')
            for c, v in enumerate(row):
                ref = f"{_col_letters(c)}{r + 1}"
                if v is None:
                    continue
                if isinstance(v, bool):
                    out.append(f'<c r="{ref}" t="b"><v>{int(v)}</v></c>')
                elif isinstance(v, (int, float)):
                    out.append(f'<c r="{ref}"><v>{v!r}</v></c>')
                elif shared:
                    if v not in index:
                        index[v] = len(strings)
                        strings.append(v)
                    out.append(f'<c r="{ref}" t="s"><v>{index[v]}</v></c>')
                else:
                    out.append(f'<c r="{ref}" t="inlineStr"><is><t>{escape(v)}</t></is></c>')
            out.append("</row>")
        out.append("</sheetData></worksheet>")
        sheet_xml.append("".join(out))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        zf.writestr("[Content_Types].xml",
                    '<?xml version="1.0" encoding="UTF-8"?>'
                    '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
                    '<Default Extension="xml" ContentType="application/xml"/></Types>')
        sheets_el = "".join(
            f'<sheet name="Sheet{i + 1}" sheetId="{i + 1}" r:id="rId{i + 1}"/>' for i in range(len(sheet_xml))
        )
        zf.writestr("xl/workbook.xml",
                    '<?xml version="1.0" encoding="UTF-8"?>'
                    '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
                    'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">'
                    f"<sheets>{sheets_el}</sheets></workbook>")
        rels = "".join(
            f'<Relationship Id="rId{i + 1}" '
            'Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" '
            f'Target="worksheets/sheet{i + 1}.xml"/>'
            for i in range(len(sheet_xml))
        )
        zf.writestr("xl/_rels/workbook.xml.rels",
                    '<?xml version="1.0" encoding="UTF-8"?>'
                    '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                    f"{rels}</Relationships>")
        for i, xml in enumerate(sheet_xml):
            zf.writestr(f"xl/worksheets/sheet{i + 1}.xml", xml)
        if strings:
            items = "".join(f"<si><t>{escape(s)}</t></si>" for s in strings)
            zf.writestr("xl/sharedStrings.xml",
                        '<?xml version="1.0" encoding="UTF-8"?>'
                        '<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
                        f"{items}</sst>")
    return buf.getvalue()


def workbooks_from(df: DataFrame, key: str, rows_per_book: int = 500) -> DataFrame:
    """Workbook bytes ``(book, content)`` built from ``df``: one workbook per
    block of ``rows_per_book`` consecutive ``key`` values (so a book never
    holds more than that many rows, and the number of books follows from the
    data alone), each with the column names as its first row. Books of odd
    blocks use inline strings, even ones the shared string table."""
    names = df.columns
    ship_package(df.sparkSession)

    def build(pdf):
        import pandas as pd

        block = int(pdf["__block"].iloc[0])
        body = pdf.sort_values(key)[names]
        rows = [[None if pd.isna(v) else (v.item() if hasattr(v, "item") else v) for v in r]
                for r in body.itertuples(index=False, name=None)]
        content = xlsx_bytes([[list(names)] + rows], shared=(block % 2 == 0))
        return pd.DataFrame({"book": [f"book-{block:07d}"], "content": [content]})

    blocks = df.withColumn("__block", F.floor(F.col(key) / rows_per_book))
    return blocks.groupBy("__block").applyInPandas(build, "book string, content binary")


# ------------------------------------------------------------------ Parquet bytes


def parquet_payloads(df: DataFrame, rows_per_file: int = 2000) -> DataFrame:
    """Parquet files as bytes ``(file, content)`` built from ``df``, at most
    ``rows_per_file`` rows each, written by pyarrow inside each task."""
    out_schema = "file string, content binary"
    ship_package(df.sparkSession)

    def run(batches):
        import io as _io

        import pyarrow as pa
        import pyarrow.parquet as pq

        files, blobs = [], []
        pending = []
        count = 0

        def flush():
            nonlocal pending, count
            if not pending:
                return
            buf = _io.BytesIO()
            pq.write_table(pa.Table.from_batches(pending), buf)
            files.append(task_file_name(len(files), ".parquet"))
            blobs.append(buf.getvalue())
            pending, count = [], 0

        for b in batches:
            for lo in range(0, b.num_rows, rows_per_file):
                piece = b.slice(lo, rows_per_file)
                if count + piece.num_rows > rows_per_file:
                    flush()
                pending.append(piece)
                count += piece.num_rows
        flush()
        yield pa.RecordBatch.from_pydict(
            {"file": files, "content": blobs}, schema=pa.schema([("file", pa.string()), ("content", pa.binary())])
        )

    return df.mapInArrow(run, out_schema)
