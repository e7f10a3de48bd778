"""CSV and delimited text readers.

Routes, all lazy after schema discovery:

* scan: Spark's CSV scan with an explicit schema. Used whenever Spark's own
  options express the request (any separator, quote, one-character comment,
  multi-line quoted fields) and no file is larger than a split.
* split records (``split_csv``): quoted newlines in files that are worth several
  tasks, or together with skipped lines or a long comment prefix. One more pass
  finds the quoting state at each split; then records are assembled in their
  splits and parsed by ``from_csv``. ``multiline="split"`` asks for it.
* line stage: skipped lines or a comment prefix of several characters without
  quoted newlines. A per-partition counter drops the first lines of each file's first
  split and marks the header, and ``from_csv`` parses the rest.
* whole file: as split records, in other encodings than UTF-8; one task a file.

Schema discovery: one bounded ``limit(1 + infer_schema_length)`` job fetches
the header (or first row) together with the inference sample; the types come
from the rules in ``quarry.functions.inference`` applied to that sample. With
``infer_schema_length=None``, and where malformed rows are to be dropped, they come
from one aggregate over all rows instead.

Types, given or inferred, hold for every row: the parser marks rows that it objects
to, and of those alone the text is looked at again. A value that does not fit its
type raises, it is never turned into null. Long rows raise as well, unless told
otherwise; short rows get nulls. Column pruning and filters reach the scan.

Headers must agree: with a given schema, and between files or payload documents.
Another header raises; where documents or files are parsed on their own (payloads
and split records) the same columns in another order are matched by name.
``check_header=False`` goes by position.

``multiline=False`` splits files at every newline and raises on a line whose
quotes do not balance.
"""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.encoding import qcol
from quarry.functions.inference import infer_types, infer_types_from_rows
from quarry.functions.naming import generated_names, header_names
from quarry.session import ship_package
from quarry.sources.split_csv import LineRule, read_records, split_states

EXTRA = "__quarry_extra__"
# The parser reports an unquoted empty field as ``nullValue`` and a quoted one
# (``""``) as the empty string. With the default ``nullValue=""`` both would
# turn into null; a NUL sentinel keeps them apart: empty field -> null,
# ``""`` -> "".
NULL_SENTINEL = "\u0000"
LAST = "\u0000\u0001last"  # a field that no data holds
RAGGED_MODES = ("error", "ignore")


def _paths(path) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def _ddl(schema: T.StructType) -> str:
    return ", ".join(
        "`" + f.name.replace("`", "``") + "` " + f.dataType.simpleString() for f in schema.fields
    )


def _options(delimiter, quote_char, comment, multiline, encoding, mode):
    quote = quote_char or '"'
    opts = {
        "sep": delimiter,
        "quote": quote,
        "escape": quote,
        "multiLine": str(bool(multiline)).lower(),
        "encoding": encoding,
        "mode": mode,
        "nullValue": NULL_SENTINEL,
    }
    if comment:
        opts["comment"] = comment
    return opts


def _marked(schema: T.StructType) -> T.StructType:
    """The schema with the column that keeps the text of rows the parser objects to."""
    return T.StructType(schema.fields + [T.StructField(EXTRA, T.StringType(), True)])


def _checked(df: DataFrame, schema: T.StructType, opts: dict, on_ragged: str) -> DataFrame:
    """Rows parsed with ``_marked(schema)``, those the parser objected to looked at
    again. Their text is parsed as strings with one more field at its end: where
    that comes out tells a long row (an error, unless ragged rows are ignored), a
    short one (the rest are nulls) and a full one (a value does not fit its type,
    an error; so is such a value in a short row). Other rows are not looked at."""
    n = len(schema.fields)
    texts = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(n + 2)])
    options = {k: v for k, v in opts.items() if k not in ("encoding", "mode", "comment")}
    cells = F.from_csv(F.concat(F.col(EXTRA), F.lit(opts["sep"] + LAST)), _ddl(texts), options)
    full = F.coalesce(cells[f"c{n}"] == LAST, F.lit(False))
    short = F.lit(False)
    for i in range(n):
        short = short | F.coalesce(cells[f"c{i}"] == LAST, F.lit(False))
    # Spark reads the kept text of a row only next to another column
    first = F.coalesce(qcol(schema.fields[0].name).cast("string"), F.lit(""))
    row = F.concat(F.lit(" in row "), F.substring(F.concat(EXTRA, F.substring(first, 1, 0)), 1, 200))
    problem = F.when(full, F.lit("a value does not fit its type"))
    for i, f in enumerate(schema.fields):
        if not isinstance(f.dataType, T.StringType):
            c = cells[f"c{i}"]
            wrong = c.isNotNull() & (c != "") & (c != LAST) & c.try_cast(f.dataType).isNull()
            problem = problem.when(
                wrong, F.concat(F.lit(f"column {f.name}: value '"), c, F.lit(f"' does not fit the type {f.dataType.simpleString()}"))
            )
    if on_ragged == "error":
        problem = problem.when(~short, F.lit("CSV row has more fields than the header"))
    raised = F.when(problem.isNotNull(), F.raise_error(F.concat(problem, row))).otherwise(F.lit(True))
    return df.where(F.when(F.col(EXTRA).isNotNull(), raised).otherwise(F.lit(True))).drop(EXTRA)


def _check_long(df: DataFrame, on_ragged: str) -> DataFrame:
    """Parsed records: ``EXTRA`` says whether one has more fields than columns."""
    if on_ragged != "error":
        return df.drop(EXTRA)
    guard = F.when(
        F.col(EXTRA).isNotNull(),
        F.raise_error(F.lit("CSV row has more fields than the header")),
    ).otherwise(F.lit(True))
    return df.where(guard).drop(EXTRA)


def _same_names(schema: T.StructType, raw: list) -> None:
    """A given schema must name the header's columns, in their order."""
    found, wanted = header_names(raw), [f.name for f in schema.fields]
    if found != wanted:
        raise ValueError(
            f"the header has the columns {found}, the schema {wanted}: give the schema in the header's order, "
            "or check_header=False to go by position"
        )


def _typed(names, types) -> T.StructType:
    return T.StructType([T.StructField(n, types[n], True) for n in names])


def _fitting(name: str, kind: T.DataType):
    """Column ``name`` (a string) as the given type; a non-empty value that
    does not fit raises."""
    c = qcol(name)
    if isinstance(kind, T.StringType):
        return c.alias(name)
    parsed = c.try_cast(kind)
    wrong = F.concat(F.lit(f"column {name}: value '"), c, F.lit(f"' does not fit the type {kind.simpleString()}"))
    return F.when(c.isNull() | (c == ""), F.lit(None)).when(parsed.isNotNull(), parsed).otherwise(
        F.raise_error(wrong)
    ).cast(kind).alias(name)


def _fit_columns(df: DataFrame, schema: T.StructType, carried=()) -> DataFrame:
    rest = [c for c in df.columns if c == EXTRA]
    return df.select(
        *[qcol(c) for c in carried], *[_fitting(f.name, f.dataType) for f in schema.fields], *[qcol(c) for c in rest]
    )


def _balanced(value, quote: str):
    """``value``, or an error if a quoted field goes on in the next line."""
    quotes = F.length(value) - F.length(F.replace(value, F.lit(quote), F.lit("")))
    return F.when(quotes % 2 == 0, value).otherwise(
        F.raise_error(F.lit("a quoted field holds a newline: read with multiline=True"))
    )


def _validate(delimiter, quote_char, skip_rows, on_ragged):
    if not delimiter:
        raise ValueError("delimiter must not be empty")
    if quote_char is not None and len(quote_char) != 1:
        raise ValueError("quote_char must be one character")
    if skip_rows < 0:
        raise ValueError("skip_rows must be >= 0")
    if on_ragged not in RAGGED_MODES:
        raise ValueError(f"on_ragged must be one of {RAGGED_MODES}")


def read_text(
    spark: SparkSession,
    path,
    delimiter: str = ",",
    has_header: bool = True,
    quote_char: str | None = None,
    comment_prefix: str | None = None,
    skip_rows: int = 0,
    infer_schema_length: int | None = 100,
    *,
    infer_dates: bool = False,
    on_ragged: str = "error",
    multiline: bool | str | None = None,
    schema: T.StructType | str | None = None,
    check_header: bool = True,
    encoding: str = "UTF-8",
    mode: str = "PERMISSIVE",
) -> DataFrame:
    """Delimited text with separator, quote, comment prefix, skipped
    leading lines and an inference length. ``schema`` skips inference (the
    production path at scale); its names are compared with each file's header, or
    replace it with ``check_header=False``. A value that does not fit its type raises."""
    _validate(delimiter, quote_char, skip_rows, on_ragged)
    schema = _as_struct(schema)
    if schema is None and mode == "DROPMALFORMED":
        infer_schema_length = None  # types of a sample would drop good rows
    paths = _paths(path)
    needs_lines = skip_rows > 0 or (comment_prefix is not None and len(comment_prefix) > 1)
    if needs_lines:
        if encoding.upper().replace("-", "") not in ("UTF8", "USASCII", "ASCII"):
            if multiline and mode == "PERMISSIVE":
                return _read_whole_files_route(
                    spark, paths, delimiter, has_header, quote_char, comment_prefix, skip_rows,
                    infer_schema_length, infer_dates, on_ragged, schema, check_header, encoding,
                )
            raise ValueError(f"skipped lines and long comment prefixes need UTF-8, or multiline=True "
                             f"and mode='PERMISSIVE', not {encoding}")
        route = _read_split_route if multiline else _read_lines_route
        return route(
            spark, paths, delimiter, has_header, quote_char, comment_prefix, skip_rows,
            infer_schema_length, infer_dates, on_ragged, schema, check_header, mode,
        )
    if multiline == "split" or (multiline is None and _splits_pay(spark, paths, delimiter, encoding)):
        return _read_split_route(
            spark, paths, delimiter, has_header, quote_char, comment_prefix, 0,
            infer_schema_length, infer_dates, on_ragged, schema, check_header, mode,
        )
    multiline = True if multiline is None else multiline
    opts = _options(delimiter, quote_char, comment_prefix, multiline, encoding, mode)
    reader = spark.read.options(**opts)
    raw = None
    if schema is None:
        # One bounded job fetches the first record (header or first data row)
        # and the inference sample together.
        sample_n = infer_schema_length if infer_schema_length is not None else 0
        rows = reader.option("header", "false").csv(paths).limit(1 + sample_n).collect()
        if not rows:
            raise ValueError(f"no rows in delimited input: {paths}")
        raw = list(rows[0])
        names = header_names(raw) if has_header else generated_names(len(raw))
        if infer_schema_length is not None:
            # Other files' header lines may appear in the sample: drop them.
            sample = [r for r in rows[1:] if list(r) != raw] if has_header else rows[:sample_n]
            types = infer_types_from_rows(spark, names, sample, infer_dates=infer_dates)
        else:
            types = infer_types(
                _scan(spark, opts, paths, _typed(names, dict.fromkeys(names, T.StringType())), has_header, raw, on_ragged),
                names, infer_dates=infer_dates,
            )
        schema = _typed(names, types)
    elif has_header and check_header:
        rows = reader.option("header", "false").csv(paths).limit(1).collect()
        if rows:
            raw = list(rows[0])
            _same_names(schema, raw)
    return _scan(spark, opts, paths, schema, has_header, raw, on_ragged)


def _splits_pay(spark, paths: list[str], delimiter: str, encoding: str) -> bool:
    """Whether the files hold more than one split takes, so that reading them in
    splits brings in more tasks."""
    if len(delimiter) != 1 or encoding.upper().replace("-", "") != "UTF8":
        return False
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        fs = target.getFileSystem(conf)
        total += sum(fs.getContentSummary(s.getPath()).getLength() for s in fs.globStatus(target) or [])
    most = int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes")
    ))
    if total <= most:
        return False
    longest = spark.read.format("binaryFile").load(paths).agg(F.max("length")).first()[0]
    return (longest or 0) > most


def _as_struct(schema) -> T.StructType | None:
    if schema is None or isinstance(schema, T.StructType):
        return schema
    return T.StructType.fromDDL(schema)


def _scan(spark, opts, paths, schema, has_header, raw, on_ragged) -> DataFrame:
    """Spark's CSV scan. When the schema has the header's names, each file's
    header is compared with it."""
    reader = spark.read.options(**opts).option("header", str(has_header).lower())
    if has_header and raw is not None and [f.name for f in schema.fields] == raw:
        reader = reader.option("enforceSchema", "false").option("caseSensitive", "true")
    df = reader.option("columnNameOfCorruptRecord", EXTRA).schema(_marked(schema)).csv(paths)
    return _checked(df, schema, opts, on_ragged)


def read_csv(
    spark: SparkSession,
    path,
    has_header: bool = True,
    *,
    infer_schema_length: int | None = 100,
    infer_dates: bool = False,
    on_ragged: str = "error",
    multiline: bool | str | None = None,
    schema: T.StructType | str | None = None,
    check_header: bool = True,
    encoding: str = "UTF-8",
    mode: str = "PERMISSIVE",
) -> DataFrame:
    """Comma-separated values with or without a header, inferred types
    (64-bit ints, doubles, booleans; date-looking text stays text unless
    ``infer_dates``). No header: columns are ``column_1, column_2, ...``."""
    return read_text(
        spark, path, ",", has_header, None, None, 0, infer_schema_length,
        infer_dates=infer_dates, on_ragged=on_ragged, multiline=multiline,
        schema=schema, check_header=check_header, encoding=encoding, mode=mode,
    )


# ------------------------------------------------------------------ line stage


def _preamble_filter(skip_rows: int, comment: str | None, has_header: bool):
    """mapInArrow body: drop each file's first ``skip_rows`` physical lines and
    comment lines, and flag the header line (the first non-empty, non-comment
    line after the skipped ones). Counting happens only for rows of a file's
    first split (``file_block_start == 0``); other rows only see the comment
    filter."""

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        seen: dict[str, int] = {}
        headed: set[str] = set()
        for batch in batches:
            value, fpath, start = batch.column(0), batch.column(1), batch.column(2)
            n = batch.num_rows
            keep = np.ones(n, dtype=bool)
            header = np.zeros(n, dtype=bool)
            if comment:
                is_comment = pc.fill_null(pc.starts_with(value, comment), False).to_numpy(zero_copy_only=False)
            else:
                is_comment = np.zeros(n, dtype=bool)
            empty = pc.fill_null(pc.equal(value, ""), True).to_numpy(zero_copy_only=False)
            first = pc.fill_null(pc.equal(start, 0), False).to_numpy(zero_copy_only=False)
            rows = np.flatnonzero(first)
            if len(rows):
                enc = pc.dictionary_encode(fpath.take(pa.array(rows)))
                codes = enc.indices.to_numpy(zero_copy_only=False)
                names = enc.dictionary.to_pylist()
                cuts = np.flatnonzero(np.diff(codes)) + 1
                bounds = np.concatenate(([0], cuts, [len(rows)]))
                for lo, hi in zip(bounds[:-1], bounds[1:]):
                    name = names[codes[lo]]
                    run_rows = rows[lo:hi]
                    base = seen.get(name, 0)
                    pos = base + np.arange(hi - lo)
                    seen[name] = base + (hi - lo)
                    keep[run_rows[pos < skip_rows]] = False
                    if has_header and name not in headed:
                        cand = run_rows[(pos >= skip_rows) & ~is_comment[run_rows] & ~empty[run_rows]]
                        if len(cand):
                            header[cand[0]] = True
                            headed.add(name)
            keep &= ~is_comment
            mask = pa.array(keep)
            yield pa.RecordBatch.from_arrays(
                [value.filter(mask), pa.array(header[keep])], names=["value", "is_header"]
            )

    return run


def _split_line(line: str, delimiter: str, quote: str) -> list[str]:
    """Fields of one delimited line (any separator length; a doubled quote
    inside quotes is a literal quote). Used for the header and the bounded
    inference sample only; the data itself is parsed by ``from_csv``."""
    fields, buf, i, in_quotes, n, k = [], [], 0, False, len(line), len(delimiter)
    while i < n:
        ch = line[i]
        if in_quotes:
            if ch == quote and i + 1 < n and line[i + 1] == quote:
                buf.append(quote)
                i += 2
                continue
            if ch == quote:
                in_quotes = False
            else:
                buf.append(ch)
            i += 1
        elif ch == quote and not buf:
            in_quotes = True
            i += 1
        elif line.startswith(delimiter, i):
            fields.append("".join(buf))
            buf = []
            i += k
        else:
            buf.append(ch)
            i += 1
    fields.append("".join(buf))
    return fields


def _read_lines_route(
    spark, paths, delimiter, has_header, quote_char, comment, skip_rows,
    infer_schema_length, infer_dates, on_ragged, schema, check_header, mode,
):
    ship_package(spark)
    lines = spark.read.text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )
    marked = lines.mapInArrow(
        _preamble_filter(skip_rows, comment, has_header), "value string, is_header boolean"
    )
    return _from_records(spark, marked, paths, delimiter, has_header, quote_char or '"', infer_schema_length, infer_dates,
                         on_ragged, schema, check_header, mode, whole=False)


def _read_split_route(
    spark, paths, delimiter, has_header, quote_char, comment, skip_rows,
    infer_schema_length, infer_dates, on_ragged, schema, check_header, mode,
):
    if len(delimiter) != 1:
        raise ValueError("multiline records are read in splits with a one-character delimiter only")
    ship_package(spark)
    quote = quote_char or '"'
    rule = LineRule(delimiter, quote, comment, skip_rows, has_header)
    known = split_states(spark, paths, rule)

    def read(paths, known, infer_schema_length, schema, check_header):
        records = read_records(spark, paths, rule, known)
        return _from_records(spark, records, paths, delimiter, has_header, quote, infer_schema_length, infer_dates,
                             on_ragged, schema, check_header, mode, whole=True)

    headers = sorted({splits.header for splits in known.values() if splits.header}) if has_header else []
    if len(headers) < 2 or (schema is not None and not check_header):
        return read(paths, known, infer_schema_length, schema, check_header)
    # Files with the same columns in another order: each header's files on their own
    names = {h: header_names(_split_line(h, delimiter, quote)) for h in headers}
    if len({tuple(sorted(n)) for n in names.values()}) > 1:
        raise ValueError(f"files with different headers cannot be read together: {headers[:2]}")
    order = names[next(splits.header for _, splits in sorted(known.items()) if splits.header)]

    def united(kinds):
        frames = []
        for header in headers:
            files = [unquote(f) for f, splits in known.items() if splits.header == header]
            # fewer files may be split in another way
            frames.append(read(files, split_states(spark, files, rule), None, _typed(names[header], kinds), True))
        return reduce(DataFrame.unionByName, frames).select(*map(qcol, order))

    if schema is None:
        strings = united(dict.fromkeys(order, T.StringType()))
        kinds = infer_types(strings, order, limit=infer_schema_length, infer_dates=infer_dates)
    else:
        _same_names(schema, order)
        kinds = {f.name: f.dataType for f in schema.fields}
    return united(kinds)


def _from_records(
    spark, marked, paths, delimiter, has_header, quote, infer_schema_length, infer_dates,
    on_ragged, schema, check_header, mode, whole,
):
    """Typed columns from ``marked``: the text of each record, or of each line
    unless ``whole``, and whether it is a file's header."""
    opts = {"sep": delimiter, "quote": quote, "escape": quote, "mode": mode, "nullValue": NULL_SENTINEL,
            "multiLine": str(whole).lower()}

    def text(value):
        return value if whole else _balanced(value, quote)

    def rows_under(header_line):
        """Data lines; another file's header line must be the same."""
        keep = ~F.col("is_header")
        if header_line is not None:
            keep = F.when(
                F.col("is_header") & (F.col("value") != F.lit(header_line)),
                F.raise_error(F.lit("files with different headers cannot be read together")),
            ).otherwise(keep)
        return marked.where(keep & (F.col("value") != "")).select(text(F.col("value")).alias("value"))

    body = rows_under(None)
    if schema is None:
        sample_n = infer_schema_length if infer_schema_length is not None else 0
        got = marked.where(F.col("value") != "").limit(1 + sample_n).collect()
        header_line = next((r["value"] for r in got if r["is_header"]), None)
        data_lines = [r["value"] for r in got if not r["is_header"]]
        if has_header and header_line is None:
            hit = marked.where("is_header").select("value").limit(1).collect()
            header_line = hit[0][0] if hit else None
        first = header_line if has_header else (data_lines[0] if data_lines else None)
        if first is None:
            raise ValueError(f"no rows in delimited input: {paths}")
        raw = _split_line(first, delimiter, quote)
        names = header_names(raw) if has_header else generated_names(len(raw))
        body = rows_under(header_line if has_header else None)
        if infer_schema_length is not None:
            sample = [_split_line(line, delimiter, quote) for line in data_lines[:sample_n]]
            types = infer_types_from_rows(spark, names, sample, infer_dates=infer_dates)
        else:
            strings = _parsed(body, _typed(names, dict.fromkeys(names, T.StringType())), opts, on_ragged)
            types = infer_types(strings, names, infer_dates=infer_dates)
        schema = _typed(names, types)
    elif has_header and check_header:
        hit = marked.where("is_header").select("value").limit(1).collect()
        if hit:
            _same_names(schema, _split_line(hit[0][0], delimiter, quote))
            body = rows_under(hit[0][0])
    return _parsed(body, schema, opts, on_ragged)


def _parsed(records: DataFrame, schema: T.StructType, opts: dict, on_ragged: str, carried=()) -> DataFrame:
    """The records in ``value`` as typed columns, after the carried ones."""
    keep = [qcol(c) for c in carried]
    if opts.get("mode") == "DROPMALFORMED":
        # from_csv knows no such mode: rows it objects to are dropped here
        opts = {k: v for k, v in opts.items() if k != "mode"}
        marked = _rows_of(records, schema, opts, keep)
        return marked.where(F.col(EXTRA).isNull()).drop(EXTRA)
    return _checked(_rows_of(records, schema, opts, keep), schema, opts, on_ragged)


def _rows_of(records, schema, opts, keep) -> DataFrame:
    parse = F.from_csv("value", _ddl(_marked(schema)), opts | {"columnNameOfCorruptRecord": EXTRA})
    return records.select(*keep, parse.alias("__r")).select(*keep, "__r.*")


# ------------------------------------------------------------ whole-file stage


def _whole_file_records(skip_rows, comment, has_header, delimiter, quote, encoding, names=None, chunk=8192):
    """mapInArrow body for quoted newlines plus skipped lines. Column 0 holds
    one whole document per row (file bytes from ``binaryFile``, or text from
    a payload column), parsed in one task like Spark's own multi-line CSV;
    any further columns are carried to every record of their document. The
    first ``skip_rows`` physical lines and comment lines are dropped, then the
    records are read with the standard CSV parser, header flagged. An unquoted
    empty field is null, a quoted one the empty string. With ``names`` each
    document's cells are put in that order by its own header; a header with
    other names raises."""

    def _kept_lines(lines):
        # A line is a comment only outside a quoted field: quote parity tells
        # (an escaped quote is doubled, so it toggles twice).
        in_quotes = False
        for n, line in enumerate(lines):
            if n < skip_rows:
                continue
            if not in_quotes and comment and line.startswith(comment):
                continue
            if line.count(quote) % 2:
                in_quotes = not in_quotes
            yield line

    def run(batches):
        import csv
        import io
        import sys

        import pyarrow as pa

        csv.field_size_limit(sys.maxsize)

        def places(header):
            """For each cell of a record its place in ``names``; extra cells follow."""
            own = header_names(header)
            if sorted(own) != sorted(names):
                raise ValueError(f"a document has the header {own}, another {list(names)}")
            return None if own == list(names) else [own.index(n) for n in names]

        def emit(batch, idx, flags, cells):
            take = pa.array(idx, pa.int64())
            carried = [batch.column(j).take(take) for j in range(1, batch.num_columns)]
            return pa.RecordBatch.from_arrays(
                carried + [pa.array(flags, pa.bool_()), pa.array(cells, pa.list_(pa.string()))],
                names=batch.schema.names[1:] + ["is_header", "cells"],
            )

        for batch in batches:
            idx, flags, cells = [], [], []
            for i, scalar in enumerate(batch.column(0)):
                blob = scalar.as_py()
                if blob is None:
                    continue
                if isinstance(blob, str):
                    text = io.StringIO(blob, newline="")
                else:  # decoded as it is read
                    text = io.TextIOWrapper(io.BytesIO(blob), encoding=encoding, newline="")
                records = csv.reader(
                    _kept_lines(text), delimiter=delimiter, quotechar=quote, doublequote=True,
                    quoting=csv.QUOTE_NOTNULL,
                )
                first, order = has_header, None
                for rec in records:
                    if not rec:
                        continue
                    if first and names is not None:
                        order = places(rec)
                    elif order:
                        rec = [rec[j] if j < len(rec) else None for j in order] + rec[len(order):]
                    idx.append(i)
                    flags.append(first)
                    cells.append(rec)
                    first = False
                    if len(cells) >= chunk:
                        yield emit(batch, idx, flags, cells)
                        idx, flags, cells = [], [], []
            if cells:
                yield emit(batch, idx, flags, cells)

    return run


def _read_whole_files_route(
    spark, paths, delimiter, has_header, quote_char, comment, skip_rows,
    infer_schema_length, infer_dates, on_ragged, schema, check_header, encoding,
):
    if len(delimiter) != 1:
        raise ValueError("multiline=True with skip_rows needs a one-character delimiter")
    quote = quote_char or '"'
    ship_package(spark)
    files = spark.read.format("binaryFile").load(paths).select("content")

    def records(names):
        return files.mapInArrow(
            _whole_file_records(skip_rows, comment, has_header, delimiter, quote, encoding, names),
            "is_header boolean, cells array<string>",
        )

    return _records_to_columns(spark, records, [], has_header, infer_schema_length, infer_dates, on_ragged,
                               schema, check_header, str(paths))


def _records_to_columns(spark, records, carried, has_header, infer_schema_length, infer_dates, on_ragged,
                        schema, check_header, what):
    """Typed columns from parsed records. ``records(names)``: the frame
    ``(carried..., is_header, cells)`` with cells in the order of ``names``."""
    names = [f.name for f in schema.fields] if schema is not None and has_header and check_header else None
    if schema is None:
        recs = records(None)
        sample_n = infer_schema_length if infer_schema_length is not None else 0
        got = recs.limit(1 + sample_n).collect()
        header = next((r["cells"] for r in got if r["is_header"]), None)
        if has_header and header is None:
            hit = recs.where("is_header").limit(1).collect()
            header = hit[0]["cells"] if hit else None
        data = [r["cells"] for r in got if not r["is_header"]]
        first = header if has_header else (data[0] if data else None)
        if first is None:
            raise ValueError(f"no rows in delimited input: {what}")
        found = header_names(first) if has_header else generated_names(len(first))
        names = found if has_header else None
        if infer_schema_length is not None:
            if has_header:  # the sample may come from documents in another order
                data = [r["cells"] for r in records(names).limit(1 + sample_n).collect() if not r["is_header"]]
            types = infer_types_from_rows(spark, found, data[:sample_n], infer_dates=infer_dates)
        else:
            body = records(names).where(~F.col("is_header"))
            types = infer_types(
                body.select(*[F.get("cells", i).alias(n) for i, n in enumerate(found)]), found, infer_dates=infer_dates
            )
        schema = _typed(found, types)
    body = records(names).where(~F.col("is_header"))
    n = len(schema.fields)
    cells = body.select(
        *[F.col(c) for c in carried],
        *[F.get("cells", i).alias(f.name) for i, f in enumerate(schema.fields)],
        F.when(F.size("cells") > n, F.lit("long")).alias(EXTRA),
    )
    return _check_long(_fit_columns(cells, schema, carried), on_ragged)


# ------------------------------------------------------------------ payloads


def parse_csv_text(
    df: DataFrame,
    body: str,
    *,
    delimiter: str = ",",
    has_header: bool = True,
    quote_char: str | None = None,
    comment_prefix: str | None = None,
    skip_rows: int = 0,
    schema: T.StructType | str | None = None,
    check_header: bool = True,
    infer_schema_length: int | None = 100,
    infer_dates: bool = False,
    on_ragged: str = "error",
    keep: list[str] | None = None,
    multiline: bool | None = None,
) -> DataFrame:
    """S9 for delimited text: each row of ``df`` holds a whole document in
    ``body`` (bytes landed in a table). Nothing is shuffled: each document is
    read by the CSV parser in the task that has its row (``multiline``, the
    default for a one-character delimiter: quoted newlines are allowed and
    columns are matched by each document's own header), the ``keep`` columns
    carried along with Arrow ``take``. With ``multiline=False`` documents are
    handled by array functions instead: split into lines, the first
    ``skip_rows`` dropped, blank and comment lines filtered out, the first
    remaining line taken as the header, which all documents must share, the
    rest exploded and parsed by ``from_csv``."""
    _validate(delimiter, quote_char, skip_rows, on_ragged)
    schema = _as_struct(schema)
    quote = quote_char or '"'
    opts = {"sep": delimiter, "quote": quote, "escape": quote, "nullValue": NULL_SENTINEL}
    keep = list(keep or [])
    if multiline is None:
        multiline = len(delimiter) == 1
    if multiline:
        if len(delimiter) != 1:
            raise ValueError("multiline=True needs a one-character delimiter")
        ship_package(df.sparkSession)
        carried = [f"__k{j}" for j in range(len(keep))]
        base = df.select(qcol(body).cast("string").alias("__body"),
                         *[qcol(k).alias(c) for k, c in zip(keep, carried)])
        ddl = ", ".join([f"{c} {df.schema[k].dataType.simpleString()}" for k, c in zip(keep, carried)]
                        + ["is_header boolean", "cells array<string>"])

        def records(names):
            return base.mapInArrow(
                _whole_file_records(skip_rows, comment_prefix, has_header, delimiter, quote, "utf-8", names), ddl
            )

        out = _records_to_columns(df.sparkSession, records, carried, has_header, infer_schema_length,
                                  infer_dates, on_ragged, schema, check_header, "payload column")
        for k, c in zip(keep, carried):
            out = out.withColumnRenamed(c, k)
        return out
    lines = F.split(qcol(body), r"\r?\n")
    after_skip = F.slice(lines, skip_rows + 1, F.greatest(F.size(lines) - skip_rows, F.lit(0)))

    def wanted(x):
        cond = x != ""
        if comment_prefix:
            cond = cond & ~x.startswith(comment_prefix)
        return cond

    kept = F.filter(after_skip, wanted)
    docs = df.select(*[qcol(k) for k in keep], kept.alias("__lines"))
    if has_header:
        header = F.get(F.col("__lines"), 0)
        if schema is None or check_header:
            got = docs.select(header.alias("h")).where(F.col("h").isNotNull()).limit(1).collect()
            first = got[0][0] if got else None
            if first is not None and schema is not None:
                _same_names(schema, _split_line(first, delimiter, quote))
            if first is not None:
                other = F.raise_error(F.lit("documents with different headers cannot be read together"))
                same = header.isNull() | (header == F.lit(first))
                docs = docs.withColumn("__lines", F.when(same, F.col("__lines")).otherwise(other))
        data = F.slice(F.col("__lines"), 2, F.greatest(F.size("__lines") - 1, F.lit(0)))
    else:
        header = F.lit(None).cast("string")
        data = F.col("__lines")
    rows = docs.select(*[qcol(k) for k in keep], F.explode(data).alias("value"))
    rows = rows.withColumn("value", _balanced(F.col("value"), quote))
    if schema is None:
        if not has_header:
            got = rows.select("value").limit(1).collect()
            first = got[0][0] if got else None
        if first is None:
            raise ValueError("no CSV rows in the payload column")
        raw = _split_line(first, delimiter, quote)
        names = header_names(raw) if has_header else generated_names(len(raw))
        if infer_schema_length is not None:
            sample = [_split_line(r[0], delimiter, quote) for r in rows.select("value").limit(infer_schema_length).collect()]
            types = infer_types_from_rows(df.sparkSession, names, sample, infer_dates=infer_dates)
        else:
            strings = _parsed(rows, _typed(names, dict.fromkeys(names, T.StringType())), opts, on_ragged)
            types = infer_types(strings, names, infer_dates=infer_dates)
        schema = _typed(names, types)
    return _parsed(rows, schema, opts, on_ragged, keep)
