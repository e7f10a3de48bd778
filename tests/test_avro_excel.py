import datetime as dt
import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.plans.fixtures import avro_container, write_avro_files, xlsx_bytes
from quarry.sources.avro import read_avro
from quarry.sources.excel import UnsupportedWorkbook, number_text, parse_workbook_bytes, read_excel, workbook_rows


AVRO_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
    T.StructField("day", T.DateType()), T.StructField("m", T.MapType(T.StringType(), T.LongType())),
    T.StructField("raw", T.BinaryType()),
])


def test_avro_types_through_json(spark, tmp):
    rows = [
        {"id": 1, "name": "a", "day": dt.date(1970, 1, 3), "m": {"k": 5}, "raw": b"AB"},
        {"id": 2, "name": None, "day": None, "m": None, "raw": None},
    ]
    with open(tmp + "/a.avro", "wb") as fh:
        fh.write(avro_container(rows, AVRO_SCHEMA))
    df = read_avro(spark, tmp + "/a.avro")
    types = {f.name: f.dataType for f in df.schema.fields}
    assert types["id"] == T.LongType() and types["name"] == T.StringType()
    assert types["day"] == T.LongType()  # logical date stays an integer
    assert isinstance(types["m"], T.StructType)  # map becomes a struct
    got = {r.id: r for r in df.collect()}
    assert got[1].day == 2 and got[1].m.k == 5 and got[1].raw == "AB"
    assert got[2].name is None


def test_avro_split_over_tasks(spark, tmp):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("s", T.StringType())])
    rows = [{"id": i, "s": "x" * 50} for i in range(20000)]
    with open(tmp + "/big.avro", "wb") as fh:
        fh.write(avro_container(rows, schema, block_rows=500))
    spark.conf.set("spark.hadoop.mapreduce.input.fileinputformat.split.maxsize", "200000")
    df = read_avro(spark, tmp + "/big.avro")
    assert df.count() == 20000
    assert df.agg({"id": "sum"}).first()[0] == sum(range(20000))


def test_avro_files_are_written_as_rows_come(spark, tmp):
    df = spark.createDataFrame([], "id long, s string")
    runs = []

    class Frame:
        schema, sparkSession = df.schema, spark

        def mapInArrow(self, run, schema):
            runs.append(run)
            return spark.createDataFrame([], schema)

    write_avro_files(Frame(), tmp)

    def batches():
        for k in range(5):
            # what came before is in the file, but for a block and the file's buffer
            assert k == 0 or sum(os.path.getsize(f"{tmp}/{f}") for f in os.listdir(tmp)) > (k - 1) * 4000 * 55
            yield pa.RecordBatch.from_pydict({"id": range(4000 * k, 4000 * (k + 1)), "s": ["x" * 50] * 4000})

    assert [b.to_pylist() for b in runs[0](batches())] == [[{"rows": 20000}]]
    assert [f for f in os.listdir(tmp) if not f.endswith(".avro")] == []
    rows = read_avro(spark, tmp, native=False)
    assert rows.count() == 20000 and rows.agg({"id": "sum"}).first()[0] == sum(range(20000))
    assert list(runs[0](iter([])))[0].to_pylist() == [{"rows": 0}]


def test_avro_file_of_a_failed_task_is_gone(spark, tmp):
    df = spark.createDataFrame([(i, "x") for i in range(3000)], "id long, s string").coalesce(1)
    bad = df.withColumn("s", F.when(F.col("id") == 2500, F.raise_error(F.lit("no"))).otherwise(F.col("s")))
    with pytest.raises(Exception, match="no"):
        write_avro_files(bad, tmp)
    assert os.listdir(tmp) == []


def test_avro_missing(spark, tmp):
    with pytest.raises(FileNotFoundError):
        read_avro(spark, tmp + "/none.avro")


def test_number_text():
    assert number_text("1") == "1" and number_text("1.0") == "1" and number_text("1.5") == "1.5"
    assert number_text("1e21") == "1000000000000000000000"
    assert number_text("1E-7") == "0.0000001"
    assert number_text("-2.50") == "-2.5"


def test_workbook_rules():
    data = xlsx_bytes([
        [["name", "n", "ok"], ["ann", 1, True], [None, 2.5, None], ["bob", None, False]],
        [["second sheet"]],
    ])
    assert workbook_rows(data) == [["name", "n", "ok"], ["ann", "1", "true"], ["", "2.5", ""], ["bob", "", "false"]]
    inline = xlsx_bytes([[["x", "y"], ["1", "2"]]], shared=False)
    assert workbook_rows(inline) == [["x", "y"], ["1", "2"]]


def test_workbook_used_range_starts_at_first_cell():
    data = xlsx_bytes([[[None, None], [None, "a", "b"], [None, "c"]]])
    assert workbook_rows(data) == [["a", "b"], ["c", ""]]


def test_workbook_errors():
    with pytest.raises(ValueError, match="No data in Excel sheet"):
        workbook_rows(xlsx_bytes([[]]))
    with pytest.raises(UnsupportedWorkbook, match="xls"):
        workbook_rows(b"\xd0\xcf\x11\xe0" + b"\x00" * 100)
    with pytest.raises(UnsupportedWorkbook):
        workbook_rows(b"plain text")


def test_read_excel_files(spark, tmp):
    with open(tmp + "/a.xlsx", "wb") as fh:
        fh.write(xlsx_bytes([[["h1", "h2", "h3"], [1, 2, 3]]]))
    with open(tmp + "/b.xlsx", "wb") as fh:
        fh.write(xlsx_bytes([[["h1", "h2"], ["x", "y"]]]))
    df = read_excel(spark, tmp)
    assert df.columns == ["col0", "col1", "col2"]
    rows = sorted((tuple(r) for r in df.collect()), key=repr)
    # header rows are data; the narrower workbook gets nulls
    assert rows == sorted([("h1", "h2", "h3"), ("1", "2", "3"), ("h1", "h2", None), ("x", "y", None)], key=repr)
    with pytest.raises(Exception, match="wider"):
        read_excel(spark, tmp, width=2).collect()


def test_workbook_bytes_column(spark):
    books = spark.createDataFrame([("b1", xlsx_bytes([[["a"], ["b"]]]))], "book string, content binary")
    df = parse_workbook_bytes(books, "content", source="book")
    assert [tuple(r) for r in df.orderBy("row_no").collect()] == [("b1", 0, "a"), ("b1", 1, "b")]


def test_columnar_payloads(spark, tmp):
    import io

    import pyarrow as pa
    import pyarrow.orc as po
    import pyarrow.parquet as pq

    from quarry.sources.payload import parse_avro_bytes, parse_orc_bytes, parse_parquet_bytes

    table = pa.table({"id": pa.array([1, 2, 3], pa.int64()), "s": ["a", None, "c"]})
    pbuf, obuf = io.BytesIO(), io.BytesIO()
    pq.write_table(table, pbuf)
    po.write_table(table, obuf)
    abytes = avro_container([{"id": 1, "s": "a"}, {"id": 2, "s": None}],
                            T.StructType([T.StructField("id", T.LongType()), T.StructField("s", T.StringType())]))
    df = spark.createDataFrame([(pbuf.getvalue(), obuf.getvalue(), abytes)], "p binary, o binary, a binary")
    assert sorted(parse_parquet_bytes(df, "p", tmp + "/p").collect(), key=repr) == sorted(
        [(1, "a"), (2, None), (3, "c")], key=repr)
    assert parse_orc_bytes(df, "o", tmp + "/o").count() == 3
    assert sorted(r.id for r in parse_avro_bytes(df, "a", tmp + "/a").collect()) == [1, 2]


def test_land_bytes_is_idempotent_and_rejects_remote_paths(spark, tmp):
    import os

    from quarry.sources.payload import land_bytes

    df = spark.createDataFrame([(b"one",), (b"two",)], "c binary").coalesce(1)
    land_bytes(df, "c", tmp + "/land", ".bin")
    land_bytes(df, "c", tmp + "/land", ".bin")  # a re-run (or a retried task) replaces, never adds
    names = sorted(n for n in os.listdir(tmp + "/land") if not n.startswith("."))
    assert names == ["part-00000-0000000.bin", "part-00000-0000001.bin"]
    with pytest.raises(ValueError, match="not a local or mounted path"):
        land_bytes(df, "c", "hdfs://nn/x")


def test_rich_and_phonetic_shared_strings():
    import io
    import zipfile

    data = xlsx_bytes([[["placeholder"]]])
    src = zipfile.ZipFile(io.BytesIO(data))
    out = io.BytesIO()
    ns = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    sst = (f'<sst xmlns="{ns}"><si><r><t>bold</t></r><r><t xml:space="preserve"> text</t></r></si>'
           f'<si><t>漢字</t><rPh sb="0" eb="2"><t>かんじ</t></rPh></si></sst>')
    sheet = (f'<worksheet xmlns="{ns}"><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c>'
             f'<c r="B1" t="s"><v>1</v></c></row></sheetData></worksheet>')
    with zipfile.ZipFile(out, "w") as zf:
        for name in src.namelist():
            if name == "xl/sharedStrings.xml":
                continue
            zf.writestr(name, sheet if name.endswith("sheet1.xml") else src.read(name))
        zf.writestr("xl/sharedStrings.xml", sst)
    assert workbook_rows(out.getvalue()) == [["bold text", "漢字"]]


def test_read_excel_glob(spark, tmp):
    with open(tmp + "/a.xlsx", "wb") as fh:
        fh.write(xlsx_bytes([[["x"]]]))
    with open(tmp + "/notes.txt", "w") as fh:
        fh.write("not a workbook")
    assert read_excel(spark, tmp, path_glob="*.xlsx").collect()[0][0] == "x"
