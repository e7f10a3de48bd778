"""The registered queries: one per operator of SURVEY §2, each over the whole
driver tables (or files Spark writes from them), each with a DuckDB oracle.

Round trips write to a fresh directory under the session's shared checkpoint
directory, so every executor sees them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.export import export_profile_json
from quarry.operators.profile import flatten_profile, profile_basic, profile_detailed
from quarry.operators.profile_state import profile_from_state, update_profile_state
from quarry.operators.transform import limit_rows, select_columns
from quarry.plans.copy_job import copy_data, copy_sql
from quarry.plans.fixtures import (
    FILE_BYTES,
    csv_bodies,
    event_bodies,
    in_bounded_files,
    parquet_payloads,
    workbooks_from,
    write_avro_files,
    write_with_preamble,
)
from quarry.plans.pipeline import run_file_pipeline
from quarry.plans.resumable import copy_resumable, read_copied
from quarry.session import scratch_dir
from quarry.sinks import write_csv, write_json, write_orc, write_parquet
from quarry.sinks.published import publish, read_published
from quarry.sources.avro import read_avro
from quarry.sources.columnar import read_orc, read_parquet
from quarry.sources.excel import parse_workbook_bytes, read_excel
from quarry.sources.json import parse_http_bodies, parse_json_text, read_json
from quarry.sources.payload import land_bytes, parse_parquet_bytes
from quarry.sources.text import parse_csv_text, read_csv, read_text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


# ------------------------------------------------------------------ profiles


def q_profile_detailed_orders(spark, sf_dir):
    return flatten_profile(profile_detailed(table(spark, sf_dir, "orders")))


def q_profile_detailed_lineitem(spark, sf_dir):
    return flatten_profile(profile_detailed(table(spark, sf_dir, "lineitem")))


def q_profile_approx_lineitem(spark, sf_dir):
    """P2 with HyperLogLog distinct counts. ``unique`` is compared with the
    exact count: within five standard deviations of the stated error."""
    lineitem = table(spark, sf_dir, "lineitem")
    prof = flatten_profile(profile_detailed(lineitem, distinct="approx", approx_rsd=0.02))
    exact = flatten_profile(profile_detailed(lineitem, samples=False)).select(
        "position", F.col("unique").alias("exact")
    )
    close = F.abs(F.col("unique") - F.col("exact")) <= F.greatest(F.lit(1.0), 0.1 * F.col("exact"))
    return prof.join(exact, "position").withColumn("unique_close", close).drop("unique", "exact")


def q_profile_state_lineitem(spark, sf_dir):
    """P2 as mergeable state: the table arrives in two parts, each scanned
    once, and the profile comes from the state alone. ``unique`` and the median are
    compared with the exact ones."""
    lineitem = table(spark, sf_dir, "lineitem")
    data, state = scratch_dir(spark, "grown"), scratch_dir(spark, "profile-state")
    for part in (0, 1):
        write_parquet(lineitem.where(F.col("l_orderkey") % 2 == part), f"{data}/{part}")
        update_profile_state(spark, state, data)
    exact = flatten_profile(profile_detailed(lineitem, samples=False)).select("position", F.col("unique").alias("exact"))
    close = F.abs(F.col("unique") - F.col("exact")) <= F.greatest(F.lit(1.0), 0.08 * F.col("exact"))
    found = profile_from_state(spark.read.parquet(state))
    return flatten_profile(found).join(exact, "position").withColumn("unique_close", close).drop("unique", "exact")


def q_published_overwrite(spark, sf_dir):
    """K2 published: a table is replaced by a job that reads it, and read back."""
    path = scratch_dir(spark, "published")
    publish(table(spark, sf_dir, "orders"), path)
    publish(read_published(spark, path).where("o_orderkey % 2 = 0"), path)
    return read_published(spark, path)


def q_profile_basic_nulls(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    return profile_basic(docs.join(labels, "doc_id", "left"))


def q_profile_detailed_nulls(spark, sf_dir):
    """P2 over a frame with nulls (labels cover part of the documents)."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    return flatten_profile(profile_detailed(docs.join(labels, "doc_id", "left"), order_by="doc_id"))


def q_profile_detailed_documents(spark, sf_dir):
    """P2 over whole texts: distinct counts move digests, not documents."""
    return flatten_profile(profile_detailed(table(spark, sf_dir, "documents"), order_by="doc_id"))


def q_profile_samples(spark, sf_dir):
    prof = profile_detailed(table(spark, sf_dir, "customer"), order_by="c_custkey")
    return prof.where(F.col("sample_values").isNotNull()).select(
        "column", F.posexplode("sample_values").alias("sample_pos", "value")
    )


def q_profile_detailed_embeddings(spark, sf_dir):
    """P2 over an array column (grouped by value, no min/max) and an int."""
    return flatten_profile(profile_detailed(table(spark, sf_dir, "embeddings")))


def q_profile_samples_documents(spark, sf_dir):
    """P2e over whole documents: the first three texts by doc_id, untruncated."""
    prof = profile_detailed(table(spark, sf_dir, "documents"), order_by="doc_id")
    return prof.where(F.col("sample_values").isNotNull()).select(
        "column", F.posexplode("sample_values").alias("sample_pos", "value")
    )


def q_profile_json(spark, sf_dir):
    out = scratch_dir(spark, "profile-json")
    export_profile_json(profile_detailed(table(spark, sf_dir, "supplier"), order_by="s_suppkey"), out)
    back = spark.read.schema(
        "column string, dtype string, nulls bigint, `unique` bigint, min string, max string, "
        "sample_values array<string>"
    ).option("multiLine", "true").json(out)
    return back.select(
        "column", "dtype", "nulls", "unique",
        *[
            F.get_json_object(end, f"$.{kind}").cast("double").alias(f"{end}_{kind.lower()}")
            for end in ("min", "max") for kind in ("Int", "Float")
        ],
        F.array_join("sample_values", "|").alias("samples"),
    )


# ------------------------------------------------------------------ transforms


def q_select_columns(spark, sf_dir):
    return select_columns(table(spark, sf_dir, "part"), ["p_name", "p_partkey", "p_retailprice"])


def q_limit_rows(spark, sf_dir):
    return limit_rows(table(spark, sf_dir, "orders"), 100, order_by="o_orderkey")


def q_limit_file_order(spark, sf_dir):
    """T2 as the reference's head-N: the first rows in file order."""
    return limit_rows(table(spark, sf_dir, "lineitem"), 100, file_order=True)


# ------------------------------------------------------------------ text


def q_csv_roundtrip(spark, sf_dir):
    out = scratch_dir(spark, "csv")
    write_csv(table(spark, sf_dir, "supplier"), out)
    return read_csv(spark, out)


def q_csv_no_header(spark, sf_dir):
    out = scratch_dir(spark, "csv-nohdr")
    write_csv(table(spark, sf_dir, "region"), out, header=False)
    return read_csv(spark, out, has_header=False)


def q_csv_multiline_pages(spark, sf_dir):
    """K1 + S1 with whole raw web pages: quotes, commas and newlines inside
    fields survive the round trip (``multiline=True``)."""
    out = scratch_dir(spark, "csv-pages")
    write_csv(table(spark, sf_dir, "pages"), out)
    return read_csv(spark, out, multiline=True)


def q_csv_split_documents(spark, sf_dir):
    """K1 + S1 over all documents in large files with quoted newlines, each read
    by many tasks (``multiline="split"``)."""
    out = scratch_dir(spark, "csv-docs")
    write_csv(table(spark, sf_dir, "documents"), out)
    return read_csv(spark, out, multiline="split", schema="doc_id long, text string, lang string, source string, n_chars long")


def q_text_pipe_options(spark, sf_dir):
    out = scratch_dir(spark, "pipe")
    write_with_preamble(table(spark, sf_dir, "part"), out, "|", 2)
    return read_text(spark, out, delimiter="|", has_header=True, comment_prefix="##", skip_rows=2)


def q_text_skip_multiline(spark, sf_dir):
    """S2 split records: skipped junk lines, ``##`` comments and quoted
    newlines together, over the benchmark passages."""
    out = scratch_dir(spark, "bench-text")
    write_with_preamble(table(spark, sf_dir, "benchmark"), out, ",", 2)
    return read_text(spark, out, comment_prefix="##", skip_rows=2, multiline=True)


def q_text_skip_multiline_documents(spark, sf_dir):
    """S2 split records over all documents: texts of any length, quotes,
    commas and newlines, after skipped lines."""
    out = scratch_dir(spark, "docs-text")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    write_with_preamble(in_bounded_files(docs, FILE_BYTES), out, ",", 2)
    return read_text(spark, out, comment_prefix="##", skip_rows=2, multiline=True)


def q_text_tab_comment(spark, sf_dir):
    """S2 on the direct CSV scan: tab separator, one-character comment prefix."""
    out = scratch_dir(spark, "tsv")
    write_with_preamble(table(spark, sf_dir, "customer"), out, "\t", 0)
    return read_text(spark, out, delimiter="\t", comment_prefix="#")


def q_profile_csv_input(spark, sf_dir):
    """P2 over a CSV-backed frame: the input is landed once as Parquet and
    profiled column family by column family; shipdate stays text."""
    out = scratch_dir(spark, "csv-profile")
    write_csv(table(spark, sf_dir, "lineitem"), out)
    return flatten_profile(profile_detailed(read_csv(spark, out), samples=False))


def q_csv_payloads(spark, sf_dir):
    """CSV documents held in a string column, one per block of suppliers."""
    bodies = csv_bodies(table(spark, sf_dir, "supplier"), "s_suppkey")
    return parse_csv_text(bodies, "body")


def q_csv_payloads_schema(spark, sf_dir):
    """S9 with a given schema, matched by each document's own header."""
    bodies = csv_bodies(table(spark, sf_dir, "supplier"), "s_suppkey")
    schema = "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"
    return parse_csv_text(bodies, "body", schema=schema)


def q_limit_first_rows(spark, sf_dir):
    """T2 by default: the first rows in file order."""
    return limit_rows(table(spark, sf_dir, "orders"), 250)


def q_file_pipeline(spark, sf_dir):
    """Parquet -> select -> ordered limit -> CSV, read back."""
    out = scratch_dir(spark, "pipeline")
    run_file_pipeline(
        spark, "parquet", f"{sf_dir.rstrip('/')}/lineitem.parquet", "csv", out,
        columns=["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"],
        limit=1000, order_by=["l_orderkey", "l_linenumber"],
    )
    return read_csv(spark, out)


# ------------------------------------------------------------------ JSON


def q_json_lines_roundtrip(spark, sf_dir):
    out = scratch_dir(spark, "jsonl")
    write_json(table(spark, sf_dir, "customer"), out)
    return read_json(spark, out)


def q_json_lines_conversations(spark, sf_dir):
    """K3 + S3 with free text (quotes, newlines, non-ASCII)."""
    out = scratch_dir(spark, "jsonl-conv")
    write_json(table(spark, sf_dir, "conversations"), out)
    return read_json(spark, out)


def q_json_from_text(spark, sf_dir):
    return parse_json_text(table(spark, sf_dir, "events"), "props", keep=["event_id"])


def q_json_bodies(spark, sf_dir):
    bodies = event_bodies(table(spark, sf_dir, "events"))
    return parse_http_bodies(bodies)


def q_json_late_fields(spark, sf_dir):
    """S3 where two fields occur in few records only, none of them among the
    first of a file: the schema comes from all records."""
    events = table(spark, sf_dir, "events")
    rare = F.col("event_id") % 1000 == 999
    out = scratch_dir(spark, "jsonl-late")
    write_json(
        events.select("event_id", "event_type", F.when(rare, F.col("value")).alias("late_value"),
                      F.when(rare, F.col("props")).alias("late_props")),
        out,
    )
    return read_json(spark, out)


# ------------------------------------------------------------------ columnar


def q_parquet_copy(spark, sf_dir):
    out = scratch_dir(spark, "parquet")
    write_parquet(table(spark, sf_dir, "lineitem"), out)
    return read_parquet(spark, out)


def q_orc_roundtrip(spark, sf_dir):
    out = scratch_dir(spark, "orc")
    write_orc(table(spark, sf_dir, "nation"), out)
    return read_orc(spark, out)


def q_avro_read(spark, sf_dir):
    out = scratch_dir(spark, "avro")
    write_avro_files(table(spark, sf_dir, "orders"), out)
    return read_avro(spark, out)


def _land_workbooks(books: DataFrame, directory: str) -> None:
    """Land workbook bytes as ``.xlsx`` files (fixture for S6)."""
    land_bytes(books.select("content"), "content", directory, ".xlsx")


def q_excel_read(spark, sf_dir):
    """S6 over workbooks built from ``part``, one per block of 500 part keys;
    each workbook's header row comes back as data, as the reader keeps it."""
    out = scratch_dir(spark, "xlsx")
    _land_workbooks(workbooks_from(table(spark, sf_dir, "part"), "p_partkey", rows_per_book=500), out)
    return read_excel(spark, out)


def q_excel_bytes(spark, sf_dir):
    """Workbooks held as bytes in a column, parsed in place, header rows
    included."""
    books = workbooks_from(table(spark, sf_dir, "customer"), "c_custkey", rows_per_book=400)
    return parse_workbook_bytes(books, "content")


def q_parquet_bytes(spark, sf_dir):
    """S9 for columnar bytes: Parquet files held in a column are landed under
    the checkpoint directory and scanned."""
    payloads = parquet_payloads(table(spark, sf_dir, "orders"), rows_per_file=2000)
    return parse_parquet_bytes(payloads, "content")


# ------------------------------------------------------------------ SQL / JDBC


def q_sql_copy_filtered(spark, sf_dir):
    out = scratch_dir(spark, "sqlcopy")
    # a view name of its own, so a caller's view called "orders" is left alone
    view = f"orders_{uuid.uuid4().hex[:8]}"
    copy_sql(
        spark,
        f"SELECT * FROM {view} WHERE o_orderdate >= TIMESTAMP_NTZ '1997-01-01 00:00:00';",
        out,
        tables={view: table(spark, sf_dir, "orders")},
    )
    spark.catalog.dropTempView(view)
    return read_parquet(spark, out)


DERBY_DRIVER = "org.apache.derby.jdbc.EmbeddedDriver"


def derby_with(spark, df: DataFrame, name: str) -> str:
    """Load ``df`` into an in-memory Derby database inside this JVM and return
    its URL. Derby is embedded: no server, no port, visible to this process
    only."""
    url = f"jdbc:derby:memory:quarry_{uuid.uuid4().hex[:10]};create=true"
    df.write.jdbc(url, name, mode="overwrite", properties={"driver": DERBY_DRIVER})
    return url


ORDERS_SINCE_1997 = 'SELECT * FROM ORDERS WHERE "o_orderdate" >= \'1997-01-01 00:00:00\';'


def q_jdbc_query(spark, sf_dir):
    url = derby_with(spark, table(spark, sf_dir, "orders"), "orders")
    out = scratch_dir(spark, "jdbc")
    copy_data(spark, url, ORDERS_SINCE_1997, out, driver=DERBY_DRIVER, single_connection=True,
              options={"preferTimestampNTZ": "true"})
    return read_parquet(spark, out)


def q_jdbc_partitioned(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    url = derby_with(spark, orders, "orders")
    lo, hi = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    out = scratch_dir(spark, "jdbc-part")
    copy_data(spark, url, 'SELECT * FROM ORDERS', out, driver=DERBY_DRIVER,
              partition_column='"o_orderkey"', lower_bound=lo, upper_bound=hi + 1,
              num_partitions=4, options={"preferTimestampNTZ": "true"})
    return read_parquet(spark, out)


def q_jdbc_resumable(spark, sf_dir):
    """J1 in balanced ranges, each landed on its own and entered in a ledger."""
    url = derby_with(spark, table(spark, sf_dir, "orders"), "orders")
    out = scratch_dir(spark, "jdbc-ranges")
    options = dict(driver=DERBY_DRIVER, options={"preferTimestampNTZ": "true"})
    copy_resumable(spark, url, "SELECT * FROM ORDERS", out, '"o_orderkey"', 6, **options)
    return read_copied(spark, out)


QUERIES = {
    "profile_detailed_orders": q_profile_detailed_orders,
    "profile_detailed_lineitem": q_profile_detailed_lineitem,
    "profile_approx_lineitem": q_profile_approx_lineitem,
    "profile_state_lineitem": q_profile_state_lineitem,
    "published_overwrite": q_published_overwrite,
    "profile_basic_nulls": q_profile_basic_nulls,
    "profile_detailed_nulls": q_profile_detailed_nulls,
    "profile_detailed_documents": q_profile_detailed_documents,
    "profile_samples": q_profile_samples,
    "profile_detailed_embeddings": q_profile_detailed_embeddings,
    "profile_samples_documents": q_profile_samples_documents,
    "profile_json": q_profile_json,
    "select_columns": q_select_columns,
    "limit_rows": q_limit_rows,
    "limit_file_order": q_limit_file_order,
    "csv_roundtrip": q_csv_roundtrip,
    "csv_no_header": q_csv_no_header,
    "csv_multiline_pages": q_csv_multiline_pages,
    "csv_split_documents": q_csv_split_documents,
    "text_pipe_options": q_text_pipe_options,
    "text_tab_comment": q_text_tab_comment,
    "text_skip_multiline": q_text_skip_multiline,
    "text_skip_multiline_documents": q_text_skip_multiline_documents,
    "profile_csv_input": q_profile_csv_input,
    "csv_payloads": q_csv_payloads,
    "csv_payloads_schema": q_csv_payloads_schema,
    "limit_first_rows": q_limit_first_rows,
    "file_pipeline": q_file_pipeline,
    "json_lines_roundtrip": q_json_lines_roundtrip,
    "json_lines_conversations": q_json_lines_conversations,
    "json_from_text": q_json_from_text,
    "json_bodies": q_json_bodies,
    "json_late_fields": q_json_late_fields,
    "parquet_copy": q_parquet_copy,
    "orc_roundtrip": q_orc_roundtrip,
    "avro_read": q_avro_read,
    "excel_read": q_excel_read,
    "excel_bytes": q_excel_bytes,
    "parquet_bytes": q_parquet_bytes,
    "sql_copy_filtered": q_sql_copy_filtered,
    "jdbc_query": q_jdbc_query,
    "jdbc_partitioned": q_jdbc_partitioned,
    "jdbc_resumable": q_jdbc_resumable,
}
