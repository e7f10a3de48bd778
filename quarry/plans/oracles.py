"""DuckDB SQL equivalents of the registered queries (the correctness gate).

Column names and types follow the Spark side: counts BIGINT, positions
INTEGER, timestamps reported as epoch microseconds.
"""

from __future__ import annotations

# Schemas of the driver tables the profile oracles walk (name, Spark type label).
ORDERS = [
    ("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
    ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string"),
]
LINEITEM = [
    ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
    ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
    ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
    ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz"),
]
SUPPLIER = [("s_suppkey", "bigint"), ("s_name", "string"), ("s_nationkey", "int"), ("s_acctbal", "double")]
DOCUMENTS = [
    ("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint"),
]
DOCS_LABELS = [
    ("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"),
    ("n_chars", "bigint"), ("quality", "int"), ("toxic", "int"),
]
CUSTOMER_STRINGS = ["c_name", "c_mktsegment"]
DOCUMENT_STRINGS = ["text", "lang", "source"]
EMBEDDINGS = [("vec_id", "bigint"), ("embedding", "array<float>"), ("label", "int")]
# lineitem as read back from CSV: ints widen to bigint, timestamps stay text.
LINEITEM_FROM_CSV = [
    (c, {"int": "bigint", "timestamp_ntz": "string"}.get(t, t)) for c, t in LINEITEM
]

INT_TYPES = {"bigint", "int", "boolean"}
EPOCH_TYPES = {"timestamp_ntz", "timestamp"}
FLOAT_TYPES = {"double", "float"}


def _unique(c: str) -> str:
    return f"count(DISTINCT {c}) + coalesce(max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END), 0)"


def _minmax(c: str, t: str) -> tuple[str, str, str, str]:
    null_i, null_f = "CAST(NULL AS BIGINT)", "CAST(NULL AS DOUBLE)"
    if t in INT_TYPES:
        return f"CAST(min({c}) AS BIGINT)", f"CAST(max({c}) AS BIGINT)", null_f, null_f
    if t in EPOCH_TYPES:
        return f"min(epoch_us({c}))", f"max(epoch_us({c}))", null_f, null_f
    if t in FLOAT_TYPES:
        v = f"CASE WHEN isnan({c}) THEN NULL ELSE {c} END"
        return null_i, null_i, f"CAST(min({v}) AS DOUBLE)", f"CAST(max({v}) AS DOUBLE)"
    return null_i, null_i, null_f, null_f


def detailed_profile_sql(source: str, cols, with_unique: bool = True) -> str:
    parts = []
    for i, (c, t) in enumerate(cols):
        mn_i, mx_i, mn_f, mx_f = _minmax(c, t)
        uniq = f"CAST({_unique(c)} AS BIGINT) AS \"unique\", " if with_unique else ""
        parts.append(
            f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS \"column\", '{t}' AS dtype, "
            f"CAST(count(*) - count({c}) AS BIGINT) AS nulls, {uniq}"
            f"{mn_i} AS min_int, {mx_i} AS max_int, {mn_f} AS min_float, {mx_f} AS max_float, "
            f"CAST(count(*) AS BIGINT) AS row_count FROM {source}"
        )
    return "\nUNION ALL\n".join(parts)


def basic_profile_sql(source: str, cols) -> str:
    parts = [
        f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS \"column\", '{t}' AS dtype, "
        f"CAST(count(*) - count({c}) AS BIGINT) AS nulls, CAST(count(*) AS BIGINT) AS row_count FROM {source}"
        for i, (c, t) in enumerate(cols)
    ]
    return "\nUNION ALL\n".join(parts)


def samples_sql(table: str = "customer", key: str = "c_custkey", columns=None) -> str:
    parts = [
        f"SELECT '{c}' AS \"column\", CAST(rn - 1 AS INTEGER) AS sample_pos, v AS value FROM "
        f"(SELECT {c} AS v, row_number() OVER (ORDER BY {key}) AS rn FROM {table} WHERE {c} IS NOT NULL) "
        f"WHERE rn <= 3"
        for c in (columns or CUSTOMER_STRINGS)
    ]
    return "\nUNION ALL\n".join(parts)


def json_profile_sql(table: str = "supplier", key: str = "s_suppkey") -> str:
    """The exported document: extremes as numbers, samples joined by ``|``."""
    parts = []
    for c, t in SUPPLIER:
        ends = _minmax(c, t)
        names = ("min_int", "max_int", "min_float", "max_float")
        cells = ", ".join(f"CAST({e} AS DOUBLE) AS {n}" for e, n in zip(ends, names))
        first = f"(SELECT {c} FROM {table} WHERE {c} IS NOT NULL ORDER BY {key} LIMIT 3)"
        samples = f"(SELECT string_agg({c}, '|') FROM {first})" if t == "string" else "CAST(NULL AS VARCHAR)"
        parts.append(
            f"SELECT '{c}' AS \"column\", '{t}' AS dtype, CAST(count(*) - count({c}) AS BIGINT) AS nulls, "
            f"CAST({_unique(c)} AS BIGINT) AS \"unique\", {cells}, {samples} AS samples FROM {table}"
        )
    return "\nUNION ALL\n".join(parts)


DOCS_JOIN = "(SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic " \
            "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"

def number_text_sql(c: str) -> str:
    """A double as the xlsx reader prints it: shortest digits, no ``.0``."""
    return f"regexp_replace(CAST({c} AS VARCHAR), '\\.0$', '')"


def header_rows_sql(table: str, key: str, per_book: int, names) -> str:
    """One header row (the column names as text) per workbook; a workbook
    holds one block of ``per_book`` consecutive key values."""
    cols = ", ".join(f"'{n}' AS col{i}" for i, n in enumerate(names))
    return f"SELECT {cols} FROM (SELECT DISTINCT floor({key} / {per_book}) AS b FROM {table})"


ORDERS_1997 = "SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01 00:00:00'"

ORACLES = {
    "profile_detailed_orders": detailed_profile_sql("orders", ORDERS),
    "profile_detailed_lineitem": detailed_profile_sql("lineitem", LINEITEM),
    "profile_approx_lineitem": "SELECT *, true AS unique_close FROM ("
                               + detailed_profile_sql("lineitem", LINEITEM, with_unique=False) + ")",
    "profile_state_lineitem": "SELECT *, true AS unique_close FROM ("
                              + detailed_profile_sql("lineitem", LINEITEM, with_unique=False) + ")",
    "published_overwrite": "SELECT * FROM orders WHERE o_orderkey % 2 = 0",
    "profile_basic_nulls": basic_profile_sql(DOCS_JOIN, DOCS_LABELS),
    "profile_detailed_nulls": detailed_profile_sql(DOCS_JOIN, DOCS_LABELS),
    "profile_detailed_documents": detailed_profile_sql("documents", DOCUMENTS),
    "profile_samples": samples_sql(),
    "profile_detailed_embeddings": detailed_profile_sql("embeddings", EMBEDDINGS),
    "profile_samples_documents": samples_sql("documents", "doc_id", DOCUMENT_STRINGS),
    "profile_json": json_profile_sql(),
    "select_columns": "SELECT p_name, p_partkey, p_retailprice FROM part",
    "limit_rows": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 100",
    "limit_file_order": "SELECT * FROM lineitem LIMIT 100",
    "csv_roundtrip": "SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey, s_acctbal FROM supplier",
    "csv_no_header": "SELECT CAST(r_regionkey AS BIGINT) AS column_1, r_name AS column_2 FROM region",
    "csv_multiline_pages": "SELECT page_id, url, html FROM pages",
    "csv_split_documents": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "text_pipe_options": "SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, "
                         "p_retailprice FROM part",
    "text_tab_comment": "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, "
                        "c_mktsegment FROM customer",
    "text_skip_multiline": "SELECT item_id, text FROM benchmark",
    "text_skip_multiline_documents": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "profile_csv_input": detailed_profile_sql("lineitem", LINEITEM_FROM_CSV),
    "csv_payloads": "SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey, s_acctbal FROM supplier",
    "csv_payloads_schema": "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier",
    "limit_first_rows": "SELECT * FROM orders LIMIT 250",
    "file_pipeline": "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity, l_returnflag "
                     "FROM lineitem ORDER BY l_orderkey, l_linenumber LIMIT 1000",
    "json_lines_roundtrip": "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, "
                            "c_mktsegment FROM customer",
    "json_lines_conversations": "SELECT conv_id, turn, role, text FROM conversations",
    "json_from_text": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "json_bodies": "SELECT event_id, epoch_us(ts) AS ts_us, user_id, event_type, value, props FROM events "
                   "WHERE floor(event_id / 100) % 10 NOT IN (3, 8)",
    "json_late_fields": "SELECT event_id, event_type, CASE WHEN event_id % 1000 = 999 THEN value END AS late_value, "
                        "CASE WHEN event_id % 1000 = 999 THEN props END AS late_props FROM events",
    "parquet_copy": "SELECT * FROM lineitem",
    "orc_roundtrip": "SELECT * FROM nation",
    "avro_read": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, epoch_us(o_orderdate) AS o_orderdate, "
                 "o_orderpriority FROM orders",
    "excel_read": "SELECT CAST(p_partkey AS VARCHAR) AS col0, p_name AS col1, p_brand AS col2, p_type AS col3, "
                  "CAST(p_size AS VARCHAR) AS col4, " + number_text_sql("p_retailprice") + " AS col5 FROM part "
                  "UNION ALL " + header_rows_sql("part", "p_partkey", 500,
                                                 ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]),
    "excel_bytes": "SELECT CAST(c_custkey AS VARCHAR) AS col0, c_name AS col1, CAST(c_nationkey AS VARCHAR) AS col2, "
                   + number_text_sql("c_acctbal") + " AS col3, c_mktsegment AS col4 FROM customer "
                   "UNION ALL " + header_rows_sql("customer", "c_custkey", 400,
                                                  ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]),
    "parquet_bytes": "SELECT * FROM orders",
    "sql_copy_filtered": ORDERS_1997,
    "jdbc_query": ORDERS_1997,
    "jdbc_resumable": "SELECT * FROM orders",
    "jdbc_partitioned": "SELECT * FROM orders",
}
