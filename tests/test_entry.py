import __spark_entry__ as entry


def test_every_query_has_an_oracle():
    qs, oracles = entry.queries(), entry.oracle_sql()
    assert entry.QUERIES and set(entry.QUERIES) <= set(qs)
    assert set(entry.QUERIES) <= set(oracles) <= set(qs)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["position", "column", "dtype", "nulls", "unique", "min_int", "max_int",
                          "min_float", "max_float", "row_count"]
    rows = df.collect()
    assert [r.column for r in rows] == ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
    assert all(r.row_count > 0 for r in rows)
