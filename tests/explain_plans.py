"""Print the physical plans of the main operators as Markdown.

    python tests/explain_plans.py [sf_dir]

Each section shows Spark's executed plan (simple form) for one operator over
the driver tables, so scans (ReadSchema, PushedFilters), shuffles (Exchange),
bounded top-k (TakeOrderedAndProject) and broadcasts can be checked by eye.
"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from quarry.operators.profile import profile_basic, profile_detailed  # noqa: E402
from quarry.operators.transform import limit_rows, select_columns  # noqa: E402
from quarry.plans.copy_job import sql_extract  # noqa: E402
from quarry.plans.fixtures import event_bodies  # noqa: E402
from quarry.session import local_session, scratch_dir  # noqa: E402
from quarry.sinks import write_csv  # noqa: E402
from quarry.sources.columnar import read_parquet  # noqa: E402
from quarry.sources.json import parse_http_bodies  # noqa: E402
from quarry.sources.text import read_csv  # noqa: E402


def plan_text(df) -> str:
    """``DataFrame.explain`` after running the query, so the adaptive plan
    shown is the final one (real stage shapes)."""
    import contextlib
    import io

    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()

    def t(name):
        return read_parquet(spark, f"{sf_dir}/{name}.parquet")

    csv_dir = scratch_dir(spark, "plans-csv")
    write_csv(t("lineitem"), csv_dir)
    cases = [
        ("P2 exact profile of lineitem (per-column counts, one shared final aggregate)",
         profile_detailed(t("lineitem"))),
        ("P2 exact profile, type-family plan (used above 32 columns)",
         profile_detailed(t("lineitem"), exact_plan="narrow", samples=False)),
        ("P2 approximate profile (one wide aggregate)", profile_detailed(t("lineitem"), distinct="approx")),
        ("P1 basic profile of documents left join labels",
         profile_basic(t("documents").join(t("labels"), "doc_id", "left"))),
        ("T1 select on Parquet (pruned ReadSchema)", select_columns(t("part"), ["p_name", "p_size"])),
        ("T2 ordered head-N (bounded top-k)", limit_rows(t("orders"), 10, order_by="o_orderkey")),
        ("T2 head-N in file order", limit_rows(t("lineitem"), 10, file_order=True)),
        ("S1 CSV read with a filter (pushed to the CSV parser)",
         read_csv(spark, csv_dir).where(F.col("l_quantity") > 45).select("l_orderkey", "l_quantity")),
        ("S11/S4 landed bodies parsed (one from_json per record)",
         parse_http_bodies(event_bodies(t("events"))).select("event_id", "value")),
        ("J5 SQL over registered views",
         sql_extract(spark, "SELECT o_orderpriority, count(*) AS n FROM orders "
                            "WHERE o_orderdate >= TIMESTAMP_NTZ '1997-01-01 00:00:00' GROUP BY 1",
                     {"orders": t("orders")})),
    ]
    print("# Physical plans\n")
    print(f"Generated by `python tests/explain_plans.py {sf_dir}` (final adaptive plans after execution).\n")
    for title, df in cases:
        print(f"## {title}\n")
        print("```")
        print(plan_text(df).rstrip())
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
