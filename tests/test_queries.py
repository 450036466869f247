"""Queries against their SQL on the small table."""

from __future__ import annotations

import duckdb
import pytest
from gaugeworks import classify_queries, queries, register_queries, report_queries, review_queries, wide_queries

SMALL = "/root/testdata/sf0.001"
NAMES = [*review_queries.oracle_sql(), *report_queries.oracle_sql(), "staged_reconciliation", *register_queries.oracle_sql(), *wide_queries.oracle_sql(), "exact_matches", "reconciliation", "ultimate_parents", "vessel_match", "sponsor_index", "unit_index", "index_stats"]
SQL = queries.oracle_sql() | review_queries.oracle_sql() | report_queries.oracle_sql() | classify_queries.oracle_sql() | register_queries.oracle_sql() | wide_queries.oracle_sql()
RUN = queries.queries() | review_queries.queries() | report_queries.queries() | classify_queries.queries() | register_queries.queries() | wide_queries.queries()


def shown(value):
    return round(float(value), 6) if isinstance(value, float) or hasattr(value, "as_tuple") else value


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for name in queries.TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_rows_are_those_of_the_sql(spark, tables, name):
    out = RUN[name](spark, SMALL)
    got = sorted(str([shown(r[c]) for c in sorted(out.columns)]) for r in out.collect())
    found = tables.execute(SQL[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(out.columns)
    want = sorted(str([shown(r[columns.index(c)]) for c in sorted(columns)]) for r in found.fetchall())
    assert got == want and got


def test_export_of_all_tables_records_what_fails(spark, tmp_path):
    from gaugeworks.plans.traversal import export_all

    frames = {t: spark.read.parquet(f"{SMALL}/{t}.parquet") for t in queries.GRAPH.keys}
    frames["supplier"] = frames["supplier"].drop("s_nationkey")
    told = {e[0]: e for e in export_all(queries.GRAPH.walk("region", depth=2), frames, "r_name = 'ASIA'", f"file://{tmp_path}")}
    assert told["region"][3:] == (1, "") and told["nation"][3] == spark.read.parquet(f"file://{tmp_path}/nation").count() > 0
    assert told["supplier"][3] is None and told["supplier"][4] and told["customer"][4] == ""
