"""A sample of the registered queries against their SQL in DuckDB."""

import os

import pytest

from tallyloom import workloads

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
SAMPLE = [
    "q_clean_ids", "q_ffill", "q_first_by", "q_numbered_preamble", "q_upsert_scoped", "q_published_table",
    "q_load_orders", "q_upfront_offprice", "q_cartons_to_come", "q_inventory", "q_reconcile_invoices", "q_form_to_po",
]

workloads.load_all()


def test_every_query_has_its_sql():
    assert set(workloads.QUERIES) == set(workloads.ORACLES)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")
@pytest.mark.parametrize("name", SAMPLE)
def test_query_agrees_with_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    df = workloads.QUERIES[name](spark, FOLDER)
    cols = sorted(df.columns)
    quoted = ", ".join(f'"{c}"' for c in cols)
    expected = con.sql(f"SELECT {quoted} FROM ({workloads.ORACLES[name]})").fetchall()
    order = lambda r: tuple(str(v) for v in r)
    got = sorted((tuple(r) for r in df.select(*cols).collect()), key=order)
    assert len(got) > 0
    assert got == sorted(expected, key=order)
